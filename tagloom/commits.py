"""Folders whose content changes as a whole.

Data is written to folders of its own first.  A small numbered JSON document
then names the folders that count, so readers see all of a change or nothing
of it, and a write that stops halfway leaves what was there before.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from .functions.days import Day, partition_value

#: Documents kept behind the newest one, for readers that have just listed them.
KEPT = 5
_locks: dict[str, threading.Lock] = defaultdict(threading.Lock)


@dataclass(frozen=True)
class CommitLog:
    """A JSON document in a folder, replaced by the next number.

    A writer that finds its number taken reads the newer document and applies
    its change again, so changes of several writers add up.  Renaming without
    overwriting decides between processes (on a file system where that is
    atomic, as on HDFS), a lock between threads.
    """

    spark: SparkSession
    folder: str

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return jvm, path, path.getFileSystem(conf), conf

    def _numbers(self) -> list[int]:
        _, path, files, _ = self._files()
        if not files.exists(path):
            return []
        names = (status.getPath().getName() for status in files.listStatus(path))
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    def read(self) -> dict:
        """The newest document; empty before the first change."""
        return self._read()[1]

    def _read(self) -> tuple[int, dict]:
        jvm, path, files, _ = self._files()
        numbers = self._numbers()
        if not numbers:
            return -1, {}
        stream = files.open(jvm.org.apache.hadoop.fs.Path(path, f"{numbers[-1]:012d}.json"))
        try:
            return numbers[-1], json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def update(self, change: Callable[[dict], dict]) -> dict:
        """Replace the document by ``change`` of it.  ``change`` may be called again."""
        with _locks[self.folder]:
            while True:
                number, old = self._read()
                new = change(old)
                if self._put(number + 1, new):
                    self._forget(number + 1 - KEPT)
                    return new

    def _put(self, number: int, document: dict) -> bool:
        jvm, path, files, conf = self._files()
        make = jvm.org.apache.hadoop.fs.Path
        staged = make(path, f".{uuid.uuid4().hex}.tmp")
        stream = files.create(staged, True)
        try:
            stream.write(bytearray(json.dumps(document, sort_keys=True).encode()))
        finally:
            stream.close()
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
        try:
            context.rename(staged, make(path, f"{number:012d}.json"), options)
        except Py4JJavaError as error:
            files.delete(staged, False)
            if "FileAlreadyExistsException" in str(error.java_exception.getClass()):
                return False
            raise
        return True

    def _forget(self, number: int) -> None:
        jvm, path, files, _ = self._files()
        if number >= 0:
            files.delete(jvm.org.apache.hadoop.fs.Path(path, f"{number:012d}.json"), False)


@dataclass(frozen=True)
class DayFolder:
    """Tables by day and name under a path; all tables of one ``publish`` appear together.

    What a rerun replaces stays on disk until ``vacuum``, because readers may
    still be at it.
    """

    spark: SparkSession
    location: str

    def _log(self, day: Day) -> CommitLog:
        return CommitLog(self.spark, f"{self.location}/_commits/{partition_value(day)}")

    def stage(self) -> str:
        """A new folder for data, relative to ``location``."""
        return f"data/run={uuid.uuid4().hex}"

    def publish(self, day: Day, tables: Mapping[str, DataFrame]) -> None:
        """Write all tables, then make them the day's content of their names."""
        run = self.stage()
        for name, rows in tables.items():
            rows.write.parquet(f"{self.location}/{run}/{name}")
        self.commit(day, {name: f"{run}/{name}" for name in tables})

    def commit(self, day: Day, folders: Mapping[str, str | list[str] | None]) -> None:
        """Point names of a day to written folders, or to several; None stands for a table without rows."""
        self._log(day).update(lambda old: {**old, **folders})

    def names(self, day: Day) -> dict:
        """Folders by name; one small file is read."""
        return self._log(day).read()

    def has(self, day: Day, name: str) -> bool:
        return name in self.names(day)

    def read(self, day: Day, name: str, schema=None) -> DataFrame:
        folder = self.names(day)[name]
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(f"{self.location}/{folder}")

    def days(self) -> list[str]:
        """All days that have been published, as ``yyyyMMdd``."""
        _, path, files, _ = CommitLog(self.spark, f"{self.location}/_commits")._files()
        if not files.exists(path):
            return []
        return sorted(status.getPath().getName() for status in files.listStatus(path))

    def previous(self, day: Day, name: str, bootstrap: bool = False) -> bool:
        """Whether a state can go on from ``day``.  A missing day is an error unless a start is meant."""
        if self.has(day, name):
            return True
        if bootstrap:
            return False
        raise LookupError(f"{self.location} has no {name} of {partition_value(day)}; run that day first")

    def vacuum(self) -> int:
        """Delete the data folders that no day points to; returns their number.  No writer may be at work."""
        _, path, files, _ = CommitLog(self.spark, f"{self.location}/data")._files()
        live = set()
        for day in self.days():
            for folders in self.names(day).values():
                live.update(f.split("/")[1] for f in ([folders] if isinstance(folders, str) else folders or []))
        if not files.exists(path):
            return 0
        dead = [s.getPath() for s in files.listStatus(path) if s.getPath().getName() not in live]
        for folder in dead:
            files.delete(folder, True)
        return len(dead)
