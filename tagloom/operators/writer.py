"""Idempotent writes into the tag table.

A write replaces whole ``(data_date, tagtype)`` partitions and nothing else,
so a day can be rerun.  Only the partitions named by the caller change, and a
partition whose new content is empty becomes empty.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..commits import DayFolder
from ..functions.days import Day, days_before, parse_day, partition_value
from ..functions.tagrows import tag_schema
from ..session import path_exists, scratch_dir

PARTITIONS = ("data_date", "tagtype")
_DYNAMIC = {"spark.sql.sources.partitionOverwriteMode": "dynamic",
            "hive.exec.dynamic.partition.mode": "nonstrict"}


@dataclass(frozen=True)
class TagTable:
    """Operations shared by the two kinds of tag table.

    ``owner`` names the owner column: ``userid`` or ``cookieid``.
    """

    spark: SparkSession
    location: str
    owner: str = "userid"

    def overwrite(self, tags: DataFrame, day: Day, tagtype: str | Sequence[str]) -> dict[str, int]:
        """Replace the day's partitions; returns the rows written to each.

        With several tag types, ``tags`` carries them in a ``tagtype`` column
        and all partitions are written by one job.  A row of any other tag
        type, or of none, fails the write, and no partition changes.
        """
        data_date = partition_value(day)
        single = isinstance(tagtype, str)
        types = [tagtype] if single else list(tagtype)
        if single:
            tags = tags.withColumn("tagtype", F.lit(tagtype))
        written = self._write(tags.withColumn("data_date", F.lit(data_date)), [(data_date, t) for t in types])
        return {t: written[data_date, t] for t in types}

    def overwrite_days(self, tags: DataFrame, first: Day, last: Day, tagtype: str) -> dict[str, int]:
        """Replace the partitions of one tag type for every day in [first, last] by one job; returns the rows written
        to each day.  ``tags`` carries the day in ``data_date``; a row of another day fails the write."""
        days = (parse_day(last) - parse_day(first)).days
        named = [partition_value(days_before(last, n)) for n in range(days, -1, -1)]
        written = self._write(tags.withColumn("tagtype", F.lit(tagtype)), [(d, tagtype) for d in named])
        return {d: written[d, tagtype] for d in named}

    def _write(self, tags: DataFrame, partitions: list[tuple[str, str]]) -> dict[tuple[str, str], int]:
        """Replace the named partitions by rows with ``data_date`` and ``tagtype``; returns the rows of each."""
        at = F.concat_ws("/", F.coalesce("data_date", F.lit("null")), F.coalesce("tagtype", F.lit("null")))
        named = at.isin(["/".join(p) for p in partitions])
        unnamed = F.raise_error(F.concat(F.lit("tag type not named for this write: "), at))
        counts = Observation(f"tags-{uuid.uuid4().hex}")
        rows = (tags.select(*(F.col(f.name).cast("string").alias(f.name) for f in tag_schema(self.owner)))
                .withColumn("tagtype", F.when(named, F.col("tagtype")).otherwise(unnamed))
                .observe(counts, *(F.count_if(at == "/".join(p)).alias("/".join(p)) for p in partitions)))
        staged = self._replace(rows)
        written = {p: counts.get.get("/".join(p)) or 0 for p in partitions}
        self._finish(staged, written)
        return written

    def _finish(self, staged: str | None, written: dict[tuple[str, str], int]) -> None:
        # Dynamic overwrite touches no partition that receives no row.
        for (data_date, tagtype), n in written.items():
            if n == 0:
                self._clear(data_date, tagtype)

    def partition(self, day: Day, tagtype: str) -> DataFrame:
        """Rows of one partition."""
        return self.read().filter((F.col("data_date") == partition_value(day))
                                  & (F.col("tagtype") == tagtype))

    def previous_state(self, day: Day, tagtype: str, bootstrap: bool = False) -> DataFrame | None:
        """The partition a day's state is built on.

        A missing partition is an error, because the state would silently
        start over; ``bootstrap`` says that starting over is meant.
        """
        if self.exists(day, tagtype):
            return self.partition(day, tagtype)
        if bootstrap:
            return None
        raise LookupError(f"{self.location} has no partition "
                          f"{partition_value(day)}/{tagtype}; run that day first")


class PathTagTable(TagTable):
    """A tag table stored as partitioned parquet under a path."""

    def read(self) -> DataFrame:
        return self.spark.read.schema(tag_schema(self.owner)).parquet(self.location)

    def _folder(self, data_date: str, tagtype: str) -> str:
        return f"{self.location}/data_date={data_date}/tagtype={tagtype}"

    def exists(self, day: Day, tagtype: str) -> bool:
        return path_exists(self.spark, self._folder(partition_value(day), tagtype))

    def partition(self, day: Day, tagtype: str) -> DataFrame:
        # Only this folder is listed, however many days the table holds.
        if not self.exists(day, tagtype):
            return self.spark.createDataFrame([], tag_schema(self.owner))
        return (self.spark.read.schema(tag_schema(self.owner))
                .option("basePath", self.location)
                .parquet(self._folder(partition_value(day), tagtype)))

    def _replace(self, rows: DataFrame) -> None:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*PARTITIONS).parquet(self.location))

    def _clear(self, data_date: str, tagtype: str) -> None:
        columns = [f for f in tag_schema(self.owner).fields if f.name not in PARTITIONS]
        empty = self.spark.createDataFrame([], type(tag_schema())(columns))
        empty.write.mode("overwrite").parquet(self._folder(data_date, tagtype))


class PublishedTagTable(TagTable):
    """A tag table under a path whose partitions appear by one commit for each day.

    Rows are written to a folder of their own.  One small file then names the
    folders of all the day's partitions, so a reader sees all partitions of a
    write or none, an interrupted write leaves the old day, and writers of
    other tag types of the same day keep each other's partitions.
    """

    @property
    def days(self) -> DayFolder:
        return DayFolder(self.spark, self.location)

    def _read(self, folders: Sequence[str]) -> DataFrame:
        schema = tag_schema(self.owner)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema.add("run", "string")).option("basePath", f"{self.location}/data")
                .parquet(*(f"{self.location}/{folder}" for folder in folders)).drop("run"))

    def read(self) -> DataFrame:
        return self._read([f for day in self.days.days() for f in self.days.names(day).values() if f])

    def exists(self, day: Day, tagtype: str) -> bool:
        return self.days.has(day, tagtype)

    def partition(self, day: Day, tagtype: str) -> DataFrame:
        # One commit is read and one folder listed, however many days the table holds.
        folder = self.days.names(day).get(tagtype)
        return self._read([folder] if folder else [])

    def _replace(self, rows: DataFrame) -> str:
        staged = self.days.stage()
        rows.write.partitionBy(*PARTITIONS).parquet(f"{self.location}/{staged}")
        return staged

    def _finish(self, staged: str | None, written: dict[tuple[str, str], int]) -> None:
        for day in sorted({data_date for data_date, _ in written}):
            self.days.commit(day, {t: f"{staged}/data_date={d}/tagtype={t}" if n else None
                                   for (d, t), n in written.items() if d == day})


class CatalogTagTable(TagTable):
    """A tag table registered in the catalog.

    Rows are written to scratch space first and inserted from there by a
    session of their own, because catalog tables take the overwrite mode from
    the session: the caller's settings stay as they are, also for other
    threads, and a failing computation touches no partition.
    """

    def create(self) -> None:
        columns = ", ".join(f"{f.name} STRING" for f in tag_schema(self.owner))
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.location} ({columns}) "
                       f"USING parquet PARTITIONED BY ({', '.join(PARTITIONS)})")

    def read(self) -> DataFrame:
        return self.spark.table(self.location)

    @staticmethod
    def _spec(data_date: str, tagtype: str) -> str:
        return f"PARTITION (data_date = '{data_date}', tagtype = '{tagtype}')"

    def exists(self, day: Day, tagtype: str) -> bool:
        spec = self._spec(partition_value(day), tagtype)
        return not self.spark.sql(f"SHOW PARTITIONS {self.location} {spec}").isEmpty()

    def _replace(self, rows: DataFrame) -> None:
        staged = scratch_dir(self.spark, "tags")
        rows.write.parquet(staged)
        database = self.spark.catalog.currentDatabase()
        session = self.spark.newSession()
        for key, value in _DYNAMIC.items():
            session.conf.set(key, value)
        session.catalog.setCurrentDatabase(database)
        # insertInto takes columns by position.
        (session.read.schema(rows.schema).parquet(staged).select(*session.table(self.location).columns)
         .write.insertInto(self.location, overwrite=True))
        # The caller's session may remember the files of the table.
        self.spark.catalog.refreshTable(self.location)

    def _clear(self, data_date: str, tagtype: str) -> None:
        spec = self._spec(data_date, tagtype)
        blanks = ", ".join(["''"] * (len(tag_schema()) - len(PARTITIONS)))
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.location} {spec} SELECT {blanks} WHERE false")
        self.spark.sql(f"ALTER TABLE {self.location} ADD IF NOT EXISTS {spec}")
