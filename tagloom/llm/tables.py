"""Reading inputs, and tables written in the middle of a plan."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

import tagloom
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import delete_path, scratch_dir


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the executors' Python import this package, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(tagloom.__file__)))
    folder = tempfile.mkdtemp(prefix="tagloom-")  # the driver serves the file from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/tagloom", "zip", root, "tagloom"))
    _shipped.add(context.applicationId)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    The plan behind it is cut, and a lost executor costs no more than its
    running tasks.  The folder goes when the session ends.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table of ``materialize`` that nothing will read again."""
    delete_path(df.sparkSession, df._scratch)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one, that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bucket_of(column: Column, buckets: int) -> Column:
    """crc32 of a value as text, modulo ``buckets``; null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % buckets


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
