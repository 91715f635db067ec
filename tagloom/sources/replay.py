"""File-backed inputs: whole tables and streams that replay them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import is_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str,
                 files_per_batch: int | None = None) -> DataFrame:
    """A stream over the table ``<folder>/<name>.parquet``.

    A table that is a folder is streamed with the files added to it later; of
    a single file, files of the same name.  A missing table is an error.
    """
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
