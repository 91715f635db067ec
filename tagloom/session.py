"""Session construction and shared scratch space."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Applied by build_session; a session handed in by a caller is left as it is.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}
# For long-running streams: window state off the heap, uploaded as changelogs.
STREAMING = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, master: str | None = None,
                  **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def with_settings(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of its own with some settings changed and the caller's others; the caller's session stays as it is."""
    session = spark.newSession()
    for key in (*DEFAULTS, "spark.sql.shuffle.partitions"):
        value = spark.conf.get(key, None)
        if value is not None:
            session.conf.set(key, value)
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path for checkpoints and intermediate tables that every executor sees.

    It lies under ``spark.checkpoint.dir``, or else in the temporary folder
    of the default file system, and is deleted when the session's JVM ends.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        home = jvm.org.apache.hadoop.fs.FileSystem.get(conf)
        base = home.makeQualified(jvm.org.apache.hadoop.fs.Path(conf.get("hadoop.tmp.dir"))).toString()
    folder = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/tagloom/{name}-{uuid.uuid4().hex}")
    files = folder.getFileSystem(conf)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{folder.toString()}/data"


def stored(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` written to a new path and read from there, for what is read more than once."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists in the file system of ``path``."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return location.getFileSystem(conf).exists(location)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder of its file system."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(location) and files.getFileStatus(location).isDirectory()


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern of their file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it exists."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)
