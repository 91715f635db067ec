"""Sinks that write each micro-batch once.

A batch may be delivered again after a failure.  Both sinks key their output
by query and batch and replace what the same batch has left behind.  Batches
of other queries stay: a new checkpoint is a new query.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..commits import CommitLog
from ..session import delete_path, glob_paths
from .runner import BatchHandler, BatchKey

QUERY, BATCH = "query_id", "batch_id"


@dataclass(frozen=True)
class BatchFolder:
    """A parquet folder with one partition per query and batch, merged from time to time.

    A small document names the merged folders and, for each query, the last
    batch they hold; readers take these and the batches after it.  Merging
    writes a new folder first and then replaces the document, so no row is
    lost or read twice when it is interrupted at any point.  With ``schema``
    (without query and batch) no reader looks into files for their columns.
    """

    spark: SparkSession
    location: str
    schema: T.StructType | None = None

    @property
    def _log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.location}/_merged/log")

    def write(self, rows: DataFrame, key: BatchKey) -> None:
        if key.batch_id <= self._log.read().get("upto", {}).get(key.query_id, -1):
            # Merged already, hence complete.  What is measured along the way is still waited for.
            rows.write.format("noop").mode("overwrite").save()
            return
        rows.write.mode("overwrite").parquet(self._batch(key))

    def read(self) -> DataFrame:
        """All rows, with ``query_id`` and ``batch_id``."""
        document = self._log.read()
        batches = [self._batch(key) for key in self._batches() if key.batch_id > document.get("upto", {}).get(
            key.query_id, -1)]
        return self._rows(batches, [f"{self.location}/{run}" for run in document.get("runs", [])])

    def read_batch(self, key: BatchKey) -> DataFrame:
        reader = self.spark.read.schema(self.schema) if self.schema else self.spark.read
        return reader.parquet(self._batch(key))

    def merge(self, keep: int = 1, runs: int = 8) -> int:
        """Merge the batches of every query but the ``keep`` newest, which may still be repeated; returns their number.

        Merged folders are merged themselves when there are more than ``runs``
        of them.  Folders that an earlier merge has replaced are deleted, those
        of this one stay for the readers that are at them.  One merge at a time.
        """
        document = self._log.read()
        upto, old, dead = (document.get(name, kind()) for name, kind in (("upto", dict), ("runs", list), ("dead", list)))
        queries: dict[str, list[int]] = {}
        for key in self._batches():
            queries.setdefault(key.query_id, []).append(key.batch_id)
        closed = [BatchKey(q, b) for q, found in queries.items()
                  for b in sorted(found)[:len(found) - keep] if b > upto.get(q, -1)]
        if not closed:
            return 0
        again = old if len(old) >= runs else []
        run = f"_merged/data/{uuid.uuid4().hex}"
        rows = self._rows([self._batch(key) for key in closed], [f"{self.location}/{r}" for r in again])
        # Files of a good size, whatever the number of batches.
        rows.hint("rebalance").write.parquet(f"{self.location}/{run}")
        ends = {**upto}
        for key in closed:
            ends[key.query_id] = max(ends.get(key.query_id, -1), key.batch_id)
        replaced = again + [f"{QUERY}={key.query_id}/{BATCH}={key.batch_id}" for key in closed]
        self._log.update(lambda _: {"upto": ends, "runs": [*(r for r in old if r not in again), run], "dead": replaced})
        for folder in dead:
            delete_path(self.spark, f"{self.location}/{folder}")
        return len(closed)

    def _rows(self, batches: Sequence[str], runs: Sequence[str]) -> DataFrame:
        schema = self.schema
        if schema is None:
            if not batches and not runs:
                return self.spark.read.parquet(self.location)  # says that there is nothing
            found = self.spark.read.parquet(batches[0] if batches else runs[0]).schema
            schema = T.StructType([f for f in found.fields if f.name not in (QUERY, BATCH)])
        whole = T.StructType([*schema.fields, T.StructField(QUERY, T.StringType()), T.StructField(BATCH, T.LongType())])
        parts = []
        if batches:
            parts.append(self.spark.read.schema(whole).option("basePath", self.location).parquet(*batches))
        if runs:
            parts.append(self.spark.read.schema(whole).parquet(*runs))
        if not parts:
            return self.spark.createDataFrame([], whole)
        return functools.reduce(DataFrame.unionByName, parts)

    def _batches(self) -> list[BatchKey]:
        """Batches whose folders are complete."""
        pattern = f"{self.location}/{QUERY}=*/{BATCH}=*/_SUCCESS"
        found = []
        for path in glob_paths(self.spark, pattern):
            query, batch = path.split("/")[-3:-1]
            found.append(BatchKey(query.split("=", 1)[1], int(batch.split("=", 1)[1])))
        return found

    def _batch(self, key: BatchKey) -> str:
        return f"{self.location}/{QUERY}={key.query_id}/{BATCH}={key.batch_id}"


def merging(handler: BatchHandler, sink: BatchFolder, every: int = 300) -> BatchHandler:
    """Merge the sink's batches after every ``every``-th one (ten minutes of two-second batches)."""

    def handle(batch: DataFrame, key: BatchKey) -> None:
        handler(batch, key)
        if key.batch_id % every == every - 1:
            sink.merge()

    return handle


def jdbc_transaction(spark: SparkSession, url: str, properties: dict[str, str],
                     statements: Sequence[str]) -> None:
    """Run statements in one database transaction.

    The driver class must be on ``spark.driver.extraClassPath``.
    """
    jvm = spark.sparkContext._jvm
    login = jvm.java.util.Properties()
    for key, value in properties.items():
        login.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, login)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.executeUpdate(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _write_jdbc(rows: DataFrame, url: str, name: str, properties: dict[str, str]) -> None:
    rows.write.jdbc(url, name, mode="append", properties=properties)


@dataclass
class JdbcTable:
    """A database table fed through a staging table.

    Executors append to the staging table, where a retried task may leave
    copies.  One transaction then moves the batch: it removes the old rows,
    inserts each identity once and empties the staging rows, so readers see
    whole batches only.  Several queries may share one table.
    """

    spark: SparkSession
    url: str
    name: str
    properties: dict[str, str] = field(default_factory=dict)
    connections: int = 8
    write: Callable[..., None] = _write_jdbc
    transact: Callable[..., None] = jdbc_transaction
    _created: bool = False

    @property
    def stage(self) -> str:
        return f"{self.name}_stage"

    def append_batch(self, rows: DataFrame, identity: Sequence[str], key: BatchKey) -> None:
        """Append ``rows`` tagged with their query and batch, whatever the batch wrote before.

        ``identity`` names the columns that tell rows apart; they stay in the
        staging table.
        """
        columns = [c for c in rows.columns if c not in identity] + [QUERY, BATCH]
        self._move(rows, columns, [f"DELETE FROM {self.name} WHERE {_same_batch(key)}"], key)

    def replace_keys(self, rows: DataFrame, keys: Sequence[str], key: BatchKey) -> None:
        """Put ``rows`` in the place of the rows with the same keys."""
        same = " AND ".join(f"s.{name} = {self.name}.{name}" for name in keys)
        delete = (f"DELETE FROM {self.name} WHERE EXISTS (SELECT 1 FROM {self.stage} s "
                  f"WHERE {_same_batch(key, 's.')} AND {same})")
        self._move(rows, list(rows.columns), [delete], key)

    def _move(self, rows: DataFrame, columns: list[str], before: list[str], key: BatchKey) -> None:
        staged = (rows.withColumn(QUERY, F.lit(key.query_id))
                  .withColumn(BATCH, F.lit(key.batch_id).cast("bigint")))
        options = {**self.properties, "numPartitions": str(self.connections)}
        if not self._created:
            # An empty append creates a missing table and keeps an existing one.
            empty = self.spark.createDataFrame([], staged.select(*columns).schema)
            self.write(empty, self.url, self.name, options)
            self._created = True
        self.write(staged, self.url, self.stage, options)
        inner = f"SELECT DISTINCT {', '.join(staged.columns)} FROM {self.stage} WHERE {_same_batch(key)}"
        names = ", ".join(columns)
        self.transact(self.spark, self.url, self.properties, [
            *before,
            f"INSERT INTO {self.name} ({names}) SELECT {names} FROM ({inner}) s",
            f"DELETE FROM {self.stage} WHERE {_same_batch(key)}"])


def _same_batch(key: BatchKey, table: str = "") -> str:
    query_id = key.query_id.replace("'", "''")
    return f"{table}{QUERY} = '{query_id}' AND {table}{BATCH} = {key.batch_id}"
