"""Kafka message streams.

``kafka_options`` is separate from the reader because the connector is a
package the cluster supplies.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

StartOffset = tuple[str, int, int]
MESSAGE_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")


def topic_list(topics: str) -> list[str]:
    """Topics of a comma-separated setting."""
    return [topic.strip() for topic in topics.split(",") if topic.strip()]


def kafka_options(servers: str, topics: Sequence[str], start: Iterable[StartOffset] = (),
                  group_id: str | None = None, min_partitions: int | None = None,
                  max_offsets: int | None = None) -> dict[str, str]:
    """Source options for a topic subscription or for explicit offsets.

    With ``start`` only the listed partitions are read, each from its offset.
    Without it every partition of the topics is read from its latest offset.
    An offset of -2 stands for the earliest one.
    """
    options = {"kafka.bootstrap.servers": servers, "failOnDataLoss": "true"}
    by_topic: dict[str, dict[str, int]] = {}
    for topic, partition, offset in start:
        by_topic.setdefault(topic, {})[str(partition)] = offset
    if by_topic:
        options["assign"] = json.dumps({t: [int(p) for p in ps] for t, ps in by_topic.items()})
        options["startingOffsets"] = json.dumps(by_topic)
    else:
        options["subscribe"] = ",".join(topics)
        options["startingOffsets"] = "latest"
    if group_id:
        options["kafka.group.id"] = group_id
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Messages as (key, value) text with their topic, partition, offset, time."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"),
                      *MESSAGE_COLUMNS[2:])


def after_ledger(messages: DataFrame, ledger: DataFrame) -> DataFrame:
    """Recorded messages, batch or stream, that a ledger (topic, partitionname,
    untilOffset) has not seen; partitions absent from it from their start."""
    seen = ledger.select(F.col("topic"), F.col("partitionname").alias("partition"),
                         F.col("untilOffset").alias("_until"))
    return (messages.join(seen, ["topic", "partition"], "left")
            .where(F.col("_until").isNull() | (F.col("offset") >= F.col("_until")))
            .select(messages.columns))


def union_streams(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Several inputs as one stream."""
    for other in others:
        first = first.unionByName(other)
    return first
