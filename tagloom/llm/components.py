"""Connected components of a link table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tables import forget, materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) of every id in ``links``; component_id is the smallest id reachable.

    Each round attaches the larger neighbours of every id to its smallest
    neighbour, then the smaller ones; it ends when the links stay the same,
    after about log2(longest path) rounds.  Links with a null end are
    ignored; loops keep their id.  No links give an empty table.  Tables of
    earlier rounds are deleted.
    """
    pairs = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    loops = pairs.where("u = v").select("u", "v")
    stars = materialize(pairs.where("u <> v"), "links")
    before = None
    while True:
        now = tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                              F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first())
        if now == before or now[0] == 0:
            break
        before, old = now, stars
        stars = materialize(_small_star(_large_star(old)), "links")
        forget(old)
    roots = stars.select(F.col("v").alias("u"), "v")
    return stars.unionByName(roots).unionByName(loops).groupBy(F.col("u").alias("id")).agg(
        F.min("v").alias("component_id"))


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
