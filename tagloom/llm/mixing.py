"""Mixing sources to target weights by entropy balancing.

Of all document rates between 0 and ``cap`` that give every source its
target of words, the ones of largest entropy relative to one copy each are
``min(cap, exp(lambda * size))`` with one multiplier for each source.  The
multipliers solve a convex dual; its slope and curvature are sums over the
documents, so every Newton step is one aggregate.  Rates depend on source
and size alone, hence the sums run over counts of documents by source and
size.  Rates become whole copies from the longest documents to the shortest,
each size taking over what the longer ones have left.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.tables import forget, materialize

WORD = r"[^\x20\x09-\x0D]+"
#: A source is solved when its words are this near to the target, as a share of it; rounding takes the rest.
NEAR = 1e-9
#: Every step halves an interval at least, so doubles are exhausted before this.
MAX_STEPS = 200
#: Documents of one source and size are dealt into buckets of about so many of all documents' ranks.
BUCKET_ROWS, MAX_BUCKETS = 1_000, 100_000

def _src() -> Column:
    """Stands for the source in keys: "" for null, else "s" and the source."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit(""))


def _in_order(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``: 0, 1, ... by code point of the source, null last.

    Ranges are numbered by their own tasks; only the number of rows of every range meets in one.
    """
    order = (F.col("src") == "").asc(), F.col("src").asc()
    placed = materialize(sources.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("at", F.monotonically_increasing_id()), "mix-order")
    placed = placed.withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))
    sizes = placed.groupBy("part").agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(sizes.select("part", before.alias("before")), "part").select(
        *sources.columns, (F.col("before") + F.col("at")).alias("place"))


def source_targets(sources: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(src, source_size) with ``target``: shares of all words by weight, none above ``cap`` times the source's size.

    What a source cannot take is shared again by weight among the others.
    """
    place = (F.col("place") % len(weights) + 1).cast("int")
    weighted = materialize(_in_order(sources).withColumn(
        "weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), place)).drop("place"), "mix-weights")
    most = F.col("source_size") * cap
    words, free = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.sum("weight")).first()
    capped, level = 0, words / free if free else 0.0
    while True:
        above = F.col("weight") * F.lit(level) > most
        n, taken, free = weighted.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, most)), F.lit(0)),
                                      F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))).first()
        if n == capped or not free:
            break
        capped, level = n, (words - taken) / free
    return weighted.select("src", "source_size", F.when(above, most.cast("double")).otherwise(
        F.col("weight") * F.lit(level)).alias("target"))


def _rate(cap: int) -> Column:
    """Copies that a document of ``size`` should have; an empty one keeps one."""
    tilted = F.least(F.lit(float(cap)), F.exp(F.col("lam") * F.col("size") / F.col("unit")))
    return F.when(F.col("size") == 0, 1.0).when(F.col("full"), float(cap)).otherwise(tilted)


def solve_multipliers(sizes: DataFrame, targets: DataFrame, cap: int = 3) -> DataFrame:
    """``targets`` with the multiplier ``lam`` (of size / ``unit``) of every source and ``gap``, the words it misses.

    ``sizes`` is (src, size, n).  Newton steps on the dual, kept inside the interval that is known to hold the
    solution; where a step leaves it, the interval is halved or, while open to one side, doubled.
    """
    words = F.col("n") * F.col("size")
    unit = sizes.groupBy("src").agg(F.try_divide(F.sum(words * F.col("size").cast("double")), F.sum(words)).alias("unit"))
    nothing = F.lit(None).cast("double")
    state = materialize(targets.join(unit, "src").select(
        "src", "source_size", "target", F.coalesce("unit", F.lit(1.0)).alias("unit"),
        (F.col("target") >= F.col("source_size") * cap).alias("full"), F.lit(0.0).alias("lam"),
        nothing.alias("low"), nothing.alias("high"), F.lit(0.0).alias("gap"), F.lit(False).alias("done")), "mix-dual")
    lam, low, high, gap = (F.col(c) for c in ("lam", "low", "high", "gap"))
    for _ in range(MAX_STEPS):
        share = F.col("n") * F.col("size") * _rate(cap)
        slopes = sizes.join(state, "src").groupBy("src").agg(
            F.sum(share).alias("mixed"),
            F.sum(F.when(_rate(cap) < cap, share * F.col("size") / F.col("unit"))).alias("curve"))
        tried = (state.drop("gap", "done").join(slopes, "src")
                 .withColumn("gap", F.col("target") - F.col("mixed"))
                 .withColumn("done", F.col("full") | (F.abs("gap") <= F.col("target") * NEAR))
                 .withColumn("low", F.when(gap > 0, lam).otherwise(low))
                 .withColumn("high", F.when(gap < 0, lam).otherwise(high)))
        newton = F.try_divide(gap, F.col("curve")) + lam
        inside = (F.coalesce(newton > low, newton.isNotNull()) & F.coalesce(newton < high, newton.isNotNull()))
        width = 2 * F.greatest(F.abs(lam), F.lit(1.0))
        halved = F.when(low.isNull(), lam - width).when(high.isNull(), lam + width).otherwise((low + high) / 2)
        old = state
        state = materialize(tried.withColumn("lam", F.when(F.col("done"), lam).when(inside, newton).otherwise(halved))
                            .select(state.columns), "mix-dual")
        forget(old)
        if state.where("NOT done").isEmpty():
            break
    return state


def _nearest(x: float) -> int:
    """Halves go down, also those that sums in another order have moved a little."""
    return math.floor(x + 0.5 - 1e-6)


def _whole_copies(cap: int):
    """Copies of all documents of each size of a source, so that the source's words meet its target."""
    def spread(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ascending=False, ignore_index=True)
        size, n, want = (rows[c].tolist() for c in ("size", "n", "want"))
        copies, carry = [0] * len(size), float(rows["gap"].iloc[0]) if len(rows) else 0.0
        for i, z in enumerate(size):
            if z == 0:
                copies[i] = n[i]
                continue
            carry += want[i] * z
            copies[i] = min(max(_nearest(carry / z), 0), cap * n[i])
            carry -= copies[i] * z
        # What the shorter documents had no room for goes to a longer one, and the overshoot back to the shorter ones.
        for upward in (True, False):
            for i, z in enumerate(size):
                if z and abs(carry) > 0.75:
                    more = carry / z
                    step = int(more > 0) if upward and abs(more) < 1 else _nearest(more)
                    step = min(max(step, -copies[i]), cap * n[i] - copies[i])
                    copies[i] += step
                    carry -= step * z
                    if step and upward:
                        break
        return pd.DataFrame({"src": rows["src"], "size": size, "copies": copies})
    return spread


def mix_sources(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) of every row of ``docs`` (doc_id, source, text).

    Sources by code point, null last, weigh ``weights`` in turn.  ``taken`` is size times copies; no row gets more
    than ``cap`` copies.  Null and empty texts have size 0 and one copy; null ids and repeated rows are documents like
    others; ties between equal sizes go by a hash of doc_id, so reruns agree.  An empty table gives no rows.  Other
    columns of ``docs`` are not read.
    """
    sized = materialize(docs.select(
        "doc_id", _src().alias("src"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64("doc_id", F.lit("mix")).alias("hash")), "mix-sizes")
    sizes = materialize(sized.groupBy("src", "size").agg(F.count("*").alias("n")), "mix-histogram")
    sources = sizes.groupBy("src").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    solved = solve_multipliers(sizes, source_targets(sources, weights, cap), cap)
    rated = sizes.join(solved, "src").withColumn("rate", _rate(cap))
    # At most one row for each size of a source's documents.
    copies = (rated.select("src", "size", "n", (F.col("rate") * F.col("n")).alias("want"), "gap")
              .groupBy("src").applyInPandas(_whole_copies(cap), "src string, size long, copies long"))
    plan = rated.select("src", "size", "n", "rate", "source_size", "target").join(copies, ["src", "size"])

    rows = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = min(max(rows // BUCKET_ROWS, 1), MAX_BUCKETS)
    sized = sized.withColumn("bucket", F.pmod("hash", F.lit(buckets)))
    # A bucket's share of the copies beyond an equal number for all, by running totals: exact in sum.
    so_far = F.sum("rows").over(Window.partitionBy("src", "size").orderBy("bucket")).cast("decimal(19,0)")
    dealt = (sized.groupBy("src", "size", "bucket").agg(F.count("*").alias("rows")).join(plan, ["src", "size"])
             .withColumn("so_far", so_far)
             .withColumn("extra", F.expr("so_far * cast(copies % n AS decimal(19,0)) div n "
                                         "- (so_far - rows) * cast(copies % n AS decimal(19,0)) div n"))
             .select("src", "size", "bucket", "extra", F.expr("copies div n").alias("each"), "rate", "source_size",
                     "target"))
    rank = F.row_number().over(Window.partitionBy("src", "size", "bucket").orderBy("hash", "doc_id"))
    whole = F.col("each") + F.when(rank <= F.col("extra"), 1).otherwise(0)
    return (sized.join(dealt, ["src", "size", "bucket"]).withColumn("copies", whole)
            .select("doc_id", F.when(F.col("src") != "", F.expr("substr(src, 2)")).alias("source"), "size",
                    "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")))
