"""A Merkle manifest of a dataset, built by a butterfly exchange.

Rows of every source, in order of doc_id, are cut into aligned blocks of
``FANOUT ** levels`` leaves; a block folds its own leaves.  Then aligned groups
of blocks swap the roots of their subtrees round by round: in round r a block
sends its subtree's root to the blocks with the same place in the other
subtrees of its group, and every block of the group hashes the common parent
for itself.  After the last round each block holds all siblings above it, so
nothing is passed down the tree.  Sources are joined by further rounds of the
same exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.tables import materialize

FANOUT = 3
#: Blocks have 3 ** 5 to 3 ** 9 leaves: about 4,096 blocks up to 80 million rows, larger blocks do not grow further.
LEAST_LEVELS, MOST_LEVELS, BLOCKS = 5, 9, 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# Siblings of one level, left and right of the node, as one text each.
_STEP = "struct<left: string, right: string>"
_KEPT = (f"struct<steps: array<{_STEP}>, subroot: string, first: bigint, blocks: bigint, number: bigint, "
         "idle: boolean>")


def _field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(**changed: Column) -> Column:
    """The digest of a row; ``changed`` replaces columns."""
    return F.sha2(F.concat(*(_field(changed.get(name, F.col(name))) for name in FIELDS)), 256)


def _numbered(rows: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """``rows``, written, with ``place`` 0, 1, ... by ``order`` within the columns ``group``, which ``order`` starts with.

    Ranges of rows are numbered by their own tasks, so no group meets in one; only the number of rows for each range
    and group do.
    """
    ranged = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("at", F.monotonically_increasing_id()), name)
    ranged = ranged.withColumn("part", F.shiftright("at", 33))
    parts = ranged.groupBy(*group, "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("rows").over(Window.partitionBy(*group).orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(*(F.col(c).alias(f"{c}_") for c in group), F.col("part").alias("part_"), "first",
                         before.alias("before"))
    same = F.col("part") == F.col("part_")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"{c}_"))
    return ranged.join(parts, same).select(*rows.columns, (F.col("before") + F.col("at") - F.col("first")).alias("place"))


def _running(rows: DataFrame, at: str, count: str, name: str) -> DataFrame:
    """``rows`` with ``name``: the sum of ``count`` over all rows of a lower ``at`` (0, 1, ...), in two levels."""
    rows = rows.withColumn("chunk", F.floor(F.col(at) / 10_000))

    def before(window) -> Column:
        return F.coalesce(F.sum(count).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    chunks = rows.groupBy("chunk").agg(F.sum(count).alias(count)).select(
        "chunk", before(Window.orderBy("chunk")).alias("base"))
    inner = before(Window.partitionBy("chunk").orderBy(at))
    return rows.withColumn("inner", inner).join(chunks, "chunk").withColumn(
        name, F.col("base") + F.col("inner")).drop("chunk", "inner", "base")


def _parents(nodes: list[str]) -> list[str]:
    return [hashlib.sha256("".join(nodes[i:i + FANOUT]).encode()).hexdigest() for i in range(0, len(nodes), FANOUT)]


def _tree(leaves: list[str], levels: int) -> list[list[str]]:
    """Nodes of a block, ``levels`` times folded."""
    tree = [leaves]
    for _ in range(levels):
        tree.append(_parents(tree[-1]))
    return tree


def _block_root(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("place")
    top = _tree(rows["leaf"].tolist(), int(rows["levels"].iloc[0]))[-1]
    return rows.iloc[:1][["block", "first", "blocks", "number"]].assign(hash=top)[
        ["block", "hash", "first", "blocks", "number"]]


def _proofs(leaves: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Proofs of a block's leaves: siblings in the block, then those from the exchange."""
    leaves = leaves.sort_values("place", ignore_index=True)
    upper, subroot, root = above["steps"].iloc[0], above["subroot"].iloc[0], above["hash"].iloc[0]
    tree = _tree(leaves["leaf"].tolist(), int(leaves["levels"].iloc[0]))
    upper = [(s["left"], s["right"]) for s in upper]
    digests, folded = [], []
    for i, node in enumerate(leaves["changed"]):
        steps, at = [], i
        for nodes in tree[:-1]:
            run = at // FANOUT * FANOUT
            steps.append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + FANOUT])))
            at //= FANOUT
        steps += upper
        digests.append(hashlib.sha256("".join(left + right for left, right in steps).encode()).hexdigest())
        for left, right in steps:
            node = hashlib.sha256((left + node + right).encode()).hexdigest()
        folded.append(node)
    return pd.DataFrame({"doc_id": leaves["doc_id"], "source": leaves["source"], "leaf": leaves["leaf"],
                         "subroot": subroot, "root": root, "proof_sha256": digests, "folded_root": folded,
                         "verified": [node == root for node in folded]})


def _exchange(state: DataFrame) -> DataFrame:
    """One round.  ``state`` has (block, hash, steps, subroot, first, blocks, number) and ``family``, an array of
    (start, stop) block ranges: the subtrees with a common parent, empty where a block sits the round out.

    A subtree with fewer blocks than another serves the other's blocks in turn, so every block hears once from each
    subtree of its family.
    """
    own = F.get(F.filter("family", lambda f: (f["start"] <= F.col("block")) & (F.col("block") < f["stop"])), F.lit(0))
    state = state.withColumn("own", own)
    place = F.aggregate("family", F.lit(0), lambda n, f: n + F.when(f["start"] < F.col("own.start"), 1).otherwise(0))

    def served(other: Column) -> Column:
        first = other["start"] + F.col("block") - F.col("own.start")
        return F.when((other["start"] != F.col("own.start")) & (first < other["stop"]), F.sequence(
            first, other["stop"] - 1, F.col("own.stop") - F.col("own.start"))).otherwise(F.array().cast("array<long>"))

    said = F.struct(place.alias("place"), F.col("hash"))
    nothing = F.lit(None).cast(_KEPT)
    sent = F.transform(F.flatten(F.transform("family", served)), lambda to: F.struct(
        to.alias("to"), F.col("said"), nothing.alias("kept")))
    kept = F.struct("steps", "subroot", "first", "blocks", "number", (F.size("family") == 0).alias("idle")).cast(_KEPT)
    heard = (state.withColumn("said", said)
             .select(F.explode(F.concat(F.array(F.struct(F.col("block").alias("to"), F.col("said"), kept.alias("kept"))),
                                        sent)).alias("m")).select("m.*")
             .groupBy("to").agg(F.array_sort(F.collect_list(F.struct(
                 F.col("said.place").alias("place"), F.col("said.hash").alias("hash"),
                 F.col("kept").isNotNull().alias("mine")))).alias("said"), F.max("kept").alias("kept")))
    mine = F.get(F.filter("said", lambda s: s["mine"]), F.lit(0))

    def joined(side) -> Column:
        return F.array_join(F.transform(F.filter("said", side), lambda s: s["hash"]), "")

    heard = heard.withColumn("mine", mine)
    step = F.struct(joined(lambda s: s["place"] < F.col("mine.place")).alias("left"),
                    joined(lambda s: s["place"] > F.col("mine.place")).alias("right"))
    parent = F.sha2(joined(lambda s: s["place"].isNotNull()), 256)
    return heard.select(
        F.col("to").alias("block"), F.when(F.col("kept.idle"), F.col("mine.hash")).otherwise(parent).alias("hash"),
        F.when(F.col("kept.idle"), F.col("kept.steps")).otherwise(F.concat("kept.steps", F.array(step))).alias("steps"),
        *(F.col(f"kept.{c}").alias(c) for c in ("subroot", "first", "blocks", "number")))


def _ranges(first: Column, count: Column, at: Column, span: int) -> Column:
    """Ranges of the subtrees of ``span`` blocks around place ``at`` of ``count`` blocks from ``first``."""
    start = F.floor(at / (span * FANOUT)) * (span * FANOUT)
    every = F.transform(F.sequence(F.lit(0), F.lit(FANOUT - 1)), lambda i: F.struct(
        (first + start + i * span).alias("start"), (first + F.least(start + (i + 1) * span, count)).alias("stop")))
    family = F.filter(every, lambda f: f["start"] < f["stop"])
    return F.when(count > span, family).otherwise(F.array().cast("array<struct<start: bigint, stop: bigint>>"))


def _rounds(count: int) -> Iterator[int]:
    span = 1
    while span < count:
        yield span
        span *= FANOUT


def merkle_manifest(docs: DataFrame, changed_text: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``.

    Leaves hash doc_id, source, lang, n_chars and text.  ``changed_text`` is an expression over ``docs``: the text of
    the leaf that is folded to ``folded_root`` along the siblings of the unchanged tree.  Nulls in any column are
    hashed as ``-``; a null source is a source of its own, before the others; null ids come first within a source, and
    rows of one id are ordered by their leaf, so repeated rows have a defined place.  A lone leaf is its own root.  An
    empty table gives no rows.  Other columns of ``docs`` are not read.
    """
    leaf = leaf_digest()
    changed = leaf if changed_text is None else leaf_digest(text=changed_text)
    # Ids are carried as text: pandas would round large ones beside a null.
    rows = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), leaf.alias("leaf"),
                       changed.alias("changed"))
    order = [F.col(c).asc_nulls_first() for c in ("source", "doc_id", "leaf")]
    placed = materialize(_numbered(materialize(rows, "manifest-leaves"), ["source"], order, "manifest-order"),
                         "manifest-placed")
    sources = _numbered(placed.groupBy("source").agg(F.count("*").alias("leaves")), [], order[:1], "manifest-sources")
    total = placed.count()
    levels = LEAST_LEVELS
    while levels < MOST_LEVELS and FANOUT ** levels * BLOCKS < total:
        levels += 1
    size = FANOUT ** levels
    # A source folds within its blocks as long as it has more than one node.
    depth = sum(F.when(F.col("leaves") > FANOUT ** k, 1).otherwise(0) for k in range(levels))
    blocks = F.ceil(F.col("leaves") / size)
    sources = sources.select("source", "leaves", F.col("place").alias("number"), blocks.alias("blocks"),
                             depth.alias("levels"))
    sources = materialize(_running(sources, "number", "blocks", "first"), "manifest-counts")
    names = sources.select(F.col("source").alias("source_"), "first", "blocks", "number", "levels")
    leaves = placed.join(names, F.col("source").eqNullSafe(F.col("source_"))).withColumn(
        "block", F.col("first") + F.floor(F.col("place") / size)).withColumn("doc_id", F.col("doc_id").cast("string"))

    of_source = "first", "blocks", "number"
    roots = leaves.groupBy("block", *of_source).applyInPandas(
        _block_root, "block long, hash string, first long, blocks long, number long")
    most, number = sources.agg(F.max("blocks"), F.count("*")).first()
    state = roots.select("block", "hash", F.array().cast(f"array<{_STEP}>").alias("steps"),
                         F.lit(None).cast("string").alias("subroot"), *of_source)
    for span in _rounds(most or 0):
        state = _exchange(state.withColumn("family", _ranges(
            F.col("first"), F.col("blocks"), F.col("block") - F.col("first"), span)))
    state = state.withColumn("subroot", F.col("hash"))
    for span in _rounds(number):
        ranges = sources.groupBy(F.floor(F.col("number") / span).alias("subtree")).agg(
            F.min("first").alias("start"), F.max(F.col("first") + F.col("blocks")).alias("stop"))
        families = ranges.groupBy(F.floor(F.col("subtree") / FANOUT).alias("parent")).agg(
            F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("family"))
        state = _exchange(state.withColumn("parent", F.floor(F.col("number") / (span * FANOUT)))
                          .join(families, "parent"))
    found = leaves.groupBy("block").cogroup(state.groupBy("block")).applyInPandas(
        _proofs, "doc_id string, source string, leaf string, subroot string, root string, proof_sha256 string, "
                 "folded_root string, verified boolean")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
