"""Blocking and allowing URLs by rules and by a path-template tree.

A url's path becomes a list of segments.  Segments that are numbers,
hexadecimal or mixed identifiers are generalised at once; a host's tree is
then built level by level over the distinct (host, path shape) rows with
their counts, not over the pages.  At each node, a segment keeps a branch of
its own only if its labelled share of blocked pages differs significantly
from that of its siblings; all others merge into one wildcard branch.  Below
a node whose labelled pages are all of one kind nothing can differ, so the
rest of its paths is generalised at once: the tree is as deep as the labels'
differences, the templates as long as the paths.

Labels are the rules' own decisions.  A template's blocked share is
smoothed towards the same template on all hosts, and that one towards the
share of all labelled pages; templates at or over the limit are rejected.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tables import lower_ascii, materialize


@dataclass(frozen=True)
class Rule:
    """A host with a path prefix, and what to do with its pages."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
#: Segments that are general by their characters.
TYPED = "^<"
#: Standard errors by which a segment's share must differ from its siblings' to keep its branch.
DIFFERS = 2.0
#: Labelled pages that a wider template's share counts as.
PRIOR = 5.0
LIMIT = 0.5


def _host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return lower_ascii(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def _matched(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null."""
    fitting = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        fitting = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(
            fitting)
    return fitting


def _shape(path: Column) -> Column:
    """The path's segments, variable ones generalised by their characters."""
    segments = F.split(F.regexp_replace(path, "^/", ""), "/", -1)

    def general(s: Column) -> Column:
        stem = F.regexp_replace(s, r"\.[A-Za-z]{1,5}$", "")
        suffix = F.substring(F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1), 1, 6)
        kind = (F.when(stem.rlike(r"^[0-9]+$"), F.lit("<n>"))
                .when(stem.rlike(r"^[0-9A-Fa-f-]{8,}$") & stem.rlike("[0-9]"), F.lit("<hex>"))
                .when(stem.rlike(r"[0-9]"), F.lit("<id>")).otherwise(stem))
        return F.concat(kind, suffix)

    return F.transform(segments, general)


def templates(pages: DataFrame) -> DataFrame:
    """(host, shape, template, blocked_share, labelled) for rows (host, shape, label); label 1 is blocked.

    ``template`` is the shape with merged segments as ``*``.
    """
    shapes = materialize(pages.groupBy("host", "shape").agg(
        F.count("label").alias("labelled"), F.sum(F.coalesce("label", F.lit(0))).alias("blocked")), "shapes")
    done, tree, level = [], shapes.withColumn("template", F.lit("").cast("string")), 0
    while True:
        ends = _with_mixed(tree).withColumn("mixed", F.col("mixed") & (F.size("shape") > level))
        ends = materialize(ends.withColumn("template", F.when(F.col("mixed"), F.col("template")).otherwise(
            F.concat("template", _rest(level)))), "tree")
        done.append(ends.where("NOT mixed").drop("mixed"))
        tree = ends.where("mixed").drop("mixed")
        if tree.isEmpty():
            break
        tree = materialize(_with_level(tree, level), "tree")
        level += 1
    tree = functools.reduce(DataFrame.unionByName, done)
    counts = [F.sum("labelled").alias("n"), F.sum("blocked").alias("k")]
    overall = tree.agg(*counts).select(F.when(F.col("n") > 0, (F.col("k") + 0.5) / (F.col("n") + 1)).alias("p0")).first()
    p0 = overall["p0"] or 0.0  # without any labelled page nothing is rejected
    wide = tree.groupBy("template").agg(*counts).select(
        "template", ((F.col("k") + PRIOR * p0) / (F.col("n") + PRIOR)).alias("wide"))
    own = tree.groupBy("host", "template").agg(*counts)
    shares = own.join(wide, "template").select(
        "host", "template", F.col("n").alias("labelled"),
        ((F.col("k") + PRIOR * F.col("wide")) / (F.col("n") + PRIOR)).alias("blocked_share"))
    return tree.select("host", "shape", "template").join(shares, ["host", "template"])


def _with_mixed(tree: DataFrame) -> DataFrame:
    """``tree`` with ``mixed``: whether the row's node, its host and template so far, has labelled pages of both kinds."""
    nodes = tree.groupBy("host", "template").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("k")).select(
        "host", "template", ((F.col("k") > 0) & (F.col("k") < F.col("n"))).alias("mixed"))
    return tree.join(nodes, ["host", "template"])


def _rest(level: int) -> Column:
    """The segments from ``level`` on without branches of their own: typed ones as they are, others as the wildcard."""
    segments = F.slice("shape", level + 1, F.greatest(F.size("shape") - level, F.lit(0)))
    return F.array_join(F.transform(segments, lambda s: F.when(s.rlike(TYPED), F.concat(F.lit("/"), s)).otherwise(
        F.lit("/*"))), "")


def _with_level(tree: DataFrame, level: int) -> DataFrame:
    """Add one segment to every template: its own, or the wildcard."""
    segment = F.get("shape", F.lit(level))
    tree = tree.withColumn("segment", segment)
    here = tree.where("segment IS NOT NULL").groupBy("host", "template", "segment").agg(
        F.sum("labelled").alias("n"), F.sum("blocked").alias("k"))
    node = here.groupBy("host", "template").agg(F.sum("n").alias("all_n"), F.sum("k").alias("all_k"))
    rest_n, rest_k = F.col("all_n") - F.col("n"), F.col("all_k") - F.col("k")
    pooled = (F.col("all_k") + 1) / (F.col("all_n") + 2)
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n") + 1 / rest_n))
    differs = (F.col("n") > 0) & (rest_n > 0) & (
        F.abs(F.col("k") / F.col("n") - rest_k / rest_n) >= DIFFERS * error)
    kept = here.join(node, ["host", "template"]).select(
        "host", "template", "segment", F.coalesce(differs, F.lit(False)).alias("own"))
    # Typed segments and endings are general already; only literal ones merge.
    name = F.when(F.col("segment").isNull(), F.lit("")).when(
        F.coalesce("own", F.lit(False)) | F.col("segment").rlike(TYPED), F.concat(F.lit("/"), "segment")).otherwise(
        F.lit("/*"))
    return tree.join(kept, ["host", "template", "segment"], "left").withColumn(
        "template", F.concat("template", name)).drop("own", "segment")


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, blocked_share) of every row of ``pages``.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path: then up to ``?``, ``#`` or the end.  A null url, or
    one without ``://``, has both empty.  The longest rule that fits
    decides; else the template.  Where no rule fits any page, all pages are
    allowed.  Equal rows stay; other columns are not read.
    """
    host, path = _host_and_path(F.col(url_col))
    judged = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    judged = judged.withColumn("match", _matched(F.col("host"), F.col("path"), rules)).withColumn(
        "shape", _shape(F.col("path")))
    label = (F.col("match.verdict") == "block").cast("int")
    found = templates(judged.select("host", "shape", label.alias("label")))
    found = materialize(found, "templates")
    by_method = F.when(F.col("blocked_share") >= LIMIT, F.lit("block")).otherwise(F.lit("allow"))
    return judged.join(found, ["host", "shape"], "left").select(
        id_col, "host", "path", F.col("match.rule").alias("rule"),
        F.coalesce("match.verdict", by_method).alias("verdict"), "template", "blocked_share")
