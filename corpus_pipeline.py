"""A corpus pipeline: quality, repeated lines, near-duplicates, benchmark items, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but
the last return the columns of ``docs``; documents keep their columns, and
n_chars follows the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import bpe, contamination, lines, minhash, quality
from tagloom.llm.queries import TOKENIZER
from tagloom.llm.tables import materialize, read, ship_package, unused

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the co-trained classifier rejects.

    A null text counts as empty; unknown source, language or length speaks
    for nothing.  Rows that share an id are judged each by its own text, a row
    without an id like any other.  Equal scores at the limit stay.  Without
    labels of both kinds nothing goes.
    """
    ship_package(spark)
    scored = quality.score_quality(docs, read(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that stand in ten documents or more; a document stays even if all its lines go.

    Lines in fewer than ten different texts, repeated only because texts are copied, stay in the smallest id.
    A null text becomes empty, an empty one stays; blank lines never count.  Rows that share an id, or have none,
    count as one document.
    """
    ship_package(spark)
    kept = lines.drop_repeated_lines(docs, min_docs=10, keep_copied=True)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(kind)).otherwise(
            F.col("n_chars")))
    return kept.select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every group of near-duplicates, by five-word shingles at 0.8.

    Documents without words are near to nothing and stay, so do rows without an id.  Rows that share an id are one
    document: they go or stay together.
    """
    ship_package(spark)
    name = unused(docs, "gone")
    gone = minhash.near_duplicates(docs, k=5, percent=80).where("NOT kept").select(
        F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(name), "left_anti")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold an item of the benchmark, 80 percent of its five-word shingles at least.

    Items and documents without words match nothing.  Rows that share an id go together; rows without an id stay.
    """
    ship_package(spark)
    return contamination.without_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row; a null text is empty, ids may be null or repeat."""
    ship_package(spark)
    return bpe.round_trip(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("minhash_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("bpe", tokens),
]

#: SQL cannot express the classifier and the tokenizer; the tests hold the operators of the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; each stage's result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
