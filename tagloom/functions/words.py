"""Word splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_words(text: Column) -> Column:
    """Split on single blanks; trailing empty words are dropped.

    An empty text is one empty word, an all-blank text has no word, and empty
    words at the start or in the middle count.
    """
    trimmed = F.rtrim(text)
    return (F.when(text == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ")))


def explode_words(df: DataFrame, text: str = "value", *keep: str) -> DataFrame:
    return df.select(*keep, F.explode(split_words(F.col(text))).alias("word"))


def count_words(df: DataFrame, text: str = "value") -> DataFrame:
    return explode_words(df, text).groupBy("word").agg(F.count("*").alias("n"))
