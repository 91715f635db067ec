"""The common shape of tag rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the tag tables besides the owner, all strings.
VALUE_COLUMNS = ("tagweight", "tagranking", "reserve", "reserve1")


def tag_schema(owner: str = "userid") -> T.StructType:
    names = ("tagid", owner, *VALUE_COLUMNS, "data_date", "tagtype")
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def tag_rows(df: DataFrame, tagid: Column | str, owner: Column | str,
             weight: Column | None = None, owner_name: str = "userid",
             *extra: Column) -> DataFrame:
    """``df`` as tag rows: a tag id, its owner and an optional weight."""
    tagid = F.lit(tagid) if isinstance(tagid, str) else tagid
    owner = F.col(owner) if isinstance(owner, str) else owner
    blank = F.lit("")
    weight = blank if weight is None else weight.cast("string")
    return df.select(tagid.alias("tagid"), owner.cast("string").alias(owner_name),
                     weight.alias("tagweight"), blank.alias("tagranking"),
                     blank.alias("reserve"), blank.alias("reserve1"), *extra)
