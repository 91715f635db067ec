"""Fields of JSON event messages ``{"i":{"timestamp":s},"d":{"d":id}}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text for an unreadable field, and where an id is cut.
UNKNOWN = "(unknown)"
ID_SEPARATOR = "##"
# Seconds whose microseconds still fit a timestamp.
_LAST_SECOND = (2**63 - 1) // 10**6


def event_time(seconds: Column) -> Column:
    """Local ``yyyy-MM-dd HH:mm:ss`` of epoch seconds."""
    text = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")
    # Years past 9999 come with a plus sign.
    readable = F.when(seconds.between(-_LAST_SECOND, _LAST_SECOND), F.ltrim(text, F.lit("+")))
    return F.coalesce(readable, F.lit(UNKNOWN))


def device_id(kind: Column, inner: Column) -> Column:
    """The id in the member ``d``: ``"null"`` when the object has none, unknown
    when the member's type is no object or the id is empty."""
    head = F.substring_index(F.coalesce(inner, F.lit("null")), ID_SEPARATOR, 1)
    return F.when(kind.startswith("OBJECT") & (head != ""), head).otherwise(F.lit(UNKNOWN))


def extract_events(messages: DataFrame, *keep: str, value: str = "value") -> DataFrame:
    """Message rows → (*keep, data_date, cookies_num).

    The whole value is parsed once, strictly: text after the message makes
    both fields unknown.  Timestamps with a fraction or exponent are truncated.
    """
    # The parser stops after a first value.  Text behind the message can close
    # one of two kinds of bracket around it, but not both.
    inside = F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))
    message = F.try_parse_json(F.concat(F.lit('{"m":'), value, F.lit("}")))
    parsed = messages.select(*keep, F.when(inside.isNotNull(), message).alias("message"))
    seconds = F.try_variant_get("message", "$.m.i.timestamp", "decimal(38,9)").try_cast("bigint")
    kind = F.schema_of_variant(F.try_variant_get("message", "$.m.d", "variant"))
    inner = F.try_variant_get("message", "$.m.d.d", "string")
    return parsed.select(*keep, event_time(seconds).alias("data_date"),
                         device_id(kind, inner).alias("cookies_num"))
