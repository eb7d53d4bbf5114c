"""Log filter: raw log lines -> rating records, and rating records -> typed events.

``filter_rating_log`` keeps lines that contain ``PRODUCT_RATING_PREFIX:`` and forwards
the text between the first and second occurrence, trimmed, under the fixed key
``logProcessor``. Lines whose payload is empty are not forwarded (the reference throws
on them); ``rejected_log_lines`` returns them for a bad-records sink. Both are plain
column expressions, so they run unchanged on a static frame or inside a streaming query.

``parse_rating_events`` decodes ``userId|productId|score|epochSeconds``. ``strict``
casts (ANSI: a bad value or a short record fails the query); ``permissive`` uses
``try_cast`` and drops rows that do not decode (see ``rejected_events``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprank import schemas as S
from shoprank.functions.columns import normalise_seconds, rating_payload


def filter_rating_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    payload = rating_payload(F.col(value_col))
    return (lines.select(payload.alias("value")).where(F.col("value").isNotNull())
            .select(F.lit(S.RATING_LOG_KEY).alias("key"), "value"))


def rejected_log_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Lines with the prefix but nothing usable after it."""
    has = F.col(value_col).contains(S.RATING_LOG_PREFIX + ":")
    return lines.where(has & rating_payload(F.col(value_col)).isNull())


def _fields(value_col: str, mode: str):
    parts = F.split(F.col(value_col), r"\|")
    cast = (lambda c, t: c.cast(t)) if mode == "strict" else (lambda c, t: c.try_cast(t))
    field = (lambda i: F.element_at(parts, i + 1)) if mode == "strict" else (lambda i: F.get(parts, i))
    return [cast(F.trim(field(0)), "int").alias("userId"),
            cast(F.trim(field(1)), "int").alias("productId"),
            cast(F.trim(field(2)), "double").alias("score"),
            cast(F.trim(field(3)), "bigint").alias("timestamp")]


def _undecoded():
    """Whether a record gives no usable event; a NaN score counts as none."""
    return (F.col("userId").isNull() | F.col("productId").isNull() | F.col("timestamp").isNull()
            | F.col("score").isNull() | F.isnan("score"))


def parse_rating_events(records: DataFrame, value_col: str = "value", mode: str = "strict",
                        keep: list[str] | None = None) -> DataFrame:
    """(userId, productId, score, timestamp[s]) from ``u|p|score|epoch`` text, and the columns
    ``keep`` of the records as they are."""
    if mode not in ("strict", "permissive"):
        raise ValueError("mode must be 'strict' or 'permissive'")
    parsed = records.select(*_fields(value_col, mode), *(keep or []))
    if mode == "permissive":
        parsed = parsed.where(~_undecoded())
    return parsed.withColumn("timestamp", normalise_seconds("timestamp"))


def rejected_events(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Records that ``mode='permissive'`` leaves out: fewer than four fields, a bad number or a
    score that is not a number."""
    parsed = records.select(F.col(value_col), *_fields(value_col, "permissive"))
    return parsed.where(_undecoded()).select(value_col)
