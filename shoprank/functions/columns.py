"""Column builders (scalar functions). All are built-in Spark expressions, so they stay
inside whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoprank import schemas as S

_TWO_32 = 4294967296
_TWO_31 = 2147483648


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def jvm_trim(col) -> Column:
    """Trim like the JVM ``String.trim``: drop every leading/trailing char <= U+0020
    (Spark's ``trim`` only drops spaces)."""
    return F.regexp_replace(_c(col), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def split_fields(col, sep_regex: str) -> Column:
    """Split a delimited record; keeps inner and trailing empties (positions matter)."""
    return F.split(_c(col), sep_regex)


def split_list(col, sep_regex: str = r"\|") -> Column:
    """Split a list-valued text field and drop trailing empty items, like the JVM
    ``String.split`` (a field ending in ``|`` has no empty last element)."""
    stripped = F.regexp_replace(_c(col), f"({sep_regex})+$", "")
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, sep_regex))


def year_month(epoch_seconds) -> Column:
    """Epoch seconds -> integer ``yyyyMM`` in UTC. Built on day numbers, so it does not
    depend on the session time zone; no UDF."""
    day = F.date_from_unix_date(F.floor(_c(epoch_seconds) / F.lit(86400)).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


def epoch_seconds(ts_ntz) -> Column:
    """Whole epoch seconds of a zone-less timestamp (``TimestampNTZ``), read as UTC."""
    c = _c(ts_ntz)
    return (F.unix_date(F.to_date(c)).cast("bigint") * 86400
            + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)).cast("bigint")


def normalise_seconds(col) -> Column:
    """Timestamps written in milliseconds (web write path) are brought to seconds."""
    c = _c(col).cast("bigint")
    return F.when(c > F.lit(100_000_000_000), F.floor(c / 1000)).otherwise(c).cast("bigint")


def tags_to_text(col) -> Column:
    """``|`` -> space in a tag string."""
    return F.translate(_c(col), "|", " ")


def normalise_score(col) -> Column:
    """Halve a 1..10 UI score and keep two decimals (half-up)."""
    return F.round(_c(col).cast("double") / 2.0, 2)


def username_hash(col) -> Column:
    """32-bit JVM string hash of a name (``h = 31*h + unit`` over UTF-16 code units,
    wrapping). Computed on the hex of the UTF-16BE encoding, 4 hex digits per unit,
    in bigint modular arithmetic so that ANSI overflow checks never fire."""
    hexed = F.hex(F.encode(_c(col), "UTF-16BE"))
    units = F.transform(
        F.sequence(F.lit(0), F.greatest(F.length(hexed) / 4 - 1, F.lit(-1)).cast("int")),
        lambda i: F.conv(F.substring(hexed, i * 4 + 1, 4), 16, 10).cast("bigint"),
    )
    units = F.when(F.length(hexed) == 0, F.array().cast("array<bigint>")).otherwise(units)
    h = F.aggregate(units, F.lit(0).cast("bigint"),
                    lambda acc, u: F.pmod(acc * 31 + u, F.lit(_TWO_32)))
    return F.when(h >= _TWO_31, h - _TWO_32).otherwise(h).cast("int")


def log10_count(col) -> Column:
    return F.log10(_c(col).cast("double"))


def dot(a, b) -> Column:
    """Dot product of two equal-length numeric arrays."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def l2_norm(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double")),
                              F.lit(0.0), lambda acc, v: acc + v))


def cosine(a, b) -> Column:
    """Cosine of two dense vectors; NULL (not NaN) when a norm is zero, so a zero vector
    never passes a ``> threshold`` filter (Spark orders NaN above every number)."""
    return dot(a, b) / F.nullif(l2_norm(a) * l2_norm(b), F.lit(0.0))


def cooccurrence_sim(cocount, count1, count2) -> Column:
    return _c(cocount).cast("double") / F.sqrt(_c(count1).cast("double") * _c(count2).cast("double"))


def rec_struct(product_col, score_col) -> Column:
    return F.struct(_c(product_col).cast("int").alias("productId"),
                    _c(score_col).cast("double").alias("score"))


def recs_to_map(recs) -> Column:
    """recs array -> map productId -> score (last duplicate wins under LAST_WIN)."""
    return F.map_from_entries(F.transform(_c(recs), lambda r: F.struct(r["productId"], r["score"])))


def rating_log_line(user, product, score, epoch) -> Column:
    """``PREFIX:user|product|score|epochSeconds`` as written by the rating endpoint."""
    return F.concat(F.lit(S.RATING_LOG_PREFIX + ":"),
                    F.concat_ws("|", _c(user).cast("string"), _c(product).cast("string"),
                                _c(score).cast("double").cast("string"), _c(epoch).cast("string")))


def rating_payload(line) -> Column:
    """Text between the first and second occurrence of the prefix, JVM-trimmed;
    NULL when the prefix is absent or nothing follows it."""
    parts = F.split(_c(line), S.RATING_LOG_PREFIX + ":")
    payload = jvm_trim(F.get(parts, 1))
    return F.when(_c(line).contains(S.RATING_LOG_PREFIX + ":") & (payload != ""), payload)
