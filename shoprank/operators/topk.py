"""Per-key top-N and the nested recommendation-list shape ``key -> [(productId, score)]``.

Top-N uses ``row_number() <= n`` over a window; Spark plans it with ``WindowGroupLimit``,
which keeps only n rows per key in each task *before* the shuffle, so a key with
millions of candidates never reaches one task whole. Ties break on ascending product
id everywhere, which makes every list deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoprank.functions.columns import rec_struct


def rank_within(df: DataFrame, key: str | list[str], order: list[Column], n: int | None = None,
                rank_col: str = "rank") -> DataFrame:
    """Add a 1-based ``rank`` per key; keep ranks <= n when n is given."""
    keys = [key] if isinstance(key, str) else key
    ranked = df.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank_col) <= n) if n is not None else ranked


def top_n_per_key(df: DataFrame, key: str, item: str, score: str, n: int | None) -> DataFrame:
    """Rows (key, item, score, rank) best score first, ties on ascending item."""
    return rank_within(df, key, [F.desc(score), F.asc(item)], n)


def to_recs(df: DataFrame, key: str, item: str, score: str, n: int | None = None,
            ranked: bool = False) -> DataFrame:
    """Group into ``key, recs`` ordered by score desc, item asc.

    With ``ranked=True`` the input already carries ``rank``; otherwise it is computed.
    The list of one key holds at most n items (or the key's neighbours when n is None,
    which is bounded by the catalogue, not by the rating volume)."""
    if not ranked:
        df = top_n_per_key(df, key, item, score, n)
    return (df.groupBy(key)
            .agg(F.sort_array(F.collect_list(F.struct(F.col("rank"), rec_struct(item, score).alias("r"))))
                 .alias("ranked"))
            .select(F.col(key), F.transform("ranked", lambda x: x["r"]).alias("recs")))


def explode_recs(df: DataFrame, key: str, rank_col: str = "rank") -> DataFrame:
    """Nested recs -> flat rows (key, rank, productId, score); rank is 1-based."""
    return (df.select(key, F.posexplode("recs").alias("pos", "rec"))
            .select(key, (F.col("pos") + 1).cast("int").alias(rank_col),
                    F.col("rec.productId").alias("productId"), F.col("rec.score").alias("score")))


def explode_recs_outer(df: DataFrame, key: str, rank_col: str = "rank") -> DataFrame:
    """Like ``explode_recs`` but an empty list yields one row with NULL item fields."""
    return (df.select(key, F.posexplode_outer("recs").alias("pos", "rec"))
            .select(key, (F.col("pos") + 1).cast("int").alias(rank_col),
                    F.col("rec.productId").alias("productId"), F.col("rec.score").alias("score")))
