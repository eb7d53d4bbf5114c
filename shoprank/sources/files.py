"""Scans and sinks: delimited product/rating files, named tables, and the load job.

* ``read_products``: ``^``-separated text, 7 fields, keep 0,1,4,5,6; ids cast, strings
  JVM-trimmed. ``mode='strict'`` fails on a bad id or a short line (ANSI cast and array
  index); ``'permissive'`` leaves such rows to ``rejected_products``.
* ``read_ratings``: ``userId,productId,score,timestamp`` text, no header; same modes, with
  ``rejected_ratings``.
* ``read_table`` / ``write_table``: named tables as Parquet directories under a base
  path with the schema of ``shoprank.schemas``; a table without a declared column fails.
* ``write_bucketed`` / ``read_bucketed``: flat list tables in buckets by product.
* ``load_tables``: replace both base tables; ``merge_ratings`` rewrites only the user ranges of
  the rating table that a batch touches.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoprank import schemas as S
from shoprank.functions.columns import jvm_trim, normalise_seconds
from shoprank.sources.partitions import recover_partitions, replace_partitions


def _cast(col, type_: str, mode: str):
    return col.cast(type_) if mode == "strict" else col.try_cast(type_)


def _field(parts, i: int, mode: str):
    """Field ``i`` of a split line; a line without it fails in strict mode, else gives null."""
    return jvm_trim(F.element_at(parts, i + 1) if mode == "strict" else F.get(parts, i))


def parse_products(lines: DataFrame, mode: str = "strict", value_col: str = "value") -> DataFrame:
    f = F.split(F.col(value_col), r"\^")
    return lines.select(
        _cast(_field(f, 0, mode), "int", mode).alias("productId"),
        _field(f, 1, mode).alias("name"),
        _field(f, 4, mode).alias("imageUrl"),
        _field(f, 5, mode).alias("categories"),
        _field(f, 6, mode).alias("tags"),
    )


def read_products(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """Product file scan. ``mode='permissive'`` drops lines whose id or field count is bad."""
    parsed = parse_products(spark.read.text(path), mode)
    if mode == "permissive":
        parsed = parsed.where(F.col("productId").isNotNull() & F.col("tags").isNotNull())
    return parsed


def rejected_products(spark: SparkSession, path: str) -> DataFrame:
    """Lines that ``mode='permissive'`` drops: bad id or fewer than 7 fields."""
    lines = spark.read.text(path)
    f = F.split(F.col("value"), r"\^")
    bad = jvm_trim(F.get(f, 0)).try_cast("int").isNull() | F.get(f, 6).isNull()
    return lines.where(bad)


def _rating_columns(mode: str, value_col: str) -> list:
    f = F.split(F.col(value_col), ",")
    return [
        _cast(_field(f, 0, mode), "int", mode).alias("userId"),
        _cast(_field(f, 1, mode), "int", mode).alias("productId"),
        _cast(_field(f, 2, mode), "double", mode).alias("score"),
        normalise_seconds(_cast(_field(f, 3, mode), "bigint", mode)).alias("timestamp"),
    ]


def parse_ratings(lines: DataFrame, mode: str = "strict", value_col: str = "value") -> DataFrame:
    return lines.select(*_rating_columns(mode, value_col))


def read_ratings(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """Rating file scan (``userId,productId,score,timestamp``)."""
    parsed = parse_ratings(spark.read.text(path), mode)
    if mode == "permissive":
        parsed = parsed.where(~_undecoded())
    return parsed


def _undecoded():
    return (F.col("userId").isNull() | F.col("productId").isNull() | F.col("timestamp").isNull()
            | F.col("score").isNull() | F.isnan("score"))


def rejected_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Lines that ``mode='permissive'`` leaves out: fewer than 4 fields or a bad number."""
    lines = spark.read.text(path)
    return lines.select("value", *_rating_columns("permissive", "value")).where(_undecoded()).select("value")


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Named table with its declared columns and types; a table without one of them fails."""
    if name in S.FLAT_TABLES:
        return read_bucketed(spark, base, name)
    schema = S.TABLE_SCHEMAS.get(name)
    stored = spark.read.parquet(table_path(base, name))
    if schema is None:
        return stored
    _require(stored, schema, name)
    return spark.read.schema(schema).parquet(table_path(base, name)).select(*schema.names)


def _require(stored: DataFrame, schema, name: str) -> None:
    missing = [c for c in schema.names if c not in stored.columns]
    if missing:
        raise ValueError(f"table {name} has no column {', '.join(missing)}")


def write_table(df: DataFrame, base: str, name: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a result table."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(table_path(base, name))


# ------------------------------------------------------------------ bucketed tables

def _bucketed_path(base: str, name: str, buckets: int) -> str:
    # the number of buckets is part of the path, so files are never read by a wrong number
    return f"{table_path(base, name)}.buckets-{buckets}"


def _catalog_name(path: str, name: str) -> str:
    return f"{name}_{zlib.crc32(path.encode()):08x}".lower()


def write_bucketed(df: DataFrame, base: str, name: str, buckets: int = S.RECS_BUCKETS) -> None:
    """Overwrite a flat list table (productId, rank, recProductId, score), bucketed by product
    and sorted by (product, rank), so that joins on the product read it without a shuffle and
    a list comes in its order. A bucket may have a file from each task; products are dealt to
    tasks by bucket here, so it has one."""
    path = _bucketed_path(base, name, buckets)
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.FLAT_RECS_SCHEMA])
    (rows.repartition(buckets, "productId").write.mode("overwrite").bucketBy(buckets, "productId").sortBy("productId", "rank")
     .option("path", path).format("parquet").saveAsTable(_catalog_name(path, name)))


def read_bucketed(spark: SparkSession, base: str, name: str, buckets: int = S.RECS_BUCKETS) -> DataFrame:
    """The bucketed table at ``base``, whichever session wrote it: it is declared to this session's
    catalog with its buckets."""
    path = _bucketed_path(base, name, buckets)
    _require(spark.read.parquet(path), S.FLAT_RECS_SCHEMA, name)
    own = _catalog_name(path, name)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.FLAT_RECS_SCHEMA)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {own} ({columns}) USING parquet CLUSTERED BY (productId) "
              f"SORTED BY (productId, rank) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.catalog.refreshTable(own)
    return spark.table(own)


# ------------------------------------------------------------------ ratings by user range

RANGE = "userRange"


def user_range(user: str = "userId"):
    return F.floor(F.col(user) / S.USERS_PER_RANGE).cast("int")


def write_ratings(ratings: DataFrame, base: str, files: int | None = None) -> None:
    """Replace the Rating table: partitions by user range, files sorted on (userId, productId),
    the file-layout form of the reference's indexes. Per-user reads prune partitions and, by
    min/max statistics, files; a user holding a large share spans several files."""
    parts = files or ratings.sparkSession.conf.get("spark.sql.shuffle.partitions")
    (ratings.select(*S.RATING_SCHEMA.names).withColumn(RANGE, user_range())
     .repartitionByRange(int(parts), "userId", "productId").sortWithinPartitions(RANGE, "userId", "productId")
     .write.mode("overwrite").partitionBy(RANGE).parquet(table_path(base, S.RATING)))


def merge_ratings(spark: SparkSession, base: str, incoming: DataFrame, merge) -> None:
    """Rewrite the user ranges of the Rating table that ``incoming`` (userId, ...) touches, as
    ``merge(stored rows of these ranges, incoming)``; the files of all others stay as they are.
    A driver that dies while ranges are replaced leaves them to ``recover_partitions``, with which
    the next merge begins."""
    path = table_path(base, S.RATING)
    recover_partitions(spark, path, [RANGE])
    touched = [r[0] for r in incoming.select(user_range()).distinct().collect()]  # one number per range of the batch
    if not touched:
        return
    stored = spark.read.schema(T.StructType([*S.RATING_SCHEMA, T.StructField(RANGE, T.IntegerType())])).parquet(path)
    merged = merge(stored.where(F.col(RANGE).isin(touched)).drop(RANGE), incoming)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    replace_partitions(merged.select(*S.RATING_SCHEMA.names).withColumn(RANGE, user_range())
                       .repartitionByRange(n, "userId", "productId").sortWithinPartitions(RANGE, "userId", "productId"), path, [RANGE])


def load_tables(products: DataFrame, ratings: DataFrame, base: str, rating_files: int | None = None) -> None:
    """Replace the Product table, clustered by id, and the Rating table (``write_ratings``)."""
    (products.repartitionByRange("productId").sortWithinPartitions("productId")
     .write.mode("overwrite").parquet(table_path(base, S.PRODUCT)))
    write_ratings(ratings, base, rating_files)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames as temp views so the statistics can be issued as SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
