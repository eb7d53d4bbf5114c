"""Map the provided parquet test tables onto the recommender data model.

The same rules are written in SQL for the DuckDB oracle (``shoprank.plans.oracle``):

* ratings  = orders JOIN lineitem on the order key; userId = customer key, productId =
  part key, score = (quantity - 1) % 5 + 1, timestamp = epoch seconds of the order date.
* products = part; categories = type|brand, tags = name words|brand|type.
* rating events = ``purchase`` events; productId = the integer ``k`` of ``props``,
  score = floor(value) % 5 + 1, timestamp = whole epoch seconds of ``ts``.
* log lines = every event; purchases carry the rating prefix, the rest do not.
* users = customers; username = customer name.

Only the needed columns are selected, so the parquet scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoprank.functions.columns import epoch_seconds, rating_log_line


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (items.join(orders, items.l_orderkey == orders.o_orderkey)
            .select(F.col("o_custkey").cast("int").alias("userId"),
                    F.col("l_partkey").cast("int").alias("productId"),
                    ((F.col("l_quantity").cast("int") - 1) % 5 + 1).cast("double").alias("score"),
                    epoch_seconds("o_orderdate").alias("timestamp")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return part.select(
        F.col("p_partkey").cast("int").alias("productId"),
        F.col("p_name").alias("name"),
        F.lit("").alias("imageUrl"),
        F.concat_ws("|", "p_type", "p_brand").alias("categories"),
        F.concat_ws("|", F.regexp_replace("p_name", " ", "|"), "p_brand", "p_type").alias("tags"),
    )


def _event_fields(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("user_id").cast("int").alias("userId"),
        F.get_json_object("props", "$.k").cast("int").alias("productId"),
        ((F.floor("value").cast("bigint") % 5) + 1).cast("double").alias("score"),
        epoch_seconds("ts").alias("timestamp"),
        F.col("event_type"),
    )


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as typed rating events (event_id kept as arrival order)."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    return _event_fields(ev).drop("event_type")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a log text line ``value``; purchases carry the rating record."""
    ev = _event_fields(table(spark, sf_dir, "events"))
    rating_line = F.concat(F.lit("INFO "), rating_log_line("userId", "productId", "score", "timestamp"))
    other = F.concat(F.lit("INFO "), F.col("event_type"), F.lit(" user="), F.col("userId").cast("string"))
    return ev.select("event_id", F.when(F.col("event_type") == "purchase", rating_line)
                     .otherwise(other).alias("value"))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a rating record ``value``; views name no product, errors score
    NaN and signups have no time, so these do not decode."""
    ev = _event_fields(table(spark, sf_dir, "events"))
    product = F.when(F.col("event_type") == "view", F.col("event_type")).otherwise(F.col("productId").cast("string"))
    score = F.when(F.col("event_type") == "error", F.lit("NaN")).otherwise(F.col("score").cast("int").cast("string"))
    return ev.select(F.concat_ws("|", F.col("userId").cast("string"), product, score,
                                 F.when(F.col("event_type") != "signup", F.col("timestamp").cast("string"))).alias("value"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("custkey"), F.col("c_name").alias("username"),
        F.col("c_mktsegment").alias("segment"))
