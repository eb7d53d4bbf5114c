"""Training-data pipeline over ``documents``: five stages, each written as Parquet and read
again as the next one's input.

Null texts and texts of few words go in the first stage. Stages come back to the rows by a hash
of id and text, so rows that share an id, or have none, are judged each; rows equal in both are
one. Of copies, the row of the smallest id stays, one without an id only where none has one.
Empty tables give empty results; extra columns of documents, of any name, are carried along up
to the last stage.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoprank.llm.common import read
from shoprank.llm.decontaminate import leaks
from shoprank.llm.jaccard import jaccard_components
from shoprank.llm.packing import pack
from shoprank.llm.quality import accepted
from shoprank.llm.queries import tokenizer_path
from shoprank.llm.suffix_dedup import remove_repeats
from shoprank.session import apply_sql_conf, checkpoint_dir, materialise

#: Bytes of a passage that the third stage keeps once only; about forty words.
PASSAGE_BYTES = 240


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    apply_sql_conf(spark)
    return docs.where(accepted(F.col("text")))


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _as_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the row's key in the place of its id."""
    return docs.select(_row_key().alias("doc_id"), "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, that with the smallest id."""
    apply_sql_conf(spark)
    groups = jaccard_components(_as_rows(docs)).select(F.col("doc_id").alias("row_key"), F.col("component_id").alias("class")).distinct()
    rows = docs.select(_row_key().alias("row_key"), "doc_id").distinct()
    first = (rows.join(groups, "row_key").groupBy("class")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first")).select("first.row_key"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _row_key().alias("row_key"))
    return whole.join(first, "row_key", "left_semi").dropDuplicates(["row_key"]).select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier document, or an earlier place, has already;
    those of which nothing is left go."""
    apply_sql_conf(spark)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    carried = docs.select("doc_id", "text", *([F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")] if others else []))
    cut = remove_repeats(carried, length=PASSAGE_BYTES, keep="first", as_text=True)
    cut = cut.where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    own = {c: F.col("row")[c] for c in others} | {c: F.col(c) for c in ("doc_id", "text")}
    if "n_chars" in others:
        own["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(own["n_chars"]).cast("long")
    return cut.select(*[own[c].alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    apply_sql_conf(spark)
    found = leaks(_as_rows(docs), read(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("row_key")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _row_key().alias("row_key"))
    return whole.join(materialise(found, "pipeline-leaks"), "row_key", "left_anti").select("row.*")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their places in sequences of 4096 tokens."""
    apply_sql_conf(spark)
    return pack(docs, tokenizer_path())


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates),
          ("suffix-array dedup", repeated_passages), ("benchmark decontamination", benchmark_leaks),
          ("best-fit packing", packed_sequences)]

#: Components, suffix order, tokens and bins are not for SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    top = os.path.join(checkpoint_dir(spark), "pipeline", uuid.uuid4().hex)
    for number, (_, stage) in enumerate(STAGES):
        path = f"{top}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
