"""Helpers shared by the corpus operators: null-safe text, tables cut from their lineage,
fixed-size Bloom filters and connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoprank.session import materialise


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def bind(value: Column, then) -> Column:
    """``then(value)`` with ``value`` worked out once, wherever the optimizer moves it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Bloom:
    """Bloom filter over 64-bit hashes with a fixed number of bits, so that sending one to
    every task costs the same whatever the data size. A fuller filter only lets more rows
    through to the exact join behind it."""

    def __init__(self, bits: int = 1 << 23, words: np.ndarray | None = None):
        self.bits = bits
        self.words = np.zeros(bits // 64, np.uint64) if words is None else words

    def _spots(self, h: np.ndarray):
        h = h.astype(np.uint64, copy=False)
        mixed = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        mask = np.uint64(self.bits - 1)
        yield mixed & mask
        yield (mixed >> np.uint64(32)) & mask
        yield (mixed * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(29)) & mask

    def add(self, h: np.ndarray) -> None:
        for spot in self._spots(h):
            np.bitwise_or.at(self.words, (spot >> np.uint64(6)).astype(np.int64),
                             np.uint64(1) << (spot & np.uint64(63)))

    def has(self, h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for spot in self._spots(h):
            word = self.words[(spot >> np.uint64(6)).astype(np.int64)]
            found &= (word >> (spot & np.uint64(63))) & np.uint64(1) == 1
        return found


def bloom_of(df: DataFrame, column: str, bits: int = 1 << 23) -> Bloom:
    """Filter over a bigint column. Each task fills its own filter and sends only the words
    it set; the driver receives at most bits/64 words per merge group."""

    def fill(frames):
        import pandas as pd

        own = Bloom(bits)
        for frame in frames:
            own.add(frame[column].dropna().to_numpy(np.int64).view(np.uint64))
        spots = np.flatnonzero(own.words)
        yield pd.DataFrame({"spot": spots, "word": own.words[spots].view(np.int64)})

    words = (df.select(column).mapInPandas(fill, "spot long, word long")
             .groupBy("spot").agg(F.bit_or("word").alias("word")).toPandas())
    out = Bloom(bits)
    out.words[words["spot"].to_numpy()] = words["word"].to_numpy(np.int64).view(np.uint64)
    return out


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every end of ``edges`` (u, v): label is the smallest node of the
    component. Every round takes the smallest label among the neighbours and then the label
    of that label, so that long chains halve; each round is written before the next."""
    ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    both = materialise(edges.select(F.inline(ways)).distinct(), "cc-edges")  # edges are worked out once
    labels = materialise(both.groupBy(F.col("u").alias("node")).agg(
        F.least(F.min("v"), F.col("u")).alias("label")), "cc-labels")
    while True:
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        labels = labels.join(far, "label").select("node", F.least("label", "far").alias("label"))
        near = both.join(labels, both.v == labels.node).groupBy("u").agg(F.min("label").alias("near"))
        labels = materialise(labels.join(near, labels.node == near.u).select(
            "node", F.least("label", "near").alias("label"), (F.col("near") < F.col("label")).alias("moved")), "cc-labels")
        if labels.where("moved").limit(1).count() == 0:
            return labels.select("node", "label")
        labels = labels.select("node", "label")
