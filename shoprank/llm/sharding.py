"""Sharding by longest-processing-time scheduling: rows of equal text stay together, groups
go by size to the least-loaded shard through a heap.

The largest groups (those above a fixed share of a shard, of which there cannot be many) are
scheduled on the driver. All others are dealt by hash to packers; each takes its groups from
the largest to the smallest and gives them to the least loaded of its own bins through a
heap, holding the bins alone. The bins, whose number does not depend on the number of
groups, are then scheduled like groups on top of the large ones. Shards come out nearly
equal in bytes (law ``bytes``), as far as no group exceeds a shard.

A row's size is its text's UTF-8 bytes plus 8. Null and empty texts are one group of size 8 a
row and CRC 0. Equal texts are told by SHA-256. Rows that repeat an id each get a place;
slots count from 0 without gaps in each shard; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoprank.session import materialise

from .common import shuffle_partitions

#: A group above 1 / LARGE of a shard is scheduled by itself: at most shards * LARGE groups.
LARGE = 512
#: Bins of all packers together, at least; their number bounds what the driver schedules.
BINS = 8192
#: Parts of a shard in which slots are counted.
SLOT_PARTS = 256


def lpt(jobs, loads: list[int]) -> list[int]:
    """The shard of each (size, name) of ``jobs``, which are sorted by falling size; ``loads``
    holds the shards' sizes and is brought up to date."""
    heap = [(load, shard) for shard, load in enumerate(loads)]
    heapq.heapify(heap)
    out = []
    for size, _ in jobs:
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        loads[shard] = load + size
        out.append(shard)
    return out


def _into_bins(bins: int):
    def run(frames):
        packer, heap = None, []
        for frame in frames:
            taken = []
            for own, size in zip(frame["packer"].tolist(), frame["bytes"].tolist()):
                if own != packer:
                    packer, heap = own, [(0, b) for b in range(bins)]
                load, bin_no = heap[0]
                heapq.heapreplace(heap, (load + size, bin_no))
                taken.append(bin_no)
            yield frame.assign(bin=taken)

    return run


def shard(docs: DataFrame, shards: int = 24) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row (doc_id, text)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = materialise(docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                                   F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                                   F.unhex(F.sha2(text, 256)).alias("digest")), "shard-rows")
    groups = materialise(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    least = max(1, total // (shards * LARGE))
    loads = [0] * shards
    large = sorted(((r["bytes"], bytes(r["digest"])) for r in groups.where(F.col("bytes") > least).collect()), reverse=True)
    large_shards = pd.DataFrame({"digest": [d for _, d in large], "shard": lpt(large, loads)})

    packers = max(1, shuffle_partitions(spark) // 2)
    bins = max(shards, -(-BINS // packers))
    dealt = (groups.where(F.col("bytes") <= least)
             .withColumn("packer", F.pmod(F.xxhash64("digest"), F.lit(packers)).cast("int"))
             .repartition(packers, "packer").sortWithinPartitions("packer", F.desc("bytes"), "digest"))
    binned = materialise(dealt.mapInPandas(_into_bins(bins), "digest binary, bytes long, packer int, bin int"), "shard-bins")
    heights = binned.groupBy("packer", "bin").agg(F.sum("bytes").alias("bytes")).toPandas()
    heights = heights.sort_values(["bytes", "packer", "bin"], ascending=[False, True, True])
    heights["shard"] = lpt(list(zip(heights["bytes"].tolist(), heights["bin"])), loads)

    of_bins = spark.createDataFrame(heights[["packer", "bin", "shard"]].astype("int32"), "packer int, bin int, shard int")
    of_large = spark.createDataFrame(large_shards, "digest binary, shard int") if len(large) else \
        spark.createDataFrame([], "digest binary, shard int")
    placed = binned.join(F.broadcast(of_bins), ["packer", "bin"]).select("digest", "shard").unionByName(of_large)
    sharded = materialise(rows.join(placed, "digest").select(
        "doc_id", "size", "text_crc32", "shard",
        F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SLOT_PARTS)).cast("int").alias("part")), "shard-places")
    counts = sharded.groupBy("shard", "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")
    return (sharded.withColumn("row", F.row_number().over(inside)).join(F.broadcast(starts), ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("first") + F.col("row") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
