"""Merkle manifest of a table: a hash tree per language, and one over their roots.

Leaves, nodes and digests are those of ``op12`` (SHA-256 as hex text; runs of ``ARITY``
consecutive nodes, the last run shorter, until one node is left). Only every ``STEP``-th
level is written: the leaves, the roots of aligned subtrees of ``ARITY ** STEP`` leaves, and
so on up. A proof is taken from the top down. For each written level, every aligned subtree
is one small group: its missing levels are computed again from the written nodes below, the
siblings on the way of each of these nodes are put before the proof that the subtree's root
already has, and the computed nodes are dropped. At the leaves the proof is hashed and
folded, and leaves the task as a digest.

Leaves get their places without a task that holds a language: rows are sorted by (language,
doc_id, leaf) in a shuffle by range, equal rows split by their place in the input, and the
counts of each part, a row for each part and language, give the offsets.

A null field is ``-``. Rows of null doc_id come first and are never tampered with; rows that
repeat an id follow one another by leaf, so equal rows are leaves of their own. Empty and
very long texts are hashed like others. Only the columns of ``FIELDS`` are read, whatever
others there are; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoprank.session import materialise

from .common import shuffle_partitions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY, STEP = 8, 3
BLOCK = ARITY ** STEP
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---------------------------------------------------------------- digests

def leaf_digest(fields: dict[str, Column]) -> Column:
    """Binary SHA-256 over the fields, each ``-`` or its byte count, a colon and its value."""
    def written(value: Column) -> Column:
        own = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(own).cast("string"), F.lit(":"), own), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[written(fields[f]) for f in FIELDS]), 256))


def digest(parts) -> bytes:
    """Hex SHA-256 of hex digests, concatenated."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def climb(nodes: list[bytes], up: int) -> list[list[bytes]]:
    """The nodes of one aligned subtree and the ``up`` levels above them, lowest first."""
    levels = [nodes]
    for _ in range(up):
        below = levels[-1]
        levels.append([digest(below[k:k + ARITY]) for k in range(0, len(below), ARITY)])
    return levels


def levels_up(n: int) -> int:
    """Levels from ``n`` nodes to the next written one: STEP, or fewer to a tree's root."""
    up = 0
    while n > 1 and up < STEP:
        n, up = -(-n // ARITY), up + 1
    return up


def siblings(levels: list[list[bytes]], place: int) -> list[tuple[int, list[bytes]]]:
    """(place in its run, the run's other nodes) of node ``place`` and those above it."""
    out = []
    for below in levels[:-1]:
        run = below[place - place % ARITY:place - place % ARITY + ARITY]
        at = place % ARITY
        out.append((at, run[:at] + run[at + 1:]))
        place //= ARITY
    return out


def packed(steps) -> bytes:
    """A proof as bytes: for each run its place, the number of siblings and their digests."""
    return b"".join(bytes((at, len(others))) + b"".join(bytes.fromhex(o.decode()) for o in others) for at, others in steps)


def unpacked(proof: bytes) -> list[tuple[int, list[bytes]]]:
    out, k = [], 0
    while k < len(proof):
        at, n = proof[k], proof[k + 1]
        out.append((at, [proof[j:j + 32].hex().encode() for j in range(k + 2, k + 2 + 32 * n, 32)]))
        k += 2 + 32 * n
    return out


def fold(leaf: bytes, steps) -> bytes:
    """The root that a leaf and the siblings of its proof give."""
    for at, others in steps:
        leaf = digest(others[:at] + [leaf] + others[at:])
    return leaf


# ---------------------------------------------------------------- trees

def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0 in each ``tree`` by ``order``) and ``n`` (rows of the tree)."""
    spark = rows.sparkSession
    key = [F.col("tree").asc(), *order, F.col("entry").asc()]
    dealt = (rows.withColumn("entry", F.monotonically_increasing_id())
             .repartitionByRange(shuffle_partitions(spark), *key).sortWithinPartitions(*key).drop("entry"))
    placed = materialise(dealt.select("*", F.spark_partition_id().alias("part"),
                                      F.monotonically_increasing_id().alias("at")), name)
    counts = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("tree", "part", F.sum("rows").over(tree).alias("n"),
                           (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(starts, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _block() -> Column:
    return F.expr(f"pos div {BLOCK}")


def _roots(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("pos")
    up = levels_up(int(group["n"].iloc[0]))
    top = climb([h.hex().encode() for h in group["hash"]], up)[-1][0]
    n = int(group["n"].iloc[0])
    for _ in range(up):
        n = -(-n // ARITY)
    return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [n], "hash": [bytes.fromhex(top.decode())]})


def written_levels(leaves: DataFrame) -> list[DataFrame]:
    """The written levels over ``leaves`` (tree, pos, n, hash), these first, the roots last."""
    levels = [leaves]
    while (levels[-1].agg(F.max("n")).first()[0] or 1) > 1:
        block = levels[-1].select("tree", _block().alias("block"), "pos", "n", "hash")
        levels.append(materialise(block.groupBy("tree", "block").applyInPandas(
            _roots, "tree string, pos long, n long, hash binary"), "merkle-level"))
    return levels


def _proved(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame):
    """(node, steps of its proof inside the subtree and above, as bytes)."""
    nodes = nodes.sort_values("pos")
    levels = climb([h.hex().encode() for h in nodes["hash"]], levels_up(int(nodes["n"].iloc[0])))
    return nodes, [packed(siblings(levels, k)) + above["proof"].iloc[0] for k in range(len(nodes))]


def _proofs(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    if nodes.empty or above.empty:
        return pd.DataFrame(columns=["tree", "pos", "proof", "subroot", "root"])
    nodes, proofs = _proved(key, nodes, above)
    return pd.DataFrame({"tree": key[0], "pos": nodes["pos"], "proof": proofs,
                         "subroot": above["subroot"].iloc[0], "root": above["root"].iloc[0]})


_DIGESTS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
#: Ids travel as strings: pandas would make floats of a group's integers where one is null.
_RESULT = ", ".join(f"{c} {'boolean' if c == 'verified' else 'string'}" for c in _DIGESTS)


def _verified(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    if nodes.empty or above.empty:
        return pd.DataFrame(columns=_DIGESTS)
    nodes, proofs = _proved(key, nodes, above)
    root = above["root"].iloc[0].hex()
    rows = []
    for doc, leaf, tampered, proof in zip(nodes["doc_id"], nodes["hash"], nodes["tampered"], proofs):
        steps = unpacked(proof)
        folded = fold((tampered if tampered is not None else leaf).hex().encode(), steps).decode()
        rows.append((doc, leaf.hex(), above["subroot"].iloc[0].hex(), root,
                     digest(o for _, others in steps for o in others).decode(), folded, folded == root))
    return pd.DataFrame(rows, columns=_DIGESTS)


def _under(nodes: DataFrame, above: DataFrame, run, schema: str) -> DataFrame:
    """``run`` on every aligned subtree of ``nodes`` with the proof of its root."""
    below = nodes.withColumn("block", _block())
    over = above.select("tree", F.col("pos").alias("block"), "proof", "subroot", "root")
    return below.groupBy("tree", "block").cogroup(over.groupBy("tree", "block")).applyInPandas(run, schema)


def _down(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """Proofs of the nodes of ``levels[0]`` from those of the roots, ``levels[-1]``."""
    for nodes in reversed(levels[:-1]):
        above = materialise(_under(nodes.select("tree", "pos", "n", "hash"), above, _proofs,
                                   "tree string, pos long, proof binary, subroot binary, root binary"), "merkle-proofs")
    return above


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row."""
    own = {f: F.col(f) for f in FIELDS}
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(own).alias("hash"),
        F.when(changed, leaf_digest(own | {"text": F.translate("text", _UPPER, _LOWER)})).alias("tampered"))
    leaves = numbered(rows, [F.col("doc_id").asc_nulls_first(), F.col("hash").asc()], "merkle-leaves")
    levels = written_levels(leaves.select("tree", "pos", "n", "hash"))
    subroots = levels[-1]

    tops = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "hash"),
                    [F.col("lang").asc()], "merkle-subroots")
    top_levels = written_levels(tops.select("tree", "pos", "n", "hash"))
    root = top_levels[-1].select("tree", "pos", F.lit(b"").alias("proof"), F.col("hash").alias("subroot"),
                                 F.col("hash").alias("root"))
    of_top = _down(top_levels, root).select("pos", "proof", "root")
    above = (tops.select("pos", F.col("lang").alias("tree"), F.col("hash").alias("subroot")).join(of_top, "pos")
             .select("tree", F.lit(0).cast("long").alias("pos"), "proof", "subroot", "root"))
    above = _down(levels[1:] or levels, above)
    out = _under(leaves.withColumn("doc_id", F.col("doc_id").cast("string")), above, _verified, _RESULT)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
