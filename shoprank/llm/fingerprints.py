"""Document fingerprints by one-permutation MinHash.

A text is its set of shingles of ``WIDTH`` words (``shingles.py``; fewer words: the whole
sequence). Every shingle is hashed once: the upper bits name one of ``BINS`` bins, which
keeps the least hash. A bin that stays empty borrows by optimal densification: it walks its
own fixed random order of all bins, the same for every text, to the first one that is not
empty. Of each bin's hash, mixed with the bin's number so that a hash lent to many bins
does not agree by chance in all of them at once, the ``BITS`` lowest bits are kept, two
bins to a byte: 256 bytes a text, written as hex digits. The likeness of two fingerprints is the share of equal bins,
freed of the 1 in 2**BITS that agree by chance; it estimates the Jaccard likeness of the
shingle sets (standard error at most 0.024 where sets fill their bins, more for texts of
fewer shingles than bins).

``edited_fingerprints`` needs each row's successor. Rows are sorted by (doc_id, hash of the
text) in one shuffle by range, equal rows split by their place in the input, and every task
walks its part with the next row at hand. Only the last row of a part lacks its successor:
these rows and the first rows of the parts, two per task, are joined afterwards.

Null texts are empty. A text without words has the empty fingerprint: likeness 1 to another
empty one, else 0. Rows that repeat an id follow one another by a hash of their texts, null
ids come first, and a table of one row is its own successor. Whole texts are read, however
long; a task holds one Arrow batch of rows and one more row. Other columns are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoprank.session import materialise

from .common import shuffle_partitions, text_or_empty
from .shingles import chunks, mix, shingle_sets

WIDTH = 5
#: Bins are a power of two; two of BITS bits share a byte.
BINS, BITS = 512, 4
CHANCE = 1 / (1 << BITS)
BYTES = BINS * BITS // 8

#: Row k: the order in which the empty bin k looks at the others.
_ORDERS: list[np.ndarray] = []


def _orders() -> np.ndarray:
    if not _ORDERS:
        rng = np.random.default_rng(20250711)
        _ORDERS.append(np.stack([rng.permutation(BINS) for _ in range(BINS)]).astype(np.int64))
    return _ORDERS[0]


def densified(least: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """``least`` (texts x BINS) with each empty bin's entry replaced by that of the first filled
    bin in its order; rows without a filled bin stay as they are."""
    orders = _orders()
    text, empty = np.nonzero(~filled & filled.any(axis=1)[:, None])
    out, step = least.copy(), 0
    while len(text):
        donor = orders[empty, step]
        found = filled[text, donor]
        out[text[found], empty[found]] = least[text[found], donor[found]]
        text, empty, step = text[~found], empty[~found], step + 1
    return out


def fingerprints_of(texts) -> np.ndarray:
    """One row of BYTES bytes per text, and whether it has a word at all in the last column."""
    shift, mask = np.uint64(64 - BINS.bit_length() + 1), np.uint64((1 << BITS) - 1)
    own_of_bin = np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    out = np.zeros((len(texts), BYTES + 1), np.uint8)
    for part in chunks(texts):
        place, h, n = shingle_sets(part, WIDTH)
        bins = (h >> shift).astype(np.int64)
        first = np.ones(len(h), bool)  # hashes of a text are sorted, so the first of a bin is its least
        first[1:] = (place[1:] != place[:-1]) | (bins[1:] != bins[:-1])
        least = np.zeros((len(part), BINS), np.uint64)
        filled = np.zeros((len(part), BINS), bool)
        at = place[first], bins[first]
        least[at], filled[at] = h[first], True
        low = (mix(densified(least, filled) ^ own_of_bin) & mask).astype(np.uint8)
        rows = [k for k, _ in part]
        out[rows, :BYTES] = low[:, 0::2] << 4 | low[:, 1::2]
        out[rows, BYTES] = n > 0
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard likeness of the texts behind fingerprints ``a`` and ``b``, row by row."""
    differ = a[:, :BYTES] ^ b[:, :BYTES]
    same = 1 - ((differ & 15 != 0).sum(axis=1) + (differ >> 4 != 0).sum(axis=1)) / BINS
    free = np.clip((same - CHANCE) / (1 - CHANCE), 0, 1)
    words_a, words_b = a[:, BYTES] > 0, b[:, BYTES] > 0
    return np.where(words_a & words_b, free, np.where(words_a | words_b, 0.0, 1.0))


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first ones of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _packed(prints: np.ndarray) -> list[bytes]:
    return [row[:BYTES].tobytes() if row[BYTES] else b"" for row in prints]


def _unpacked(packed) -> np.ndarray:
    return np.array([np.frombuffer(p + b"\1" if p else bytes(BYTES + 1), np.uint8) for p in packed]).reshape(-1, BYTES + 1)


_RESOLVED = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha", pa.binary()), ("own", pa.binary()),
                       ("edit", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_WALKED = pa.schema([*_RESOLVED, ("part", pa.int32()), ("edge", pa.int32()), ("text", pa.string())])
_SQL_TYPES = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string", pa.float64(): "double"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_SQL_TYPES[f.type]}" for f in schema)


def _batch(schema: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    """A batch of ``rows`` rows; columns that are not given are null."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type)
                                       for f in schema], schema=schema)


def _resolved(ids, texts, own, following, following_own) -> dict:
    """Columns of rows whose successors' texts and fingerprints are known."""
    after = [edited(t, f) for t, f in zip(texts, following)]
    prints = fingerprints_of(after)
    return {"doc_id": ids, "n_chars": [len(t) for t in texts],
            "edited_sha": [hashlib.sha256(t.encode()).digest() for t in after],
            "own": _packed(own), "edit": _packed(prints),
            "near_edited": likeness(own, prints), "near_next": likeness(own, following_own)}


def _walk(batches):
    """Resolved rows of one sorted part (edge 0), and its first and last rows (edges 1 and 2)
    with their texts."""
    part, last = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part")[0].as_py()
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        own = fingerprints_of(texts)
        if last is None:
            yield _batch(_WALKED, 1, part=[part], edge=[1], text=texts[:1], own=_packed(own[:1]))
        else:
            ids, texts, own = [last[0], *ids], [last[1], *texts], np.concatenate([last[2], own])
        last = ids[-1], texts[-1], own[-1:]
        n = len(texts) - 1
        if n:
            yield _batch(_WALKED, n, part=[part] * n, edge=[0] * n,
                         **_resolved(ids[:-1], texts[:-1], own[:-1], texts[1:], own[1:]))
    if last is not None:
        yield _batch(_WALKED, 1, part=[part], edge=[2], doc_id=[last[0]], text=[last[1]], own=_packed(last[2]))


def _stitch(batches):
    for batch in batches:
        if batch.num_rows:
            column = batch.to_pydict()
            yield _batch(_RESOLVED, batch.num_rows, **_resolved(
                column["doc_id"], column["text"], _unpacked(column["own"]),
                column["next_text"], _unpacked(column["next_own"])))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row (doc_id, text); no shuffle."""
    schema = pa.schema([_RESOLVED.field("doc_id"), _RESOLVED.field("own")])

    def run(batches):
        for batch in batches:
            yield _batch(schema, batch.num_rows, doc_id=batch.column("doc_id"),
                         own=_packed(fingerprints_of(batch.column("text").to_pylist())))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, _ddl(schema)).select("doc_id", F.lower(F.hex("own")).alias("fingerprint"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    for every row (doc_id, text); see the module's text for the edit and the order."""
    spark = docs.sparkSession
    key = [F.col("doc_id").asc_nulls_first(), F.col("h").asc(), F.col("place").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("place"))
    dealt = rows.repartitionByRange(shuffle_partitions(spark), *key).sortWithinPartitions(*key)
    walked = materialise(dealt.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(
        _walk, _ddl(_WALKED)), "fingerprint-rows")
    first = walked.where("edge = 1").select("part", F.col("text").alias("next_text"), F.col("own").alias("next_own"))
    around = Window.orderBy("part")  # one row for each task of the sort
    turn = (walked.where("edge = 1").select("part")
            .withColumn("next_part", F.coalesce(F.lead("part").over(around), F.min("part").over(around.rowsBetween(
                Window.unboundedPreceding, Window.unboundedFollowing)))))
    open_rows = walked.where("edge = 2").select("part", "doc_id", "text", "own").join(turn, "part")
    closed = (open_rows.drop("part").withColumnRenamed("next_part", "part").join(first, "part")
              .select("doc_id", "text", "own", "next_text", "next_own").mapInArrow(_stitch, _ddl(_RESOLVED)))
    whole = walked.where("edge = 0").select(*closed.columns).unionByName(closed)
    return whole.select("doc_id", "n_chars", F.lower(F.hex("edited_sha")).alias("edited_sha256"),
                        F.lower(F.hex("own")).alias("fingerprint"), F.lower(F.hex("edit")).alias("edited_fingerprint"),
                        "near_edited", "near_next")
