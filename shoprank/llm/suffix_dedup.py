"""Suffix-array dedup: removal of byte strings of ``length`` that occur more than once.

The longest-previous-factor array tells, for every suffix, the longest prefix it shares with an
earlier suffix, which is the previous or next smaller position in suffix order; what it covers
with ``length`` bytes or more goes. With a fixed length, LPF is wanted up to ``length`` only, so
suffixes need an order that puts equal ``length``-byte prefixes side by side: that of a 64-bit
hash of those prefixes, dealt out by hash range, so that no common passage or letter fills a
range. In each range common prefixes are ``length`` or 0 (windows of one hash are taken as
equal), and LPF comes from the smaller positions on both sides. Suffixes that cannot match are
left out before:

1. Every window of ``length`` bytes is named by the smallest hash of its inner grams
   (a minimizer). Neighbouring windows of one name form a run; equal windows have equal
   names. Runs are dealt by name as packed rows, and names that occur once are dropped.
   Runs with equal whole extents match window by window, so their copies are done here.
2. Of the other runs, and of one run of each extent, every window becomes a suffix of the
   order above.

``keep='first'`` removes the bytes of windows with LPF >= length (earlier: smaller doc_id, then
row key, then place); ``keep='none'`` also those with a later equal window, by the same array over
falling positions.
Windows are judged on the input, overlaps count, matches never cross rows.

Rows are told apart by a hash of id and text; rows equal in both count as one document under
``keep='first'`` and as copies under ``keep='none'``. Null texts are empty; texts shorter than
``length`` are kept whole; null ids sort first. Other columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprank.session import materialise

from .common import bloom_of, shuffle_partitions
from .shingles import mix, powers, prefix_hash

#: Bytes of text that a task looks at together, or one long text.
CHUNK_BYTES = 200_000
#: Bytes of text whose runs or windows share a bucket, so a task's group keeps its size.
BUCKET_BYTES = 8 << 20

PACKED = "bucket int, keys binary, places binary, names binary, extents binary"
RUNS = "key long, whole boolean, runs binary"


def _chunks(frame: pd.DataFrame, limit: int = CHUNK_BYTES):
    part, size = [], 0
    for key, doc, text in zip(frame["key"].to_numpy(), frame["doc_id"].to_numpy(), frame["text"]):
        data = (text or "").encode("utf-8", "surrogatepass")
        if part and size + len(data) > limit:
            yield part
            part, size = [], 0
        part.append((key, np.iinfo(np.int64).min if pd.isna(doc) else int(doc), data))
        size += len(data)
    if part:
        yield part


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every ``width`` neighbours, by doubling."""
    out, span = values, 1
    while span * 2 <= width:
        out = pick(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return pick(out[:-rest], out[rest:]) if rest else out


def _named_runs(datas: list[bytes], length: int):
    """(document, start, windows, name, extent, repeats itself) of every run of windows."""
    gram = max(1, length * 16 // 25)
    width = length - gram + 1
    data = np.frombuffer(b"".join(datas), np.uint8)
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, bool),)
    if len(data) < length:
        return none
    sizes = np.array([len(d) for d in datas], np.int64)
    ends = np.cumsum(sizes)
    prefix = prefix_hash(data)
    _, down = powers(len(data) + 1)
    grams = mix((prefix[gram:] - prefix[:-gram]) * down[:len(data) - gram + 1])
    least = _sliding(grams, width, np.minimum)  # of the windows, by start
    starts = np.arange(len(least))
    owner = np.searchsorted(ends, starts, side="right")
    valid = starts + length <= ends[owner]
    breaks = np.ones(len(least), bool)
    breaks[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | (valid[1:] != valid[:-1])
    at = np.flatnonzero(breaks)
    n = np.diff(np.r_[at, len(least)])
    good = valid[at]
    at, n = at[good], n[good]
    if not len(at):
        return none
    stop = at + n - 1 + length
    extent = mix((prefix[stop] - prefix[at]) * down[at] + n.astype(np.uint64))
    # grams that name a window; two neighbours with one hash: the text repeats itself
    padded = np.concatenate([np.zeros(width - 1, np.uint64), np.where(valid, least, 0), np.zeros(width - 1, np.uint64)])
    chosen = np.flatnonzero(grams == _sliding(padded, width, np.maximum)[:len(grams)])
    twice = grams[chosen[1:]][grams[chosen[1:]] == grams[chosen[:-1]]]
    name = least[at]
    return owner[at], at - (ends - sizes)[owner[at]], n, name, extent, np.isin(name, twice)


def _rows_by_bucket(hashes, buckets: int, columns, order_by):
    """(bucket, slice of the columns) dealt by the range of the hash, kept in order inside."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    columns = [c[order] for c in columns]
    cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        if lo < hi:
            yield int(bucket[lo]), [c[lo:hi] for c in columns]


def _pack_owner(owner: np.ndarray, ids: np.ndarray) -> bytes:
    """(key, doc_id, entries) of each document whose entries follow one another."""
    at = np.r_[0, np.flatnonzero(np.diff(owner)) + 1]
    counts = np.diff(np.r_[at, len(owner)])
    return np.column_stack([ids[owner[at]], counts]).astype(np.int64).tobytes()


def _unpack_owner(blobs):
    rows = np.concatenate([np.frombuffer(b, np.int64).reshape(-1, 3) for b in blobs])
    return np.repeat(rows[:, 0], rows[:, 2]), np.repeat(rows[:, 1], rows[:, 2])


def _pack_runs(buckets: int, length: int):
    def run(frames):
        for frame in frames:
            for part in _chunks(frame):
                owner, start, n, name, extent, again = _named_runs([d for _, _, d in part], length)
                if not len(owner):
                    continue
                ids = np.array([(key, doc) for key, doc, _ in part], np.int64)
                rows = []
                # names are smallest hashes, so their own range would deal nearly all to the first bucket
                for bucket, (o, s, m, a, h, e) in _rows_by_bucket(mix(name), buckets, [owner, start, n, again, name, extent], owner):
                    places = np.column_stack([s, m * 2 + a]).astype(np.uint32)
                    rows.append((bucket, _pack_owner(o, ids), places.tobytes(),
                                 h.view(np.uint8).reshape(-1, 8)[:, :6].tobytes(), e.tobytes()))
                yield pd.DataFrame(rows, columns=["bucket", "keys", "places", "names", "extents"])

    return run


def _from_six(blob: bytes) -> np.ndarray:
    six = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view(np.uint64).reshape(-1)


def _runs_by_key(key: np.ndarray, start: np.ndarray, n: np.ndarray, whole: bool) -> pd.DataFrame:
    """A row for each key, its distinct runs (start, windows) packed: as rows or Python objects of
    their own they would fill the memory of the workers."""
    order = np.lexsort((n, start, key))
    key, runs = key[order], np.column_stack([start[order], n[order]]).astype(np.uint32)
    new_key = np.r_[True, key[1:] != key[:-1]][:len(key)]
    some = new_key | np.r_[True, (runs[1:] != runs[:-1]).any(axis=1)][:len(key)]
    key, runs, new_key = key[some], runs[some], new_key[some]
    at = np.flatnonzero(new_key)
    packed = [runs[a:b].tobytes() for a, b in zip(at, np.r_[at[1:], len(key)])]
    return pd.DataFrame({"key": key[at], "whole": np.full(len(at), whole), "runs": packed})


def _unpack_runs(blobs) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint32).reshape(-1, 2).astype(np.int64)


def _matching_runs(keep: str):
    """Of one bucket of names: runs whose windows all match (whole), and runs to look into."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        name = np.concatenate([_from_six(b) for b in frame["names"]])
        extent = np.concatenate([np.frombuffer(b, np.uint64) for b in frame["extents"]])
        key, doc = _unpack_owner(frame["keys"])
        places = np.concatenate([np.frombuffer(b, np.uint32).reshape(-1, 2) for b in frame["places"]]).astype(np.int64)
        del frame
        start, n, again = places[:, 0], places[:, 1] // 2, places[:, 1] % 2 == 1
        order = np.argsort(name, kind="stable")
        name = name[order]
        same = name[1:] == name[:-1]
        maybe = np.r_[False, same] | np.r_[same, False] | again[order]
        order = order[maybe]
        name, extent, key, doc, start, n, again = (c[order] if k else c[maybe] for k, c in enumerate(
            (name, extent, key, doc, start, n, again)))
        order = np.lexsort((start, key, doc, extent, name))
        name, extent, key, doc, start, n, again = (c[order] for c in (name, extent, key, doc, start, n, again))
        if keep == "first" and len(name):  # equal rows are one document
            new = np.r_[True, np.diff(name).astype(bool) | np.diff(extent).astype(bool) | np.diff(key).astype(bool) | np.diff(start).astype(bool)]
            name, extent, key, doc, start, n, again = (c[new] for c in (name, extent, key, doc, start, n, again))
        if not len(name):
            return _runs_by_key(key, start, n, True)
        new_name = np.r_[True, name[1:] != name[:-1]]
        new_extent = new_name | np.r_[True, extent[1:] != extent[:-1]]
        extent_no = np.cumsum(new_extent) - 1
        name_no = np.cumsum(new_name) - 1
        copies = np.bincount(extent_no)[extent_no]
        extents = np.bincount(name_no[new_extent])[name_no]
        whole = (copies > 1) & (~new_extent if keep == "first" else True)
        look = new_extent & ((extents > 1) | again)
        return pd.concat([_runs_by_key(key[some], start[some], n[some], kind) for some, kind in ((whole, True), (look, False))])

    return run


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each run, one after another."""
    total = counts.sum()
    offsets = np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(starts, counts) + np.arange(total) - offsets


def _pack_windows(buckets: int, length: int):
    def run(frames):
        for frame in frames:
            runs = dict(zip(frame["key"].to_numpy(), frame["runs"]))
            for part in _chunks(frame):
                owners, starts, hashes = [], [], []
                for k, (key, _, text) in enumerate(part):
                    data = np.frombuffer(text, np.uint8)
                    prefix = prefix_hash(data)
                    _, down = powers(len(data) + 1)
                    own = _unpack_runs(runs[key])
                    at = _spread(own[:, 0], own[:, 1])
                    starts.append(at)
                    owners.append(np.full(len(at), k))
                    hashes.append(mix((prefix[at + length] - prefix[at]) * down[at]))
                owner, start, h = (np.concatenate(x) for x in (owners, starts, hashes))
                ids = np.array([(key, doc) for key, doc, _ in part], np.int64)
                rows = [(bucket, _pack_owner(o, ids), s.astype(np.uint32).tobytes(), x.tobytes(), b"")
                        for bucket, (o, s, x) in _rows_by_bucket(h, buckets, [owner, start, h], owner)]
                yield pd.DataFrame(rows, columns=["bucket", "keys", "places", "names", "extents"])

    return run


def longest_previous(lcp: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Longest-previous-factor array in suffix order: for each suffix the longest prefix that it
    shares with one of a smaller ``position``. ``lcp`` is that shared with the suffix before.

    The suffix of the longest one is the previous or the next with a smaller position in suffix
    order. Each side is walked from neighbour to neighbour's own smaller one, all suffixes at
    once, and no further than something is shared."""

    def one_side(lcp: np.ndarray, position: np.ndarray) -> np.ndarray:
        smaller, shared = np.arange(len(lcp)) - 1, lcp.copy()
        shared[:1] = 0
        going = np.flatnonzero(shared > 0)
        while len(going):
            going = going[position[smaller[going]] > position[going]]
            over = smaller[going]
            shared[going] = np.minimum(shared[going], shared[over])
            smaller[going] = smaller[over]
            going = going[shared[going] > 0]
        return shared

    before = one_side(lcp, position)
    after = one_side(np.r_[lcp[:1], lcp[1:][::-1]], position[::-1])[::-1]
    return np.maximum(before, after)


def _matching_windows(keep: str, length: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([np.frombuffer(b, np.uint64) for b in frame["names"]])
        start = np.concatenate([np.frombuffer(b, np.uint32) for b in frame["places"]]).astype(np.int64)
        key, doc = _unpack_owner(frame["keys"])
        del frame
        order = np.argsort(h, kind="stable")  # suffix order
        same = h[order][1:] == h[order][:-1]
        order = order[np.r_[False, same] | np.r_[same, False]]
        h, key, doc, start = h[order], key[order], doc[order], start[order]
        equal = np.r_[False, h[1:] == h[:-1]][:len(h)]
        lcp = np.where(equal, length, 0)
        position = np.empty(len(h), np.int64)
        position[np.lexsort((start, key, doc))] = np.arange(len(h))
        match = longest_previous(lcp, position)
        if keep == "none":  # a later one counts as well
            match = np.maximum(match, longest_previous(lcp, -position))
        hit = match >= length
        h, key, start = h[hit], key[hit], start[hit]
        order = np.lexsort((start, key))
        key, start = key[order], start[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (start[1:] > start[:-1] + 1)][:len(key)]
        at = np.flatnonzero(new)
        last = np.r_[at[1:], len(key)][:len(at)] - 1
        return _runs_by_key(key[at], start[at], start[last] - start[at] + 1, True)

    return run


def _cut(length: int, as_text: bool):
    """The rows of ``frames`` without the bytes of their windows in ``runs``; as text, without
    the rest of characters that were cut apart."""

    def run(frames):
        for frame in frames:
            kept, sizes, removed, spans = [], [], [], []
            for text, runs in zip(frame["text"], frame["runs"] if "runs" in frame else [None] * len(frame)):
                data = (text or "").encode("utf-8", "surrogatepass")
                pieces, end, gone, n_spans = [], 0, 0, 0
                if runs is not None and len(runs):
                    own = _unpack_runs(runs)
                    own = own[np.argsort(own[:, 0], kind="stable")]
                    reach = np.maximum.accumulate(own[:, 0] + own[:, 1] - 1 + length)
                    at = np.flatnonzero(np.r_[True, own[1:, 0] > reach[:-1]])
                    for start, stop in zip(own[at, 0].tolist(), reach[np.r_[at[1:], len(own)] - 1].tolist()):
                        pieces.append(data[end:start])
                        gone += stop - start
                        end = stop
                    n_spans = len(at)
                pieces.append(data[end:])
                left = b"".join(pieces)
                kept.append(left.decode("utf-8", "ignore") if as_text else left)
                sizes.append(len(data))
                removed.append(gone)
                spans.append(n_spans)
            out = frame.drop(columns=[c for c in ("runs", "key", "text") if c in frame])
            yield out.assign(**{"text" if as_text else "kept": kept}, n_bytes=sizes, n_removed=removed,
                             n_spans=spans)

    return run


def _in_filter(bloom, want: bool):
    def run(frames):
        for frame in frames:
            yield frame[bloom.has(frame["key"].to_numpy(np.int64).view(np.uint64)) == want]

    return run


def _in_turn(first, then):
    """Both on the rows of a task in one Python worker; a worker each holds a batch and its libraries twice."""

    def run(frames):
        return then(first(frames))

    return run


def remove_repeats(docs: DataFrame, length: int = 400, keep: str = "first", as_text: bool = False) -> DataFrame:
    """All columns of ``docs`` but ``text``, with kept (the remaining bytes; with ``as_text``
    the remaining text in its place), n_bytes, n_removed and n_spans (maximal removed runs)."""
    spark = docs.sparkSession
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(32, shuffle_partitions(spark), -(-n_bytes // BUCKET_BYTES))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"),
                        *([F.struct(*[F.col(f"`{c}`") for c in others]).alias("others")] if others else []))
    lean = keyed.select("doc_id", "text", "key")
    runs = materialise(lean.mapInPandas(_pack_runs(buckets, length), PACKED)
                       .groupBy("bucket").applyInPandas(_matching_runs(keep), RUNS), "suffix-runs")
    listed = F.collect_list("runs").alias("runs")
    look = runs.where("not whole")
    some = bloom_of(look, "key")
    texts = lean.mapInPandas(_in_filter(some, True), lean.schema).dropDuplicates(["key"]) if keep == "first" else \
        lean.mapInPandas(_in_filter(some, True), lean.schema)
    windows = materialise(
        texts.join(look.groupBy("key").agg(listed), "key")
        .mapInPandas(_pack_windows(buckets, length), PACKED)
        .groupBy("bucket").applyInPandas(_matching_windows(keep, length), RUNS), "suffix-windows")
    cuts = runs.where("whole").unionByName(windows).select("key", "runs")
    hit = bloom_of(cuts, "key")
    left = "text string" if as_text else "kept binary"
    out = ("doc_id long, " + (f"others {keyed.schema['others'].dataType.simpleString()}, " if others else "")
           + f"{left}, n_bytes long, n_removed long, n_spans long")
    plain = keyed.mapInPandas(_in_turn(_in_filter(hit, False), _cut(length, as_text)), out)
    touched = (keyed.mapInPandas(_in_filter(hit, True), keyed.schema)
               .join(cuts.groupBy("key").agg(listed), "key", "left").drop("key")
               .select("doc_id", *(["others"] if others else []), "text", "runs").mapInPandas(_cut(length, as_text), out))
    whole = plain.unionByName(touched)
    return whole.select("doc_id", *[F.col("others")[c].alias(c) for c in others], left.split()[0], "n_bytes", "n_removed", "n_spans")
