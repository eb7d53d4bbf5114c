"""Benchmark decontamination by template canonicalisation.

Texts become canonical words: numbers, units after a number and names (capitalised words
inside a sentence) turn into typed placeholders, all other words are lower-cased. Windows of
canonical words of the documents are hash-joined with those of the benchmark items; a filter
of fixed size over the benchmark's windows keeps all others from leaving their task.
Matches of one document and item on one diagonal form a run. A run counts as a leak when it
covers ``min_run`` words of the item (or all of a shorter one) and its slots are consistent:
equal values in the item stand for equal values in the document, and different ones for
different ones. So verbatim copies are found, and questions with other numbers, names and
units as well.

Windows of which more than half the words are slots say nothing as templates. So every window
is also hashed by its literal lower-cased words, slots by value; items and windows of any
share of slots are found this way when their words are copied. Items of fewer than
``MIN_ITEM`` words are looked for by their literal words only, as a whole: one of a single
word is leaked by every text with that word. In scripts without spaces (Chinese, Japanese,
Thai, Lao, Burmese, Khmer) each character is a word, so windows are character n-grams.

A third template folds runs of capitalised words, those at sentence starts included, into one
name each, so that other names of another number of words, and names that start a sentence, are
found on one diagonal. It serves items of at least ``MIN_TOTAL`` folded words. Items of at most
twice the window's width have windows of ``SHORT_WIDTH`` words; with a word changed in the
middle the matched words of both sides count together (``MIN_TOTAL``, ``SHARE`` of the item).

Null texts are empty and match nothing. Items without a word are not searched. Rows equal in
id and text count once; null ids are carried along; other columns are ignored; empty tables
give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprank.session import materialise

from .common import Bloom, bloom_of
from .shingles import BYTES_PER_CHUNK, LOWER, mix, powers, prefix_hash

WIDTH = 8
SHORT_WIDTH = 6
MIN_ITEM = 5
MIN_RUN = 13
#: Matched words of a diagonal, and their share of the item, that count without one long run.
MIN_TOTAL = 9
SHARE = 0.6
#: Share of slots that must agree with the mapping of the run.
CONSISTENT = 0.8

#: Units of measure that follow a number.
UNITS = ("mm cm m km in ft yd mi mg g kg t lb oz ml l s ms min h hr hrs day days week weeks month months year years "
         "hour hours minute minutes second seconds meter meters metre metres kilometer kilometers mile miles gram grams "
         "kilogram kilograms liter liters litre litres dollar dollars euro euros cent cents percent degree degrees "
         "inch inches foot feet kmh mph kwh w kw mw v hz khz mhz ghz kb mb gb tb usd eur gbp").split()

NUMBER, NAME, UNIT = (np.uint64(x) for x in (11, 12, 13))

#: Part the hashes of the three kinds of windows.
CANONICAL, LITERAL, FOLDED = 0, 1 << 32, 1 << 33

#: Empty slots are those of a literal window: the item's own.
WINDOWS = "place int, width int, hash long, slots binary"


def _word_hash(words) -> np.ndarray:
    out = []
    for word in words:
        data = np.frombuffer(word.encode(), np.uint8)
        prefix = prefix_hash(data)
        out.append((prefix[-1:] + np.uint64(len(data)))[0])
    return mix(np.array(out, np.uint64))


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after) of the characters of scripts without spaces, and the first
    bytes of their punctuation."""
    lead = np.flatnonzero(data >= 0xE0)
    lead = lead[lead + 2 < len(data)]
    one, two, three = data[lead], data[lead + 1], data[lead + 2]
    mark = ((one == 0xE3) & (two == 0x80)) | ((one == 0xEF) & (two == 0xBC) & ((three <= 0x8F) | ((three >= 0x9A) & (three <= 0xA0))))
    alone = (((one == 0xE0) & (two >= 0xB8) & (two <= 0xBB)) | ((one == 0xE1) & ((two <= 0x82) | (two == 0x9E) | (two == 0x9F)))
             | ((one == 0xE3) & (two >= 0x81)) | ((one >= 0xE4) & (one <= 0xE9)) | ((one == 0xEF) & (two >= 0xA4) & (two <= 0xAB))
             | ((one == 0xF0) & (two >= 0xA0) & (two <= 0xBF)))
    return lead[alone], lead[alone] + np.where(one[alone] == 0xF0, 4, 3), lead[mark]


def canonical(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(canonical word, slot value or 0, text number, literal word, whether it is capitalised
    and no unit, whether only blanks part it from the word before) of every word of the texts."""
    parts, low = [], []
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        lower = (text or "").lower().encode("utf-8", "surrogatepass")
        parts.append(raw + b"\n")
        low.append((lower if len(lower) == len(raw) else raw.translate(LOWER)) + b"\n")
    data, lowered = (np.frombuffer(b"".join(x), np.uint8) for x in (parts, low))
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, bool)
    ends_at = np.cumsum([len(p) for p in parts])
    digit = (data >= 48) & (data <= 57)
    inner = np.zeros(len(data), bool)  # a point or comma inside a number
    inner[1:-1] = ((data[1:-1] == 46) | (data[1:-1] == 44)) & digit[:-2] & digit[2:]
    letter = ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122)) | (data >= 128)
    kind = letter.astype(np.int8) + 2 * (digit | inner)
    alone, behind, marks = _unspaced(data)
    for k in range(3):
        kind[marks + k] = 0
    change = np.ones(len(data), bool)
    change[1:] = kind[1:] != kind[:-1]
    change[alone] = True
    change[behind[behind < len(data)]] = True
    starts = np.flatnonzero(change & (kind > 0))
    edges = np.flatnonzero(change)
    stops = np.r_[edges, len(data)][np.searchsorted(edges, starts) + 1]
    prefix = prefix_hash(lowered)
    _, down = powers(len(data) + 1)
    words = mix((prefix[stops] - prefix[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    owner = np.searchsorted(ends_at, starts, side="right")
    number = kind[starts] == 2
    unit = np.zeros(len(starts), bool)
    unit[1:] = number[:-1] & ~number[1:] & (owner[1:] == owner[:-1]) & np.isin(words[1:], UNIT_HASHES)
    upper = (data[starts] >= 65) & (data[starts] <= 90)
    second = data[np.minimum(starts + 1, len(data) - 1)]
    upper |= (data[starts] == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    blank = (data == 32) | (data == 9)
    last = np.maximum.accumulate(np.where(blank, -1, np.arange(len(data))))
    before = np.where(starts > 0, data[np.maximum(last[np.maximum(starts - 1, 0)], 0)], 10)
    inside = np.isin(before, SENTENCE_END, invert=True)
    name = upper & inside & ~number & ~unit
    slot = number | unit | name
    out = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, words)))
    blanks = np.concatenate(([0], np.cumsum(blank)))
    beside = np.zeros(len(starts), bool)
    gap = starts[1:] - stops[:-1]
    beside[1:] = (gap > 0) & (blanks[starts[1:]] - blanks[stops[:-1]] == gap)
    return out, np.where(slot, words, np.uint64(0)), owner, words, upper & ~number & ~unit, beside


def folded(words, slots, owner, plain, capital, beside):
    """(word, slot value or 0, text number) with each run of capitalised words as one name."""
    if not len(words):
        return words, slots, owner
    inner = np.zeros(len(words), bool)
    inner[1:] = capital[1:] & capital[:-1] & beside[1:]
    first = np.flatnonzero(~inner)
    within = np.arange(len(words)) - first[np.cumsum(~inner) - 1]
    value = np.add.reduceat(mix(plain + within.astype(np.uint64)), first) | np.uint64(1)
    name = capital[first]
    return np.where(name, NAME, words[first]), np.where(name, value, slots[first]), owner[first]


SENTENCE_END = np.frombuffer(b".!?:;\n\r\"()[]{}>|*#-\x0b\x0c", np.uint8)
UNIT_HASHES = _word_hash(UNITS)


def windows(words, slots, owner, width: int, kind: int = CANONICAL):
    """(first word, hash) of the windows of ``width`` canonical or folded words with enough plain
    ones, or of all windows of literal words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(width + kind))
    for i in range(width):
        total += words[i:i + n] * np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64))
    filled = np.concatenate(([0], np.cumsum(slots != 0)))
    good = (owner[:n] == owner[width - 1:]) & ((kind == LITERAL) | ((filled[width:] - filled[:-width]) * 2 <= width))
    at = np.flatnonzero(good)
    return at, mix(total[at])


def width_of(n_words: int, width: int) -> int:
    return width if n_words > 2 * width else min(n_words, width, SHORT_WIDTH)


def _item_windows(width: int):
    def run(frames):
        for frame in frames:
            rows = []
            for item, text in zip(frame["item_id"], frame["text"]):
                words, slots, owner, plain, *case = canonical([text])
                if not len(words):
                    continue
                own = width_of(len(words), width)
                found = [(LITERAL, plain, slots, own)]
                if own >= MIN_ITEM:
                    found.append((CANONICAL, words, slots, own))
                names, name_slots, name_owner = folded(words, slots, owner, plain, *case)
                if len(names) >= MIN_TOTAL:
                    found.append((FOLDED, names, name_slots, width_of(len(names), width)))
                for kind, units, values, own in found:
                    for place, x in zip(*windows(units, values, np.zeros(len(units)), own, kind)):
                        rows.append((item, len(units), place, own, x.astype(np.int64), values[place:place + own].tobytes(), kind == FOLDED))
            out = pd.DataFrame(rows, columns=["item_id", "n_words", "place", "width", "hash", "slots", "folded"])
            yield out.assign(item_id=out["item_id"].astype("Int64"))

    return run


def _document_windows(bloom: Bloom, widths: list[int], limit: int = BYTES_PER_CHUNK):
    def batches(frame):
        size, lo = 0, 0
        for k, text in enumerate(frame["text"]):
            own = len(text or "")
            if k > lo and size + own > limit:
                yield frame.iloc[lo:k]
                lo, size = k, 0
            size += own
        yield frame.iloc[lo:]

    wanted = [(kind, w) for w in widths for kind, least in ((LITERAL, 1), (CANONICAL, MIN_ITEM), (FOLDED, SHORT_WIDTH)) if w >= least]

    def run(frames):
        for frame in frames:
            for part in batches(frame):
                words, slots, owner, plain, *case = canonical(part["text"])
                kinds = {LITERAL: (plain, slots, owner), CANONICAL: (words, slots, owner),
                         FOLDED: folded(words, slots, owner, plain, *case)}
                out = []
                for kind, width in wanted:
                    units, values, of = kinds[kind]
                    first = np.searchsorted(of, np.arange(len(part)))
                    at, h = windows(units, values, of, width, kind)
                    hit = bloom.has(h)
                    at, h = at[hit], h[hit]
                    if width < MIN_ITEM:  # a whole item: once a text will do
                        once = np.unique(np.stack([of[at], h.view(np.int64)]), axis=1, return_index=True)[1]
                        at, h = at[once], h[once]
                    out.append(pd.DataFrame({
                        "doc_id": part["doc_id"].iloc[of[at]].astype("Int64").to_numpy(), "key": part["key"].to_numpy()[of[at]],
                        "place": at - first[of[at]], "width": width, "hash": h.view(np.int64),
                        "slots": [b"" if kind == LITERAL else values[a:a + width].tobytes() for a in at]}))
                yield pd.concat(out)

    return run


def _consistent(own: np.ndarray, theirs: np.ndarray) -> bool:
    """Whether enough slots follow a one-to-one mapping of values."""
    pairs = {}
    for x, y in zip(own.tolist(), theirs.tolist()):
        pairs[(x, y)] = pairs.get((x, y), 0) + 1
    fits, to, of = 0, {}, {}
    for (x, y), count in sorted(pairs.items(), key=lambda p: -p[1]):
        if to.setdefault(x, y) == y and of.setdefault(y, x) == x:
            fits += count
    return fits >= CONSISTENT * len(own)


def _judge(min_run: int):
    """Of each diagonal: the longest run of item words that match, or else all that match, and
    their slots."""

    def run(frames):
        for frame in frames:
            rows = []
            for doc, item, n_words, hits in zip(frame["doc_id"], frame["item_id"], frame["n_words"], frame["hits"]):
                covered = np.zeros(n_words, bool)
                own, theirs = np.zeros(n_words, np.uint64), np.zeros(n_words, np.uint64)
                for hit in hits:
                    at, width = hit["at"], hit["width"]
                    covered[at:at + width] = True
                    own[at:at + width] = np.frombuffer(hit["item_slots"], np.uint64)
                    theirs[at:at + width] = np.frombuffer(hit["doc_slots"] or hit["item_slots"], np.uint64)
                edges = np.flatnonzero(np.diff(np.r_[0, covered.astype(np.int8), 0]))
                lo, hi = max(zip(edges[::2], edges[1::2]), key=lambda x: x[1] - x[0])
                total = np.flatnonzero(covered)
                judged = [np.arange(lo, hi)] if hi - lo >= min(min_run, n_words) else []
                if len(total) >= max(MIN_TOTAL, SHARE * n_words):
                    judged.append(total)
                for places in judged:
                    filled = places[own[places] != 0]
                    a, b = own[filled], theirs[filled]
                    if _consistent(a, b):
                        rows.append((doc, item, len(places), int(n_words), len(filled), int((a != b).sum())))
                        break
            out = pd.DataFrame(rows, columns=["doc_id", "item_id", "n_matched", "n_words", "n_slots", "n_changed"])
            yield out.assign(doc_id=out["doc_id"].astype("Int64"), item_id=out["item_id"].astype("Int64"))

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, min_run: int = MIN_RUN) -> DataFrame:
    """A row for each document (doc_id, text) and item (item_id, text) that it leaks: doc_id,
    item_id, n_matched (words of the longest run, or of all), n_words (of the item; folded ones if
    these match best), n_slots, n_changed
    (slots with another value than in the item)."""
    items = materialise(benchmark.select("item_id", "text").dropDuplicates().mapInPandas(
        _item_windows(width), "item_id long, n_words int, " + WINDOWS + ", folded boolean"), "leak-items")
    widths = sorted(r[0] for r in items.select("width").distinct().collect())
    found = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")).mapInPandas(
        _document_windows(bloom_of(items, "hash"), widths), "doc_id long, key long, " + WINDOWS)
    found = materialise(found, "leak-windows").distinct()
    item_side = items.select("hash", "width", "item_id", "n_words", "folded", F.col("place").alias("at"), F.col("slots").alias("item_slots"))
    hits = found.withColumnRenamed("slots", "doc_slots").join(item_side, ["hash", "width"])
    runs = (hits.groupBy("key", "doc_id", "item_id", "n_words", "folded", (F.col("place") - F.col("at")).alias("diagonal"))
            .agg(F.collect_list(F.struct("at", "width", "item_slots", "doc_slots")).alias("hits")))
    judged = runs.select("doc_id", "item_id", "n_words", "hits").mapInPandas(
        _judge(min_run), "doc_id long, item_id long, n_matched int, n_words int, n_slots int, n_changed int")
    return (judged.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_matched", "n_words", "n_slots", "n_changed")).alias("best"))
            .select("doc_id", "item_id", "best.*"))
