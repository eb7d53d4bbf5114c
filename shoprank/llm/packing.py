"""Best-fit packing: documents into sequences of at most ``capacity`` tokens.

Texts are tokenized once; longer documents are cut into pieces of ``capacity``, all others
stay whole. Pieces of full length are sequences of their own. The rest is dealt by hash to
packers of a bounded number of tokens, and every packer runs bounded-space online best-fit
over its stream: a fixed number of open bins, kept in a bitset keyed by free space. A piece
goes to the open bin whose free space fits it best; if none fits, a new bin is opened, and
when all are in use the fullest closes first. A packer holds open bins only, whatever the
length of its stream. Few bins are open against the sequences of a packer, so closing is the
rule. The stream is a number of runs dealt by hash, each from the longest piece to the shortest
(Spark's sort): in every run short pieces fill what long ones leave, before it closes.

Null texts are empty: one piece with the end token alone. Rows that repeat an id are packed
each; null ids are carried along; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprank.session import materialise

from .shingles import LOWER

#: Open bins of a packer; a fixed number, far below the sequences it fills.
OPEN_BINS = 128
#: Runs of falling length in the stream of a packer.
RUNS = 16
#: Sequences that one packer fills, about; more tokens mean more packers.
SEQUENCES_PER_PACKER = 2048

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, spread long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

#: Spaces and line ends part words for the tokenizer; A-Z are lower-cased by it.
_PARTED = bytes(32 if c == 10 else LOWER[c] for c in range(256))


#: A word that ends in ASCII punctuation after an ASCII letter or digit.
_TAIL = re.compile(rb"(.*[a-z0-9])([^a-z0-9\x80-\xff]+)", re.S)


class WordIds(dict):
    """Token ids (little-endian bytes) by word. Only for tokenizers that part words at white
    space, part punctuation from a letter or digit before it, and lower-case: then the ids of a
    text are those of its words, and those of a word the ones of its front and its tail."""

    LONGEST, MOST = 64, 600_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__({b"": b""})
        self.tokenizer = Tokenizer.from_file(path)

    def of(self, texts) -> list[bytes]:
        parted = [(t or "").encode("utf-8", "replace").translate(_PARTED).split(b" ") for t in texts]
        missing = {w for words in parted for w in words if w not in self}
        halves = {w: m.groups() for w in missing if (m := _TAIL.fullmatch(w))}
        coded = list({x for w in missing for x in halves.get(w, (w,)) if x not in self})
        more = {}

        def keep(word, ids):
            (self if len(word) <= self.LONGEST else more)[word] = ids

        for lo in range(0, len(coded), 20_000):
            part = coded[lo:lo + 20_000]
            found = self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            for word, code in zip(part, found):
                ids = code.ids
                keep(word, struct.pack(f"<{len(ids)}I", *ids))
        for word, own in halves.items():
            keep(word, b"".join([self[x] if x in self else more[x] for x in own]))
        out = [b"".join([self[w] if w in self else more[w] for w in words]) if more else
               b"".join(map(self.__getitem__, words)) for words in parted]
        if len(self) > self.MOST:
            self.clear()
            self[b""] = b""
        return out


#: One vocabulary for all tasks of a Python worker; WordIds.MOST bounds it.
_WORDS: dict[str, WordIds] = {}


def _words(path: str) -> WordIds:
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def _tokenized(path: str, capacity: int, end_id: int):
    def run(frames):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = _words(path)
        end = np.uint32(end_id).tobytes()
        for frame in frames:
            for lo in range(0, len(frame), 500):
                part = frame.iloc[lo:lo + 500]
                rows = []
                for doc, ids in zip(part["doc_id"], words.of(part["text"])):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), capacity * 4)):
                        own = ids[at:at + capacity * 4]
                        rows.append((doc, piece, at // 4, len(own) // 4, zlib.crc32(own)))
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out.assign(spread=out["ids_crc32"].to_numpy() * 0x9E3779B1 + out["length"].to_numpy())

    return run


class OpenBins:
    """A fixed number of open bins in a bitset keyed by free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.count = 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        own = self.by_free[free]
        bin_id = own.pop()
        if not own:
            self.bits &= ~(1 << free)
        self.count -= 1
        return bin_id

    def place(self, length: int, new_id: int) -> tuple[int, int, bool]:
        """(bin, offset, whether it is new) for a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            bin_id, new = self._take(free), False
        else:
            free, bin_id, new = self.capacity, new_id, True
            if self.count >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
        left = free - length
        if left:
            self.by_free[left].append(bin_id)
            self.bits |= 1 << left
            self.count += 1
        return bin_id, self.capacity - free, new


def _packed(capacity: int, open_bins: int):
    def run(frames):
        packer, bins, opened = None, None, 0
        for frame in frames:
            ids, offsets = [], []
            for own, length in zip(frame["packer"].tolist(), frame["length"].tolist()):
                if own != packer:
                    packer, bins, opened = own, OpenBins(capacity, open_bins), 0
                bin_id, offset, new = bins.place(length, (own << 32) + opened)
                opened += new
                ids.append(bin_id)
                offsets.append(offset)
            yield frame.drop(columns=["packer"]).assign(sequence_id=ids, offset=offsets)

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
         open_bins: int = OPEN_BINS) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = materialise(docs.select("doc_id", "text").mapInPandas(
        _tokenized(tokenizer_path, capacity, end_id), PIECES), "packing-pieces")
    rest = pieces.where(F.col("length") < capacity)
    tokens = rest.agg(F.sum("length")).first()[0] or 0
    packers = max(1, round(tokens / (capacity * SEQUENCES_PER_PACKER)))
    mixed = F.xxhash64("spread", "doc_id", "piece")
    dealt = (rest.withColumn("packer", F.pmod(mixed, F.lit(packers)))
             .withColumn("run", F.pmod(F.xxhash64(F.lit(RUNS), "spread", "doc_id", "piece"), F.lit(RUNS)))
             .repartition(packers, "packer").sortWithinPartitions("packer", "run", F.desc("length"), "spread", "doc_id")
             .select("doc_id", "piece", "start", "length", "ids_crc32", "packer"))
    packed = dealt.mapInPandas(_packed(capacity, open_bins), PACKED)
    full = pieces.where(F.col("length") == capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.monotonically_increasing_id() + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)
