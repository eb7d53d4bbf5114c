"""Word shingles of many texts at once, hashed in NumPy.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a shingle is ``width`` consecutive
words, or the whole sequence of a text with fewer words. Words and shingles are 64-bit
polynomial hashes, computed over the bytes of a whole chunk of texts without a Python loop
over words. Shingles never cross a text's end."""

from __future__ import annotations

import numpy as np

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
BASE = 0x9E3779B97F4A7C15 | 1
BYTES_PER_CHUNK = 500_000

_rng = np.random.default_rng(20240607)
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i mod 2**64 for i < n, kept between calls."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            factor = np.full(size, base, np.uint64)
            factor[0] = 1
            _powers[k] = np.multiply.accumulate(factor)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of BYTE_VALUE[data[k]] * BASE**k for i <= k < j."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[:-1], out=out[1:])
    return out


def chunks(texts, limit: int = BYTES_PER_CHUNK):
    """Lists of (index, lower-cased bytes) with at most ``limit`` bytes, or one long text."""
    part, size = [], 0
    for k, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass").translate(LOWER)
        if part and size + len(data) > limit:
            yield part
            part, size = [], 0
        part.append((k, data))
        size += len(data) + 1
    if part:
        yield part


def shingle_sets(part, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in ``part``, shingle hash) sorted and distinct, and the set sizes of ``part``."""
    joined = b" ".join(data for _, data in part) + b" "
    data = np.frombuffer(joined, np.uint8)
    ends_at = np.cumsum([len(d) + 1 for _, d in part])
    space = IS_SPACE[data]
    before = np.concatenate(([True], space[:-1]))
    starts = np.flatnonzero(~space & before)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(part), np.int64)
    ends = np.flatnonzero(space & ~before)
    prefix = prefix_hash(data)
    _, down = powers(len(data) + 1)
    words = mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    owner = np.searchsorted(ends_at, starts, side="right")
    n_words = np.bincount(owner, minlength=len(part))
    first = np.concatenate(([0], np.cumsum(n_words)))[:-1]
    up = [np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64)) for i in range(width)]

    def hashed(at: np.ndarray, k: int) -> np.ndarray:
        total = np.full(len(at), np.uint64(k))
        for i in range(k):
            total += words[at + i] * up[i]
        return mix(total)

    places, hashes = [], []
    long_enough = n_words[owner] - (np.arange(len(owner)) - first[owner]) >= width
    at = np.flatnonzero(long_enough)
    places.append(owner[at])
    hashes.append(hashed(at, width))
    for k in range(1, width):
        short = np.flatnonzero(n_words == k)
        places.append(short)
        hashes.append(hashed(first[short], k))
    place, h = np.concatenate(places), np.concatenate(hashes)
    order = np.lexsort((h, place))
    place, h = place[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (place[1:] != place[:-1]) | (h[1:] != h[:-1])
    place, h = place[new], h[new]
    return place, h, np.bincount(place, minlength=len(part))
