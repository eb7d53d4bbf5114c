"""One-permutation MinHash fingerprints against plain Python."""

import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shoprank.llm import fingerprints as fp
from shoprank.llm.fingerprints import BINS, BITS, edited, edited_fingerprints, fingerprints, fingerprints_of, likeness
from shoprank.llm.shingles import chunks, mix, shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_fingerprint(text):
    """Bin by bin, with the module's hashes and orders."""
    hashes = [int(h) for part in chunks([text]) for h in shingle_sets(part, 5)[1]]
    if not hashes:
        return b""
    least = {}
    for h in hashes:
        least[h >> 55] = min(h, least.get(h >> 55, h))
    out = []
    for k in range(BINS):
        donor = k if k in least else next(b for b in fp._orders()[k].tolist() if b in least)
        own = np.array([least[donor] ^ ((k + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)], np.uint64)
        out.append(int(mix(own)[0]) % (1 << BITS))
    return bytes(a << 4 | b for a, b in zip(out[0::2], out[1::2]))


def texts_of(n, seed=3):
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(5000)]
    base = [words[k] for k in rng.integers(0, 5000, 3000)]
    return [" ".join(base[:n]), " ".join(base[n // 4:n + n // 4]), " ".join(base[:n // 2] + ["x"] + base[n // 2:n])]


def test_fingerprints_equal_plain_ones_bin_by_bin(docs):
    texts = [r["text"] for r in docs.collect()] + texts_of(40) + texts_of(2000) + ["one", "a b c d e f"]
    assert fp._packed(fingerprints_of(texts)) == [plain_fingerprint(t) for t in texts]


def test_likeness_estimates_jaccard_likeness():
    for n, bound in ((6, 0.45), (60, 0.25), (600, 0.12), (2500, 0.12)):
        texts = texts_of(n)
        prints = fingerprints_of(texts)
        for a in range(3):
            for b in range(3):
                found = likeness(prints[a:a + 1], prints[b:b + 1])[0]
                assert abs(found - jaccard(texts[a], texts[b])) <= (0 if a == b else bound)
    errors = []
    for seed in range(60):
        a, b, _ = texts_of(800, seed)
        prints = fingerprints_of([a, b])
        errors.append(likeness(prints[:1], prints[1:])[0] - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.035  # unbiased


def test_edited_fingerprints_equal_brute_force(docs):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    h = {r["text"] or "": r["h"] for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, h[r[1]]))
    expected = Counter()
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        after = edited(text, following)
        assert after == text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        own, edit, other = (fingerprints_of([t]) for t in (text, after, following))
        expected[i, len(text), hashlib.sha256(after.encode()).hexdigest(), plain_fingerprint(text).hex(),
                 plain_fingerprint(after).hex(), likeness(own, edit)[0], likeness(own, other)[0]] += 1
    clashing = docs.withColumns({"h": F.lit(1), "place": F.lit("p"), "part": F.lit(2), "edge": F.lit(3), "own": F.lit("o")})
    for given in (docs, clashing, docs.repartition(1), docs.repartition(11)):
        assert Counter(map(tuple, edited_fingerprints(given).collect())) == expected
    plain = {(r["doc_id"], r["fingerprint"]) for r in fingerprints(docs).collect()}
    assert plain == {(i, f) for i, _, _, f, *_ in expected}


def test_one_row_empty_table_and_empty_texts(spark):
    schema = "doc_id long, text string"
    assert edited_fingerprints(spark.createDataFrame([], schema)).count() == 0
    assert fingerprints(spark.createDataFrame([], schema)).count() == 0
    one = edited_fingerprints(spark.createDataFrame([(1, "a b c d e f")], schema)).first()
    assert one["edited_sha256"] == hashlib.sha256(b"a b c a b c").hexdigest() and one["near_next"] == 1.0
    three = {r["doc_id"]: r for r in edited_fingerprints(spark.createDataFrame([(1, None), (2, ""), (3, "x y")], schema)).collect()}
    assert three[1]["fingerprint"] == three[2]["fingerprint"] == "" and three[1]["near_next"] == 1.0
    assert three[2]["near_next"] == 0.0 and three[2]["near_edited"] == 1.0


def test_a_very_long_text(spark):
    long = "word " * 400_000 + "end"
    found = {r["doc_id"]: r for r in edited_fingerprints(spark.createDataFrame([(1, long), (2, "few words")], "doc_id long, text string")).collect()}
    assert found[1]["n_chars"] == len(long) and found[1]["near_next"] < 0.06  # an estimate
    assert found[1]["edited_sha256"] == hashlib.sha256((long[:len(long) - len(long) // 2] + "few words").encode()).hexdigest()
