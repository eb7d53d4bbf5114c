"""Rows of the whole pipeline against plain Python, on hostile rows: shared and missing ids, copies,
near copies, repeated passages, leaks, nulls, empty and long texts, clashing column names."""

import random
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F
from test_operators import shingles

import corpus_pipeline as P
from shoprank.llm.quality import quality_report
from shoprank.llm.queries import tokenizer_path

NAMES = "doc_id long, text string, n_removed int, row_key string, n_chars long, hits int, `first` int"
VOCABULARY = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "r", "st", "l")]


def _sentences(dice, n):
    def one():
        words = [dice.choice(VOCABULARY) for _ in range(dice.randint(6, 12))] + ["the", "of", "and"]
        dice.shuffle(words)
        return " ".join(words).capitalize() + "."
    return " ".join(one() for _ in range(n))


def _fixture():
    dice = random.Random(7)
    base = [_sentences(dice, 12) for _ in range(8)]
    passage, leak = _sentences(dice, 8), _sentences(dice, 2)
    near = base[0].split(" ")
    near[40] = "changed"
    texts = [(10, base[0]), (3, base[0]), (11, " ".join(near)), (None, base[1]), (None, base[1]), (12, base[1]), (None, base[2]),
             (20, base[3]), (20, f"{base[4]} {leak}"), (None, f"{base[5]} {leak} {_sentences(dice, 3)}"),
             (30, f"{_sentences(dice, 9)}\n{passage}\n{_sentences(dice, 9)}"), (31, f"{_sentences(dice, 9)}\n{passage}\n{_sentences(dice, 9)}"),
             (40, None), (41, ""), (42, "few words"), (43, _sentences(dice, 900)), (43, base[6]), (44, base[7]), (44, base[7])]
    return texts, [(1, leak), (2, None), (3, "")]


def _near(rows):
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    sets, kept, group = [shingles(t) for _, t in rows], [], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 75 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    for k, row in enumerate(rows):
        if group.index(group[k]) == k:
            kept.append(row)
    return kept


def _passages(rows, length):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    seen, out = set(), []
    for doc, text in rows:
        data, gone = text.encode(), set()
        for k in range(len(data) - length + 1):
            if data[k:k + length] in seen:
                gone.update(range(k, k + length))
            seen.add(data[k:k + length])
        left = bytes(c for k, c in enumerate(data) if k not in gone).decode()
        if not gone or left.strip(" "):
            out.append((doc, left))
    return out


def test_run_equals_plain_python(spark, tmp_path):
    from tokenizers import Tokenizer

    texts, items = _fixture()
    rows = [(i, t, k % 3, "k", len(t or ""), 1, 2) for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, NAMES)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    good = {(r["doc_id"], r["n_words"]) for r in quality_report(docs).where("kept").collect()}
    kept = [(i, t) for i, t in texts if (i, len((t or "").split())) in good]
    assert {i for i, _ in texts} - {i for i, _ in kept} == {40, 41, 42}
    rows = {name: [(r["doc_id"], r["text"]) for r in _run_to(spark, str(tmp_path), k).collect()] for k, (name, _) in enumerate(P.STAGES[:4])}
    expected = kept
    for (name, _), plain in zip(P.STAGES, (lambda x: x, _near, lambda x: _passages(x, P.PASSAGE_BYTES),
                                           lambda x: [r for r in x if items[0][1] not in r[1]])):
        expected = plain(expected)
        assert Counter(rows[name]) == Counter(expected), name
    tokenizer, pieces = Tokenizer.from_file(tokenizer_path()), Counter()
    for i, text in expected:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            own = ids[at:at + 4096]
            pieces[i, piece, at, len(own), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own))] += 1
    packed = P.run(spark, str(tmp_path)).collect()
    assert Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in packed) == pieces
    ends = defaultdict(int)
    for p in sorted(packed, key=lambda p: p["offset"]):
        assert ends[p["sequence_id"]] == p["offset"]
        ends[p["sequence_id"]] += p["length"]
    assert max(ends.values()) <= 4096


def _run_to(spark, sf_dir, last):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in P.STAGES[:last + 1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        docs = out
    return docs


def test_empty_tables_go_through(spark, tmp_path):
    spark.createDataFrame([], NAMES).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).where(F.lit(True)).count() == 0
