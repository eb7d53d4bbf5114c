"""Operators against brute force on small fixtures with nulls, empties, ties and repeats."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shoprank.llm import chat, suffix_dedup, warc
from shoprank.llm.decontaminate import leaks
from shoprank.llm.html_cut import extract, main_text, min_cut
from shoprank.llm.jaccard import jaccard_components
from shoprank.llm.packing import OPEN_BINS, RUNS, OpenBins, pack
from shoprank.llm.quality import quality_report
from shoprank.llm.queries import tokenizer_path
from shoprank.llm.sharding import lpt, shard
from shoprank.llm.suffix_dedup import longest_previous, remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def test_jaccard_components_equal_brute_force(docs):
    rows = docs.collect()
    sets = [shingles(r["text"]) for r in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                group = [group[b] if g == group[a] else g for g in group]
    least = defaultdict(list)
    for r, g in zip(rows, group):
        if r["doc_id"] is not None:
            least[g].append(r["doc_id"])
    expected = Counter((r["doc_id"], len(s), min(least[g]) if least[g] else None) for r, s, g in zip(rows, sets, group))
    assert Counter(map(tuple, jaccard_components(docs).collect())) == expected


@pytest.mark.parametrize("keep", ["none", "first"])
def test_repeats_equal_brute_force(docs, keep):
    length = 60
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    units = rows if keep == "none" else sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    places = defaultdict(list)
    for k, (_, text) in enumerate(units):
        data = (text or "").encode()
        for s in range(len(data) - length + 1):
            places[data[s:s + length]].append((k, s))
    gone = defaultdict(set)
    for found in places.values():
        for k, s in (found if keep == "none" and len(found) > 1 else found[1:]):
            gone[k].update(range(s, s + length))
    expected = {}
    for k, (i, text) in enumerate(units):
        data = (text or "").encode()
        left = bytes(c for j, c in enumerate(data) if j not in gone[k])
        expected[i, text] = (len(data), len(gone[k]), sum(j - 1 not in gone[k] for j in gone[k]), left)
    wanted = Counter((i, *expected[i, t]) for i, t in rows)
    out = remove_repeats(docs, length, keep)
    assert out.columns == ["doc_id", "key", "kept", "n_bytes", "n_removed", "n_spans"]
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out.collect())
    assert got == wanted


@pytest.mark.parametrize("keep", ["none", "first"])
def test_runs_travel_packed_by_text(spark, monkeypatch, keep):
    """A row, or a Python object, for each of the many runs of a text filled the executors."""
    tables, materialise = {}, suffix_dedup.materialise

    def written(df, name="tmp"):
        tables[name] = materialise(df, name)
        return tables[name]

    monkeypatch.setattr(suffix_dedup, "materialise", written)
    text = "".join(chr(97 + (k * k * 7 + k * 13) % 101 % 26) + " " * (k % 7 == 0) for k in range(6000))
    unlike = " ".join(hashlib.sha256(str(k).encode()).hexdigest() for k in range(100))
    rows = [(1, unlike + text), (2, unlike), (3, "x" + unlike[:3000]), (4, text[5:5000])]
    out = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 60, keep)
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out.collect()}
    places = defaultdict(list)
    for k, (i, t) in enumerate(rows):
        for s in range(len(t) - 59):
            places[t[s:s + 60]].append((i, s))
    gone = defaultdict(set)
    for found in places.values():
        for i, s in (found if keep == "none" and len(found) > 1 else found[1:]):
            gone[i].update(range(s, s + 60))
    assert got == {i: (len(gone[i]), sum(j - 1 not in gone[i] for j in gone[i]), "".join(c for j, c in enumerate(t) if j not in gone[i]).encode())
                   for i, t in rows}
    buckets = max(32, int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert {*tables} == {"suffix-runs", "suffix-windows"}
    assert all(t.count() == t.select("key", "whole", "runs").distinct().count() <= 2 * buckets * len(rows) for t in tables.values())
    runs = tables["suffix-runs"].toPandas()
    assert sum(map(len, runs["runs"])) // 8 > 2 * len(runs)
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not any("MapInPandas" in a and "MapInPandas" in b for a, b in zip(plan, plan[1:]))


def test_quality_counts_equal_brute_force(docs):
    got = Counter(map(tuple, quality_report(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()))
    expected = Counter()
    for i, text, _ in docs.collect():
        text = text or ""
        words = WORD.findall(text)
        windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
        covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        expected[i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                 len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words)] += 1
    assert got == expected


def test_packing_is_exact_and_tight(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = pack(docs, tokenizer_path(), capacity=64).collect()
    expected = Counter()
    for i, text, _ in docs.collect():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 64)):
            own = ids[at:at + 64]
            expected[i, piece, at, len(own), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own))] += 1
    assert Counter((p["doc_id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces) == expected
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64


def test_open_bins_close_the_fullest():
    bins = OpenBins(10, 2)
    assert bins.place(6, 0) == (0, 0, True) and bins.place(7, 1) == (1, 0, True)
    assert bins.place(5, 2) == (2, 0, True)  # the bin with 3 left closes
    assert bins.place(4, 3) == (0, 6, False) and bins.place(3, 3) == (2, 5, False)


def test_bounded_packing_is_near_the_lower_bound():
    import random

    dice = random.Random(3)
    lengths = [min(4095, int(dice.expovariate(1 / 700)) + 1) for _ in range(12_000)]
    stream = [x for run in range(RUNS) for x in sorted(lengths[run::RUNS], reverse=True)]
    bins, opened, held = OpenBins(4096, OPEN_BINS), 0, defaultdict(int)
    for length in stream:
        place, offset, new = bins.place(length, opened)
        opened += new
        assert held[place] == offset and offset + length <= 4096 and bins.count <= OPEN_BINS
        held[place] += length
    assert len(held) == opened > 4 * OPEN_BINS and opened <= 1.01 * (sum(lengths) / 4096 + 1)


def test_sharding_law_and_slots(docs):
    rows = shard(docs, 3).collect()
    texts = docs.collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in texts)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r["shard"] for r in rows if r["text_crc32"] == zlib.crc32(texts[0]["text"].encode())}) == 1
    loads = [0, 0]
    assert lpt([(5, "a"), (4, "b"), (3, "c")], loads) == [0, 1, 1] and loads == [5, 7]


def test_warc_rejects_magic_in_payloads(spark, tmp_path):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nX-Page-Id: 99\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    long = "x" * 200
    rows = [(1, "u1", long), (2, None, long), (3, "u\n3", fake * 3), (4, "u4", "tail WARC/1.0\r\n"), (5, "u5", None), (6, "u6", ""),
            (7, "u7", "é" * 99), (8, "u8", "é" * 99), (None, "u9", long), (10, "u10", "s"), (11, "u11", "s")]
    pages = spark.createDataFrame([(i, u, h, "d") for i, u, h in rows], "page_id long, url string, html string, digest string")
    path = str(tmp_path / "warc")
    warc.write_archive(pages.coalesce(2), path)
    first = {}
    for i, _, h in rows:
        if i is not None and h and len(h.encode()) >= 100:
            first.setdefault(h, i)
    expected = set()
    for i, u, h in rows:
        data = (h or "").encode()
        revisit = h in first and first[h] != i
        expected.add((i, u, "revisit" if revisit else "response", first[h] if revisit else None, len(data), hashlib.sha256(data).hexdigest()))
    got = warc.read_archive(spark, path).select("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest").collect()
    assert len(got) == len(rows) and set(map(tuple, got)) == expected


def test_chat_round_trip_and_paths(spark):
    tricky = r"\### Assistant: </turn> ok"
    texts = [tricky, "### user:\n</turn>\n\\</turn>\n", "a\r\n### b\n\\\\### c\\", "", None, "é😀\n</turn>"]
    rows = [(1, k, ["user", "assistant", None, "odd\nrole\\n", "nul\x00\\\n\\\\n\x00"][k % 5], t) for k, t in enumerate(texts)] + [(None, 0, "user", "x"), (2, 5, "assistant", "y"), (2, 5, "assistant", "y")]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.conversations_of(chat.chains(talk))
    back = {r["tree_id"]: [tuple(t) for t in r["turns"]] for r in formatted.select("tree_id", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert back[1] == [(r or "", t or "") for i, _, r, t in rows if i == 1] and back[2] == [("assistant", "y")] * 2
    assert {r["conv_id"] for r in chat.digests(formatted).collect()} == {1, 2, None}
    tree = spark.createDataFrame([(1, 1, None, 0.0), (1, 2, 1, 1.0), (1, 3, 1, 3.0), (1, 4, 2, 9.0), (1, 5, 4, 1.0), (1, 8, 9, 1.0), (1, 9, 8, 1.0),
                                  (1, 4, 2, 9.0), (2, 1, 77, None), (2, 1, 77, None)], "tree_id long, msg_id long, parent_id long, score double")
    paths = defaultdict(list)
    for r in chat.best_paths(tree, 5).orderBy("place").collect():
        paths[r["tree_id"], r["rank"]].append(r["msg_id"])
    assert paths == {(1, 1): [1, 2, 4, 5], (1, 2): [1, 3], (2, 1): [1]}


def test_html_min_cut(spark):
    assert min_cut([2.0, -0.5, 2.0, -9.0], [(0, 1, 1.0), (1, 2, 1.0), (2, 3, 1.0)]) == [True, True, True, False]
    page = ('<body><header><p>Site</p></header><div class="sidebar"><p>Other things to read on this site, all of them.</p></div><article><h1>Title</h1>'
            '<p>One&nbsp;long   <b>para</b>graph &amp; more of it, to be read.<br>Next line.<script>x<</script><div class="ad">Buy this now.</div>'
            '<form><p>Name</p></form></article><section class="comments"><p>I like this article very much indeed.</p></section><footer>&copy; me')
    assert main_text(page)[0] == "Title One long paragraph & more of it, to be read. Next line."
    pages = spark.createDataFrame([(1, "u", page, 1), (2, None, None, 1), (None, "v", "", 1)], "page_id long, url string, html string, text int")
    assert {(r["page_id"], r["url"], r["n_chars"]) for r in extract(pages).collect()} == {(1, "u", 61), (2, None, 0), (None, "v", 0)}


def test_reparameterised_leaks(spark):
    item = "Maria has 12 apples and gives 5 apples to John who walks 3 km to the old market in Berlin every day."
    other = "So: Peter has 30 apples and gives 7 apples to Anna who walks 9 km to the old market in Paris every day. More."
    mixed = "So: Peter has 30 apples and gives 30 apples to Peter who walks 30 km to the old market in Peter every day. More."
    docs = spark.createDataFrame([(1, item), (2, other), (3, "Nothing of the kind is said here at all, " * 5), (4, None), (5, ""), (6, mixed), (7, "it says " + item.lower())],
                                 "doc_id long, text string")
    found = {(r["doc_id"], r["item_id"], r["n_changed"] > 0) for r in leaks(docs, docs.where("doc_id = 1").withColumnRenamed("doc_id", "item_id")).collect()}
    assert found >= {(1, 1, False), (2, 1, True)} and not {d for d, _, _ in found} & {3, 4, 5, 6}


def test_bad_names_around_an_article_do_not_cost_it():
    long = "It is a paragraph of the article, and all of it is to be read. " * 8
    want = long.strip()
    side = '<div class="sidebar"><p>Other things to read on this site.</p></div>'
    for page in ('<div class="layout has-sidebar"><article><p>%s</p></article></div>', '<article class="post comments-open"><p>%s</p></article>',
                 '<div class="layout no-sidebar"><main><p>%s</p></main></div>', '<div class="widget-layout"><article><p>%s</p></article></div>',
                 '<div class="promo"><main class="search"><p>%s</p></main></div>', '<article class="post tag-search"><p>%s</p></article>',
                 '<form id="aspnetForm"><label>Find</label><select><option>A</option></select><article><p>%s</p></article></form>',
                 '<article><section id="responses"><p>%s</p></section></article>', '<article><section id="discussion"><p>%s</p></section></article>',
                 '<article><p>%s</p></article><div class="related"><article><p>Another story.</p></article></div>',
                 '<article><p>%s</p><section class="comments"><article><p>I like this very much.</p></article></section></article>',
                 '<article><p>%s</p><section id="comments"><article><p>I like this very much.</p></article></section></article>'):
        assert main_text(page % long + side)[0] == want, page


def test_verbatim_leaks_of_slots_short_items_and_unspaced_scripts(spark):
    items = ["What is 12 + 30 - 7?", "Compute 3 * 4 + 12 - 5 * 6 + 7 modulo 11.", "HOW MANY LEGS DO THREE SPIDERS AND TWO BEETLES HAVE IN ALL?",
             "Ann, Bob, Carl, Dora and Emil bought 5, 7, 9, 11 and 13 apples. How many is that?", "Who wrote Hamlet?", "小明有五个苹果，他给了小红两个，还剩几个？",
             "The Old Man Of The Sea Went To See His Brother In The North", "ใครเขียนแฮมเล็ต"]
    docs = [f"Some words come first, then {x} And more words follow after it." for x in items] + [items[6].lower(), "我们知道" + items[5].replace("，", " ") + "没有人知道。"]
    clean = ["What is 13 + 30 - 7?", "Compute 3 * 4 + 12 - 5 * 6 + 8 modulo 12.", "Who wrote the play Hamlet?", "小明有三个苹果，小红没有。", None, ""]
    rows = list(enumerate(docs + clean))
    found = leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(k, k) for k in range(len(items))} | {(8, 6), (9, 5)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_components(none).count() == 0
    assert remove_repeats(none).count() == 0
    assert pack(none, tokenizer_path()).count() == 0
    assert shard(none).count() == 0
    assert leaks(none, none.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert quality_report(none).count() == 0


def test_longest_previous_equals_brute_force():
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(40):
        n = int(rng.integers(0, 60))
        lcp, position = rng.integers(0, 6, n) * rng.integers(0, 2, n), rng.permutation(n)
        wanted = [max([0, *(min(lcp[min(i, j) + 1:max(i, j) + 1]) for j in range(n) if position[j] < position[i])]) for i in range(n)]
        assert longest_previous(lcp, position).tolist() == wanted
