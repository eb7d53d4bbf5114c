"""Merkle manifest against a plain recursive version."""

import hashlib
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from shoprank.llm import merkle

LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """(root, siblings by node: for each level (those before, those after))."""
    paths = [[] for _ in nodes]
    owners = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        above, above_owners = [], []
        for lo in range(0, len(nodes), 8):
            run = nodes[lo:lo + 8]
            for k in range(len(run)):
                for leaf in owners[lo + k]:
                    paths[leaf].append((run[:k], run[k + 1:]))
            above.append(sha("".join(run)))
            above_owners.append([leaf for k in range(len(run)) for leaf in owners[lo + k]])
        nodes, owners = above, above_owners
    return nodes[0], paths


def plain(rows):
    by_lang = defaultdict(list)
    for i, text, lang, source, n_chars in rows:
        def leaf(t):
            return sha("".join(map(written, (i, source, lang, n_chars, t))))
        tampered = leaf(text and text.translate(LOWER)) if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 else leaf(text)
        by_lang[lang].append((i is not None, i or 0, leaf(text), tampered, i))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    for own in by_lang.values():
        own.sort(key=lambda x: x[:3])
    trees = {x: tree([leaf for _, _, leaf, _, _ in by_lang[x]]) for x in langs}
    root, top = tree([trees[x][0] for x in langs])
    out = Counter()
    for x, above in zip(langs, top):
        subroot, paths = trees[x]
        for (_, _, leaf, node, i), path in zip(by_lang[x], paths):
            for before, after in path + above:
                node = sha("".join(before + [node] + after))
            proof = sha("".join("".join(b + a) for b, a in path + above))
            out[i, leaf, subroot, root, proof, node, node == root] += 1
    return out


def rows_of(n, lang, start=0):
    return [(start + k, f"Text {k} Of {lang}", lang, "s", k) for k in range(n)]


def test_manifest_equals_the_plain_tree(spark):
    rows = (rows_of(1300, "en") + rows_of(64, "de", 2000) + rows_of(65, "é", 3000) + rows_of(9, None, 4000) + rows_of(1, "", 5000)
            + rows_of(8, "fr", 6000) + [(7, None, "en", None, None), (8, "", "en", "", 0), (None, "NULL ID", "en", "s", 1)]
            + [(9, "Same", "en", "s", 1)] * 3 + [(None, None, None, None, None)] * 2 + [(10, "LONG " * 50_000, "en", "s", 1)]
            + [(2 ** 60 + 1, "Big", "en", "s", 1), (-5, "Below", "en", "s", 1)])
    docs = spark.createDataFrame(rows, SCHEMA)
    expected = plain(rows)
    assert Counter(map(tuple, merkle.manifest(docs).collect())) == expected
    clashing = docs.withColumns({c: F.lit("x") for c in ("tree", "pos", "hash", "leaf", "root", "n", "block", "entry", "part")})
    assert Counter(map(tuple, merkle.manifest(clashing.repartition(1)).collect())) == expected
    assert sum(v for k, v in expected.items() if not k[-1]) > 100  # tampering shows


def test_many_languages_make_a_tree_of_their_own(spark):
    rows = [(k, f"T{k}", f"lang-{k}", None, k) for k in range(600)]
    assert Counter(map(tuple, merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect())) == plain(rows)


def test_one_row_and_none(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    row = merkle.manifest(spark.createDataFrame([(1, "Text", None, "s", 4)], SCHEMA)).first()
    assert row["leaf"] == row["subroot"] == row["root"] == sha("1:11:s-1:44:Text")
    assert row["proof_sha256"] == sha("")


def test_levels_are_written_every_few(spark):
    leaves = spark.range(5000).select(F.lit("=a").alias("tree"), F.col("id").alias("pos"), F.lit(5000).cast("long").alias("n"),
                                      F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("hash"))
    levels = merkle.written_levels(leaves)
    assert [x.count() for x in levels] == [5000, 10, 1]
    nodes = [hashlib.sha256(str(k).encode()).hexdigest() for k in range(5000)]
    assert levels[-1].first()["hash"].hex() == tree(nodes)[0]


def test_proofs_pack_and_fold():
    nodes = [sha(str(k)).encode() for k in range(11)]
    levels = merkle.climb(nodes, 2)
    for k, node in enumerate(nodes):
        steps = merkle.siblings(levels, k)
        assert merkle.unpacked(merkle.packed(steps)) == steps
        assert merkle.fold(node, steps) == levels[-1][0]
    assert merkle.fold(nodes[1], merkle.siblings(levels, 0)) != levels[-1][0]
    assert [merkle.levels_up(n) for n in (1, 2, 8, 9, 64, 65, 512, 513, 10 ** 9)] == [0, 1, 1, 2, 2, 3, 3, 3, 3]
