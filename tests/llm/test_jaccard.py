"""N-gram Jaccard join on large groups of near copies."""

import random
from collections import defaultdict

import pytest
from shoprank.llm import common, jaccard

PERCENT = 75


def shingles(text):
    words = text.split()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def components(texts):
    """Smallest id reachable by links, from all pairs."""
    sets = [shingles(t) for t in texts]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if 100 * common >= PERCENT * (len(sets[a]) + len(sets[b]) - common) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    return dict(enumerate(group))


def edited(words, places, mark):
    out = list(words)
    for p in places:
        out[p] = f"{mark}{p}"
    return " ".join(out)


def near_copies(rng, name, members, outsiders, first=5):
    """Texts of a few edits, which link, and texts of four edits (at ``first`` and every tenth word
    from there), of which some share the very edits of a member, so that they link with few."""
    words = [f"{name}{k}" for k in range(150)]
    own = [sorted(rng.sample(range(5, 145, 10), rng.choice((1, 1, 2)))) for _ in range(members)]
    texts = [edited(words, places, f"{name}m{k}x") for k, places in enumerate(own)]
    for k in range(outsiders):
        places = rng.sample(range(first, 145, 10), 4)
        if k % 3 == 0:
            places = (own[k] + [p for p in places if p not in own[k]])[:4 + k % 2]
        texts.append(edited(words, places, f"{name}o{k}x"))
    return texts


@pytest.mark.parametrize("few", [2, 16])
def test_near_copies_equal_brute_force(spark, monkeypatch, few):
    rng = random.Random(few)
    monkeypatch.setattr(jaccard, "FEW", few)
    chain = [f"c{k}" for k in range(400)]  # a component without shingles that most members have
    texts = near_copies(rng, "a", 30, 20) + near_copies(rng, "b", 5, 4)
    texts += [" ".join(chain[k:k + 80]) for k in range(0, 300, 10)]
    texts += [edited(chain[k:k + 80], rng.sample(range(80), 3), f"d{k}x") for k in range(5, 300, 30)]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs, PERCENT).collect()}
    assert found == components(texts)


def test_texts_below_the_threshold_are_not_paired_with_all_near_copies(spark, monkeypatch):
    texts = near_copies(random.Random(3), "a", 120, 60, first=10)
    pairs, centres, verified, materialise = [], [], jaccard._verified, jaccard.materialise
    monkeypatch.setattr(jaccard, "_verified", lambda p, *more: pairs.append(p.count()) or verified(p, *more))

    def written(df, name="tmp"):
        out = materialise(df, name)
        if name == "jaccard-cross":
            centres.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "materialise", written)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs, PERCENT).collect()}
    assert found == components(texts)
    groups = defaultdict(int)
    for label in found.values():
        groups[label] += 1
    alone, largest = sum(n == 1 for n in groups.values()), max(groups.values())
    assert alone >= 20 and pairs[-1] < alone * largest / 5 and centres[0] < 3 * alone


def test_no_written_plan_holds_several_searches(spark, monkeypatch):
    """The driver holds every plan, and one anew after each of its stages."""
    sizes, materialise = {}, jaccard.materialise

    def written(df, name="tmp"):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        sizes[name] = max(sizes.get(name, 0), plan.count("Join "))
        return materialise(df, name)

    for module in (common, jaccard):
        monkeypatch.setattr(module, "materialise", written)
    rng = random.Random(4)
    texts = near_copies(rng, "a", 40, 20) + near_copies(rng, "b", 5, 4)
    texts += [edited([f"e{k}" for k in range(150)], sorted(rng.sample(range(5, 145, 5), 7)), f"l{k}x") for k in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs, PERCENT).collect()}
    assert found == components(texts)
    assert "jaccard-cores" in sizes and max(sizes.values()) <= 12, sizes


def test_components_work_their_edges_out_once(spark, monkeypatch):
    plans, materialise = {}, common.materialise

    def written(df, name="tmp"):
        plans.setdefault(name, df._jdf.queryExecution().optimizedPlan().toString())
        return materialise(df, name)

    monkeypatch.setattr(common, "materialise", written)
    edges = spark.createDataFrame([(5, 2), (2, 9), (7, 8), (5, 2)], "u long, v long").mapInPandas(lambda frames: frames, "u long, v long")
    labels = {r["node"]: r["label"] for r in common.connected_components(edges).collect()}
    assert labels == {2: 2, 5: 2, 9: 2, 7: 7, 8: 7}
    assert plans["cc-edges"].count("MapInPandas") == 1
