"""N-gram Jaccard join: size-aware heavy-light join over word-shingle sets.

Only a shingle that occurs in two different sets can be shared, so the join first finds
those (one shuffle of packed 6-byte hashes, dealt by hash range) and keeps the sets of
which at least the threshold share is found elsewhere; all others link with nothing.
The rest is split by size:

* light sets (up to a boundary) enumerate fixed-size subsets. A subset is keyed with the
  two set sizes it serves and has exactly the overlap those sizes need, so all sets that
  share a key link with each other: a star per key carries all these links.
* heavy sets scan inverted lists. Lists are kept for the rarest shingles only (prefix
  filter in order of document frequency, which is exact). A list first offers one hub per
  size class; what that links is merged, and then only pairs of sets that still lie in
  different components are listed and counted, so a group of near copies costs its
  members, not their pairs. Of these pairs, the distances to the components' centres rule
  out most (triangle inequality of the Jaccard distance). Pairs with a large component are
  searched by what the sets have or lack against its core (``_delta_pairs``).

The boundary is the size up to which all subsets cost less than the scans of the same
sets' lists, from counts over the whole input.

Copies: equal sets carry the same 64-bit set key and are one set. Results are exact up to
collisions of 64-bit hashes. Null texts and texts without words have the empty set, link
with nothing and keep their own id; a null id takes the smallest id of its component;
repeated rows are copies; other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoprank.session import materialise

from .common import connected_components, shuffle_partitions
from .shingles import chunks, mix, shingle_sets

#: Largest size for which subsets are ever considered; the cost decides below it.
LARGEST_LIGHT = 16

#: Members up to which all pairs with a component are listed; pairs with larger ones are searched
#: by their differences from the component's core.
FEW = 16
#: Members that a core is counted over; classes of cost into which members are dealt.
CORE_SETS, COST_CLASSES = 32, 16

PACKED = "bucket int, keys binary, counts binary, hashes binary"
FOUND = "doc_id long, key long, n int, hashes binary, dfs binary"


def need(n, m, percent: int):
    """Least intersection of sets of n and m for 100 * i >= percent * union."""
    return -(-percent * (n + m) // (100 + percent))


def least_share(n, percent: int):
    """Least intersection of a set of n with any set: union >= n."""
    return -(-percent * n // 100)


def _set_keys(place, h, n_docs):
    """64-bit keys of the sets; 0 marks the empty set."""
    keys = np.zeros(n_docs, np.uint64)
    np.add.at(keys, place, mix(h))
    other = np.zeros(n_docs, np.uint64)
    np.bitwise_xor.at(other, place, mix(h + np.uint64(0x51ED270B)))
    keys = mix(keys ^ mix(other))
    used = np.zeros(n_docs, bool)
    used[place] = True
    keys[used & (keys == 0)] = 1
    keys[~used] = 0
    return keys


def _pack(buckets: int, width: int):
    def run(frames):
        for frame in frames:
            ids = frame["doc_id"].to_numpy()
            for part in chunks(frame["text"]):
                place, h, n = shingle_sets(part, width)
                keys = _set_keys(place, h, len(part))
                own = ids[[k for k, _ in part]]
                null = pd.isna(own)
                rows = [(-1 - int(keys[:1].sum() % np.uint64(buckets)),
                         np.column_stack([np.where(null, 0, own).astype(np.int64), null.astype(np.int64)]).tobytes(),
                         n.astype(np.uint32).tobytes(), keys.tobytes())]
                bucket = ((h >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype(np.uint16)
                order = np.argsort(bucket, kind="stable")
                bucket, place, h = bucket[order], place[order], h[order]
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(h)]):
                    if lo == hi:
                        continue
                    at = np.r_[0, np.flatnonzero(np.diff(place[lo:hi])) + 1]
                    counts = np.diff(np.r_[at, hi - lo]).astype(np.uint32)
                    low = h[lo:hi].view(np.uint8).reshape(-1, 8)[:, :6]
                    rows.append((int(bucket[lo]), keys[place[lo:hi][at]].tobytes(), counts.tobytes(), low.tobytes()))
                yield pd.DataFrame(rows, columns=["bucket", "keys", "counts", "hashes"])

    return run


def _unpack48(blob: bytes) -> np.ndarray:
    low = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    out = np.zeros((len(low), 8), np.uint8)
    out[:, :6] = low
    return out.view(np.uint64).reshape(-1)


def _repeated(frame: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the documents' keys and sizes, or the shingles that occur in two sets or
    more, by set, with the number of sets that have them."""
    bucket = int(frame["bucket"].iloc[0])
    none = pd.DataFrame({c: [] for c in ("doc_id", "key", "n", "hashes", "dfs")})
    if bucket < 0:
        ids = np.concatenate([np.frombuffer(b, np.int64).reshape(-1, 2) for b in frame["keys"]])
        out = pd.DataFrame({"doc_id": pd.array(ids[:, 0], "Int64"),
                            "key": np.concatenate([np.frombuffer(b, np.int64) for b in frame["hashes"]]),
                            "n": np.concatenate([np.frombuffer(b, np.uint32) for b in frame["counts"]]).astype(np.int32),
                            "hashes": None, "dfs": None})
        out.loc[ids[:, 1] == 1, "doc_id"] = pd.NA
        return out
    h = np.concatenate([_unpack48(b) for b in frame["hashes"]])
    key = np.repeat(np.concatenate([np.frombuffer(b, np.int64) for b in frame["keys"]]),
                    np.concatenate([np.frombuffer(b, np.uint32) for b in frame["counts"]]))
    del frame
    order = np.argsort(h, kind="stable")
    h, key = h[order], key[order]
    same = h[1:] == h[:-1]
    maybe = np.r_[False, same] | np.r_[same, False]
    h, key = h[maybe], key[maybe]
    order = np.lexsort((key, h))
    h, key = h[order], key[order]
    if not len(h):
        return none
    new = np.r_[True, (h[1:] != h[:-1]) | (key[1:] != key[:-1])]
    h, key = h[new], key[new]
    at = np.r_[0, np.flatnonzero(h[1:] != h[:-1]) + 1]
    sizes = np.diff(np.r_[at, len(h)])
    df = np.repeat(sizes, sizes)
    keep = df > 1
    h, key, df = h[keep] | np.uint64(bucket << 48), key[keep], df[keep].astype(np.uint32)
    if not len(h):
        return none
    order = np.argsort(key, kind="stable")
    h, key, df = h[order], key[order], df[order]
    at = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1]
    ends = np.r_[at[1:], len(h)]
    return pd.DataFrame({"doc_id": pd.array([pd.NA] * len(at), "Int64"), "key": key[at], "n": (ends - at).astype(np.int32),
                         "hashes": [h[a:b].tobytes() for a, b in zip(at, ends)],
                         "dfs": [df[a:b].tobytes() for a, b in zip(at, ends)]})


def _order_tokens(frames):
    """Shingles of each set from the rarest to the most frequent."""
    for frame in frames:
        toks = []
        for hs, ds in zip(frame["hashes"], frame["dfs"]):
            h = np.concatenate([np.frombuffer(b, np.int64) for b in hs])
            df = np.concatenate([np.frombuffer(b, np.uint32) for b in ds])
            toks.append(h[np.lexsort((h, df))])
        yield pd.DataFrame({"key": frame["key"], "n": frame["n"], "toks": toks})


def _subsets(percent: int):
    """A row for each (smaller size, larger size, subset) that a light set serves."""

    def run(frames):
        for frame in frames:
            out = []
            for key, n, boundary, toks in zip(frame["key"], frame["n"], frame["boundary"], frame["toks"]):
                toks = sorted(int(t) for t in toks)
                for m in range(least_share(n, percent), boundary + 1):
                    size = need(n, m, percent)
                    if max(n, m) > boundary or size > min(n, m) or size > len(toks):
                        continue
                    for subset in combinations(toks, size):
                        out.append((min(n, m), max(n, m), np.array(subset, np.int64).tobytes(), key, n))
            yield pd.DataFrame(out, columns=["small", "large", "subset", "key", "n"])

    return run


def _light_links(sets: DataFrame, percent: int) -> DataFrame:
    """(u, v) of a star per subset. All sets of a key link across the two sizes: every larger
    set with the smallest key of the smaller ones, and every smaller with that of the larger."""
    subs = sets.mapInPandas(_subsets(percent), "small int, large int, subset binary, key long, n int")
    group = ["small", "large", "subset"]
    hubs = subs.groupBy(*group).agg(F.min(F.when(F.col("n") == F.col("small"), F.col("key"))).alias("low"),
                                    F.min(F.when(F.col("n") == F.col("large"), F.col("key"))).alias("high"))
    hubs = hubs.where(F.col("low").isNotNull() & F.col("high").isNotNull())
    hub = F.when(F.col("n") == F.col("small"), F.col("high")).otherwise(F.col("low"))
    return (subs.join(hubs, group).select(F.col("key").alias("u"), hub.alias("v"))
            .where("u != v").distinct())


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (u, v and others) with both sizes and the size of the intersection."""
    a = sets.select(F.col("key").alias("u"), F.col("n").alias("n_u"), F.col("toks").alias("t_u"))
    b = sets.select(F.col("key").alias("v"), F.col("n").alias("n_v"), F.col("toks").alias("t_v"))
    return (pairs.join(a, "u").join(b, "v")
            .withColumn("common", F.size(F.array_intersect("t_u", "t_v"))).drop("t_u", "t_v"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (u, v) of ``pairs`` that link, by the sizes of their intersections."""
    return (_overlaps(pairs, sets).where(F.col("common") * (100 + percent) >= percent * (F.col("n_u") + F.col("n_v")))
            .select("u", "v"))


def _distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with their Jaccard distance, a metric."""
    return _overlaps(pairs, sets).withColumn(
        "far", 1 - F.col("common") / (F.col("n_u") + F.col("n_v") - F.col("common"))).drop("n_u", "n_v", "common")


def _cores(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(lb, core): the shingles that most of a component's members have, counted over about
    CORE_SETS of them. Any core gives the same links; a common one gives few differences."""
    sizes = members.groupBy("lb").agg(F.count("*").alias("members"))
    some = members.join(sizes, "lb").where(F.pmod(F.xxhash64("v"), "members") < CORE_SETS).select("lb", F.col("v").alias("key"))
    counted = some.groupBy("lb").agg(F.count("*").alias("taken"))
    toks = some.join(sets, "key").select("lb", F.explode("toks").alias("tok")).groupBy("lb", "tok").agg(F.count("*").alias("has"))
    return (toks.join(counted, "lb").where(F.col("has") * 2 > F.col("taken"))
            .groupBy("lb").agg(F.collect_list("tok").alias("core")))


def _deltas(rows: DataFrame, end: str, cores: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``rows`` (lb, ``end``, n, ...) with ``delta``, the shingles that only one of the set and the
    component's core has, and ``cost``: p * n + (100 + p) * (shingles of the core that the set lacks)."""
    toks = sets.select(F.col("key").alias(end), "toks")
    lacks = F.array_except("core", "toks")
    return (rows.join(cores, "lb", "left").withColumn("core", F.coalesce("core", F.array().cast("array<bigint>"))).join(toks, end)
            .withColumn("delta", F.concat(F.array_except("toks", "core"), lacks))
            .withColumn(f"cost_{end}", percent * F.col(f"n_{end}") + (100 + percent) * F.size(lacks))
            .withColumn("whole", (100 + percent) * F.size("core")).drop("toks", "core"))


def _delta_pairs(firsts: DataFrame, seconds: DataFrame, sets: DataFrame, percent: int, possible,
                 linked: bool = True) -> DataFrame:
    """(u, v) of sets u (``firsts``: lb, u, ...) and members v (``seconds``: lb, v, ...) of a large
    component lb: all that can link, or for a u that surely links with lb, one that does. With
    ``linked`` false lb is any group, and both sides are its members: all pairs that can link, but for
    those that a star around the cheapest member carries.

    With K the core, R the shingles of K that a set lacks and D the symmetric difference of the
    set and K, the intersection of u and v is |K| - |R(u)| - |R(v)| + |D(u) & D(v)|. So they link
    when (100 + p) * |D(u) & D(v)| >= cost(u) + cost(v) - (100 + p) * |K|. Near copies have
    nearly all shingles in common, but few of their differences, so this overlap is searched by
    prefixes of D, the rarest differences first; members are dealt into classes of about
    equal cost, so that a prefix is as short as their costs allow."""
    q = 100 + percent
    cores = materialise(_cores(seconds, sets), "jaccard-cores")
    v = materialise(_deltas(seconds, "v", cores, sets, percent), "jaccard-deltas")
    spans = v.groupBy("lb").agg(F.min(F.struct("cost_v", "v")).alias("cheapest"), F.max("cost_v").alias("most_cost"))
    spans = materialise(spans.select(
        "lb", F.col("cheapest.cost_v").alias("least_cost"), F.col("cheapest.v").alias("v"),
        F.greatest(F.lit(q), F.ceil((F.col("most_cost") - F.col("cheapest.cost_v") + 1) / COST_CLASSES)).alias("span")), "jaccard-spans")
    u = materialise(_deltas(firsts, "u", cores, sets, percent).join(spans, "lb"), "jaccard-deltas")
    sure = u.where(F.col("cost_u") + F.col("least_cost") <= F.col("whole")).where("u != v").select("u", "v")
    if linked:
        u = u.where(F.col("cost_u") + F.col("least_cost") > F.col("whole"))
    u = u.drop("v", "least_cost", "span")
    counts = materialise(v.select("lb", F.explode("delta").alias("tok")).groupBy("lb", "tok").agg(F.count("*").alias("df")),
                         "jaccard-differences")

    def ordered(rows: DataFrame, end: str) -> DataFrame:
        """Differences that some member has, from the rarest on, in the place of ``delta``."""
        toks = (rows.select("lb", end, F.explode("delta").alias("tok")).join(counts, ["lb", "tok"]).groupBy("lb", end)
                .agg(F.array_sort(F.collect_list(F.struct("df", "tok"))).alias("delta")))
        return materialise(rows.drop("delta").join(toks, ["lb", end]), "jaccard-ordered")

    def listed(rows: DataFrame, end: str, least) -> DataFrame:
        """A row for each difference of a prefix that an overlap worth ``least`` / q must meet, and
        ``left``: q times the number of differences from there on."""
        places = F.size("delta") - F.greatest(F.lit(1), F.ceil(least / q)).cast("int") + 1
        rows = rows.withColumn("places", places).where("places > 0")
        kept = [c for c in rows.columns if c not in ("delta", "places")]
        return (rows.select(*kept, F.size("delta").alias("size"), F.posexplode(F.slice("delta", F.lit(1), F.col("places"))).alias("at", "d"))
                .select(*kept, F.col("d.tok").alias("tok"), (q * (F.col("size") - F.col("at"))).alias(f"left_{end}")))

    v = v.join(spans.drop("v"), "lb").withColumn("class", F.floor((F.col("cost_v") - F.col("least_cost")) / F.col("span"))).drop("span", "least_cost")
    classes = v.groupBy("lb", "class").agg(F.min("cost_v").alias("class_cost"))
    closest = u.groupBy("lb").agg(F.min("cost_u").alias("u_cost"))
    seconds = listed(ordered(v, "v").join(closest, "lb"), "v", F.col("u_cost") + F.col("cost_v") - F.col("whole")).drop("whole", "u_cost")
    firsts = listed(ordered(u, "u").join(classes, "lb"), "u", F.col("cost_u") + F.col("class_cost") - F.col("whole")).drop("class_cost")
    lacking = F.col("cost_u") + F.col("cost_v") - F.col("whole")
    met = (firsts.join(seconds, ["lb", "class", "tok"])
           .where((lacking <= F.col("left_u")) & (lacking <= F.col("left_v")) & possible()))
    return materialise(met.select("u", "v").unionByName(sure), "jaccard-pairs")


def _heavy_links(sets: DataFrame, light_links: DataFrame, percent: int) -> DataFrame:
    """Links that involve a set beyond the boundary, as far as components need them."""
    share = F.ceil(F.col("n") * percent / 100).cast("int")
    # a partner shares only repeated shingles, which bounds its size
    most = F.floor((F.size("toks") * (100 + percent) - F.col("n") * percent) / percent).cast("int")
    lists = materialise(
        sets.where(share <= F.size("toks"))
        .withColumn("reach", F.floor(F.col("n") * 100 / percent))
        .where("reach > boundary")  # a smaller set meets only light ones
        .select("key", "n", most.alias("most"),
                F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int").alias("class"),
                F.explode(F.slice("toks", F.lit(1), F.size("toks") - share + 1)).alias("tok")), "jaccard-lists")

    def fits(a: str, b: str):
        n, m = F.col(f"n_{a}"), F.col(f"n_{b}")
        return ((n * 100 >= m * percent) & (m * 100 >= n * percent)
                & (m <= F.col(f"most_{a}")) & (n <= F.col(f"most_{b}")))

    def labelled(links: DataFrame) -> DataFrame:
        comps = connected_components(links).select(F.col("node").alias("key"), "label")
        return lists.join(comps, "key", "left").withColumn("label", F.coalesce("label", "key"))

    links = materialise(light_links, "jaccard-links")
    for best in (True, False):
        rows = labelled(links)
        hubs = (rows.groupBy("tok", "class").agg(F.min(F.struct("label", "key", "n", "most")).alias("hub"), F.count("*").alias("members"))
                .where("members > 1").select("tok", "class", F.col("hub.key").alias("v"), F.col("hub.n").alias("n_v"),
                                             F.col("hub.most").alias("most_v"), F.col("hub.label").alias("lb")))
        pairs = (rows.select("tok", "class", F.col("label").alias("la"), F.col("key").alias("u"), F.col("n").alias("n_u"),
                             F.col("most").alias("most_u"))
                 .join(hubs, ["tok", "class"]).where(F.col("la") != F.col("lb")).where(fits("u", "v"))
                 .groupBy("u", "v").agg(F.count("*").alias("votes")))
        if best:
            pairs = pairs.groupBy("u").agg(F.max(F.struct("votes", "v")).alias("top")).select("u", F.col("top.v").alias("v"))
        links = materialise(links.unionByName(_verified(pairs.select("u", "v"), sets, percent)), "jaccard-links")

    # Every component gets a centre, its largest hub. With distances d to the centres and D
    # between two centres, d(u, v) >= D - d(u) - d(v): pairs that this puts too far apart go.
    limit = 1 - percent / 100 + 1e-9
    comps = materialise(connected_components(links).select(F.col("node").alias("key"), "label"), "jaccard-comps")
    centres = (links.groupBy(F.col("v").alias("key")).agg(F.count("*").alias("size")).join(comps, "key")
               .groupBy("label").agg(F.max(F.struct("size", "key")).alias("top")).select("label", F.col("top.key").alias("centre")))
    inside = _distances(comps.join(centres, "label").select(F.col("key").alias("u"), F.col("centre").alias("v"), "label"), sets)
    inside = materialise(inside.select(F.col("u").alias("key"), "label", F.col("v").alias("centre"), F.col("far")), "jaccard-inside")
    rows = lists.join(inside, "key", "left").select(
        "tok", "key", "n", "most", F.coalesce("label", "key").alias("label"), F.coalesce("centre", "key").alias("centre"),
        F.coalesce("far", F.lit(0.0)).alias("d"))
    rows = materialise(rows, "jaccard-rows")
    members = rows.drop("tok").distinct()
    whole = members.groupBy("label", "centre").agg(F.min("n").alias("n"), F.max("most").alias("most"),
                                                   F.max("d").alias("d"), F.count("*").alias("size"))
    # All lists with one smallest component are gone through together: the components in them
    # are paired once, not once for each shingle they share.
    mixed = rows.groupBy("tok").agg(F.min("label").alias("hub"), F.max("label").alias("b")).where("hub < b").select("tok", "hub")
    near = rows.select("tok", "label").join(mixed, "tok").select("hub", "label").distinct().join(whole, "label")
    # Sets without a link yet that meet at one hub are searched by differences, too, where they are many.
    many = near.where("size = 1").groupBy("hub").agg(F.count("*").alias("lone")).where(F.col("lone") > FEW)
    near = near.join(many, "hub", "left").withColumn("lone", F.col("lone").isNotNull() & (F.col("size") == 1))
    near = materialise(near, "jaccard-near")

    def side(frame: DataFrame, name: str, end: str) -> DataFrame:
        return frame.select(*[F.col(c).alias({"label": f"l{name}", "key": end, "centre": end}.get(c, f"{c}_{end}"))
                              if c != "hub" else F.col(c) for c in frame.columns])

    cross = (side(near, "a", "u").join(side(near, "b", "v"), "hub")
             .where(F.struct("size_u", "la") < F.struct("size_v", "lb"))
             .where((F.col("n_u") <= F.col("most_v")) & (F.col("n_v") <= F.col("most_u")) & ~(F.col("lone_u") & F.col("lone_v")))
             .select("la", "lb", "u", "v", "size_v", "d_v", (F.col("d_u") + F.col("d_v")).alias("radii")).distinct())
    apart = _distances(materialise(cross, "jaccard-cross"), sets).where(F.col("far") - F.col("radii") <= limit)
    apart = materialise(apart.select("la", "lb", "far", "size_v", F.col("d_v").alias("radius")), "jaccard-apart")
    own = members.drop("centre")
    firsts = materialise(apart.join(side(own, "a", "u"), "la").where(F.col("far") - F.col("d_u") - F.col("radius") <= limit),
                         "jaccard-firsts")

    def possible():
        return fits("u", "v") & (F.col("far") - F.col("d_u") - F.col("d_v") <= limit)

    # Each search is written by itself: all in one query are a plan of hundreds of nodes, planned anew after every stage.
    pairs = firsts.where(F.col("size_v") <= FEW).join(side(own, "b", "v"), "lb").where(possible()).select("u", "v")
    large = apart.where(F.col("size_v") > FEW).select(F.col("lb").alias("label")).distinct()
    if not large.isEmpty():
        pairs = pairs.unionByName(_delta_pairs(
            firsts.where(F.col("size_v") > FEW), side(own.join(large, "label", "left_semi"), "b", "v"), sets, percent, possible))
    lone = near.where("lone").select(F.col("hub").alias("lb"), "label", "n", "most")
    if not lone.isEmpty():
        ends = [lone.select("lb", F.col("label").alias(end), F.col("n").alias(f"n_{end}"), F.col("most").alias(f"most_{end}"))
                for end in ("u", "v")]
        pairs = pairs.unionByName(_delta_pairs(*ends, sets, percent, lambda: fits("u", "v") & (F.col("u") < F.col("v")), linked=False))
    return links.unionByName(_verified(pairs.distinct(), sets, percent))


def _boundary(sets: DataFrame, percent: int) -> int:
    """Largest size up to which enumerating subsets costs no more than scanning lists."""
    share = F.ceil(F.col("n") * percent / 100).cast("int")
    small = sets.where(F.col("n") <= LARGEST_LIGHT)
    counts = small.groupBy("n", F.size("toks").alias("r")).agg(F.count("*").alias("sets")).collect()
    lists = small.select("n", F.explode(F.slice("toks", F.lit(1), F.size("toks") - share + 1)).alias("tok"))
    lengths = lists.groupBy("tok").agg(F.count("*").alias("length"))
    scans = {row["n"]: row["scan"] for row in
             lists.join(lengths, "tok").groupBy("n").agg(F.sum("length").alias("scan")).collect()}
    boundary, subsets, scanned = 0, 0, 0
    for n in range(1, LARGEST_LIGHT + 1):
        served = range(least_share(n, percent), n * 100 // percent + 1)
        subsets += sum(row["sets"] * comb(row["r"], need(n, m, percent)) for row in counts if row["n"] == n for m in served)
        scanned += scans.get(n, 0)
        if subsets <= scanned:
            boundary = n
    return boundary


def jaccard_components(docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text): documents
    link when 100 * intersection >= percent * union of their shingle sets, and component_id
    is the smallest doc_id that links reach."""
    spark = docs.sparkSession
    buckets = max(32, shuffle_partitions(spark))
    packed = docs.select("doc_id", "text").mapInPandas(_pack(buckets, width), PACKED)
    found = materialise(packed.groupBy("bucket").applyInPandas(_repeated, FOUND), "jaccard-found")
    meta = found.where("hashes is null").select("doc_id", "key", F.col("n").alias("n_shingles"))
    sizes = meta.groupBy("key").agg(F.max("n_shingles").alias("n"), F.min("doc_id").alias("least_id"))
    shared = (found.where("hashes is not null").groupBy("key")
              .agg(F.sum("n").alias("r"), F.collect_list("hashes").alias("hashes"), F.collect_list("dfs").alias("dfs"))
              .join(sizes.where("key != 0").select("key", "n"), "key")
              .where(F.col("r") * 100 >= F.col("n") * percent))
    sets = materialise(shared.select("key", "n", "hashes", "dfs").mapInPandas(
        _order_tokens, "key long, n int, toks array<long>"), "jaccard-sets")
    boundary = _boundary(sets, percent)
    sets = sets.withColumn("boundary", F.lit(boundary))
    light = _light_links(sets.where(F.col("n") <= boundary), percent)
    links = _heavy_links(sets, light, percent)
    comps = connected_components(links).select(F.col("node").alias("key"), "label")
    classes = materialise(sizes.join(comps, "key", "left").select(
        "key", "least_id", F.coalesce("label", "key").alias("label")), "jaccard-classes")
    least = classes.groupBy("label").agg(F.min("least_id").alias("component_id"))
    ids = classes.join(least, "label").select("key", "component_id")
    return meta.join(ids, "key").select(
        "doc_id", F.col("n_shingles").cast("long"),
        F.when(F.col("key") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
