"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

Word 1- and 2-grams are hashed into a sparse vector, and a multinomial logistic regression,
trained here, tells licence families from an unknown class. Training rows are the notice
templates below with words left out, the short notices, and a bounded sample of lines of the
input (``SAMPLE``) that look like no template, as unknown. The bar a probability must pass is
set on further sampled lines, so that at most one in a thousand unknown lines passes.

Paragraphs end at lines without a letter or digit. Every line is classified, and in paragraphs
with a word of ``ANCHOR`` every two and three neighbouring lines that hold one as well, so that
wrapped templates are seen whole (lines without any word that a confirmation needs are left out
before, which changes no result); a predicted family is confirmed by the share of the best
matching template's words that stand there. The short notices, of which a share says nothing,
are looked for word by word in the joined lines of these paragraphs; one that is found confirms
its family, with the probability that the classifier gives the notice for it.

Everything runs as DataFrame, SQL and Spark ML operations. Null and empty texts have no
licence; every line of a text of any length is classified; rows that repeat an id are taken
together; null ids are a group of their own; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoprank.session import materialise

from .common import bind

#: Lines of the input that training takes as unknown, and as many for the bar. They come from
#: about twice as many documents, picked by a hash of the row.
SAMPLE = 4000
VARIANTS = 24
FEATURES = 1 << 13
#: Least share of a template's words in a confirmed line or window of lines.
CONFIRM = 0.6

#: Short licence notices by family.
TEMPLATES = {
    "apache": ["Licensed under the Apache License, Version 2.0",
               "you may not use this file except in compliance with the License obtained at apache.org licenses LICENSE-2.0",
               "Distributed under the terms of the Apache License 2.0"],
    "mit": ["Released under the MIT License", "This project is licensed under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3",
            "redistribute it and or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
            "Licensed under the GPL version 2 or later"],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 2.1",
             "redistribute it and or modify it under the terms of the GNU Lesser General Public License"],
    "agpl": ["Licensed under the GNU Affero General Public License, version 3",
             "This program is released under the terms of the GNU Affero General Public License"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted",
            "Released under the BSD 3-Clause License", "This code is licensed under the BSD License"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
            "Licensed under the Mozilla Public License 2.0"],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related rights to this work CC0 1.0",
            "Dedicated to the public domain under CC0 1.0 Universal"],
    "isc": ["Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted ISC License",
            "Released under the ISC License"],
    "proprietary": ["All rights reserved. No part of this work may be reproduced without written permission",
                    "This document is proprietary and confidential"],
}
#: Short notices by family, as words in a row.
NOTICES = {
    "apache": ["apache license", "apache 2 0", "apache2 license", "license apache", "licensed under apache", "identifier apache 2 0"],
    "mit": ["mit license", "mit licensed", "license mit", "licensed under mit", "licensed under the mit", "license identifier mit",
            "mit or apache", "2 0 or mit", "permission is hereby granted free of charge to any person obtaining a copy"],
    "gpl": ["gnu general public license", "gnu gpl", "gpl license", "license gpl", "gplv2", "gplv3", "gpl v2", "gpl v3", "gpl 2 0", "gpl 3 0",
            "gpl version 2", "gpl version 3", "licensed under the gpl", "licensed under gpl", "license identifier gpl"],
    "lgpl": ["gnu lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl license", "license lgpl", "lgplv2", "lgplv2 1",
             "lgplv3", "lgpl v2", "lgpl v3", "lgpl 2 0", "lgpl 2 1", "lgpl 3 0", "lgpl version 2", "lgpl version 3", "licensed under the lgpl"],
    "agpl": ["gnu affero general public license", "affero general public license", "gnu agpl", "agpl license", "license agpl", "agplv3", "agpl v3",
             "agpl 3 0", "agpl version 3", "licensed under the agpl"],
    "bsd": ["bsd license", "bsd licensed", "license bsd", "bsd 2 clause", "bsd 3 clause", "bsd 4 clause", "2 clause bsd", "3 clause bsd", "4 clause bsd",
            "bsd style license", "licensed under bsd", "license identifier bsd", "redistribution and use in source and binary forms"],
    "mpl": ["mozilla public license", "license mpl", "mpl license", "mpl 1 1", "mpl 2 0", "mplv2", "mpl v2", "mpl version 2", "licensed under the mpl"],
    "cc-by": ["cc by", "creative commons attribution", "creativecommons org licenses by"],
    "cc-by-sa": ["cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike", "creativecommons org licenses by sa"],
    "cc-by-nc": ["cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial",
                 "creativecommons org licenses by nc"],
    "cc0": ["cc0", "cc0 1 0", "cc zero", "creative commons zero", "dedicated to the public domain", "creativecommons org publicdomain zero"],
    "isc": ["isc license", "isc licensed", "license isc", "licensed under isc", "licensed under the isc", "license identifier isc",
            "permission to use copy modify and or distribute this software", "permission to use copy modify and distribute this software"],
    "proprietary": ["all rights reserved", "all rights are reserved", "proprietary and confidential", "confidential and proprietary", "proprietary license",
                    "license proprietary"],
}
#: Words after a notice that make it one of another licence.
NOT_BEFORE = {"cc-by": "sa|nc|nd|sharealike|share|noncommercial|non|noderivatives|noderivs|no"}
#: Every template and notice has one of these; cheap, and read in the raw text.
ANCHOR = (r"(?i)licen[cs]|permission|permitted|redistribut|reserved|confidential|proprietary|domain|copyright|gpl|apache|"
          r"mozilla|mpl|bsd|mit\s+or|or\s+mit|cc[^\p{L}\p{N}]*by|cc[^\p{L}\p{N}]*(?:0|zero)|creative\s*commons")
#: The same in two parts: literals, and what needs a pattern.
ANCHOR_WORDS = ["licenc", "licens", "permission", "permitted", "redistribut", "reserved", "confidential", "proprietary", "domain",
                "copyright", "gpl", "apache", "mozilla", "mpl", "bsd"]
ANCHOR_REST = r"(?i)mit\s+or|or\s+mit|c(?:c[^\p{L}\p{N}]*(?:by|0|zero)|reative\s*commons)"
#: Lines without a letter or digit between two paragraphs.
BLANK = r"\n[^\p{L}\p{N}]*\n"
FAMILIES = sorted(TEMPLATES)
UNKNOWN = len(FAMILIES)


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), 1)


def grams_of(words: Column) -> Column:
    """The words and the pairs of neighbours."""
    return bind(words, lambda w: F.concat(w, F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1)))))


def _templates(spark) -> DataFrame:
    rows = [F.struct(F.lit(FAMILIES.index(f)).alias("family"), F.lit(short).alias("short"), F.lit(t).alias("text"))
            for short, texts in ((False, TEMPLATES), (True, NOTICES)) for f in FAMILIES for t in texts[f]]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.family", "t.short", words_of(F.col("t.text")).alias("words"))


def _notice(name: str) -> str:
    """Pattern of the family's notices in words between blanks, longest first."""
    texts = "|".join(sorted(NOTICES[name], key=len, reverse=True)).replace("license", "licen[cs]e")
    return f"(?<= )(?:{texts})(?= )" + (f"(?! (?:{NOT_BEFORE[name]}) )" if name in NOT_BEFORE else "")


def _joined(text: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(words_of(text), " "), F.lit(" "))


def _overlap(words: Column, family: Column) -> Column:
    """Largest share of a template's words, of the family, that stand among ``words``."""
    best = F.lit(0.0)
    for number, name in enumerate(FAMILIES):
        shares = []
        for text in TEMPLATES[name]:
            own = sorted({w for w in "".join(c.lower() if c.isalnum() else " " for c in text).split()})
            shares.append(F.size(F.array_intersect(F.array(*[F.lit(w) for w in own]), words)) / F.lit(float(len(own))))
        best = F.when(family == number, F.greatest(*shares)).otherwise(best)
    return best


COMMON = {"the", "of", "and", "to", "a", "in", "is", "this", "or", "it", "for", "with", "by", "be", "as", "are", "all", "any", "no", "may", "you"}


def _template_words(text: str) -> set[str]:
    return set("".join(c.lower() if c.isalnum() else " " for c in text).split())


def _confirmable(words: Column) -> Column:
    """Whether a line can hold ``CONFIRM`` of some template's words: it then has one of those
    that are not common, as the common ones alone are too few in every template. Others need no
    class."""
    sets = [_template_words(t) for f in FAMILIES for t in TEMPLATES[f]]
    assert all(len(s & COMMON) < CONFIRM * len(s) for s in sets)
    return F.arrays_overlap(words, F.array(*[F.lit(w) for w in sorted(set().union(*sets) - COMMON)]))


def _anchored(text: Column) -> Column:
    """Whether ``ANCHOR`` is found; literals are looked for without a pattern."""
    def literals(low: Column) -> Column:
        found = F.contains(low, F.lit(ANCHOR_WORDS[0]))
        for word in ANCHOR_WORDS[1:]:
            found = found | F.contains(low, F.lit(word))
        return found

    return bind(F.lower(text), literals) | text.rlike(ANCHOR_REST)


def _any_overlap(words: Column) -> Column:
    """Share of the words that stand in any template: high for licence lines."""
    known = sorted(set().union(*[_template_words(t) for f in FAMILIES for t in TEMPLATES[f]]) - COMMON)
    return F.size(F.filter(words, lambda w: w.isin(known))) / F.greatest(F.size(words), F.lit(1))


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc_id, row, place, paragraph); ``row`` tells rows of one id apart."""
    return (docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
            .select("doc_id", "row", F.posexplode(F.split(F.coalesce("text", F.lit("")), BLANK, -1)).alias("place", "paragraph")))


def _unit(family: int):
    return lambda text: F.struct(F.lit(family).alias("named"), text.alias("text"))


def units(paragraph: Column) -> Column:
    """(named, text) of every line, and, with an anchor, of every two and three neighbouring
    lines around one and of every notice; ``named`` is the notice's family and else -1."""
    def windows(lines: Column, width: int) -> Column:
        starts = F.when(F.size(lines) >= width, F.sequence(F.lit(1), F.size(lines) - (width - 1))).otherwise(F.array().cast("array<int>"))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(lines, i, F.lit(width)), " "))
        return F.transform(F.filter(joined, lambda x: x.rlike(ANCHOR)), _unit(-1))

    def notices(joined: Column) -> Column:
        return F.concat(*[F.transform(F.regexp_extract_all(joined, F.lit(_notice(name)), F.lit(0)), _unit(k))
                          for k, name in enumerate(FAMILIES)])

    def of(lines: Column) -> Column:
        single = F.transform(lines, _unit(-1))
        return F.when(_anchored(paragraph), F.concat(single, windows(lines, 2), windows(lines, 3), bind(_joined(paragraph), notices))).otherwise(single)

    return bind(F.split(paragraph, "\n", -1), of)


def train(docs: DataFrame, sample: int = SAMPLE):
    """(hashing, model, bar) from the templates and a bounded sample of lines of ``docs``."""
    spark = docs.sparkSession
    notice = F.col("line").rlike(ANCHOR) & _joined(F.col("line")).rlike("|".join(_notice(name) for name in FAMILIES))
    share = 2 * sample / max(docs.count(), 1)
    some = docs if share >= 1 else docs.where(F.xxhash64("doc_id", "text") < int(share * 2**64) - 2**63)
    lines = (paragraphs(some).select(F.explode(F.split("paragraph", "\n", -1)).alias("line"))
             .select("line", words_of(F.col("line")).alias("words"))
             .where((F.size("words") >= 3) & (_any_overlap(F.col("words")) < 0.5) & ~notice))
    picked = materialise(lines.select("words", F.xxhash64("line").alias("h")).orderBy("h").limit(2 * sample), "licence-sample")
    variants = _templates(spark).select("family", "short", "words", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("v")).select(
        "family", F.filter("words", lambda w: F.col("short") | (F.col("v") == 0) | (F.pmod(F.xxhash64(w, F.col("v")), F.lit(8)) > 0)).alias("words"))
    unknown = F.pmod(F.xxhash64(F.col("h")), F.lit(2))
    rows = variants.unionByName(picked.where(unknown == 0).select(F.lit(UNKNOWN).alias("family"), "words"))
    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features")
    known = hashing.transform(rows.select(F.col("family").cast("double").alias("label"), grams_of(F.col("words")).alias("grams")))
    model = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=25).fit(known.coalesce(4))
    held = model.transform(hashing.transform(picked.where(unknown == 1).select(grams_of(F.col("words")).alias("grams"))))
    worst = held.select((1 - _probability(F.col("probability"), UNKNOWN)).alias("p")).agg(F.percentile_approx("p", 0.999, 10000)).first()[0]
    return hashing, model, min(0.95, max(0.5, worst or 0.0))


def _probability(vector: Column, place: int) -> Column:
    from pyspark.ml.functions import vector_to_array

    return F.get(vector_to_array(vector), F.lit(place))


def licences(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, licence, n_paragraphs, probability, overlap) for every licence that paragraphs
    of a document are confirmed to name."""
    from pyspark.ml.functions import vector_to_array

    hashing, model, bar = train(docs, sample)
    keys = ["doc_id", "row", "place", "named"]
    # words are made, and lines left out, before the rows, so that neither is done twice
    in_words = F.transform(units(F.col("paragraph")), lambda u: F.struct(u["named"].alias("named"), words_of(u["text"]).alias("words")))
    worth = F.filter(in_words, lambda u: (u["named"] >= 0) | (F.size(u["words"]) >= 2) & _confirmable(u["words"]))
    lines = (paragraphs(docs).select("doc_id", "row", "place", F.explode(worth).alias("unit"))
             .select("doc_id", "row", "place", "unit.named", "unit.words"))
    scored = model.transform(hashing.transform(lines.select(*keys, "words", grams_of(F.col("words")).alias("grams"))))
    chances, notice = vector_to_array("probability"), F.col("named") >= 0
    hit = scored.select(*keys, "words", F.when(notice, F.col("named")).otherwise(F.col("prediction").cast("int")).alias("family"),
                        F.when(notice, F.get(chances, F.col("named"))).otherwise(F.array_max(F.slice(chances, 1, UNKNOWN))).alias("probability"))
    hit = hit.where(notice | (F.col("family") != UNKNOWN) & (F.col("probability") >= bar))
    overlap = F.when(notice, F.lit(1.0)).otherwise(_overlap(F.col("words"), F.col("family")))
    confirmed = hit.withColumn("overlap", overlap).where(F.col("overlap") >= CONFIRM)
    name = F.get(F.array(*[F.lit(f) for f in FAMILIES]), F.col("family"))
    best = [F.max("probability").alias("probability"), F.max("overlap").alias("overlap")]
    return (confirmed.groupBy("doc_id", "row", "place", name.alias("licence")).agg(*best)
            .groupBy("doc_id", "licence").agg(F.count("*").alias("n_paragraphs"), *best))
