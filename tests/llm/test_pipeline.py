from conftest import SF001
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from shoprank.llm.licences import licences


def test_stages_keep_the_columns_and_the_clean_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, SF001)
    assert kept.columns == docs.columns
    assert kept.join(labels.where("quality = 0"), "doc_id").count() == 0
    unique = corpus_pipeline.near_duplicates(spark, kept, SF001)
    assert unique.columns == docs.columns and unique.count() == unique.select("text").distinct().count()
    packed = corpus_pipeline.run(spark, SF001)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_licence_lines_are_found(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(10**6, "First line here.\nReleased under the MIT License.\nLast."), (10**6 + 1, None), (10**6 + 2, "")], docs.schema)
    found = {(r["doc_id"], r["licence"]) for r in licences(docs.unionByName(more), 500).collect()}
    assert (10**6, "mit") in found and not {d for d, _ in found} & {10**6 + 1, 10**6 + 2}


def test_short_and_wrapped_licence_notices_are_found(spark):
    planted = [("gpl", "This work is licensed under the GNU General Public License, version 3."), ("proprietary", "All rights reserved."),
               ("cc-by-nc", "Licensed under CC BY-NC 4.0."), ("mit", "Released under the MIT License."), ("apache", "Licensed under the Apache License, Version 2.0.")]
    short = [("mit", "MIT License"), ("mit", "License: MIT"), ("isc", "ISC License"), ("bsd", "BSD 3-Clause License"), ("mpl", "License: MPL-2.0"),
             ("lgpl", "GNU Lesser General Public License"), ("cc0", "CC0 1.0"), ("cc-by-sa", "CC BY-SA 4.0"), ("cc-by", "CC BY 4.0"),
             ("proprietary", "Copyright (c) 2020 A. Person. All rights reserved."), ("mit", "x y z, used here under the MIT Licence, as was said above by them")]
    spdx = [("mit", "MIT"), ("apache", "Apache-2.0"), ("isc", "ISC"), ("bsd", "BSD-2-Clause"), ("gpl", "GPL-2.0-or-later"), ("lgpl", "LGPL-2.1-only"),
            ("agpl", "AGPL-3.0"), ("mpl", "MPL-2.0"), ("cc-by", "CC-BY-4.0"), ("cc-by-sa", "CC-BY-SA-4.0"), ("cc-by-nc", "CC-BY-NC-4.0"), ("cc0", "CC0-1.0")]
    wrapped = [("isc", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that"
                       "\nthe above copyright notice and this permission notice appear in all copies."),
               ("proprietary", "A b c. All\nrights reserved."), ("mpl", "This Source Code Form is subject to the terms of the\nMozilla Public\nLicense, v. 2.0.")]
    cases = planted + short + [(f, "SPDX-License-Identifier: " + x) for f, x in spdx] + wrapped
    both = "First paragraph.\n \n# Apache-2.0 OR MIT\n\nMIT License\nMIT License"
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    clean = [(10**6 + 500, "Mit der Lizenz: all of the rights of way are reserved for walkers."), (10**6 + 501, "rights reserved\n\nall")]
    more = spark.createDataFrame([(10**6 + k, f"One line before it.\n{x}\nThe last line.") for k, (_, x) in enumerate(cases)] + clean + [(10**6 + 600, both)] * 2, docs.schema)
    found = licences(docs.unionByName(more), 500).collect()
    assert {(r["doc_id"], r["licence"]) for r in found if 10**6 <= r["doc_id"] < 10**6 + 600} == {(10**6 + k, f) for k, (f, _) in enumerate(cases)}
    assert {(r["licence"], r["n_paragraphs"]) for r in found if r["doc_id"] == 10**6 + 600} == {("apache", 2), ("mit", 4)}
    for family, line in planted:
        own = {r["doc_id"] for r in docs.where(F.concat(F.lit("\n"), "text", F.lit("\n")).contains(f"\n{line}\n")).collect()}
        assert own <= {r["doc_id"] for r in found if r["licence"] == family}


def test_every_operator_is_registered():
    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
