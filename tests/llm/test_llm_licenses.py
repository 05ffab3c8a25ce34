"""Licenses that differ in a word, and notices wrapped as license files are."""

import textwrap

from pyspark.sql import functions as F

from tagmeans.llm import licenses


def labels(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.i: r.labels for r in licenses.scan(df).select(F.col("row.doc_id").alias("i"), "labels").collect()}
    return [got[i] for i in range(len(texts))]


def test_near_misses(spark):
    want = {"Licensed under CC BY 4.0": ["cc-by"], "Licensed under CC BY-SA 4.0": ["cc-by-sa"],
            "Licensed under CC BY-NC 4.0": ["cc-by-nc"], "Released under the BSD License": ["bsd"],
            "Released under the Apache License": [], "Released under the MIT License": ["mit"],
            "Licensed under the GPL license, version 2.0": ["gpl-2"],
            "GNU Lesser General Public License, version 2.1": ["lgpl-2.1"],
            "This work is licensed under the GNU General Public License version 2": ["gpl-2"],
            "This work is licensed under the GNU Affero General Public License version 3": ["agpl-3"],
            "Licensed under the Apache License, Version 2.0": ["apache-2"],
            "all " + "word " * 30 + "rights " + "word " * 30 + "reserved": []}
    assert dict(zip(want, labels(spark, list(want)))) == want


def test_wrapped_notices_and_identifiers(spark):
    wrapped = [(t, [label]) for label, t, _, _ in licenses.NOTICES if len(t.split()) > 15]
    texts = [("pad " * k + "\n" + textwrap.fill(t, width, initial_indent=" * ", subsequent_indent=" * "), want)
             for t, want in wrapped for width in (50, 72) for k in (0, 47, 95)]
    texts += [(f"# SPDX-License-Identifier: {x}", [want]) for x, want in (
        ("MIT", "mit"), ("Apache-2.0", "apache-2"), ("GPL-3.0-or-later", "gpl-3"), ("LGPL-2.1-only", "lgpl-2.1"),
        ("BSD-3-Clause", "bsd"), ("MPL-2.0", "mpl-2"), ("CC-BY-SA-4.0", "cc-by-sa"))]
    got = labels(spark, [t for t, _ in texts])
    assert [(t, g) for (t, want), g in zip(texts, got) if g != want] == []


GRANT = ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
         "documentation files the software to use the software without restriction")


def test_blocks_over_the_threshold(spark):
    """Notices in other words, down to the threshold, and labels that their words leave open."""
    texts = {GRANT: (["mit"], 22 / 24), "pad " * 53 + GRANT.replace("software ", "software, ") + " pad" * 9: (["mit"], 22 / 24),
             "Released under the Apache License": ([], 0.8), "we reserved all the rights": ([], 1.0),
             "this work is licensed under the GNU General Public License": ([], 10 / 12),
             "this work is licensed under the GNU General Public License, version 2": (["gpl-2"], 1.0),
             "All rights reserved. " + "pad " * 80 + "Licensed under the MIT licence": (["all-rights-reserved", "mit"], 1.0),
             "SPDX-License-Identifier: Apache-2.0 OR MIT": (["apache-2", "mit"], 1.0),
             "SPDX-License-Identifier: MIT OR Apache-2.0": (["apache-2", "mit"], 1.0),
             "Apache License v2.0": (["apache-2"], 1.0), "released under a license": ([], 0.0),
             "Creative Commons Attribution-NonCommercial 4.0 International License": (["cc-by-nc"], 1.0),
             "Made available under the terms of the Eclipse Public License v. 2.0": (["epl-2"], 1.0),
             "\u212Aey permission \u0130 hereby": ([], 0.0), "": ([], 0.0)}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.i: (r.labels, r.score) for r in licenses.scan(df).select(F.col("row.doc_id").alias("i"), "labels", "score").collect()}
    for (i, g), (t, (labels_, score)) in zip(sorted(got.items()), texts.items()):
        assert (t, g[0]) == (t, labels_) and abs(g[1] - score) < 1e-9, (t, g)


def test_against_sql_on_near_notices(spark, tmp_path):
    """Notices with words dropped, doubled, changed and cut, one after the other, against the SQL rule."""
    import random

    import duckdb

    r, rows = random.Random(6), []
    for i in range(160):
        ws = []
        for _ in range(r.randint(1, 3)):
            notice = r.choice(licenses.NOTICES)[1].split()
            notice = [r.choice(["the", "version", "mit", "x"]) if r.random() < 0.08 else w for w in notice if r.random() > 0.06]
            ws += ["pad"] * r.choice([0, 1, 3, 30, 70]) + notice + r.choice([[], notice[:4]])
        rows.append((i, r.choice([" ", "\n", ", "]).join(ws).title() if i % 2 else " ".join(ws)))
    rows += [(200, None), (201, ""), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.toPandas().to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet')")
    res = con.execute(licenses.oracle())
    cols = [d[0] for d in res.description]
    got = licenses.query(spark, str(tmp_path)).select(*cols).collect()
    want = res.fetchall()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert len({x[6] for x in want}) > 15


def test_only_texts_with_whole_words_are_looked_at_closer(spark):
    texts = ["submit dispdxed recodes by-laws", "Unlicensed (mitigated) ", "(SPDX) ", "x Apache; license, VERSION--2.", "a spdxé b",
             "", " .", None, "K spKdx", "one\x00two\x7f"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = (licenses._parted(df, "text", ["spdx", "code", "mit"], licenses.PHRASES)
           .orderBy("row.doc_id").select("n_words", "low").collect())
    assert [r.low for r in got] == [None, None, "(spdx) ", "x apache; license, version--2.", *[None] * 6]
    assert [r.n_words for r in got] == [5, 2, 1, 5, 3, 0, 0, 0, 2, 2]
