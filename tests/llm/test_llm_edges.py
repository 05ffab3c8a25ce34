"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column
names: every operator has a defined result for them."""

import pytest
from pyspark.sql import functions as F

from tagmeans.llm import (decontamination, html_text, licenses, mixing, neighbours, pii, quality, simhash, spans,
                          token_output)

CLASH = ["row", "n_words", "spans", "items", "print", "root", "component_id", "score", "text_", "n", "posterior",
         "rate", "copies", "k", "size", "uid", "kinds", "main_text", "kept", "hash", "id", "nth", "hit", "runs"]
LONG = "word " * 60_000 + "end"
ROWS = [(1, None), (2, ""), (3, "  \n\t "), (4, LONG), (5, "alpha beta gamma delta"), (5, "alpha beta gamma delta"),
        (None, "alpha beta gamma delta"), (None, None), (6, "\u2028 \U0001F600 é A's 1.5"), (7, "x" * 5000)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"),
                     *[F.lit(c).alias(c) for c in CLASH]).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(4, 1, 0), (5, 0, 1), (5, 1, 0), (None, 1, 1), (6, None, None), (99, 0, 0)],
        "doc_id long, quality int, toxic int")


BENCH = "item_id long, text string"


def same_columns(out, docs, rows):
    assert out.select("row.*").columns == docs.columns
    assert out.count() == rows


def test_decontamination(spark, docs, none):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "Alpha  beta"), (None, "gamma delta"), (3, "alpha beta")], BENCH)
    out = decontamination.find_benchmark(docs, bench)
    same_columns(out, docs, len(ROWS))
    hits = {r.t: (r.n_words, [tuple(s) for s in r.spans], r["items"]) for r in out.select(
        F.col("row.text").alias("t"), "n_words", "spans", "items").collect()}
    assert hits["alpha beta gamma delta"] == (4, [(0, 4)], ["3"])
    assert hits[None] == hits[""] == (0, [], []) and hits[LONG] == (60_001, [], [])
    kept = decontamination.decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3
    assert decontamination.decontaminate(none, bench).count() == 0
    assert decontamination.decontaminate(docs, bench.limit(0)).count() == len(ROWS)


def test_simhash(docs, none):
    out = simhash.near_duplicates(docs)
    same_columns(out, docs, len(ROWS))
    got = {(r.i, r.t): (r.print, r.component_id) for r in out.select(
        F.col("row.doc_id").alias("i"), F.col("row.text").alias("t"), "print", "component_id").collect()}
    assert got[1, None] == got[2, ""] == got[None, None] == got[3, "  \n\t "] == (0, 1)
    assert got[5, "alpha beta gamma delta"][1] == got[None, "alpha beta gamma delta"][1] == 5
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 4, 5, 6, 7]
    assert simhash.drop_near_duplicates(none).count() == 0


def test_quality(docs, none, labels):
    for table in (labels, labels.limit(0)):
        model = quality.train(docs, table)
        out = quality.with_quality(docs, model)
        same_columns(out, docs, len(ROWS))
        assert all(0 <= r.score <= 1 for r in out.select("score").collect())
    assert quality.train(docs, labels.limit(0)).score([""]).tolist() == [0.5]
    assert quality.keep_good(none, labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).columns == docs.columns
    empty = [r.score for r in out.where("row.text is null or row.text = ''").select("score").collect()]
    assert len(set(empty)) == 1


def test_mixing(docs, none, labels):
    for table in (labels, labels.limit(0)):
        out, domains = mixing.mix(docs, table)
        same_columns(out, docs, len(ROWS))
        got = out.select(F.col("row.text").alias("t"), "n", "rate", "posterior").collect()
        assert all(r.rate >= 0 and abs(sum(r.posterior) - 1) < 1e-9 and len(r.posterior) == len(domains) for r in got)
        assert all(r.rate == 1 and r.n == 0 for r in got if not (r.t or "").strip())
    assert mixing.mixed(docs, labels).columns == docs.columns
    assert mixing.mixed(none, labels).count() == 0


def test_licenses(docs, none):
    out = licenses.scan(docs)
    assert out.select("row.*").columns == [c for c in docs.columns if c != "text"]
    got = out.select("n_words", "labels", "score", "starts").collect()
    assert len(got) == len(ROWS) and all(r.labels == [] and r.score == 0 and r.starts == [] for r in got)
    assert sorted(r.n_words for r in got) == [0, 0, 0, 0, 1, 4, 4, 4, 7, 60_001]
    assert licenses.scan(none).count() == 0


def test_pii(docs, none):
    out = pii.pseudonymize(docs)
    same_columns(out, docs, len(ROWS))
    assert sorted((r.text, r.kinds) for r in out.select("row.text", "kinds").collect()) == sorted(
        (t or "", []) for _, t in ROWS)
    assert pii.pseudonymize(none).count() == 0


def test_html(docs, none):
    out = html_text.extract(docs, "text")
    same_columns(out, docs, len(ROWS))
    got = {r.t: r.main_text for r in out.select(F.col("row.text").alias("t"), "main_text").collect()}
    assert got[None] == got[""] == got["  \n\t "] == "" and got["x" * 5000] == "x" * 5000
    assert got[LONG] == LONG
    assert html_text.extract(none, "text").count() == 0


def test_spans(docs, none):
    out = spans.removed(docs)
    same_columns(out, docs, len(ROWS))
    got = out.select(F.col("row.text").alias("t"), "n_bytes", "spans", "kept").collect()
    for r in got:
        data = (r.t or "").encode()
        assert r.n_bytes == len(data)
        whole = len(data) >= 400  # both long texts repeat themselves
        assert (bytes(r.kept) != data) == whole
    assert {r.t: bytes(r.kept) for r in got}["x" * 5000] == b""
    assert spans.removed(none).count() == 0


def test_token_output(spark, docs, none, tmp_path):
    path = token_output.default_path()
    folder = token_output.write_tokens(docs, str(tmp_path / "a"), path)
    got = token_output.digest(token_output.read_tokens(spark, folder)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7]
    assert [r.n_tokens for r in got if r.doc_id in (1, 2)] == [1, 1] and got[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    folder = token_output.write_tokens(none, str(tmp_path / "b"), path)
    assert token_output.read_tokens(spark, folder).count() == 0


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 2), (2, [0.5, 0.5], 1),
            (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, None], 1),
            (8, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (40, None, 1), (9, [2.0, -3.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = [tuple(r) for r in neighbours.search(df, queries=F.col("id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert [(q, r, v) for q, r, v, _ in got] == [(0, 1, 9), (0, 2, 1), (0, 3, 20), (0, 4, 2),
                                                 (20, 1, 9), (20, 2, 0), (20, 3, 1), (20, 4, 2)]
    assert [s for *_, s in got[:4]] == [2.0, 1.0, 1.0, 0.5]
    assert neighbours.search(df.limit(0)).count() == 0
    assert neighbours.search(df.where("vec_id = 4")).count() == 0
