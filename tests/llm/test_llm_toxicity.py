"""The toxicity classifier: held-out labels, plain convolution, and its defined results."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagmeans.llm import registry, toxicity

SF = "/root/testdata/sf0.1"


def plain_pool(model, words_rows):
    """The largest answer of each filter over windows of one text, padded, one by one."""
    out = []
    pad = [np.zeros(toxicity.DIMS)] * max(toxicity.WIDTHS)
    vectors = [model.table[r].astype(np.float64).sum(axis=0) for r in words_rows] + pad
    for k in toxicity.WIDTHS:
        w = model.w[f"filter{k}"].astype(np.float64)
        seen = [sum(vectors[i + j] @ w[j] for j in range(k) if i + j < len(vectors)) for i in range(len(vectors))]
        out.append(np.max(seen, axis=0) + model.w[f"bias{k}"])
    return np.concatenate(out)


@pytest.mark.parametrize("block", [3, 1 << 16])
def test_answers_are_those_of_plain_convolution(monkeypatch, block):
    monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", block)
    r = np.random.default_rng(4)
    model = toxicity.Network()
    model.table = r.normal(0, 1, model.table.shape).astype(np.float32)
    model.table[0] = 0
    texts = ["", "one", "One, two! three four", " ".join(f"w{i % 7}" for i in range(40)), "é ñ ß", "..."]
    t = toxicity.Texts(texts)
    pooled, _ = model._pooled(t.codes, t.first, model.table[t.rows].sum(axis=1))
    for i, text in enumerate(texts):
        words = t.codes[t.first[i]:t.first[i + 1] - 3]
        assert len(words) == len([w for w in text.replace(",", " ").replace("!", " ").replace(".", " ").split()])
        assert np.allclose(pooled[i], plain_pool(model, t.rows[words]), atol=1e-4)
    alone = np.concatenate([model.score([x]) for x in texts])
    assert np.allclose(model.score(texts), alone, atol=1e-6)


def test_slopes_are_those_of_the_loss():
    r = np.random.default_rng(5)
    model = toxicity.Network()
    model.table = r.normal(0, 1, model.table.shape).astype(np.float32)
    model.table[0] = 0
    t, y = toxicity.Texts(["a b c d a", "b b", "e f a"]), np.array([1, 0, 1], np.float32)

    def loss():
        z = model.logits(t)
        return float(np.mean(np.log1p(np.exp(-np.where(y > 0, z, -z)))))

    g, _ = model._slopes(t.codes, t.first, t.rows, y)
    for k, i in (("out", 0), ("out", 20), ("bias2", 3), ("filter1", (0, 2, 1)), ("filter3", (2, 5, 4)), ("filter2", (1, 0, 7))):
        old = model.w[k][i]
        model.w[k][i] = old + 1e-2
        up = loss()
        model.w[k][i] = old - 1e-2
        down = loss()
        model.w[k][i] = old
        assert abs((up - down) / 2e-2 - g[k][i]) < 2e-3


def test_cuts():
    z, y = np.array([3.0, 2.0, 2.0, 1.0, -1.0]), np.array([1, 1, 1, 0, 0])
    assert toxicity.best_cut(z, y, 1.0) == 1.5
    assert toxicity.best_cut(z, np.array([1, 1, 0, 0, 0]), 50.0) == 2.5
    assert toxicity.best_cut(z, np.zeros(5), 1.0) == toxicity.best_cut(z[:0], y[:0], 1.0)


def test_language_is_told_from_words():
    t = toxicity.Texts(["The cat AND the dog", "der Hund und die Katze", "le chat et les chiens", "el gato y los perros", "xyz", ""])
    assert [toxicity.LANGUAGES[i] for i in t.language] == ["en", "de", "fr", "es", "", ""]


def test_held_out_labels(spark):
    """The whole query at sf0.1: rows that no label was learned from."""
    rows = registry.QUERIES["op13_toxicity"](spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(rows) == 10_000 and rows.score.between(0, 1).all() and ((rows.score >= 0.3) == rows.predicted.astype(bool)).all()
    x = rows[rows.held_out].merge(labels, on="doc_id")
    bad, good = x[x.toxic == 1], x[x.toxic == 0]
    assert bad.predicted.mean() >= 0.7 and good.predicted.mean() <= 0.02
    english = bad.merge(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    assert english[english.lang == "en"].predicted.mean() >= 0.85


def test_columns_that_are_no_inputs(spark):
    r = random.Random(1)
    texts = [" ".join(r.choice(["the", "a", "cat", "dog", "of"]) for _ in range(12)) + (" idiot" if i % 3 == 0 else "") for i in range(240)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(240)] + [(3, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    first = {x.t: x.score for x in toxicity.with_toxicity(docs, model).select(F.col("row.text").alias("t"), "score").collect()}
    other = docs.withColumn("lang", F.lit(None).cast("string")).withColumn("score", F.lit("x")).repartition(7)
    again = toxicity.with_toxicity(other, toxicity.train(other, labels))
    assert again.select("row.*").columns == other.columns
    again = {x.t: x.score for x in again.select(F.col("row.text").alias("t"), F.col("score")).collect()}
    assert again.keys() == first.keys() and all(abs(again[t] - first[t]) < 2e-6 for t in first)
    assert np.mean([(first[t] >= 0.3) == ("idiot" in t) for t in texts]) > 0.98


def test_defined_results(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "word " * 200_000), (5, "x" * 100_000), (5, "again"), (None, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for marks in ([(1, 0), (2, 1), (3, None), (None, 1), (4, 0), (5, 1), (99, 1)], [(4, 1)], []):
        labels = spark.createDataFrame(marks, "doc_id long, toxic int")
        out = toxicity.with_toxicity(docs, toxicity.train(docs, labels)).select("row.*", "score").collect()
        assert len(out) == len(rows) and all(0 <= x.score <= 1 for x in out)
        assert len({x.score for x in out if not (x.text or "").strip()}) == 1
        assert len({x.score for x in out if x.text == "again"}) == 1
    assert toxicity.train(docs, labels).score([""]).tolist() == [0.0]
    assert toxicity.with_toxicity(docs.limit(0), toxicity.train(docs.limit(0), labels)).count() == 0


def test_every_labelled_row_teaches(spark):
    """Toxic texts that are all above 10,000 characters, dealt to shards that take several rounds; every
    labelled row that isn't held out is learned from, once and whole."""
    r = random.Random(2)
    words = ["the", "a", "cat", "dog", "of", "house"]
    texts = {i: " ".join(r.choice(words) for _ in range(3000 if i % 5 == 0 else 20)) + (" idiot" if i % 5 == 0 else "")
             for i in range(400)}
    docs = spark.createDataFrame([*texts.items(), (3, "zzz"), (5, None), (None, "idiot")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(4, None), (10, 0), (999, 1)], "doc_id long, toxic int")
    rows = toxicity.labelled(docs, labels, "doc_id", "text", "toxic", 50).collect()
    learned = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 != 2]
    texts[5] = "" if 5 in learned else texts[5]
    assert sorted((x.y, x.t) for x in rows) == sorted((int(i % 5 == 0), texts[i]) for i in learned)
    assert len({x.shard for x in rows}) > 2 and len({x.apart for x in rows}) == 2
    for shard in (50, toxicity.SHARD):
        model = toxicity.train(docs, labels, shard=shard)
        out = toxicity.with_toxicity(docs.where("doc_id is not null and text is not null"), model).select("row.*", "score").collect()
        assert np.mean([(x.score >= 0.3) == ("idiot" in x.text) for x in out]) > 0.98


def test_long_texts_give_their_slopes(monkeypatch):
    r = np.random.default_rng(6)
    model = toxicity.Network()
    model.table = r.normal(0, 1, model.table.shape).astype(np.float32)
    model.table[0] = 0
    t, y = toxicity.Texts([" ".join(f"w{i * 7 % 31}" for i in range(50)), "a b", "c"]), np.array([1, 0, 1], np.float32)
    g, back = model._slopes(t.codes, t.first, t.rows, y)
    monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", 7)
    h, again = model._slopes(t.codes, t.first, t.rows, y)
    assert np.allclose(back, again, atol=1e-5) and all(np.allclose(g[k], h[k], atol=1e-5) for k in g)
    # every row of a batch is gone over in each pass
    words = np.array([3, 9, 2, 2, 4])
    assert [x.tolist() for x in toxicity._parts(np.array([4, 1, 2, 3, 0]), words)] == [[4], [1], [2, 3, 0]]
