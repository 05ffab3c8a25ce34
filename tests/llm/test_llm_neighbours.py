"""Recall of the forest where vectors crowd, and its exchange of candidates."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagmeans.llm import neighbours


def made(kind, n=4000, d=24):
    r = np.random.default_rng(8)
    v = r.normal(size=(n, d)) / np.sqrt(d)
    if kind == "hot":  # a third of the rows in one cluster
        v[:n // 3] = v[0] + 0.1 * v[:n // 3]
    elif kind == "zipf":
        centers = r.normal(size=(200, d)) / np.sqrt(d)
        v = centers[np.minimum(r.zipf(1.5, n) - 1, 199)] + 0.2 * v
    elif kind == "long":  # a cluster and a few vectors much longer than the rest
        v[:n // 3] = v[0] + 0.1 * v[:n // 3]
        v[r.choice(n, 12, replace=False)] *= 4
    return v.astype(np.float32)


@pytest.mark.parametrize("kind", ["hot", "zipf", "long"])
@pytest.mark.parametrize("array", ["array<float>", "array<double>"])
def test_recall_where_vectors_crowd(spark, kind, array):
    v = made(kind)
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], f"vec_id long, embedding {array}")
    got = defaultdict(list)
    for row in neighbours.search(df, queries=F.col("id") % 20 == 0, part=600).orderBy("query_id", "rank").collect():
        got[row.query_id].append((row.vec_id, row.score))
    v, hits = v.astype(np.float64), []
    for q in range(0, len(v), 20):
        s = v @ v[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(len(v)), -s))[:20]
        hits.append(len(set(best) & {i for i, _ in got[q]}) / 20)
        assert len(got[q]) == len(set(got[q])) == 20 and all(abs(s[i] - x) < 1e-9 for i, x in got[q])
    assert np.mean(hits) >= 0.9


def test_whole_query_recall(spark):
    """All queries of sf0.01 against brute force."""
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = {r.vec_id: np.array(r.embedding, float) for r in rows if r.embedding}
    ids, v = np.array(list(rows)), np.array(list(rows.values()))
    got = defaultdict(list)
    for r in neighbours.query(spark, sf).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    asked = [i for i in ids if i % 20 == 0]
    assert sorted(got) == sorted(asked)
    hits = []
    for q in asked:
        s = v @ rows[q]
        s[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]]
        hits.append(len(set(best.tolist()) & set(got[q])) / 20)
    assert np.mean(hits) >= 0.9
