"""The prefix trie against plain dictionaries, at any number of shards."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagmeans.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    """The contract's rows, node by node. ``rows``: conversation to its list of (role, text)."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rows.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in children[p]) or 1
        saved[p] = sum(saved[q] for q in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]),
                   leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
                  for p in members)


def plain_rebuilt(rows):
    turns = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda x: (x[0] or 0, x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        if c is not None:
            turns[c].append((role or "", text or ""))
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - c % 100, [])[:h] + turns[c][h:]
    return out


def made(seed, ids, texts=("a", "bb", "é\U0001F600"), most=9):
    """Random conversations of few texts, with hot ones, ties, nulls and repeated rows."""
    r, rows = random.Random(seed), []
    for c in ids:
        hot = r.random() < 0.3
        for t in range(4 if hot else r.randint(0, most)):
            text = "hot" if hot else r.choice([*texts, None])
            rows.append((c, None if r.random() < 0.05 else t, r.choice(["u", None]) if not hot else "u", text))
    return rows + rows[:5] + [(None, 1, "u", "nobody"), (None, None, None, None)]


def got(df, shards=None):
    return sorted((tuple(r) for r in trie.trie(trie.rebuilt(trie.paths(df)), shards).collect()),
                  key=lambda x: (x[0], x[1], -1 if x[2] is None else x[2], x[7]))


@pytest.mark.parametrize("shards", [None, 5, 60])
def test_against_dictionaries(spark, shards):
    rows = made(3, [*range(0, 260), 700, 701, 1205]) + [(800, t, "u", "deep" * (t % 3)) for t in range(90)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("path", F.lit(1)).withColumn("depth", F.lit("x"))
    want = plain_trie(plain_rebuilt(rows))
    assert got(df.repartition(4), shards) == sorted(want, key=lambda x: (x[0], x[1], -1 if x[2] is None else x[2], x[7]))


@pytest.mark.parametrize("wide", [1, 2, 3, 32])
def test_matrices_of_any_width(monkeypatch, wide):
    """Every depth of one shard, with rows that end at and beside the edges of a matrix."""
    monkeypatch.setattr(trie, "WIDE", wide)
    r = np.random.default_rng(wide)
    rows = [r.integers(1, 3, r.integers(0, 9)).tolist() for _ in range(150)]
    ids = r.permutation(1000)[:150]
    order, levels = trie.nodes_by_depth(ids, np.array([len(x) for x in rows]), np.concatenate(rows).astype(np.int64),
                                        np.concatenate(rows).astype(np.int64) * 10)
    assert order.tolist() == sorted(range(150), key=lambda i: (rows[i], ids[i]))
    for d, x in enumerate(levels):
        want = defaultdict(list)
        for i in range(150):
            if len(rows[i]) >= d:
                want[tuple(rows[i][:d])].append(i)
        assert x["n"].tolist() == [len(want[p]) for p in sorted(want)]
        assert x["conv_id"].tolist() == [min(ids[want[p]]) for p in sorted(want)]
        assert x["ends"].tolist() == [sum(len(rows[i]) == d for i in want[p]) for p in sorted(want)]
        if d:
            assert x["cp"].tolist() == [p[-1] * 10 for p in sorted(want)]
            up = sorted({p[:-1] for p in want} | {tuple(rows[i][:d - 1]) for i in range(150) if len(rows[i]) >= d - 1})
            assert [up[i] for i in x["parent"]] == [p[:-1] for p in sorted(want)]


def test_turnless_and_empty(spark):
    h = {c: zlib.crc32(str(c).encode()) % 6 for c in range(100, 200)}
    short = next(c for c in h if h[c] > 1 and c % 100)  # without an anchor and within its first h turns
    df = spark.createDataFrame([(short, 0, None, None)], SCHEMA)
    assert got(df) == [(short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]
    assert got(df.limit(0)) == []
    assert got(spark.createDataFrame([(None, 0, "u", "x")], SCHEMA)) == []


def test_query_over_many_shards(spark, monkeypatch):
    """The whole query at sf0.001, cut so that most nodes stand at a boundary."""
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    monkeypatch.setattr(trie, "LEAST_TURNS", 10)
    assert sorted(map(tuple, trie.query(spark, sf).collect()), key=str) == sorted(plain_trie(plain_rebuilt(rows)), key=str)
