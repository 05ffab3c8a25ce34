"""Repeated spans: orders of windows in a bucket, hot buckets dealt anew, a passage that all texts hold."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagmeans.llm import orders, spans


def kept(texts, length):
    """The bytes of each text that no repeated window covers."""
    windows = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if windows[t[p:p + length]] > 1:
                mask[p:p + length] = b"\1" * length
        out.append(bytes(c for c, m in zip(t, mask) if not m))
    return out


def got(spark, texts, length, reach):
    df = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    rows = spans.removed(df, length=length, reach=reach).select(F.col("row.doc_id").alias("i"), "kept").collect()
    return [bytes(r.kept) for r in sorted(rows)]


@pytest.mark.parametrize("members", [1, 6, 4096])
def test_hot_buckets(spark, monkeypatch, members):
    """A notice that most texts hold between words of their own, cut at many places, and copies of whole texts."""
    monkeypatch.setattr(spans, "MEMBERS", members)
    monkeypatch.setattr(spans, "SALTS", 3)
    r = random.Random(members)
    word = lambda n: "".join(r.choice("abcdef ") for _ in range(n))
    notice = word(70)
    texts = [word(r.randint(0, 40)) + notice[r.randint(0, 12):r.randint(50, 70)] + word(r.randint(0, 40)) for _ in range(70)]
    texts += texts[:9] + [texts[0]] * 20 + [notice + notice, "", "short"]
    texts = [t.encode() for t in texts]
    assert got(spark, texts, 40, 16) == kept(texts, 40)


def test_windows_of_a_bucket():
    """Every run of a bucket's repeated windows, against plain comparison, for parts of the range too."""
    r = random.Random(7)
    length = 24
    for _ in range(30):
        core = bytes(r.choice(b"ab") for _ in range(9))
        data, x, n = [], [], []
        while len(data) < 12:
            before, after = r.randint(0, 15), r.randint(0, 15)
            d = bytes(r.choice(b"ab") for _ in range(before)) + core + bytes(r.choice(b"ab") for _ in range(after))
            # windows of a phrase begin 0 to 15 bytes before its trigger
            if len(d) >= length and before - (len(d) - length) >= 0 and (d, before) not in zip(data, x):
                data.append(d)
                x.append(before)
                n.append(len(d) - length + 1)
        count = np.array([r.choice([1, 1, 2]) for _ in data])
        group = np.array(sorted(r.choice([0, 1]) for _ in data))
        for lo, hi in ((0, 15), (0, 7), (8, 15), (3, 3)):
            out = set()
            for row, a, b in zip(*orders.repeated_windows(group, data, np.array(x), np.array(n), count, lo, hi, length)):
                out |= {(int(row), p) for p in range(a, b)}
            windows = Counter((group[i], x[i] - p, d[p:p + length]) for i, d in enumerate(data) for p in range(n[i]))
            want = {(i, p) for i, d in enumerate(data) for p in range(n[i]) if count[i] == 1 and lo <= x[i] - p <= hi
                    and windows[group[i], x[i] - p, d[p:p + length]] > 1}
            assert out == want


def test_one_very_long_text(spark):
    r = random.Random(2)
    word = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    part = word(900)
    texts = [(word(300_000) + part + word(100_000) + part).encode(), b"y" * 200_000, (word(500) + part[:450]).encode()]
    sizes = [len(t) for t in got(spark, texts, 400, 256)]
    assert sizes == [len(texts[0]) - 1800, 0, 500]
