"""Collocation mining against plain counting, and its defined results."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tagmeans.llm import collocations
from tagmeans.llm.words import byte_kinds, word_hashes, words_of

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, longest):
    """lang, phrase, a, l, r, n, score of all kept phrases."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            ws, lang_ = re.findall(r"[^\x20\x09]+", piece), "und" if lang is None else lang
            n[lang_] += len(ws)
            for m in range(1, longest + 1):
                f[lang_].update(tuple(ws[i:i + m]) for i in range(len(ws) - m + 1))
    out = set()
    for lang, counts in f.items():
        big = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = {q[i:j] for q in big for i in range(len(q)) for j in range(i + 2, len(q) + 1)
                  if j - i < len(q) and big[q] >= counts[q[i:j]]}
        for p, a in big.items():
            if p not in inside:
                s, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                out.add((lang, " ".join(p), a, counts[p[:k]], counts[p[k:]], n[lang], s))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_counting(spark, seed):
    r = random.Random(seed)
    words = ["the", "The", "of", "a", "b", "é", "x y", " ", "z" * 300, "1", "-"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!", ";\x0b"]
    rows = [("".join(r.choice(words) + r.choice(ends) for _ in range(r.randint(0, 60))), r.choice(["en", "de", None]))
            for _ in range(120)]
    rows += [("one line that all have, and more", "en")] * 30 + [("the " * 400, "fr"), (None, None), ("", "xx"), (None, "de")]
    df = spark.createDataFrame([(t, lang, "c", 1, 2) for t, lang in rows], "text string, lang string, phrase string, n int, h int")
    got = collocations.collocations(df.repartition(5), least=4, longest=4).collect()
    assert len(got) == len(set(got))
    assert {tuple(x) for x in got} == plain(rows, 4, 4)


def test_top_orders_by_score_count_and_bytes(spark):
    rows = [("en", "b c", 5, 9), ("en", "a c", 5, 9), ("en", "é c", 5, 9), ("en", "z z", 6, 9), ("en", "q q", 1, 10), ("fr", "x x", 1, 1)]
    df = spark.createDataFrame([(*x[:3], 1, 1, 1, x[3]) for x in rows], "lang string, phrase string, a long, l long, r long, n long, score long")
    got = sorted((r.lang, r.rank, r.phrase) for r in collocations.top(df, 4).collect())
    assert got == [("en", 1, "q q"), ("en", 2, "z z"), ("en", 3, "a c"), ("en", 4, "b c"), ("fr", 1, "x x")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert collocations.top(collocations.collocations(df)).count() == 0
    blank = spark.createDataFrame([(None, None), ("", "en"), (" \t\n", "en")], "text string, lang string")
    assert collocations.collocations(blank).count() == 0


def test_words_of_slices():
    texts = pa.array(["zero", "One two\ttwo", None, "", "three.Four ", "é  five;", " six"])[1:]
    w = words_of(texts, byte_kinds(b" \t", b".;"))
    known = [x.decode() for x in w.known.to_pylist()]
    assert [known[c] for c in w.codes] == ["one", "two", "two", "three", "four", "é", "five", "six"]
    assert w.doc.tolist() == [0, 0, 0, 3, 3, 4, 4, 5] and w.left.tolist() == [3, 2, 1, 1, 1, 2, 1, 1]
    h = word_hashes(w.known)
    assert len(np.unique(h)) == len(known) and h.tolist() == word_hashes(pa.array([b"skip", *w.known.to_pylist()])[1:]).tolist()
    assert len(words_of(pa.array([], pa.string()), byte_kinds(b" ")).codes) == 0
