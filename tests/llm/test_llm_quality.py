"""The quality network's long texts, and its answers against plain convolution."""

import random
import tracemalloc

import numpy as np
import pytest

from tagmeans.llm import quality


def plain_largest(model, raw):
    """The largest answer of each filter, window by window."""
    k, n = quality.WIDTH, max(-(-len(raw) // quality.STRIDE), quality.WIDTH // quality.STRIDE)
    ids = [*raw, *[quality.PAD] * (n * quality.STRIDE + k - len(raw))]
    low = [x % 256 for x in ids] + [0] * quality.GRAM
    same = [x != quality.PAD and any(i >= lag and low[i:i + quality.GRAM] == low[i - lag:i - lag + quality.GRAM]
                                     for lag in range(1, quality.LAG + 1)) for i, x in enumerate(ids)]
    x = np.array([[*model.w["embed"][i], float(s)] for i, s in zip(ids, same)])
    answers = [x[i * quality.STRIDE:i * quality.STRIDE + k].ravel() @ model.w["filter"] + model.w["bias"] for i in range(n)]
    return np.max(answers, axis=0)


def text(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(["word", "é", "again again again", "x" * 9, "\n"]) for _ in range(n))


@pytest.mark.parametrize("piece", [32, 64, 1 << 20])
def test_pieces_have_the_answers_of_the_whole(monkeypatch, piece):
    monkeypatch.setattr(quality, "LONG", piece)
    model = quality.Network()
    for seed, n in ((1, 1), (2, 20), (3, 90), (4, 91)):
        raw = text(seed, n).encode()
        assert np.allclose(model._largest(raw), plain_largest(model, raw), atol=1e-4)
    texts = ["a", text(5, 80), "", text(6, 3), text(7, 200), text(8, 200)]
    whole = [1 / (1 + np.exp(-model._top(np.maximum(plain_largest(model, t.encode()), 0))[1])) for t in texts]
    assert np.allclose(model.score(texts), whole, atol=1e-4)


def test_a_long_text_takes_the_memory_of_a_piece():
    long = text(9, 5_000_000)
    model = quality.Network()
    tracemalloc.start()
    score = model.score([long])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(long) > 20_000_000 and 0 <= score[0] <= 1 and peak < 500e6
