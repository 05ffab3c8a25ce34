"""Quality classifier: a byte-level convolutional network, trained and run in numpy.

A text's bytes go through a learned embedding; a further channel marks bytes
whose last ``GRAM`` bytes stood before within ``LAG`` bytes. Learned filters of
``WIDTH`` bytes slide over the whole text in steps of ``STRIDE``; the largest
answer of each filter over all chunks goes through one more layer to one
probability.

The network is trained on the driver on at most ``SAMPLE`` labelled rows with
texts of at most ``SAMPLE_CHARS`` characters (at most some 80 MB), picked by hash
of the id. Scores come from whole texts, whatever their length: long ones are gone through in
overlapping pieces, with the largest answers so far, in the memory of one piece.

Defined results: null and empty texts are scored as one chunk of padding;
repeated rows get equal scores; without usable labels every score is 0.5, with
labels of one class only every score is that class' share; a label or fold that
is null teaches nothing; every further column passes through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_from_text, labelled_sample, table

EMBED, WIDTH, STRIDE, FILTERS, HIDDEN = 6, 16, 8, 24, 12
LAG, GRAM = 32, 4
SAMPLE, SAMPLE_CHARS, EPOCHS, BATCH = 2400, 20_000, 6, 32
#: Characters that are scored together (their channels stay in the processor's cache).
CHARS_AT_ONCE = 1 << 16
#: Bytes beyond which a text is scored in pieces, and bytes of a piece (whole steps).
LONG = 1 << 20
#: A document is predicted to be good from this score on.
CUT = 0.3
PAD = 256
CHANNELS = EMBED + 1


def as_bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded byte numbers of all texts one after the other, their recurrence
    channel, and the first step (of ``STRIDE`` bytes) of each text and the end.

    Each text is padded to whole steps and at least one whole filter, and then
    by a filter's width, so no filter covers two texts."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    n = np.array([len(r) for r in raw])
    steps = np.maximum(-(-n // STRIDE), WIDTH // STRIDE) + WIDTH // STRIDE
    first = np.r_[0, np.cumsum(steps)]
    out = np.full(first[-1] * STRIDE, PAD, np.int16)
    for r, at in zip(raw, first * STRIDE):
        out[at:at + len(r)] = np.frombuffer(r, np.uint8)
    return out, recurring(out), first


def recurring(out: np.ndarray) -> np.ndarray:
    """Whether each byte's last ``GRAM`` bytes stood before within ``LAG`` bytes."""
    low = np.append(out.astype(np.uint8), np.zeros(GRAM, np.uint8))
    gram = np.ndarray(len(out), "<u4", low, strides=(1,)).copy()
    same, block = np.zeros(len(out), bool), 1 << 15
    for a in range(0, len(out), block):  # in pieces that stay in the processor's cache
        for lag in range(1, LAG + 1):
            b = max(a, lag)
            now = gram[b:a + block]
            same[b:a + block] |= now == gram[b - lag:b - lag + len(now)]
    same &= out != PAD
    return same


class Network:
    """The weights, answers and training steps of the network."""

    def __init__(self, seed: int = 1):
        r = np.random.default_rng(seed)
        f = np.float32
        self.w = {
            "embed": r.normal(0, 0.5, (PAD + 1, EMBED)).astype(f),
            "filter": r.normal(0, 1 / np.sqrt(WIDTH * CHANNELS), (WIDTH * CHANNELS, FILTERS)).astype(f),
            "bias": np.zeros(FILTERS, f),
            "hidden": r.normal(0, 1 / np.sqrt(FILTERS), (FILTERS, HIDDEN)).astype(f),
            "hidden_bias": np.zeros(HIDDEN, f),
            "out": r.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN).astype(f), "out_bias": np.zeros(1, f)}

    def _answers(self, data):
        """Answers of all filters by step, without those that cover padding between texts."""
        out, same, first = data
        x = self._channels(out, same)
        answers = self._steps(x)
        for i in range(WIDTH // STRIDE):
            answers[first[1:] - 1 - i] = -np.inf
        return x, answers

    def _steps(self, x):
        """Answers of all filters by step; none where a filter would pass the end."""
        parts = x.reshape(-1, STRIDE * CHANNELS)
        k, n = WIDTH // STRIDE, len(parts)
        each = parts @ np.concatenate(list(self.w["filter"].reshape(k, -1, FILTERS)), axis=1)
        answers = np.full((n, FILTERS), -np.inf, np.float32)
        answers[:n - k + 1] = self.w["bias"] + sum(
            each[i:n - k + 1 + i, i * FILTERS:(i + 1) * FILTERS] for i in range(k))
        return answers

    def _largest(self, raw: bytes) -> np.ndarray:
        """The largest answer of each filter in a long text, piece by piece. A piece has ``LAG`` bytes
        before it and a filter's width and more after it, so its answers are those of the whole text."""
        top = np.full(FILTERS, -np.inf, np.float32)
        steps = max(-(-len(raw) // STRIDE), WIDTH // STRIDE)
        for step in range(0, steps, LONG // STRIDE):
            n = min(LONG // STRIDE, steps - step)
            a, b = step * STRIDE - LAG, (step + n + 1) * STRIDE + WIDTH
            out = np.full(b - a, PAD, np.int16)
            part = raw[max(a, 0):b]
            out[max(-a, 0):max(-a, 0) + len(part)] = np.frombuffer(part, np.uint8)
            answers = self._steps(self._channels(out, recurring(out)))[LAG // STRIDE:LAG // STRIDE + n]
            top = np.maximum(top, answers.max(axis=0))
        return top

    def _channels(self, out, same):
        """The input channels of each byte: its embedding and whether it recurs."""
        both = np.zeros((2, PAD + 1, CHANNELS), np.float32)
        both[:, :, :EMBED] = self.w["embed"]
        both[1, :, EMBED] = 1
        return both.reshape(-1, CHANNELS).take(out + np.int16(PAD + 1) * same, axis=0)

    def _top(self, pooled):
        h = np.maximum(pooled @ self.w["hidden"] + self.w["hidden_bias"], 0)
        return h, h @ self.w["out"] + self.w["out_bias"][0]

    def score(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 of each text."""
        size = np.array([len(t) for t in texts])
        held = np.cumsum(size) // CHARS_AT_ONCE
        alone = size > LONG
        new = (np.diff(held) > 0) | alone[1:] | alone[:-1]
        cuts = np.r_[0, np.flatnonzero(new) + 1, len(texts)]
        return np.concatenate([self._score(texts[a:b]) for a, b in zip(cuts[:-1], cuts[1:])])

    def _score(self, texts: list[str]) -> np.ndarray:
        if len(texts) == 1 and len(texts[0]) > LONG:
            largest = self._largest(texts[0].encode("utf-8", "replace"))[None]
        else:
            data = as_bytes(texts)
            _, answers = self._answers(data)
            largest = np.maximum.reduceat(answers, data[2][:-1], axis=0)
        pooled = np.maximum(largest, 0)
        return 1 / (1 + np.exp(-np.clip(self._top(pooled)[1].astype(np.float64), -30, 30)))

    def slopes(self, data, y):
        """Loss and gradients over some texts; only the largest answers pass gradients on."""
        out, _, first = data
        x, answers = self._answers(data)
        best = np.stack([a + answers[a:b].argmax(axis=0) for a, b in zip(first[:-1], first[1:])])
        raw = np.take_along_axis(answers, best, axis=0)
        pooled = np.maximum(raw, 0)
        h, z = self._top(pooled)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        dz = ((p - y) / len(y)).astype(np.float32)
        dh = np.outer(dz, self.w["out"]) * (h > 0)
        dpool = (dh @ self.w["hidden"].T) * (raw > 0)
        at = best[:, :, None] * STRIDE + np.arange(WIDTH)
        seen = x[at].reshape(*best.shape, -1)  # texts, filters, width * channels
        g = {"out": h.T @ dz, "out_bias": dz.sum(keepdims=True), "hidden": pooled.T @ dh,
             "hidden_bias": dh.sum(axis=0), "bias": dpool.sum(axis=0),
             "filter": np.einsum("nfk,nf->kf", seen, dpool)}
        back = np.einsum("kf,nf->nfk", self.w["filter"], dpool).reshape(*best.shape, WIDTH, CHANNELS)
        g["embed"] = np.zeros_like(self.w["embed"])
        np.add.at(g["embed"], out[at].ravel(), back[..., :EMBED].reshape(-1, EMBED))
        loss = -np.mean(y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))
        return loss, g

    def fit(self, texts: list[str], labels, epochs: int = EPOCHS, batch: int = BATCH, seed: int = 1):
        """Adam over shuffled batches; the same sample gives the same network."""
        r, y = np.random.default_rng(seed), np.asarray(labels, np.float32)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(x) for k, x in self.w.items()}
        t = 0
        parts = np.argsort([len(x) for x in texts], kind="stable")
        # texts of like length share a batch; the order of batches is shuffled
        ready = [(as_bytes([texts[i] for i in parts[a::max(1, len(texts) // batch)]]),
                  y[parts[a::max(1, len(texts) // batch)]]) for a in range(max(1, len(texts) // batch))]
        for epoch in range(epochs):
            rate = 0.01 * (1 - epoch / epochs) + 0.0005
            for i in r.permutation(len(ready)):
                _, g = self.slopes(*ready[i])
                t += 1
                for k in self.w:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                    self.w[k] -= (rate * (m[k] / (1 - 0.9 ** t))
                                  / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-6)).astype(np.float32)
        return self


class Constant:
    """The score where nothing can be learned."""

    def __init__(self, share: float):
        self.share = share

    def score(self, texts):
        return np.full(len(texts), self.share)


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the ids that no label is learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", sample: int = SAMPLE, chars: int = SAMPLE_CHARS):
    """The network fitted to a bounded sample of the labelled rows that aren't held out.

    Of several labels of one id, the least counts."""
    marks = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id))
             .groupBy(F.col(doc_id).alias("key")).agg(F.min(label).alias("y")))
    rows = labelled_sample(docs, marks, doc_id, text, sample, chars)
    y = [int(r.y) for r in rows]
    if len(set(y)) < 2:
        return Constant(sum(y) / len(y) if y else 0.5)
    return Network().fit([r.t for r in rows], y)


def with_quality(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``score`` (0 to 1, of label 1)."""
    def make():
        return lambda texts: [model.score(texts).tolist()]

    return add_from_text(docs, text, "score double", make)


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
              cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject, with their columns."""
    model = train(docs, labels, doc_id, text)
    return with_quality(docs, model, text).where(F.col("score") >= cut).select("row.*")


def query(spark, sf_dir):
    """Contract digest: the score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels)
    scored = with_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        F.col("row.doc_id").alias("doc_id"), held_out("row.doc_id").alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))
