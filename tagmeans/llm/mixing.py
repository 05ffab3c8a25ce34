"""Mixing to target weights by soft domain membership.

A softmax classifier over hashed word presence learns domains from a labelled
table and gives every document a posterior over them. Each document has a rate:
how often it is to stand in the mix. With ``n`` tokens and posterior ``p`` a
document adds ``rate * n * p`` to the domains' expected tokens, and the rates
minimise the squared distance of these totals to the targets, by projected
gradient steps from rate 1 under rate >= 0. One step needs one sum of a few
numbers over all documents. Steps are scaled by the Gram matrix of the documents that
are off their bound and projected from the sum of all steps so far, so a rate is a
function of its document's posterior and of that sum, and no rates are stored.
Of several rates that meet the targets these are the ones nearest to 1. The solver ends
when a step leaves the projected gradient (the optimality gap) below ``GAP``, and says so:
totals, targets and gap come with the rates, and a run that has not converged warns.

Words (runs of characters other than white space) stand for tokens, unless a
column with token numbers is given.

A document stands in the mix floor(rate + u) times, u in [0, 1) by a keyed hash of
its id and text: the expected number is the rate itself, below and above 1.

Defined results: null and empty texts have no token, the posterior of a text
without words and rate 1; repeated rows get equal rates and copies; without labels
there is one domain ("") and every rate moves alike; a text of any length is read whole; an empty
table gives no rows; every further column passes through.
"""

from __future__ import annotations

import warnings
import zlib
from dataclasses import dataclass
from itertools import chain, filterfalse, islice
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_from_text, keep, labelled_sample, table

#: Bounds of the classifier's sample: rows, and characters of a text.
SAMPLE, SAMPLE_CHARS = 6000, 20_000
#: ``SEEN_IN``: sampled texts that must hold a feature for it to be learned.
FEATURES, SEEN_IN, EPOCHS = 1 << 18, 3, 20
#: Steps at most, and the optimality gap to reach: the projected gradient's mean over all tokens, as a share
#: of a rate of 1. ``DAMP`` (a share of the mean token) keeps steps finite where targets can't be met.
STEPS, GAP, DAMP = 200, 1e-7, 1e-9
#: Where the distance to the targets stays above ``NEAR`` (no rates near 1 meet them), a domain's miss is weighed
#: against moving rates: a miss of ``FAR`` of its tokens is worth as much as moving its documents' rates by 1.
NEAR, FAR = 0.01, 0.01
#: Parts of a step that are tried at once.
PARTS = (1.0, 0.5, 0.2, 0.05, 0.01)
#: Words whose features a task remembers.
MEMO = 300_000
#: Target shares of the domains quality-toxic: nearly all of the mix is good and not toxic.
TARGETS = {"1-0": 0.97, "0-0": 0.02, "1-1": 0.008, "0-1": 0.002}
#: Without target shares: how often a domain's documents are to stand in the mix, 1 if not here.
TIMES = {"1-1": 0.0, "0-1": 0.0}
#: Key of the hash that rounds rates.
ROUNDING = "mix"
DOMAIN_LABELS = ("quality", "toxic")


_EDGES = b".,;:!?\"'()[]{}<>%*$#&|+-_=/\\~^@"


def _word_features(word: bytes) -> tuple[int, int]:
    """Numbers of a word without case and punctuation, and of the punctuation at its end."""
    return (zlib.crc32(word.lower().strip(_EDGES)) % FEATURES,
            zlib.crc32(b"\0end" + word[len(word.rstrip(_EDGES)):]) % FEATURES)


_TWICE, _CAPITALS = zlib.crc32(b"\0twice") % FEATURES, zlib.crc32(b"\0capitals") % FEATURES


def _features(text: str, memo: dict) -> tuple[np.ndarray, int]:
    """Distinct features of the text's words, of words twice in a row and of texts mostly
    in capitals; and the number of words. ``memo`` keeps what words give."""
    words = text.encode("utf-8", "replace").split()
    own = set(words)
    new = set(filterfalse(memo.__contains__, own))
    if len(memo) > MEMO:
        memo.clear()
        new = own
    memo.update((w, _word_features(w)) for w in new)
    seen = set(chain.from_iterable(map(memo.__getitem__, own)))
    if any(map(eq, words, islice(words, 1, None))):
        seen.add(_TWICE)
    if 2 * sum(map(bytes.isupper, own)) > len(own):
        seen.add(_CAPITALS)
    return np.fromiter(sorted(seen), np.int64, len(seen)), len(words)


class Softmax:
    """Domain classifier over sparse binary features."""

    def __init__(self, domains: list[str], weights: np.ndarray, bias: np.ndarray):
        self.domains, self.weights, self.bias = domains, weights, bias

    def posterior(self, ids: np.ndarray) -> np.ndarray:
        z = self.bias + self.weights[ids].sum(axis=0)
        e = np.exp(z - z.max())
        return e / e.sum()

    @classmethod
    def fit(cls, texts: list[str], marks: list[str], epochs: int = EPOCHS, seed: int = 5,
            shares: dict[str, float] | None = None) -> Softmax:
        """``shares``: the domains' true shares, where the sample has others."""
        domains = sorted(set(marks)) or [""]
        k = len(domains)
        y = np.array([domains.index(m) for m in marks], np.int64)
        share = np.bincount(y, minlength=k) + 0.5
        w, b = np.zeros((FEATURES, k)), np.log(share / share.sum())
        if k == 1:
            return cls(domains, w, b)
        memo: dict = {}
        rows = [_features(t, memo)[0] for t in texts]
        often = np.bincount(np.concatenate(rows), minlength=FEATURES) >= SEEN_IN
        rows = [x[often[x]] for x in rows]
        r, seen = np.random.default_rng(seed), np.full((FEATURES, k), 1e-2)
        for _ in range(epochs):
            for part in np.array_split(r.permutation(len(rows)), max(1, len(rows) // 64)):
                own = [rows[i] for i in part]
                at = np.concatenate(own)
                doc = np.repeat(np.arange(len(part)), [len(x) for x in own])
                z = np.zeros((len(part), k)) + b
                np.add.at(z, doc, w[at])
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(part)), y[part]] -= 1
                p /= len(part)
                ids, back = np.unique(at, return_inverse=True)
                g = np.zeros((len(ids), k))
                np.add.at(g, back, p[doc])
                g += 1e-5 * w[ids]
                seen[ids] += g ** 2
                w[ids] -= 0.1 * g / np.sqrt(seen[ids])
                b -= 0.05 * p.sum(axis=0)
        if shares:
            sampled = np.bincount(y, minlength=k) / len(y)
            true = np.array([shares[d] for d in domains]) / sum(shares[d] for d in domains)
            b = b + np.log(true / sampled)
        return cls(domains, w, b)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label_columns=DOMAIN_LABELS, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Softmax:
    """The classifier fitted to a bounded sample of labelled documents, picked by hash, as many
    of each domain; its posteriors are those of the domains' shares among all labels.

    A domain is the label values joined by "-"; rows with a null label or id teach
    nothing; of several rows of an id the least domain counts."""
    marks = (labels.where(F.col(doc_id).isNotNull())
             .select(F.col(doc_id).alias("key"), F.concat_ws("-", *[
                 F.col(c).cast("string") for c in label_columns]).alias("y"),
                 sum((F.col(c).isNull().cast("int") for c in label_columns), F.lit(0)).alias("bad"))
             .where("bad = 0").groupBy("key").agg(F.min("y").alias("y")))
    shares = {r.y: r.n for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}  # one row for each domain
    rows = labelled_sample(docs, marks, doc_id, text, sample, chars, by_mark=True)
    return Softmax.fit([r.t for r in rows], [r.y for r in rows], shares=shares)


def with_posterior(docs: DataFrame, model: Softmax, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``n`` (words) and ``posterior`` array<double>."""
    def make():
        memo: dict = {}

        def f(texts):
            both = [_features(t, memo) for t in texts]
            return [[n for _, n in both], [model.posterior(ids).tolist() for ids, _ in both]]

        return f

    return add_from_text(docs, text, "n long, posterior array<double>", make)


def rate_column(step, posterior: str = "posterior"):
    """The rate after all steps (their sum), as an expression on the posterior."""
    along = F.aggregate(F.zip_with(F.col(posterior), F.array(*[F.lit(float(x)) for x in step]), lambda a, b: a * b),
                        F.lit(0.0), lambda s, x: s + x)
    return F.greatest(F.lit(0.0), F.lit(1.0) - along)


@dataclass
class Rates:
    """Rates as the sum of all steps, with what they reach.

    ``totals`` and ``targets`` are expected tokens by domain; ``gap`` is zero at the least distance, whether
    that meets the targets or not; ``steps`` counts passes over the documents."""

    step: list[float]
    totals: list[float]
    targets: list[float]
    gap: float
    steps: int

    @property
    def converged(self) -> bool:
        return self.gap < GAP

    @property
    def distance(self) -> float:
        """The totals' distance to the targets, as a share of these."""
        t = np.array(self.targets)
        return float(np.abs(np.array(self.totals) - t).sum() / max(np.abs(t).sum(), 1.0))


def fit_rates(members: DataFrame, targets: list[float], steps: int = STEPS, damp=None) -> Rates:
    """The rates whose expected tokens of each domain come nearest to the targets.

    ``damp`` (a number for each domain; default nearly none) weighs the squares of misses, divided by it,
    against the squares of moving rates from 1, by token.

    ``members`` has ``n`` and ``posterior``. The gradient of a document's rate is its
    ``n * posterior`` times the totals' distances. A step is that gradient over ``n``, through
    the inverse Gram matrix of the documents with rates above 0; several parts of it are tried in one
    pass, and the one with the least objective is taken."""
    k, target = len(targets), np.array(targets, float)
    p = [F.element_at("posterior", i + 1) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def tried(sums):
        """For each sum of steps: totals, Gram matrix off the bound, squared rates."""
        cols = []
        for s in sums:
            rate = rate_column(s)
            part = [F.col("n") * x for x in p]
            cols += [F.sum(x * rate) for x in part]
            cols += [F.sum(F.when(rate > 0, part[i] * p[j]).otherwise(0.0)) for i, j in pairs]
            cols += [F.sum(F.col("n") * rate * rate)]
        row = [x or 0.0 for x in members.agg(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()]
        size = len(row) // len(sums)
        for a in range(0, len(row), size):
            gram = np.zeros((k, k))
            for (i, j), x in zip(pairs, row[a + k:a + size - 1]):
                gram[i, j] = gram[j, i] = x
            yield np.array(row[a:a + k]), gram, row[a + size - 1]

    tokens = float(members.agg(F.sum("n")).first()[0] or 0) or 1.0
    damp = np.full(k, DAMP * tokens) if damp is None else np.asarray(damp, float)
    sum_ = np.zeros(k)
    totals, gram, square = next(tried([sum_]))
    for passes in range(1, steps + 1):
        # the dual of the nearest rates: its gradient is the distance to the targets
        slope = totals - target - damp * sum_
        change = np.linalg.solve(gram + np.diag(damp + 1e-12 * tokens), slope)
        # what a whole step would still move a rate by, over all tokens
        gap = float(np.sqrt(max(0.0, change @ gram @ change) / tokens)) if np.abs(change).max() > 0 else 0.0
        if gap < GAP:
            break
        objective = square / 2 + target @ sum_ + damp @ sum_ ** 2 / 2
        trials = [sum_ + part * change for part in PARTS]
        results = list(tried(trials))
        values = [sq / 2 + target @ s + damp @ s ** 2 / 2 for s, (_, _, sq) in zip(trials, results)]
        best = int(np.argmin(values))
        if values[best] > objective - 1e-15 * abs(objective):
            break  # no part of the step is better: rounding is all that is left
        sum_, (totals, gram, square) = trials[best], results[best]
    return Rates(sum_.tolist(), totals.tolist(), target.tolist(), gap, passes)


def plan(members: DataFrame, domains: list[str], targets: dict[str, float] | None = None):
    """(``rate`` column, ``Rates``) for documents with ``n`` and ``posterior``.

    ``targets`` gives the share of each domain in the mix; domains without one get
    none. The mix has so many tokens that the domain with the largest share keeps
    those it has, so its documents keep rates near 1; a domain that is asked for more
    than it has gets rates above 1. Without ``targets`` each document adds to its domains'
    targets its tokens as often as ``TIMES`` says, by its posterior: clean documents stand once, toxic ones not."""
    slim = keep(members.groupBy("posterior").agg(F.sum("n").alias("n")).where("n > 0"))
    p = [F.element_at("posterior", i + 1) for i in range(len(domains))]
    times = sum((x * F.lit(TIMES.get(d, 1.0)) for x, d in zip(p, domains)), F.lit(0.0))
    sums = slim.agg(*[F.sum(F.col("n") * x) for x in p], *[F.sum(F.col("n") * times * x) for x in p]).first()
    own, kept = np.array([x or 0.0 for x in sums]).reshape(2, -1)
    if targets is None:
        wanted = kept
    else:
        shares = np.array([targets.get(d, 0.0) for d in domains])
        shares = shares / shares.sum() if shares.sum() else np.full(len(shares), 1 / len(shares))
        lead = int(shares.argmax())
        wanted = shares * own[lead] / shares[lead]
    fit = fit_rates(slim, wanted.tolist())
    if fit.distance > NEAR:
        fit = fit_rates(slim, wanted.tolist(), damp=FAR * np.maximum(own, 1.0))
        warnings.warn(f"no rates near 1 meet the targets: distance {fit.distance:.2g}", stacklevel=2)
    if not fit.converged:
        warnings.warn(f"rates have not converged after {fit.steps} passes: gap {fit.gap:.2g}", stacklevel=2)
    return F.when(F.col("n") > 0, rate_column(fit.step)).otherwise(1.0), fit


def drawn(doc_id, text):
    """A number in [0, 1) by a keyed hash of a document, in steps that sums with rates keep."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(ROUNDING), doc_id, text), 32) / float(1 << 32)


def with_copies(members: DataFrame, rate, u) -> DataFrame:
    """``members`` with ``rate`` and ``copies``: the rate rounded up with the probability of
    its fraction, by ``u``."""
    return members.withColumn("rate", rate).withColumn("copies", F.floor(F.col("rate") + u).cast("int"))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
        doc_id: str = "doc_id", text: str = "text", label_columns=DOMAIN_LABELS):
    """(frame, domains): ``row`` (all columns of ``docs``), ``n``, ``posterior`` (by
    domain), ``rate`` and ``copies``. The texts are read twice: once for the rates and
    once for the result."""
    model = train(docs, labels, doc_id, text, label_columns)
    members = with_posterior(docs, model, text)
    rate, _ = plan(members.select("n", "posterior"), model.domains, targets)
    return with_copies(members, rate, drawn(F.col("row")[doc_id], F.col("row")[text])), model.domains


def mixed(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The realised mix: each row of ``docs`` as often as its ``copies`` say, with its columns."""
    out, _ = mix(docs, labels, **how)
    return (out.where("copies > 0")
            .select("row", F.explode(F.when(F.col("copies") > 1, F.sequence(F.lit(1), "copies"))
                                     .otherwise(F.array(F.lit(1)))).alias("copy")).select("row.*"))


def query(spark, sf_dir):
    """Domain, rate and copies of every document, with the fit's distance to its targets and optimality gap."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    members = keep(with_posterior(docs, model).select(
        F.col("row.doc_id").alias("doc_id"), "n", "posterior", drawn(F.col("row.doc_id"), F.col("row.text")).alias("u")))
    rate, fit = plan(members, model.domains, TARGETS)
    likely = F.array_position("posterior", F.array_max("posterior")).cast("int")
    return with_copies(members, rate, F.col("u")).select(
        "doc_id", F.col("n").alias("n_tokens"),
        F.element_at(F.array(*map(F.lit, model.domains)), likely).alias("domain"),
        F.array_max("posterior").alias("membership"), "rate", "copies",
        F.lit(fit.distance).alias("distance"), F.lit(fit.gap).alias("gap"))
