"""Toxicity classifier: a convolutional network over words, trained and run in numpy.

A word's embedding is the sum of rows of a hashed table: one for the word, one for each
of its first ``PREFIXES`` bytes, so inflected forms share rows. Filters of one, two and
three words slide over the whole text; the largest answer of each goes to one logistic
layer. Rows that no text learned from has stay zero, so unknown words answer like padding.

The network is trained on the whole texts of all labelled rows, in the cluster's tasks: rows are
dealt to shards of some ``SHARD`` by a hash of their id; in each of ``ROUNDS`` rounds every
shard goes on from the network of the round before, block by block, and the weights are averaged
(a table row over the shards that changed it). The driver holds the network, never rows. Where
one block holds all rows, ``STARTS`` networks are trained and the best one is kept.
Every fourth row (by hash) is kept apart to calibrate: for each language, the cut with
the best F1 over all of them, counted by steps of ``1 / STEP`` of the logit, is moved to ``CUT``. A text's
language is told from its own words (``FUNCTION_WORDS``), never from a column; languages with
less than ``FEWEST`` toxic rows there share one cut.

Defined results: null and empty texts are scored as padding; texts of any length are scored
whole, ``WORDS_AT_ONCE`` words at a time; repeated rows get equal scores; without usable
labels every score is 0, with labels of one class only every score is that class; a label
or fold that is null teaches nothing; of several labels of an id the largest counts, of
several texts the least; an empty table gives no rows; every further column passes through.
"""

from __future__ import annotations

import copy
import itertools
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import add_from_text, keep, table
from .words import byte_kinds, prefix_hashes, words_of

ROWS, DIMS, WIDTHS, FILTERS = 1 << 18, 8, (1, 2, 3), 12
PREFIXES = (4, 5, 6, 7, 8)
EPOCHS, BATCH = 8, 64
#: Training steps at least; few rows are gone over more often.
STEPS = 400
#: Rows of a shard, about; rounds after which the shards' weights are averaged; characters parsed at once.
SHARD, ROUNDS, BLOCK = 8192, 4, 8 << 20
#: Networks that few rows (one block) are learned by; the one with the least loss on the rows kept apart is used.
STARTS = 3
#: Texts that must hold a word or prefix for it to have a row.
SEEN_IN = 2
#: Toxic rows that a language needs for a cut of its own.
FEWEST = 8
WORDS_AT_ONCE = 1 << 16
#: A document is predicted to be toxic from this score on.
CUT = 0.3
#: Steps of a logit, between -30 and 30, that calibration tells apart.
STEP = 256
KINDS = byte_kinds(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))

# Frequent words that tell the languages of the corpus apart.
FUNCTION_WORDS = {
    "en": "the of and to is that with was for are",
    "de": "der die und das nicht mit ist ein den von",
    "fr": "le les et des du est dans une pour qui",
    "es": "el los y del por con una las para se",
}
LANGUAGES = [*FUNCTION_WORDS, ""]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Texts:
    """Word codes of some texts with padding after each, so that no filter covers two texts."""

    def __init__(self, texts: list[str]):
        w = words_of(pa.array(texts, pa.string()), KINDS)
        pad = max(WIDTHS)
        self.known, n = w.known, len(texts)
        count = np.bincount(w.doc, minlength=n)
        self.first = np.r_[0, np.cumsum(count + pad)]
        self.codes = np.full(self.first[-1], len(w.known), np.int64)
        self.codes[np.arange(len(w.codes)) + pad * w.doc.astype(np.int64)] = w.codes
        hashes = prefix_hashes(w.known, PREFIXES)
        rows = np.where(hashes > 0, hashes % np.uint64(ROWS - 1) + np.uint64(1), np.uint64(0)).astype(np.int64)
        self.rows = np.vstack([rows, np.zeros((1, rows.shape[1]), np.int64)])  # the last: padding; row 0 is zero
        own = {word.encode(): i for i, ws in enumerate(FUNCTION_WORDS.values()) for word in ws.split()}
        told = np.full(len(w.known) + 1, -1)
        for word, i in own.items():
            told[:-1][np.asarray(pc.equal(w.known, word))] = i
        of = told[w.codes]
        votes = np.bincount(w.doc[of >= 0].astype(np.int64) * len(own) + of[of >= 0], minlength=n * len(own)).reshape(n, len(own))
        self.language = np.where(votes.max(axis=1, initial=0) > 0, votes.argmax(axis=1), len(FUNCTION_WORDS))


class Network:
    """The weights, answers and training steps of the network."""

    def __init__(self, seed: int = 1):
        r = np.random.default_rng(seed)
        f = np.float32
        self.table = np.zeros((ROWS, DIMS), f)
        self.w = {"out": r.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(f), "out_bias": np.full(1, -1, f)}
        for k in WIDTHS:
            self.w[f"filter{k}"] = r.normal(0, 1 / np.sqrt(k * DIMS), (k, DIMS, FILTERS)).astype(f)
            self.w[f"bias{k}"] = np.full(FILTERS, 0.05, f)
        self.shift = np.zeros(len(LANGUAGES))
        # of the training
        self.learnt = np.zeros(ROWS, bool)
        self.size = np.zeros((ROWS, 1), f)
        self.m = {k: np.zeros_like(x) for k, x in self.w.items()}
        self.v = {k: np.zeros_like(x) for k, x in self.w.items()}
        self.step = 0

    def _pooled(self, codes, first, embedded, where=False):
        """The largest answer of each filter in each text, and where it stands."""
        out, at = [], []
        n = len(first) - 1
        for k in WIDTHS:
            taps = [embedded @ self.w[f"filter{k}"][j] for j in range(k)]
            top, place = np.full((n, FILTERS), -np.inf, np.float32), np.zeros((n, FILTERS), np.int64)
            for a in range(0, len(codes), WORDS_AT_ONCE):
                b = min(a + WORDS_AT_ONCE, len(codes))
                x = taps[0][codes[a:b]]
                for j in range(1, k):
                    m = min(b + j, len(codes)) - a - j
                    if m > 0:
                        x[:m] += taps[j][codes[a + j:a + j + m]]
                for j in range(1, k):  # windows that would reach into the next text
                    late = first[1:] - j
                    x[late[(late >= a) & (late < b)] - a] = -np.inf
                i, z = np.searchsorted(first, a, "right") - 1, np.searchsorted(first, b, "left")
                begin = np.maximum(first[i:z], a) - a
                best = np.maximum.reduceat(x, begin, axis=0)
                if where:
                    here = np.stack([a + p + x[p:q].argmax(axis=0) for p, q in zip(begin, np.r_[begin[1:], b - a])])
                    place[i:z] = np.where(best > top[i:z], here, place[i:z])
                np.maximum(top[i:z], best, out=top[i:z])
            at.append(place)
            out.append(top + self.w[f"bias{k}"])
        return np.concatenate(out, axis=1), at

    def logits(self, t: Texts) -> np.ndarray:
        pooled, _ = self._pooled(t.codes, t.first, self.table[t.rows].sum(axis=1))
        return (np.maximum(pooled, 0) @ self.w["out"] + self.w["out_bias"][0]).astype(np.float64)

    def score(self, texts: list[str]) -> np.ndarray:
        """Calibrated probability of label 1 of each text."""
        t = Texts(texts)
        # rounded, since products of other shapes may differ in their last bits
        return np.round(_sigmoid(self.logits(t) + self.shift[t.language]), 6)

    def _slopes(self, codes, first, rows, y):
        """Gradients of a batch: of the weights, and of the table (rows, slopes)."""
        embedded = self.table[rows].sum(axis=1)
        pooled, at = self._pooled(codes, first, embedded, where=True)
        h = np.maximum(pooled, 0)
        p = _sigmoid(h @ self.w["out"] + self.w["out_bias"][0])
        dz = ((p - y) / len(y)).astype(np.float32)
        g = {"out": h.T @ dz, "out_bias": dz.sum(keepdims=True)}
        dpool = np.outer(dz, self.w["out"]) * (pooled > 0)
        back = np.zeros_like(embedded)
        for i, k in enumerate(WIDTHS):
            d = dpool[:, i * FILTERS:(i + 1) * FILTERS]
            g[f"bias{k}"] = d.sum(axis=0)
            g[f"filter{k}"] = np.zeros_like(self.w[f"filter{k}"])
            for j in range(k):
                seen = codes[at[i] + j]
                g[f"filter{k}"][j] = np.einsum("nfe,nf->ef", embedded[seen], d)
                np.add.at(back, seen.ravel(), (d[:, :, None] * self.w[f"filter{k}"][j].T[None]).reshape(-1, DIMS))
        return g, back

    def fit(self, t: Texts, y: np.ndarray, passes: range, epochs: int, seed: int = 1):
        """Those ``passes`` of ``epochs`` over some rows: Adam for the weights, Adagrad for the table's
        rows; the same rows give the same network."""
        y = y.astype(np.float32)
        rows = np.where(self.learnt[t.rows], t.rows, 0)
        words = np.diff(t.first)
        for epoch in passes:
            order = np.random.default_rng((seed, epoch)).permutation(len(y))
            rate = 0.01 * (1 - epoch / epochs) + 0.001
            for a in range(0, len(order), BATCH):
                # a batch of many words takes several steps
                for docs in _parts(order[a:a + BATCH], words):
                    n = words[docs]
                    first = np.r_[0, np.cumsum(n)]
                    flat = t.codes[np.repeat(t.first[docs] - first[:-1], n) + np.arange(first[-1])]
                    self._learn(flat, first, rows, y[docs], rate, 0.3 * (1 - 0.9 * epoch / epochs))
        return self

    def _learn(self, flat, first, rows, y, rate: float, table_rate: float) -> None:
        used, codes = np.unique(flat, return_inverse=True)
        g, back = self._slopes(codes, first, rows[used], y)
        hit = np.flatnonzero(back.any(axis=1))
        at, which = np.unique(rows[used[hit]].ravel(), return_inverse=True)
        slope = np.zeros((len(at), DIMS), np.float32)
        np.add.at(slope, which, np.repeat(back[hit], rows.shape[1], axis=0))
        slope[at == 0] = 0
        self.size[at] += (slope ** 2).sum(axis=1, keepdims=True)
        self.table[at] -= table_rate * slope / (np.sqrt(self.size[at]) + 1e-6)
        self.step += 1
        m, v, step = self.m, self.v, self.step
        for k in self.w:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            self.w[k] = self.w[k] - (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)

    def changes(self, old: "Network") -> pa.RecordBatch:
        """Table rows that differ from ``old``'s, then each weight, moment and the steps as a row beyond."""
        at = np.flatnonzero((self.size != old.size)[:, 0])
        dense = np.concatenate([x.ravel() for d in (self.w, self.m, self.v) for x in d.values()] + [[self.step]])
        values = np.zeros((len(at) + len(dense), DIMS + 1), np.float32)
        values[:len(at), :DIMS], values[:len(at), DIMS] = self.table[at], self.size[at, 0]
        values[len(at):, 0] = dense
        row = np.r_[at, ROWS + np.arange(len(dense))].astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(row), *map(pa.array, np.ascontiguousarray(values.T))],
                                          names=["row", *VALUES])

    def take(self, rows: np.ndarray, values: np.ndarray) -> None:
        """What ``changes`` of all shards average to."""
        of_table = rows < ROWS
        self.table[rows[of_table]] = values[of_table, :DIMS]
        self.size[rows[of_table], 0] = values[of_table, DIMS]
        dense = values[~of_table, 0][np.argsort(rows[~of_table])]
        for d in (self.w, self.m, self.v):
            for k, x in d.items():
                d[k], dense = dense[:x.size].reshape(x.shape).astype(np.float32), dense[x.size:]
        self.step = round(float(dense[0]))

    def calibrate(self, language: np.ndarray, z: np.ndarray, y: np.ndarray, n: np.ndarray):
        """Moves each language's best cut to ``CUT``; ``n`` rows stand behind each logit."""
        cut, common = np.log(CUT / (1 - CUT)), best_cut(z, y, 1.0, n)
        for i in range(len(LANGUAGES)):
            mine = language == i
            enough = (y * n)[mine].sum() >= FEWEST and ((1 - y) * n)[mine].sum() >= FEWEST
            self.shift[i] = cut - (best_cut(z[mine], y[mine], 1.0, n[mine]) if enough else common)
        return self

    def trained(self) -> "Network":
        """Without what only the training needs."""
        self.learnt = self.size = self.m = self.v = None
        return self


VALUES = [f"v{i}" for i in range(DIMS + 1)]


def _parts(docs: np.ndarray, words: np.ndarray):
    """Runs of ``docs`` with at most ``WORDS_AT_ONCE`` words or one text each."""
    begin, held = 0, 0
    for i, n in enumerate(words[docs].tolist()):
        if i > begin and held + n > WORDS_AT_ONCE:
            yield docs[begin:i]
            begin, held = i, 0
        held += n
    yield docs[begin:]


def best_cut(z: np.ndarray, y: np.ndarray, weight: float, n: np.ndarray | None = None) -> float:
    """The middle of the gap between logits that parts them with the best F1; ``n``: rows with
    each logit (1), a clean one counting ``weight``."""
    if not y.any() or y.all():
        return float(np.log(CUT / (1 - CUT)))
    order = np.argsort(-z, kind="stable")
    n = np.ones(len(z), np.int64) if n is None else n[order]
    z, y = z[order], y[order]
    hit, wrong = np.cumsum(y * n), np.cumsum((1 - y) * n * weight)
    f1 = 2 * hit / (hit + wrong + (y * n).sum())
    f1[:-1][z[:-1] == z[1:]] = -1  # a cut can't part equal logits
    i = int(f1.argmax())
    return float((z[i] + z[i + 1]) / 2 if i + 1 < len(z) else z[i] - 1)


class Constant:
    """The score where nothing can be learned."""

    def __init__(self, share: float):
        self.share = share

    def score(self, texts):
        return np.full(len(texts), self.share)


def held_out(doc_id: str = "doc_id"):
    """True for the fourth of the ids that no label is learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, shard: int) -> DataFrame:
    """(shard, y, t, apart) of every labelled row that isn't held out, whole texts, in an order
    that only the ids make; from a copy in the checkpoint folder. Each text is shuffled once."""
    known = F.col(doc_id).isNotNull() & ~held_out(doc_id)
    marks = (labels.where(F.col(label).isNotNull() & known)
             .groupBy(F.col(doc_id).alias("key")).agg(F.max(F.col(label).cast("int")).alias("y")).where("y in (0, 1)"))
    shards = max(1, -(-marks.count() // shard))
    texts = docs.where(known).select(F.col(doc_id).alias("key"), F.lit(None).cast("int").alias("y"),
                                     F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = (marks.withColumn("t", F.lit(None).cast("string")).unionByName(texts)
            .withColumn("h", F.xxhash64("key")).withColumn("shard", F.pmod("h", F.lit(shards)).cast("int")))
    # an id's label comes first, then its least text
    w = Window.partitionBy("shard", "h", "key").orderBy("t")
    return keep(rows.repartition("shard").withColumn("mark", F.first("y").over(w)).withColumn("nth", F.row_number().over(w))
                .where("mark is not null and nth = 2")
                .select("shard", F.col("mark").alias("y"), "t", (F.pmod(F.xxhash64("key", F.lit(1)), F.lit(4)) == 3).alias("apart")))


def _blocks(batches):
    """(shard, labels, texts) of rows in order, cut where the shard changes and after some ``BLOCK``
    characters, the same however they are batched."""
    shard, y, texts, held = None, [], [], 0
    for batch in batches:
        for s, mark, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if texts and (s != shard or held + len(t) > BLOCK):
                yield shard, np.array(y, np.int64), texts
                y, texts, held = [], [], 0
            shard, held = s, held + len(t)
            y.append(mark)
            texts.append(t)
    if texts:
        yield shard, np.array(y, np.int64), texts


def learnable(rows: DataFrame) -> np.ndarray:
    """Which table rows stand in at least ``SEEN_IN`` of the texts."""
    def run(batches):
        seen = np.zeros(ROWS, np.int64)
        for _, y, texts in _blocks(batches):
            t = Texts(texts)
            pairs = np.unique(np.repeat(np.arange(len(y)), np.diff(t.first)) * (len(t.known) + 1) + t.codes)
            doc, code = np.divmod(pairs, len(t.known) + 1)
            for column in t.rows.T:
                seen += np.bincount(np.unique(doc * ROWS + column[code]) % ROWS, minlength=ROWS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["row", "n"])

    out = np.zeros(ROWS, bool)
    out[(rows.mapInArrow(run, "row long, n long").groupBy("row").agg(F.sum("n").alias("n"))
         .where(F.col("n") >= SEEN_IN).select("row").toArrow())["row"].to_numpy()] = True
    out[0] = False
    return out


def train_round(rows: DataFrame, model: Network, passes: range, epochs: int) -> None:
    """Every shard goes over its rows from ``model``, which takes the average."""
    sent = rows.sparkSession.sparkContext.broadcast(model)  # of fixed size: some 10 MB

    def run(batches):
        for shard, blocks in itertools.groupby(_blocks(batches), lambda x: x[0]):
            mine = copy.deepcopy(sent.value)
            for i, (_, y, texts) in enumerate(blocks):
                mine.fit(Texts(texts), y, passes, epochs, seed=1 + shard + (i << 32))
            yield mine.changes(sent.value)

    got = (rows.mapInArrow(run, "row int, " + ", ".join(f"{v} float" for v in VALUES))
           .groupBy("row").agg(*[F.avg(v).alias(v) for v in VALUES]).toArrow())  # of the network's size
    sent.unpersist()
    model.take(got["row"].to_numpy(), np.stack([got[v].to_numpy() for v in VALUES], axis=1))


def logit_counts(rows: DataFrame, model: Network) -> pa.Table:
    """(language, z, y, n): how many rows have each rounded logit."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for _, y, texts in _blocks(batches):
            t = Texts(texts)
            z = np.round(np.clip(sent.value.logits(t), -30, 30) * STEP).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(t.language), pa.array(z), pa.array(y)], names=["language", "z", "y"])

    return rows.mapInArrow(run, "language long, z long, y long").groupBy("language", "z", "y").agg(F.count("*").alias("n")).toArrow()


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          epochs: int = EPOCHS, shard: int = SHARD):
    """The network fitted to all labelled rows that aren't held out."""
    rows = labelled(docs, labels, doc_id, text, label, shard)
    found = rows.groupBy("apart", "y").agg(F.count("*").alias("n"), F.sum(F.length("t")).alias("chars")).collect()
    if len({r.y for r in found}) < 2:
        return Constant(float(any(r.y for r in found)))
    split = len(found) == 4 and sum(r.n for r in found) >= 16
    fit, other = (rows.where("not apart"), rows.where("apart")) if split else (rows, rows)
    fitted = [r for r in found if not (split and r.apart)]
    n = min(shard, sum(r.n for r in fitted))
    epochs = max(epochs, -(-STEPS // -(-n // BATCH)))
    # rows that are parsed at once by one task need no rounds
    rounds = 1 if n < shard and sum(r.chars for r in fitted) <= BLOCK else ROUNDS
    learnt = learnable(fit)

    def start(seed: int):
        model = Network(seed)
        model.learnt = learnt
        for a in range(rounds):
            train_round(fit, model, range(a * epochs // rounds, (a + 1) * epochs // rounds), epochs)
        counts = logit_counts(other, model)
        language, z, y, n = (counts[c].to_numpy() for c in ("language", "z", "y", "n"))
        loss = float((n * np.logaddexp(0, np.where(y > 0, -z, z) / STEP)).sum())
        return loss, seed, model.calibrate(language, z / STEP, y, n).trained()

    if rounds > 1 or not split:
        return start(1)[2]
    with ThreadPoolExecutor(STARTS) as pool:  # jobs of one task each
        return min(pool.map(start, range(1, STARTS + 1)), key=lambda x: x[:2])[2]


def with_toxicity(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``score`` (0 to 1, of label 1)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size: some 8 MB

    def make():
        return lambda texts: [sent.value.score(texts).tolist()]

    return add_from_text(docs, text, "score double", make)


def query(spark, sf_dir):
    """Contract digest: the score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = with_toxicity(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        F.col("row.doc_id").alias("doc_id"), held_out("row.doc_id").alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"))
