"""The operators against plain brute force on small tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tagmeans.llm import (decontamination, licenses, mixing, neighbours, phrases, pii, quality, registry, simhash, spans,
                          token_output)
from tagmeans.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SF)
    res = con.execute(registry.ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert Counter(tuple(r[c] for c in cols) for r in df.collect()) == Counter(res.fetchall())


def test_decontamination_in_passes(spark):
    r = random.Random(1)
    words = "abcdefg"
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(i, text(r.choice([1, 2, 3, 5, 9]))) for i in range(12)]
    docs = [(i, text(r.randint(0, 40))) for i in range(60)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    for most in (10_000, 8):
        got = {x.i: ({p for s in x.spans for p in range(s.begin, s.end)}, set(x["items"]), len(x.spans))
               for x in decontamination.find_benchmark(d, b, window=3, pass_words=most).select(
                   F.col("row.doc_id").alias("i"), "spans", "items").collect()}
        for i, t in docs:
            ws, hit, found = t.split(), set(), set()
            for item, u in items:
                p = u.split()
                m = min(3, len(p))
                wins = {tuple(p[j:j + m]) for j in range(len(p) - m + 1)}
                for j in range(len(ws) - m + 1):
                    if tuple(ws[j:j + m]) in wins:
                        hit |= set(range(j, j + m))
                        found.add(str(item))
            runs = sum(x - 1 not in hit for x in hit)
            assert got[i] == (hit, found, runs)


def _components(prints, bits=2):
    ids = sorted(prints)
    f = np.array([prints[i] for i in ids], np.uint64)
    near, label = np.bitwise_count(f[:, None] ^ f) <= bits, np.array(ids)
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return dict(zip(ids, label.tolist()))
        label = new


def test_simhash_whole_query(spark, documents):
    import xxhash

    def plain(text):
        ws = text.lower().encode().split() if text.isascii() else [
            w for w in "".join(c.lower() if c.isascii() else c for c in text).encode().split()]
        grams = [b" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or ([b" ".join(ws)] if ws else [])
        hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    prints = {i: plain(t) for i, t in documents}
    want = _components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in registry.QUERIES["op2_simhash"](spark, SF).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


@pytest.mark.parametrize("leaf", [2, 40, 2048])
def test_simhash_hot_groups(spark, leaf):
    """A ball of near copies, long chains and strangers, at every depth of dealing."""
    r = np.random.default_rng(leaf)
    base = r.integers(0, 2**64, 4, dtype=np.uint64)
    flips = lambda n: np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, (n, 3), dtype=np.uint64), axis=1)
    chain = np.cumsum(np.full(40, 3, np.uint64)) ^ base[3]
    p = np.unique(np.concatenate([base[0] ^ flips(150), base[1] ^ flips(20), chain, r.integers(0, 2**64, 100, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(x),) for x in p.view(np.int64)], "print long")
    named = {row.print: row.component_id for row in simhash._named(
        df.withColumn("id", F.col("print")), 2, leaf).collect()}
    want = _components({int(x): int(x) & (2**64 - 1) for x in p.view(np.int64)})
    assert named == want


def test_simhash_index_of_a_dense_group_in_bounded_memory():
    """A group whose members are all near each other: every pair once, a few MB at a time."""
    import tracemalloc
    from itertools import combinations

    near = [0, *(1 << i for i in range(64)), *(1 << i | 1 << j for i, j in combinations(range(64), 2))][:simhash.LEAF]
    p = np.array(near, np.uint64) ^ np.uint64(0x0123456789ABCDEF)
    p = np.concatenate([p, p])
    groups = np.repeat([0, 1], len(near))
    index, seen = simhash.GrayIndex(groups, p), 0
    tracemalloc.start()
    for x, y in index.pairs(4):
        assert (groups[x] == groups[y]).all()
        seen += len(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == len(near) * (len(near) - 1)  # two groups of all pairs
    assert peak < 60e6


def test_simhash_texts_stay_in_their_task(spark, documents):
    """Only the columns asked for come back from the Python workers."""
    df = spark.createDataFrame(documents, "doc_id long, text string")
    slim = simhash.with_fingerprint(df, columns=["doc_id"])
    assert slim.select("row.*").columns == ["doc_id"]
    whole = simhash.with_fingerprint(df).select("row.doc_id", "print")
    assert sorted(slim.select("row.doc_id", "print").collect()) == sorted(whole.collect())


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 4999)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}, 4999: 4999, 5000: 4999}


def test_spans_whole_query(spark, documents):
    seen, again = set(), set()
    data = {i: (t or "").encode() for i, t in documents}
    for b in data.values():
        for p in range(len(b) - 399):
            w = b[p:p + 400]
            again.add(w) if w in seen else seen.add(w)
    want = {}
    for i, b in data.items():
        mask = bytearray(len(b))
        for p in range(len(b) - 399):
            if b[p:p + 400] in again:
                mask[p:p + 400] = b"\1" * 400
        kept = bytes(c for c, m in zip(b, mask) if not m)
        want[i] = (len(b), sum(mask), mask.count(b"\0\1") + (mask[:1] == b"\1"), hashlib.sha256(kept).hexdigest())
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in registry.QUERIES["op10_repeated_spans"](spark, SF).collect()}
    assert got == want and any(v[1] for v in want.values())


def test_spans_of_awkward_texts(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abc") for _ in range(r.randint(1, 4)))
    part = [" ".join(word() for _ in range(40)) for _ in range(6)]
    texts = ["".join(r.choice(part) for _ in range(r.randint(0, 5))) for _ in range(40)] + ["ab" * 300, "a" * 95, "é" * 100]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for length, reach in ((40, 16), (100, 32)):
        windows = Counter(t.encode()[p:p + length] for t in texts for p in range(len(t.encode()) - length + 1))
        got = {x.i: bytes(x.kept) for x in spans.removed(df, length=length, reach=reach).select(
            F.col("row.doc_id").alias("i"), "kept").collect()}
        for i, t in enumerate(texts):
            b, mask = t.encode(), bytearray(len(t.encode()))
            for p in range(len(b) - length + 1):
                if windows[b[p:p + length]] > 1:
                    mask[p:p + length] = b"\1" * length
            assert got[i] == bytes(c for c, m in zip(b, mask) if not m)


def test_phrases_cover_every_window_once():
    r = np.random.default_rng(0)
    data = bytes(r.integers(97, 101, 5000, dtype=np.uint8))
    at, n, anchor = phrases.phrases(data, 100, 32)
    assert at[0] == 0 and (at[1:] == (at + n)[:-1]).all() and at[-1] + n[-1] == len(data) - 99
    assert (anchor >= at + n - 1).all() and (anchor < at + 32).all()


def test_token_output_whole_query(spark, documents):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_output.default_path())
    want, start = [], 0
    for i, text in sorted(documents):
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in registry.QUERIES["op8_token_output"](spark, SF).orderBy("start").collect()] == want


def test_coder_round_trip_and_damage():
    r = np.random.default_rng(0)
    ids = np.minimum(r.geometric(0.01, 70_000), 3000).astype(np.uint32)
    coder = token_output.Coder(token_output.quantised(np.bincount(ids)))
    for n in (0, 1, 255, 256, 257, 40_000, 70_000):
        data = coder.encode(ids[:n], lanes=16, steps=64)
        assert (coder.decode(data) == ids[:n]).all()
    entropy = -sum(c / len(ids) * np.log2(c / len(ids)) for c in np.bincount(ids) if c)
    assert 8 * len(coder.encode(ids)) / len(ids) < entropy + 0.5
    bad = bytearray(data)
    bad[-100] ^= 1
    with pytest.raises(ValueError):
        coder.decode(bytes(bad))


def test_pieces_equal_the_library():
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = token_output.default_path()
    t, p, r = Tokenizer.from_file(path), token_output.Pieces(path), random.Random(5)
    alphabet = ["a", "B", "é", "1", ".", "'s", "!!", " ", "  ", "\n", "\t", " ", " ", "\x85", "\x1c", "<|endoftext|>", "😀"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 14))) for _ in range(3000)]
    for _ in range(2):
        assert [x.tolist() for x in p.encode(pa.array(texts))] == [
            e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_pieces_remember_many_words():
    """Words met three large slices ago don't go to the library again."""
    import pyarrow as pa

    p, seen = token_output.Pieces(token_output.default_path()), []
    ids = p._ids
    p._ids = lambda texts: seen.append(sum(map(len, texts))) or ids(texts)
    texts = [pa.array([" ".join(f"x{i:x}" for i in range(a, a + 210_000))]) for a in (0, 210_000, 420_000)]
    first = p.encode(texts[0])[0]
    for t in texts[1:]:
        p.encode(t)
    seen.clear()
    assert (p.encode(texts[0])[0] == first).all() and sum(seen) < 100


def test_pieces_go_to_the_library_in_short_texts():
    """New words go there a hundred at a time, and equal punctuation of many words once."""
    import pyarrow as pa

    p, seen = token_output.Pieces(token_output.default_path()), []
    ids, whole = p._ids, p._whole
    p._ids = lambda texts: seen.extend(texts) or ids(texts)
    p._whole = lambda pieces, memory: seen.extend(x for x in pieces if memory is p.tails) or whole(pieces, memory)
    text = " ".join(f"x{i:x}y" + ("?!", ",\n-", "")[i % 3] for i in range(5_000))
    assert p.encode(pa.array([text]))[0].tolist() == p.encoder.encode(text, add_special_tokens=False).ids
    assert max(len(t.split(" ")) for t in seen) <= 101 and seen.count("?!") <= 2


def test_pieces_that_are_forgotten(monkeypatch):
    """A memory of a few words and tails, for texts of words with punctuation, line ends and runs of spaces."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_output, "REMEMBERED", 64)
    path = token_output.default_path()
    t, p, r = Tokenizer.from_file(path), token_output.Pieces(path), random.Random(6)
    words = ["al", "Be", "\u00e9t\u00e9", "\u01b0.", "x2", "don't", "ok,***", "end.\nNew&&&", "a|b|", "<|endoftext|>", "a<|endoftext|>.", "", "\n", "\u00a0q"]
    for _ in range(6):
        texts = [" ".join(r.choice(words) + r.choice(["", "", str(r.randint(0, 99)), "!?", ","]) for _ in range(r.randint(0, 9)))
                 for _ in range(200)] + [None]
        assert [x.tolist() for x in p.encode(pa.array(texts))] == [
            t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_pseudonyms_are_permutations(spark):
    df = spark.range(1000).select(F.format_string("%03d", "id").alias("d"))
    got = {r.d: r.p for r in df.select("d", pii.permuted_digits(F.col("d"), "k", "t").alias("p")).collect()}
    assert sorted(got.values()) == sorted(got) and sum(a == b for a, b in got.items()) < 20

    def luhn(s):
        return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (c > "4") for i, c in enumerate(reversed(s))) % 10 == 0

    cards = [s for s in (f"4{i:015d}" for i in range(0, 4000, 7)) if luhn(s)]
    days = [f"{y}-02-29" for y in (1600, 1999, 2000, 2024)] + [f"2023-{m:02d}-15" for m in range(1, 14)]
    text = "\n".join([*cards, *days, "203.0.113.9", "+1 (212) 555-0100", "(212) 555-0100", "078-05-1120", "a.b@example.org"])
    out, = pii.pseudonymize(spark.createDataFrame([(1, text), ], "doc_id long, text string")).select("row.text", "kinds").collect()
    lines = out.text.split("\n")
    new = lines[:len(cards)]
    assert all(luhn(x) and len(x) == 16 for x in new) and len(set(new)) == len(cards)
    assert lines[len(cards) + 1] == "1999-02-29" and lines[len(cards) + 16] == "2023-13-15"
    assert lines[-4][-14:] == lines[-3] and lines[-5].count(".") == 3 and lines[-1].endswith("@example.org")
    assert Counter(out.kinds)["date"] == 15 and Counter(out.kinds)["phone"] == 2 and lines[-2] != "078-05-1120"


def test_quality_held_out(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels").select("doc_id", "quality").distinct()
    rows = quality.with_quality(docs.select("doc_id", "text"), quality.train(docs, labels)).select(
        F.col("row.doc_id").alias("doc_id"), "score", quality.held_out("row.doc_id").alias("h")).join(labels, "doc_id").collect()
    good = [r.score for r in rows if r.h and r.quality == 1]
    bad = [r.score for r in rows if r.h and r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.93
    assert np.mean([g >= quality.CUT for g in good]) > 0.95


def test_rates_meet_targets(spark):
    r = np.random.default_rng(2)
    p = r.dirichlet([0.3, 0.3, 0.3], 400)
    n = r.integers(1, 500, 400)
    df = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p)], "n long, posterior array<double>")
    own = (n[:, None] * p).sum(axis=0)
    for target in (own * [1.0, 0.5, 0.2], own * [1.2, 0.05, 0.9]):
        fit = mixing.fit_rates(df, target.tolist())
        rates = [x.rate for x in df.select(mixing.rate_column(fit.step).alias("rate")).collect()]
        totals = (np.array(rates)[:, None] * n[:, None] * p).sum(axis=0)
        assert fit.converged and min(rates) >= 0 and np.allclose(totals, target, rtol=1e-4) and np.allclose(totals, fit.totals)
    # no rates reach a target outside the cone of the posteriors: the least distance, by a plain solver
    target = own * [0.0, 1.0, 3.0]
    fit = mixing.fit_rates(df, target.tolist())
    a, r_ = (n[:, None] * p).T, np.ones(400)
    for _ in range(200_000):
        r_ = np.maximum(0, r_ - (a.T @ (a @ r_ - target)) / np.linalg.norm(a, 2) ** 2)
    least = np.linalg.norm(a @ r_ - target)
    assert np.linalg.norm(np.array(fit.totals) - target) <= least * 1.001 + 1e-3 * np.linalg.norm(target)


@pytest.mark.parametrize("lengths", [False, True])
def test_neighbours_recall(spark, lengths):
    r = np.random.default_rng(4)
    v = r.normal(size=(3000, 16)) / 4
    if lengths:
        v *= r.uniform(0.2, 3, (3000, 1))
    v[100:130] = v[100]
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for row in neighbours.search(df, queries=F.col("id") % 20 == 0, part=700).orderBy("query_id", "rank").collect():
        got[row.query_id].append((row.vec_id, row.score))
    hit = 0
    for q in range(0, 3000, 20):
        s = v @ v[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(3000), -s))[:20]
        hit += len(set(best) & {i for i, _ in got[q]})
        assert len(got[q]) == 20 and all(abs(s[i] - x) < 1e-9 for i, x in got[q])
    assert hit / 3000 >= 0.9


def test_licenses_threshold_and_phrases(spark):
    rows = [(1, "x\nReleased under the MIT License.\ny"), (2, "released MIT license under"), (3, "Released the MIT"),
            (4, "under the mit\nlicense"), (5, "All rights reserved"), (6, "cc-by-nc cc by nc"), (7, "UNDER THE MİT LICENSE")]
    got = {r.i: (r.labels, round(r.score, 3), [s.start for s in r.starts]) for r in licenses.scan(
        spark.createDataFrame(rows, "doc_id long, text string")).select(F.col("row.doc_id").alias("i"), "labels", "score", "starts").collect()}
    assert got[1] == (["mit"], 1.0, [2]) and got[2] == (["mit"], 0.8, []) and got[3] == ([], 0.0, [])
    assert got[4] == (["mit"], 1.0, [0]) and got[5] == (["all-rights-reserved"], 1.0, [])
    assert got[6] == (["cc-by-nc"], 1.0, [0, 3]) and got[7] == ([], 0.0, [])


def test_pipeline_is_its_stages(spark):
    """run() against the stages' decisions made one by one from the operators' own outputs."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.train(docs, labels)
    rows = [r for r in docs.collect() if model.score([r.text or ""])[0] >= quality.CUT]
    prints = {r.doc_id: simhash.fingerprint(r.text or "") for r in rows}
    heads = set(_components(prints).values())
    rows = [r for r in rows if r.doc_id in heads]
    bench = [(r.item_id, decontamination.words_of(r.text or "")) for r in table(spark, SF, "benchmark").collect()]
    wins = {tuple(ws[i:i + 13]) for _, ws in bench for i in range(max(1, len(ws) - 12)) if ws}

    def clean(text):
        ws = decontamination.words_of(text or "")
        hit = {p for w in {min(13, len(x)) for x in wins} for i in range(len(ws) - w + 1)
               if tuple(ws[i:i + w]) in wins for p in range(i, i + w)}
        return not (hit and 20 * len(hit) >= len(ws))

    rows = [r for r in rows if clean(r.text)]
    out, _ = mixing.mix(spark.createDataFrame(rows, docs.schema), labels)
    copies = {r.i: r.copies for r in out.select(F.col("row.doc_id").alias("i"), "copies").collect()}
    from tokenizers import Tokenizer

    t, want, start = Tokenizer.from_file(token_output.default_path()), [], 0
    for r in sorted(rows, key=lambda r: r.doc_id):
        for _ in range(copies[r.doc_id]):
            ids = np.array(t.encode(r.text, add_special_tokens=False).ids + [0], "<u4")
            want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    assert [tuple(r) for r in corpus_pipeline.run(spark, SF).orderBy("start").collect()] == want
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
