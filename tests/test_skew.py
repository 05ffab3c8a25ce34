"""Hot keys: one question with a third of all answers, one duplicated
question id, one language with most points. Results must stay whole and
exact, and the plans must reduce each hot key before its shuffle."""

import contextlib
import io
import random
from collections import defaultdict

from pyspark.sql import functions as F

from tagmeans import (ClusterConfig, draw_centers, grouped_postings, sample_stratified,
                      scored_vectors, stage_counts, weighted_points)
from tagmeans.schema import POSTING
from tagmeans.sources.star import to_lines

LANGS = ("Java", "Scala", "PHP")


def skewed_rows(seed=5, n_answers=3000):
    rnd = random.Random(seed)
    rows = []
    # Question 1 appears 40 times (hot duplicated id), the others once.
    rows += [(1, 1, None, None, k, "Java") for k in range(40)]
    rows += [(1, q, None, None, 0, rnd.choice(LANGS) if q % 4 else "Java") for q in range(2, 300)]
    aid = 10_000
    for k in range(n_answers):
        parent = 1 if k < n_answers // 3 else rnd.randint(2, 320)   # a third go to question 1
        rows.append((2, aid, None, parent, rnd.randint(-30, 90), None))
        aid += 1
    return rows


def brute(rows):
    qs, ans = defaultdict(list), defaultdict(list)
    for r in rows:
        if r[0] == 1:
            qs[r[1]].append(r)
        elif r[0] == 2:
            ans[r[3]].append(r)
    out = {}
    for qid, q in qs.items():
        if qid in ans:
            tag = q[0][5]
            out[qid] = (LANGS.index(tag) * 50000, max(0, max(a[4] for a in ans[qid])),
                        len(q) * len(ans[qid]))
    return out


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_question_and_duplicates_exact(spark):
    rows = skewed_rows()
    p = spark.createDataFrame(rows, POSTING)
    expect = brute(rows)
    cfg = ClusterConfig(langs=LANGS, kernels=6)
    got = {r.id: (r.x, r.high_score) for r in scored_vectors(p, cfg).collect()}
    assert got == {k: v[:2] for k, v in expect.items()}
    pairs = {r.qid: r.n_pairs for r in grouped_postings(p).collect()}
    assert pairs == {k: v[2] for k, v in expect.items()}
    counts = {r.stage: r.n for r in stage_counts(to_lines(p), cfg).collect()}
    assert counts["qa_pairs"] == sum(v[2] for v in expect.values())
    assert counts["scored"] == len(expect)


def test_hot_keys_reduced_before_shuffle(spark):
    p = spark.createDataFrame(skewed_rows(), POSTING)
    cfg = ClusterConfig(langs=LANGS, kernels=6)
    plan = plan_text(scored_vectors(p, cfg))
    # the partial aggregate sits below the only exchange
    assert "partial_max" in plan and plan.count("Exchange hashpartitioning") == 1
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")
    v = scored_vectors(p, cfg)
    wplan = plan_text(weighted_points(v))
    assert "partial_count" in wplan
    splan = plan_text(sample_stratified(v, cfg))
    # a group limit runs in every map task, before the exchange
    first_limit = splan.rindex("WindowGroupLimit")
    assert first_limit > splan.index("Exchange hashpartitioning")


def test_seed_draw_with_dominant_language(spark):
    rows = [(k, 0, k % 50) for k in range(5000)] + \
           [(5000 + k, 50000, k) for k in range(3)] + [(6000 + k, 100000, k) for k in range(4)]
    v = spark.createDataFrame(rows, "id int, x bigint, high_score int")
    cfg = ClusterConfig(langs=LANGS, kernels=9)
    seeds = draw_centers(v, cfg)
    assert len(seeds) == 9
    assert sorted(x for x, _ in seeds) == [0] * 3 + [50000] * 3 + [100000] * 3
    # whole data still counted: the weighted points cover every row
    assert weighted_points(v).agg(F.sum("n")).first()[0] == len(rows)


def test_grouping_also_reduces_before_shuffle(spark):
    p = spark.createDataFrame(skewed_rows(), POSTING)
    plan = plan_text(grouped_postings(p))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")


def test_salted_pairs(spark):
    """Ids hot on the question side, on the answer side and on both: all pairs once, and no
    partition of the join holds much more than the others, with AQE off."""
    from tagmeans import answers, qa_pairs, questions

    rows = [(1, 1, None, None, k, "Java") for k in range(60)] + [(1, 2, None, None, 0, "PHP")]
    rows += [(1, 3, None, None, k, "PHP") for k in range(400)] + [(1, q, None, None, 0, "Java") for q in range(4, 400)]
    rows += [(2, 10_000 + k, None, (1, 2, 2, 4 + k % 390)[k % 4], k, None) for k in range(4000)]
    rows += [(2, 1, None, 3, 7, None), (2, 2, None, 9_999, 7, None)]
    p = spark.createDataFrame(rows, POSTING).repartition(4)
    qs, ans = defaultdict(list), defaultdict(list)
    for r in rows:
        (qs[r[1]] if r[0] == 1 else ans[r[3]]).append(r)
    want = sorted(repr((k, q, a)) for k in qs for q in qs[k] for a in ans[k])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = qa_pairs(questions(p), answers(p, strict=False))
        assert "a_part" in plan_text(pairs)
        got = [(r.qid, tuple(r.question), tuple(r.answer)) for r in pairs.collect()]
        sizes = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(repr, got)) == want
    # 60,000 of some 64,000 pairs are of one id
    assert len(sizes) == 8 and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
    plain = qa_pairs(questions(p), answers(p, strict=False), salted=False)
    assert sorted(map(repr, [(r.qid, tuple(r.question), tuple(r.answer)) for r in plain.collect()])) == want


def test_hot_ids_are_counted_in_few_rows(spark):
    """Only ids of many rows are kept one by one; the others add up to one row."""
    from tagmeans.operators import scoring

    q = spark.range(1, 5001).select(F.col("id").alias("qid"), F.lit("q").alias("question"))
    a = spark.range(6000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id") - 1500).alias("qid"), F.lit("a").alias("answer"))
    kept, cut = [], scoring.cut_lineage
    scoring.cut_lineage = lambda df: kept.append(cut(df)) or kept[-1]
    try:
        hot = scoring._hot_ids(q, a).collect()
    finally:
        scoring.cut_lineage = cut
    assert [tuple(r) for r in hot] == [(7, 1, scoring.SALTS)]
    assert kept[0].count() == 2 and kept[0].agg(F.sum("na")).first()[0] == 6000
