import pytest

from tagmeans import (ClusterConfig, draw_centers, sample_global, sample_rows,
                      sample_stratified)
from tagmeans.operators.sampling import poisson_thresholds

LANGS = ("A", "B", "C")


def vectors(spark, per_lang_counts, spread=50000):
    rows = []
    vid = 0
    for lang, n in enumerate(per_lang_counts):
        for k in range(n):
            rows.append((vid, lang * spread, k % 7))
            vid += 1
    return spark.createDataFrame(rows, "id int, x bigint, high_score int")


def test_stratified_exact_per_language_and_deterministic(spark):
    cfg = ClusterConfig(langs=LANGS, kernels=6)
    v = vectors(spark, [10, 50, 3])
    s1 = sorted(tuple(r) for r in sample_stratified(v, cfg).collect())
    s2 = sorted(tuple(r) for r in sample_stratified(v, cfg).collect())
    assert s1 == s2
    assert [r[0] for r in s1] == list(range(6))
    by_lang = {}
    for i, x, _ in s1:
        by_lang.setdefault(x, []).append(i)
    assert by_lang == {0: [0, 1], 50000: [2, 3], 100000: [4, 5]}
    assert draw_centers(v, cfg) == [(x, y) for _, x, y in s1]


def test_stratified_too_few_points_or_absent_language(spark):
    cfg = ClusterConfig(langs=LANGS, kernels=9)
    with pytest.raises(ValueError, match="fewer than 3"):
        draw_centers(vectors(spark, [5, 2, 5]), cfg)
    with pytest.raises(ValueError, match="drew 6 seeds"):
        draw_centers(vectors(spark, [5, 5, 0]), cfg)


def test_global_sample(spark):
    cfg = ClusterConfig(langs=LANGS, kernels=6, lang_spread=100)
    v = vectors(spark, [10, 0, 1], spread=100)
    s = sample_global(v, cfg).collect()
    assert sorted(r.i for r in s) == list(range(6))
    assert len(draw_centers(v, cfg)) == 6
    with pytest.raises(ValueError, match="drew 3 seeds"):
        draw_centers(vectors(spark, [2, 0, 1], spread=100), cfg)


def test_poisson_row_sample(spark):
    df = spark.range(2000)
    s = sample_rows(df, 0.5, seed=0)
    rows = [r.id for r in s.collect()]
    assert 800 < len(rows) < 1200 and len(set(rows)) < len(rows)
    # the same rows on any partitioning
    for parts in (1, 4, 16):
        assert sorted(r.id for r in sample_rows(df.repartition(parts), 0.5, seed=0).collect()) == sorted(rows)
    assert sorted(r.id for r in sample_rows(df, 0.5, seed=1).collect()) != sorted(rows)
    kept = sample_rows(df, 0.25, with_replacement=False)
    assert 400 < kept.count() < 600 and kept.distinct().count() == kept.count()


def test_poisson_thresholds_follow_the_distribution():
    import math

    t = poisson_thresholds(0.5)
    assert t == sorted(set(t)) and t[-1] < 1 << 52
    assert abs(t[0] / 2 ** 52 - math.exp(-0.5)) < 1e-15
    assert abs(t[1] / 2 ** 52 - 1.5 * math.exp(-0.5)) < 1e-15
    assert poisson_thresholds(0.0) == []


def test_stratified_draw_is_whole_on_its_own(spark):
    cfg = ClusterConfig(langs=LANGS, kernels=9)
    v = vectors(spark, [4000, 7, 300])
    assert sample_stratified(v, cfg).count() == 9
    with pytest.raises(ValueError, match="fewer than 3"):
        draw_centers(vectors(spark, [400, 2, 30]), cfg)


def test_sample_is_drawn_above_the_aggregate(spark):
    """A sample by the aggregate's key is drawn once for each of its rows, not for each posting under it."""
    from pyspark.sql import functions as F

    from tagmeans import sample_rows
    from test_skew import plan_text

    df = spark.range(300).select((F.col("id") % 100).alias("id"), F.lit(1).alias("v")).groupBy("id").agg(F.sum("v").alias("v"))
    drawn = sample_rows(df, 0.5, seed=3)
    plan = plan_text(drawn)
    assert "Filter" not in plan and "md5" not in plan[plan.index("Exchange"):]
    some = {r.id: r["count"] for r in drawn.groupBy("id").count().collect()}
    assert 20 < len(some) < 60 and max(some.values()) > 1
    assert drawn.columns == ["id", "v"] and {r.v for r in drawn.collect()} == {3}
