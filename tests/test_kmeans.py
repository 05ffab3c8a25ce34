import random

import pytest
from hypothesis import given, settings, strategies as st

from tagmeans import ClusterConfig, assign_closest, converged, kmeans, kmeans_step, movement
from tagmeans.operators.kmeans import update_centers


def brute_closest(p, centers):
    best, bd = 0, float("inf")
    for i, c in enumerate(centers):
        d = float(p[0] - c[0]) ** 2 + float(p[1] - c[1]) ** 2
        if d < bd:
            best, bd = i, d
    return best


def brute_update(points, centers):
    groups = {}
    for p in points:
        groups.setdefault(brute_closest(p, centers), []).append(p)
    out = []
    for i, c in enumerate(centers):
        g = groups.get(i)
        if not g:
            out.append(c)
            continue
        sx, sy, n = sum(p[0] for p in g), sum(p[1] for p in g), len(g)
        tx = abs(sx) // n * (1 if sx >= 0 else -1)
        ty = abs(sy) // n * (1 if sy >= 0 else -1)
        out.append((tx, ty))
    return out


def test_tie_goes_to_lowest_index(points_df):
    df = assign_closest(points_df([(0, 5)]), [(100, 100), (0, 0), (0, 10)])
    assert df.first().i == 1


def test_truncating_integer_mean_and_empty_cluster(points_df):
    new, sizes = update_centers(points_df([(0, 1), (0, 2), (50, -1), (50, -2)]),
                                [(0, 0), (50, 0), (1000, 1000)])
    assert new == [(0, 1), (50, -1), (1000, 1000)]
    assert sizes == [2, 2, 0]


def test_step_frame(points_df):
    rows = kmeans_step(points_df([(0, 1), (0, 2), (50, -1), (50, -2)]),
                       [(0, 0), (50, 0), (1000, 1000)]).orderBy("i").collect()
    assert [(r.new_x, r.new_y, r.n, r.distance) for r in rows] == [
        (0, 1, 2, 1.0), (50, -1, 2, 1.0), (1000, 1000, 0, 0.0)]


def test_movement_and_convergence():
    assert movement([(0, 0), (3, 4)], [(1, 1), (0, 0)]) == 2.0 + 25.0
    assert not converged(20.0, 20.0)
    assert converged(19.999, 20.0)
    with pytest.raises(ValueError):
        movement([(0, 0)], [])


def test_loop_stops_at_max_and_respects_start(points_df):
    pts = points_df([(x, (x * 37) % 101) for x in range(200)])
    cfg = ClusterConfig(langs=("a", "b"), kernels=4, eta=0.0, max_iterations=3)
    r = kmeans(pts, [(0, 0), (1, 1), (2, 2), (3, 3)], cfg)
    assert r.updates == 3 and not r.converged
    r2 = kmeans(pts, [(0, 0), (1, 1), (2, 2), (3, 3)], cfg, start_iter=3)
    assert r2.updates == 1
    r3 = kmeans(pts, [(0, 0), (1, 1), (2, 2), (3, 3)], cfg, start_iter=10)
    assert r3.updates == 1  # at least one update always runs
    assert [t[0] for t in r.trace] == [1] * 4 + [2] * 4 + [3] * 4


def test_weighted_equals_unweighted(spark, points_df):
    rnd = random.Random(3)
    pts = [(rnd.choice([0, 100, 200]), rnd.randint(0, 30)) for _ in range(300)]
    counts = {}
    for p in pts:
        counts[p] = counts.get(p, 0) + 1
    plain = points_df(pts)
    weighted = points_df([(x, y, n) for (x, y), n in counts.items()], weighted=True)
    cfg = ClusterConfig(langs=("a", "b", "c"), kernels=6, eta=1.0)
    seeds = [(0, 0), (0, 30), (100, 0), (100, 30), (200, 0), (200, 30)]
    a, b = kmeans(plain, seeds, cfg), kmeans(weighted, seeds, cfg)
    assert a.centers == b.centers and a.updates == b.updates


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(-50, 50), st.integers(-50, 50)), min_size=1, max_size=60),
       st.lists(st.tuples(st.integers(-50, 50), st.integers(-50, 50)), min_size=1, max_size=6))
def test_update_matches_brute_force(spark, points, centers):
    df = spark.createDataFrame(points, "x bigint, y bigint")
    new, _ = update_centers(df, centers)
    assert new == brute_update(points, centers)
