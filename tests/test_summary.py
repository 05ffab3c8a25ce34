import pytest

from tagmeans import ClusterConfig, cluster_results, cluster_stats, report_lines
from tagmeans.config import DEFAULT_LANGS
from tagmeans.sources.sinks import REPORT_HEADER


def test_recorded_matlab_cluster(points_df):
    pts = points_df([(600000, 5), (600000, 10), (600000, 11), (600000, 4)])
    rows = cluster_results(pts, [(600000, 7)], ClusterConfig()).collect()
    assert [tuple(r) for r in rows] == [("MATLAB", 100.0, 4, 7)]


def test_mixed_cluster_odd_median_and_empty_cluster(points_df):
    pts = points_df([(0, 1), (0, 2), (50000, 9), (0, 3), (50000, 100)], )
    rows = cluster_results(pts, [(10000, 0), (900000, 900000)], ClusterConfig()).collect()
    assert [tuple(r) for r in rows] == [("JavaScript", 60.0, 5, 3)]


def test_dominant_tie_takes_lowest_language(points_df):
    pts = points_df([(50000, 1), (0, 1), (50000, 2), (0, 2)])
    r = cluster_results(pts, [(25000, 0)], ClusterConfig()).first()
    assert (r.lang_label, r.lang_percent, r.median_score) == ("JavaScript", 50.0, 1)


def test_weighted_points_give_same_result(points_df):
    plain = points_df([(100000, 1), (100000, 1), (100000, 4), (150000, 8)])
    weighted = points_df([(100000, 1, 2), (100000, 4, 1), (150000, 8, 1)], weighted=True)
    cfg = ClusterConfig()
    c = [(100000, 0), (150000, 8)]
    assert cluster_results(plain, c, cfg).collect() == cluster_results(weighted, c, cfg).collect()


def test_results_sorted_by_median(points_df):
    pts = points_df([(0, 50), (50000, 5), (100000, 20)])
    rows = cluster_results(pts, [(0, 50), (50000, 5), (100000, 20)], ClusterConfig()).collect()
    assert [r.median_score for r in rows] == [5, 20, 50]


def test_report_lines(points_df):
    pts = points_df([(600000, 5), (600000, 10), (600000, 11), (600000, 4), (0, 1), (50000, 1),
                     (50000, 1)])
    stats = cluster_stats(pts, [(600000, 7), (25000, 1)], ClusterConfig())
    lines = [r.line for r in report_lines(stats).orderBy("pos").collect()]
    assert lines == [
        *REPORT_HEADER,
        "      1  Java              (66.7 %)            3",
        "      7  MATLAB            (100.0%)            4",
    ]


def test_config_validation():
    with pytest.raises(ValueError):
        ClusterConfig(kernels=44)
    with pytest.raises(ValueError):
        ClusterConfig(lang_spread=0)
    with pytest.raises(ValueError):
        ClusterConfig(on_unknown="skip")
    assert ClusterConfig().per_lang == 3 and ClusterConfig().stratified
    assert not ClusterConfig(lang_spread=499).stratified
    assert DEFAULT_LANGS.index("MATLAB") == 12


def test_report_rounds_half_up(points_df):
    # 351 of 400 points in one language: exactly 87.75 %, printed as 87.8
    pts = points_df([(50000, 3, 351), (0, 3, 49)], weighted=True)
    stats = cluster_stats(pts, [(40000, 3)], ClusterConfig())
    lines = [r.line for r in report_lines(stats).orderBy("pos").collect()]
    assert lines[3] == "      3  Java              (87.8 %)          400"


def test_report_from_plain_results(points_df):
    pts = points_df([(0, 50), (50000, 5), (100000, 20)])
    res = cluster_results(pts, [(0, 50), (50000, 5), (100000, 20)], ClusterConfig())
    lines = [r.line for r in report_lines(res).orderBy("pos").collect()]
    assert [ln.split()[0] for ln in lines[3:]] == ["5", "20", "50"]
