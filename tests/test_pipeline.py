import pytest
from pyspark.errors import PySparkException

from tagmeans import ClusterConfig, run_lines

LANGS = ("A", "B", "C")


def lines_for(n_per_lang=40, bad=None):
    out = []
    aid = 10_000
    for li, lang in enumerate(LANGS):
        for q in range(n_per_lang):
            qid = li * 1000 + q + 1
            out.append(f"1,{qid},,,0,{lang}")
            for s in range(q % 4 + 1):
                out.append(f"2,{aid},,{qid},{(q * 7 + s) % 60 - 5}")
                aid += 1
    if bad:
        out.append(bad)
    return out


def test_pipeline_totals_and_iteration_bound(lines_df):
    cfg = ClusterConfig(langs=LANGS, kernels=6, max_iterations=50)
    run = run_lines(lines_df(lines_for()), cfg)
    rows = run.results().collect()
    assert sum(r.cluster_size for r in rows) == 3 * 40
    assert 1 <= run.result.updates <= 50
    assert len(run.seeds) == 6
    run.release()


def test_pipeline_global_seeds(lines_df):
    cfg = ClusterConfig(langs=LANGS, kernels=6, lang_spread=100)
    run = run_lines(lines_df(lines_for()), cfg)
    assert sum(r.cluster_size for r in run.results().collect()) == 120


def test_pipeline_with_poisson_sample(lines_df):
    cfg = ClusterConfig(langs=LANGS, kernels=3)
    run = run_lines(lines_df(lines_for(200)), cfg, sample_fraction=0.5)
    n = sum(r.cluster_size for r in run.results().collect())
    assert 150 < n < 450   # about half of 600 scored questions, with repeats


def test_pipeline_strict_fails_on_malformed_line(lines_df):
    cfg = ClusterConfig(langs=LANGS, kernels=6)
    with pytest.raises(PySparkException):
        run_lines(lines_df(lines_for(bad="1,oops,,,0,A")), cfg)
    run = run_lines(lines_df(lines_for(bad="1,oops,,,0,A")), cfg, strict=False)
    assert sum(r.cluster_size for r in run.results().collect()) == 120


def test_stage_counts_lenient_counts_all_lines(lines_df):
    from tagmeans import stage_counts
    lines = lines_for(5) + ["1,oops,,,0,A", "", "3,77,,,1,A"]
    counts = {r.stage: r.n for r in stage_counts(lines_df(lines), ClusterConfig(
        langs=LANGS, kernels=6), strict=False).collect()}
    good = lines_for(5)
    assert counts["lines"] == len(good) + 3
    assert counts["postings"] == len(good) + 1          # the type-3 line parses
    assert counts["questions"] == 15 and counts["scored"] == 15 and counts["vectors"] == 15
    assert counts["answers"] == counts["qa_pairs"] == len(good) - 15
