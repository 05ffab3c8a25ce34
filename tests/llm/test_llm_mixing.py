"""Realised mixes against their targets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagmeans.llm import mixing
from tagmeans.llm.common import table

DOMAINS = ["0-0", "0-1", "1-0", "1-1"]


@pytest.mark.parametrize("targets", [
    {"1-0": 0.6, "0-0": 0.24, "1-1": 0.08, "0-1": 0.08}, {d: 0.25 for d in DOMAINS}, mixing.TARGETS, None])
def test_realised_totals_meet_targets(spark, targets):
    r = np.random.default_rng(7)
    n = r.integers(50, 150, 20_000)
    p = 0.96 * np.eye(4)[r.choice(4, len(n), p=[0.3, 0.05, 0.55, 0.1])] + 0.01
    df = spark.createDataFrame([(i, str(i % 9), int(a), [float(x) for x in b]) for i, (a, b) in enumerate(zip(n, p))],
                               "doc_id long, text string, n long, posterior array<double>")
    rate, fit = mixing.plan(df, DOMAINS, targets)
    assert fit.converged
    rows = mixing.with_copies(df, rate, mixing.drawn(F.col("doc_id"), F.col("text"))).orderBy("doc_id").collect()
    copies, own = np.array([x.copies for x in rows]), n @ p
    got = (copies * n) @ p
    if targets is None:
        clean = np.array([d[-1] == "0" for d in DOMAINS])
        assert np.allclose(got[clean], own[clean], rtol=0.03) and got[~clean].sum() < 0.02 * own.sum()
        return
    shares = np.array([targets[d] for d in DOMAINS])
    assert np.abs(got / got.sum() - shares).sum() < 0.05 and abs(got[shares.argmax()] / own[shares.argmax()] - 1) < 0.05
    # rates between the whole numbers are met by copies of both, rates above 1 by repeats
    assert all(x.copies in (int(x.rate), int(x.rate) + 1) for x in rows)
    assert copies.max() > 1 or max(x.rate for x in rows) <= 1


def test_query_and_mix_round_alike(spark):
    sf = "/root/testdata/sf0.01"
    rows = mixing.query(spark, sf).collect()
    got = {r.doc_id: (r.rate, r.copies) for r in rows}
    # all domains meet their targets, and the fit is at its optimum
    assert {r.gap < mixing.GAP for r in rows} == {True} and max(r.distance for r in rows) < 0.001
    out, _ = mixing.mix(table(spark, sf, "documents"), table(spark, sf, "labels"), mixing.TARGETS)
    assert got == {r.i: (r.rate, r.copies) for r in out.select(F.col("row.doc_id").alias("i"), "rate", "copies").collect()}
    assert abs(sum(c for _, c in got.values()) / sum(x for x, _ in got.values()) - 1) < 0.05


def test_targets_that_no_rates_meet(spark):
    """Documents that are all half of each domain: rates stay near the whole, and the fit says so."""
    df = spark.createDataFrame([(i, 100, [0.5, 0.5]) for i in range(50)], "doc_id long, n long, posterior array<double>")
    with pytest.warns(UserWarning, match="no rates near 1 meet the targets"):
        rate, fit = mixing.plan(df, ["0", "1"], {"0": 0.9, "1": 0.1})
    assert fit.converged and fit.distance > 0.3
    rates = [r.rate for r in df.select(rate.alias("rate")).collect()]
    # the least squares of misses: totals halfway between the targets
    assert max(rates) - min(rates) < 1e-9 and abs(rates[0] - 0.556) < 0.02


def test_clean_documents_stay(spark):
    """Without targets: sure clean documents stand once, toxic ones go, doubtful ones by their posterior."""
    r = np.random.default_rng(1)
    toxic = np.r_[np.full(900, 1e-4), np.full(80, 1 - 1e-4), np.linspace(0, 1, 20)]
    df = spark.createDataFrame([(i, int(r.integers(10, 900)), [float(0.1 * (1 - t)), float(0.1 * t), float(0.9 * (1 - t)), float(0.9 * t)])
                                for i, t in enumerate(toxic)], "doc_id long, n long, posterior array<double>")
    rate, fit = mixing.plan(df, DOMAINS)
    rates = np.array([x.rate for x in df.select("doc_id", rate.alias("rate")).orderBy("doc_id").collect()])
    assert fit.converged and fit.distance < 1e-3 and np.abs(rates - (1 - toxic)).max() < 0.01
