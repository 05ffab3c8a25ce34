from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException

from tagmeans import (ClusterConfig, answers, grouped_postings, qa_pairs, questions,
                      scored_postings, scored_vectors, vector_postings)
from tagmeans.plans.clustering import vectors_from_postings

PHP_Q = (1, 13882656, None, None, -1, "PHP")
PHP_ANSWERS = [(2, 13882679 + k, None, 13882656, s, None) for k, s in enumerate([2, 2, 5, 0, 0, 0])]


def test_high_score_and_vector_of_recorded_question(postings_df):
    p = postings_df([PHP_Q] + PHP_ANSWERS)
    scored = scored_postings(grouped_postings(p)).collect()
    assert [(r.id, r.tags, r.score, r.high_score) for r in scored] == [(13882656, "PHP", -1, 5)]
    v = scored_vectors(p, ClusterConfig()).collect()
    assert [(r.x, r.high_score) for r in v] == [(100000, 5)]


def test_cpp_vector(postings_df):
    p = postings_df([(1, 1, None, None, 0, "C++"), (2, 2, None, 1, 0, None)])
    assert [(r.x, r.high_score) for r in scored_vectors(p, ClusterConfig()).collect()] == [(250000, 0)]


def test_unanswered_orphans_negative_and_other_types(postings_df):
    p = postings_df([
        (1, 1, None, None, 3, "Java"),            # no answers -> absent
        (2, 10, None, 99, 7, None),                # orphan answer -> absent
        (1, 2, None, None, 0, "Java"),
        (2, 11, None, 2, -4, None), (2, 12, None, 2, -1, None),   # all negative -> 0
        (3, 2, None, 2, 50, None),                 # type 3 -> ignored
    ])
    rows = scored_postings(grouped_postings(p)).collect()
    assert [(r.id, r.high_score) for r in rows] == [(2, 0)]


def test_duplicate_question_ids_multiply_pairs(postings_df):
    p = postings_df([
        (1, 7, None, None, 0, "Scala"), (1, 7, None, None, 2, "Scala"),
        (2, 70, None, 7, 4, None), (2, 71, None, 7, 9, None), (2, 72, None, 7, -3, None),
    ])
    g = grouped_postings(p).collect()
    assert len(g) == 1
    r = g[0]
    assert (r.qid, r.n_pairs, r.score_sum, r.min_score, r.max_score) == (7, 6, 20, -3, 9)
    assert r.question.score == 0  # smallest record among the duplicates
    pairs = qa_pairs(questions(p), answers(p))
    assert pairs.count() == 6


def test_answer_without_parent_is_an_error(postings_df):
    p = postings_df([(1, 1, None, None, 0, "Java"), (2, 2, None, None, 1, None),
                     (2, 3, None, 1, 1, None)])
    with pytest.raises(PySparkException):
        grouped_postings(p).collect()
    assert grouped_postings(p, strict=False).count() == 1


def test_unknown_tag_error_or_drop(postings_df):
    p = postings_df([(1, 1, None, None, 0, "Cobol"), (2, 2, None, 1, 1, None),
                     (1, 3, None, None, 0, None), (2, 4, None, 3, 1, None),
                     (1, 5, None, None, 0, "Java"), (2, 6, None, 5, 1, None)])
    with pytest.raises(PySparkException):
        scored_vectors(p, ClusterConfig()).collect()
    with pytest.raises(PySparkException):
        vector_postings(scored_postings(grouped_postings(p)), ClusterConfig()).collect()
    drop = ClusterConfig(on_unknown="drop")
    assert [r.id for r in scored_vectors(p, drop).collect()] == [5]
    assert [r.id for r in vector_postings(scored_postings(grouped_postings(p)), drop).collect()] == [5]


LANGS = ["Java", "Scala", "PHP"]
posting_rows = st.lists(st.one_of(
    st.tuples(st.just(1), st.integers(0, 6), st.just(None), st.just(None),
              st.integers(-5, 5), st.sampled_from(LANGS)),
    st.tuples(st.just(2), st.integers(100, 120), st.just(None), st.integers(0, 8),
              st.integers(-20, 20), st.just(None)),
), max_size=40)


@settings(max_examples=15, deadline=None)
@given(posting_rows)
def test_grouping_matches_brute_force(spark, rows):
    from tagmeans.schema import POSTING
    p = spark.createDataFrame(rows, POSTING)
    qs = defaultdict(list)
    ans = defaultdict(list)
    for r in rows:
        (qs if r[0] == 1 else ans)[r[1] if r[0] == 1 else r[3]].append(r)
    expect = {}
    for qid in qs:
        if qid in ans:
            pairs = [(q, a) for q in qs[qid] for a in ans[qid]]
            expect[qid] = (len(pairs), sum(a[4] for _, a in pairs),
                           min(a[4] for _, a in pairs), max(a[4] for _, a in pairs))
    got = {r.qid: (r.n_pairs, r.score_sum, r.min_score, r.max_score)
           for r in grouped_postings(p).collect()}
    assert got == expect
    assert qa_pairs(questions(p), answers(p)).count() == sum(v[0] for v in expect.values())
    cfg = ClusterConfig(langs=tuple(LANGS), kernels=3)
    fused = sorted(tuple(r) for r in scored_vectors(p, cfg).collect())
    plain = sorted(tuple(r) for r in vector_postings(
        scored_postings(grouped_postings(p, langs=cfg.langs)), cfg).collect())
    assert fused == plain


def test_conflicting_duplicates_have_one_rule(postings_df):
    rows = [(1, 5, None, None, 0, "Java"), (1, 5, None, None, 3, "JavaScript"), (2, 7, None, 5, 4, None),
            (1, 6, None, None, 0, "Java"), (1, 6, None, None, 3, "Cobol"), (2, 8, None, 6, 4, None)]
    p = postings_df(rows)
    drop = ClusterConfig(on_unknown="drop")
    for got in (scored_vectors(p, drop),
                vector_postings(scored_postings(grouped_postings(p, langs=drop.langs)), drop),
                vectors_from_postings(p, drop, sample_fraction=30.0).distinct()):
        assert [tuple(r) for r in got.collect()] == [(5, 0, 4)]
    with pytest.raises(Exception, match="tag not in the language list"):
        scored_vectors(p, ClusterConfig()).count()
    with pytest.raises(Exception, match="tag not in the language list"):
        vector_postings(scored_postings(grouped_postings(p, langs=drop.langs)), ClusterConfig()).select("id").collect()
