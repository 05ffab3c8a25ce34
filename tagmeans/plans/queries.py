"""Registered queries over the star test tables and their DuckDB oracles.

Every query reads the whole tables through the adapter in
``sources.star`` (orders + customer -> questions, lineitem -> answers) and
runs one operator family of the reference on them. ``ORACLES`` holds, for
each query, SQL over the same tables that computes the same rows by brute
force (it materializes pairs, expands the point multiset, compares every
point with every center), with the same column names and types.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ClusterConfig
from ..operators.counts import stage_counts
from ..operators.kmeans import assign_closest, kmeans, kmeans_step
from ..operators.parse import answers, malformed_lines, parse_postings, questions
from ..operators.sampling import (draw_centers, poisson_thresholds, sample_global, sample_rows,
                                  sample_stratified)
from ..operators.scoring import grouped_postings, qa_pairs, scored_postings, scored_vectors
from ..operators.vectors import vector_postings, weighted_points, with_lang_index
from ..schema import POSTING_COLUMNS
from ..sources.star import STAR_TAGS, star_config, star_lines, star_postings, table
from ..sources.text import read_lines
from .checkpoint import cut_lineage, delete_copy, ensure_checkpoint_dir, write_copy
from .clustering import cluster_vectors, score, vectors_from_postings

# Settings of the registered queries.
CFG = star_config()                                   # spread 50000, k 45, eta 20, seed 42
CFG_MIXED = star_config(lang_spread=100)              # global seeds, languages mix
CFG_MAX3 = star_config(max_iterations=3)
RESUME_FROM = 110                                     # kmeans(..., iter=110): at most 11 updates
# A language list that leaves the 'P' status tags unknown.
PARTIAL_TAGS: tuple[str, ...] = tuple(t for t in STAR_TAGS if not t.endswith("-P"))
CFG_DROP = ClusterConfig(langs=PARTIAL_TAGS, kernels=len(PARTIAL_TAGS) * 3, on_unknown="drop")
CFG_DUP = star_config(on_unknown="drop")
K3_FRACTION = 0.5


# ---------------------------------------------------------------- Spark side

def _postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed postings (P1) of the adapter's posting lines."""
    return parse_postings(star_lines(spark, sf_dir))


def _vectors(spark, sf_dir, cfg: ClusterConfig) -> DataFrame:
    """Per-question points through the fused plan the pipeline uses."""
    return scored_vectors(_postings(spark, sf_dir), cfg)


def _held(df: DataFrame) -> DataFrame:
    """A frame of at most a few hundred rows, from its rows on the driver: what it
    was computed from can be released."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def q_parse_postings(spark, sf_dir):
    return _postings(spark, sf_dir)


def q_text_scan(spark, sf_dir):
    """S1 through the real text reader: the adapter's lines are written as a
    text table into the shared checkpoint folder, then scanned and parsed."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tagmeans-lines-{uuid.uuid4().hex}"
    star_lines(spark, sf_dir).write.mode("overwrite").text(path)
    parsed = cut_lineage(parse_postings(read_lines(spark, path)))
    delete_copy(spark, path)
    return parsed


def _salted_lines(spark, sf_dir) -> DataFrame:
    """All adapter lines plus one corrupted copy of every order line and of
    every line item line whose return flag is A or N."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber",
                                                 "l_extendedprice", "l_returnflag")
    key = F.col("o_orderkey").cast("string")
    bad_q = o.select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit(" 1,"), key, F.lit(",,,0,X")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("99999999999,"), key, F.lit(",,,0,X")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("1,"), key))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))
        .otherwise(F.concat(F.lit("2,"), key, F.lit(",,x,1"))).alias("value"))
    score = F.floor((F.col("l_extendedprice") - F.lit(40000.0)) / F.lit(100.0)).cast("string")
    lid = F.col("l_linenumber").cast("string")
    bad_a = li.where(F.col("l_returnflag").isin("A", "N")).select(
        F.when(F.col("l_returnflag") == "A",
               F.concat(F.lit("2,"), lid, F.lit(",,"), F.col("l_orderkey").cast("string"),
                        F.lit(","), score, F.lit(".5")))
        .otherwise(F.concat(F.lit("2,"), lid, F.lit("0000000000,,"),
                            F.col("l_orderkey").cast("string"), F.lit(","), score))
        .alias("value"))
    return star_lines(spark, sf_dir).unionByName(bad_q).unionByName(bad_a)


def _separator_lines(spark, sf_dir) -> DataFrame:
    """Lines with line separators: one after the score (malformed) and one within the
    tag (valid) of every order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    mark = F.when(F.col("o_orderstatus") == "F", F.lit("\u0085")).otherwise(F.lit("\u2028"))
    key = F.col("o_orderkey").cast("string")
    return o.select(F.explode(F.array(
        F.concat(F.lit("2,7,,"), key, F.lit(",3"), mark),
        F.concat(F.lit("1,"), key, F.lit(",,,0,a"), mark, F.lit("b")))).alias("value"))


def q_parse_lenient(spark, sf_dir):
    """P1 with malformed lines dropped."""
    lines = _salted_lines(spark, sf_dir).unionByName(_separator_lines(spark, sf_dir))
    return parse_postings(lines, strict=False)


def _duplicated(spark, sf_dir) -> DataFrame:
    """The postings, and for every second order a second question of its id with
    another score and tag; every fourth of those has an unknown tag."""
    key = F.col("id")
    other = F.element_at(F.array(*map(F.lit, STAR_TAGS)), (key % len(STAR_TAGS) + 1).cast("int"))
    again = (star_postings(spark, sf_dir).where((F.col("posting_type") == 1) & (key % 2 == 0))
             .withColumn("score", F.lit(-1))
             .withColumn("tags", F.when(key % 8 == 0, F.lit("unknown")).otherwise(other)))
    return star_postings(spark, sf_dir).unionByName(again)


def q_duplicate_questions(spark, sf_dir):
    """A3 + P5 in one aggregation, with conflicting duplicates of questions."""
    return scored_vectors(_duplicated(spark, sf_dir), CFG_DUP)


def q_duplicate_questions_unfused(spark, sf_dir):
    """The same by the scored records."""
    return vector_postings(score(_duplicated(spark, sf_dir), langs=CFG_DUP.langs), CFG_DUP)


def q_malformed_lines(spark, sf_dir):
    return malformed_lines(_salted_lines(spark, sf_dir))


def q_questions(spark, sf_dir):
    return questions(_postings(spark, sf_dir))


def q_answers(spark, sf_dir):
    return answers(_postings(spark, sf_dir))


def q_qa_pairs(spark, sf_dir):
    p = _postings(spark, sf_dir)
    return qa_pairs(questions(p), answers(p)).select(
        "qid", F.col("question.tags").alias("tags"),
        F.col("answer.id").alias("answer_id"), F.col("answer.score").alias("answer_score"))


def _hot_answers(spark, sf_dir) -> DataFrame:
    """The postings with every third answer moved to the first question. They are parsed
    once and read from a copy: five passes follow, whose filters would repeat the parsing."""
    p = cut_lineage(_postings(spark, sf_dir))
    first = p.where("posting_type = 1").agg(F.min("id")).first()[0]
    moved = (F.col("posting_type") == 2) & (F.col("id") % 3 == 0)
    return p.withColumn("parent_id", F.when(moved, F.lit(first)).otherwise(F.col("parent_id")))


def q_qa_pairs_hot(spark, sf_dir):
    """J1 with a third of the answers under one id, dealt by salts."""
    p = _hot_answers(spark, sf_dir)
    return qa_pairs(questions(p), answers(p), salted=True).select(
        "qid", F.col("question.tags").alias("tags"),
        F.col("answer.id").alias("answer_id"), F.col("answer.score").alias("answer_score"))


def q_grouped_postings(spark, sf_dir):
    return grouped_postings(_postings(spark, sf_dir)).select(
        "qid", F.col("question.tags").alias("tags"), "n_pairs", "score_sum",
        "min_score", "max_score")


def q_scored_postings(spark, sf_dir):
    return scored_postings(grouped_postings(_postings(spark, sf_dir)))


def q_sampled_scored(spark, sf_dir):
    return sample_rows(score(_postings(spark, sf_dir)), K3_FRACTION, seed=0).select(
        "id", "tags", "high_score")


def q_lang_index(spark, sf_dir):
    return with_lang_index(_postings(spark, sf_dir), PARTIAL_TAGS).select(
        "id", "posting_type", "tags", "lang_idx")


def q_vector_postings(spark, sf_dir):
    """P5 on the scored questions (the unfused path)."""
    return vector_postings(score(_postings(spark, sf_dir)), CFG)


def q_vector_postings_drop(spark, sf_dir):
    return vector_postings(score(_postings(spark, sf_dir)), CFG_DROP)


def q_scored_vectors(spark, sf_dir):
    """A1-A3 + P5 fused into one aggregation (the pipeline's plan)."""
    return _vectors(spark, sf_dir, CFG)


def q_scored_vectors_drop(spark, sf_dir):
    return _vectors(spark, sf_dir, CFG_DROP)


def q_weighted_points(spark, sf_dir):
    return weighted_points(_vectors(spark, sf_dir, CFG))


def q_stage_counts(spark, sf_dir):
    return stage_counts(star_lines(spark, sf_dir), CFG)


def q_sample_stratified(spark, sf_dir):
    return sample_stratified(_vectors(spark, sf_dir, CFG), CFG)


def q_sample_global(spark, sf_dir):
    return sample_global(_vectors(spark, sf_dir, CFG_MIXED), CFG_MIXED)


def _drawn(spark, sf_dir, cfg):
    """Seeds and weighted points; the per-question points are deleted again."""
    vectors, path = write_copy(_vectors(spark, sf_dir, cfg))
    weighted, seeds = cut_lineage(weighted_points(vectors)), draw_centers(vectors, cfg)
    delete_copy(spark, path)
    return weighted, seeds


def q_assign_closest(spark, sf_dir):
    weighted, seeds = _drawn(spark, sf_dir, CFG)
    return assign_closest(weighted, seeds).select("x", "y", "n", "i")


def q_kmeans_step(spark, sf_dir):
    return kmeans_step(*_drawn(spark, sf_dir, CFG))


def _run(vectors: DataFrame, cfg: ClusterConfig, out) -> DataFrame:
    """``out(run)``, held, with everything the run kept released."""
    run = cluster_vectors(vectors, cfg)
    try:
        return _held(out(run))
    finally:
        run.release()


def _looped(spark, sf_dir, cfg, out, start_iter=1):
    weighted, seeds = _drawn(spark, sf_dir, cfg)
    weighted = weighted.persist()
    try:
        return out(kmeans(weighted, seeds, cfg, start_iter=start_iter))
    finally:
        weighted.unpersist()


def q_kmeans_means(spark, sf_dir):
    return _looped(spark, sf_dir, CFG, lambda r: r.centers_frame(spark))


def q_kmeans_max_iter(spark, sf_dir):
    return _looped(spark, sf_dir, CFG_MAX3, lambda r: r.centers_frame(spark))


def q_kmeans_resume(spark, sf_dir):
    return _looped(spark, sf_dir, CFG, lambda r: r.centers_frame(spark), start_iter=RESUME_FROM)


def q_kmeans_trace(spark, sf_dir):
    return _looped(spark, sf_dir, CFG, lambda r: r.trace_frame(spark))


def q_cluster_results(spark, sf_dir):
    return _run(scored_vectors(star_postings(spark, sf_dir), CFG), CFG, lambda r: r.results())


def q_cluster_results_lines(spark, sf_dir):
    return _run(_vectors(spark, sf_dir, CFG), CFG, lambda r: r.results())


def q_cluster_results_mixed(spark, sf_dir):
    return _run(_vectors(spark, sf_dir, CFG_MIXED), CFG_MIXED, lambda r: r.results())


def q_cluster_results_sampled(spark, sf_dir):
    """The whole pipeline over a Poisson sample of the scored questions (K3)."""
    sample = vectors_from_postings(_postings(spark, sf_dir), CFG, sample_fraction=K3_FRACTION)
    return _run(sample, CFG, lambda r: r.results())


def q_cluster_report(spark, sf_dir):
    return _run(_vectors(spark, sf_dir, CFG), CFG, lambda r: r.report())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_postings": q_parse_postings,
    "text_scan": q_text_scan,
    "malformed_lines": q_malformed_lines,
    "parse_lenient": q_parse_lenient,
    "duplicate_questions": q_duplicate_questions,
    "duplicate_questions_unfused": q_duplicate_questions_unfused,
    "questions": q_questions,
    "answers": q_answers,
    "qa_pairs": q_qa_pairs,
    "qa_pairs_hot": q_qa_pairs_hot,
    "grouped_postings": q_grouped_postings,
    "scored_postings": q_scored_postings,
    "sampled_scored": q_sampled_scored,
    "lang_index": q_lang_index,
    "vector_postings": q_vector_postings,
    "vector_postings_drop": q_vector_postings_drop,
    "scored_vectors": q_scored_vectors,
    "scored_vectors_drop": q_scored_vectors_drop,
    "weighted_points": q_weighted_points,
    "stage_counts": q_stage_counts,
    "sample_stratified": q_sample_stratified,
    "sample_global": q_sample_global,
    "assign_closest": q_assign_closest,
    "kmeans_step": q_kmeans_step,
    "kmeans_means": q_kmeans_means,
    "kmeans_max_iter": q_kmeans_max_iter,
    "kmeans_resume": q_kmeans_resume,
    "kmeans_trace": q_kmeans_trace,
    "cluster_results": q_cluster_results,
    "cluster_results_lines": q_cluster_results_lines,
    "cluster_results_mixed": q_cluster_results_mixed,
    "cluster_results_sampled": q_cluster_results_sampled,
    "cluster_report": q_cluster_report,
}


# --------------------------------------------------------------- DuckDB side

def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_POSTINGS_SQL = """
q AS (
  SELECT CAST(1 AS INTEGER) AS posting_type, CAST(o_orderkey AS INTEGER) AS id,
         CAST(NULL AS INTEGER) AS accepted_answer, CAST(NULL AS INTEGER) AS parent_id,
         CAST(0 AS INTEGER) AS score, c_mktsegment || '-' || o_orderstatus AS tags
  FROM orders JOIN customer ON o_custkey = c_custkey),
a AS (
  SELECT CAST(2 AS INTEGER) AS posting_type, CAST(l_linenumber AS INTEGER) AS id,
         CAST(NULL AS INTEGER) AS accepted_answer, CAST(l_orderkey AS INTEGER) AS parent_id,
         CAST(floor((l_extendedprice - CAST(40000 AS DOUBLE)) / CAST(100 AS DOUBLE)) AS INTEGER) AS score,
         CAST(NULL AS VARCHAR) AS tags
  FROM lineitem),
p AS (SELECT * FROM q UNION ALL SELECT * FROM a),
sc AS (
  SELECT q.posting_type, q.id, q.accepted_answer, q.parent_id, q.score, q.tags,
         CAST(greatest(max(a.score), 0) AS INTEGER) AS high_score
  FROM q JOIN a ON q.id = a.parent_id
  GROUP BY q.posting_type, q.id, q.accepted_answer, q.parent_id, q.score, q.tags)"""


def _vec_sql(cfg: ClusterConfig, scored: str = "sc") -> str:
    idx = f"list_position({_sql_list(cfg.langs)}, tags) - 1"
    where = "WHERE lang_idx IS NOT NULL" if cfg.on_unknown == "drop" else ""
    return f"""
vi AS (SELECT id, CAST({idx} AS BIGINT) AS lang_idx, high_score FROM {scored}),
vec AS (SELECT id, lang_idx * {cfg.lang_spread} AS x, high_score FROM vi {where}),
wp AS (SELECT CAST(x AS BIGINT) AS x, CAST(high_score AS BIGINT) AS y, CAST(count(*) AS BIGINT) AS n
       FROM vec GROUP BY x, high_score)"""


def _seeds_sql(cfg: ClusterConfig) -> str:
    if cfg.stratified:
        return f"""
sd AS (SELECT id, x, high_score AS y,
              md5(concat_ws('|', '{cfg.seed}', CAST(x AS VARCHAR), CAST(id AS VARCHAR))) AS h FROM vec),
sr AS (SELECT *, row_number() OVER (PARTITION BY x ORDER BY h, id) AS rn FROM sd),
seeds AS (SELECT CAST((x // {cfg.lang_spread}) * {cfg.per_lang} + rn - 1 AS INTEGER) AS i,
                 CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y
          FROM sr WHERE rn <= {cfg.per_lang})"""
    return f"""
sd AS (SELECT id, x, high_score AS y,
              md5(concat_ws('|', '{cfg.seed}', CAST(id AS VARCHAR))) AS h FROM vec),
seeds AS (SELECT CAST(row_number() OVER (ORDER BY h, id) - 1 AS INTEGER) AS i,
                 CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y
          FROM (SELECT * FROM sd ORDER BY h, id LIMIT {cfg.kernels}))"""


def _dist(px: str, py: str, cx: str, cy: str) -> str:
    return (f"(CAST({px} - {cx} AS DOUBLE) * CAST({px} - {cx} AS DOUBLE) + "
            f"CAST({py} - {cy} AS DOUBLE) * CAST({py} - {cy} AS DOUBLE))")


def _kmeans_sql(cfg: ClusterConfig, max_updates: int) -> str:
    """State rows ``(u, i, x, y, ox, oy, n, dist)``: centers after ``u``
    updates, the centers before, cluster size and total movement."""
    d = _dist("p.x", "p.y", "c.x", "c.y")
    return f"""
km(u, i, x, y, ox, oy, n, dist) AS (
  SELECT 0, i, x, y, x, y, CAST(0 AS BIGINT), CAST('inf' AS DOUBLE) FROM seeds
  UNION ALL
  SELECT * FROM (
    WITH cur AS (SELECT * FROM km WHERE dist >= {float(cfg.eta)} AND u < {max_updates}),
    asg AS (SELECT p.x, p.y, p.n, min(struct_pack(d := {d}, i := c.i)).i AS i
            FROM wp p, cur c GROUP BY p.x, p.y, p.n),
    sums AS (SELECT i, sum(x * n) AS sx, sum(y * n) AS sy, sum(n) AS n FROM asg GROUP BY i),
    nxt AS (SELECT c.u + 1 AS u, c.i,
                   CAST(coalesce(s.sx // s.n, c.x) AS BIGINT) AS x,
                   CAST(coalesce(s.sy // s.n, c.y) AS BIGINT) AS y,
                   c.x AS ox, c.y AS oy, CAST(coalesce(s.n, 0) AS BIGINT) AS n
            FROM cur c LEFT JOIN sums s ON c.i = s.i)
    SELECT u, i, x, y, ox, oy, n, sum({_dist("x", "y", "ox", "oy")}) OVER () AS dist FROM nxt)
),
fin AS (SELECT i, x, y FROM km WHERE u = (SELECT max(u) FROM km))"""


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts)


def _results_sql(cfg: ClusterConfig) -> str:
    d = _dist("p.x", "p.y", "c.x", "c.y")
    return f"""
asg AS (SELECT p.x, p.y, p.n, min(struct_pack(d := {d}, i := c.i)).i AS i
        FROM wp p, fin c GROUP BY p.x, p.y, p.n),
bl AS (SELECT i, x, sum(n) AS c FROM asg GROUP BY i, x),
dom AS (SELECT i, max(struct_pack(c := c, nx := -x)) AS top FROM bl GROUP BY i),
sz AS (SELECT i, sum(n) AS size FROM asg GROUP BY i),
med AS (SELECT i, CAST(trunc(quantile_cont(y, 0.5)) AS INTEGER) AS median_score
        FROM (SELECT a.i, a.y FROM asg a, range(a.n)) GROUP BY i),
res AS (
  SELECT sz.i, CAST(-dom.top.nx // {cfg.lang_spread} AS INTEGER) AS lang_idx,
         {_sql_list(cfg.langs)}[CAST(-dom.top.nx // {cfg.lang_spread} AS INTEGER) + 1] AS lang_label,
         CAST(dom.top.c AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(sz.size AS DOUBLE) AS lang_percent,
         CAST(sz.size AS BIGINT) AS cluster_size, med.median_score
  FROM sz JOIN dom ON sz.i = dom.i JOIN med ON sz.i = med.i)"""


def _full(cfg: ClusterConfig, max_updates: int | None = None) -> str:
    mu = cfg.max_iterations if max_updates is None else max_updates
    return _with(_POSTINGS_SQL, _vec_sql(cfg), _seeds_sql(cfg), _kmeans_sql(cfg, mu),
                 _results_sql(cfg))


_PATTERN_SQL = (r"(?s)[+-]?[0-9]+,[+-]?[0-9]+,([+-]?[0-9]+)?,([+-]?[0-9]+)?,[+-]?[0-9]+(,.*)?")


def _salted_sql(more: str = "") -> str:
    """``chk``: the salted lines with both checks of the strict parser."""
    fields = "string_split(rtrim(value, ','), ',')"
    fits = " AND ".join(
        f"(coalesce({fields}[{k + 1}], '') = '' OR try_cast({fields}[{k + 1}] AS INTEGER) IS NOT NULL)"
        for k in range(5))
    return f"""WITH {_POSTINGS_SQL},
lines AS (
  SELECT concat_ws(',', CAST(posting_type AS VARCHAR), CAST(id AS VARCHAR),
                   coalesce(CAST(accepted_answer AS VARCHAR), ''),
                   coalesce(CAST(parent_id AS VARCHAR), ''), CAST(score AS VARCHAR),
                   coalesce(tags, '')) AS value FROM p
  UNION ALL
  SELECT CASE o_orderpriority
           WHEN '1-URGENT' THEN ' 1,' || CAST(o_orderkey AS VARCHAR) || ',,,0,X'
           WHEN '2-HIGH' THEN '99999999999,' || CAST(o_orderkey AS VARCHAR) || ',,,0,X'
           WHEN '3-MEDIUM' THEN '1,' || CAST(o_orderkey AS VARCHAR)
           WHEN '4-NOT SPECIFIED' THEN ''
           ELSE '2,' || CAST(o_orderkey AS VARCHAR) || ',,x,1' END FROM orders
  UNION ALL
  SELECT CASE WHEN l_returnflag = 'A'
           THEN '2,' || CAST(l_linenumber AS VARCHAR) || ',,' || CAST(l_orderkey AS VARCHAR)
                || ',' || CAST(CAST(floor((l_extendedprice - CAST(40000 AS DOUBLE)) / CAST(100 AS DOUBLE)) AS BIGINT) AS VARCHAR) || '.5'
           ELSE '2,' || CAST(l_linenumber AS VARCHAR) || '0000000000,,' || CAST(l_orderkey AS VARCHAR)
                || ',' || CAST(CAST(floor((l_extendedprice - CAST(40000 AS DOUBLE)) / CAST(100 AS DOUBLE)) AS BIGINT) AS VARCHAR) END
  FROM lineitem WHERE l_returnflag IN ('A', 'N'){more}),
chk AS (SELECT value, regexp_full_match(value, '{_PATTERN_SQL}') AS shape, ({fits}) AS fits FROM lines)"""


def _malformed_sql() -> str:
    return _salted_sql() + """
SELECT value, CASE WHEN NOT shape THEN 'shape' ELSE 'int_range' END AS reason
FROM chk WHERE NOT shape OR NOT fits"""


def _oracles() -> dict[str, str]:
    post = f"WITH {_POSTINGS_SQL}"
    cols = ", ".join(POSTING_COLUMNS)
    o: dict[str, str] = {}
    o["parse_postings"] = f"{post} SELECT {cols} FROM p"
    o["text_scan"] = o["parse_postings"]
    o["malformed_lines"] = _malformed_sql()
    mark = "CASE WHEN o_orderstatus = 'F' THEN chr(133) ELSE chr(8232) END"
    more = f"""
  UNION ALL SELECT '2,7,,' || CAST(o_orderkey AS VARCHAR) || ',3' || {mark} FROM orders
  UNION ALL SELECT '1,' || CAST(o_orderkey AS VARCHAR) || ',,,0,a' || {mark} || 'b' FROM orders"""
    field = "string_split(rtrim(value, ','), ',')"
    ints = ", ".join(f"CAST(nullif({field}[{k + 1}], '') AS INTEGER) AS {c}"
                     for k, c in enumerate(POSTING_COLUMNS[:5]))
    o["parse_lenient"] = (f"{_salted_sql(more)} SELECT {ints}, "
                          f"CASE WHEN len({field}) >= 6 THEN {field}[6] END AS tags FROM chk WHERE shape AND fits")
    tags = _sql_list(STAR_TAGS)
    o["duplicate_questions"] = f"""{post},
dq AS (SELECT id, tags FROM q UNION ALL
       SELECT id, CASE WHEN id % 8 = 0 THEN 'unknown' ELSE {tags}[id % {len(STAR_TAGS)} + 1] END
       FROM q WHERE id % 2 = 0),
du AS (SELECT id, min(coalesce(list_position({tags}, tags), 0)) - 1 AS lang FROM dq GROUP BY id)
SELECT du.id, CAST(lang * {CFG_DUP.lang_spread} AS BIGINT) AS x,
       CAST(greatest(max(a.score), 0) AS INTEGER) AS high_score
FROM du JOIN a ON du.id = a.parent_id WHERE lang >= 0 GROUP BY du.id, lang"""
    o["duplicate_questions_unfused"] = o["duplicate_questions"]
    number = "CAST('0x' || substr(md5('0|' || CAST(id AS VARCHAR)), 1, 13) AS BIGINT)"
    times = " + ".join(f"CAST(h >= {t} AS INTEGER)" for t in poisson_thresholds(K3_FRACTION))
    sampled = f"""
sampled AS (SELECT id, tags, high_score FROM (
  SELECT id, tags, high_score, unnest(range({times})) FROM (SELECT *, {number} AS h FROM sc)))"""
    o["cluster_results_sampled"] = _with(_POSTINGS_SQL, sampled, _vec_sql(CFG, "sampled"), _seeds_sql(CFG), _kmeans_sql(
        CFG, CFG.max_iterations), _results_sql(CFG)) + " SELECT lang_label, lang_percent, cluster_size, median_score FROM res"
    o["sampled_scored"] = f"""{post}
SELECT id, tags, high_score FROM (
  SELECT id, tags, high_score, unnest(range({times})) FROM (SELECT *, {number} AS h FROM sc))"""
    o["questions"] = f"{post} SELECT {cols} FROM q"
    o["answers"] = f"{post} SELECT {cols} FROM a"
    o["qa_pairs_hot"] = f"""{post},
hot AS (SELECT id, score, CASE WHEN id % 3 = 0 THEN (SELECT min(id) FROM q) ELSE parent_id END AS parent_id FROM a)
SELECT q.id AS qid, q.tags, hot.id AS answer_id, hot.score AS answer_score FROM q JOIN hot ON q.id = hot.parent_id"""
    o["qa_pairs"] = (f"{post} SELECT q.id AS qid, q.tags, a.id AS answer_id, a.score AS answer_score "
                     f"FROM q JOIN a ON q.id = a.parent_id")
    o["grouped_postings"] = (
        f"{post} SELECT q.id AS qid, q.tags, CAST(count(*) AS BIGINT) AS n_pairs, "
        f"CAST(sum(a.score) AS BIGINT) AS score_sum, min(a.score) AS min_score, "
        f"max(a.score) AS max_score FROM q JOIN a ON q.id = a.parent_id GROUP BY q.id, q.tags")
    o["scored_postings"] = f"{post} SELECT * FROM sc"
    o["lang_index"] = (
        f"{post} SELECT id, posting_type, tags, "
        f"CAST(list_position({_sql_list(PARTIAL_TAGS)}, tags) - 1 AS INTEGER) AS lang_idx FROM p")
    o["vector_postings"] = (f"WITH {_POSTINGS_SQL},{_vec_sql(CFG)} "
                            f"SELECT id, CAST(x AS BIGINT) AS x, high_score FROM vec")
    o["vector_postings_drop"] = (f"WITH {_POSTINGS_SQL},{_vec_sql(CFG_DROP)} "
                                 f"SELECT id, CAST(x AS BIGINT) AS x, high_score FROM vec")
    o["scored_vectors"] = o["vector_postings"]
    o["scored_vectors_drop"] = o["vector_postings_drop"]
    o["weighted_points"] = f"WITH {_POSTINGS_SQL},{_vec_sql(CFG)} SELECT x, y, n FROM wp"
    o["stage_counts"] = f"""WITH {_POSTINGS_SQL},{_vec_sql(CFG)}
SELECT 'lines' AS stage, CAST(count(*) AS BIGINT) AS n FROM p
UNION ALL SELECT 'postings', CAST(count(*) AS BIGINT) FROM p
UNION ALL SELECT 'questions', CAST(count(*) AS BIGINT) FROM q
UNION ALL SELECT 'answers', CAST(count(*) AS BIGINT) FROM a
UNION ALL SELECT 'qa_pairs', CAST(count(*) AS BIGINT) FROM q JOIN a ON q.id = a.parent_id
UNION ALL SELECT 'scored', CAST(count(*) AS BIGINT) FROM sc
UNION ALL SELECT 'vectors', CAST(count(*) AS BIGINT) FROM vec
UNION ALL SELECT 'weighted_points', CAST(count(*) AS BIGINT) FROM wp"""
    o["sample_stratified"] = (f"WITH {_POSTINGS_SQL},{_vec_sql(CFG)},{_seeds_sql(CFG)} "
                              f"SELECT i, x, y FROM seeds")
    o["sample_global"] = (f"WITH {_POSTINGS_SQL},{_vec_sql(CFG_MIXED)},{_seeds_sql(CFG_MIXED)} "
                          f"SELECT i, x, y FROM seeds")
    d = _dist("p.x", "p.y", "c.x", "c.y")
    o["assign_closest"] = (
        f"WITH {_POSTINGS_SQL},{_vec_sql(CFG)},{_seeds_sql(CFG)} "
        f"SELECT p.x, p.y, p.n, CAST(min(struct_pack(d := {d}, i := c.i)).i AS INTEGER) AS i "
        f"FROM wp p, seeds c GROUP BY p.x, p.y, p.n")
    o["kmeans_step"] = (
        _with(_POSTINGS_SQL, _vec_sql(CFG), _seeds_sql(CFG), _kmeans_sql(CFG, 1))
        + " SELECT i, ox AS x, oy AS y, x AS new_x, y AS new_y, n, "
        + _dist("ox", "oy", "x", "y") + " AS distance FROM km WHERE u = 1")
    o["kmeans_means"] = _with(_POSTINGS_SQL, _vec_sql(CFG), _seeds_sql(CFG),
                              _kmeans_sql(CFG, CFG.max_iterations)) + " SELECT i, x, y FROM fin"
    o["kmeans_max_iter"] = _with(_POSTINGS_SQL, _vec_sql(CFG_MAX3), _seeds_sql(CFG_MAX3),
                                 _kmeans_sql(CFG_MAX3, CFG_MAX3.max_iterations)) + \
        " SELECT i, x, y FROM fin"
    o["kmeans_resume"] = _with(_POSTINGS_SQL, _vec_sql(CFG), _seeds_sql(CFG),
                               _kmeans_sql(CFG, CFG.max_iterations - RESUME_FROM + 1)) + \
        " SELECT i, x, y FROM fin"
    o["kmeans_trace"] = (
        _with(_POSTINGS_SQL, _vec_sql(CFG), _seeds_sql(CFG), _kmeans_sql(CFG, CFG.max_iterations))
        + " SELECT CAST(u AS INTEGER) AS iter, i, ox AS x, oy AS y, x AS new_x, y AS new_y, n, "
        + _dist("ox", "oy", "x", "y")
        + f" AS distance, dist AS total_distance, dist < {float(CFG.eta)} AS converged "
          "FROM km WHERE u >= 1")
    results = ("SELECT lang_label, lang_percent, cluster_size, median_score FROM res")
    o["cluster_results"] = _full(CFG) + " " + results
    o["cluster_results_lines"] = o["cluster_results"]
    o["cluster_results_mixed"] = _full(CFG_MIXED) + " " + results
    o["cluster_report"] = _full(CFG) + """,
hdr(pos, line) AS (VALUES (0, 'Resulting clusters:'),
                          (1, '  Score  Dominant language (%percent)  Questions'),
                          (2, '================================================'))
SELECT CAST(pos AS INTEGER) AS pos, line FROM hdr
UNION ALL
SELECT CAST(row_number() OVER (ORDER BY median_score, lang_idx, i) + 2 AS INTEGER) AS pos,
       printf('%7d  %-17s (%-5s%%)      %7d', median_score, lang_label,
              CAST(CAST(round(CAST(lang_percent AS DECIMAL(20, 8)), 1) AS DECIMAL(5, 1)) AS VARCHAR),
              cluster_size) AS line
FROM res"""
    return o


ORACLES: dict[str, str] = _oracles()
