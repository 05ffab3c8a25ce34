"""Largest inner products by a forest of hash prefixes.

Each of ``TREES`` trees gives a vector a string of ``BITS`` sign bits of random
projections and keeps all strings in a sorted array. A query descends each array
to its longest common prefix; from there all trees ascend together, a bit at a
time, and the longest prefix with enough candidates in all trees counts. These
candidates are compared by their exact inner product in double precision.

Vectors are lifted to one length first (one more coordinate), so the largest
inner product is the smallest angle. How many candidates are enough is fitted: on
``SAMPLE`` vectors, whose true neighbours are found by comparing them with all
rows, the longest prefix is sought that still finds ``RECALL`` of them.

An array is dealt by its strings' first bits, and a large part further by hash, so
no task holds more than some ``PART`` rows. Only ids and strings go to the trees' parts: there a
query learns how many candidates each prefix has and, once all trees have agreed on its length,
at which homes they are. A vector's home is its part of the first tree; each vector is sent
there once, each query to the homes of its candidates, where every candidate meets it once,
whichever trees name it. A query whose first bits have too few candidates is compared with all rows.
Vectors travel in the numbers they are given in (4 or 8 bytes).

Defined results: vectors that are null, zero or hold null or non-finite numbers,
and those of another dimension than most, take no part, nor do null ids; rows that
repeat id and vector count once; equal vectors are searched once, each of their ids
is found; ties go to the smaller id; with fewer candidates than asked for, all of
them; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, table

TREES, BITS, SEED = 20, 24, 11
SAMPLE, RECALL, SLACK = 64, 0.96, 0.75
PART = 50_000
NEAREST, EVERY = 20, 20


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(id, v) of the vectors that take part, ``v`` as array<float> or array<double>."""
    kind = vectors.schema[embedding].dataType.elementType
    v = F.col(embedding) if isinstance(kind, T.FloatType) else F.col(embedding).cast("array<double>")
    good = (vectors.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
            .where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
            .where(F.exists("v", lambda x: x != 0)).distinct())
    sizes = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return good.where(F.size("v") == (sizes.d if sizes else 0))


class Forest:
    """The projections: they depend on the dimension and the largest length only."""

    def __init__(self, dimension: int, longest: float, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        self.planes = np.random.default_rng(seed).normal(size=(dimension + 1, trees * bits))
        self.longest, self.trees, self.bits = longest, trees, bits

    def codes(self, v: np.ndarray, query: bool = False) -> np.ndarray:
        """Each tree's hash string as a number, first bit highest. Queries aren't lifted."""
        more = np.zeros(len(v)) if query else np.sqrt(np.maximum(0, self.longest ** 2 - (v ** 2).sum(axis=1)))
        signs = (np.c_[v, more] @ self.planes > 0).reshape(len(v), self.trees, self.bits)
        return (signs << np.arange(self.bits)[::-1]).sum(axis=2)


def _matrix(column, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1).astype("<f8")


def _hashed(distinct: DataFrame, forest: Forest, query: bool, kind: str) -> DataFrame:
    """(id, vector binary, codes array<int>)."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v = np.array(batch.column(1).to_pylist(), kind)
                codes = forest.codes(v.astype("<f8"), query).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([x.tobytes() for x in v], pa.binary()),
                     pa.array(codes.tolist(), pa.list_(pa.int32()))], names=["id", "vector", "codes"])

    return distinct.select("id", "v").mapInArrow(run, "id long, vector binary, codes array<int>")


def _fit(points: DataFrame, queries: DataFrame, forest: Forest, nearest: int, kind: str) -> tuple[int, float]:
    """(prefix length, candidates in all trees) that find ``RECALL`` of a sample's neighbours."""
    sample = queries.orderBy(F.xxhash64("id")).limit(SAMPLE).collect()
    q, q_codes = _matrix([r.vector for r in sample], kind), np.array([r.codes for r in sample])
    ids = np.array([r.id for r in sample])
    trees, bits = forest.trees, forest.bits

    def common(a, b):
        """Length of the longest prefix that two codes share."""
        return bits - np.frexp((a ^ b).astype(float))[1]

    def run(batches):
        best = pd.DataFrame({"q": [], "score": [], "prefix": []})
        sizes = np.zeros((len(q), bits + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v, codes = _matrix(batch.column(1).to_pylist(), kind), np.array(batch.column(2).to_pylist())
            scores = q @ v.T
            own = batch.column(0).to_numpy()
            for i in range(len(q)):
                share = common(codes, q_codes[i])
                sizes[i] += np.bincount(share.ravel(), minlength=bits + 1)
                scores[i][own == ids[i]] = -np.inf
                top = np.argsort(-scores[i], kind="stable")[:nearest]
                best = pd.concat([best, pd.DataFrame({"q": i, "score": scores[i][top],
                                                      "prefix": share[top].max(axis=1)})])
            best = best.sort_values("score", ascending=False).groupby("q").head(nearest)
        at_least = sizes[:, ::-1].cumsum(axis=1)[:, ::-1]
        rows = best.assign(level=-1, n=0)
        more = pd.DataFrame({"q": np.repeat(np.arange(len(q)), bits + 1), "score": 0.0, "prefix": 0,
                             "level": np.tile(np.arange(bits + 1), len(q)), "n": at_least.ravel()})
        yield pa.RecordBatch.from_pandas(pd.concat([rows, more]).astype(
            {"q": "int32", "score": "float64", "prefix": "int32", "level": "int32", "n": "int64"}), preserve_index=False)

    found = keep(points.mapInArrow(run, "q int, score double, prefix int, level int, n long"))
    nth = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    prefixes = np.array([r.prefix for r in found.where("level < 0 and score > -1e300").withColumn("nth", nth)
                         .where(F.col("nth") <= nearest).select("prefix").collect()])
    means = dict(found.where("level >= 0").groupBy("level").agg((F.sum("n") / len(sample)).alias("n")).collect())
    if not len(prefixes):
        return 0, float("inf")
    level = max(x for x in range(bits + 1) if (prefixes >= x).mean() >= RECALL)
    return level, means[level]


def search(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", nearest: int = NEAREST,
           queries=None, part: int = PART) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``nearest`` rows found for each query, best first.

    ``queries`` is a condition on ``id``; without it all rows are queries."""
    rows = keep(usable(vectors, vec_id, embedding))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    one = rows.select(F.max(F.size("v")).alias("d"), F.max(F.sqrt(square)).alias("m")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if one.d is None:
        return rows.sparkSession.createDataFrame([], schema)
    forest = Forest(one.d, one.m)
    kind = "<f4" if rows.schema["v"].dataType.elementType == T.FloatType() else "<f8"
    # equal vectors are one point; of its ids no more can be among the nearest than these
    alike = Window.partitionBy("v")
    named = (rows.withColumn("nth", F.row_number().over(alike.orderBy("id"))).withColumn("point", F.min("id").over(alike))
             .select("id", "point", "nth", F.when(F.col("nth") == 1, F.col("v")).alias("v")))
    named = keep(named.withColumn("asked", F.lit(True) if queries is None else queries))
    q_ids = named.where("asked").select("id", "point")
    points = keep(_hashed(named.where("nth = 1"), forest, False, kind))
    wanted = named.where("nth = 1").join(q_ids.select("point").distinct(), "point", "left_semi")
    asking = keep(_hashed(wanted, forest, True, kind))
    named = named.where(F.col("nth") <= nearest + 1)
    if asking.isEmpty():
        return rows.sparkSession.createDataFrame([], schema)

    level, mean = _fit(points, asking, forest, nearest, kind)
    enough = max(SLACK * mean, 4 * nearest * forest.trees)
    first = max(0, min(level - 1, 12))  # bits that deal an array to parts
    trees, bits = forest.trees, forest.bits

    def strings(df, *columns):
        """One row for each tree: its number, hash string and first bits."""
        return (df.select(*columns, F.posexplode("codes").alias("tree", "code"))
                .withColumn("seg", F.shiftright("code", bits - first)))

    # trees * 2 ** first rows at most
    parts = keep(strings(points).groupBy("tree", "seg").agg(F.ceil(F.count("*") / part).cast("int").alias("parts")))
    small = F.broadcast(parts)

    def dealt(df):
        return df.join(small, ["tree", "seg"]).withColumn(
            "part", F.pmod(F.xxhash64("id", "tree"), F.col("parts")).cast("int")).drop("parts")

    def sent(df):
        return df.join(small, ["tree", "seg"]).withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    keys = ["tree", "seg", "part"]

    def ranges(codes, query, x):
        low = (query >> (bits - x)) << (bits - x)
        return np.searchsorted(codes, low), np.searchsorted(codes, low + (1 << (bits - x)))

    def descend(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        codes, q = np.sort(left["code"].to_numpy(np.int64)), right["code"].to_numpy(np.int64)
        n = []
        for x in range(first, bits + 1):
            a, b = ranges(codes, q, x)
            n.append(b - a)
        return pd.DataFrame({"id": right["id"], "n": pd.Series(
            list(np.array(n, np.int64).T), index=right.index, dtype=object)})

    met = (dealt(strings(points, "id")).select("id", "code", *keys).groupBy(*keys)
           .cogroup(sent(strings(asking, "id")).select("id", "code", *keys).groupBy(*keys))
           .applyInPandas(descend, "id long, n array<long>"))
    sums = met.groupBy("id").agg(F.array(*[F.sum(F.element_at("n", i + 1)) for i in range(bits - first + 1)]).alias("n"))
    # all trees ascend until they have enough; -1: not even the first bits have
    long_ = F.coalesce(F.array_max(F.filter(F.transform("n", lambda n, i: F.when(n >= enough, i)),
                                            lambda i: i.isNotNull())) + first, F.lit(-1))
    levels = keep(asking.join(sums, "id", "left").withColumn("level", F.coalesce(long_, F.lit(-1)).cast("int"))
                  .drop("n"))
    # the first tree's parts are the vectors' homes
    home = lambda seg, n: F.shiftleft(seg.cast("long"), 32) + n
    first_tree = F.broadcast(parts.where("tree = 0").select("seg", "parts"))
    homed = (points.withColumn("seg", F.shiftright(F.element_at("codes", 1), bits - first)).join(first_tree, "seg")
             .withColumn("home", home(F.col("seg"), F.pmod(F.xxhash64("id", F.lit(0)), F.col("parts"))))
             .select("id", "vector", "codes", "home"))

    def visit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"id": [], "home": []})]
        if len(left) and len(right):
            order = np.argsort(left["code"].to_numpy(), kind="stable")
            codes, homes = left["code"].to_numpy(np.int64)[order], left["home"].to_numpy()[order]
            a, b = ranges(codes, right["code"].to_numpy(np.int64), right["level"].to_numpy(np.int64))
            ids = right["id"].to_numpy()
            by = np.argsort(homes, kind="stable")
            own, begin = np.unique(homes[by], return_index=True)
            for h, at in zip(own, np.split(by, begin[1:])):
                met = np.searchsorted(at, a) < np.searchsorted(at, b)
                out.append(pd.DataFrame({"id": ids[met], "home": h}))
        return pd.concat(out).astype({"id": "int64", "home": "int64"})

    near = (dealt(strings(homed, "id", "home")).select("home", "code", *keys).groupBy(*keys)
            .cogroup(sent(strings(levels.where("level >= 0"), "id", "level")).select("id", "code", "level", *keys).groupBy(*keys))
            .applyInPandas(visit, "id long, home long").distinct())
    # without enough candidates: all homes, 2 ** first and what large ones are parted to
    whole = F.array(*[F.struct(F.lit(r.seg).alias("seg"), F.lit(r.parts).alias("parts"))
                      for r in parts.where("tree = 0").collect()])
    far = (levels.where("level < 0").select("id", F.inline(whole)).select("id", "seg", F.explode(
        F.sequence(F.lit(0), F.col("parts") - 1)).alias("nth")).select("id", home(F.col("seg"), F.col("nth")).alias("home")))
    visits = near.unionByName(far).join(levels.select("id", "vector", "codes", "level"), "id")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"id": [], "point": [], "score": []})]
        if len(left) and len(right):
            v, own, codes = _matrix(left["vector"], kind), left["id"].to_numpy(), np.array(left["codes"].tolist(), np.int64)
            order = np.argsort(codes, axis=0, kind="stable")
            q, q_codes = _matrix(right["vector"], kind), np.array(right["codes"].tolist(), np.int64)
            x = right["level"].to_numpy(np.int64)
            begin, end = (np.array(z) for z in zip(*[
                ranges(codes[order[:, t], t], q_codes[:, t], np.maximum(x, 0)) for t in range(trees)]))
            for i, name in enumerate(right["id"]):
                met = np.ones(len(v), bool)
                if x[i] >= 0:
                    met[:] = False
                    for t in range(trees):
                        met[order[begin[t, i]:end[t, i], t]] = True
                at = np.flatnonzero(met)
                score = v[at] @ q[i]
                best = np.lexsort((own[at], -score))[:nearest + 1]
                out.append(pd.DataFrame({"id": name, "point": own[at][best], "score": score[best]}))
        return pd.concat(out).astype({"id": "int64", "point": "int64", "score": "float64"})

    found = (homed.groupBy("home").cogroup(visits.select("home", "id", "vector", "codes", "level").groupBy("home"))
             .applyInPandas(compare, "id long, point long, score double"))
    best = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "point"))
    few = keep(found.withColumn("nth", best).where(F.col("nth") <= nearest + 1).drop("nth"))
    out = (q_ids.select(F.col("id").alias("query_id"), F.col("point").alias("id"))
           .join(few, "id").join(named.select("point", F.col("id").alias("vec_id")), "point")
           .where("query_id <> vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (out.withColumn("rank", rank).where(F.col("rank") <= nearest)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def query(spark, sf_dir):
    """Every row whose id is divisible by 20 against all rows."""
    return search(table(spark, sf_dir, "embeddings"), queries=F.col("id") % EVERY == 0)
