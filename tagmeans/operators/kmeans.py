"""Integer-mean Lloyd k-means on a (weighted) point set.

Operators: nearest-center assignment (J2), one update step (I1 = J2 -> A4 ->
J3), movement between center lists (A9), convergence test (I2), the loop
(I3) and its per-iteration trace (I4).

Points are ``x, y`` with an optional multiplicity ``n``. Each update is one
Spark job: assign every point with a per-row argmin over the k centers
(a constant array in the plan), partially aggregate ``sum(x*n), sum(y*n),
sum(n)`` per cluster before the shuffle, and collect the k sums. Only the k
centers travel through the driver; the points stay where they are cached.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ClusterConfig
from ..functions.expressions import nearest_center, nearest_center_sql, squared_distance
from ..schema import CENTERS, TRACE
from .vectors import weighted_points

Centers = list[tuple[int, int]]


def _weight(points: DataFrame) -> F.Column:
    return F.col("n").cast("long") if "n" in points.columns else F.lit(1).cast("long")


def assign_closest(points: DataFrame, centers: Centers, x: str = "x", y: str = "y") -> DataFrame:
    """J2: add ``i int``, the index of the nearest center (ties -> lowest)."""
    return points.withColumn("i", nearest_center(centers, x, y).cast("int"))


def cluster_sums(points: DataFrame, centers: Centers) -> DataFrame:
    """Per non-empty cluster: ``i, sx, sy, n`` (sums weighted by multiplicity).

    Written as SQL text: the loop builds this plan once per update, and a
    handful of calls into the JVM keep that cheap next to the job itself.
    """
    w = "cast(n as bigint)" if "n" in points.columns else "1L"
    return (points.selectExpr(f"cast({nearest_center_sql(centers)} as int) AS i",
                              f"cast(x as bigint) * {w} AS wx",
                              f"cast(y as bigint) * {w} AS wy", f"{w} AS w")
            .groupBy("i")
            .agg(F.expr("sum(wx)").alias("sx"), F.expr("sum(wy)").alias("sy"),
                 F.expr("sum(w)").alias("n")))


def centers_frame(spark, centers: Centers) -> DataFrame:
    """The k centers as a DataFrame ``i int, x bigint, y bigint``."""
    return spark.createDataFrame([(i, int(x), int(y)) for i, (x, y) in enumerate(centers)],
                                 CENTERS)


def kmeans_step(points: DataFrame, centers: Centers) -> DataFrame:
    """I1 as a DataFrame: ``i, x, y, new_x, new_y, n, distance`` per center.

    ``new`` is the truncated integer mean of the cluster (A4), or the old
    center when the cluster is empty (J3); ``distance`` is the squared move.
    """
    spark = points.sparkSession
    sums = cluster_sums(points, centers)
    c = centers_frame(spark, centers)
    j = c.join(F.broadcast(sums), "i", "left")  # both sides hold at most k rows
    new_x = F.coalesce(F.expr("sx div n"), F.col("x"))
    new_y = F.coalesce(F.expr("sy div n"), F.col("y"))
    return j.select(
        "i", "x", "y", new_x.alias("new_x"), new_y.alias("new_y"),
        F.coalesce(F.col("n"), F.lit(0).cast("long")).alias("n"),
    ).withColumn("distance", squared_distance("x", "y", "new_x", "new_y"))


def _trunc_div(a: int, b: int) -> int:
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def update_centers(points: DataFrame, centers: Centers) -> tuple[Centers, list[int]]:
    """Run one update; return the new centers and the cluster sizes."""
    # At most k rows: one reduce task reads them all, however many shuffle
    # partitions the session uses.
    rows = cluster_sums(points, centers).coalesce(1).collect()
    sums = {r["i"]: (r["sx"], r["sy"], r["n"]) for r in rows}
    new: Centers = []
    sizes: list[int] = []
    for i, old in enumerate(centers):
        if i in sums:
            sx, sy, n = sums[i]
            new.append((_trunc_div(sx, n), _trunc_div(sy, n)))
            sizes.append(int(n))
        else:
            new.append(old)
            sizes.append(0)
    return new, sizes


def point_distance(a: tuple[int, int], b: tuple[int, int]) -> float:
    """P6 on the driver: squared distance of two points."""
    dx, dy = a[0] - b[0], a[1] - b[1]
    return float(dx) * float(dx) + float(dy) * float(dy)


def movement(old: Centers, new: Centers) -> float:
    """A9: sum of squared distances between two center lists of equal length."""
    if len(old) != len(new):
        raise ValueError(f"center lists differ in length: {len(old)} vs {len(new)}")
    total = 0.0
    for a, b in zip(old, new):
        total += point_distance(a, b)
    return total


def converged(distance: float, eta: float) -> bool:
    """I2: strictly below eta."""
    return distance < eta


@dataclass
class KMeansResult:
    centers: Centers
    updates: int
    converged: bool
    trace: list[tuple] = field(default_factory=list)

    def trace_frame(self, spark) -> DataFrame:
        """I4: ``iter, i, x, y, new_x, new_y, n, distance, total_distance,
        converged`` for every center of every update."""
        return spark.createDataFrame(self.trace, TRACE)

    def centers_frame(self, spark) -> DataFrame:
        return centers_frame(spark, self.centers)


def kmeans(points: DataFrame, centers: Centers, config: ClusterConfig,
           start_iter: int = 1) -> KMeansResult:
    """I3: update until the movement drops below ``eta`` or until update
    number ``max_iterations`` (counting from ``start_iter``) has run; at
    least one update always runs. Returns the centers of the last update.

    Every update re-reads ``points``, so it should be persisted (see
    ``plans.clustering.prepare_points``). Points without a multiplicity ``n``
    are reduced to distinct weighted points once, and kept until the loop ends.
    """
    if "n" not in points.columns:
        weighted = weighted_points(points, "y").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return kmeans(weighted, centers, config, start_iter)
        finally:
            weighted.unpersist()
    it = start_iter
    current = list(centers)
    trace: list[tuple] = []
    while True:
        new, sizes = update_centers(points, current)
        d = movement(current, new)
        done = converged(d, config.eta)
        for i, (a, b) in enumerate(zip(current, new)):
            trace.append((it, i, a[0], a[1], b[0], b[1], sizes[i],
                          point_distance(a, b), d, done))
        if done:
            return KMeansResult(new, it - start_iter + 1, True, trace)
        if it >= config.max_iterations:
            return KMeansResult(new, it - start_iter + 1, False, trace)
        current = new
        it += 1
