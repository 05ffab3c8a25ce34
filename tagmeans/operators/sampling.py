"""Seed draws: stratified exact-k (K1), global exact-k (K2), Poisson rows (K3).

Draws are deterministic: every point gets the key
``md5(seed|x|id)`` (stratified) or ``md5(seed|id)`` (global) and the
smallest keys win, the id breaking ties. The per-language top-k is a
``row_number`` window with a ``<=`` filter, which Spark plans as a
WindowGroupLimit: each map task keeps only ``per_lang`` rows per language
before the shuffle, so a language holding a third of all points never has
to be gathered in one task. The global draw is a TakeOrderedAndProject
(k rows per task). Only the k seeds ever reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ClusterConfig


def _draw_key(seed: int, *cols: str) -> F.Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def sample_stratified(vectors: DataFrame, config: ClusterConfig) -> DataFrame:
    """K1: exactly ``per_lang`` points of every language.

    Output: ``i int, x bigint, y bigint``; ``i = lang_idx * per_lang + rank``,
    so the seeds are ordered by language, then by draw key.
    """
    per_lang = config.per_lang
    keyed = vectors.select("id", "x", F.col("high_score").cast("long").alias("y"),
                           _draw_key(config.seed, "x", "id").alias("h"))
    w = Window.partitionBy("x").orderBy("h", "id")
    drawn = keyed.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= per_lang)
    lang = (F.col("x") / F.lit(config.lang_spread)).cast("long")
    return drawn.select(
        (lang * per_lang + F.col("rn") - 1).cast("int").alias("i"),
        F.col("x").cast("long").alias("x"), "y")


def sample_global(vectors: DataFrame, config: ClusterConfig) -> DataFrame:
    """K2: ``kernels`` points without replacement, ignoring the language.

    Output: ``i int, x bigint, y bigint`` with ``i`` the draw order.
    """
    k = config.kernels
    top = (vectors.select("id", F.col("x").cast("long").alias("x"),
                          F.col("high_score").cast("long").alias("y"),
                          _draw_key(config.seed, "id").alias("h"))
           .orderBy("h", "id").limit(k))
    # k rows at most: the window runs on the single TakeOrderedAndProject output.
    return top.select((F.row_number().over(Window.orderBy("h", "id")) - 1).cast("int").alias("i"),
                      "x", "y")


def sample_vectors(vectors: DataFrame, config: ClusterConfig) -> DataFrame:
    """Stratified draw when ``lang_spread >= 500``, global draw below."""
    if config.stratified:
        return sample_stratified(vectors, config)
    return sample_global(vectors, config)


def draw_centers(vectors: DataFrame, config: ClusterConfig) -> list[tuple[int, int]]:
    """Run the seed draw and return the centers ordered by ``i`` (W2 checks).

    Fails when a language has fewer points than ``per_lang``, when a language
    is absent, or when fewer than ``kernels`` points exist.
    """
    rows = sample_vectors(vectors, config).orderBy("i").collect()  # <= kernels rows
    if config.stratified:
        per_x: dict[int, int] = {}
        for r in rows:
            per_x[r["x"]] = per_x.get(r["x"], 0) + 1
        short = {x: c for x, c in per_x.items() if c < config.per_lang}
        if short:
            raise ValueError(
                f"languages with fewer than {config.per_lang} points: "
                + ", ".join(f"x={x} ({c})" for x, c in sorted(short.items())))
    if len(rows) != config.kernels:
        raise ValueError(f"drew {len(rows)} seeds, expected {config.kernels}")
    return [(int(r["x"]), int(r["y"])) for r in rows]


# Bits of a draw key that the row sample compares.
_SAMPLE_BITS = 52


def poisson_thresholds(rate: float, bits: int = _SAMPLE_BITS) -> list[int]:
    """``ceil(2^bits * P(Poisson(rate) <= k))`` for k = 0, 1, ... until the
    distribution fills all ``bits``; a key reaching k of them is drawn k times."""
    out, k, p, total = [], 0, math.exp(-rate), 0.0
    while True:
        total += p
        t = min(1 << bits, math.ceil(total * (1 << bits)))
        if t >= 1 << bits or out and t == out[-1]:
            return out
        out.append(t)
        k += 1
        p *= rate / k


def sample_rows(df: DataFrame, fraction: float = 0.001, seed: int = 0,
                with_replacement: bool = True, key: tuple[str, ...] = ("id",)) -> DataFrame:
    """K3: Poisson (with replacement) or Bernoulli row sample.

    What is drawn depends on ``md5(seed|key)`` only, so it is the same on any
    partitioning, cluster and retry; rows with equal keys are drawn alike.
    """
    number = F.conv(F.substring(_draw_key(seed, *key), 1, _SAMPLE_BITS // 4), 16, 10).cast("long")
    if not with_replacement:
        return df.where(number < F.lit(math.ceil(fraction * (1 << _SAMPLE_BITS))))
    # Drawn by the generator, without a filter: Catalyst would push that below an aggregate by ``key``, to each
    # of its input rows, and there repeat what makes the key for every threshold.
    cols = [F.col(f"`{c}`") for c in df.columns]
    keyed = df.select(*cols, number.alias("_draw"))
    times = sum((F.when(F.col("_draw") >= F.lit(t).cast("long"), 1).otherwise(0) for t in poisson_thresholds(fraction)), F.lit(0))
    return keyed.select(*cols, F.explode(F.array_repeat(F.lit(1), times)).alias("_nth")).drop("_nth")
