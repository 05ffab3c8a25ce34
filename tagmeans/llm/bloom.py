"""Bloom filters of fixed size over 64-bit hashes, built by Spark, used in tasks.

They only save work: who uses one counts exactly afterwards."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 64-bit words of a filter (16 MB), whatever the input.
WORDS = 1 << 21


def bloom(keys: DataFrame, name: str) -> np.ndarray:
    """The filter of a column of 64-bit hashes: two bits in one word for each.

    At most ``WORDS`` rows reach the driver."""
    word = F.col(name).bitwiseAND(F.lit(WORDS - 1).cast("long")).alias("word")
    bit = lambda s: f"shiftleft(1L, cast(shiftright(`{name}`, {s}) & 63 as int))"
    rows = (keys.select(word, F.expr(f"{bit(24)} | {bit(32)}").alias("bits"))
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(WORDS, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out


def maybe_in(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False for keys that certainly aren't in the filter."""
    one = np.int64(1)
    bits = (one << ((keys >> 24) & 63)) | (one << ((keys >> 32) & 63))
    return (filter_[keys & (WORDS - 1)] & bits) == bits
