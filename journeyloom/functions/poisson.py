"""Poisson counts by hashed inversion, exact for any whole rate.

The sum of independent Poisson counts is Poisson with the summed rate, so a rate n is drawn as its binary digits (rates
2^0 to 2^15) and as many counts of rate 2^TOP as are left. Each count inverts the cumulative probabilities of its rate at
32 hashed bits. The probabilities are cut into CELLS equal cells of the bits: one row per (rate, cell) says how many
thresholds lie before the cell and which lie in it, so a draw is one lookup and a scan of a few numbers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

TOP = 16
CELLS = 4_096
_CELL_BITS = 20


def thresholds(rate: int) -> tuple[int, np.ndarray]:
    """(k, t): a 32-bit draw b counts k + (number of t <= b)."""
    spread = 9 * math.sqrt(rate) + 12
    low = max(0, math.floor(rate - spread))
    counts = range(low, math.ceil(rate + spread))
    chance = np.array([math.exp(j * math.log(rate) - rate - math.lgamma(j + 1)) for j in counts])
    steps = np.floor(np.cumsum(chance) * 2.0**32).astype(np.int64)
    return low, steps[steps < 2**32]


def poisson_cells(spark: SparkSession) -> DataFrame:
    """(level, cell, before, inside) for the rates 2^level up to 2^TOP; (TOP + 1) x CELLS rows whatever the data."""
    columns: dict[str, list] = {"level": [], "cell": [], "before": [], "inside": []}
    for level in range(TOP + 1):
        low, steps = thresholds(1 << level)
        cuts = np.searchsorted(steps, np.arange(CELLS + 1, dtype=np.int64) << _CELL_BITS)
        columns["level"].extend([level] * CELLS)
        columns["cell"].extend(range(CELLS))
        columns["before"].extend((low + cuts[:-1]).tolist())
        columns["inside"].extend(steps[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True))
    types = {"level": pa.int32(), "cell": pa.int32(), "before": pa.int64(), "inside": pa.list_(pa.int64())}
    return spark.createDataFrame(pa.table({c: pa.array(v, types[c]) for c, v in columns.items()}))


def rate_parts(n: Column) -> Column:
    """The rate ``n`` as an array of (level, piece): its binary digits below 2^TOP, and pieces of 2^TOP."""
    part = lambda level, piece: F.struct(level.cast("int").alias("level"), piece.cast("long").alias("piece"))
    digits = F.filter(F.sequence(F.lit(0), F.lit(TOP - 1)), lambda i: F.getbit(n, i) == 1)
    whole = F.floor(n / (1 << TOP)).cast("long")
    large = F.when(whole > 0, F.transform(F.sequence(F.lit(1).cast("long"), whole), lambda p: part(F.lit(TOP), p)))
    return F.concat(F.transform(digits, lambda i: part(i, F.lit(0))), F.coalesce(large, F.array().cast("array<struct<level:int,piece:bigint>>")))


def cell_of(bits: Column) -> Column:
    return F.shiftright(bits, _CELL_BITS).cast("int")


def count_at(bits: Column) -> Column:
    """The count of a draw joined with its row of ``poisson_cells``."""
    return F.col("before") + F.size(F.filter("inside", lambda t: t <= bits))
