"""Joins with channel-sized tables whose size is checked before they are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from journeyloom.session import checkpointed

BROADCAST_ROWS = 100_000
_SALTS = 64


def freeze(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Evaluate a small table once; larger than ``limit`` rows it stays a plan.

    The result of fitting a model is one row per channel and is used by several later
    steps. Reading at most ``limit`` + 1 rows both fixes it and proves its size.
    """
    rows = df.limit(limit + 1).toArrow()
    if rows.num_rows > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows))


def pin(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Evaluate a reduced table once, whatever its size: a local table or a checkpoint."""
    rows = df.limit(limit + 1).toArrow()
    if rows.num_rows > limit:
        return checkpointed(df)
    return df.sparkSession.createDataFrame(rows)


def join_dimension(
    touches: DataFrame, values: DataFrame, key: str = "channel", how: str = "left", limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Join touches with a table keyed by ``key``.

    Up to ``limit`` rows the table is broadcast. Beyond that both sides are salted, so
    that a key holding a large share of the touches is spread over many tasks.
    """
    fixed = freeze(values, limit)
    if fixed is not values:
        return touches.join(fixed, key, how)
    salts = F.sequence(F.lit(0), F.lit(_SALTS - 1))
    copies = values.withColumn("_salt", F.explode(salts))
    spread = F.pmod(F.xxhash64("customer_id", "touchpoint_number"), F.lit(_SALTS)).cast("int")
    return touches.withColumn("_salt", spread).join(copies, [key, "_salt"], how).drop("_salt")


def channels_of(touches: DataFrame, limit: int = BROADCAST_ROWS) -> list[str]:
    """The distinct channels in order (one job over one column)."""
    found = touches.select("channel").where(F.col("channel").isNotNull()).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} channels: group rare ones before modelling")
    return sorted(r[0] for r in found)
