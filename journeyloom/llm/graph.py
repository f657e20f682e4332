"""Connected components of an edge table by alternating star contractions, and helpers for bounded broadcasts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from journeyloom.session import fresh_path

PART_EDGES = 250_000
#: A key list is broadcast up to this many rows (8 bytes each); beyond it the join shuffles.
BROADCAST_KEYS = 500_000


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends there and a lost executor costs nothing."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_keys(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in ``keys`` (a stored one-column table); broadcast only if it is small."""
    if keys.count() <= BROADCAST_KEYS:
        return df.join(F.broadcast(keys), column, "left_semi")
    return df.join(keys, column, "left_semi")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces a partition's edges by (member, smallest member) of its own components."""
    parts = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches]
    if not parts:
        return
    a, b = (np.concatenate(c) for c in zip(*parts, strict=True))
    names, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(names))
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        for side in (left, right):
            np.minimum.at(label, side, low)
            np.minimum.at(label, before[side], low)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(names)))
    yield pa.record_batch([pa.array(names[moved]), pa.array(names[label[moved]])], ["a", "b"])


def components(edges: DataFrame, part_edges: int = PART_EDGES) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b: long), component being the smallest node.

    Parts of at most about ``part_edges`` edges are first contracted by themselves, which finishes a small table. Then stars
    are contracted in turn: every node hands its larger neighbours to its smallest one, then its smaller ones.
    The edge table never grows, no neighbourhood is gathered in one place, and each round is stored.
    """
    given = stored(edges.where("a <> b").select("a", "b"), "edges")
    parts = -(-given.count() // part_edges)
    now = stored(given.repartition(max(1, parts)).mapInArrow(_forest, "a long, b long"), "forest")
    seen = None
    if parts <= 1:
        return _members(now)
    while True:
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(low, "a")
            .select(F.col("b").alias("x"), "m", F.col("a").alias("u"))
            .select(F.explode(F.array(F.struct("x", "m"), F.struct(F.col("u").alias("x"), "m"))).alias("e"))
            .select(F.col("e.x").alias("a"), F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        now = stored(small, "edges")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    return _members(now)


def _members(stars: DataFrame) -> DataFrame:
    """(node, component) of stars (member, centre)."""
    ends = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionByName(ends.select(F.col("component").alias("node"), "component").distinct())
