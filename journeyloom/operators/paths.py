"""Paths by content: a key of fixed size for every path, its steps as chunked rows.

A path's key is its length and a 128-bit digest. The digest is the exclusive or of the md5 of (position, channel) over its
touches, so it is a partial aggregate: touches of one customer are combined where they are, in any order, and no task
holds a journey. Counting paths is grouping by key. The steps of a path are rows (key, chunk, steps) of at most ``chunk``
channels, taken from one representative customer. Keys and chunks have one form at every length.

``with_path_text`` puts the whole text of each distinct path into one row, for display.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from journeyloom.functions.journey_scope import CHUNK_TOUCHES, chunk_index, renumber
from journeyloom.functions.numeric import ranked_top
from journeyloom.operators.journeys import journey_states

SEPARATOR = " -> "
#: Steps of a path in one row.
CHUNK_STEPS = 1_000
KEY = ["path_length", "path_key"]
# Hexadecimal digits of the md5 that make up each word of the digest (a word fits a long).
_WORDS = [(1, 15), (16, 15), (31, 2)]


def _digest_words() -> list[Column]:
    digest = F.md5(F.concat_ws("|", F.col("touchpoint_number").cast("string"), F.col("channel")))
    return [F.bit_xor(F.conv(F.substring(digest, at, n), 16, 10).cast("long")).alias(f"_word{at}") for at, n in _WORDS]


def _key() -> Column:
    return F.concat(*[F.lpad(F.lower(F.hex(f"_word{at}")), n, "0") for at, n in _WORDS])


def journey_keys(touches: DataFrame, *extra: Column) -> DataFrame:
    """One row per journey: customer_id, path_length, path_key and further aggregates of its touches.

    Positions must be dense (``renumber`` makes them so for a subset of touches).
    """
    grouped = touches.groupBy("customer_id").agg(F.count(F.lit(1)).alias("path_length"), *_digest_words(), *extra)
    return grouped.withColumn("path_key", _key()).drop(*[f"_word{at}" for at, _ in _WORDS])


def path_steps(touches: DataFrame, keys: DataFrame, chunk: int = CHUNK_STEPS, separator: str = SEPARATOR) -> DataFrame:
    """(path_length, path_key, chunk, steps) of the paths in ``keys`` (``journey_keys``), chunks counted from 0.

    The steps come from the customer with the smallest id of each path. The join with the touches is on (customer,
    chunk), so a customer with many touches is many keys.
    """
    pieces = (
        keys.groupBy(*KEY)
        .agg(F.min("customer_id").alias("customer_id"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunk_index(F.col("path_length"), chunk))))
    )
    steps = touches.select("customer_id", "touchpoint_number", "channel", chunk_index(F.col("touchpoint_number"), chunk).alias("chunk"))
    ordered = F.array_sort(F.collect_list(F.struct("touchpoint_number", "channel")))
    return (
        steps.join(pieces, ["customer_id", "chunk"])
        .groupBy("customer_id", "chunk")
        .agg(*[F.first(c).alias(c) for c in KEY], F.array_join(ordered["channel"], separator).alias("steps"))
        .select(*KEY, "chunk", "steps")
    )


def with_path_text(table: DataFrame, steps: DataFrame, name: str = "path", separator: str = SEPARATOR) -> DataFrame:
    """Adds the whole text of each path: one row holds all of it, so this is for display."""
    parts = F.array_sort(F.collect_list(F.struct("chunk", "steps")))
    text = steps.groupBy(*KEY).agg(F.array_join(parts["steps"], separator).alias(name))
    return table.join(text, KEY)


def pattern_keys(touches: DataFrame) -> DataFrame:
    """Frequency and average revenue per path and outcome; the length of a path is its average length."""
    return _patterns(_outcomes(touches))


def _outcomes(touches: DataFrame) -> DataFrame:
    return journey_keys(touches, F.max("converted").alias("converted"), F.max("revenue").alias("revenue"))


def _patterns(journeys: DataFrame) -> DataFrame:
    return (
        journeys.groupBy(*KEY, "converted")
        .agg(F.count(F.lit(1)).alias("frequency"), F.avg("revenue").alias("avg_revenue"))
        .withColumn("avg_length", F.col("path_length").cast("double"))
    )


def path_patterns(touches: DataFrame) -> DataFrame:
    """J12 with the text of each path as ``journey_path``."""
    keys = _outcomes(touches)
    table = with_path_text(_patterns(keys), path_steps(touches, keys), "journey_path")
    return table.select("journey_path", "converted", "frequency", "avg_revenue", "avg_length", *KEY).orderBy(
        F.desc("frequency"), "journey_path", "converted"
    )


def conversion_touch_keys(touches: DataFrame, chunk: int = CHUNK_TOUCHES) -> DataFrame:
    """Paths made of converted touches only, by key."""
    return _counted(_converted(touches, chunk)[1], "conversions")


def _converted(touches: DataFrame, chunk: int) -> tuple[DataFrame, DataFrame]:
    converted = renumber(touches.filter(F.col("converted") == 1), chunk)
    return converted, journey_keys(converted, F.max("revenue").alias("revenue"))


def _counted(keys: DataFrame, name: str) -> DataFrame:
    return keys.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias(name), F.sum("revenue").alias("total_revenue"), F.avg("revenue").alias("avg_revenue")
    )


def conversion_touch_paths(touches: DataFrame, chunk: int = CHUNK_TOUCHES) -> DataFrame:
    """J13 with the text of each path."""
    converted, keys = _converted(touches, chunk)
    table = with_path_text(_counted(keys, "conversions"), path_steps(converted, keys))
    return table.select("path", "conversions", "total_revenue", "avg_revenue", *KEY).orderBy(F.desc("conversions"), "path")


def converting_keys(touches: DataFrame, n: int | None = 10, max_journeys: int | None = None) -> DataFrame:
    """Paths of converting customers by key, most frequent first, then shortest, then by digest.

    ``max_journeys`` restricts the report to the first customers by id, the display
    limit of the dashboard page; the default covers every journey.
    """
    return ranked_top(_counted(_converting(touches, max_journeys), "count"), n, F.desc("count"), *[F.asc(c) for c in KEY])


def _converting(touches: DataFrame, max_journeys: int | None) -> DataFrame:
    journeys = _outcomes(touches).filter(F.col("converted") == 1)
    return journeys if max_journeys is None else journeys.orderBy("customer_id").limit(max_journeys)


def converting_paths(touches: DataFrame, n: int | None = 10, max_journeys: int | None = None) -> DataFrame:
    """J14 with the text of each path, most frequent first, then by text."""
    keys = _converting(touches, max_journeys)
    table = with_path_text(_counted(keys, "count"), path_steps(touches, keys))
    return ranked_top(table.select("path", "count", "total_revenue", "avg_revenue", *KEY), n, F.desc("count"), F.asc("path"))


def sequence_chunks(touches: DataFrame, chunk: int = CHUNK_STEPS) -> DataFrame:
    """J4 as rows (customer_id, chunk, touches, states): start, channels in order and outcome, ``chunk`` states a row."""
    states = journey_states(touches).withColumn("chunk", chunk_index(F.col("step"), chunk))
    ordered = F.array_sort(F.collect_list(F.struct("step", "state")))
    return states.groupBy("customer_id", "chunk").agg(
        F.first("total_touchpoints").alias("touches"), ordered["state"].alias("states")
    )


def journey_sequences(touches: DataFrame) -> DataFrame:
    """J4 as one array per journey, for display: one row holds all of it."""
    parts = F.array_sort(F.collect_list(F.struct("chunk", "states")))
    return sequence_chunks(touches).groupBy("customer_id").agg(F.first("touches").alias("touches"), F.flatten(parts["states"]).alias("sequence"))
