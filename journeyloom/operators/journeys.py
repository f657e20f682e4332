"""Journey construction: enrichment, states, feature rows (J1-J11, J15); paths are in ``paths``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from journeyloom.functions.journey_scope import (
    CHUNK_TOUCHES,
    renumber,
    with_journey_totals,
    with_neighbours,
)
from journeyloom.schema import CONVERSION, NULL, START


def enrich_touches(touches: DataFrame, chunk: int = CHUNK_TOUCHES) -> DataFrame:
    """Previous and next channel, seconds since the previous touch, end flags."""
    near = with_neighbours(
        renumber(touches, chunk),
        {"prev_channel": ("channel", -1), "next_channel": ("channel", 1), "_prev_time": ("timestamp", -1)},
        chunk=chunk,
    )
    elapsed = F.unix_timestamp("timestamp") - F.unix_timestamp("_prev_time")
    return near.withColumns(
        {
            "time_since_prev": F.coalesce(elapsed, F.lit(0)),
            "is_first_touch": F.col("touchpoint_number") == 1,
            "is_last_touch": F.col("touchpoint_number") == F.col("total_touchpoints"),
        }
    ).drop("_prev_time")


def journey_states(touches: DataFrame, chunk: int = CHUNK_TOUCHES) -> DataFrame:
    """J4 in long form: one row per (customer_id, step, state), any journey length.

    Step 1 is the start state, steps 2..n+1 the channels, step n+2 the outcome.
    """
    ended = with_journey_totals(renumber(touches, chunk), {"_converted": F.max("converted")}, chunk)
    p, n = F.col("touchpoint_number"), F.col("total_touchpoints")
    outcome = F.when(F.col("_converted") == 1, CONVERSION).otherwise(NULL)

    def step(number: Column, state: Column) -> Column:
        return F.struct(number.cast("long").alias("step"), state.alias("state"))

    here = step(p + 1, F.col("channel"))
    begin, end = step(F.lit(1), F.lit(START)), step(n + 2, outcome)
    steps = (
        F.when((p == 1) & (p == n), F.array(begin, here, end))
        .when(p == 1, F.array(begin, here))
        .when(p == n, F.array(here, end))
        .otherwise(F.array(here))
    )
    return ended.select("customer_id", "total_touchpoints", F.explode(steps).alias("s")).select(
        "customer_id", "s.step", "s.state", "total_touchpoints"
    )


def journey_features(touches: DataFrame, channels: list[str]) -> DataFrame:
    """The feature row of the Python models; revenue is the sum over touches."""
    counts = [F.sum(F.when(F.col("channel") == c, 1).otherwise(0)).alias(f"channel_{c}_count") for c in channels]
    seconds = F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))
    return touches.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("journey_length"),
        F.sum("cost").alias("total_cost"),
        F.sum("time_on_site").alias("total_time_on_site"),
        F.sum("pages_viewed").alias("total_pages_viewed"),
        F.size(F.collect_set("channel")).alias("unique_channels"),
        F.size(F.collect_set("device")).alias("unique_devices"),
        F.max("converted").alias("converted"),
        F.sum("revenue").alias("revenue"),
        (seconds / 1e6 / 3600).alias("journey_duration_hours"),
        *counts,
        F.min_by("channel", "touchpoint_number").alias("first_channel"),
        F.max_by("channel", "touchpoint_number").alias("last_channel"),
        F.sum(F.when(F.col("device") == "mobile", 1).otherwise(0)).alias("mobile_touches"),
        F.sum(F.when(F.col("device") == "desktop", 1).otherwise(0)).alias("desktop_touches"),
    )


# The channels the batch model counts by name.
COUNTED_CHANNELS = ["paid_search", "organic_search", "social_media", "email", "direct", "display"]


def conversion_features(touches: DataFrame) -> DataFrame:
    """The feature row of the batch conversion model."""
    named = [F.sum(F.when(F.col("channel") == c, 1).otherwise(0)).alias(f"{c}_touches") for c in COUNTED_CHANNELS]
    devices = [
        F.sum(F.when(F.col("device") == d, 1).otherwise(0)).alias(f"{d}_touches") for d in ("mobile", "desktop")
    ]
    return touches.groupBy("customer_id").agg(
        F.max("converted").alias("label"),
        F.count(F.lit(1)).alias("journey_length"),
        F.size(F.collect_set("channel")).alias("unique_channels"),
        F.size(F.collect_set("device")).alias("unique_devices"),
        F.sum("cost").alias("total_cost"),
        F.sum("time_on_site").alias("total_time_on_site"),
        F.sum("pages_viewed").alias("total_pages_viewed"),
        F.avg("time_on_site").alias("avg_time_on_site"),
        *named,
        *devices,
    )


def journey_stats(touches: DataFrame) -> DataFrame:
    """Last position, distinct channels and devices, converted."""
    return touches.groupBy("customer_id").agg(
        F.max("touchpoint_number").alias("journey_length"),
        F.size(F.collect_set("channel")).alias("unique_channels"),
        F.size(F.collect_set("device")).alias("unique_devices"),
        F.max("converted").alias("converted"),
    )


def length_histogram(touches: DataFrame, bins: int = 20) -> DataFrame:
    """Journeys per equal-width bin between the shortest and the longest."""
    lengths = touches.groupBy("customer_id").agg(F.max("touchpoint_number").alias("length"))
    by_length = lengths.groupBy("length").agg(F.count(F.lit(1)).alias("journeys"))
    ends = by_length.agg(F.min("length").alias("low"), F.max("length").alias("high"))
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    # the top edge belongs to the last bin; equal lengths all fall into the first
    bin_number = F.when(
        F.col("high") > F.col("low"),
        F.least(F.floor((F.col("length") - F.col("low")) / width) + 1, F.lit(bins)),
    ).otherwise(1)
    return (
        by_length.join(F.broadcast(ends), F.col("length").between(F.col("low"), F.col("high")))
        .groupBy(bin_number.cast("int").alias("bin"))
        .agg(
            F.min(F.col("low") + (bin_number - 1) * width).alias("bin_start"),
            F.sum("journeys").alias("journeys"),
        )
    )


def channel_quartiles(touches: DataFrame) -> DataFrame:
    """Quartiles of distinct channels per journey, by conversion status."""
    counts = (
        journey_stats(touches).groupBy("converted", "unique_channels").agg(F.count(F.lit(1)).alias("journeys"))
    )
    quartiles = F.percentile("unique_channels", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("journeys"))
    return (
        counts.groupBy("converted")
        .agg(
            quartiles.alias("q"),
            F.min("unique_channels").alias("min"),
            F.max("unique_channels").alias("max"),
        )
        .select(
            "converted",
            "min",
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
            "max",
        )
    )


def calendar_features(touches: DataFrame) -> DataFrame:
    """Hour, weekday (Monday = 0 and Sunday = 1 numbering), month, quarter."""
    return touches.withColumns(
        {
            "hour_of_day": F.hour("timestamp"),
            "day_of_week": F.weekday("timestamp"),
            "day_of_week_sunday1": F.dayofweek("timestamp"),
            "month": F.month("timestamp"),
            "quarter": F.quarter("timestamp"),
        }
    )


def with_journey_length(touches: DataFrame, chunk: int = CHUNK_TOUCHES) -> DataFrame:
    """Journey length on every touch."""
    return with_journey_totals(touches, {"journey_length": F.max("touchpoint_number")}, chunk)


def sample_converting_journey(ga: DataFrame) -> DataFrame:
    """All sessions of the visitor with the earliest conversion."""
    key = F.struct("date", "visitStartTime", "visitNumber", "fullVisitorId")
    visitor = ga.filter(F.col("transactions") > 0).agg(F.min_by("fullVisitorId", key).alias("fullVisitorId"))
    return ga.join(F.broadcast(visitor), "fullVisitorId", "left_semi").select(
        "fullVisitorId", "visitNumber", "date", "channel", "transactions", "revenue"
    )
