"""Markov-chain attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from journeyloom.functions.dimensions import freeze, join_dimension
from journeyloom.functions.journey_scope import (
    CHUNK_TOUCHES,
    renumber,
    with_journey_totals,
    with_neighbours,
)
from journeyloom.functions.numeric import ranked_top, ratio, roi, total
from journeyloom.operators.journeys import journey_states


def transitions(touches: DataFrame, order: int = 1, chunk: int = CHUNK_TOUCHES) -> DataFrame:
    """M1, M2: transition counts and row-normalised probabilities.

    ``from_state`` is a string at order 1 and an array of ``order`` states above;
    sequences shorter than order + 1 contribute nothing.
    """
    ahead = {f"_s{i}": ("state", i) for i in range(1, order + 1)}
    states = journey_states(touches, chunk).withColumn("_steps", F.col("total_touchpoints") + 2)
    moved = with_neighbours(states, ahead, position="step", length="_steps", chunk=chunk)
    source = F.col("state") if order == 1 else F.array("state", *[f"_s{i}" for i in range(1, order)])
    counts = (
        moved.select(source.alias("from_state"), F.col(f"_s{order}").alias("to_state"))
        .filter(F.col("to_state").isNotNull())
        .groupBy("from_state", "to_state")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    leaving = F.sum("count").over(Window.partitionBy("from_state"))
    return counts.withColumn("probability", ratio(F.col("count"), leaving))


def transition_matrix(edges: DataFrame, states: list[str]) -> DataFrame:
    """M3: one row per from-state, one column per to-state, 0 where unseen."""
    return edges.groupBy("from_state").pivot("to_state", states).agg(F.sum("probability")).na.fill(0.0)


def removal_effects(touches: DataFrame) -> DataFrame:
    """M4, M5: removal effect and attribution share per channel.

    Removing a channel loses exactly the converting journeys that consist of nothing
    else, so one aggregate per journey decides it: its smallest and largest channel
    agree. Channels that never stand alone have effect 0; if all do, shares are equal.
    """
    journeys = touches.groupBy("customer_id").agg(
        F.max("converted").alias("converted"), F.min("channel").alias("low"), F.max("channel").alias("high")
    )
    sole = F.when(F.col("low") == F.col("high"), F.col("low"))
    by_channel = (
        journeys.filter(F.col("converted") == 1)
        .groupBy(sole.alias("channel"))
        .agg(F.count(F.lit(1)).alias("lost"))
    )
    return _effects(by_channel, touches.select("channel").distinct())


def removal_effects_from_sets(sets: DataFrame, channels: list[str]) -> DataFrame:
    """M4, M5 from the distinct channel sets of ``shapley.channel_sets``."""
    alone = F.when(F.size("members") == 1, F.element_at(F.lit(channels), F.col("members")[0] + 1))
    by_channel = sets.groupBy(alone.alias("channel")).agg(F.sum("conversions").alias("lost"))
    names = sets.sparkSession.createDataFrame([(c,) for c in channels], "channel string")
    return _effects(by_channel, names)


def _effects(by_channel: DataFrame, channels: DataFrame) -> DataFrame:
    """Effects and shares from conversions lost per sole channel (NULL: more than one).

    All tables here have one row per channel.
    """
    lost = by_channel.select("channel", "lost", total(F.col("lost")).alias("conversions")).filter(
        F.col("channel").isNotNull()
    )
    effects = channels.join(lost, "channel", "left").select(
        "channel", F.coalesce(ratio(F.col("lost"), F.col("conversions")), F.lit(0.0)).alias("removal_effect")
    )
    everything = total(F.col("removal_effect"))
    equal = ratio(F.lit(1), total(F.lit(1)))
    share = F.when(everything > 0, F.col("removal_effect") / everything).otherwise(equal)
    return effects.withColumn("attribution_share", share)


def share_out(
    touches: DataFrame, values: DataFrame, value: str, out: str, chunk: int = CHUNK_TOUCHES
) -> DataFrame:
    """M6, H4: split each converting journey's revenue by channel value.

    ``values`` has one row per channel. The fractions of a journey without revenue stay
    as they are and sum to 1.
    """
    valued = join_dimension(touches, values.select("channel", F.col(value).alias("_given"))).withColumn(
        "_v", F.coalesce("_given", F.lit(0.0))
    )
    totals = {
        "_converted": F.max("converted"),
        "_value": F.max("revenue"),
        "_all": F.sum("_v"),
    }
    ready = with_journey_totals(valued, totals, chunk)
    return ready.select(*touches.columns, shared_credit("_v", "_all").alias(out))


def shared_credit(value: str, journey_sum: str):
    """Credit of one touch from its channel value and the journey's sum of values."""
    part = F.when(F.col(journey_sum) > 0, F.col(value) / F.col(journey_sum)).otherwise(F.col(value))
    scaled = F.when(F.col("_value") > 0, part * F.col("_value")).otherwise(part)
    return F.when(F.col("_converted") == 1, scaled).otherwise(0.0)


def attribute_markov(touches: DataFrame, chunk: int = CHUNK_TOUCHES) -> DataFrame:
    """M6: ``markov_attribution`` on every touch."""
    return share_out(touches, removal_effects(touches), "attribution_share", "markov_attribution", chunk)


def channel_totals(attributed: DataFrame, credit: str) -> DataFrame:
    """Attributed revenue, cost, customers and last-touch conversions per channel."""
    last = F.col("touchpoint_number") == F.col("total_touchpoints")
    return (
        attributed.groupBy("channel", "customer_id")
        .agg(
            F.sum(credit).alias("credit"),
            F.sum("cost").alias("cost"),
            F.sum(F.when(last, F.col("converted")).otherwise(0)).alias("last"),
        )
        .groupBy("channel")
        .agg(
            F.sum("credit").alias("attributed_revenue"),
            F.sum("cost").alias("cost"),
            F.count(F.lit(1)).alias("unique_customers"),
            F.sum("last").alias("last_touch_conversions"),
        )
    )


def markov_performance(touches: DataFrame, chunk: int = CHUNK_TOUCHES) -> DataFrame:
    """M7: channel table of the Markov model, largest attributed revenue first."""
    effects = freeze(removal_effects(touches))
    attributed = share_out(touches, effects, "attribution_share", "markov_attribution", chunk)
    return (
        channel_totals(attributed, "markov_attribution")
        .drop("last_touch_conversions")
        .join(effects, "channel")
        .withColumn("roi", roi(F.col("attributed_revenue"), F.col("cost")))
        .orderBy(F.desc("attributed_revenue"), "channel")
    )


def transitions_from(edges: DataFrame, state: str) -> DataFrame:
    """M8: where one state leads, most likely first; an unknown state gives no rows."""
    return (
        edges.filter(F.col("from_state") == state)
        .select("to_state", "probability")
        .orderBy(F.desc("probability"), "to_state")
    )


def top_edges(edges: DataFrame, n: int | None = 20) -> DataFrame:
    """M9: edges of the transition graph, heaviest first."""
    return ranked_top(
        edges.filter(F.col("probability") > 0), n, F.desc("probability"), F.asc("from_state"), F.asc("to_state")
    )


def flow_edges(
    touches: DataFrame, n: int | None = 50, max_customers: int | None = None, chunk: int = CHUNK_TOUCHES
) -> DataFrame:
    """Flow between (channel, position) nodes and the outcome, largest first.

    ``max_customers`` restricts the picture to the first customers by id, the display
    limit of the dashboard page; the default covers everyone.
    """
    scope = touches
    if max_customers is not None:
        first = touches.select("customer_id").distinct().orderBy("customer_id").limit(max_customers)
        scope = touches.join(first, "customer_id", "left_semi")
    ended = with_journey_totals(renumber(scope, chunk), {"_converted": F.max("converted")}, chunk)
    moved = with_neighbours(ended, {"_next": ("channel", 1)}, chunk=chunk)
    p = F.col("touchpoint_number")
    outcome = F.when(F.col("_converted") == 1, "Conversion").otherwise("No Conversion")
    at_end = p == F.col("total_touchpoints")
    edges = moved.select(
        F.concat("channel", F.lit("_"), p - 1).alias("source"),
        F.when(at_end, outcome).otherwise(F.concat("_next", F.lit("_"), p)).alias("target"),
    )
    counts = edges.groupBy("source", "target").agg(F.count(F.lit(1)).alias("value"))
    return ranked_top(counts, n, F.desc("value"), F.asc("source"), F.asc("target"))
