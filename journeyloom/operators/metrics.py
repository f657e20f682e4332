"""Dataset, channel and calendar aggregates.

Distinct customers per channel come from grouping on (channel, customer) first:
counts and sums are combined on the map side, and no channel is ever held whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from journeyloom.functions.numeric import ranked_top, ratio, ratio_or_zero, roi, side_by_side


def is_last() -> Column:
    return F.col("touchpoint_number") == F.col("total_touchpoints")


def _flag(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _per_customer(touches: DataFrame, *by: str) -> DataFrame:
    """One row per (by, customer) with the sums every channel table needs.

    Sums over first and last touches are there if the touches have positions.
    """
    placed = [
        _flag(F.col("touchpoint_number") == 1).alias("first_touches"),
        _flag(is_last()).alias("last_touches"),
        F.sum(F.when(is_last(), F.col("converted")).otherwise(0)).alias("last_conversions"),
    ]
    return touches.groupBy(*by, "customer_id").agg(
        F.count(F.lit(1)).alias("touches"),
        F.sum("cost").alias("cost"),
        F.sum("revenue").alias("revenue"),
        F.sum("converted").alias("converted"),
        F.max("converted").alias("any_converted"),
        F.sum("time_on_site").alias("time_on_site"),
        F.count("time_on_site").alias("timed"),
        F.sum("pages_viewed").alias("pages_viewed"),
        F.count("pages_viewed").alias("paged"),
        *(placed if "touchpoint_number" in touches.columns else []),
    )


def dataset_stats(touches: DataFrame) -> DataFrame:
    """A1: rows, distinct customers, distinct channels."""
    pairs = touches.groupBy("customer_id", "channel").agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(
        F.sum("n").alias("total_records"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.countDistinct("channel").alias("unique_channels"),
    )


def channel_metrics(touches: DataFrame) -> DataFrame:
    """A2: the batch channel table; conversion rate per touch, NULL roi at zero cost."""
    return (
        _per_customer(touches, "channel")
        .groupBy("channel")
        .agg(
            F.sum("touches").alias("total_touches"),
            F.count(F.lit(1)).alias("unique_customers"),
            F.sum("cost").alias("total_cost"),
            F.sum("revenue").alias("total_revenue"),
            ratio(F.sum("time_on_site"), F.sum("timed")).alias("avg_time_on_site"),
            ratio(F.sum("pages_viewed"), F.sum("paged")).alias("avg_pages_viewed"),
            F.sum("converted").alias("conversions"),
            F.sum("first_touches").alias("first_touches"),
            F.sum("last_touches").alias("last_touches"),
        )
        .withColumns(
            {
                "conversion_rate": ratio(F.col("conversions"), F.col("total_touches")),
                "roi": ratio(F.col("total_revenue") - F.col("total_cost"), F.col("total_cost")),
                "revenue_per_customer": ratio(F.col("total_revenue"), F.col("unique_customers")),
            }
        )
        .orderBy(F.desc("total_revenue"), "channel")
    )


def time_patterns(touches: DataFrame) -> DataFrame:
    """A3: hour by day of week (Sunday = 1)."""
    return (
        touches.groupBy(F.hour("timestamp").alias("hour"), F.dayofweek("timestamp").alias("day_of_week"))
        .agg(
            F.count(F.lit(1)).alias("touches"),
            F.sum("converted").alias("conversions"),
            F.avg("time_on_site").alias("avg_engagement"),
        )
        .withColumn("conversion_rate", ratio(F.col("conversions"), F.col("touches")))
        .orderBy("hour", "day_of_week")
    )


def kpi_overview(touches: DataFrame) -> DataFrame:
    """A4: one row of headline figures."""
    customers = touches.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("touches"),
        F.max("converted").alias("converted"),
        F.sum("revenue").alias("revenue"),
        F.sum("cost").alias("cost"),
    )
    return customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("touches").alias("total_touchpoints"),
        F.sum("converted").alias("total_conversions"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("cost").alias("total_cost"),
    ).withColumns(
        {
            "conversion_rate": ratio(F.col("total_conversions"), F.col("total_customers")),
            "roas": ratio_or_zero(F.col("total_revenue"), F.col("total_cost")),
            "avg_customer_value": ratio(F.col("total_revenue"), F.col("total_customers")),
        }
    )


def channel_overview(touches: DataFrame) -> DataFrame:
    """A5: conversions per distinct customer and roi."""
    return (
        _per_customer(touches, "channel")
        .groupBy("channel")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("cost").alias("cost"),
            F.sum("revenue").alias("revenue"),
            F.sum("converted").alias("converted"),
        )
        .withColumns(
            {
                "roi": roi(F.col("revenue"), F.col("cost")),
                "conversion_rate": ratio(F.col("converted"), F.col("customers")),
            }
        )
    )


def channel_detail(touches: DataFrame, channel: str | None = None) -> DataFrame:
    """Deep dive per channel; all channels at once unless one is named."""
    scope = touches if channel is None else touches.filter(F.col("channel") == channel)
    return (
        _per_customer(scope, "channel")
        .groupBy("channel")
        .agg(
            F.sum("touches").alias("total_touches"),
            F.count(F.lit(1)).alias("unique_customers"),
            F.sum("cost").alias("total_cost"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("any_converted").alias("converting_customers"),
            ratio(F.sum("time_on_site"), F.sum("timed")).alias("avg_time_on_site"),
        )
        .withColumns(
            {
                "conversion_rate": ratio_or_zero(F.col("converting_customers"), F.col("unique_customers")),
                "roi": ratio_or_zero(F.col("total_revenue") - F.col("total_cost"), F.col("total_cost")),
            }
        )
    )


def daily_metrics(touches: DataFrame, by_channel: bool = True) -> DataFrame:
    """Distinct customers, cost, revenue and conversions per day (and channel)."""
    by = ["channel", "date"] if by_channel else ["date"]
    dated = touches.withColumn("date", F.to_date("timestamp"))
    return (
        _per_customer(dated, *by)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("cost").alias("cost"),
            F.sum("revenue").alias("revenue"),
            F.sum("converted").alias("converted"),
        )
    )


def position_frequency(touches: DataFrame) -> DataFrame:
    """How often a channel sits at each position, and conversions there."""
    return touches.groupBy("channel", F.col("touchpoint_number").alias("position")).agg(
        F.count("customer_id").alias("frequency"), F.sum("converted").alias("conversions")
    )


def top_channels(touches: DataFrame, n: int = 10) -> DataFrame:
    """Channels by touch count."""
    counts = touches.groupBy("channel").agg(F.count(F.lit(1)).alias("touches"))
    return ranked_top(counts, n, F.desc("touches"), F.asc("channel"))


def ga_profile(ga: DataFrame) -> DataFrame:
    """A10: profile of a session export."""
    visitors = ga.groupBy("fullVisitorId").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        _flag(F.col("transactions") > 0).alias("with_transactions"),
        F.sum("transactions").alias("transactions"),
        F.sum("revenue").alias("revenue"),
    )
    return visitors.agg(
        F.sum("n").alias("total_rows"),
        F.count("fullVisitorId").alias("unique_visitors"),
        F.min("first").alias("min_date"),
        F.max("last").alias("max_date"),
        F.sum("with_transactions").alias("rows_with_transactions"),
        F.sum("transactions").alias("total_transactions"),
        F.sum("revenue").alias("total_revenue"),
    )


def dataset_summary(touches: DataFrame) -> DataFrame:
    """One summary row with channel list and date range."""
    customers = touches.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("touches"),
        F.max("converted").alias("converted"),
        F.sum("revenue").alias("revenue"),
        F.sum("cost").alias("cost"),
        F.min("timestamp").alias("start"),
        F.max("timestamp").alias("end"),
    )
    figures = customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.sum("touches").alias("total_touchpoints"),
        F.sum("converted").alias("total_conversions"),
        F.avg("converted").alias("conversion_rate"),
        F.avg("touches").alias("avg_journey_length"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("cost").alias("total_cost"),
        ratio_or_zero(F.sum("revenue"), F.sum("cost")).alias("roas"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
    )
    names = touches.agg(F.array_sort(F.collect_set("channel")).alias("channels"))
    return side_by_side(figures, names)


def roi_table(touches: DataFrame) -> DataFrame:
    """Roi, cost per (last-touch) acquisition, revenue per customer."""
    return (
        _per_customer(touches, "channel")
        .groupBy("channel")
        .agg(
            F.sum("cost").alias("cost"),
            F.sum("revenue").alias("revenue"),
            F.count(F.lit(1)).alias("customers"),
            F.sum("last_conversions").alias("last_touch_conversions"),
        )
        .withColumns(
            {
                "roi": roi(F.col("revenue"), F.col("cost")),
                "cpa": ratio(F.col("cost"), F.col("last_touch_conversions")),
                "revenue_per_customer": ratio(F.col("revenue"), F.col("customers")),
            }
        )
    )


def prepared_check(touches: DataFrame) -> DataFrame:
    """Customers, converting customers, sum of each customer's largest revenue."""
    customers = touches.groupBy("customer_id").agg(
        F.max("converted").alias("converted"), F.max("revenue").alias("revenue")
    )
    return customers.agg(
        F.count(F.lit(1)).alias("unique_customers"),
        F.sum("converted").alias("converting_customers"),
        F.sum("revenue").alias("total_revenue"),
    )
