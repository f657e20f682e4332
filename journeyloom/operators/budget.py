"""Budget allocation on channel totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from journeyloom.functions.numeric import ratio, ratio_or_zero, roi, total

# Budget multipliers and the diminishing-returns factor of the projection.
SCENARIOS = [0.5, 0.75, 1.0, 1.25, 1.5]
RETURNS = 0.9


def _channel_sums(touches: DataFrame, *more) -> DataFrame:
    return touches.groupBy("channel").agg(F.sum("cost").alias("cost"), F.sum("revenue").alias("revenue"), *more)


def allocation_weights(attributed: DataFrame) -> DataFrame:
    """B1: weight of every channel under the equal, shapley and roi strategies."""
    sums = _channel_sums(attributed, F.sum("shapley_attribution").alias("credit"))
    gain = F.when(F.col("cost") > 0, ratio(F.col("revenue") - F.col("cost"), F.col("cost"))).otherwise(0.0)
    positive = F.when(gain > 0, gain)
    weighted = sums.select(
        "channel",
        "cost",
        "revenue",
        ratio(F.lit(1), total(F.lit(1))).alias("equal"),
        ratio(F.col("credit"), total(F.col("credit"))).alias("shapley"),
        ratio(positive, total(positive)).alias("roi"),
        total(F.col("cost")).alias("total_budget"),
    )
    long = weighted.unpivot(
        ["channel", "cost", "revenue", "total_budget"], ["equal", "shapley", "roi"], "strategy", "weight"
    )
    return long.filter(F.col("weight").isNotNull())


def allocation_strategies(attributed: DataFrame) -> DataFrame:
    """B1: expected revenue and roi of each strategy at the past revenue per cost."""
    past = F.when(F.col("cost") > 0, ratio(F.col("revenue"), F.col("cost"))).otherwise(0.0)
    outcome = (
        allocation_weights(attributed)
        .groupBy("strategy")
        .agg(
            F.sum(F.col("total_budget") * F.col("weight") * past).alias("expected_revenue"),
            F.max("total_budget").alias("total_budget"),
        )
    )
    gain = F.col("expected_revenue") - F.col("total_budget")
    return outcome.withColumn("expected_roi", ratio(gain, F.col("total_budget")))


def optimal_budget(touches: DataFrame) -> DataFrame:
    """B2: the whole budget over channels with positive roi, in proportion to it."""
    sums = _channel_sums(touches).withColumn("total_budget", total(F.col("cost")))
    gain = roi(F.col("revenue"), F.col("cost"))
    positive = sums.withColumn("roi", gain).filter(F.col("roi") > 0)
    optimal = positive.withColumn("optimal_budget", F.col("total_budget") * F.col("roi") / total(F.col("roi")))
    change = F.col("optimal_budget") - F.col("cost")
    return optimal.select(
        "channel",
        F.col("cost").alias("current_budget"),
        "optimal_budget",
        change.alias("budget_change"),
        (ratio(change, F.col("cost")) * 100).alias("change_pct"),
        "roi",
    ).orderBy(F.desc("change_pct"), "channel")


def budget_comparison(touches: DataFrame) -> DataFrame:
    """Current and optimal budget in long form."""
    return optimal_budget(touches).unpivot(
        ["channel"], ["current_budget", "optimal_budget"], "budget_type", "amount"
    )


def scenario_projection(touches: DataFrame) -> DataFrame:
    """Budget, projected revenue and roi at a row of multipliers."""
    sums = touches.agg(F.sum("cost").alias("cost"), F.sum("revenue").alias("revenue"))
    scaled = sums.withColumn("multiplier", F.explode(F.lit(SCENARIOS)))
    budget = F.col("cost") * F.col("multiplier")
    projected = F.col("revenue") * F.col("multiplier") * RETURNS
    return scaled.select(
        "multiplier",
        budget.alias("total_budget"),
        projected.alias("projected_revenue"),
        ratio_or_zero(projected - budget, budget).alias("projected_roi"),
    )
