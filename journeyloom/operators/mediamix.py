"""Media-mix modelling on the daily channel table.

Touches reduce to one row per day and channel; everything after that, including the
ridge fit, works on a table with one row per day.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from journeyloom.functions.dimensions import channels_of
from journeyloom.functions.numeric import hash_int, ratio, ratio_or_zero, total

# Fixed values of the transformations.
ADSTOCK_RATE, ADSTOCK_LAGS = 0.7, 8
SATURATION_ALPHA, SATURATION_GAMMA = 1.0, 1.0
LAMBDAS = [0.001, 0.01, 0.1, 1.0, 10.0, 100.0]


def daily_channel(touches: DataFrame) -> DataFrame:
    """Spend, impressions, conversions and revenue per day and channel."""
    return touches.groupBy(F.to_date("timestamp").alias("date"), "channel").agg(
        F.sum("cost").alias("spend"),
        F.count(F.lit(1)).alias("impressions"),
        F.sum("converted").alias("conversions"),
        F.sum("revenue").alias("revenue"),
    )


def daily_wide(daily: DataFrame, channels: list[str]) -> DataFrame:
    """R2: one row per day, spend and revenue columns per channel, 0 where absent.

    ``total_revenue`` is that of all channels, named here or not.
    """

    def of(channel: str, value: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("channel") == channel, F.col(value))), F.lit(0.0)).alias(f"{value}_{channel}")

    cells = [of(c, value) for value in ("spend", "revenue") for c in channels]
    return daily.groupBy("date").agg(*cells, F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("total_revenue"))


def daily_grid(daily: DataFrame, channels: list[str]) -> DataFrame:
    """R2 in long form: every channel on every day that has touches."""
    wide = daily_wide(daily, channels)
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("channel"), F.col(f"`spend_{c}`").alias("spend"))
                for c in channels
            ]
        )
    )
    return wide.select("date", "total_revenue", pairs.alias("p")).select(
        "date", "p.channel", "p.spend", "total_revenue"
    )


def with_adstock(grid: DataFrame, rate: float = ADSTOCK_RATE, max_lag: int = ADSTOCK_LAGS) -> DataFrame:
    """Geometric carry-over of spend, by row, within each channel."""
    days = Window.partitionBy("channel").orderBy("date")
    carried = F.col("spend")
    for j in range(1, max_lag + 1):
        carried = carried + F.coalesce(F.lag("spend", j).over(days), F.lit(0.0)) * rate**j
    return grid.withColumn("adstock", carried)


def with_saturation(
    grid: DataFrame, alpha: float = SATURATION_ALPHA, gamma: float = SATURATION_GAMMA
) -> DataFrame:
    """Hill curve of adstock relative to the channel's largest; 0 for an unused channel."""
    top = F.max("adstock").over(Window.partitionBy("channel"))
    scaled = F.pow(ratio_or_zero(F.col("adstock"), top), F.lit(alpha))
    return grid.withColumn("saturated", scaled / (scaled + F.pow(F.lit(gamma), F.lit(alpha))))


def calendar_terms(daily: DataFrame) -> DataFrame:
    """Trend index, weekday (Sunday = 1) and month of each day."""
    days = daily.select("date").distinct()
    return days.select(
        "date",
        F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("date")).alias("trend"),
        F.dayofweek("date").alias("day_of_week"),
        F.month("date").alias("month"),
    )


def transformed_grid(touches: DataFrame, channels: list[str]) -> DataFrame:
    """R1 to R4 in a row."""
    return with_saturation(with_adstock(daily_grid(daily_channel(touches), channels)))


def fold_sums(grid: DataFrame, channels: list[str], seed: int = 42, folds: int = 5) -> DataFrame:
    """Sums of products of (1, saturated spend by channel, revenue) per fold of days.

    A day's fold comes from the hash of its date. One row per fold: everything a ridge
    fit on any union of folds needs, whatever the order or number of rows.
    """
    names = [f"x{i}" for i in range(len(channels))]
    wide = grid.groupBy("date").agg(
        F.max("total_revenue").alias("y"),
        *[F.coalesce(F.max(F.when(F.col("channel") == c, F.col("saturated"))), F.lit(0.0)).alias(n) for c, n in zip(channels, names, strict=True)],
    )
    rows = wide.select(
        F.pmod(hash_int(F.lit(seed), F.col("date")), F.lit(folds)).cast("int").alias("fold"),
        F.lit(1.0).alias("one"),
        *names,
        F.coalesce("y", F.lit(0.0)).alias("y"),
    )
    terms = ["one", *names, "y"]
    products = [F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for i, a in enumerate(terms) for b in terms[i:]]
    return rows.groupBy("fold").agg(*products)


class _Ridge:
    """Ridge fits for any penalty from one product matrix of (1, x, y): one eigen-decomposition for all of them.

    Predictors and response are scaled to unit deviation, and the penalty by that of the
    response; constant predictors get 0.
    """

    def __init__(self, sums: np.ndarray):
        self.mean = sums[0] / sums[0, 0]
        covariance = sums / sums[0, 0] - np.outer(self.mean, self.mean)
        self.deviation = np.sqrt(np.maximum(np.diag(covariance), 0.0))
        self.size = len(sums) - 2
        self.used = np.flatnonzero(self.deviation[1:-1] > 1e-12) + 1
        if self.deviation[-1] <= 1e-12:
            self.used = self.used[:0]
        scale = self.deviation[self.used]
        inner = covariance[np.ix_(self.used, self.used)] / np.outer(scale, scale)
        outer = covariance[self.used, -1] / (scale * self.deviation[-1]) if len(self.used) else np.zeros(0)
        self.values, self.vectors = np.linalg.eigh(inner)
        self.turned = self.vectors.T @ outer

    def fit(self, penalty: float) -> tuple[np.ndarray, float]:
        """Coefficients and intercept."""
        weights = np.zeros(self.size)
        if len(self.used):
            solved = self.vectors @ (self.turned / (self.values + penalty / self.deviation[-1]))
            weights[self.used - 1] = solved * self.deviation[-1] / self.deviation[self.used]
        return weights, float(self.mean[-1] - weights @ self.mean[1:-1])


def _mean_error(sums: np.ndarray, weights: np.ndarray, intercept: float) -> float:
    """Root mean square error on the rows summed in ``sums``."""
    v = np.concatenate(([-intercept], -weights, [1.0]))
    return float(np.sqrt(max(v @ sums @ v, 0.0) / sums[0, 0]))


def ridge_path(
    grid: DataFrame, channels: list[str], seed: int = 42, folds: int = 5, penalties: list[float] = LAMBDAS
) -> DataFrame:
    """Coefficients for every penalty, its cross-validated error and whether it is chosen.

    (penalty, cv_error, chosen, channel, coefficient, intercept). The folds' sums of products, a few rows whose size the
    channels fix, are all that the fits need; each union of folds is decomposed once for all penalties.
    """
    size = len(channels) + 2
    parts = []
    for row in fold_sums(grid, channels, seed, folds).drop("fold").collect():
        upper = np.zeros((size, size))
        upper[np.triu_indices(size)] = [float(v) for v in row]
        parts.append(upper + np.triu(upper, 1).T)
    schema = "penalty double, cv_error double, chosen boolean, channel string, coefficient double, intercept double"
    if not parts:
        return grid.sparkSession.createDataFrame([], schema)
    everything = sum(parts)
    held = [(p, _Ridge(everything - p)) for p in parts if everything[0, 0] > p[0, 0]]
    errors = {x: sum(_mean_error(p, *fit.fit(x)) for p, fit in held) / max(1, len(held)) for x in penalties}
    best, whole = min(penalties, key=errors.get), _Ridge(everything)
    rows = []
    for penalty in penalties:
        weights, intercept = whole.fit(penalty)
        rows += [(float(penalty), errors[penalty], penalty == best, c, float(w), intercept) for c, w in zip(channels, weights, strict=True)]
    return grid.sparkSession.createDataFrame(rows, schema)


def ridge_coefficients(grid: DataFrame, channels: list[str], seed: int = 42, folds: int = 5) -> DataFrame:
    """Ridge fit of daily revenue on saturated spend; penalty by cross-validation.

    Returns the non-zero coefficients, largest magnitude first.
    """
    chosen = ridge_path(grid, channels, seed, folds).filter(F.col("chosen") & (F.col("coefficient") != 0))
    return chosen.select("channel", "coefficient").orderBy(F.desc(F.abs("coefficient")), "channel")


def ridge_equations(grid: DataFrame, path: DataFrame) -> DataFrame:
    """R5 checked on the days themselves: per penalty and channel, ``product`` and ``shrinkage``.

    A fit b solves its normal equations: on predictors and response in units of their deviations, the mean product of a
    predictor with what the fit leaves (``product``) is the penalty, in units of the response, times b (``shrinkage``).
    """
    by_channel, everywhere = Window.partitionBy("channel"), Window.partitionBy(F.lit(0))
    days = grid.groupBy("date").agg(F.max("total_revenue").alias("y"))
    days = days.select("date", "y", F.avg("y").over(everywhere).alias("mean_y"), F.stddev_pop("y").over(everywhere).alias("dev_y"))
    units = grid.select(
        "date",
        "channel",
        F.coalesce(ratio(F.col("saturated") - F.avg("saturated").over(by_channel), F.stddev_pop("saturated").over(by_channel)), F.lit(0.0)).alias("z"),
        F.stddev_pop("saturated").over(by_channel).alias("dev"),
    )
    fitted = units.join(F.broadcast(path), "channel").join(days, "date")
    scaled = fitted.withColumn("b", F.coalesce(ratio(F.col("coefficient") * F.col("dev"), F.col("dev_y")), F.lit(0.0)))
    left = ratio(F.col("y") - F.col("mean_y"), F.col("dev_y")) - F.sum(F.col("z") * F.col("b")).over(Window.partitionBy("penalty", "date"))
    return (
        scaled.withColumn("left", left)
        .groupBy("penalty", "channel")
        .agg(F.avg(F.col("z") * F.col("left")).alias("product"), (F.first("penalty") / F.first("dev_y") * F.first("b")).alias("shrinkage"))
    )


def contributions(grid: DataFrame, coefficients: DataFrame) -> DataFrame:
    """Revenue explained per channel, its roi and its share of the total."""
    inputs = grid.groupBy("channel").agg(F.sum("saturated").alias("x"), F.sum("spend").alias("spend"))
    joined = inputs.join(coefficients, "channel", "left")
    out = joined.select(
        "channel", (F.col("x") * F.coalesce("coefficient", F.lit(0.0))).alias("contribution"), "spend"
    )
    return out.withColumns(
        {
            "roi": F.when(F.col("spend") > 0, F.col("contribution") / F.col("spend")).otherwise(0.0),
            "contribution_pct": ratio(F.col("contribution"), total(F.col("contribution"))) * 100,
        }
    ).orderBy(F.desc("contribution"), "channel")


def budget_by_roi(contribution: DataFrame) -> DataFrame:
    """today's spend redistributed in proportion to roi."""
    optimal = total(F.col("spend")) * ratio(F.col("roi"), total(F.col("roi")))
    out = contribution.select(
        "channel", F.col("spend").alias("current_spend"), optimal.alias("optimal_spend"), "roi"
    )
    change = F.col("optimal_spend") - F.col("current_spend")
    return out.withColumns(
        {"spend_change": change, "change_pct": ratio(change, F.col("current_spend")) * 100}
    ).orderBy(F.desc_nulls_last("change_pct"), "channel")


def media_mix(touches: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The whole analysis: coefficients, contributions, optimised budget."""
    channels = channels_of(touches)
    grid = transformed_grid(touches, channels)
    coefficients = ridge_coefficients(grid, channels, seed)
    contribution = contributions(grid, coefficients)
    return coefficients, contribution, budget_by_roi(contribution)
