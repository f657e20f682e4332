"""Daily and weekly series: trends, anomalies, forecasts, stationarity.

The heavy step of every operator is one aggregation by calendar unit. Windows below
it run over one row per date or week.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from journeyloom.functions.least_squares import product_sums, swept
from journeyloom.functions.numeric import ratio
from journeyloom.operators.metrics import daily_metrics

SERIES = ["shapley_attribution", "markov_attribution", "last_touch_attribution", "revenue"]


def daily_attribution(attributed: DataFrame) -> DataFrame:
    """Daily sums of the model credits and of revenue."""
    return attributed.groupBy(F.to_date("timestamp").alias("date")).agg(*[F.sum(c).alias(c) for c in SERIES])


def daily_series(attributed: DataFrame, methods: list[str]) -> DataFrame:
    """D1 in long form: series, date, value."""
    return (
        attributed.groupBy(F.to_date("timestamp").alias("date"))
        .agg(*[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in methods])
        .unpivot(["date"], methods, "series", "value")
    )


def weekly_channel(touches: DataFrame, with_year: bool = False) -> DataFrame:
    """Mean conversion, revenue, cost and customers per ISO week and channel.

    Weeks of different years share a number unless ``with_year`` adds the ISO year.
    """
    week = F.weekofyear("timestamp").alias("week")
    year = F.expr("extract(YEAROFWEEK FROM timestamp)").alias("iso_year")
    keys = ["iso_year", "week", "channel"] if with_year else ["week", "channel"]
    dated = touches.select(week, year, "channel", "customer_id", "converted", "revenue", "cost")
    return (
        dated.groupBy(*keys, "customer_id")
        .agg(
            F.count("converted").alias("n"),
            F.sum("converted").alias("converted"),
            F.sum("revenue").alias("revenue"),
            F.sum("cost").alias("cost"),
        )
        .groupBy(*keys)
        .agg(
            ratio(F.sum("converted"), F.sum("n")).alias("conversion_rate"),
            F.sum("revenue").alias("revenue"),
            F.sum("cost").alias("cost"),
            F.count(F.lit(1)).alias("customers"),
        )
    )


def channel_trends(weekly: DataFrame, min_weeks: int = 4) -> DataFrame:
    """D3: slope and direction of the weekly conversion rate, for channels with more than ``min_weeks``."""
    return (
        weekly.groupBy("channel")
        .agg(
            F.regr_slope("conversion_rate", "week").alias("trend_slope"),
            F.max_by("conversion_rate", "week").alias("current_conv_rate"),
            F.count(F.lit(1)).alias("weekly_data_points"),
        )
        .filter(F.col("weekly_data_points") > min_weeks)
        .withColumn("trend_direction", F.when(F.col("trend_slope") > 0, "improving").otherwise("declining"))
    )


def rolling_scores(touches: DataFrame, window: int = 7, deviations: float = 2.0) -> DataFrame:
    """Each daily value against the mean and deviation of its last ``window`` rows."""
    metrics = ["revenue", "cost", "converted"]
    daily = daily_metrics(touches, by_channel=False).withColumn("converted", F.col("converted").cast("double"))
    long = daily.select("date", *metrics).unpivot(["date"], metrics, "metric", "value")
    recent = Window.partitionBy("metric").orderBy("date").rowsBetween(1 - window, 0)
    scored = long.withColumns(
        {"rolling_mean": F.avg("value").over(recent), "rolling_std": F.stddev_samp("value").over(recent)}
    )
    gap = F.col("value") - F.col("rolling_mean")
    return scored.withColumns(
        {
            "deviation": ratio(gap, F.col("rolling_std")),
            "is_anomaly": F.coalesce(F.abs(gap) > deviations * F.col("rolling_std"), F.lit(False)),
        }
    )


def anomaly_summary(scores: DataFrame) -> DataFrame:
    """Anomalous dates, their number and the largest signed deviation per metric."""
    return scores.groupBy("metric").agg(
        F.array_sort(F.collect_list(F.when(F.col("is_anomaly"), F.col("date").cast("string")))).alias(
            "anomaly_dates"
        ),
        F.sum(F.col("is_anomaly").cast("int")).alias("anomaly_count"),
        F.max("deviation").alias("max_deviation"),
    )


def _lagged(series: DataFrame, group: str, order: str, value: str) -> DataFrame:
    steps = Window.partitionBy(group).orderBy(order)
    return series.select(
        group,
        order,
        F.col(value).alias("y"),
        F.lag(value).over(steps).alias("y_before"),
        F.row_number().over(steps).alias("t"),
        F.count(F.lit(1)).over(Window.partitionBy(group)).alias("points"),
    )


def _ar1(pairs: DataFrame, group: str) -> DataFrame:
    """Least-squares y = a + b * y_before and the last value per series."""
    return pairs.groupBy(group).agg(
        F.coalesce(F.regr_slope("y", "y_before"), F.lit(0.0)).alias("b"),
        F.coalesce(F.regr_intercept("y", "y_before"), F.avg("y")).alias("a"),
        F.max_by("y", "t").alias("y_last"),
        F.max("t").alias("t_last"),
    )


def _ahead(h):
    """Value h steps after the last one, the recursion in closed form."""
    power = F.pow(F.col("b"), h)
    drift = F.when(F.col("b") == 1, F.col("a") * h).otherwise(F.col("a") * (1 - power) / (1 - F.col("b")))
    return power * F.col("y_last") + drift


def ar1_forecast(series: DataFrame, group: str, order: str, value: str, steps: int) -> DataFrame:
    """The next ``steps`` values of every series from a first-order autoregression."""
    fitted = _ar1(_lagged(series, group, order, value), group)
    return fitted.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps)))).select(
        group, "step", _ahead(F.col("step")).alias("forecast")
    )


def ar1_holdout_mae(series: DataFrame, group: str, order: str, value: str, train: float = 0.8) -> DataFrame:
    """Mean absolute error on the last fifth of each series, fitted on the rest."""
    pairs = _lagged(series, group, order, value).withColumn("cut", F.floor(F.col("points") * train))
    fitted = _ar1(pairs.filter(F.col("t") <= F.col("cut")), group)
    held = pairs.filter(F.col("t") > F.col("cut")).join(fitted, group)
    return held.groupBy(group).agg(
        F.avg(F.abs(F.col("y") - _ahead(F.col("t") - F.col("t_last")))).alias("mae"),
        F.count(F.lit(1)).alias("held_out"),
    )


def ar_fits(series: DataFrame, group: str, order: str, value: str, max_order: int = 5) -> DataFrame:
    """An autoregression per series whose order, 0 to ``max_order``, has the least AIC.

    Autocovariances of all lags come from one pass. The Levinson-Durbin recursion is a fold over the lags that gives the
    coefficients of every order from those of the one before, with n ln(variance) + 2 (order + 1) as its AIC. Returns
    group, points, mean, order, phi (coefficients, first lag first), variance and recent (last values, newest first).
    """
    steps = Window.partitionBy(group).orderBy(order)
    centred = series.select(group, F.row_number().over(steps).alias("t"), F.col(value).cast("double").alias("y")).withColumn(
        "m", F.avg("y").over(Window.partitionBy(group))
    )
    centred = centred.withColumn("d", F.col("y") - F.col("m"))
    by_time = Window.partitionBy(group).orderBy("t")
    lags = centred.select("*", *[F.lag("d", k).over(by_time).alias(f"d{k}") for k in range(1, max_order + 1)])
    points = F.count("y")
    # missing days of a series have no row here, so every lag is one row back
    covariance = [F.coalesce(F.sum(F.col("d") * F.col(f"d{k}" if k else "d")), F.lit(0.0)) / points for k in range(max_order + 1)]
    newest = F.transform(F.sort_array(F.collect_list(F.when(F.col("t") > F.col("n") - max_order, F.struct("t", "y"))), asc=False), lambda s: s["y"])
    sums = (
        lags.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(group)))
        .groupBy(group)
        .agg(points.alias("points"), F.avg("y").alias("mean"), F.array(*covariance).alias("c"), newest.alias("recent"))
    )
    best = F.array_min("found")
    return sums.withColumn("found", _levinson(max_order)).select(
        group, "points", "mean", best["order"].alias("order"), best["phi"].alias("phi"), best["v"].alias("variance"), "recent"
    )


def _levinson(max_order: int) -> Column:
    """(aic, order, phi, v) of every order that the series is long enough for, from its autocovariances ``c``."""

    def fit(order: Column, phi: Column, v: Column) -> Column:
        aic = F.when(v > 0, F.col("points") * F.log(v) + 2 * (order + 1)).otherwise(F.lit(float("-inf")))
        return F.struct(aic.alias("aic"), order.cast("int").alias("order"), phi.alias("phi"), v.alias("v"))

    def longer(found: Column, k: Column) -> Column:
        last = F.element_at(found, -1)
        c = F.col("c")
        ahead = F.aggregate(F.sequence(F.lit(1), k), F.lit(0.0), lambda s, j: s + F.when(j < k, F.get(last["phi"], j - 1) * c[F.greatest(k - j, F.lit(0))]).otherwise(0.0))
        # one element each, so that the reflection is computed once
        added = F.transform(F.array((c[k] - ahead) / last["v"]), lambda r: fit(k, _reflected(last["phi"], r), last["v"] * (1 - r * r)))
        enough = (last["v"] > 1e-12 * c[0]) & (k < F.col("points") - 1)
        return F.when(enough, F.concat(found, added)).otherwise(found)

    start = F.array(fit(F.lit(0), F.array().cast("array<double>"), F.col("c")[0]))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max_order)), start, longer)


def _reflected(phi: Column, r: Column) -> Column:
    """Coefficients of the next order from the reflection ``r``."""
    turned = F.transform(phi, lambda x, j: x - r * phi[F.size(phi) - 1 - j])
    return F.concat(turned, F.array(r))


def ar_forecast(series: DataFrame, group: str, order: str, value: str, steps: int, max_order: int = 5) -> DataFrame:
    """Group, order, step and forecast of the next ``steps`` values, each from the values and forecasts before it."""

    def following(path: Column, _: Column) -> Column:
        gaps = F.transform("phi", lambda x, j: x * (path[j] - F.col("mean")))
        return F.concat(F.array(F.col("mean") + F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x)), path)

    path = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.col("recent"), following)
    newest_last = F.reverse(F.slice(path, F.lit(1), F.lit(steps)))
    fits = ar_fits(series, group, order, value, max_order)
    return fits.select(group, "order", F.posexplode(newest_last).alias("at", "forecast")).select(
        group, "order", (F.col("at") + 1).alias("step"), "forecast"
    )


def augmented_dickey_fuller(series: DataFrame, group: str, order: str, value: str, lags: int = 1) -> DataFrame:
    """T statistic of the level in the regression of the change on it, a constant and ``lags`` earlier changes.

    The normal equations of every series come from one pass of cross moments.
    """
    by_time = Window.partitionBy(group).orderBy(order)
    level = F.col(value) - F.avg(value).over(Window.partitionBy(group))
    moved = series.select(group, order, level.alias("y")).withColumn("y1", F.lag("y").over(by_time))
    moved = moved.withColumn("dy", F.col("y") - F.col("y1"))
    earlier = [f"dy{k}" for k in range(1, lags + 1)]
    rows = moved.select(group, F.lit(1.0).alias("one"), "y1", "dy", *[F.lag("dy", k).over(by_time).alias(c) for k, c in enumerate(earlier, 1)])
    terms = ["y1", "one", *earlier, "dy"]
    size = len(terms)
    solved = product_sums(rows, group, terms).withColumn("s", swept(F.col("products"), size, size - 1))
    gamma, spread, residual = F.col("s")[size - 1], F.col("s")[0], F.col("s")[size * size - 1]
    error = F.sqrt(ratio(residual, F.col("n") - (size - 1)) * spread)
    return solved.select(group, F.col("n").alias("rows"), gamma.alias("gamma"), ratio(gamma, error).alias("df_statistic"))


def dickey_fuller(series: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """T statistic of the level in the regression of the change on it, no lags."""
    pairs = _lagged(series, group, order, value).withColumn("dy", F.col("y") - F.col("y_before"))
    moments = pairs.groupBy(group).agg(
        F.regr_count("dy", "y_before").alias("pairs"),
        F.regr_sxx("dy", "y_before").alias("sxx"),
        F.regr_syy("dy", "y_before").alias("syy"),
        F.regr_sxy("dy", "y_before").alias("sxy"),
    )
    slope = ratio(F.col("sxy"), F.col("sxx"))
    residual = F.col("syy") - slope * F.col("sxy")
    error = F.sqrt(ratio(ratio(residual, F.col("pairs") - 2), F.col("sxx")))
    return moments.select(group, "pairs", slope.alias("gamma"), ratio(slope, error).alias("df_statistic"))
