"""Tests and intervals on attribution.

Spark reduces the data to moments per group; tail probabilities are columns of the
reduced tables.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from journeyloom.functions import distributions as dist, poisson, tails
from journeyloom.functions.dimensions import freeze
from journeyloom.functions.numeric import hash_int, ratio, ratio_or_zero

ANOVA_METHODS = ["shapley_attribution", "markov_attribution", "last_touch_attribution"]
TOUCH_METHODS = [*ANOVA_METHODS, "linear_attribution"]


def customer_method_values(attributed: DataFrame, methods: list[str] = ANOVA_METHODS) -> DataFrame:
    """Positive attribution sums per customer in long form: method, value."""
    sums = attributed.groupBy("customer_id").agg(*[F.sum(m).alias(m) for m in methods])
    return sums.unpivot(["customer_id"], methods, "method", "value").filter(F.col("value") > 0)


def converted_touch_values(attributed: DataFrame, methods: list[str] = TOUCH_METHODS) -> DataFrame:
    """Attribution of converted touches in long form: method, value."""
    touched = attributed.filter(F.col("converted") == 1).select("customer_id", *methods)
    return touched.unpivot(["customer_id"], methods, "method", "value")


def group_moments(values: DataFrame) -> DataFrame:
    """Size, mean and sample variance per method."""
    return values.groupBy("method").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("variance")
    )


def anova_table(moments: DataFrame) -> DataFrame:
    """One-way analysis of variance from group moments, one row."""
    everyone = Window.partitionBy(F.lit(0))
    grand = F.sum(F.col("n") * F.col("mean")).over(everyone) / F.sum("n").over(everyone)
    spread = moments.withColumn("between", F.col("n") * F.pow(F.col("mean") - grand, 2))
    sums = spread.agg(
        F.sum("between").alias("between"),
        F.sum((F.col("n") - 1) * F.coalesce("variance", F.lit(0.0))).alias("within"),
        (F.count(F.lit(1)) - 1).alias("df_between"),
        (F.sum("n") - F.count(F.lit(1))).alias("df_within"),
    )
    f = ratio(ratio(F.col("between"), F.col("df_between")), ratio(F.col("within"), F.col("df_within")))
    return sums.withColumn("f_statistic", f)


def anova(values: DataFrame, alpha: float = 0.05) -> DataFrame:
    """X1, X2 with p-value and verdict."""
    p = tails.f_tail(F.col("f_statistic"), F.col("df_between"), F.col("df_within"))
    tested = anova_table(group_moments(values)).withColumn("p_value", p)
    return tested.withColumn("significant_difference", F.col("p_value") < alpha)


def tukey_hsd(values: DataFrame, alpha: float = 0.05) -> DataFrame:
    """All pairs of methods with adjusted p and confidence interval.

    The groups are the attribution methods, so their moments fit one row; the pairs,
    tails and the critical value are columns from there on.
    """
    moments = F.sort_array(F.collect_list(F.struct("method", "n", "mean", F.coalesce("variance", F.lit(0.0)).alias("variance"))))
    within = F.aggregate("g", F.lit(0.0), lambda total, m: total + (m["n"] - 1) * m["variance"])
    whole = group_moments(values).agg(moments.alias("g"), F.count(F.lit(1)).alias("k"), (F.sum("n") - F.count(F.lit(1))).alias("df"))
    whole = whole.withColumn("mse", F.coalesce(ratio(within, F.col("df")), F.lit(0.0)))
    critical = F.when(F.col("k") > 1, tails.studentized_range_critical(alpha, F.col("k"), F.col("df")))
    # a one-row table, frozen so that no pair evaluates the search again
    whole = freeze(whole.withColumn("critical", critical), 1)
    pairs = F.flatten(F.transform("g", lambda a, i: F.transform(F.slice("g", i + 2, F.size("g")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    table = whole.select(F.explode(pairs).alias("p"), "k", "df", "mse", "critical").select("p.a", "p.b", "k", "df", "mse", "critical")
    table = table.withColumn("difference", F.col("b.mean") - F.col("a.mean")).withColumn(
        "error", F.sqrt(F.col("mse") / 2 * (1 / F.col("a.n") + 1 / F.col("b.n")))
    )
    table = table.withColumn("q_statistic", ratio(F.abs("difference"), F.col("error"))).withColumn(
        "p_adjusted", tails.studentized_range_tail(F.col("q_statistic"), F.col("k"), F.col("df"))
    )
    reach = F.col("critical") * F.col("error")
    return table.select(
        F.col("a.method").alias("group1"),
        F.col("b.method").alias("group2"),
        F.col("difference").alias("mean_difference"),
        "q_statistic",
        "p_adjusted",
        (F.col("difference") - reach).alias("lower"),
        (F.col("difference") + reach).alias("upper"),
        (F.col("p_adjusted") < alpha).alias("reject"),
    )


def incrementality(
    touches: DataFrame, channels: list[str], holdout_pct: int = 20, seed: int = 42
) -> DataFrame:
    """X4, X6 (and the statistic of X5): hold-out test of each channel, all in one pass.

    A customer is in the control arm when the md5 of (seed, id) falls into the hold-out
    share; control drops the channel's touches, and customers with no other touch drop
    out with them. Treatment is everyone else.
    """
    control = F.pmod(hash_int(F.lit(seed), F.col("customer_id")), F.lit(100)) < holdout_pct
    customers = touches.groupBy("customer_id").agg(
        F.max("converted").alias("all"),
        *[
            F.max(F.when(F.col("channel") != c, F.col("converted"))).alias(f"without_{i}")
            for i, c in enumerate(channels)
        ],
    ).withColumn("control", control)

    def arm(value: Column, suffix: str) -> list[Column]:
        return [
            F.count(value).alias(f"n_{suffix}"),
            F.avg(value).alias(f"mean_{suffix}"),
            F.var_samp(value).alias(f"var_{suffix}"),
        ]

    aggregates = arm(F.when(~F.col("control"), F.col("all")), "t")
    for i in range(len(channels)):
        aggregates += arm(F.when(F.col("control"), F.col(f"without_{i}")), str(i))
    tests = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("channel"),
                    F.col(f"mean_{i}").alias("control_rate"),
                    F.col("mean_t").alias("treatment_rate"),
                    F.col(f"n_{i}").alias("control_n"),
                    F.col("n_t").alias("treatment_n"),
                    F.col(f"var_{i}").alias("control_var"),
                    F.col("var_t").alias("treatment_var"),
                )
                for i, c in enumerate(channels)
            ]
        )
    )
    table = customers.agg(*aggregates).select(tests.alias("r")).select("r.*")
    gap = F.col("treatment_rate") - F.col("control_rate")
    df = F.col("control_n") + F.col("treatment_n") - 2
    pooled = ratio(
        (F.col("control_n") - 1) * F.col("control_var") + (F.col("treatment_n") - 1) * F.col("treatment_var"), df
    )
    error = F.sqrt(pooled * (ratio(F.lit(1), F.col("control_n")) + ratio(F.lit(1), F.col("treatment_n"))))
    spread = F.sqrt((F.col("control_var") + F.col("treatment_var")) / 2)
    return table.select(
        "channel",
        "control_rate",
        "treatment_rate",
        F.when(F.col("control_rate") > 0, gap / F.col("control_rate")).otherwise(0.0).alias("lift"),
        ratio(-gap, error).alias("t_statistic"),
        ratio_or_zero(gap, spread).alias("cohens_d"),
        "control_n",
        "treatment_n",
    )


def incrementality_test(
    touches: DataFrame, channels: list[str], alpha: float = 0.05, holdout_pct: int = 20, seed: int = 42
) -> DataFrame:
    """X4-X6 with the equal-variance t-test's p-value."""
    table = incrementality(touches, channels, holdout_pct, seed)
    p = tails.t_two_sided(F.col("t_statistic"), F.col("control_n") + F.col("treatment_n") - 2)
    return table.withColumn("p_value", p).withColumn("significant", F.col("p_value") < alpha)


def _power_constant(alpha: float, power: float) -> float:
    return (dist.normal_quantile(1 - alpha / 2) + dist.normal_quantile(power)) ** 2


def method_effect_size(
    attributed: DataFrame,
    first: str = "shapley_attribution",
    second: str = "last_touch_attribution",
    alpha: float = 0.05,
    power: float = 0.8,
) -> DataFrame:
    """Cohen's d of two methods on converted touches, its reading, and the X8 size.

    The size per group is the normal approximation of the two-sample t-test.
    """
    m = attributed.filter(F.col("converted") == 1).agg(
        F.count(first).alias("n1"),
        F.count(second).alias("n2"),
        F.avg(first).alias("mean1"),
        F.avg(second).alias("mean2"),
        F.var_samp(first).alias("var1"),
        F.var_samp(second).alias("var2"),
    )
    pooled = F.sqrt(
        ratio(
            (F.col("n1") - 1) * F.col("var1") + (F.col("n2") - 1) * F.col("var2"), F.col("n1") + F.col("n2") - 2
        )
    )
    d = F.col("effect_size")
    return m.select(ratio(F.col("mean1") - F.col("mean2"), pooled).alias("effect_size")).withColumns(
        {
            "interpretation": F.when(F.abs(d) < 0.2, "Small").when(F.abs(d) < 0.5, "Medium").otherwise("Large"),
            "required_n": F.ceil(ratio(F.lit(2 * _power_constant(alpha, power)), d * d)),
        }
    )


def sample_sizes(
    touches: DataFrame, mde: float = 0.02, alpha: float = 0.05, power: float = 0.8, by: str = "channel"
) -> DataFrame:
    """Customers needed to see a change of ``mde`` in the conversion rate.

    One row for all customers and one per channel (or other column, such as the customer
    segment), each at its own baseline rate; the effect is mde / sqrt(p (1 - p)). Normal approximation, one- and two-sample.
    """
    pairs = touches.groupBy(by, "customer_id").agg(F.max("converted").alias("converted"))
    per_group = pairs.groupBy(F.col(by).cast("string").alias("scope")).agg(
        F.count(F.lit(1)).alias("customers"), F.avg("converted").alias("baseline_rate")
    )
    overall = (
        pairs.groupBy("customer_id")
        .agg(F.max("converted").alias("converted"))
        .agg(F.count(F.lit(1)).alias("customers"), F.avg("converted").alias("baseline_rate"))
        .select(F.lit("all").alias("scope"), "customers", "baseline_rate")
    )
    rate = F.col("baseline_rate")
    sized = overall.unionByName(per_group).withColumn(
        "effect_size", ratio(F.lit(mde), F.sqrt(rate * (1 - rate)))
    )
    need = ratio(F.lit(_power_constant(alpha, power)), F.col("effect_size") * F.col("effect_size"))
    return sized.withColumns({"one_sample_n": F.ceil(need), "two_sample_n": F.ceil(2 * need)})


# Poisson(1) draw from 32 random bits: the number of cumulative probabilities passed.
def poisson_thresholds(terms: int = 12) -> list[int]:
    cumulative, out = 0.0, []
    for k in range(terms):
        cumulative += math.exp(-1.0) / math.factorial(k)
        out.append(int(cumulative * 4294967296.0))
    return out


# Values are resampled in whole millionths.
UNITS = 1_000_000


def bootstrap_means(
    attributed: DataFrame,
    value: str = "shapley_attribution",
    replicates: int = 1000,
    seed: int = 42,
    blocks: int | None = None,
) -> DataFrame:
    """Bootstrap mean per channel with percentile interval and standard error.

    Every touch is resampled with a Poisson(1) weight of its own. Touches of one channel
    with the same value (to the millionth) are one row with their number n, and their
    weights add up to a Poisson(n) draw, so the work is bounded by distinct values, not
    touches. ``blocks`` asks for the coarser bootstrap of that many random groups of
    touches per channel, whose work does not grow with the data.
    """
    rows = attributed.filter(F.col(value).isNotNull())
    means = _touch_replicates(rows, value, replicates, seed) if blocks is None else _block_replicates(rows, value, replicates, blocks, seed)
    resampled = F.when(F.col("draw") > 0, F.col("mean"))
    return (
        means.groupBy("channel")
        .agg(
            F.max(F.when(F.col("draw") == 0, F.col("mean"))).alias("mean_attribution"),
            F.percentile(resampled, F.lit(0.025)).alias("ci_lower"),
            F.percentile(resampled, F.lit(0.975)).alias("ci_upper"),
            F.stddev_samp(resampled).alias("std_error"),
        )
        .orderBy(F.desc("mean_attribution"), "channel")
    )


def _touch_replicates(rows: DataFrame, value: str, replicates: int, seed: int) -> DataFrame:
    """(channel, draw, mean); draw 0 is the observed mean.

    One md5 gives the bits of four replicates. Draws never become rows: a task adds up all replicates of a channel and
    returns one row a replicate.
    """
    units = F.round(F.col(value) * UNITS).cast("long")
    counts = rows.groupBy("channel", units.alias("units")).agg(F.count(F.lit(1)).alias("n"))
    parts = counts.select("channel", "units", F.inline(poisson.rate_parts(F.col("n"))))
    key = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ("channel", "units", "level", "piece")])
    tasks = 4 * rows.sparkSession.sparkContext.defaultParallelism
    dealt = parts.repartition(tasks, "channel", "units", "level", "piece").sortWithinPartitions("channel")
    channel = rows.schema["channel"].dataType.simpleString()
    sums = dealt.select("channel", "units", "level", key.alias("key")).mapInArrow(
        _resampled(replicates), f"channel {channel}, draw int, w bigint, s double"
    )
    return sums.groupBy("channel", "draw").agg(ratio(F.sum("s") / UNITS, F.sum("w")).alias("mean"))


def _resampled(replicates: int):
    """Rows (channel, units, level, key), sorted by channel, to sums of weight and of weight times units by draw.

    Draw 0 gives every part its rate 2^level, the number of touches it stands for.
    """

    def run(batches):
        quads = [f"|{q}".encode() for q in range(-(-replicates // 4))]
        steps: dict[int, tuple] = {}
        at, draws = None, pa.array(range(replicates + 1), pa.int32())

        def out():
            return pa.RecordBatch.from_arrays([pa.array([at] * len(draws), kind), draws, pa.array(w), pa.array(s)], ["channel", "draw", "w", "s"])

        w = s = None
        for batch in batches:
            kind = batch.schema.field("channel").type
            for channel, units, level, key in zip(*(batch.column(c).to_pylist() for c in ("channel", "units", "level", "key")), strict=True):
                if w is None or channel != at:
                    if w is not None:
                        yield out()
                    at, w, s = channel, np.zeros(replicates + 1, np.int64), np.zeros(replicates + 1)
                if level not in steps:
                    steps[level] = poisson.thresholds(1 << level)
                low, passed = steps[level]
                start = key.encode()
                bits = np.frombuffer(b"".join([hashlib.md5(start + q).digest() for q in quads]), ">u4")[:replicates].astype(np.int64)
                drawn = np.concatenate([[1 << level], low + np.searchsorted(passed, bits, side="right")])
                w += drawn
                s += drawn * float(units)
        if w is not None:
            yield out()

    return run


def _block_replicates(rows: DataFrame, value: str, replicates: int, blocks: int, seed: int) -> DataFrame:
    """(channel, draw, mean) from Poisson(1) weights of random groups of touches.

    The weights are one byte per (block, replicate): a table whose size the parameters fix.
    """
    spark = rows.sparkSession
    tasks = spark.sparkContext.defaultParallelism
    block = F.pmod(hash_int(F.col("customer_id"), F.col("touchpoint_number")), F.lit(blocks)).cast("int")
    sums = rows.groupBy("channel", block.alias("block")).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"))
    # draw 0 gives every group weight 1: the observed mean comes out of the same pass
    drawn = F.transform(
        F.sequence(F.lit(-1), F.lit(replicates - 1)), lambda r: hash_int(F.lit(seed), F.col("block"), r)
    )
    passed = sum((F.when(F.col("bits") >= t, 1).otherwise(0) for t in poisson_thresholds()), F.lit(0))
    passed = F.when(F.col("draw") == 0, 1).otherwise(passed)
    weights = (
        spark.range(0, blocks, 1, min(tasks, blocks))
        .select(F.col("id").cast("int").alias("block"))
        .select("block", F.posexplode(drawn).alias("draw", "bits"))
        .groupBy("block")
        .agg(F.array_sort(F.collect_list(F.struct("draw", passed.cast("tinyint").alias("w")))).alias("draws"))
        .select("block", F.col("draws.w").alias("draws"))
    )
    return (
        sums.repartition(tasks, "channel", "block")
        .join(F.broadcast(weights), "block")
        .select("channel", "n", "s", F.posexplode("draws").alias("draw", "w"))
        .filter(F.col("w") > 0)
        .groupBy("channel", "draw")
        .agg(ratio(F.sum(F.col("w") * F.col("s")), F.sum(F.col("w") * F.col("n"))).alias("mean"))
    )


def revenue_intervals(touches: DataFrame, z: float = 1.96) -> DataFrame:
    """Normal interval of revenue per touch, with the population deviation."""
    stats = touches.groupBy("channel").agg(
        F.avg("revenue").alias("mean"), F.stddev_pop("revenue").alias("sd"), F.count("revenue").alias("n")
    )
    error = F.col("sd") / F.sqrt("n")
    return stats.select(
        "channel",
        "mean",
        (F.col("mean") - z * error).alias("ci_lower"),
        (F.col("mean") + z * error).alias("ci_upper"),
    )
