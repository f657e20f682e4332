"""All methods side by side, and what follows from their differences."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from journeyloom.functions.dimensions import channels_of, join_dimension, pin
from journeyloom.functions.journey_scope import CHUNK_TOUCHES, renumber, with_journey_totals
from journeyloom.functions.numeric import ranked_top, ratio, roi, total
from journeyloom.operators.markov import removal_effects_from_sets, shared_credit
from journeyloom.operators.rules import RULES, rule_credit
from journeyloom.operators.shapley import channel_sets, shapley_values

# Display names of the methods, in report order.
METHODS = {
    "shapley_attribution": "Shapley Value",
    "markov_attribution": "Markov Chain",
    "last_touch_attribution": "Last Touch",
    "first_touch_attribution": "First Touch",
    "linear_attribution": "Linear",
    "time_decay_attribution": "Time Decay",
    "position_based_attribution": "Position Based",
}


def attribute_all(
    touches: DataFrame,
    shapley: DataFrame | None = None,
    markov: DataFrame | None = None,
    chunk: int = CHUNK_TOUCHES,
) -> DataFrame:
    """The seven ``*_attribution`` columns.

    Both models are fitted on the distinct channel sets, found in one pass. The two
    channel-sized results meet in one small join, and all seven credits then come from
    a single further pass over the journeys.
    """
    if shapley is None or markov is None:
        channels = channels_of(touches)
        sets = pin(channel_sets(touches, channels))
        shapley = shapley if shapley is not None else shapley_values(touches, channels=channels, sets=sets)
        markov = markov if markov is not None else removal_effects_from_sets(sets, channels)
    fitted = shapley.select("channel", F.col("shapley_value").alias("_sh")).join(
        markov.select("channel", F.col("attribution_share").alias("_mk")), "channel", "full"
    )
    valued = join_dimension(touches, fitted).withColumns(
        {"_sh": F.coalesce("_sh", F.lit(0.0)), "_mk": F.coalesce("_mk", F.lit(0.0))}
    )
    totals = {
        "_converted": F.max("converted"),
        "_value": F.max("revenue"),
        "_sh_all": F.sum("_sh"),
        "_mk_all": F.sum("_mk"),
    }
    ready = with_journey_totals(renumber(valued, chunk), totals, chunk)
    return ready.select(
        *touches.columns,
        shared_credit("_sh", "_sh_all").alias("shapley_attribution"),
        shared_credit("_mk", "_mk_all").alias("markov_attribution"),
        *[rule_credit(r) for r in RULES],
    )


def with_attributions(touches: DataFrame, chunk: int = CHUNK_TOUCHES) -> DataFrame:
    """Touches that already carry all methods pass through, others are computed."""
    if all(m in touches.columns for m in METHODS):
        return touches
    return attribute_all(touches.drop(*METHODS), chunk=chunk)


def channel_credit(attributed: DataFrame) -> DataFrame:
    """Credit per method and cost, one row per channel."""
    return attributed.groupBy("channel").agg(*[F.sum(m).alias(m) for m in METHODS], F.sum("cost").alias("cost"))


def comparison(attributed: DataFrame) -> DataFrame:
    """One row per channel and method with cost and roi."""
    wide = channel_credit(attributed).withColumnsRenamed(METHODS)
    return wide.unpivot(["channel", "cost"], list(METHODS.values()), "method", "attributed_revenue").select(
        "channel",
        "method",
        "attributed_revenue",
        F.col("cost").alias("channel_cost"),
        roi(F.col("attributed_revenue"), F.col("cost")).alias("roi"),
    )


def _moments(values: list):
    array = F.array(*values)
    mean = F.aggregate(array, F.lit(0.0), lambda a, x: a + x) / len(values)
    squares = F.aggregate(array, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    return mean, squares / (len(values) - 1)


def attribution_summary(attributed: DataFrame, ref_compat: bool = False) -> DataFrame:
    """Methods as columns with variance, deviation, variation and average.

    ``ref_compat`` reproduces a quirk: the deviation then covers the seven methods and
    the variance, and the mean under the variation these eight and the deviation.
    """
    wide = channel_credit(attributed).drop("cost")
    methods = [F.coalesce(F.col(m), F.lit(0.0)) for m in METHODS]
    mean, variance = _moments(methods)
    out = wide.withColumn("variance", variance).withColumn("average", mean)
    if ref_compat:
        _, odd = _moments([*methods, F.col("variance")])
        out = out.withColumn("std_dev", F.sqrt(odd))
        base, _ = _moments([*methods, F.col("variance"), F.col("std_dev")])
    else:
        out = out.withColumn("std_dev", F.sqrt("variance"))
        base = F.col("average")
    return out.withColumn("cv", ratio(F.col("std_dev"), base)).orderBy(F.desc("average"), "channel")


def _advanced(attributed: DataFrame) -> DataFrame:
    return (
        channel_credit(attributed)
        .withColumn("advanced_avg", (F.col("shapley_attribution") + F.col("markov_attribution")) / 2)
        .withColumn("undervaluation", F.col("advanced_avg") - F.col("last_touch_attribution"))
        .select("channel", "cost", "advanced_avg", "undervaluation")
    )


def undervalued_channels(attributed: DataFrame, n: int = 3) -> DataFrame:
    """C4: channels the last touch credits least compared with the models."""
    found = _advanced(attributed).select("channel", "advanced_avg", "undervaluation")
    return ranked_top(found, n, F.desc("undervaluation"), F.asc("channel"))


def overvalued_channels(attributed: DataFrame, n: int = 3) -> DataFrame:
    """C4: channels the last touch credits most compared with the models."""
    found = _advanced(attributed).select("channel", "advanced_avg", "undervaluation")
    return ranked_top(found, n, F.asc("undervaluation"), F.asc("channel"))


def budget_reallocation(attributed: DataFrame) -> DataFrame:
    """Total cost redistributed by the models' share, minus today's cost."""
    share = ratio(F.col("advanced_avg"), total(F.col("advanced_avg")))
    return _advanced(attributed).select(
        "channel",
        "cost",
        (share * total(F.col("cost"))).alias("optimal_allocation"),
        (share * total(F.col("cost")) - F.col("cost")).alias("reallocation"),
    )


def high_roi_channels(attributed: DataFrame, n: int = 3) -> DataFrame:
    """Best roi on the models' average."""
    scored = _advanced(attributed).select(
        "channel", "advanced_avg", roi(F.col("advanced_avg"), F.col("cost")).alias("roi")
    )
    return ranked_top(scored, n, F.desc_nulls_last("roi"), F.asc("channel"))


def model_table(attributed: DataFrame, methods: list[str]) -> DataFrame:
    """Chosen methods in long form."""
    names = {m: METHODS[m] for m in methods}
    wide = attributed.groupBy("channel").agg(*[F.sum(m).alias(names[m]) for m in methods])
    return wide.unpivot(["channel"], list(names.values()), "model", "attribution")


def model_agreement(attributed: DataFrame, methods: list[str]) -> DataFrame:
    """Channel by model with the coefficient of variation, most agreed first."""
    wide = attributed.groupBy("channel").agg(*[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in methods])
    mean, variance = _moments([F.col(m) for m in methods])
    return wide.withColumn("coefficient_of_variation", ratio(F.sqrt(variance), mean)).orderBy(
        F.asc_nulls_last("coefficient_of_variation"), "channel"
    )


def roi_pivot(attributed: DataFrame) -> DataFrame:
    """Channel by method, roi in the cells, 0 where undefined."""
    wide = channel_credit(attributed)
    return wide.select(
        "channel", *[F.coalesce(roi(F.col(m), F.col("cost")), F.lit(0.0)).alias(m) for m in METHODS]
    )
