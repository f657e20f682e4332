"""The touchpoint table: one explicit schema and the normaliser that enforces it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Default marketing channels and their unit cost per touch.
CHANNEL_COST = {
    "organic_search": 0.0,
    "paid_search": 2.5,
    "social_media": 1.5,
    "email": 0.1,
    "display": 0.8,
    "affiliate": 5.0,
    "direct": 0.0,
    "referral": 0.0,
    "video": 3.0,
    "retargeting": 4.0,
}
CHANNELS = list(CHANNEL_COST)

# Device names.
DEVICES = ["desktop", "mobile", "tablet"]

# States the Markov chain adds around a journey.
START, CONVERSION, NULL = "start", "conversion", "null"
RESERVED_STATES = (START, CONVERSION, NULL)
# State of touches whose channel is missing: such a touch is a step of its journey like any other.
NO_CHANNEL = "(none)"

TOUCHPOINT_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("channel", T.StringType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("campaign_type", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("touchpoint_number", T.IntegerType()),
        T.StructField("total_touchpoints", T.IntegerType()),
        T.StructField("time_on_site", T.DoubleType()),
        T.StructField("pages_viewed", T.IntegerType()),
        T.StructField("cost", T.DoubleType()),
        T.StructField("converted", T.IntegerType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("customer_segment", T.StringType()),
    ]
)

REQUIRED = (
    "customer_id",
    "timestamp",
    "channel",
    "device",
    "time_on_site",
    "pages_viewed",
    "cost",
    "converted",
    "revenue",
)


def conform(df: DataFrame) -> DataFrame:
    """Cast a touch table to the model types.

    ``converted`` may arrive as boolean, number or text ("True", "1", "1.0", ...); text
    that is neither fails the job, a missing value counts as not converted. Touches
    without a customer belong to no journey and are left out. A missing channel becomes NO_CHANNEL. A channel named like a Markov
    state fails the job when its row is read: the two could not be told apart.
    """
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise KeyError(f"touchpoint columns missing: {missing}")
    types = {f.name: f.dataType for f in TOUCHPOINT_SCHEMA if f.name != "customer_id"}
    channel = F.when(
        F.col("channel").isin(*RESERVED_STATES),
        F.raise_error(F.concat(F.lit("reserved channel name: "), F.col("channel"))),
    ).otherwise(F.coalesce(F.col("channel"), F.lit(NO_CHANNEL)))
    # position counters stay wide: a journey may be longer than an int can count
    types["touchpoint_number"] = types["total_touchpoints"] = T.LongType()
    columns = []
    for name in df.columns:
        source = channel if name == "channel" else F.col(name)
        if name == "converted" and isinstance(df.schema[name].dataType, T.StringType):
            source = _flag(source)
        elif name == "converted":
            source = F.coalesce(source.cast("int"), F.lit(0))
        columns.append(source.cast(types[name]).alias(name) if name in types else source.alias(name))
    return df.filter(F.col("customer_id").isNotNull()).select(*columns)


def flag_or_null(text: Column) -> Column:
    """0 or 1 from the text of a boolean or a number, 0 for none; NULL for anything else."""
    word = F.lower(F.trim(text))
    number = F.when(word.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?$"), word.cast("double"))
    return (
        F.when(word.isNull() | (word == "") | word.isin("false", "f", "no", "n"), 0)
        .when(word.isin("true", "t", "yes", "y"), 1)
        .when(number.isin(0.0, 1.0), number.cast("int"))
    )


def _flag(text: Column) -> Column:
    """0 or 1 from the text of a boolean or a number; anything else fails the job."""
    wrong = F.raise_error(F.concat(F.lit("converted is neither 0 nor 1: "), text)).cast("int")
    return F.coalesce(flag_or_null(text), wrong)
