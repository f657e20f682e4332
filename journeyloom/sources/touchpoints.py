"""Readers of touchpoint tables and adapters that build them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from journeyloom.functions.journey_scope import number_touches
from journeyloom.functions.numeric import hash_unit
from journeyloom.schema import CHANNEL_COST, CHANNELS, DEVICES, RESERVED_STATES, TOUCHPOINT_SCHEMA, conform, flag_or_null

_RECORD = "_record"


def read_touchpoints(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType = TOUCHPOINT_SCHEMA,
    customer_type: T.DataType | None = None,
    strict: bool = False,
) -> DataFrame:
    """Touches from CSV with a header, or Parquet; typed, never inferred.

    Rows that cannot be touches are left out; ``rejected_touches`` gives them with their
    reasons. With ``strict`` a line or cell that its type cannot hold fails the job
    instead, and only rows without a customer are left out. CSV columns may come in any
    order, the same in all files of a folder: a file whose header differs fails the job.
    Columns the schema lacks are kept as strings. Customer ids from CSV are strings
    unless ``customer_type`` says otherwise.
    """
    if strict:
        return conform(_strict_touches(spark, path, fmt, schema, customer_type))
    return sort_touches(spark, path, fmt, schema, customer_type)[0]


def rejected_touches(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType = TOUCHPOINT_SCHEMA,
    customer_type: T.DataType | None = None,
) -> DataFrame:
    """The rows that ``read_touchpoints`` leaves out, as they came, with ``reasons`` (array) and ``record``.

    ``record`` is the text of a CSV line that does not have the header's fields, else NULL.
    """
    return sort_touches(spark, path, fmt, schema, customer_type)[1]


def reject_counts(rejected: DataFrame) -> DataFrame:
    """Rejected rows by reason; a row with two reasons counts for both."""
    return rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def sort_touches(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType = TOUCHPOINT_SCHEMA, customer_type: T.DataType | None = None
) -> tuple[DataFrame, DataFrame]:
    """Accepted touches and rejected rows of one folder."""
    raw = _text_touches(spark, path) if fmt == "csv" else _strict_touches(spark, path, fmt, schema, customer_type)
    types = {f.name: f.dataType for f in schema}
    types["touchpoint_number"] = types["total_touchpoints"] = T.LongType()
    types["customer_id"] = customer_type or (T.StringType() if fmt == "csv" else raw.schema["customer_id"].dataType)
    values = {c: typed(c, raw.schema[c].dataType, types[c]) for c in raw.columns if c in types}
    columns = [c for c in raw.columns if c != _RECORD]
    if _RECORD not in raw.columns:
        raw = raw.withColumn(_RECORD, F.lit(None).cast("string"))

    def given(name: str) -> Column:
        text = isinstance(raw.schema[name].dataType, T.StringType)
        return F.col(name).isNotNull() & (F.trim(name) != "") if text else F.col(name).isNotNull()

    reasons = [F.when(F.col(_RECORD).isNotNull(), F.lit("line: other fields than the header"))]
    reasons += [F.when(given(c) & v.isNull(), F.lit(f"{c}: not a {types[c].simpleString() if c != 'converted' else 'flag'}")) for c, v in values.items()]
    reasons.append(F.when(~given("customer_id"), F.lit("customer_id: missing")))
    reasons.append(F.when(F.col("channel").isin(*RESERVED_STATES), F.lit("channel: reserved name")))
    judged = raw.withColumn("reasons", F.array_compact(F.array(*reasons)))
    fine = F.size("reasons") == 0
    accepted = judged.filter(fine).select(*[values.get(c, F.col(c)).alias(c) for c in columns])
    rejected = judged.filter(~fine).select(*columns, "reasons", F.col(_RECORD).alias("record"))
    return conform(accepted), rejected


def typed(name: str, given: T.DataType, wanted: T.DataType) -> Column:
    """A column in the wanted type, NULL where its value does not fit."""
    value = F.col(name)
    if not isinstance(given, T.StringType):
        return value if given == wanted or name == "converted" else value.try_cast(wanted)
    if name == "converted":
        return flag_or_null(value)
    if isinstance(wanted, T.StringType):
        return value
    number = F.trim(value).try_cast("double")
    if isinstance(wanted, T.IntegralType):
        # "3" and "3.0" are whole numbers, "3.5" is none
        whole = F.when(number == F.floor(number), number.try_cast(wanted))
        return F.coalesce(F.trim(value).try_cast(wanted), whole)
    if isinstance(wanted, T.DoubleType):
        return F.when(F.abs(number) < float("inf"), number)
    return F.trim(value).try_cast(wanted)


def _text_touches(spark: SparkSession, path: str) -> DataFrame:
    """CSV cells as text; a line with other fields than the header has it whole in _RECORD."""
    header = spark.read.option("header", True).csv(path).columns
    given = T.StructType([T.StructField(n, T.StringType()) for n in [*header, _RECORD]])
    lenient = {
        "header": True,
        "enforceSchema": False,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _RECORD,
        # a line is judged by all of its fields, whatever columns a query reads
        "columnPruning": False,
    }
    return spark.read.schema(given).options(**lenient).csv(path)


def _strict_touches(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType, customer_type: T.DataType | None
) -> DataFrame:
    if fmt == "csv":
        header = spark.read.option("header", True).csv(path).columns
        known = {f.name: f.dataType for f in schema}
        known["converted"] = T.StringType()  # "True" in generated files, "1" or "1.0" in others
        known["customer_id"] = customer_type or T.StringType()
        given = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in header])
        return spark.read.schema(given).options(header=True, enforceSchema=False, mode="FAILFAST").csv(path)
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown touchpoint format: {fmt}")


def _pick(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index + 1)


def events_to_touchpoints(events: DataFrame, numbered: bool = True) -> DataFrame:
    """Touches from an event stream: one journey per user and calendar day.

    Numbering costs a pass over the data; without it the touches have no positions.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    channel = _pick(CHANNELS, k % 10)
    cost = F.element_at(F.create_map(*[F.lit(v) for kv in CHANNEL_COST.items() for v in kv]), channel)
    purchase = F.col("event_type") == "purchase"
    touches = events.select(
        (F.col("user_id") * 100000 + F.unix_date(F.to_date("ts"))).cast("long").alias("customer_id"),
        F.concat(F.lit("e"), F.col("event_id")).alias("session_id"),
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        channel.alias("channel"),
        _pick(DEVICES, (F.floor(k / 10) % 3).cast("int")).alias("device"),
        (F.col("value") * 10).alias("time_on_site"),
        (k % 7 + 1).alias("pages_viewed"),
        cost.alias("cost"),
        F.when(purchase, 1).otherwise(0).alias("converted"),
        F.when(purchase, F.col("value")).otherwise(0.0).alias("revenue"),
    )
    touches = conform(touches)
    if numbered:
        touches = number_touches(touches, ["timestamp", "event_id"])
    return touches.drop("event_id")


def events_to_ga_sessions(events: DataFrame) -> DataFrame:
    """Session rows in the web-analytics export layout, one per event."""
    k = F.get_json_object("props", "$.k").cast("int")
    purchase = F.col("event_type") == "purchase"
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.col("user_id").cast("string").alias("fullVisitorId"),
        F.col("event_id").alias("visitNumber"),
        F.date_format(ts, "yyyyMMdd").cast("int").alias("date"),
        (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("long").alias("visitStartTime"),
        _pick(CHANNELS, k % 10).alias("channel"),
        _pick(DEVICES, (F.floor(k / 10) % 3).cast("int")).alias("deviceCategory"),
        F.when(F.col("event_type") != "error", F.col("value") * 10).alias("timeOnSite"),
        F.when(k % 7 != 6, (k % 7 + 1).cast("double")).alias("pageviews"),
        F.when(purchase, F.lit(1.0)).alias("transactions"),
        F.when(purchase, F.col("value")).alias("revenue"),
    )


def ga_sessions_to_touchpoints(ga: DataFrame, cost: Column | None = None, offset: str = "seconds") -> DataFrame:
    """S2 (with J2, J3): web-analytics sessions to numbered touches.

    ``visitStartTime`` is added to the date as seconds (``offset='seconds'``); exports
    that store epoch seconds there are read with ``offset='epoch'``. Sessions carry no
    cost, so the caller gives a column; by default a repeatable draw from 0.5 to 5.
    """
    if offset not in ("seconds", "epoch"):
        raise ValueError("offset must be 'seconds' or 'epoch'")
    touch_id = F.concat_ws("_", "fullVisitorId", F.col("visitNumber").cast("string"))
    midnight = F.to_timestamp(F.col("date").cast("string"), "yyyyMMdd")
    when = (
        F.timestamp_seconds(F.unix_timestamp(midnight) + F.col("visitStartTime"))
        if offset == "seconds"
        else F.timestamp_seconds("visitStartTime")
    )
    touches = ga.select(
        F.col("fullVisitorId").alias("customer_id"),
        touch_id.alias("session_id"),
        "visitNumber",
        "channel",
        when.alias("timestamp"),
        F.col("deviceCategory").alias("device"),
        (cost if cost is not None else 0.5 + 4.5 * hash_unit(touch_id)).alias("cost"),
        F.coalesce("timeOnSite", F.lit(0.0)).alias("time_on_site"),
        F.coalesce("pageviews", F.lit(1.0)).cast("int").alias("pages_viewed"),
        F.when(F.col("transactions") > 0, 1).otherwise(0).alias("converted"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
    )
    numbered = number_touches(conform(touches), ["timestamp", "visitNumber", "session_id"])
    return numbered.drop("visitNumber")
