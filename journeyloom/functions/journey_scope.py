"""Journey-wide context for touches, safe for journeys of any length.

One customer may own a large share of all touches, so nothing here sends a whole
journey to one task. Positions (``touchpoint_number``) are dense, 1..n, and every
touch carries n (``total_touchpoints``). A journey therefore splits into chunks of
at most ``chunk`` consecutive positions by arithmetic on the row alone, and

* totals over a journey are windows over one chunk, plus a pre-aggregated table of
  the few journeys longer than a chunk, joined on (customer, chunk);
* neighbours are windows over one chunk that also receives copies of the touches
  next to its borders.

``number_touches`` records the longest journey it saw in the column metadata of
``total_touchpoints``. When that bound fits one chunk, the plans reduce to plain
windows on ``customer_id`` that share a single exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from journeyloom.session import checkpointed

CHUNK_TOUCHES = 500_000
BROADCAST_KEYS = 100_000
_BOUND = "longest_journey"


def longest_journey(df: DataFrame) -> int | None:
    """Known upper bound on journey length, or None."""
    return df.schema["total_touchpoints"].metadata.get(_BOUND)


def declare_longest_journey(df: DataFrame, touches: int) -> DataFrame:
    """Attach a known bound; it stays valid under filters and projections."""
    metadata = dict(df.schema["total_touchpoints"].metadata)
    metadata[_BOUND] = int(touches)
    return df.withMetadata("total_touchpoints", metadata)


def measure_longest_journey(df: DataFrame) -> DataFrame:
    """Read the bound from the data (one narrow job) and attach it."""
    top = df.agg(F.max("total_touchpoints")).first()[0] or 0
    return declare_longest_journey(df, top)


def fits(df: DataFrame, limit: int) -> bool:
    bound = longest_journey(df)
    return bound is not None and bound <= limit


def chunk_index(position: Column, chunk: int) -> Column:
    return F.floor((position - 1) / F.lit(chunk)).cast("long")


def with_journey_totals(df: DataFrame, totals: dict[str, Column], chunk: int = CHUNK_TOUCHES) -> DataFrame:
    """Add journey-level aggregates (max, min, sum, count) to every touch."""
    if fits(df, chunk):
        whole = Window.partitionBy("customer_id")
        return df.select("*", *[agg.over(whole).alias(name) for name, agg in totals.items()])

    pieces = df.withColumn("_chunk", chunk_index(F.col("touchpoint_number"), chunk))
    piece = Window.partitionBy("customer_id", "_chunk")
    rows = pieces.select("*", *[agg.over(piece).alias(name) for name, agg in totals.items()])
    last_chunk = chunk_index(F.max("total_touchpoints"), chunk)
    long = (
        df.filter(F.col("total_touchpoints") > chunk)
        .groupBy("customer_id")
        .agg(*[agg.alias(f"_long_{name}") for name, agg in totals.items()], last_chunk.alias("_last"))
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))))
        .drop("_last")
    )
    joined = rows.join(long, ["customer_id", "_chunk"], "left")
    is_long = F.col("total_touchpoints") > chunk
    return joined.select(
        *df.columns,
        *[F.when(is_long, F.col(f"_long_{name}")).otherwise(F.col(name)).alias(name) for name in totals],
    )


def with_neighbours(
    df: DataFrame,
    columns: dict[str, tuple[str, int]],
    position: str = "touchpoint_number",
    length: str = "total_touchpoints",
    chunk: int = CHUNK_TOUCHES,
) -> DataFrame:
    """Add the value of a column at a fixed distance: ``{out: (column, offset)}``.

    A positive offset looks ahead, a negative one back; NULL beyond the journey.
    """
    reach = max(abs(offset) for _, offset in columns.values())
    if reach >= chunk:
        raise ValueError("a chunk must be longer than the distance looked at")

    def looked_up(window):
        return [
            (F.lead(source, offset) if offset > 0 else F.lag(source, -offset)).over(window).alias(out)
            for out, (source, offset) in columns.items()
        ]

    # two extra steps leave room for the start and end states of a sequence
    if fits(df, chunk - 2):
        return df.select("*", *looked_up(Window.partitionBy("customer_id").orderBy(position)))

    home = chunk_index(F.col(position), chunk)
    inside = F.pmod(F.col(position) - 1, F.lit(chunk))
    copies = F.array_compact(
        F.array(
            home,
            F.when((inside < reach) & (home > 0), home - 1),
            F.when((inside >= chunk - reach) & ((home + 1) * chunk < F.col(length)), home + 1),
        )
    )
    spread = df.withColumn("_home", home).withColumn("_chunk", F.explode(copies))
    window = Window.partitionBy("customer_id", "_chunk").orderBy(position)
    return (
        spread.select("*", *looked_up(window)).filter(F.col("_chunk") == F.col("_home")).drop("_chunk", "_home")
    )


def renumber(df: DataFrame, chunk: int = CHUNK_TOUCHES) -> DataFrame:
    """Dense positions and lengths for any subset of numbered touches.

    Operators whose result depends on a touch being first or last call this on what they
    are given. It is part of the window over the customer that they need anyway.
    """
    missing = [c for c in ("touchpoint_number", "total_touchpoints") if c not in df.columns]
    if missing:
        raise KeyError(f"touches without {', '.join(missing)}: number_touches adds positions")
    order = F.col("touchpoint_number")
    if fits(df, chunk):
        whole = Window.partitionBy("customer_id")
        return df.withColumns(
            {
                "touchpoint_number": F.row_number().over(whole.orderBy(order)).cast("long"),
                "total_touchpoints": F.count(F.lit(1)).over(whole),
            }
        ).transform(lambda d: declare_longest_journey(d, longest_journey(df)))

    pieces = df.withColumn("_chunk", chunk_index(order, chunk))
    piece = Window.partitionBy("customer_id", "_chunk")
    local = pieces.withColumn("_local", F.row_number().over(piece.orderBy(order)).cast("long")).withColumn(
        "_in_chunk", F.count(F.lit(1)).over(piece)
    )
    # one row per chunk of a long journey: its size, the sizes before it and their sum
    counts = (
        pieces.filter(F.col("total_touchpoints") > chunk)
        .groupBy("customer_id", "_chunk")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    per_customer = Window.partitionBy("customer_id")
    offsets = counts.select(
        "customer_id",
        "_chunk",
        (F.sum("_rows").over(per_customer.orderBy("_chunk")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(per_customer).alias("_all"),
    )
    joined = local.join(offsets, ["customer_id", "_chunk"], "left")
    return joined.withColumns(
        {
            "touchpoint_number": F.col("_local") + F.coalesce("_before", F.lit(0)),
            "total_touchpoints": F.coalesce("_all", "_in_chunk"),
        }
    ).select(*df.columns)


def number_touches(
    df: DataFrame,
    order: list[str],
    key: str = "customer_id",
    chunk: int = CHUNK_TOUCHES,
    rows_per_range: int | None = None,
) -> DataFrame:
    """Add ``touchpoint_number`` and ``total_touchpoints`` by the given order.

    ``order`` must end in a column that is unique within a customer. A first narrow
    job counts touches per key. Keys of at most ``chunk`` touches are numbered by one
    window. Larger keys are split over many tasks by range partitioning on
    (key, order), frozen by a checkpoint so that partition numbers hold still, and
    numbered per range with the sizes of the earlier ranges added.
    """
    plain = df.drop("touchpoint_number", "total_touchpoints")
    sizes = plain.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    longest = sizes.agg(F.max("_n")).first()[0] or 0
    by_order = [F.col(c) for c in order]

    def by_window(rows: DataFrame) -> DataFrame:
        whole = Window.partitionBy(key)
        return rows.select(
            "*",
            F.row_number().over(whole.orderBy(*by_order)).cast("long").alias("touchpoint_number"),
            F.count(F.lit(1)).over(whole).alias("total_touchpoints"),
        )

    if longest <= chunk:
        return declare_longest_journey(by_window(plain), longest)

    hot = checkpointed(sizes.filter(F.col("_n") > chunk))
    keys, hot_rows = hot.agg(F.count(F.lit(1)), F.sum("_n")).first()
    cold = by_window(_pick(plain, hot, key, order, keys, "left_anti"))

    ranges = max(2, -(-hot_rows // (rows_per_range or chunk)))
    frozen = checkpointed(
        _pick(plain, hot, key, order, keys, "left_semi")
        .repartitionByRange(int(ranges), key, *order)
        .withColumn("_range", F.spark_partition_id())
    )
    per_key = Window.partitionBy(key)
    sizes_by_range = frozen.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes_by_range.select(
        key,
        "_range",
        (F.sum("_rows").over(per_key.orderBy("_range")) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(per_key).alias("total_touchpoints"),
    )
    in_range = Window.partitionBy(key, "_range").orderBy(*by_order)
    numbered = (
        frozen.withColumn("_local", F.row_number().over(in_range).cast("long"))
        .join(offsets, [key, "_range"])
        .select(
            *plain.columns,
            (F.col("_local") + F.col("_before")).alias("touchpoint_number"),
            "total_touchpoints",
        )
    )
    return declare_longest_journey(cold.unionByName(numbered), longest)


def _pick(df: DataFrame, hot: DataFrame, key: str, order: list[str], keys: int, how: str) -> DataFrame:
    """Semi/anti join with the hot keys: broadcast up to a checked count, else salted."""
    if keys <= BROADCAST_KEYS:
        return df.join(F.broadcast(hot.select(key)), key, how)
    salts = 64
    salted = hot.select(key, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    rows = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    return rows.join(salted, [key, "_salt"], how).drop("_salt")
