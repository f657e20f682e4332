"""Shapley attribution (H1-H6).

A coalition's worth v(S) is the conversion rate of the journeys whose channel set
contains S, 0 for coalitions nobody was seen with and for the empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from journeyloom.functions.dimensions import channels_of, freeze, join_dimension
from journeyloom.functions.journey_scope import CHUNK_TOUCHES
from journeyloom.functions.numeric import hash_int, ratio, roi, total
from journeyloom.operators.markov import channel_totals, share_out
from journeyloom.session import checkpointed

# Channels in one word of a mask, and words of a mask.
MASK_CHANNELS, MASK_WORDS = 62, 2
# Channels whose subsets one row may list.
LAYER = 12
# Most channels of one journey for exact values.
MAX_MEMBERS = 26
SAMPLES = 1000
# Sampled orders are broadcast up to this many channel places in all.
BROADCAST_PLACES = 5_000_000


def channel_sets(touches: DataFrame, channels: list[str]) -> DataFrame:
    """Journeys and conversions per distinct channel set, the input of both models.

    ``members`` holds positions in ``channels``. One pass reduces each journey to a bit
    mask (to an array of positions above 62 channels) and counts equal ones; everything
    after works on these rows instead of journeys.
    """
    n = len(channels)
    if n <= MASK_CHANNELS:
        bits = F.create_map(*[F.lit(x) for i, c in enumerate(channels) for x in (c, 1 << i)])
        located = touches
        mask = F.bit_or(F.element_at(bits, F.col("channel")).cast("long"))
        members = F.filter(F.lit(list(range(n))), lambda i: F.getbit("mask", i) == 1)
    else:
        positions = touches.sparkSession.createDataFrame(list(enumerate(channels)), "position int, channel string")
        located = join_dimension(touches, positions)
        mask = F.array_sort(F.collect_set("position"))
        members = F.col("mask")
    return (
        located.groupBy("customer_id")
        .agg(mask.alias("mask"), F.max("converted").alias("converted"))
        .groupBy("mask")
        .agg(F.count(F.lit(1)).alias("total"), F.sum("converted").alias("conversions"))
        .select(members.alias("members"), "total", "conversions")
    )


def _member_bits(members: Column, words: int) -> list[Column]:
    """Positions as bits of ``words`` longs of MASK_CHANNELS bits each."""

    def word(w: int) -> Column:
        low = w * MASK_CHANNELS
        here = F.filter(members, lambda i: (i >= low) & (i < low + MASK_CHANNELS))
        one = F.lit(1).cast("long")
        return F.aggregate(here, F.lit(0).cast("long"), lambda m, i: m.bitwiseOR(F.call_function("shiftleft", one, (i - low).cast("int"))))

    return [word(w).alias(f"word{w}") for w in range(words)]


def _submasks(word: str, bits: range) -> Column:
    """The masks that keep any of ``bits`` of a word and all its other bits."""
    inside = F.filter(F.lit(list(bits)), lambda i: F.getbit(word, i) == 1)
    rest = F.col(word).bitwiseAND(F.lit(~sum(1 << i for i in bits)))
    one = F.lit(1).cast("long")
    return F.aggregate(
        inside,
        F.array(rest),
        lambda found, i: F.concat(found, F.transform(found, lambda s: s.bitwiseOR(F.call_function("shiftleft", one, i.cast("int"))))),
    )


def _subsets(members: Column) -> Column:
    """All subsets of an array of at most LAYER positions."""
    return F.aggregate(
        members,
        F.array(F.array().cast("array<int>")),
        lambda found, i: F.concat(found, F.transform(found, lambda s: F.array_append(s, i.cast("int")))),
    )


def _summed(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.sum("total").alias("total"), F.sum("conversions").alias("conversions"))


def _coalitions(sets: DataFrame, n: int) -> DataFrame:
    """(members, total, conversions) of every subset of the channel sets.

    A row never lists more than 2^LAYER subsets. Sets of at most LAYER channels are expanded in one step. Larger ones are
    masks (one or two longs), and the subsets grow by layers of LAYER channels: what a layer gives is summed by mask and
    stored before the next, so the work follows the distinct coalitions, not the sum over the sets. Beyond the masks the
    members of each set are expanded LAYER at a time.
    """
    widest = n
    if n > LAYER:
        sets = checkpointed(sets)
        widest = sets.agg(F.max(F.size("members"))).first()[0] or 0
    if widest > MAX_MEMBERS:
        raise ValueError(
            f"a journey holds {widest} channels: exact values list its 2^{widest} coalitions, more than 2^{MAX_MEMBERS}; "
            "use mode='sampled' (shapley_sampled or shapley_stratified)"
        )
    words = -(-n // MASK_CHANNELS)
    if words > MASK_WORDS:
        table = sets.withColumn("found", F.array().cast("array<int>"))
        for first in range(1, max(widest, 1) + 1, LAYER):
            more = F.explode(_subsets(F.slice("members", first, LAYER)))
            table = table.withColumn("more", more).withColumn("found", F.concat("found", "more")).drop("more")
        return _summed(table.withColumn("members", F.col("found")), ["members"])
    key = [f"word{w}" for w in range(words)]
    table = sets.select(*_member_bits(F.col("members"), words), "total", "conversions")
    if n <= LAYER:
        table = _summed(table.withColumn("word0", F.explode(_submasks("word0", range(n)))), key)
    elif widest <= LAYER:
        subsets = sets.select(F.explode(_subsets(F.col("members"))).alias("members"), "total", "conversions")
        table = _summed(subsets.select(*_member_bits(F.col("members"), words), "total", "conversions"), key)
    else:
        for w in range(words):
            for low in range(0, min(MASK_CHANNELS, n - w * MASK_CHANNELS), LAYER):
                bits = range(low, min(low + LAYER, MASK_CHANNELS, n - w * MASK_CHANNELS))
                table = checkpointed(_summed(table.withColumn(key[w], F.explode(_submasks(key[w], bits))), key))
    return table.select(_positions(n), "total", "conversions", *key)


def _positions(n: int) -> Column:
    """The positions of the bits of the words."""
    return F.filter(F.lit(list(range(n))), lambda i: _bit(i, n) == 1).alias("members")


def _bit(i: Column, n: int) -> Column:
    bit = F.getbit("word0", F.least(i, F.lit(MASK_CHANNELS - 1)))
    if n > MASK_CHANNELS:
        bit = F.when(i < MASK_CHANNELS, bit).otherwise(F.getbit("word1", F.greatest(i - MASK_CHANNELS, F.lit(0))))
    return bit


def coalition_rates(
    touches: DataFrame | None, channels: list[str] | None = None, sets: DataFrame | None = None
) -> DataFrame:
    """H1: journeys, conversions and rate of every coalition seen, incl. the empty one.

    Only the distinct channel sets are expanded to their subsets, not the journeys, so the
    work follows the channels that meet in one journey, not their number in all. A journey
    of more than MAX_MEMBERS channels is an error.
    ``members`` holds positions in ``channels``; ``mask`` has their bits, and is NULL
    where a position does not fit.
    """
    channels = channels or channels_of(touches)
    sets = sets if sets is not None else channel_sets(touches, channels)
    rates = _coalitions(sets, len(channels)).withColumn("rate", ratio(F.col("conversions"), F.col("total")))
    small = F.coalesce(F.array_max("members"), F.lit(0)) < MASK_CHANNELS
    mask = F.col("word0") if "word0" in rates.columns else _member_bits(F.col("members"), 1)[0]
    names = F.transform("members", lambda i: F.element_at(F.lit(channels), i + 1))
    return rates.select("members", F.when(small, mask).alias("mask"), names.alias("coalition"), "total", "conversions", "rate")


def shapley_exact(
    touches: DataFrame | None, channels: list[str] | None = None, sets: DataFrame | None = None
) -> DataFrame:
    """H2, exact: the expectation the sampler estimates, as one weighted sum.

    Gathering the marginal contributions by coalition T gives channel i the weight
    w(|T|-1) if T holds i and -w(|T|) if not, with w(k) = k! (n-k-1)! / n! and w(n) = 0.
    Taking -w(|T|) v(T) over all T once, only the members of a coalition need a row:
    they get w(|T|-1) + w(|T|) on top. Coalitions nobody was seen with are worth 0.
    """
    channels = channels or channels_of(touches)
    n = len(channels)
    weights = F.lit([1 / (n * math.comb(n - 1, k)) for k in range(n)] + [0.0])
    size = F.size("members")
    worth = coalition_rates(touches, channels, sets).filter(size > 0).select("members", "rate", size.alias("k"))
    without, held = F.element_at(weights, F.col("k") + 1), F.element_at(weights, F.col("k"))
    # position -1 carries the sum that all channels share
    parts = worth.select(
        F.explode(
            F.concat(
                F.array(F.struct(F.lit(-1).alias("i"), (-without * F.col("rate")).alias("v"))),
                F.transform("members", lambda i: F.struct(i.cast("int").alias("i"), ((held + without) * F.col("rate")).alias("v"))),
            )
        ).alias("p")
    )
    sums = parts.groupBy("p.i").agg(F.sum("p.v").alias("v"))
    names = sets_session(touches, sets).createDataFrame(list(enumerate(channels)), "i int, channel string")
    shared = F.sum(F.when(F.col("i") == -1, F.col("v"))).over(Window.partitionBy(F.lit(0)))
    return (
        sums.join(names, "i", "full")
        .withColumn("_shared", F.coalesce(shared, F.lit(0.0)))
        .filter(F.col("i") >= 0)
        .select("channel", (F.coalesce("v", F.lit(0.0)) + F.col("_shared")).alias("raw_value"))
    )


def sets_session(touches: DataFrame | None, sets: DataFrame | None) -> SparkSession:
    return (touches if touches is not None else sets).sparkSession


def shapley_sampled(
    touches: DataFrame,
    n_samples: int = SAMPLES,
    seed: int = 42,
    channels: list[str] | None = None,
    sets: DataFrame | None = None,
) -> DataFrame:
    """H2, sampled: average marginal contribution over random channel orders.

    Works for any number of channels. A journey contains the first j channels of an
    order exactly when j is at most the length of the leading run that lies in its
    channel set, so each distinct set adds one run length per order it starts, and
    v of every prefix is a sum over runs. Orders come from a hash and are repeatable.
    """
    channels = channels or channels_of(touches)
    n = len(channels)
    spark = sets_session(touches, sets)
    sets = sets if sets is not None else channel_sets(touches, channels)
    gains = _marginals(sets, _orders(spark, n, n_samples, seed), n, n_samples)
    # a channel that no order could place in a seen coalition is worth 0
    none = spark.createDataFrame([(i, 0.0) for i in range(n)], "c int, gain double")
    return (
        gains.select("c", "gain")
        .unionByName(none)
        .groupBy("c")
        .agg((F.sum("gain") / n_samples).alias("raw_value"))
        .select(F.element_at(F.lit(channels), F.col("c") + 1).alias("channel"), "raw_value")
    )


def shapley_stratified(
    touches: DataFrame | None,
    n_orders: int = 100,
    seed: int = 42,
    channels: list[str] | None = None,
    sets: DataFrame | None = None,
) -> DataFrame:
    """H2, sampled by strata: channel, raw value and its standard error.

    Each of ``n_orders`` random orders is used in all its rotations, so every channel
    stands once at every place of it. The rotations of one order make one independent
    estimate; the standard error is that of their mean.
    """
    channels = channels or channels_of(touches)
    n = len(channels)
    spark = sets_session(touches, sets)
    sets = sets if sets is not None else channel_sets(touches, channels)
    turned = F.concat(F.slice("perm", F.col("turn") + 1, F.lit(n)), F.slice("perm", F.lit(1), F.col("turn")))
    orders = _orders(spark, n, n_orders, seed).withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    orders = orders.select((F.col("sample") * n + F.col("turn")).alias("sample"), turned.alias("perm")).withColumn("first", F.col("perm")[0])
    gains = _marginals(sets, orders, n, n_orders * n).select(F.floor(F.col("sample") / n).alias("base"), "c", "gain")
    # an order that places a channel in no seen coalition estimates 0 for it
    grid = spark.range(n_orders).select(F.col("id").alias("base"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("c"), F.lit(0.0).alias("gain"))
    estimates = gains.unionByName(grid).groupBy("base", "c").agg((F.sum("gain") / n).alias("estimate"))
    return (
        estimates.groupBy("c")
        .agg(F.avg("estimate").alias("raw_value"), (F.stddev_samp("estimate") / F.sqrt(F.count(F.lit(1)))).alias("std_error"))
        .select(F.element_at(F.lit(channels), F.col("c") + 1).alias("channel"), "raw_value", "std_error")
    )


def _orders(spark: SparkSession, n: int, count: int, seed: int) -> DataFrame:
    """(sample, perm, first): ``count`` random orders of ``n`` positions, by hash."""
    shuffled = F.array_sort(
        F.transform(
            F.sequence(F.lit(0), F.lit(n - 1)),
            lambda i: F.struct(hash_int(F.lit(seed), F.col("sample"), i).alias("h"), i.alias("i")),
        )
    )
    orders = spark.range(count).withColumnRenamed("id", "sample").select("sample", shuffled["i"].alias("perm"))
    return orders.withColumn("first", F.col("perm")[0])


def _marginals(sets: DataFrame, orders: DataFrame, n: int, n_samples: int) -> DataFrame:
    """(sample, c, gain): for each order, what v of its prefixes adds to and takes from each channel."""
    spark = sets.sparkSession
    # first place in the order that lies outside the set, or past its end
    inside = F.transform("perm", lambda c: F.array_contains("members", c))
    run = F.coalesce(F.nullif(F.array_position(inside, F.lit(False)), F.lit(0)), F.lit(n + 1)) - 1
    tasks = spark.sparkContext.defaultParallelism
    # n_samples orders of n small numbers: the size is known before any data is read
    small = n_samples * n <= BROADCAST_PLACES
    drawn = F.broadcast(orders) if small else orders
    # few channels start all orders: beyond a broadcast, orders are spread by sample
    salts = 1 if small else 64
    salt = F.pmod(F.col("sample"), F.lit(salts)).cast("int").alias("salt")
    runs = (
        sets.repartition(tasks, "members")
        .withColumn("first", F.explode("members"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        .join(drawn.select("*", salt), ["first", "salt"])
        .select("sample", run.alias("run"), "total", "conversions")
        .groupBy("sample", "run")
        .agg(F.sum("total").alias("total"), F.sum("conversions").alias("conversions"))
    )
    prefixes = (
        runs.select("sample", F.explode(F.sequence(F.lit(1), F.col("run"))).alias("j"), "total", "conversions")
        .groupBy("sample", "j")
        .agg(ratio(F.sum("conversions"), F.sum("total")).alias("v"))
    )
    # v(prefix j) counts for the channel that completes it and against the next one
    signed = prefixes.join(drawn, "sample").select(
        "sample",
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.col("perm")[F.col("j") - 1].alias("c"), F.col("v").alias("gain")),
                    F.when(
                        F.col("j") < n,
                        F.struct(F.get("perm", F.col("j")).alias("c"), (-F.col("v")).alias("gain")),
                    ),
                )
            )
        ).alias("m")
    )
    return signed.select("sample", "m.c", "m.gain")


def normalise(values: DataFrame) -> DataFrame:
    """H3: shift by a negative minimum, scale to sum 1, equal shares if all are 0."""
    low = F.min("raw_value").over(Window.partitionBy(F.lit(0)))
    shifted = values.withColumn("_s", F.col("raw_value") - F.when(low < 0, low).otherwise(0.0))
    everything = total(F.col("_s"))
    value = F.when(everything > 0, F.col("_s") / everything).otherwise(ratio(F.lit(1), total(F.lit(1))))
    return shifted.select("channel", "raw_value", value.alias("shapley_value"))


def shapley_values(
    touches: DataFrame,
    mode: str = "exact",
    n_samples: int = SAMPLES,
    seed: int = 42,
    channels: list[str] | None = None,
    sets: DataFrame | None = None,
) -> DataFrame:
    """H2 + H3: channel, raw value and normalised value.

    ``mode`` 'exact' expands each distinct channel set to its subsets, whatever the number
    of channels in all; 'sampled' (``n_samples`` random orders) estimates the same value
    and is the choice where single journeys hold dozens of different channels.
    """
    channels = channels or channels_of(touches)
    if mode == "exact":
        return normalise(shapley_exact(touches, channels, sets))
    if mode == "sampled":
        return normalise(shapley_sampled(touches, n_samples, seed, channels, sets))
    raise ValueError("mode must be 'exact' or 'sampled'")


def attribute_shapley(
    touches: DataFrame, values: DataFrame | None = None, chunk: int = CHUNK_TOUCHES
) -> DataFrame:
    """H4: ``shapley_attribution`` on every touch."""
    values = values if values is not None else shapley_values(touches)
    return share_out(touches, values, "shapley_value", "shapley_attribution", chunk)


def shapley_performance(
    touches: DataFrame, values: DataFrame | None = None, chunk: int = CHUNK_TOUCHES
) -> DataFrame:
    """H5: channel table of the Shapley model, largest attributed revenue first."""
    values = freeze(values if values is not None else shapley_values(touches))
    attributed = attribute_shapley(touches, values, chunk)
    # both sides have one row per channel: a plain join
    return (
        channel_totals(attributed, "shapley_attribution")
        .join(values.select("channel", "shapley_value"), "channel", "left")
        .withColumn("roi", roi(F.col("attributed_revenue"), F.col("cost")))
        .orderBy(F.desc("attributed_revenue"), "channel")
    )


def shapley_comparison(attributed: DataFrame) -> DataFrame:
    """H6: last touch, first touch and Shapley revenue by channel, NULL as 0."""
    revenue = F.col("revenue")
    return attributed.groupBy("channel").agg(
        F.coalesce(F.sum(F.when(F.col("converted") == 1, revenue)), F.lit(0.0)).alias("last_touch"),
        F.coalesce(F.sum(F.when(F.col("touchpoint_number") == 1, revenue)), F.lit(0.0)).alias("first_touch"),
        F.coalesce(F.sum("shapley_attribution"), F.lit(0.0)).alias("shapley"),
    )
