"""Long journeys: chunked plans give what whole-journey windows give."""

import math
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from journeyloom.functions import journey_scope as scope
from journeyloom.operators import compare, journeys, markov, paths, rules, shapley

from touch_data import SCHEMA, by_touch, random_journeys

LENGTHS = [1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 40, 41, 1, 3]


@pytest.fixture(scope="module")
def rows():
    return random_journeys(LENGTHS)


@pytest.fixture(scope="module")
def long(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def bounded(long):
    return scope.declare_longest_journey(long, max(LENGTHS))


@pytest.mark.parametrize("chunk", [2, 3, 4, 7, 40])
def test_totals(long, bounded, chunk):
    totals = {"m": F.max("revenue"), "s": F.sum("cost"), "n": F.count(F.lit(1)), "c": F.max("converted")}
    a = by_touch(scope.with_journey_totals(long, totals, chunk), *totals)
    b = by_touch(scope.with_journey_totals(bounded, totals), *totals)
    assert a.keys() == b.keys() and len(a) == sum(LENGTHS)
    for key in a:
        assert a[key] == pytest.approx(b[key])


@pytest.mark.parametrize("chunk", [2, 3, 5, 20])
def test_neighbours(long, rows, chunk):
    got = by_touch(journeys.enrich_touches(long, chunk), "prev_channel", "next_channel", "time_since_prev")
    channel = {(r[0], r[5]): r[3] for r in rows}
    assert len(got) == len(rows)
    for (c, p), (before, after, seconds) in got.items():
        assert before == channel.get((c, p - 1)) and after == channel.get((c, p + 1))
        assert seconds == (60 if p > 1 else 0)


@pytest.mark.parametrize("order, chunk", [(1, 2), (1, 4), (2, 3), (3, 5), (2, 50)])
def test_transitions(long, rows, order, chunk):
    sequences, ended = {}, {}
    for r in sorted(rows, key=lambda r: (r[0], r[5])):
        sequences.setdefault(r[0], ["start"]).append(r[3])
        ended[r[0]] = ended.get(r[0], 0) or r[10]
    expected = Counter()
    for c, s in sequences.items():
        s = [*s, "conversion" if ended[c] else "null"]
        for i in range(len(s) - order):
            source = s[i] if order == 1 else tuple(s[i : i + order])
            expected[source, s[i + order]] += 1
    got = {
        (r["from_state"] if order == 1 else tuple(r["from_state"]), r["to_state"]): r["count"]
        for r in markov.transitions(long, order, chunk).collect()
    }
    assert got == dict(expected)


@pytest.mark.parametrize("chunk", [3, 10])
def test_attribution_methods(long, bounded, chunk):
    a = by_touch(compare.attribute_all(long, chunk=chunk), *compare.METHODS)
    b = by_touch(compare.attribute_all(bounded), *compare.METHODS)
    assert a.keys() == b.keys()
    for key in a:
        assert a[key] == pytest.approx(b[key], abs=1e-9)


def test_time_decay_against_plain_weights(long, rows):
    got = by_touch(rules.attribute_rules(long, ["time_decay"], chunk=4), "time_decay_attribution")
    journeys_ = {}
    for r in rows:
        journeys_.setdefault(r[0], []).append(r)
    for c, touches in journeys_.items():
        n = len(touches)
        value = max(t[11] for t in touches) if any(t[10] for t in touches) else 0
        weights = [0.7 ** (n - i - 1) for i in range(n)]
        for i, w in enumerate(weights):
            assert got[c, i + 1][0] == pytest.approx(value * w / sum(weights))


@pytest.mark.parametrize("chunk", [3, 100])
def test_renumber(long, rows, chunk):
    picked = scope.renumber(long.filter("channel = 'email'"), chunk)
    got = {(r["customer_id"], r["session_id"]): (r["touchpoint_number"], r["total_touchpoints"]) for r in picked.collect()}
    expected, seen = {}, Counter()
    chosen = [r for r in sorted(rows, key=lambda r: (r[0], r[5])) if r[3] == "email"]
    sizes = Counter(r[0] for r in chosen)
    for r in chosen:
        seen[r[0]] += 1
        expected[r[0], r[1]] = (seen[r[0]], sizes[r[0]])
    assert got == expected


@pytest.mark.parametrize("chunk, rows_per_range", [(1000, None), (10, None), (5, 3), (39, 7)])
def test_number_touches(spark, rows, chunk, rows_per_range):
    mixed = rows[:]
    random.Random(3).shuffle(mixed)
    raw = spark.createDataFrame(mixed, SCHEMA).drop("touchpoint_number", "total_touchpoints").repartition(6)
    # many touches share one timestamp, so the order rests on the tie-break
    tied = raw.withColumn("timestamp", F.date_trunc("hour", "timestamp")).withColumn(
        "tie", F.split("session_id", "-")[1].cast("int")
    )
    numbered = scope.number_touches(tied, ["timestamp", "tie"], chunk=chunk, rows_per_range=rows_per_range)
    got = {r["session_id"]: (r["touchpoint_number"], r["total_touchpoints"]) for r in numbered.collect()}
    assert got == {r[1]: (r[5], r[6]) for r in rows}
    assert scope.longest_journey(numbered) == max(LENGTHS)
    # the join with the hot keys gives the same rows when they are too many to broadcast
    if chunk == 5:
        scope_keys, scope.BROADCAST_KEYS = scope.BROADCAST_KEYS, 1
        try:
            salted = scope.number_touches(tied, ["timestamp", "tie"], chunk=chunk, rows_per_range=rows_per_range)
            again = {r["session_id"]: (r["touchpoint_number"], r["total_touchpoints"]) for r in salted.collect()}
        finally:
            scope.BROADCAST_KEYS = scope_keys
        assert again == got


def test_long_paths_keep_their_groups(spark):
    base = random_journeys([6, 6, 3, 8])
    # customer 5 repeats customer 4's long path, customer 6 changes one step of it
    fourth = [r for r in base if r[0] == 4]
    twin = [(5, f"t{r[5]}", *r[2:]) for r in fourth]
    other = [(6, f"o{r[5]}", r[2], "video" if r[5] == 2 else r[3], *r[4:]) for r in fourth]
    touches = spark.createDataFrame(base + twin + other, SCHEMA)
    keyed = paths.pattern_keys(touches).collect()
    whole = paths.path_patterns(touches).collect()
    assert sorted(r["frequency"] for r in whole) == sorted(r["frequency"] for r in keyed) == [1, 1, 1, 1, 2]
    assert {(r["path_length"], r["path_key"]) for r in keyed} == {(r["path_length"], r["path_key"]) for r in whole}
    assert len({r["path_key"] for r in keyed}) == 5 and {len(r["path_key"]) for r in keyed} == {32}
    for n in (None, 2):
        a = paths.converting_keys(touches, n).collect()
        b = paths.converting_paths(touches, n).collect()
        assert sorted((r["count"], r["total_revenue"]) for r in a) == sorted((r["count"], r["total_revenue"]) for r in b)
    a = paths.conversion_touch_keys(touches, chunk=3).collect()
    b = paths.conversion_touch_paths(touches).collect()
    assert sorted((r["conversions"], r["total_revenue"]) for r in a) == sorted(
        (r["conversions"], r["total_revenue"]) for r in b
    )


@pytest.mark.parametrize("chunk", [1, 4, 1000])
def test_chunks_are_the_whole_path_and_sequence(long, chunk):
    keys = paths.journey_keys(long)
    steps = {}
    for r in sorted(paths.path_steps(long, keys, chunk).collect(), key=lambda r: r["chunk"]):
        assert len(r["steps"].split(" -> ")) <= chunk
        steps.setdefault((r["path_length"], r["path_key"]), []).append(r["steps"])
    channels = {}
    for r in long.orderBy("customer_id", "touchpoint_number").select("customer_id", "channel").collect():
        channels.setdefault(r[0], []).append(r[1])
    got = {r["customer_id"]: " -> ".join(steps[r["path_length"], r["path_key"]]) for r in keys.collect()}
    assert got == {c: " -> ".join(x) for c, x in channels.items()}
    states, pieces = {}, {}
    for r in sorted(journeys.journey_states(long, chunk=4).collect(), key=lambda r: r["step"]):
        states.setdefault(r["customer_id"], []).append(r["state"])
    for r in sorted(paths.sequence_chunks(long, chunk).collect(), key=lambda r: r["chunk"]):
        assert len(r["states"]) <= chunk
        pieces.setdefault(r["customer_id"], []).extend(r["states"])
    assert pieces == states == {r["customer_id"]: r["sequence"] for r in paths.journey_sequences(long).collect()}


def test_one_customer_with_a_third_of_three_million_touches(spark):
    """No row grows with the customer: keys have a fixed size, chunks at most CHUNK_STEPS steps."""
    n, hot = 3_000_000, 1_000_000
    touch = F.col("id")
    rows = spark.range(0, n, 1, 16).select(
        F.when(touch < hot, 0).otherwise(1 + F.floor((touch - hot) / 4)).cast("long").alias("customer_id"),
        F.when(touch < hot, touch + 1).otherwise((touch - hot) % 4 + 1).cast("long").alias("touchpoint_number"),
        F.when(touch < hot, hot).otherwise(4).cast("long").alias("total_touchpoints"),
        F.concat(F.lit("c"), (touch * 7 % 13 % 5).cast("string")).alias("channel"),
        F.lit(1).alias("converted"),
        F.lit(2.0).alias("revenue"),
    )
    patterns = paths.pattern_keys(rows).orderBy("path_length").collect()
    assert sum(r["frequency"] for r in patterns) == 500_001 and patterns[-1]["path_length"] == hot
    assert {r["path_length"] for r in patterns[:-1]} == {4} and len(patterns) <= 14
    steps = paths.path_steps(rows, paths.journey_keys(rows)).filter(F.col("path_length") == hot)
    count, longest, last = steps.agg(F.count("*"), F.max(F.length("steps")), F.max("chunk")).first()
    assert (count, last) == (1000, 999) and longest == 1000 * 2 + 999 * 4


def test_flow_edges(long, rows):
    got = {(r["source"], r["target"]): r["value"] for r in markov.flow_edges(long, None, chunk=5).collect()}
    expected, ended = Counter(), {}
    channel = {(r[0], r[5]): r[3] for r in rows}
    for r in rows:
        ended[r[0]] = ended.get(r[0], 0) or r[10]
    for (c, p), name in channel.items():
        after = channel.get((c, p + 1))
        end = "Conversion" if ended[c] else "No Conversion"
        expected[f"{name}_{p - 1}", f"{after}_{p}" if after else end] += 1
    assert got == dict(expected)


def test_measured_bound(long):
    assert scope.longest_journey(long) is None
    measured = scope.measure_longest_journey(long)
    assert scope.longest_journey(measured) == max(LENGTHS)
    assert scope.longest_journey(measured.filter("channel = 'email'").select("customer_id", "total_touchpoints")) == 41


@pytest.mark.parametrize("sources", [40, 90])
def test_sampled_shapley_on_many_channels(spark, sources):
    rng = random.Random(5)
    rows = [(r[0], r[1], r[2], f"src{rng.randint(0, sources - 1)}", *r[4:]) for r in random_journeys([4] * 100)]
    touches = spark.createDataFrame(rows, SCHEMA)
    values = shapley.shapley_values(touches, mode="sampled", n_samples=200)
    shares = {r["channel"]: r["shapley_value"] for r in values.collect()}
    channels = {r[3] for r in rows}
    assert set(shares) == channels and sum(shares.values()) == pytest.approx(1.0)
    # exact values by their definition: marginal contributions over the coalitions that matter
    journeys = {}
    for r in touches.collect():
        seen, won = journeys.setdefault(r["customer_id"], (set(), []))
        seen.add(r["channel"])
        won.append(r["converted"])
    counts = {}
    for seen, won in journeys.values():
        for k in range(len(seen) + 1):
            for coalition in combinations(sorted(seen), k):
                n, c = counts.get(coalition, (0, 0))
                counts[coalition] = (n + 1, c + max(won))
    worth = {t: c / n for t, (n, c) in counts.items() if t}
    n = len(channels)
    want = dict.fromkeys(channels, 0.0)
    for t, v in worth.items():
        for i in channels:
            if i in t:
                want[i] += v / (n * math.comb(n - 1, len(t) - 1))
            elif len(t) < n:
                want[i] -= v / (n * math.comb(n - 1, len(t)))
    exact = {r["channel"]: r["raw_value"] for r in shapley.shapley_values(touches).collect()}
    assert exact == pytest.approx(want, abs=1e-9)


def test_wide_sets_equal_masked_sets(long, monkeypatch):
    channels = sorted(r[0] for r in long.select("channel").distinct().collect())

    def collected():
        return {tuple(r["members"]): (r["total"], r["conversions"]) for r in shapley.channel_sets(long, channels).collect()}

    masked = collected()
    exact = {r["channel"]: r["raw_value"] for r in shapley.shapley_exact(long, channels).collect()}
    monkeypatch.setattr(shapley, "MASK_CHANNELS", 1)
    monkeypatch.setattr(shapley, "BROADCAST_PLACES", 1)
    assert collected() == masked
    sampled = {r["channel"]: r["raw_value"] for r in shapley.shapley_sampled(long, 3000, 2, channels).collect()}
    assert sampled == pytest.approx(exact, abs=0.05)
    from_sets = markov.removal_effects_from_sets(shapley.channel_sets(long, channels), channels).collect()
    plain = {r["channel"]: r["removal_effect"] for r in markov.removal_effects(long).collect()}
    assert {r["channel"]: r["removal_effect"] for r in from_sets} == pytest.approx(plain)


def test_paths_and_sequences_are_whole_at_every_length(spark):
    # one customer owns a third of the touches, twice what the default once held
    touches = spark.createDataFrame(random_journeys([20_000] + [8_000] * 5), SCHEMA)
    channels = {}
    for r in touches.orderBy("customer_id", "touchpoint_number").select("customer_id", "channel").collect():
        channels.setdefault(r[0], []).append(r[1])
    want = sorted(" -> ".join(c) for c in channels.values())
    assert sorted(r["journey_path"] for r in paths.path_patterns(touches).collect()) == want
    sequences = {r["customer_id"]: r["sequence"][1:-1] for r in paths.journey_sequences(touches).collect()}
    assert sequences == channels
    assert all("#" not in r["path"] for r in paths.conversion_touch_paths(touches).collect())
    converting = {r["customer_id"] for r in touches.filter("converted = 1").select("customer_id").distinct().collect()}
    assert {r["path"] for r in paths.converting_paths(touches, None).collect()} == {" -> ".join(channels[c]) for c in converting}
