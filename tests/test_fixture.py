"""The nine-touch fixture with values worked out by hand, and the invariants."""

import pytest
from pyspark.sql import functions as F

from journeyloom.operators import compare, journeys, markov, paths, rules, shapley

from touch_data import by_touch, nine_touches

EXPECTED = {
    "last_touch": [0, 0, 100, 0, 50, 0, 0, 0, 150],
    "first_touch": [100, 0, 0, 50, 0, 150, 0, 0, 0],
    "linear": [33.3333, 33.3333, 33.3333, 25, 25, 37.5, 37.5, 37.5, 37.5],
    "time_decay": [22.3744, 31.9635, 45.6621, 20.5882, 29.4118, 20.3119, 29.0170, 41.4528, 59.2183],
    "position_based": [40, 20, 40, 25, 25, 60, 15, 15, 60],
}


@pytest.fixture(scope="module")
def nine(spark):
    return nine_touches(spark).cache()


@pytest.mark.parametrize("rule", rules.RULES)
def test_rules(nine, rule):
    got = by_touch(rules.attribute_rules(nine, [rule]), f"{rule}_attribution")
    assert [v[0] for _, v in sorted(got.items())] == pytest.approx(EXPECTED[rule], abs=1e-4)


def test_shapley(nine):
    rates = shapley.coalition_rates(nine).filter("mask <> 0").collect()
    assert len(rates) == 17 and all(r["rate"] == 1.0 for r in rates)
    values = {r["channel"]: r for r in shapley.shapley_values(nine).collect()}
    raw = {c: r["raw_value"] for c, r in values.items()}
    assert raw == pytest.approx(
        {"direct": 0.2, "email": 0.116667, "paid_search": 0.116667, "social_media": 0.116667, "organic_search": -0.55},
        abs=1e-5,
    )
    assert sum(r["shapley_value"] for r in values.values()) == pytest.approx(1.0)
    got = by_touch(shapley.attribute_shapley(nine), "shapley_attribution")
    assert [v[0] for _, v in sorted(got.items())] == pytest.approx(
        [32, 32, 36, 0, 50, 36.3636, 36.3636, 36.3636, 40.9091], abs=1e-4
    )


def test_markov(nine):
    effects = markov.removal_effects(nine).collect()
    assert all(r["removal_effect"] == 0 and r["attribution_share"] == pytest.approx(0.2) for r in effects)
    got = by_touch(markov.attribute_markov(nine), "markov_attribution")
    assert [v[0] for _, v in sorted(got.items())] == pytest.approx(EXPECTED["linear"], abs=1e-4)
    edges = {(r["from_state"], r["to_state"]): (r["count"], r["probability"]) for r in markov.transitions(nine).collect()}
    third = pytest.approx(1 / 3)
    assert edges == {
        ("start", "paid_search"): (1, third),
        ("start", "organic_search"): (1, third),
        ("start", "social_media"): (1, third),
        ("paid_search", "email"): (1, 0.5),
        ("paid_search", "direct"): (1, 0.5),
        ("email", "direct"): (1, 0.5),
        ("email", "paid_search"): (1, 0.5),
        ("organic_search", "direct"): (1, 1.0),
        ("social_media", "email"): (1, 1.0),
        ("direct", "conversion"): (3, 1.0),
    }
    assert markov.transitions_from(markov.transitions(nine), "unknown").count() == 0


def test_sequences_have_ends(nine):
    for r in paths.journey_sequences(nine).collect():
        assert r["sequence"][0] == "start" and r["sequence"][-1] in ("conversion", "null")
        assert len(r["sequence"]) == r["touches"] + 2


def test_matrix_rows_sum_to_one(nine):
    states = ["paid_search", "email", "direct", "organic_search", "social_media", "conversion", "null"]
    for r in markov.transition_matrix(markov.transitions(nine), states).collect():
        assert sum(r[s] for s in states) == pytest.approx(1.0)


def test_one_feature_row_per_customer(nine):
    rows = journeys.journey_features(nine, ["direct", "email"]).collect()
    assert sorted(r["customer_id"] for r in rows) == [1, 2, 3]
    first = next(r for r in rows if r["customer_id"] == 1)
    assert (first["first_channel"], first["last_channel"], first["unique_channels"]) == ("paid_search", "direct", 3)
    assert first["journey_duration_hours"] == pytest.approx(48.0)


def test_credit_is_conserved(nine):
    sums = compare.attribute_all(nine).agg(*[F.sum(m).alias(m) for m in compare.METHODS]).first()
    for method in compare.METHODS:
        assert sums[method] == pytest.approx(300.0)


def test_comparison_shape(nine):
    table = compare.comparison(compare.attribute_all(nine))
    assert table.columns == ["channel", "method", "attributed_revenue", "channel_cost", "roi"]
    assert table.count() == 5 * 7
    # zero-cost channels with revenue: an infinite ratio counts as 0
    assert {r["roi"] for r in table.filter("channel = 'direct'").collect()} <= {0.0, None}


def test_recommendations(nine):
    attributed = compare.attribute_all(nine).cache()
    assert compare.undervalued_channels(attributed).count() == 3
    assert compare.overvalued_channels(attributed).first()["channel"] == "direct"
    moved = compare.budget_reallocation(attributed).agg(F.sum("reallocation")).first()[0]
    assert moved == pytest.approx(0.0, abs=1e-9)


def test_sampled_close_to_exact(nine):
    exact = {r["channel"]: r["raw_value"] for r in shapley.shapley_exact(nine).collect()}
    sampled = {r["channel"]: r["raw_value"] for r in shapley.shapley_sampled(nine, 4000, 1).collect()}
    assert sampled == pytest.approx(exact, abs=0.05)
    again = {r["channel"]: r["raw_value"] for r in shapley.shapley_sampled(nine.repartition(3), 4000, 1).collect()}
    assert again == pytest.approx(sampled, abs=1e-12)
