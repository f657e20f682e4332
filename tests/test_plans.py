"""What the physical plans must and must not contain, on a table that is already numbered."""

import pytest

from journeyloom.functions.journey_scope import declare_longest_journey
from journeyloom.operators import compare, journeys, markov, metrics, paths, rules, shapley

from touch_data import SCHEMA, random_journeys


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "touches")
    spark.createDataFrame(random_journeys([3] * 40), SCHEMA).write.parquet(path)
    return declare_longest_journey(spark.read.parquet(path), 3)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_need_one_exchange(stored):
    text = plan(rules.attribute_rules(stored))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_all_methods_need_one_exchange_of_touches(stored):
    text = plan(compare.attribute_all(stored))
    assert text.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in text


def test_enrichment_and_transitions_share_the_journey_exchange(stored):
    assert plan(journeys.enrich_touches(stored)).count("Exchange hashpartitioning") == 1
    assert plan(markov.transitions(stored)).count("Exchange hashpartitioning(customer_id") == 1


def test_scans_read_only_what_is_used(stored):
    text = plan(metrics.time_patterns(stored))
    columns = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "timestamp" in columns and "channel" not in columns and "revenue" not in columns
    assert "PushedFilters: [IsNotNull(channel), EqualTo(channel,email)]" in plan(metrics.channel_detail(stored, "email"))


@pytest.mark.parametrize(
    "build",
    [
        lambda t: compare.comparison(compare.attribute_all(t)),
        lambda t: markov.transitions(t, 2),
        lambda t: shapley.shapley_values(t),
        lambda t: paths.path_patterns(t),
        lambda t: metrics.channel_metrics(t),
    ],
)
def test_no_python_and_no_cartesian(stored, build):
    text = plan(build(stored))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "FlatMapGroups"):
        assert word not in text
