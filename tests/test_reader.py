"""Touchpoint files: ids of any kind, flags of any spelling, headers, broken cells; journeys with gaps."""

import pytest
from pyspark.sql import types as T

from journeyloom.operators import compare, journeys, markov, rules
from journeyloom.sources.touchpoints import events_to_touchpoints, read_touchpoints, reject_counts, rejected_touches

from touch_data import nine_touches

HEADER = "customer_id,timestamp,channel,device,time_on_site,pages_viewed,cost,converted,revenue"


@pytest.fixture(scope="module")
def nine(spark):
    return nine_touches(spark).cache()


def folder(tmp_path, *files):
    for i, lines in enumerate(files):
        (tmp_path / f"{i}.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def row(customer, converted, channel="email"):
    return f"{customer},2023-01-01 10:00:00,{channel},mobile,10.5,3,1.5,{converted},50.0"


def test_ids_and_flags(spark, tmp_path):
    lines = [HEADER, row("99999999999999999999", "1.0"), row("v-7", "True"), row("12", "0"), row("12", ""), row("12", "false"), row("", "1"), row("13", "1", "")]
    path = folder(tmp_path, lines)
    got = sorted((r.customer_id, r.converted, r.channel) for r in read_touchpoints(spark, path).collect())
    assert got == [("12", 0, "email")] * 3 + [("13", 1, "(none)"), ("99999999999999999999", 1, "email"), ("v-7", 1, "email")]
    assert rejected_touches(spark, path).count() == 1


def test_typed_ids(spark, tmp_path):
    path = folder(tmp_path, [HEADER, row("12", "1")])
    assert read_touchpoints(spark, path, customer_type=T.LongType()).first().customer_id == 12


@pytest.mark.parametrize("bad", [row("1", "maybe"), row("1", "2.0"), row("1", "1").replace("10.5", "long")])
def test_broken_cells_fail(spark, tmp_path, bad):
    with pytest.raises(Exception, match="converted is neither|MALFORMED|Malformed|malformed"):
        read_touchpoints(spark, folder(tmp_path, [HEADER, bad]), strict=True).collect()


def test_broken_rows_are_set_aside(spark, tmp_path):
    good = row("1", "1")
    lines = {
        row("2", "maybe"): ["converted: not a flag"],
        good.replace("10.5", "long"): ["time_on_site: not a double"],
        good.replace("2023-01-01 10:00:00", "yesterday").replace(",3,", ",3.5,"): ["timestamp: not a timestamp", "pages_viewed: not a int"],
        row("", "1", "start"): ["customer_id: missing", "channel: reserved name"],
        "3,2023-01-01 10:00:00,email": ["line: other fields than the header"],
        good + ",more": ["line: other fields than the header"],
        good.replace("1.5", "NaN"): ["cost: not a double"],
    }
    path = folder(tmp_path, [HEADER, good, *lines, good.replace(",3,", ",3.0,").replace("50.0", "")])
    accepted = read_touchpoints(spark, path).collect()
    assert [(r.customer_id, r.pages_viewed, r.cost) for r in accepted] == [("1", 3, 1.5)] * 2
    assert sorted(r.revenue is None for r in accepted) == [False, True]
    rejected = rejected_touches(spark, path)
    assert sorted(r.reasons for r in rejected.collect()) == sorted(lines.values())
    records = {r.record for r in rejected.collect() if r.record}
    assert records == {"3,2023-01-01 10:00:00,email", good + ",more"}
    counts = {r.reason: r["rows"] for r in reject_counts(rejected).collect()}
    assert counts["line: other fields than the header"] == 2 and sum(counts.values()) == 9
    # counting alone judges the same rows
    assert read_touchpoints(spark, path).count() == 2 and rejected.count() == 7


def test_typed_parquet_cells(spark, tmp_path):
    rows = spark.createDataFrame([("1", "x", 2**40), ("2", "4.5", 3), (None, "1", 1)], "customer_id string, cost string, pages_viewed bigint")
    full = rows.selectExpr("*", "timestamp'2023-01-01 10:00:00' AS timestamp", "'email' AS channel", "'m' AS device", "1.0 AS time_on_site", "1 AS converted", "2.0D AS revenue")
    full.write.parquet(str(tmp_path / "t"))
    assert [(r.customer_id, r.cost) for r in read_touchpoints(spark, str(tmp_path / "t"), "parquet").collect()] == [("2", 4.5)]
    reasons = sorted(r.reasons for r in rejected_touches(spark, str(tmp_path / "t"), "parquet").collect())
    assert reasons == [["cost: not a double", "pages_viewed: not a int"], ["customer_id: missing"]] or reasons == [["customer_id: missing"], ["pages_viewed: not a int", "cost: not a double"]]


def test_other_column_order(spark, tmp_path):
    names, cells = HEADER.split(","), row("7", "1").split(",")
    turned = [",".join(names[::-1]), ",".join(cells[::-1])]
    got = read_touchpoints(spark, folder(tmp_path, turned)).first()
    assert (got.cost, got.revenue, got.customer_id) == (1.5, 50.0, "7")
    with pytest.raises(Exception, match="[Hh]eader"):
        read_touchpoints(spark, folder(tmp_path, turned, [HEADER, row("8", "0")])).collect()


def test_credit_is_conserved_with_gaps(nine):
    for gone in ("direct", "email", "paid_search", "organic_search"):
        left = nine.filter(f"channel <> '{gone}'")
        values = {r[0]: r[1] for r in left.groupBy("customer_id").agg({"revenue": "max"}).collect()}
        converts = {r[0] for r in left.filter("converted = 1").select("customer_id").distinct().collect()}
        credited = rules.attribute_rules(left)
        for rule in rules.RULES:
            sums = {r[0]: r[1] for r in credited.groupBy("customer_id").agg({f"{rule}_attribution": "sum"}).collect()}
            assert sums == pytest.approx({c: v if c in converts else 0.0 for c, v in values.items()})
        states = journeys.journey_states(left).filter("state in ('start', 'conversion', 'null')").count()
        assert states == 2 * left.select("customer_id").distinct().count()


def test_positions_are_asked_for(nine):
    bare = nine.drop("touchpoint_number", "total_touchpoints")
    for use in (rules.attribute_rules, markov.transitions, compare.attribute_all):
        with pytest.raises(KeyError, match="number_touches"):
            use(bare)


def test_days_of_different_years_are_different_journeys(spark):
    events = spark.sql(
        "select * from values (1L, 5L, timestamp'2023-01-05 10:00:00', 'click', 1.0D, '{\"k\": 3}'),"
        " (2L, 5L, timestamp'2024-01-05 10:00:00', 'click', 1.0D, '{\"k\": 3}') as t(event_id, user_id, ts, event_type, value, props)"
    )
    assert events_to_touchpoints(events).select("customer_id").distinct().count() == 2
