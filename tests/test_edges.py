"""Edge cases of the touch model."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from journeyloom.operators import compare, experiments, journeys, markov, metrics, paths, rules, shapley, timeseries
from journeyloom.schema import conform
from journeyloom.sources.touchpoints import ga_sessions_to_touchpoints, read_touchpoints

from touch_data import SCHEMA, by_touch, nine_touches


def touches(spark, *rows):
    """(customer, position, length, channel, cost, converted, revenue[, day])"""
    full = [
        (r[0], f"s{i}", datetime(2024, 1, r[7] if len(r) > 7 else 1, 8) + timedelta(seconds=i), r[3], "mobile", r[1], r[2], 1.0, 1, r[4], r[5], r[6])
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(full, SCHEMA)


def test_no_revenue_gives_fractions(spark):
    df = touches(spark, (1, 1, 2, "email", 1.0, 0, 0.0), (1, 2, 2, "direct", 0.0, 1, 0.0), (2, 1, 1, "email", 1.0, 1, 5.0))
    for attributed, column in (
        (markov.attribute_markov(df), "markov_attribution"),
        (shapley.attribute_shapley(df), "shapley_attribution"),
    ):
        got = by_touch(attributed, column)
        assert got[1, 1][0] + got[1, 2][0] == pytest.approx(1.0)
        assert got[2, 1][0] == pytest.approx(5.0)
    assert all(v == (0.0,) for k, v in by_touch(rules.attribute_rules(df, ["linear"]), "linear_attribution").items() if k[0] == 1)


def test_no_conversions(spark):
    df = touches(spark, (1, 1, 2, "email", 1.0, 0, 0.0), (1, 2, 2, "direct", 0.0, 0, 0.0), (2, 1, 1, "email", 1.0, 0, 0.0))
    sums = compare.attribute_all(df).agg(*[F.sum(m).alias(m) for m in compare.METHODS]).first()
    assert all(v == 0 for v in sums)
    assert all(r["attribution_share"] == pytest.approx(0.5) for r in markov.removal_effects(df).collect())
    assert {r["shapley_value"] for r in shapley.shapley_values(df).collect()} == {0.5}
    assert paths.converting_paths(df).count() == 0
    assert metrics.kpi_overview(df).first()["conversion_rate"] == 0


def test_single_touch_and_zero_cost(spark):
    df = touches(spark, (1, 1, 1, "direct", 0.0, 1, 30.0))
    row = compare.attribute_all(df).first()
    assert all(row[m] == pytest.approx(30.0) for m in compare.METHODS)
    assert metrics.channel_metrics(df).first()["roi"] is None
    assert metrics.channel_overview(df).first()["roi"] == 0.0
    assert markov.removal_effects(df).first()["removal_effect"] == 1.0


def test_conform(spark):
    raw = nine_touches(spark)
    boolean = raw.withColumn("converted", F.col("converted") == 1).withColumn("timestamp", F.col("timestamp").cast("string"))
    fixed = conform(boolean)
    assert dict(fixed.dtypes)["converted"] == "int" and dict(fixed.dtypes)["timestamp"] == "timestamp"
    assert fixed.agg(F.sum("converted")).first()[0] == 3
    with pytest.raises(KeyError):
        conform(raw.drop("channel"))
    with pytest.raises(Exception, match="reserved channel name"):
        conform(raw.withColumn("channel", F.lit("start"))).collect()
    assert conform(raw.withColumn("customer_id", F.when(F.col("customer_id") > 1, F.col("customer_id")))).count() == 6


def test_csv_with_other_column_order(spark, tmp_path):
    path = tmp_path / "touches.csv"
    path.write_text(
        "channel,customer_id,timestamp,device,converted,revenue,cost,time_on_site,pages_viewed,touchpoint_number,"
        "total_touchpoints,extra\nemail,1,2024-01-01T10:00:00,mobile,False,0,0.1,5,2,1,2,x\n"
        "direct,1,2024-01-02T10:00:00,mobile,True,10,0,5,2,2,2,y\n"
    )
    got = read_touchpoints(spark, str(path)).orderBy("touchpoint_number").collect()
    assert [(r["channel"], r["converted"], r["revenue"], r["extra"]) for r in got] == [("email", 0, 0.0, "x"), ("direct", 1, 10.0, "y")]
    with pytest.raises(ValueError):
        read_touchpoints(spark, str(path), "xml")


def test_ga_defaults_and_ties(spark):
    ga = spark.createDataFrame(
        [("v", 2, 20240101, 60, "email", "mobile", None, None, None, None), ("v", 1, 20240101, 60, "direct", "mobile", 9.0, 3.0, 1.0, 20.0)],
        "fullVisitorId string, visitNumber int, date int, visitStartTime bigint, channel string, deviceCategory string, "
        "timeOnSite double, pageviews double, transactions double, revenue double",
    )
    first, second = ga_sessions_to_touchpoints(ga, cost=F.lit(2.0)).orderBy("touchpoint_number").collect()
    assert (first["channel"], second["channel"]) == ("direct", "email")
    assert (second["time_on_site"], second["pages_viewed"], second["revenue"], second["converted"]) == (0.0, 1, 0.0, 0)
    assert first["timestamp"] == datetime(2024, 1, 1, 0, 1) and first["cost"] == 2.0
    epoch = ga_sessions_to_touchpoints(ga.withColumn("visitStartTime", F.lit(1704067260)), offset="epoch")
    assert epoch.first()["timestamp"] == datetime(2024, 1, 1, 0, 1)
    drawn = ga_sessions_to_touchpoints(ga).agg(F.min("cost"), F.max("cost")).first()
    assert 0.5 <= drawn[0] <= drawn[1] < 5.0


def test_anomalies_need_six_rows(spark):
    quiet = [(c, 1, 1, "email", 1.0, 1, 10.0, day) for day in range(1, 12) if day != 4 for c in [day]]
    loud = [(99, 1, 1, "email", 1.0, 1, 900.0, 3), (98, 1, 1, "email", 1.0, 1, 900.0, 11)]
    scores = timeseries.rolling_scores(touches(spark, *quiet, *loud)).filter("metric = 'revenue' and is_anomaly").collect()
    assert [str(r["date"]) for r in scores] == ["2024-01-11"]


def test_holdout_drops_customers_of_the_tested_channel_only(spark):
    rows = [(c, 1, 1, "email" if c % 2 else "direct", 1.0, c % 3 == 0 and 1 or 0, 0.0) for c in range(1, 201)]
    got = {r["channel"]: r for r in experiments.incrementality(touches(spark, *rows), ["email", "direct"]).collect()}
    held = got["email"]["control_n"] + got["direct"]["control_n"]
    assert held + got["email"]["treatment_n"] == 200


def test_bootstrap_interval_covers_the_mean(spark):
    df = touches(spark, *[(c, 1, 1, "email", 1.0, 1, float(c % 17)) for c in range(1, 400)]).withColumn(
        "shapley_attribution", F.col("revenue")
    )
    row = experiments.bootstrap_means(df, replicates=300, blocks=200).first()
    mean = sum(c % 17 for c in range(1, 400)) / 399
    assert row["mean_attribution"] == pytest.approx(mean)
    assert row["ci_lower"] < mean < row["ci_upper"]
    deviation = (sum((c % 17 - mean) ** 2 for c in range(1, 400)) / 398) ** 0.5
    assert row["std_error"] == pytest.approx(deviation / 399**0.5, rel=0.25)
