"""Model helpers against independent fits and counts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from journeyloom.operators import conversion_models as L, mediamix as R
from journeyloom.operators.journeys import conversion_features, journey_features

from touch_data import SCHEMA, random_journeys


@pytest.fixture(scope="module")
def touches(spark):
    lengths = [1 + i % 6 for i in range(400)]
    return spark.createDataFrame(random_journeys(lengths, seed=11, conversion=0.6), SCHEMA).cache()


def logit(x, y):
    x = np.column_stack([np.ones(len(y)), x])
    b = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ b))
        h = x.T @ (x * (p * (1 - p))[:, None])
        b = b + np.linalg.solve(h, x.T @ (y - p))
    p = 1 / (1 + np.exp(-x @ b))
    return b, np.sqrt(np.diag(np.linalg.inv(h))), -2 * np.sum(y * np.log(p) + (1 - y) * np.log(1 - p))


def test_interaction_fits_equal_single_row_fits(touches):
    rows = (
        touches.groupBy("customer_id")
        .agg(
            F.max("converted").alias("y"),
            F.max(F.col("channel").isin("paid_search", "organic_search").cast("int")).alias("s"),
            F.max((F.col("channel") == "social_media").cast("int")).alias("o"),
            F.max((F.col("channel") == "email").cast("int")).alias("e"),
            F.max((F.col("channel") == "display").cast("int")).alias("d"),
        )
        .toPandas()
    )
    y = rows["y"].to_numpy(float)
    main = rows[["s", "o", "e", "d"]].to_numpy(float)
    full = np.column_stack([main, main[:, 0] * main[:, 1], main[:, 0] * main[:, 2], main[:, 1] * main[:, 2]])
    b, se, deviance = logit(full, y)
    _, _, deviance0 = logit(main, y)
    test, terms = L.interaction_test(touches)
    assert test.first()["lr_statistic"] == pytest.approx(deviance0 - deviance, rel=1e-4)
    got = {r["term"]: r for r in terms.collect()}
    for i, term in enumerate(L.INTERACTIONS):
        assert got[term]["estimate"] == pytest.approx(b[5 + i], rel=1e-3)
        assert got[term]["std_error"] == pytest.approx(se[5 + i], rel=1e-3)


def test_logit_terms_start_with_the_intercept(touches):
    terms, quality = L.logit_validation(touches)
    rows = terms.collect()
    assert [r["term"] for r in rows] == ["(Intercept)", *L.LOGIT_INPUTS]
    train, _ = L.split(L.logit_features(touches), 0.2, 42)
    data = train.toPandas()
    b, se, _ = logit(data[L.LOGIT_INPUTS].to_numpy(float), data["converted"].to_numpy(float))
    assert [r["estimate"] for r in rows] == pytest.approx(list(b), rel=1e-2, abs=1e-3)
    assert [r["std_error"] for r in rows] == pytest.approx(list(se), rel=1e-2)
    assert 0 <= quality.first()["auc"] <= 1


def test_variance_inflation(touches):
    data = L.split(L.logit_features(touches), 0.2, 42)[0].toPandas()
    x = data[L.LOGIT_INPUTS].to_numpy(float)
    b, _, _ = logit(x, data["converted"].to_numpy(float))
    ones = np.column_stack([np.ones(len(x)), x])
    p = 1 / (1 + np.exp(-ones @ b))
    covariance = np.linalg.inv((ones.T * (p * (1 - p))) @ ones)[1:, 1:]
    scale = np.sqrt(np.diag(covariance))
    expected = np.diag(np.linalg.inv(covariance / np.outer(scale, scale)))
    assert [r["vif"] for r in L.variance_inflation(touches).collect()] == pytest.approx(list(expected), rel=1e-2)


def test_stratified_split_meets_the_share_in_each_class(touches):
    features = conversion_features(touches)
    train, test = L.split(features, 0.25, 1, "label")
    assert train.count() + test.count() == features.count()
    sizes = {r["label"]: r["count"] for r in features.groupBy("label").count().collect()}
    for r in test.groupBy("label").count().collect():
        assert r["count"] == pytest.approx(0.25 * sizes[r["label"]], abs=2)


def test_pipeline_scores_and_survives_saving(touches, tmp_path):
    train, test = L.split(conversion_features(touches), 0.2, 42)
    model = L.train_pipeline(train)
    quality = L.evaluate(model, test).first()
    assert 0 <= quality["auc"] <= 1 and quality["test_rows"] == test.count()
    assert sum(r["importance"] for r in L.feature_importance(model, None).collect()) == pytest.approx(1.0)
    path = str(tmp_path / "model")
    L.save_model(model, path)
    before = L.score_journeys(model, touches).select("customer_id", "attribution_score").collect()
    assert before == L.score_journeys(L.load_model(path), touches).select("customer_id", "attribution_score").collect()


def test_encoding_covers_both_ends(touches):
    features = L.encode_end_channels(journey_features(touches, ["email"]))
    names = sorted(
        {r[0] for r in features.select("first_channel").collect()} | {r[0] for r in features.select("last_channel").collect()}
    )
    for r in features.select("first_channel", "first_channel_encoded", "last_channel", "last_channel_encoded").collect():
        assert (names[r[1]], names[r[3]]) == (r[0], r[2])


def test_media_mix_runs_to_the_budget(touches):
    coefficients, contribution, budget = R.media_mix(touches)
    assert {r["channel"] for r in contribution.collect()} >= {r["channel"] for r in coefficients.collect()}
    assert contribution.agg(F.sum("contribution_pct")).first()[0] == pytest.approx(100.0)
    total = budget.agg(F.sum("current_spend"), F.sum("optimal_spend")).first()
    assert total[0] == pytest.approx(total[1])


def test_ridge_does_not_depend_on_partitions(touches):
    channels = sorted(r[0] for r in touches.select("channel").distinct().collect())
    grid = R.transformed_grid(touches, channels)
    want = {r["channel"]: r["coefficient"] for r in R.ridge_coefficients(grid, channels).collect()}
    got = {r["channel"]: r["coefficient"] for r in R.ridge_coefficients(grid.repartition(7), channels).collect()}
    assert got == pytest.approx(want, rel=1e-6)


def test_ridge_solves_its_equations():
    rng = np.random.default_rng(4)
    x, penalty = rng.normal(size=(80, 3)) * [1, 5, 0.2] + 2, 0.7
    y = x @ [1.0, -2.0, 3.0] + rng.normal(size=80)
    rows = np.column_stack([np.ones(80), x, y])
    weights, intercept = R._Ridge(rows.T @ rows).fit(penalty)
    z, v = (x - x.mean(0)) / x.std(0), (y - y.mean()) / y.std()
    scaled = weights * x.std(0) / y.std()
    assert z.T @ (v - z @ scaled) == pytest.approx(penalty / y.std() * 80 * scaled)
    assert intercept == pytest.approx(y.mean() - x.mean(0) @ weights)
    assert R._mean_error(rows.T @ rows, weights, intercept) == pytest.approx(np.sqrt(np.mean((y - x @ weights - intercept) ** 2)))


def test_ridge_matches_a_closed_form(spark):
    rng = np.random.default_rng(3)
    days = 60
    x = rng.uniform(0, 1, (days, 2))
    y = 5 + x @ np.array([30.0, 0.0]) + rng.normal(0, 0.1, days)
    rows = [
        (f"2024-{1 + d // 28:02d}-{1 + d % 28:02d}", c, float(x[d, i]), float(y[d]))
        for d in range(days)
        for i, c in enumerate(["a", "b"])
    ]
    grid = spark.createDataFrame(rows, "date string, channel string, saturated double, total_revenue double")
    got = {r["channel"]: r["coefficient"] for r in R.ridge_coefficients(grid, ["a", "b"]).collect()}
    assert got["a"] == pytest.approx(30.0, rel=0.05) and abs(got.get("b", 0.0)) < 1.0


@pytest.mark.parametrize("kind", ["gradient_boost", "random_forest", None])
def test_tree_fits_have_partitions_by_cores(spark, touches, kind, monkeypatch):
    seen = []
    monkeypatch.setattr(L.Pipeline, "fit", lambda self, rows: seen.append(rows.rdd.getNumPartitions()))
    set_to = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        L.train_pipeline(conversion_features(touches), kind=kind)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", set_to)
    assert seen == [2 * spark.sparkContext.defaultParallelism]
