"""Jobs that write: a second run leaves equal tables, some days replace only themselves."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from journeyloom.operators import compare, shapley
from journeyloom.plans import jobs
from journeyloom.sources.sinks import read_manifest, write_by_date

from touch_data import SCHEMA, random_journeys


@pytest.fixture(scope="module")
def touches(spark):
    return spark.createDataFrame(random_journeys([3, 5, 1, 8] * 40), SCHEMA).cache()


def twice(spark, run, out):
    first = run(out)
    before = read_manifest(spark, first["manifest"])
    assert run(out) == first
    assert read_manifest(spark, first["manifest"]) == before and all(rows for rows, _ in before.values())
    return first, before


def test_etl_runs_again(spark, touches, tmp_path):
    paths, before = twice(spark, lambda out: jobs.run_etl(touches, out), str(tmp_path / "etl"))
    assert set(before) == {"journeys", "channel_metrics", "journey_patterns", "conversion_paths", "path_steps"}
    assert before["journeys"][0] == touches.count()
    keys = spark.read.parquet(paths["journey_patterns"]).select("path_length", "path_key").distinct()
    steps = spark.read.parquet(paths["path_steps"])
    assert keys.join(steps, ["path_length", "path_key"], "left_anti").count() == 0


def test_attribution_and_mix_run_again(spark, touches, tmp_path):
    source = str(tmp_path / "touches")
    touches.write.parquet(source)
    twice(spark, lambda out: jobs.run_attribution(spark, source, out), str(tmp_path / "attribution"))
    _, before = twice(spark, lambda out: jobs.run_media_mix(touches, out), str(tmp_path / "mix"))
    assert set(before) == {"grid", "ridge_path", "coefficients", "contributions", "budget"}


def test_model_runs_again(spark, touches, tmp_path):
    paths, before = twice(spark, lambda out: jobs.run_conversion_model(touches, out, "logistic"), str(tmp_path / "model"))
    assert before["scores"][0] == before["features"][0] == 160


def test_validation_runs_again(spark, touches, tmp_path):
    attributed = compare.attribute_all(touches)
    _, before = twice(spark, lambda out: jobs.run_validation(attributed, out, on=date(2024, 1, 1)), str(tmp_path / "validation"))
    assert before["report"][0] == 1 and before["touches"][0] == touches.count()


def test_some_days_replace_only_themselves(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.range(10).select((F.col("id") % 3).alias("date"), F.col("id").alias("x"))
    write_by_date(rows, path)
    write_by_date(rows.filter("date = 1").withColumn("x", F.col("x") * 100), path)
    got = sorted((r["date"], r["x"]) for r in spark.read.parquet(path).collect())
    assert got == sorted((i % 3, i * 100 if i % 3 == 1 else i) for i in range(10))


def test_journey_of_twenty_channels(spark, monkeypatch):
    """Layers of masks give the values of plain expansion; a journey beyond the bound names the sampler."""
    rows = []
    for c in range(60):
        width = 20 if c < 2 else 1 + c % 6
        rows += [(c, f"s{c}-{p}", None, f"ch{(p * 7 + c) % 20:02d}", "mobile", p + 1, width, 1.0, 1, 0.5, c % 2, 3.0 * (c % 2)) for p in range(width)]
    wide = spark.createDataFrame(rows, SCHEMA)
    channels = [f"ch{i:02d}" for i in range(20)]
    sets = shapley.channel_sets(wide, channels)
    masked = {tuple(r["members"]): (r["total"], r["conversions"], r["mask"]) for r in shapley.coalition_rates(None, channels, sets).filter("size(members) < 4").collect()}
    assert len(masked) == 1 + 20 + 190 + 1140
    monkeypatch.setattr(shapley, "MASK_WORDS", 0)
    listed = {tuple(r["members"]): (r["total"], r["conversions"], r["mask"]) for r in shapley.coalition_rates(None, channels, sets).filter("size(members) < 4").collect()}
    assert listed == masked
    monkeypatch.undo()
    exact = {r["channel"]: r["raw_value"] for r in shapley.shapley_exact(None, channels, sets).collect()}
    found = {r["channel"]: r for r in shapley.shapley_stratified(None, 200, 3, channels, sets).collect()}
    assert all(abs(found[c]["raw_value"] - exact[c]) < 5 * found[c]["std_error"] + 1e-3 for c in channels)
    assert sum(r["raw_value"] for r in found.values()) == pytest.approx(sum(exact.values()), abs=1e-9)
    monkeypatch.setattr(shapley, "MAX_MEMBERS", 12)
    with pytest.raises(ValueError, match="sampled"):
        shapley.shapley_values(wide)
