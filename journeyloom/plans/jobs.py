"""The composed jobs: batch ETL, attribution run, conversion model, media mix, validation.

Every job writes its tables below one folder and a manifest of them. Running a job again
on the same touches leaves equal tables; running it on some days replaces those days of
the tables that have a folder per date.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from journeyloom.functions.dimensions import channels_of
from journeyloom.functions.journey_scope import declare_longest_journey, longest_journey, measure_longest_journey
from journeyloom.functions.numeric import side_by_side
from journeyloom.operators import compare, conversion_models as models, experiments, journeys, mediamix, metrics, paths as P
from journeyloom.sources.sinks import write_by_date, write_csv, write_json_summary, write_manifest, write_parquet
from journeyloom.sources.touchpoints import read_touchpoints


def _finish(spark: SparkSession, out: str, tables: dict[str, str], others: dict[str, str] | None = None) -> dict[str, str]:
    write_manifest(spark, tables, f"{out}/manifest")
    return {**tables, **(others or {}), "manifest": f"{out}/manifest"}


def run_etl(touches: DataFrame, out: str) -> dict[str, str]:
    """Journey, channel and path tables of the batch job.

    The enriched touches are written first, by date, and everything else reads them from
    there. Paths are by key (``paths``), their steps are the table path_steps. Journeys
    stay spread over many files; only channel-sized results become one file.
    """
    spark = touches.sparkSession
    tables = {n: f"{out}/{n}" for n in ("journeys", "channel_metrics", "journey_patterns", "conversion_paths", "path_steps")}
    enriched = journeys.enrich_touches(touches).withColumn("date", F.to_date("timestamp"))
    write_by_date(enriched, tables["journeys"])
    stored = spark.read.parquet(tables["journeys"])
    bound = longest_journey(touches)
    stored = measure_longest_journey(stored) if bound is None else declare_longest_journey(stored, bound)
    channel = metrics.channel_metrics(stored)
    write_parquet(channel, tables["channel_metrics"], single_file=True)
    write_parquet(P.pattern_keys(stored), tables["journey_patterns"])
    write_parquet(P.conversion_touch_keys(stored), tables["conversion_paths"])
    write_parquet(P.path_steps(stored, P.journey_keys(stored)), tables["path_steps"])
    others = {"channel_metrics_csv": f"{out}/channel_metrics_csv", "summary": f"{out}/summary"}
    write_csv(spark.read.parquet(tables["channel_metrics"]), others["channel_metrics_csv"], single_file=True)
    write_json_summary(metrics.dataset_summary(stored), others["summary"])
    return _finish(spark, out, tables, others)


def run_attribution(spark: SparkSession, source: str, out: str, fmt: str = "parquet") -> dict[str, str]:
    """Read touches, attribute by all methods, write the touch and comparison tables."""
    touches = measure_longest_journey(read_touchpoints(spark, source, fmt))
    tables = {"touches": f"{out}/touchpoints_all_attributions"}
    others = {"comparison": f"{out}/method_comparison"}
    write_parquet(compare.attribute_all(touches), tables["touches"])
    # the comparison reads the finished table instead of attributing again
    write_csv(compare.comparison(spark.read.parquet(tables["touches"])), others["comparison"], single_file=True)
    return _finish(spark, out, tables, others)


def run_conversion_model(touches: DataFrame, out: str, kind: str | None = None, seed: int = 42) -> dict[str, str]:
    """Features, one fit, its quality and importances, the saved model and the scores it gives.

    Features are written once; the fit, its evaluation and the scoring read them. The
    scores come from the model as it was saved.
    """
    spark = touches.sparkSession
    tables = {n: f"{out}/{n}" for n in ("features", "quality", "importance", "scores", "score_bins")}
    write_parquet(journeys.conversion_features(touches), tables["features"])
    features = spark.read.parquet(tables["features"])
    train, test = models.split(features, 0.2, seed)
    model = models.train_pipeline(train, kind=kind, seed=seed)
    write_parquet(models.evaluate(model, test), tables["quality"], single_file=True)
    importance = models.feature_importance(model, None) if kind != "logistic" else models.linear_weights(model)
    write_parquet(importance, tables["importance"], single_file=True)
    models.save_model(model, f"{out}/model")
    saved = models.load_model(f"{out}/model")
    write_parquet(models.score_features(saved, features), tables["scores"])
    held = spark.read.parquet(tables["scores"]).join(test.select("customer_id"), "customer_id", "left_semi")
    write_parquet(models.score_bins(held, "actual_conversion", "conversion_probability"), tables["score_bins"], single_file=True)
    return _finish(spark, out, tables, {"model": f"{out}/model"})


def run_media_mix(touches: DataFrame, out: str, seed: int = 42) -> dict[str, str]:
    """The transformed daily grid by date, the ridge path, coefficients, contributions and the budget."""
    spark = touches.sparkSession
    tables = {n: f"{out}/{n}" for n in ("grid", "ridge_path", "coefficients", "contributions", "budget")}
    channels = channels_of(touches)
    write_by_date(mediamix.transformed_grid(touches, channels), tables["grid"])
    grid = spark.read.parquet(tables["grid"])
    write_parquet(mediamix.ridge_path(grid, channels, seed), tables["ridge_path"], single_file=True)
    chosen = spark.read.parquet(tables["ridge_path"]).filter("chosen and coefficient <> 0")
    write_parquet(chosen.select("channel", "coefficient"), tables["coefficients"], single_file=True)
    contribution = mediamix.contributions(grid, spark.read.parquet(tables["coefficients"]))
    write_parquet(contribution, tables["contributions"], single_file=True)
    write_parquet(mediamix.budget_by_roi(spark.read.parquet(tables["contributions"])), tables["budget"], single_file=True)
    return _finish(spark, out, tables)


def run_validation(attributed: DataFrame, out: str, seed: int = 42, on: date | None = None) -> dict[str, str]:
    """Tests, intervals and models of the validation, each as a table.

    ``attributed`` is read once: its needed columns are written first.
    """
    spark = attributed.sparkSession
    names = ("touches", "anova", "tukey", "revenue_intervals", "bootstrap", "logit_terms", "interactions", "report")
    tables = {n: f"{out}/{n}" for n in names}
    write_parquet(attributed, tables["touches"])
    touches = spark.read.parquet(tables["touches"])
    per_customer = experiments.customer_method_values(touches)
    write_parquet(experiments.anova(per_customer), tables["anova"], single_file=True)
    write_parquet(experiments.tukey_hsd(per_customer), tables["tukey"], single_file=True)
    write_parquet(experiments.revenue_intervals(touches), tables["revenue_intervals"], single_file=True)
    write_parquet(experiments.bootstrap_means(touches, seed=seed), tables["bootstrap"], single_file=True)
    terms, quality = models.logit_validation(touches, seed)
    write_parquet(terms, tables["logit_terms"], single_file=True)
    write_parquet(models.interaction_test(touches)[1], tables["interactions"], single_file=True)
    write_parquet(_report(touches, quality, on), tables["report"], single_file=True)
    return _finish(spark, out, tables)


def validation_report(attributed: DataFrame, seed: int = 42, on: date | None = None) -> DataFrame:
    """X11: one row with sizes, model quality, effect size and required sample size."""
    return _report(attributed, models.logit_validation(attributed, seed)[1], on)


def _report(attributed: DataFrame, quality: DataFrame, on: date | None) -> DataFrame:
    sizes = metrics.kpi_overview(attributed).select(
        F.col("total_customers").alias("n_customers"), F.col("total_touchpoints").alias("n_touchpoints")
    )
    effect = experiments.method_effect_size(attributed).select(
        "effect_size", F.col("required_n").alias("required_sample_size")
    )
    row = side_by_side(
        sizes, quality.select(F.col("accuracy").alias("model_accuracy"), F.col("auc").alias("model_auc")), effect
    )
    return row.withColumn("test_date", F.lit(str(on)) if on else F.current_date().cast("string"))
