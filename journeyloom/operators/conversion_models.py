"""Conversion models on journey features (L1-L10, S6), all MLlib."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, IsotonicRegression
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from journeyloom.functions.dimensions import freeze
from journeyloom.functions.distributions import chi2_tail
from journeyloom.functions.least_squares import swept
from journeyloom.functions.numeric import hash_int, ratio, side_by_side
from journeyloom.operators.journeys import COUNTED_CHANNELS, conversion_features, journey_features
from journeyloom.session import checkpointed

FEATURES = [
    "journey_length",
    "unique_channels",
    "unique_devices",
    "total_cost",
    "total_time_on_site",
    "total_pages_viewed",
    "avg_time_on_site",
    *[f"{c}_touches" for c in COUNTED_CHANNELS],
    "mobile_touches",
    "desktop_touches",
]
_BUCKETS = 10_000

# Forest size as in the reference; more memory for histograms means fewer passes.
FOREST = {"numTrees": 100, "maxDepth": 10, "featureSubsetStrategy": "sqrt", "maxMemoryInMB": 512}


def split(features: DataFrame, test_share: float = 0.2, seed: int = 42, label: str | None = None):
    """L2: repeatable train and test parts by a hash of the customer.

    With ``label`` the share is met within each class: the cut is the class's own
    quantile of the hash instead of the overall one.
    """
    bucket = F.pmod(hash_int(F.lit(seed), F.col("customer_id")), F.lit(_BUCKETS))
    drawn = features.withColumn("_bucket", bucket)
    if label is None:
        test = F.col("_bucket") < int(test_share * _BUCKETS)
        return drawn.filter(~test).drop("_bucket"), drawn.filter(test).drop("_bucket")
    # bucket counts per class: at most classes x _BUCKETS rows whatever the data size
    counts = drawn.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("n"))
    by_class = Window.partitionBy(label)
    reached = F.sum("n").over(by_class.orderBy("_bucket"))
    wanted = F.sum("n").over(by_class) * test_share
    cuts = freeze(
        counts.withColumn("inside", reached <= wanted)
        .groupBy(label)
        .agg(F.coalesce(F.max(F.when(F.col("inside"), F.col("_bucket"))), F.lit(-1)).alias("_cut"))
    )
    marked = drawn.join(cuts, label)
    test = F.col("_bucket") <= F.col("_cut")
    return marked.filter(~test).select(*features.columns), marked.filter(test).select(*features.columns)


def classifier(kind: str = "random_forest", label: str = "label", seed: int = 42):
    """The three model families with the reference parameters."""
    common = {"labelCol": label, "featuresCol": "features"}
    if kind == "random_forest":
        return RandomForestClassifier(**common, **FOREST, minInstancesPerNode=10, seed=seed)
    if kind == "gradient_boost":
        return GBTClassifier(**common, maxIter=100, maxDepth=5, stepSize=0.1, seed=seed)
    if kind == "logistic":
        return LogisticRegression(**common, maxIter=1000)
    raise ValueError(f"unknown model: {kind}")


def train_pipeline(
    train: DataFrame, inputs: list[str] | None = None, kind: str | None = None, label: str = "label", seed: int = 42
) -> PipelineModel:
    """L1: assemble, scale, fit. Without ``kind`` this is the batch random forest."""
    model = (
        classifier(kind, label, seed)
        if kind
        else RandomForestClassifier(labelCol=label, featuresCol="features", **FOREST, seed=seed)
    )
    inputs = inputs or FEATURES
    assembler = VectorAssembler(inputCols=inputs, outputCol="features_raw")
    scaler = StandardScaler(inputCol="features_raw", outputCol="features")
    rows = _ordered(train.select("customer_id", label, *inputs))
    try:
        return Pipeline(stages=[assembler, scaler, model]).fit(rows)
    finally:
        rows.unpersist()


def _ordered(features: DataFrame) -> DataFrame:
    """Cached in a fixed order: fitting passes over the rows many times and draws its samples by partition and row.

    Each task of a tree stage sends the histograms of all its nodes, and boosting runs a thousand such stages, each over
    before the next: at most two partitions a core, whatever the number of shuffle partitions.
    """
    spark = features.sparkSession
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return features.repartition(parts, "customer_id").sortWithinPartitions("customer_id").persist()


def evaluate(model: PipelineModel, test: DataFrame, label: str = "label") -> DataFrame:
    """L3: area under the curve and accuracy on the test part, one row."""
    scored = model.transform(test).select(label, vector_to_array("rawPrediction")[1].alias("raw"), "prediction")
    auc = rank_auc(scored, label, "raw").first()[0]
    hits = F.avg((F.col(label) == F.col("prediction")).cast("double"))
    accuracy, rows = scored.agg(hits, F.count(F.lit(1))).first()
    return test.sparkSession.createDataFrame([(auc, accuracy, rows)], "auc double, accuracy double, test_rows bigint")


def feature_importance(model: PipelineModel, n: int | None = 10) -> DataFrame:
    """L4: features by importance in a tree model."""
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    rows = sorted(zip(names, (float(w) for w in weights), strict=True), key=lambda r: (-r[1], r[0]))
    return SparkSession.active().createDataFrame(rows[:n], "feature string, importance double")


def linear_weights(model: PipelineModel) -> DataFrame:
    """Weights of a logistic model on its scaled features, largest first."""
    names = model.stages[0].getInputCols()
    rows = sorted(zip(names, map(float, model.stages[-1].coefficients), strict=True), key=lambda r: (-abs(r[1]), r[0]))
    return SparkSession.active().createDataFrame(rows, "feature string, weight double")


def score_journeys(model: PipelineModel, touches: DataFrame) -> DataFrame:
    """Conversion probability and score of every journey, best first."""
    return score_features(model, conversion_features(touches))


def score_features(model: PipelineModel, features: DataFrame) -> DataFrame:
    """L5 from the feature rows of the journeys."""
    return (
        model.transform(features)
        .select(
            "customer_id",
            F.col("label").alias("actual_conversion"),
            F.col("prediction").alias("predicted_conversion"),
            vector_to_array("probability")[1].alias("conversion_probability"),
            "journey_length",
            "unique_channels",
            "total_cost",
        )
        .withColumn("attribution_score", F.col("conversion_probability") * 100)
        .orderBy(F.desc("attribution_score"), "customer_id")
    )


def encode_end_channels(features: DataFrame) -> DataFrame:
    """First and last channel as ranks over the union of both columns."""
    ends = features.select(F.explode(F.array("first_channel", "last_channel")).alias("name")).distinct()
    names = freeze(ends)
    if names is ends:
        raise ValueError("too many end channels to rank: group rare ones before modelling")
    ranks = freeze(
        names.select("name", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("name")) - 1).alias("rank"))
    )
    out = features
    for end in ("first_channel", "last_channel"):
        keyed = ranks.select(F.col("name").alias(end), F.col("rank").alias(f"{end}_encoded"))
        # broadcast if the names were few enough to be read; every journey stays
        out = out.join(keyed, end, "left")
    return out


def model_inputs(touches: DataFrame, channels: list[str]) -> tuple[DataFrame, list[str]]:
    """Feature rows of the Python models with encoded ends, and the input columns."""
    features = encode_end_channels(journey_features(touches, channels))
    left_out = {"customer_id", "converted", "revenue", "first_channel", "last_channel"}
    return features, sorted(c for c in features.columns if c not in left_out)


def compare_models(touches: DataFrame, channels: list[str], kinds: list[str], seed: int = 42) -> DataFrame:
    """AUC and accuracy of each model family on one stratified split."""
    features, inputs = model_inputs(touches, channels)
    # read for the cuts, for each fit and twice for its quality
    features = features.persist()
    try:
        train, test = split(features, 0.2, seed, "converted")
        parts = []
        for kind in kinds:
            model = train_pipeline(train, inputs, kind, "converted", seed)
            parts.append((kind, *evaluate(model, test, "converted").first()))
    finally:
        features.unpersist()
    return touches.sparkSession.createDataFrame(
        parts, "model string, auc double, accuracy double, test_rows bigint"
    )


# Predictors of the logistic validation model.
LOGIT_INPUTS = [
    "journey_length",
    "unique_channels",
    "total_cost",
    "total_time",
    "has_paid_search",
    "has_email",
    "has_social",
]


def _has(*channels: str):
    return F.max(F.when(F.col("channel").isin(*channels), 1).otherwise(0))


def logit_features(touches: DataFrame) -> DataFrame:
    """One row per journey with the seven predictors."""
    return touches.groupBy("customer_id").agg(
        F.max("converted").alias("converted"),
        F.count(F.lit(1)).alias("journey_length"),
        F.size(F.collect_set("channel")).alias("unique_channels"),
        F.sum("cost").alias("total_cost"),
        F.sum("time_on_site").alias("total_time"),
        _has("paid_search").alias("has_paid_search"),
        _has("email").alias("has_email"),
        _has("social_media").alias("has_social"),
    )


def _logit(data: DataFrame, inputs: list[str], weight: str | None = None):
    assembled = VectorAssembler(inputCols=inputs, outputCol="features").transform(data)
    glm = GeneralizedLinearRegression(family="binomial", link="logit", labelCol="converted", maxIter=100, tol=1e-10)
    return (glm.setWeightCol(weight) if weight else glm).fit(assembled)


def coefficient_table(model, inputs: list[str]) -> DataFrame:
    """Estimate, standard error, z and p per term; the intercept comes first."""
    s = model.summary
    values = [float(model.intercept), *map(float, model.coefficients)]
    # MLlib lists the intercept last in the summary arrays
    shift = [len(inputs), *range(len(inputs))]
    rows = [
        (
            name,
            values[i],
            float(s.coefficientStandardErrors[j]),
            float(s.tValues[j]),
            float(s.pValues[j]),
        )
        for i, (name, j) in enumerate(zip(["(Intercept)", *inputs], shift, strict=True))
    ]
    return SparkSession.active().createDataFrame(
        rows, "term string, estimate double, std_error double, statistic double, p_value double"
    )


def logit_validation(touches: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Coefficient table, and accuracy with AUC on the held-out fifth."""
    train, test = split(logit_features(touches), 0.2, seed)
    train = train.persist()
    try:
        model = _logit(train, LOGIT_INPUTS)
        terms = coefficient_table(model, LOGIT_INPUTS)
    finally:
        train.unpersist()
    scored = model.transform(VectorAssembler(inputCols=LOGIT_INPUTS, outputCol="features").transform(test))
    hit = F.avg(((F.col("prediction") > 0.5).cast("int") == F.col("converted")).cast("double"))
    quality = scored.agg(hit.alias("accuracy"), F.count(F.lit(1)).alias("test_rows"))
    row = side_by_side(rank_auc(scored, "converted", "prediction"), quality)
    return terms, row.select("auc", "accuracy", "test_rows")


def score_equations(rows: DataFrame, inputs: list[str], weight: str | None = None) -> DataFrame:
    """What a fitted logistic model must satisfy, from one aggregation of its scored rows.

    ``rows`` has the response ``converted``, the fitted ``prediction`` and the inputs. For each term: ``observed`` (sum of
    response times term), ``fitted`` (sum of prediction times term; equal to it at the maximum of the likelihood) and
    ``std_error`` from the inverse of the information matrix, the sums of p (1 - p) times products of terms.
    """
    names = ["one", *inputs]
    w = F.col(weight) if weight else F.lit(1.0)
    p = F.col("prediction")
    whole = rows.withColumn("one", F.lit(1.0))
    size = len(names)
    cells = {(i, j): F.sum(w * p * (1 - p) * F.col(names[i]) * F.col(names[j])).alias(f"i{i}_{j}") for i in range(size) for j in range(i, size)}
    sums = whole.agg(
        *[F.sum(w * F.col("converted") * F.col(n)).alias(f"o{i}") for i, n in enumerate(names)],
        *[F.sum(w * p * F.col(n)).alias(f"f{i}") for i, n in enumerate(names)],
        *cells.values(),
    )
    # inputs of very different size: the matrix is swept in units of its diagonal
    unit = [F.sqrt(F.col(f"i{i}_{i}")) for i in range(size)]
    matrix = F.array(*[ratio(F.col(f"i{min(i, j)}_{max(i, j)}"), unit[i] * unit[j]) for i in range(size) for j in range(size)])
    inverse = sums.withColumn("inverse", swept(matrix, size, size))
    terms = F.array(
        *[
            F.struct(
                F.lit("(Intercept)" if i == 0 else n).alias("term"),
                F.col(f"o{i}").cast("double").alias("observed"),
                F.col(f"f{i}").alias("fitted"),
                ratio(F.sqrt(F.col("inverse")[i * size + i]), unit[i]).alias("std_error"),
            )
            for i, n in enumerate(names)
        ]
    )
    return inverse.select(F.inline(terms))


def logit_score_equations(touches: DataFrame, seed: int = 42) -> DataFrame:
    """``score_equations`` of the validation model on its training part."""
    train, _ = split(logit_features(touches), 0.2, seed)
    train = train.persist()
    model = _logit(train, LOGIT_INPUTS)
    return score_equations(model.transform(VectorAssembler(inputCols=LOGIT_INPUTS, outputCol="features").transform(train)), LOGIT_INPUTS)


def rank_auc(scored: DataFrame, label: str, score: str, parts: int | None = None) -> DataFrame:
    """L3: area under the curve by the rank-sum formula, one row.

    Rows are reduced to counts per distinct score, range-partitioned by score; a pair of a positive and a negative counts
    1 if the positive scores higher and 1/2 if they tie. Partitions add the negatives of all lower ones.
    """
    positive = F.col(label).cast("int") == 1
    counts = scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.when(positive, 1).otherwise(0)).alias("pos"), F.sum(F.when(positive, 0).otherwise(1)).alias("neg")
    )
    parts = parts or scored.sparkSession.sparkContext.defaultParallelism
    ranged = checkpointed(counts.repartitionByRange(parts, "score").withColumn("part", F.spark_partition_id()))
    by_part = ranged.groupBy("part").agg(F.sum("neg").alias("all_neg"))
    lower = F.coalesce(F.sum("all_neg").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row per partition
    offsets = F.broadcast(by_part.select("part", lower.alias("below_part")))
    inside = F.coalesce(F.sum("neg").over(Window.partitionBy("part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = ranged.withColumn("below", inside).join(offsets, "part")
    wins = F.sum(F.col("pos") * (F.col("below") + F.col("below_part") + F.col("neg") / 2))
    return ranked.agg(ratio(wins, F.sum("pos") * F.sum("neg").cast("double")).alias("auc"))


def score_bins(scored: DataFrame, label: str, score: str, bins: int = 100) -> DataFrame:
    """L3: how scores from 0 to 1 relate to outcomes: bins with their rows, mean score and rate, and an isotonic rate.

    Rows are reduced to ``bins`` equal bins first; the isotonic fit, which never falls as the score rises, runs on those.
    """
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    table = scored.groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("rate")
    )
    table = freeze(table, bins).coalesce(1)
    fitted = IsotonicRegression(featuresCol="mean_score", labelCol="rate", weightCol="weight", predictionCol="isotonic_rate").fit(
        table.withColumn("weight", F.col("rows").cast("double"))
    )
    return fitted.transform(table).select("bin", "rows", "mean_score", "rate", "isotonic_rate").orderBy("bin")


def variance_inflation(touches: DataFrame, seed: int = 42) -> DataFrame:
    """Inflation factors of the logistic validation model, fitted on its training part.

    The covariance of the coefficients is the inverse of X'WX with W = p (1 - p), summed in
    one pass; a factor is the diagonal of the inverse of their correlation, intercept left out.
    """
    train, _ = split(logit_features(touches), 0.2, seed)
    train = train.persist()
    try:
        model = _logit(train, LOGIT_INPUTS)
        names = ["_one", *LOGIT_INPUTS]
        rows = model.transform(
            VectorAssembler(inputCols=LOGIT_INPUTS, outputCol="features").transform(train.withColumn("_one", F.lit(1.0)))
        )
        p = F.col("prediction")
        sums = [F.sum(p * (1 - p) * F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]]
        upper = rows.agg(*sums).first()
    finally:
        train.unpersist()
    weighted = np.zeros((len(names), len(names)))
    weighted[np.triu_indices(len(names))] = [float(v) for v in upper]
    covariance = np.linalg.inv(weighted + np.triu(weighted, 1).T)[1:, 1:]
    scale = np.sqrt(np.diag(covariance))
    factors = np.diag(np.linalg.inv(covariance / np.outer(scale, scale)))
    rows = [(n, float(v)) for n, v in zip(LOGIT_INPUTS, factors, strict=True)]
    return touches.sparkSession.createDataFrame(rows, "term string, vif double")


MAIN_EFFECTS = ["has_search", "has_social", "has_email", "has_display"]
INTERACTIONS = ["search_social", "search_email", "social_email"]


def interaction_counts(touches: DataFrame) -> DataFrame:
    """Journeys and conversions per combination of the channel flags, at most 16 rows."""
    journeys = touches.groupBy("customer_id").agg(
        F.max("converted").alias("converted"),
        _has("paid_search", "organic_search").alias("has_search"),
        _has("social_media").alias("has_social"),
        _has("email").alias("has_email"),
        _has("display").alias("has_display"),
    )
    counts = journeys.groupBy(*MAIN_EFFECTS).agg(
        F.count(F.lit(1)).cast("double").alias("journeys"), F.sum("converted").alias("conversions")
    )
    return counts.withColumns(
        {
            "converted": F.col("conversions") / F.col("journeys"),
            "search_social": F.col("has_search") * F.col("has_social"),
            "search_email": F.col("has_search") * F.col("has_email"),
            "social_email": F.col("has_social") * F.col("has_email"),
        }
    )


def interaction_test(touches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Likelihood-ratio test of the three interactions, and their coefficients.

    All predictors are flags, so the fits run on one row per combination: its share of
    conversions, weighted by its journeys. The likelihood ratio is that of single rows.
    """
    counts, plain, full = _interaction_fits(touches)
    statistic = float(plain.summary.deviance - full.summary.deviance)
    test = touches.sparkSession.createDataFrame(
        [(statistic, len(INTERACTIONS), chi2_tail(statistic, len(INTERACTIONS)))],
        "lr_statistic double, df int, p_value double",
    )
    terms = coefficient_table(full, [*MAIN_EFFECTS, *INTERACTIONS])
    return test, terms.filter(F.col("term").isin(*INTERACTIONS))


def _interaction_fits(touches: DataFrame):
    counts = freeze(interaction_counts(touches)).coalesce(1)
    return counts, _logit(counts, MAIN_EFFECTS, "journeys"), _logit(counts, [*MAIN_EFFECTS, *INTERACTIONS], "journeys")


def interaction_score_equations(touches: DataFrame) -> DataFrame:
    """``score_equations`` of the models without and with interactions, with the likelihood of each.

    ``log_likelihood`` is that of single journeys; twice the difference of the two is the likelihood ratio.
    """
    counts, plain, full = _interaction_fits(touches)
    parts = []
    for name, model, inputs in (("main", plain, MAIN_EFFECTS), ("interactions", full, [*MAIN_EFFECTS, *INTERACTIONS])):
        scored = model.transform(VectorAssembler(inputCols=inputs, outputCol="features").transform(counts))
        p, n, k = F.col("prediction"), F.col("journeys"), F.col("conversions")
        # at most 16 rows
        likelihood = scored.agg(F.sum(k * F.log(p) + (n - k) * F.log1p(-p))).first()[0]
        equations = score_equations(scored, inputs, "journeys")
        parts.append(equations.withColumns({"model": F.lit(name), "log_likelihood": F.lit(likelihood)}))
    return parts[0].unionByName(parts[1])


def save_model(model: PipelineModel, path: str) -> None:
    """Overwrite a saved pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
