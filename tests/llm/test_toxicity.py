"""Held-out quality, the label model on known rates, the linear fit, odd rows."""

import numpy as np
from pyspark.sql import types as T

from journeyloom.llm.toxicity import fit_linear, label_model, score_toxicity, without_toxic

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("toxic", T.StringType()), ("score", T.StringType()))])
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    toxic = found[found.toxic == 1]
    assert (toxic.predicted == 1).mean() > 0.85
    assert found[found.predicted == 1].toxic.mean() > 0.95
    assert found.score.between(0, 1).all()


def test_label_model_recovers_labels():
    rng = np.random.default_rng(0)
    y = (rng.random(4000) < 0.2).astype(int)
    rates = np.array([(0.6, 0.02), (0.5, 0.03), (0.4, 0.01), (0.55, 0.05)])
    votes = np.stack([rng.random(4000) < np.where(y == 1, a, b) for a, b in rates], 1)
    odds = np.where(votes, np.log(rates[:, 0] / rates[:, 1]), np.log((1 - rates[:, 0]) / (1 - rates[:, 1]))).sum(1) + np.log(0.2 / 0.8)
    best = ((odds > 0) == y).mean()
    votes = np.column_stack([votes, votes[:, 0], ~votes.any(1)])
    known = np.where(rng.random(4000) < 0.3, y, -1)
    p = label_model(votes, known)
    assert ((p > 0.5) == y)[known < 0].mean() > best - 0.03


def test_linear_fit_separates():
    rows, places = np.array([0, 1, 2, 3, 0, 2]), np.array([0, 1, 0, 1, 2, 2])
    weights, bias = fit_linear(rows, places, 3, np.array([1.0, 0.0, 1.0, 0.0]))
    assert weights[0] + weights[2] + bias > 0.5 > -0.5 > weights[1] + bias


def test_odd_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    none = spark.createDataFrame([], LABELS)
    assert score_toxicity(empty, none).count() == 0
    rows = [(1, None, "x", "y"), (2, "", None, None), (2, "", None, None), (None, "some words", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = score_toxicity(docs, spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 1), (2, 1, None)], LABELS)).collect()
    assert len(got) == 4 and all(0 <= r.score < 0.7 and r.predicted == 0 for r in got)
    assert without_toxic(docs, none).columns == docs.columns and without_toxic(docs, none).count() == 4
