"""Sources/sinks, the training workflow end to end, and the streaming scorer."""

import json
import os
import tempfile


import pytest
from pyspark.sql import functions as F

from attrition.functions.features import numeric_columns
from attrition.operators import decide
from attrition.plans.scoring import score_batch
from attrition.plans.training import evaluate, train_workflow
from attrition.schema import RAW_SCHEMA
from attrition.sources import files
from attrition.sources.profile import customer_profile
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw(spark):
    """The profile in the raw churn-table layout (RowNumber, Surname added)."""
    p = customer_profile(spark, SF_SMALL)
    return p.select(F.col("CustomerId").cast("int").alias("RowNumber"), "CustomerId",
                    F.concat(F.lit("S"), F.col("CustomerId").cast("string")).alias("Surname"),
                    *[c for c in RAW_SCHEMA.fieldNames() if c not in
                      ("RowNumber", "CustomerId", "Surname")]).cache()


def test_csv_roundtrip_and_json_params(spark, raw):
    d = tempfile.mkdtemp(prefix="attrition-io-")
    files.write_csv(raw, os.path.join(d, "in"))
    back = files.read_csv(spark, os.path.join(d, "in"))
    assert back.schema == RAW_SCHEMA
    assert back.count() == raw.count()
    assert back.exceptAll(raw).count() == 0
    files.write_json_params(spark, {"max_iter": 20, "step_size": 0.1}, os.path.join(d, "p"))
    part = [f for f in os.listdir(os.path.join(d, "p")) if f.endswith(".json")][0]
    assert json.loads(open(os.path.join(d, "p", part)).readline()) == {
        "max_iter": "20", "step_size": "0.1"}


def test_drop_ids_and_numeric_columns(raw):
    feats = decide.drop_ids(raw)
    assert "CustomerId" not in feats.columns and "Exited" not in feats.columns
    with pytest.raises(ValueError):
        decide.drop_ids(feats, strict=True)
    assert numeric_columns(feats) == ["CreditScore", "Age", "Tenure", "Balance", "NumOfProducts",
                                      "HasCrCard", "IsActiveMember", "EstimatedSalary"]


def test_training_workflow_small(spark, raw):
    res = train_workflow(spark, raw.drop("RowNumber", "Surname"), n_trials=2, k=3,
                         families=["Logistic Regression"],
                         strategies=["class_weight", "SMOTE"])
    ranked = res.comparison.orderBy("rank").collect()
    assert len(ranked) == 2 and ranked[0]["Score"] >= ranked[1]["Score"]
    assert res.trials.count() == 2 and 0.0 <= res.threshold <= 1.0
    assert res.best_params["C"] > 0
    status = evaluate(res.test_scores, res.threshold).collect()
    assert {r["Metric"] for r in status} == {"ROC-AUC", "F1", "Recall", "Precision"}
    out = score_batch(raw, res.model, res.threshold, res.calibrator)
    assert out.count() == raw.count()
    assert out.where(F.col("Churn_Probability").isNull()).count() == 0


def test_streaming_scorer(spark, raw):
    from attrition.operators import models
    from attrition.streaming.scoring import start_scoring
    d = tempfile.mkdtemp(prefix="attrition-stream-")
    files.write_csv(raw.limit(40), os.path.join(d, "in"))
    m = models.strategy_pipeline("Logistic Regression", "class_weight").fit(raw)
    q = start_scoring(spark, os.path.join(d, "in"), m, 0.5, os.path.join(d, "out"),
                      os.path.join(d, "ck"))
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(os.path.join(d, "out", "*"))
    assert got.count() == 40
    assert got.columns[:4] == ["CustomerId", "Churn_Probability", "Churn_Prediction", "Risk_Level"]

