"""Category columns with many values: one sparse vector, the same table as the dense columns for few."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from attrition.operators import models, preprocess
from attrition.operators.preprocess import FeatureStages, feature_names
from attrition.schema import CAT_FEATURES, NUM_FEATURES, PASSTHROUGH_FEATURES
from attrition.sources.profile import customer_profile
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def profile(spark):
    return customer_profile(spark, SF_SMALL).cache()


def vectors(model, df):
    return {r[0]: r[1] for r in model.transform(df).select("CustomerId", vector_to_array("features")).collect()}


def test_same_table_for_few_categories(spark, profile, tmp_path):
    parts = (NUM_FEATURES, CAT_FEATURES, PASSTHROUGH_FEATURES)
    dense = FeatureStages(*parts).fit(profile)
    # Only Geography has more than three values: it alone is sparse, in its place.
    sparse = FeatureStages(*parts, max_categories=3).fit(profile)
    assert feature_names(sparse) == feature_names(dense) and len(sparse.stages) == len(dense.stages) + 2
    odd = profile.limit(3).withColumn("CustomerId", -F.col("CustomerId")).withColumn(
        "Geography", F.when(F.col("CustomerId") % 2 == 0, "NOWHERE"))
    both = profile.unionByName(odd)
    a, b = vectors(dense, both), vectors(sparse, both)
    assert a.keys() == b.keys() and all(a[k] == b[k] for k in a)
    sparse.write().overwrite().save(str(tmp_path / "stages"))
    assert vectors(PipelineModel.load(str(tmp_path / "stages")), both) == b


def test_fit_with_a_sparse_column_equals_the_dense_fit(profile):
    dense = models.strategy_pipeline("Logistic Regression", "class_weight", tol=1e-12).fit(profile)
    pipeline = models.build_pipeline(models.logistic(weighted=True, tol=1e-12), weight_mode="balanced", max_categories=3)
    sparse = pipeline.fit(profile)
    assert np.abs(dense.stages[-1].coefficients.toArray() - sparse.stages[-1].coefficients.toArray()).max() < 1e-6


def test_a_hundred_thousand_categories(spark):
    wide = spark.range(100_000).select(F.col("id").alias("CustomerId"), F.format_string("v%06d", "id").alias("c"), (F.col("id") % 7).alias("x"))
    stages = preprocess.fit_sparse(wide, "c")
    out = PipelineModel(stages=stages).transform(wide.where("CustomerId % 9973 = 0").unionByName(
        spark.createDataFrame([(-1, "new", 0), (-2, None, 0)], "CustomerId long, c string, x long")))
    for r in out.select("CustomerId", "c__onehot").collect():
        v = r["c__onehot"]
        assert v.size == 99_999
        assert v.indices.tolist() == ([r["CustomerId"] - 1] if r["CustomerId"] > 0 else [])


def test_beyond_the_most(spark, monkeypatch):
    monkeypatch.setattr(preprocess, "MAX_SPARSE", 5)
    with pytest.raises(ValueError, match="too many"):
        preprocess.fit_sparse(spark.range(8).select(F.col("id").cast("string").alias("c")), "c")
