"""Learners and the training pipeline.

``build_pipeline`` returns an ``AttritionPipeline``: an Estimator that fits the
feature stages on the training rows, optionally resamples the transformed
training rows (SMOTE / ADASYN: training only, never at transform time), fits
the classifier and returns a plain ``PipelineModel`` (savable, streamable).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.operators import imbalance
from attrition.operators.newton_boost import NewtonBoostedTrees
from attrition.operators.preprocess import MAX_CATEGORIES, FeatureStages
from attrition.session import materialize
from attrition.schema import (CAT_FEATURES, KEY, NUM_FEATURES, PASSTHROUGH_FEATURES, SEED_SPLIT,
                              TARGET)

STRATEGIES = ["class_weight", "SMOTE", "ADASYN"]


def logistic(C: float = 1.0, max_iter: int = 1000, weighted: bool = False, n: int | None = None,
             tol: float = 1e-4, penalty: str | None = "l2", **kw) -> LogisticRegression:
    """L2 logistic regression; sklearn's C maps to regParam = 1 / (C * n) and
    its default stopping tolerance 1e-4 is kept. ``penalty=None``: C is not used."""
    lr = LogisticRegression(maxIter=max_iter, elasticNetParam=0.0, standardization=False,
                            tol=tol, labelCol=TARGET, featuresCol="features", **kw)
    if penalty is None:
        lr.setRegParam(0.0)
    lr._attr_C = C  # n is known only at fit time
    if weighted:
        lr.setWeightCol("weight")
    if n and penalty:
        lr.setRegParam(1.0 / (C * n))
    return lr


def random_forest(num_trees: int = 200, max_depth: int = 5, min_instances: int = 1,
                  feature_subset: str = "auto", seed: int = SEED_SPLIT,
                  weighted: bool = False, **kw) -> RandomForestClassifier:
    rf = RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, seed=seed,
                                minInstancesPerNode=min_instances, featureSubsetStrategy=feature_subset,
                                labelCol=TARGET, featuresCol="features", **kw)
    if weighted:
        rf.setWeightCol("weight")
    return rf


def boosted_trees(max_iter: int = 100, step_size: float = 0.1, max_depth: int = 3,
                  subsampling_rate: float = 1.0, seed: int = SEED_SPLIT, weighted: bool = False,
                  **kw) -> GBTClassifier:
    gbt = GBTClassifier(maxIter=max_iter, stepSize=step_size, maxDepth=max_depth,
                        subsamplingRate=subsampling_rate, seed=seed, labelCol=TARGET,
                        featuresCol="features", **kw)
    if weighted:
        gbt.setWeightCol("weight")
    return gbt


def newton_boosted(max_iter: int = 100, step_size: float = 0.1, max_depth: int = 3, l2: float = 3.0,
                   subsampling_rate: float = 1.0, seed: int = SEED_SPLIT, weighted: bool = False) -> NewtonBoostedTrees:
    """Boosting with Newton steps and an L2 term on the leaves (see ``newton_boost``)."""
    boost = NewtonBoostedTrees(maxIter=max_iter, stepSize=step_size, maxDepth=max_depth, l2=l2,
                               subsamplingRate=subsampling_rate, seed=seed)
    return boost.setWeightCol("weight") if weighted else boost


#: Families of the comparison grid.
GRID: dict[str, Callable[..., Estimator]] = {
    "Logistic Regression": logistic,
    "Random Forest": random_forest,
    "Boosted Trees": boosted_trees,
}
FAMILIES: dict[str, Callable[..., Estimator]] = {**GRID, "Newton Boosted Trees": newton_boosted}


class AttritionPipeline(Estimator):
    def __init__(self, classifier: Estimator, num: list[str] = NUM_FEATURES,
                 cat: list[str] = CAT_FEATURES, passthrough: list[str] = PASSTHROUGH_FEATURES,
                 use_smote: bool = False, use_adasyn: bool = False,
                 weight_mode: str | None = None, label: str = TARGET, key: str = KEY,
                 extra_features: dict[str, str] | None = None, max_categories: int = MAX_CATEGORIES,
                 steps: list[str] | None = None):
        super().__init__()
        if use_smote and use_adasyn:
            raise ValueError("a pipeline can resample with SMOTE or with ADASYN, not with both")
        self.classifier = classifier
        self.features = FeatureStages(num, cat, passthrough, extra_features=extra_features,
                                      max_categories=max_categories, steps=steps)
        self.use_smote, self.use_adasyn = use_smote, use_adasyn
        self.weight_mode, self.label, self.key = weight_mode, label, key

    def preparation(self) -> tuple:
        """What the rows that the classifier sees hang on, weights apart."""
        return (type(self), self.features.signature(), self.use_smote, self.use_adasyn, self.label, self.key)

    def _fit(self, df: DataFrame) -> PipelineModel:
        return self.fit_prepared(*self.prepare(df))

    def prepare(self, df: DataFrame, once: Callable = imbalance.made) -> tuple[PipelineModel, DataFrame]:
        """Fitted feature stages and the rows that the classifier sees, resampled if asked for. ``once``:
        keeps by its key what pipelines have in common that are fitted on the same rows."""
        own = (self.features.signature(), self.label, self.key)
        fm = once(("stages", *own), lambda: self.features.fit(df))
        x = fm.transform(df)
        if self.use_smote or self.use_adasyn:
            sampler = imbalance.smote if self.use_smote else imbalance.adasyn
            # The neighbour search reads the transformed rows several times:
            # cut the lineage once, and again after resampling.
            x = once(("rows", *own), lambda: materialize(fm.transform(df).select(self.key, "features", self.label), "train-x"))
            x = materialize(sampler(x, label=self.label, features="features", key=self.key,
                                    once=lambda key, make: once((*own, *key), make))
                            .select("features", self.label), "resampled")
        return fm, x

    def fit_prepared(self, fm: PipelineModel, x: DataFrame) -> PipelineModel:
        clf = self.classifier.copy()
        counts = None
        if self.weight_mode:
            counts = imbalance.label_counts(x, self.label)
            x = imbalance.with_class_weight(x, self.label, self.weight_mode, counts=counts)
        if isinstance(clf, LogisticRegression) and hasattr(self.classifier, "_attr_C") \
                and not clf.isSet(clf.regParam):
            n = sum(counts.values()) if counts else x.count()
            clf.setRegParam(1.0 / (self.classifier._attr_C * n))
        model = clf.fit(x)
        return PipelineModel(stages=[*fm.stages, model])


def build_pipeline(classifier: Estimator, num_features: list[str] = NUM_FEATURES,
                   cat_features: list[str] = CAT_FEATURES,
                   passthrough_features: list[str] = PASSTHROUGH_FEATURES,
                   use_smote: bool = False, use_adasyn: bool = False,
                   weight_mode: str | None = None,
                   extra_features: dict[str, str] | None = None,
                   max_categories: int = MAX_CATEGORIES, steps: list[str] | None = None) -> AttritionPipeline:
    """``steps`` (functions from DataFrame to DataFrame, named ``module:function``) and
    ``extra_features`` (SQL expressions by name) are derived after the base features and saved with
    the pipeline; the latter are scaled with the numeric ones."""
    return AttritionPipeline(classifier, num_features, cat_features, passthrough_features,
                             use_smote, use_adasyn, weight_mode, extra_features=extra_features,
                             max_categories=max_categories, steps=steps)


def positive_probability(col: str = "probability") -> Column:
    """Probability of class 1 from the model's probability vector (JVM-side)."""
    return vector_to_array(F.col(col)).getItem(1)


def score(model: PipelineModel, df: DataFrame, key: str = KEY, label: str | None = TARGET) -> DataFrame:
    """``(key, [label,] p)`` for the rows of df."""
    out = model.transform(df)
    cols = [key] + ([F.col(label).cast("int").alias("y")] if label and label in df.columns else [])
    return out.select(*cols, positive_probability().alias("p"))


def strategy_pipeline(family: str, strategy: str, **params) -> AttritionPipeline:
    """Model x imbalance strategy, as in the comparison grid: class_weight uses
    the learner's weight column (balanced weights for LR/RF, n_neg/n_pos for
    boosted trees), SMOTE/ADASYN the plain learner plus the sampler."""
    weighted = strategy == "class_weight"
    clf = FAMILIES[family](weighted=weighted, **params)
    mode = None
    if weighted:
        mode = {"Boosted Trees": "positive"}.get(family, "balanced")
    return build_pipeline(clf, use_smote=strategy == "SMOTE", use_adasyn=strategy == "ADASYN",
                          weight_mode=mode)
