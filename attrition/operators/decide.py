"""Batch decisioning: predictions table, batch result, counts, top scores,
top factors and retention recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.functions import decisions as D
from attrition.schema import (FEATURE_ACTIONS, GENERAL_ACTION, ID_COLS, KEY, MAX_RECOMMENDATIONS,
                              TARGET, TOP_FACTORS)


def predictions_table(decided: DataFrame) -> DataFrame:
    """``(actual, predicted, probability, correct)`` per row."""
    return decided.select("actual", "predicted", "probability",
                          (F.col("actual") == F.col("predicted")).alias("correct"))


def predictions_summary(preds: DataFrame) -> DataFrame:
    return preds.agg(F.avg(F.col("correct").cast("double")).alias("accuracy"),
                     F.count(F.lit(1)).alias("rows"))


def drop_ids(df: DataFrame, strict: bool = False, cols=(*ID_COLS, TARGET)) -> DataFrame:
    """Drop id/target columns; strict mode (training) requires them all."""
    if strict:
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise ValueError(f"columns not found: {missing}")
    return df.drop(*cols)


def batch_result(scored: DataFrame, t: float, probability: str = "probability", key: str = KEY,
                 inputs: list[str] | None = None) -> DataFrame:
    """Key, rounded probability, CHURN/RETAIN, risk band, then the raw inputs.

    ``scored`` holds the raw rows and their ``probability`` side by side, so the result is a
    projection: no join, and repeated keys keep their rows."""
    inputs = inputs or drop_ids(scored.drop(probability)).columns
    p = F.col(probability)
    return scored.select(key, D.round_probability(p).alias("Churn_Probability"),
                         D.decision_label(D.decide(p, t)).alias("Churn_Prediction"),
                         D.risk_band(p, t).alias("Risk_Level"),
                         *[c for c in inputs if c != key])


def batch_counts(result: DataFrame) -> DataFrame:
    churn = F.col("Churn_Prediction") == "CHURN"
    return result.agg(F.count(F.lit(1)).alias("total"),
                      F.count(F.when(churn, 1)).alias("churn"),
                      F.count(F.when(~churn, 1)).alias("retain"))


def top_scores(result: DataFrame, k: int | None = None, col: str = "Churn_Probability") -> DataFrame:
    """Sort by probability descending (key breaks ties); ``k`` keeps a top-k report."""
    ordered = result.orderBy(F.col(col).desc(), F.col(KEY).asc())
    return ordered.limit(k) if k else ordered


def first_true_positive(decided: DataFrame, key: str = KEY) -> DataFrame:
    """The lowest-key customer who churned and was flagged."""
    return (decided.where((F.col("actual") == 1) & (F.col("predicted") == 1))
            .orderBy(key).limit(1))


# ---------------------------------------------------------------- SHAP-driven
def shap_arrays(shap_long: DataFrame, key: str = KEY) -> DataFrame:
    """One row per customer from a long SHAP table: ``factors``, an array of structs. The
    explainers also give this form directly (``linear_shap_arrays``), without a shuffle."""
    return shap_long.groupBy(key).agg(F.collect_list(
        F.struct("shap", "feature_idx", "feature", "value")).alias("factors"))


def _arrays(shap: DataFrame, key: str) -> DataFrame:
    return shap if "factors" in shap.columns else shap_arrays(shap, key)


def top_factors(shap: DataFrame, k: int = TOP_FACTORS, key: str = KEY) -> DataFrame:
    """Top k features per customer by |shap| (ties: later feature first),
    each marked Increases/Reduces Risk."""
    ordered = F.reverse(F.array_sort(F.transform("factors", lambda f: F.struct(
        F.abs(f["shap"]).alias("size"), f["feature_idx"].alias("idx"), f["feature"].alias("feature"),
        f["shap"].alias("shap")))))
    return (_arrays(shap, key).select(key, F.posexplode(F.slice(ordered, 1, k)).alias("pos", "f"))
            .select(key, (F.col("pos") + 1).alias("rank"), "f.feature", "f.shap",
                    F.when(F.col("f.shap") > 0, "Increases Risk").otherwise("Reduces Risk").alias("direction")))


def action_of(feature: Column, actions=FEATURE_ACTIONS) -> Column:
    """Struct (title, text) of the exact key, else of the first key the name starts with, else null."""
    pair = lambda a: F.struct(F.lit(a[1]).alias("title"), F.lit(a[2]).alias("text"))
    out = None
    for a in actions:
        out = F.when(feature == a[0], pair(a)) if out is None else out.when(feature == a[0], pair(a))
    for a in actions:
        out = out.when(feature.startswith(a[0]), pair(a))
    return out


def recommendations(shap: DataFrame, probability: DataFrame | None, t: float, key: str = KEY,
                    limit: int = MAX_RECOMMENDATIONS, actions=FEATURE_ACTIONS,
                    general=GENERAL_ACTION) -> DataFrame:
    """Up to ``limit`` retention actions per customer at or above the threshold.

    Features with positive shap (all features when none is positive) in descending shap order;
    the action is the exact key match, else the first map key the feature name starts with; one
    action per title; a customer with no matching action gets the general one. ``actions``:
    (feature or prefix, title, text) in lookup order. ``probability`` None: ``shap`` has the
    column beside its ``factors``, and nothing is joined or shuffled.
    """
    rows = _arrays(shap, key)
    if probability is not None:
        rows = rows.join(probability.select(key, "probability"), key)
    flagged = rows.where(F.col("probability") >= F.lit(float(t)))
    anywhere = F.exists("factors", lambda f: f["shap"] > 0)
    told = F.transform(
        F.reverse(F.array_sort(F.filter("factors", lambda f: ~anywhere | (f["shap"] > 0)))),
        lambda f: F.struct(action_of(f["feature"], actions).alias("action"), f["feature"].alias("feature"),
                           f["shap"].alias("shap")))
    known = F.filter(told, lambda x: x["action"].isNotNull())
    # A title counts once, at its first place: keep entries whose title has no earlier entry.
    once = F.filter("known", lambda x, i: ~F.exists(
        F.slice("known", F.lit(1), i), lambda y: y["action"]["title"] == x["action"]["title"]))
    none = F.array(F.struct(F.struct(F.lit(general[0]).alias("title"), F.lit(general[1]).alias("text")).alias("action"),
                            F.lit(None).cast("string").alias("feature"), F.lit(0.0).alias("shap")))
    picked = flagged.select(key, known.alias("known")).select(key, F.slice(once, 1, limit).alias("picked"))
    return (picked.select(key, F.posexplode(F.when(F.size("picked") > 0, F.col("picked")).otherwise(none)).alias("pos", "x"))
            .select(key, (F.col("pos") + 1).alias("rank"), "x.action.title", "x.action.text", "x.feature", "x.shap"))
