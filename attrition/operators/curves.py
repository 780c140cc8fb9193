"""Exact distributed ranking curves, threshold choice and point metrics.

Input everywhere is a scored DataFrame with a 0/1 label column and a score
column. Curves first collapse rows to one row per distinct score (map-side
partial aggregation, one shuffle), then take cumulative counts with
``prefix_sums`` — never a window over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.operators.prefix import BUCKET, bucketed, cumulated, prefix_sums
from attrition.schema import F1_EPSILON, METRIC_TARGETS, RECALL_FLOOR


def score_counts(scored: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """``(threshold, n, pos, neg)``: one row per distinct score."""
    return (scored.groupBy(F.col(score).cast("double").alias("threshold"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.col(label).cast("long")).alias("pos"))
            .withColumn("neg", F.col("n") - F.col("pos")))


def cumulative_counts(scored: DataFrame, label: str = "y", score: str = "p",
                      num_buckets: int | None = None) -> DataFrame:
    """Per distinct score t: tp/fp = positives/negatives with score >= t, plus
    the class totals ``tot_pos`` and ``tot_neg`` on every row."""
    counts = score_counts(scored, label, score)
    cum = prefix_sums(counts, "threshold", ["pos", "neg"], num_buckets=num_buckets)
    # Class totals as scalar subqueries: evaluated once, inlined as values.
    return (cum.withColumns({"tot_pos": counts.agg(F.sum("pos")).scalar(),
                             "tot_neg": counts.agg(F.sum("neg")).scalar()})
            .withColumnRenamed("pos_cum", "tp").withColumnRenamed("neg_cum", "fp"))


def pr_curve(scored: DataFrame, label: str = "y", score: str = "p",
             with_end_point: bool = True) -> DataFrame:
    """Precision/recall per distinct threshold (rows with score >= t), F1 with
    the epsilon guard, plus the (precision 1, recall 0) end point with a null
    threshold. Recall is 1 everywhere when there are no positives."""
    cum = cumulative_counts(scored, label, score)
    tp, fp, P = F.col("tp"), F.col("fp"), F.col("tot_pos")
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(P > 0, tp / P).otherwise(F.lit(1.0))
    curve = cum.select("threshold", "tp", "fp", precision.alias("precision"),
                       recall.alias("recall"))
    if with_end_point:
        end = curve.sparkSession.createDataFrame(
            [(None, 0, 0, 1.0, 0.0)], "threshold double, tp long, fp long, "
                                      "precision double, recall double")
        curve = curve.unionByName(end)
    return with_f1(curve)


def with_f1(curve: DataFrame) -> DataFrame:
    p, r = F.col("precision"), F.col("recall")
    return curve.withColumn("f1", 2 * (p * r) / (p + r + F.lit(F1_EPSILON)))


def threshold_curve(scored: DataFrame, label: str = "y", score: str = "p",
                    recall_floor: float = RECALL_FLOOR) -> DataFrame:
    """PR curve points (no end point) with ``meets_floor`` and ``is_chosen``."""
    curve = pr_curve(scored, label, score, with_end_point=False)
    best = choose_threshold(curve, recall_floor).select("threshold").scalar()
    return curve.withColumns({"meets_floor": F.col("recall") >= F.lit(recall_floor),
                              "is_chosen": F.col("threshold") == best})


def choose_threshold(curve: DataFrame, recall_floor: float = RECALL_FLOOR) -> DataFrame:
    """Best F1 among points with recall >= floor; with none, the best F1
    overall. Ties go to the lowest threshold. One row."""
    pts = curve.where(F.col("threshold").isNotNull())
    meets = F.col("recall") >= F.lit(recall_floor)
    return (pts.withColumn("meets_floor", meets)
            .orderBy(F.col("meets_floor").desc(), F.col("f1").desc(), F.col("threshold").asc())
            .limit(1))


def best_threshold(scored: DataFrame, label: str = "y", score: str = "p",
                   recall_floor: float = RECALL_FLOOR) -> DataFrame:
    return choose_threshold(pr_curve(scored, label, score, with_end_point=False),
                            recall_floor).select("threshold", "precision", "recall", "f1",
                                                 "meets_floor")


def best_threshold_value(scored: DataFrame, label: str = "y", score: str = "p",
                         recall_floor: float = RECALL_FLOOR) -> float:
    """The chosen threshold as a Python float (one scalar to the driver)."""
    return float(best_threshold(scored, label, score, recall_floor).first()["threshold"])


def confusion_counts(scored: DataFrame, t, label: str = "y", score: str = "p") -> DataFrame:
    """One-row ``(tn, fp, fn, tp)`` at decision ``score >= t``."""
    pred = F.col(score) >= (t if not isinstance(t, (int, float)) else F.lit(float(t)))
    y = F.col(label) == 1
    return scored.agg(F.count(F.when(~y & ~pred, 1)).alias("tn"),
                      F.count(F.when(~y & pred, 1)).alias("fp"),
                      F.count(F.when(y & ~pred, 1)).alias("fn"),
                      F.count(F.when(y & pred, 1)).alias("tp"))


def point_metrics(scored: DataFrame, t: float, label: str = "y", score: str = "p") -> DataFrame:
    """Precision, recall, F1 (0 where a denominator is 0) and accuracy at t."""
    c = confusion_counts(scored, t, label, score)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(F.lit(0.0))
    acc = (tp + tn) / (tp + tn + fp + fn)
    return c.select(F.lit(float(t)).alias("threshold"), "tn", "fp", "fn", "tp",
                    precision.alias("precision"), recall.alias("recall"),
                    f1.alias("f1"), acc.alias("accuracy"))


def _wide(n):
    """Counts as 19 digits: products of two fit 38 digits, where a long would overflow."""
    return n.cast("decimal(19,0)")


def roc_auc(scored: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """Exact ROC-AUC, ties counted half, from per-score counts.

    2*P*N*AUC = sum over scores of pos * (2*neg_below + neg_tied) is summed in
    integers, so the result does not depend on summation order.
    """
    cum = cumulative_counts(scored, label, score)
    twice = _wide(F.col("pos")) * _wide(2 * (F.col("tot_neg") - F.col("fp")) + F.col("neg"))
    agg = cum.agg(F.sum(twice).alias("num2"), F.first("tot_pos").alias("P"),
                  F.first("tot_neg").alias("N"))
    return agg.select(F.when((F.col("P") > 0) & (F.col("N") > 0),
                             F.col("num2").cast("double") / (2.0 * F.col("P") * F.col("N")))
                      .alias("roc_auc"),
                      F.col("P").alias("positives"), F.col("N").alias("negatives"))


def roc_curve(scored: DataFrame, label: str = "y", score: str = "p") -> DataFrame:
    """``(threshold, fpr, tpr)`` per distinct score plus the origin (null threshold)."""
    cum = cumulative_counts(scored, label, score)
    fpr = F.when(F.col("tot_neg") > 0, F.col("fp") / F.col("tot_neg"))
    tpr = F.when(F.col("tot_pos") > 0, F.col("tp") / F.col("tot_pos"))
    curve = cum.select("threshold", fpr.alias("fpr"), tpr.alias("tpr"))
    origin = curve.sparkSession.createDataFrame([(None, 0.0, 0.0)],
                                                "threshold double, fpr double, tpr double")
    return curve.unionByName(origin)


def confusion_matrix(scored: DataFrame, t: float, label: str = "y", score: str = "p") -> DataFrame:
    """Rows actual 0/1, columns pred_0/pred_1, zeros filled."""
    pred = (F.col(score) >= F.lit(float(t))).cast("int")
    base = scored.select(F.col(label).cast("int").alias("actual"), pred.alias("predicted"))
    labels = base.sparkSession.createDataFrame([(0,), (1,)], "actual int")
    counts = base.groupBy("actual").pivot("predicted", [0, 1]).count()
    return (labels.join(counts, "actual", "left")
            .select("actual", F.coalesce(F.col("0"), F.lit(0)).cast("long").alias("pred_0"),
                    F.coalesce(F.col("1"), F.lit(0)).cast("long").alias("pred_1")))


def calibration_curve(scored: DataFrame, n_bins: int = 10, label: str = "y",
                      score: str = "p") -> DataFrame:
    """Equal-width bins on [0, 1]; a score on an inner edge falls in the lower
    bin; empty bins are omitted. ``(bin, n, mean_predicted, fraction_positive)``."""
    edges = inner_edges(n_bins)
    b = sum(((F.col(score) > F.lit(e)).cast("int") for e in edges), F.lit(0))
    return (scored.groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.avg(F.col(score)).alias("mean_predicted"),
                 F.avg(F.col(label).cast("double")).alias("fraction_positive")))


def inner_edges(n_bins: int) -> list[float]:
    step = 1.0 / n_bins
    return [i * step for i in range(1, n_bins)]


def targets_status(scored: DataFrame, t: float, label: str = "y", score: str = "p",
                   targets=METRIC_TARGETS) -> DataFrame:
    """Metric, Score, Target, Status (PASS when Score >= Target)."""
    auc = roc_auc(scored, label, score).select("roc_auc").scalar()
    wide = point_metrics(scored, t, label, score).withColumn("roc_auc", auc)
    names = {"ROC-AUC": "roc_auc", "F1": "f1", "Recall": "recall", "Precision": "precision"}
    spark = scored.sparkSession
    tgt = spark.createDataFrame([(i, m, float(v)) for i, (m, v) in enumerate(targets)],
                                "ord int, Metric string, Target double")
    long = wide.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("Metric"), F.col(names[m]).cast("double").alias("Score"))
        for m, _ in targets])).alias("s")).select("s.*")
    return (long.join(F.broadcast(tgt), "Metric")
            .select("Metric", "Score", "Target",
                    F.when(F.col("Score") >= F.col("Target"), "PASS").otherwise("FAIL")
                    .alias("Status"), "ord"))


def pr_operating_point(scored: DataFrame, t: float, floors=(0.50, 0.60), label: str = "y",
                       score: str = "p") -> DataFrame:
    """Operating point at t against the precision target and the recall floor."""
    pm = point_metrics(scored, t, label, score)
    p_floor, r_floor = floors
    return pm.select("threshold", "precision", "recall", "f1",
                     (F.col("precision") >= F.lit(p_floor)).alias("meets_precision_floor"),
                     (F.col("recall") >= F.lit(r_floor)).alias("meets_recall_floor"))


def majority_baseline(df: DataFrame, label: str = "Exited") -> DataFrame:
    c = df.groupBy(label).count()
    return c.agg((F.max("count") / F.sum("count")).alias("majority_accuracy"),
                 F.sum("count").alias("rows"))


def metrics_by_fold(scored: DataFrame, t: float = 0.5, fold: str = "fold",
                    label: str = "y", score: str = "p", distinct: bool = False) -> DataFrame:
    """Per-fold ROC-AUC (null in a fold with one class), F1 and recall at t.

    ``distinct``: hardly any scores are equal. Rows are then dealt once, by fold and score range,
    instead of being counted by score first; labels must not be null."""
    n_pos = [F.count(F.lit(1)).alias("n"), F.sum("pos").alias("pos")]
    rows = scored.select(fold, F.col(score).cast("double").alias("threshold"), F.col(label).cast("long").alias("pos"))
    neg = F.col("n") - F.col("pos")
    # Rank-sum per fold: negatives strictly below each score inside its fold.
    if distinct:
        rows = bucketed(rows, "threshold")
        totals = rows.groupBy(fold, BUCKET).agg(*n_pos).select(fold, BUCKET, neg.alias("neg"))
        counts = rows.repartition(fold, BUCKET).groupBy(fold, BUCKET, "threshold").agg(*n_pos).withColumn("neg", neg)
        cum = cumulated(counts, totals, "threshold", ["neg"], descending=False, partition_by=[fold])
    else:
        counts = rows.groupBy(fold, "threshold").agg(*n_pos).withColumn("neg", neg)
        cum = prefix_sums(counts, "threshold", ["neg"], descending=False, partition_by=[fold])
    below = cum.withColumn("neg_below", F.col("neg_cum") - F.col("neg"))
    auc = (below.groupBy(fold)
           .agg(F.sum(_wide(F.col("pos")) * _wide(2 * F.col("neg_below") + F.col("neg"))).alias("num2"),
                F.sum("pos").alias("P"), F.sum("neg").alias("N"))
           .select(fold, F.when((F.col("P") > 0) & (F.col("N") > 0),
                                F.col("num2").cast("double") / (2.0 * F.col("P") * F.col("N"))).alias("roc_auc")))
    pred = F.col(score) >= F.lit(float(t))
    y = F.col(label) == 1
    pts = (scored.groupBy(fold)
           .agg(F.count(F.when(y & pred, 1)).alias("tp"),
                F.count(F.when(~y & pred, 1)).alias("fp"),
                F.count(F.when(y & ~pred, 1)).alias("fn")))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    pts = pts.select(fold,
                     F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn))
                     .otherwise(F.lit(0.0)).alias("f1"),
                     F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0)).alias("recall"))
    return auc.join(pts, fold)


def mean_over_folds(per_fold: DataFrame) -> DataFrame:
    return per_fold.agg(F.avg("roc_auc").alias("roc_auc"), F.avg("f1").alias("f1"),
                        F.avg("recall").alias("recall"), F.count(F.lit(1)).alias("folds"))
