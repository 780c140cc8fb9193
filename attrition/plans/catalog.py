"""Registered queries: a Spark plan and, where SQL can say it, a DuckDB oracle.

Every query reads the driver's tables (through the customer profile or the
scored fixture derived from them) and runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.functions import decisions as D
from attrition.functions.features import engineer
from attrition.operators import audit, curves, eda, split
from attrition.plans.oracle_sql import calibration_bin_sql, with_ctes
from attrition.schema import INPUT_COLS, KEY, TARGET
from attrition.sources.profile import customer_profile, fixture_score, scored_fixture

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ROUND = 9


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, cols: list[str], digits: int = ROUND) -> DataFrame:
    """Round float results whose last bits depend on summation order."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# ---------------------------------------------------------------- inputs
def profile(spark, sf_dir) -> DataFrame:
    """The customer profile, materialised once per query into the shared
    checkpoint folder: every later job of the query (scalar subqueries, the
    threshold, bucket edges, fitted parameters) reads it instead of
    re-aggregating the orders."""
    from attrition.session import materialize
    return materialize(customer_profile(spark, sf_dir), "profile")


def train(spark, sf_dir) -> DataFrame:
    return split.split_frames(profile(spark, sf_dir))[0]


def scored(spark, sf_dir) -> DataFrame:
    return scored_fixture(profile(spark, sf_dir))


def decided(spark, sf_dir, prof: DataFrame | None = None) -> tuple[DataFrame, float]:
    """Decisions on the scored fixture; ``prof``: the query's profile, if it has one already."""
    s = scored_fixture(prof) if prof is not None else scored(spark, sf_dir)
    t = curves.best_threshold_value(s)
    return (s.select(KEY, F.col("y").alias("actual"), F.col("p").alias("probability"),
                     D.decide("p", t).alias("predicted")), t)


# ------------------------------------------------------ profile & features
register("customer_profile", with_ctes(["profile"], "SELECT * FROM profile"))(
    lambda spark, sf_dir: customer_profile(spark, sf_dir))

DIMS = ["Geography", "IsActiveMember", "NumOfProducts"]


@register("rate_by_group", with_ctes(["train"], """
  SELECT dimension, value, CAST(count(*) AS BIGINT) AS n,
         CAST(sum(Exited) AS DOUBLE) * 100 / count(*) AS churn_rate,
         (SELECT CAST(sum(Exited) AS DOUBLE) * 100 / count(*) FROM train) AS overall_rate
  FROM (SELECT 'Geography' AS dimension, Geography AS value, Exited FROM train
        UNION ALL SELECT 'IsActiveMember', CAST(IsActiveMember AS VARCHAR), Exited FROM train
        UNION ALL SELECT 'NumOfProducts', CAST(NumOfProducts AS VARCHAR), Exited FROM train)
  GROUP BY dimension, value"""))
def q_rate_by_group(spark, sf_dir):
    return eda.rate_by_group(train(spark, sf_dir), DIMS)


@register("audit_duplicates", with_ctes(["profile"], """
  SELECT CAST(sum(c) AS BIGINT) AS rows, CAST(12 AS BIGINT) AS columns,
         CAST(sum(c - 1) AS BIGINT) AS duplicates
  FROM (SELECT count(*) AS c FROM profile GROUP BY CustomerId, CreditScore, Geography, Gender,
        Age, Tenure, Balance, NumOfProducts, HasCrCard, IsActiveMember, EstimatedSalary, Exited) g"""))
def q_audit_duplicates(spark, sf_dir):
    return audit.duplicates(customer_profile(spark, sf_dir))


_AUDIT_TYPES = [("CustomerId", "int", True), ("CreditScore", "int", True),
                ("Geography", "string", False), ("Gender", "string", False),
                ("Age", "int", True), ("Tenure", "int", True), ("Balance", "float", True),
                ("NumOfProducts", "int", True), ("HasCrCard", "int", True),
                ("IsActiveMember", "int", True), ("EstimatedSalary", "float", True),
                ("Exited", "int", True)]


def _audit_sql() -> str:
    rows = []
    for i, (c, t, num) in enumerate(_AUDIT_TYPES):
        mn = f"CAST(min({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"
        mx = f"CAST(max({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)"
        rows.append(f"SELECT {i} AS position, '{c}' AS column, '{t}' AS dtype, "
                    f"CAST(count(*) - count({c}) AS BIGINT) AS nulls, "
                    f"CAST(count(DISTINCT {c}) AS BIGINT) AS distinct, {mn} AS min, {mx} AS max "
                    f"FROM profile")
    return with_ctes(["profile"], "\nUNION ALL\n".join(rows))


@register("audit_columns", _audit_sql())
def q_audit_columns(spark, sf_dir):
    return audit.column_audit(customer_profile(spark, sf_dir)).withColumn(
        "position", F.col("position").cast("int"))


@register("derived_features", with_ctes(["features"], """
  SELECT CustomerId, round(BalanceSalaryRatio, 9) AS BalanceSalaryRatio, IsActive_by_CreditCard,
         round(ProductsPerYear, 9) AS ProductsPerYear, AgeGroup FROM features"""))
def q_derived_features(spark, sf_dir):
    df = engineer(customer_profile(spark, sf_dir))
    return rounded(df.select(KEY, "BalanceSalaryRatio", "IsActive_by_CreditCard",
                             "ProductsPerYear", "AgeGroup"),
                   ["BalanceSalaryRatio", "ProductsPerYear"])


@register("age_group", with_ctes(["features"], """
  SELECT AgeGroup, CAST(count(*) AS BIGINT) AS n, min(Age) AS min_age, max(Age) AS max_age
  FROM features GROUP BY AgeGroup"""))
def q_age_group(spark, sf_dir):
    return (engineer(customer_profile(spark, sf_dir)).groupBy("AgeGroup")
            .agg(F.count(F.lit(1)).alias("n"), F.min("Age").alias("min_age"),
                 F.max("Age").alias("max_age")))


def age_balance(df: DataFrame) -> DataFrame:
    """Example caller-supplied feature: Age x Balance."""
    return df.withColumn("AgeBalance", F.col("Age") * F.col("Balance"))


@register("extra_features", with_ctes(["features"], """
  SELECT CustomerId, AgeGroup, round(Age * Balance, 9) AS AgeBalance FROM features"""))
def q_extra_features(spark, sf_dir):
    df = engineer(customer_profile(spark, sf_dir), extra_features=[age_balance])
    return rounded(df.select(KEY, "AgeGroup", "AgeBalance"), ["AgeBalance"])


_NUMERIC_INPUTS = [c for c in INPUT_COLS if c not in ("Geography", "Gender")]


def _unpivot_sql() -> str:
    parts = []
    for i, c in enumerate(INPUT_COLS):
        if c in _NUMERIC_INPUTS:
            parts.append(f"SELECT CustomerId, {i} AS position, '{c}' AS feature, "
                         f"CAST({c} AS DOUBLE) AS value_num, CAST(NULL AS VARCHAR) AS value_str "
                         f"FROM profile")
        else:
            parts.append(f"SELECT CustomerId, {i} AS position, '{c}' AS feature, "
                         f"CAST(NULL AS DOUBLE) AS value_num, {c} AS value_str FROM profile")
    return with_ctes(["profile"], "\nUNION ALL\n".join(parts))


@register("unpivot_inputs", _unpivot_sql())
def q_unpivot_inputs(spark, sf_dir):
    df = customer_profile(spark, sf_dir)
    return df.select(KEY, F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"),
                 (F.col(c).cast("double") if c in _NUMERIC_INPUTS else F.lit(None).cast("double"))
                 .alias("value_num"),
                 (F.lit(None).cast("string") if c in _NUMERIC_INPUTS else F.col(c))
                 .alias("value_str"))
        for i, c in enumerate(INPUT_COLS)])).alias("u")).select(KEY, "u.*")


@register("row_detail", with_ctes(["features"], """
  SELECT * FROM features WHERE CustomerId = (SELECT min(CustomerId) FROM features)"""))
def q_row_detail(spark, sf_dir):
    df = engineer(customer_profile(spark, sf_dir))
    first = df.agg(F.min(KEY)).scalar()
    return df.where(F.col(KEY) == first)


# ------------------------------------------------------------- splits
@register("split_stratified", with_ctes(["split"], "SELECT CustomerId, Exited, is_test FROM split"))
def q_split(spark, sf_dir):
    return split.stratified_split(profile(spark, sf_dir)).select(KEY, TARGET, "is_test")


@register("split_summary", with_ctes(["split"], """
  SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split,
         CAST(count(*) AS BIGINT) AS rows, avg(CAST(Exited AS DOUBLE)) AS churn_rate
  FROM split GROUP BY 1"""))
def q_split_summary(spark, sf_dir):
    return audit.split_summary(split.stratified_split(profile(spark, sf_dir)))


@register("folds_stratified", with_ctes(["folds"], "SELECT CustomerId, Exited, fold FROM folds"))
def q_folds(spark, sf_dir):
    return split.stratified_folds(train(spark, sf_dir)).select(KEY, TARGET, "fold")


# ------------------------------------------------------------- EDA
@register("class_counts", with_ctes(["train"], """
  SELECT Exited AS label, CAST(count(*) AS BIGINT) AS n,
         CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM train) AS percent
  FROM train GROUP BY Exited"""))
def q_class_counts(spark, sf_dir):
    return eda.class_counts(train(spark, sf_dir))


def _kde_sql(col: str) -> str:
    return f"""
  SELECT '{col}' AS column, s.label, g.i AS grid_index,
         round(s.gmin + (s.gmax - s.gmin) * g.i / 199, 3) AS x,
         round(sum(c.cnt * exp(-0.5 * ((s.gmin + (s.gmax - s.gmin) * g.i / 199 - c.v) / s.bw)
                                    * ((s.gmin + (s.gmax - s.gmin) * g.i / 199 - c.v) / s.bw)))
               * {eda.GAUSS_NORM!r} / (s.n * s.bw), 11) AS density
  FROM (SELECT Exited AS label, CAST({col} AS DOUBLE) AS v, count(*) AS cnt
        FROM train WHERE {col} IS NOT NULL GROUP BY 1, 2) c
  JOIN (SELECT label, n, bw, lo - bw * 3.0 AS gmin, hi + bw * 3.0 AS gmax
        FROM (SELECT Exited AS label, count(*) AS n,
                     stddev_samp(CAST({col} AS DOUBLE)) * pow(CAST(count(*) AS DOUBLE), -0.2) AS bw,
                     min(CAST({col} AS DOUBLE)) AS lo, max(CAST({col} AS DOUBLE)) AS hi
              FROM train WHERE {col} IS NOT NULL GROUP BY Exited)) s ON c.label = s.label
  CROSS JOIN range(0, 200) g(i)
  GROUP BY s.label, g.i, s.gmin, s.gmax, s.n, s.bw"""


KDE_COLS = ["Age", "CreditScore", "Balance", "EstimatedSalary"]


@register("kde_by_class", with_ctes(["train"], "\nUNION ALL\n".join(map(_kde_sql, KDE_COLS))))
def q_kde(spark, sf_dir):
    t = train(spark, sf_dir)
    out = eda.kde_by_class(t, KDE_COLS[0])
    for c in KDE_COLS[1:]:
        out = out.unionByName(eda.kde_by_class(t, c))
    # Grid positions (up to some 100,000, from a bandwidth whose last bit differs between
    # engines) are compared at 3 decimals; densities (down to 1e-6) at 11.
    out = rounded(out.withColumn("grid_index", F.col("grid_index").cast("bigint")), ["x"], 3)
    return rounded(out, ["density"], 11)


CORR_COLS = ["CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "HasCrCard",
             "IsActiveMember", "EstimatedSalary", "Exited"]


def _corr_sql(body: str) -> str:
    pairs = [(b, a) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]
    sel = "\nUNION ALL\n".join(
        f"SELECT '{r}' AS row_feature, '{c}' AS col_feature, "
        f"corr(CAST({r} AS DOUBLE), CAST({c} AS DOUBLE)) AS r FROM train" for r, c in pairs)
    return with_ctes(["train"], f"SELECT * FROM ({body.format(sel=sel)})")


@register("correlation_matrix", _corr_sql(
    "SELECT row_feature, col_feature, round(r, 9) AS r FROM ({sel})"))
def q_corr(spark, sf_dir):
    return rounded(eda.correlation_matrix(train(spark, sf_dir), CORR_COLS), ["r"])


#: The audit's threshold and a lower one.
HIGH_CORR = [0.7, 0.1]
HIGH_CORR_COLS = [*CORR_COLS, "BalanceSalaryRatio", "ProductsPerYear"]


def _high_corr_sql() -> str:
    value = {c: c for c in CORR_COLS} | {"BalanceSalaryRatio": "Balance / (EstimatedSalary + 1)",
                                         "ProductsPerYear": "NumOfProducts / (Tenure + 1)"}
    return with_ctes(["train"], "\nUNION ALL\n".join(
        f"SELECT CAST({t!r} AS DOUBLE) AS threshold, '{min(a, b)}' AS feature_1, '{max(a, b)}' AS feature_2, round(abs(r), 9) AS abs_r "
        f"FROM (SELECT corr(CAST({value[a]} AS DOUBLE), CAST({value[b]} AS DOUBLE)) AS r FROM train) WHERE abs(r) > {t!r}"
        for t in HIGH_CORR for i, a in enumerate(HIGH_CORR_COLS) for b in HIGH_CORR_COLS[i + 1:]))


@register("high_correlation_pairs", _high_corr_sql())
def q_high_corr(spark, sf_dir):
    """Strongly correlated pairs among inputs, target and derived ratios, at both thresholds."""
    c = eda.correlation_matrix(engineer(train(spark, sf_dir)), HIGH_CORR_COLS)
    out = [eda.high_correlation_pairs(c, t).select(F.lit(t).alias("threshold"), "*") for t in HIGH_CORR]
    return rounded(out[0].unionByName(out[1]), ["abs_r"])


@register("majority_baseline", with_ctes(["profile"], """
  SELECT max(c) / sum(c) AS majority_accuracy, CAST(sum(c) AS BIGINT) AS rows
  FROM (SELECT count(*) AS c FROM profile GROUP BY Exited)"""))
def q_majority(spark, sf_dir):
    return curves.majority_baseline(customer_profile(spark, sf_dir))


# ------------------------------------------------------------- curves
@register("pr_curve", with_ctes(["curve_f1"], """
  SELECT threshold, tp, fp, precision, recall, round(f1, 9) AS f1 FROM curve_f1
  UNION ALL SELECT NULL, 0, 0, 1.0, 0.0, 0.0"""))
def q_pr_curve(spark, sf_dir):
    return rounded(curves.pr_curve(scored(spark, sf_dir)), ["f1"])


@register("threshold_curve", with_ctes(["curve_f1", "best"], """
  SELECT threshold, tp, fp, precision, recall, round(f1, 9) AS f1, recall >= 0.6 AS meets_floor,
         threshold = (SELECT threshold FROM best) AS is_chosen FROM curve_f1"""))
def q_threshold_curve(spark, sf_dir):
    return rounded(curves.threshold_curve(scored(spark, sf_dir)), ["f1"])


@register("best_threshold", with_ctes(["best"], """
  SELECT threshold, precision, recall, round(f1, 9) AS f1, meets_floor FROM best"""))
def q_best_threshold(spark, sf_dir):
    return rounded(curves.best_threshold(scored(spark, sf_dir)), ["f1"])


@register("roc_auc", with_ctes(["auc"], """
  SELECT roc_auc, CAST(positives AS BIGINT) AS positives, CAST(negatives AS BIGINT) AS negatives
  FROM auc"""))
def q_roc_auc(spark, sf_dir):
    return curves.roc_auc(scored(spark, sf_dir))


@register("roc_curve", with_ctes(["cum"], """
  SELECT threshold, CASE WHEN tot_neg > 0 THEN fp / tot_neg END AS fpr,
         CASE WHEN tot_pos > 0 THEN tp / tot_pos END AS tpr
  FROM cum UNION ALL SELECT NULL, 0.0, 0.0"""))
def q_roc_curve(spark, sf_dir):
    return curves.roc_curve(scored(spark, sf_dir))


@register("point_metrics", with_ctes(["point_metrics"], "SELECT * FROM point_metrics"))
def q_point_metrics(spark, sf_dir):
    s = scored(spark, sf_dir)
    return curves.point_metrics(s, curves.best_threshold_value(s))


@register("confusion_matrix", with_ctes(["decided"], """
  SELECT a.actual,
         CAST(count(CASE WHEN d.predicted = 0 THEN 1 END) AS BIGINT) AS pred_0,
         CAST(count(CASE WHEN d.predicted = 1 THEN 1 END) AS BIGINT) AS pred_1
  FROM (VALUES (0), (1)) a(actual) LEFT JOIN decided d ON d.actual = a.actual
  GROUP BY a.actual"""))
def q_confusion(spark, sf_dir):
    s = scored(spark, sf_dir)
    return curves.confusion_matrix(s, curves.best_threshold_value(s))


@register("calibration_curve", with_ctes(["scored"], f"""
  SELECT {calibration_bin_sql('p')} AS bin, CAST(count(*) AS BIGINT) AS n,
         round(avg(p), 9) AS mean_predicted, round(avg(CAST(y AS DOUBLE)), 9) AS fraction_positive
  FROM scored GROUP BY 1"""))
def q_calibration(spark, sf_dir):
    return rounded(curves.calibration_curve(scored(spark, sf_dir)),
                   ["mean_predicted", "fraction_positive"])


@register("targets_status", with_ctes(["point_metrics", "auc"], """
  SELECT Metric, Score, Target, CASE WHEN Score >= Target THEN 'PASS' ELSE 'FAIL' END AS Status, ord
  FROM (SELECT 'ROC-AUC' AS Metric, (SELECT roc_auc FROM auc) AS Score, 0.85 AS Target, 0 AS ord
        UNION ALL SELECT 'F1', f1, 0.55, 1 FROM point_metrics
        UNION ALL SELECT 'Recall', recall, 0.60, 2 FROM point_metrics
        UNION ALL SELECT 'Precision', precision, 0.50, 3 FROM point_metrics)"""))
def q_targets(spark, sf_dir):
    s = scored(spark, sf_dir)
    return curves.targets_status(s, curves.best_threshold_value(s))


@register("pr_operating_point", with_ctes(["point_metrics"], """
  SELECT threshold, precision, recall, f1, precision >= 0.5 AS meets_precision_floor,
         recall >= 0.6 AS meets_recall_floor FROM point_metrics"""))
def q_pr_point(spark, sf_dir):
    s = scored(spark, sf_dir)
    return curves.pr_operating_point(s, curves.best_threshold_value(s))


def _fold_scored(spark, sf_dir) -> DataFrame:
    prof = profile(spark, sf_dir)
    t = split.stratified_folds(split.split_frames(prof)[0]).select(KEY, "fold")
    return scored_fixture(prof).join(t, KEY)


@register("fold_metrics", with_ctes(["folds", "scored"], """
  , fs AS (SELECT s.*, f.fold FROM scored s JOIN folds f USING (CustomerId)),
  fc AS (SELECT fold, p AS threshold, count(*) AS n, sum(y) AS pos, count(*) - sum(y) AS neg
         FROM fs GROUP BY fold, p),
  fa AS (SELECT fold, sum(pos * (2 * (sum_le - neg) + neg)) AS num2, sum(pos) AS tot_pos,
                sum(neg) AS tot_neg
         FROM (SELECT *, sum(neg) OVER (PARTITION BY fold ORDER BY threshold) AS sum_le FROM fc)
         GROUP BY fold),
  fp AS (SELECT fold, count(CASE WHEN y = 1 AND p >= 0.5 THEN 1 END) AS tp,
                count(CASE WHEN y = 0 AND p >= 0.5 THEN 1 END) AS fpos,
                count(CASE WHEN y = 1 AND p < 0.5 THEN 1 END) AS fn FROM fs GROUP BY fold)
  SELECT fa.fold, CAST(num2 AS DOUBLE) / (2.0 * tot_pos * tot_neg) AS roc_auc,
         CASE WHEN 2 * tp + fpos + fn > 0 THEN 2 * tp / (2 * tp + fpos + fn) ELSE 0.0 END AS f1,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall
  FROM fa JOIN fp ON fa.fold = fp.fold""").replace("\n  , fs AS", ",\n  fs AS"))
def q_fold_metrics(spark, sf_dir):
    return curves.metrics_by_fold(_fold_scored(spark, sf_dir), 0.5)


# ------------------------------------------------------------- calibration
def _iso_sql(body: str, extra: list[str] | None = None) -> str:
    return with_ctes(["scored", *(extra or [])], """
  , ic AS (SELECT p, count(*) AS n, sum(y) AS s FROM scored GROUP BY p),
  ik AS (SELECT p, n, s, sum(n) OVER (ORDER BY p) AS cn, sum(s) OVER (ORDER BY p) AS cs FROM ic),
  iab AS (SELECT a.p AS ap, b.p AS bp, (b.cs - a.cs + a.s) / (b.cn - a.cn + a.n) AS m
          FROM ik a JOIN ik b ON a.p <= b.p),
  imin AS (SELECT x.p AS xp, iab.ap, min(iab.m) AS mn FROM ik x
           JOIN iab ON iab.ap <= x.p AND iab.bp >= x.p GROUP BY x.p, iab.ap),
  iso AS (SELECT xp AS p, round(max(mn), 9) AS calibrated FROM imin GROUP BY xp)
""".replace("\n  , ic AS", ",\n  ic AS") + body)


def _isotonic(spark, sf_dir):
    from attrition.operators import calibrate
    s = scored(spark, sf_dir)
    return s, calibrate.fit_isotonic(s)


@register("isotonic_fit", _iso_sql("SELECT p, calibrated FROM iso"))
def q_isotonic_fit(spark, sf_dir):
    from attrition.operators import calibrate
    s, m = _isotonic(spark, sf_dir)
    return rounded(calibrate.isotonic_table(m, s), ["calibrated"])


@register("isotonic_apply", _iso_sql(
    "SELECT s.CustomerId, s.y, s.p, i.calibrated AS p_cal FROM scored s JOIN iso i ON s.p = i.p"))
def q_isotonic_apply(spark, sf_dir):
    from attrition.operators import calibrate
    s, m = _isotonic(spark, sf_dir)
    return rounded(calibrate.apply_isotonic(m, s), ["p_cal"])


@register("calibrated_threshold", _iso_sql("""
  , cs AS (SELECT s.y, i.calibrated AS p FROM scored s JOIN iso i ON s.p = i.p),
  cc AS (SELECT p AS threshold, count(*) AS n, sum(y) AS pos FROM cs GROUP BY p),
  ccum AS (SELECT threshold, sum(pos) OVER (ORDER BY threshold DESC) AS tp,
                  sum(n - pos) OVER (ORDER BY threshold DESC) AS fp,
                  sum(pos) OVER () AS tot_pos FROM cc),
  cpr AS (SELECT threshold, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
                 CASE WHEN tot_pos > 0 THEN tp / tot_pos ELSE 1.0 END AS recall FROM ccum)
  SELECT threshold, precision, recall,
         round(2 * (precision * recall) / (precision + recall + 1e-8), 9) AS f1,
         recall >= 0.6 AS meets_floor
  FROM cpr ORDER BY meets_floor DESC, f1 DESC, threshold ASC LIMIT 1""".replace(
    "\n  , cs AS", ",\n  cs AS")))
def q_calibrated_threshold(spark, sf_dir):
    from attrition.operators import calibrate
    s, m = _isotonic(spark, sf_dir)
    cal = rounded(calibrate.apply_isotonic(m, s), ["p_cal"])
    return rounded(curves.best_threshold(cal, "y", "p_cal"), ["f1"])


# ------------------------------------------------------------- predictions & errors
@register("predictions_table", with_ctes(["decided"], """
  SELECT actual, predicted, probability, actual = predicted AS correct FROM decided"""))
def q_predictions(spark, sf_dir):
    from attrition.operators import decide
    return decide.predictions_table(decided(spark, sf_dir)[0])


@register("prediction_accuracy", with_ctes(["decided"], """
  SELECT avg(CAST(actual = predicted AS DOUBLE)) AS accuracy, CAST(count(*) AS BIGINT) AS rows
  FROM decided"""))
def q_prediction_accuracy(spark, sf_dir):
    from attrition.operators import decide
    return decide.predictions_summary(decide.predictions_table(decided(spark, sf_dir)[0]))


_INPUTS_SQL = ", ".join(f"f.{c}" for c in INPUT_COLS)
_ERR_SQL = """CASE WHEN actual = 1 AND predicted = 0 THEN 'False Negative'
                   WHEN actual = 0 AND predicted = 1 THEN 'False Positive' ELSE 'Correct' END"""


@register("error_rows", with_ctes(["decided", "profile"], f"""
  SELECT f.CustomerId, {_INPUTS_SQL}, d.actual, d.predicted, d.probability,
         {_ERR_SQL} AS error_type
  FROM profile f JOIN decided d ON f.CustomerId = d.CustomerId
  WHERE {_ERR_SQL} <> 'Correct'"""))
def q_error_rows(spark, sf_dir):
    from attrition.operators import errors
    prof = profile(spark, sf_dir)
    return errors.error_rows(prof, decided(spark, sf_dir, prof)[0])


@register("error_breakdown", with_ctes(["decided", "features"], f"""
  , er AS (SELECT f.Geography, f.AgeGroup, f.NumOfProducts, {_ERR_SQL} AS error_type
          FROM features f JOIN decided d ON f.CustomerId = d.CustomerId)
  SELECT dimension, value, error_type, CAST(count(*) AS BIGINT) AS count
  FROM (SELECT 'Geography' AS dimension, Geography AS value, error_type FROM er
        UNION ALL SELECT 'AgeGroup', AgeGroup, error_type FROM er
        UNION ALL SELECT 'NumOfProducts', CAST(NumOfProducts AS VARCHAR), error_type FROM er)
  WHERE error_type <> 'Correct'
  GROUP BY dimension, value, error_type""".replace("\n  , er AS", ",\n  er AS")))
def q_error_breakdown(spark, sf_dir):
    from attrition.operators import errors
    prof = profile(spark, sf_dir)
    return errors.error_breakdown(errors.error_rows(prof, decided(spark, sf_dir, prof)[0]))


@register("error_totals", with_ctes(["decided"], f"""
  SELECT CAST(count(CASE WHEN {_ERR_SQL} <> 'Correct' THEN 1 END) AS BIGINT) AS errors,
         CAST(count(*) AS BIGINT) AS rows,
         count(CASE WHEN {_ERR_SQL} <> 'Correct' THEN 1 END) / count(*) AS error_rate,
         CAST(count(CASE WHEN actual = 1 AND predicted = 0 THEN 1 END) AS BIGINT) AS false_negatives,
         CAST(count(CASE WHEN actual = 0 AND predicted = 1 THEN 1 END) AS BIGINT) AS false_positives
  FROM decided"""))
def q_error_totals(spark, sf_dir):
    from attrition.operators import errors
    return errors.error_totals(decided(spark, sf_dir)[0])


# ------------------------------------------------------------- decisions
_T = "(SELECT threshold FROM best)"


def _label_query(name: str, sql_expr: str, col_fn):
    @register(name, with_ctes(["decided", "best"], f"""
  SELECT CustomerId, probability, {sql_expr} AS {name} FROM decided"""))
    def q(spark, sf_dir):
        d, t = decided(spark, sf_dir)
        return d.select(KEY, "probability", col_fn("probability", t).alias(name))
    return q


_label_query("confidence", f"""CASE WHEN abs(probability - {_T}) < 0.1 THEN 'Borderline'
              WHEN abs(probability - {_T}) < 0.25 THEN 'Moderate' ELSE 'Strong' END""",
             D.confidence)
_label_query("risk_label", f"""CASE WHEN probability >= {_T} THEN 'High'
              WHEN abs(probability - {_T}) <= 0.15 THEN 'Elevated' ELSE 'Low' END""",
             D.risk_label)
_label_query("risk_band", f"""CASE WHEN probability > 0 AND probability <= greatest({_T} - 0.15, 0.0)
                   THEN 'Low'
              WHEN probability > greatest({_T} - 0.15, 0.0) AND probability <= {_T} THEN 'Elevated'
              WHEN probability > {_T} AND probability <= 1.0 THEN 'High' END""",
             D.risk_band)
_label_query("gauge_zone", """CASE WHEN probability * 100 < 40.0 THEN 'low'
              WHEN probability * 100 < 60.0 THEN 'medium' ELSE 'high' END""",
             lambda p, t: D.gauge_zone(p))


_BATCH_SQL = f"""
  , br AS (SELECT f.CustomerId, round(d.probability, 4) AS Churn_Probability,
          CASE WHEN d.probability >= {_T} THEN 'CHURN' ELSE 'RETAIN' END AS Churn_Prediction,
          CASE WHEN d.probability > 0 AND d.probability <= greatest({_T} - 0.15, 0.0) THEN 'Low'
               WHEN d.probability > greatest({_T} - 0.15, 0.0) AND d.probability <= {_T}
                 THEN 'Elevated'
               WHEN d.probability > {_T} AND d.probability <= 1.0 THEN 'High' END AS Risk_Level,
          {_INPUTS_SQL}
          FROM profile f JOIN decided d ON f.CustomerId = d.CustomerId)
"""


def _batch(spark, sf_dir):
    from attrition.operators import decide
    prof = profile(spark, sf_dir)
    t = curves.best_threshold_value(scored_fixture(prof))
    return decide.batch_result(prof.withColumn("probability", fixture_score()), t)


def _batch_sql(body: str) -> str:
    return with_ctes(["decided", "profile", "best"], _BATCH_SQL.replace(
        "\n  , br AS", ",\n  br AS") + body)


@register("batch_result", _batch_sql("SELECT * FROM br"))
def q_batch_result(spark, sf_dir):
    return _batch(spark, sf_dir)


@register("batch_counts", _batch_sql("""
  SELECT CAST(count(*) AS BIGINT) AS total,
         CAST(count(CASE WHEN Churn_Prediction = 'CHURN' THEN 1 END) AS BIGINT) AS churn,
         CAST(count(CASE WHEN Churn_Prediction <> 'CHURN' THEN 1 END) AS BIGINT) AS retain
  FROM br"""))
def q_batch_counts(spark, sf_dir):
    from attrition.operators import decide
    return decide.batch_counts(_batch(spark, sf_dir))


@register("top_scores", _batch_sql("SELECT * FROM br ORDER BY Churn_Probability DESC, CustomerId ASC"))
def q_top_scores(spark, sf_dir):
    """The whole batch, highest probability first."""
    from attrition.operators import decide
    return decide.top_scores(_batch(spark, sf_dir))


@register("first_true_positive", with_ctes(["decided"], """
  SELECT * FROM decided WHERE actual = 1 AND predicted = 1 ORDER BY CustomerId LIMIT 1"""))
def q_first_tp(spark, sf_dir):
    from attrition.operators import decide
    return decide.first_true_positive(decided(spark, sf_dir)[0])


# ------------------------------------------------------------- preprocessing
from attrition.plans.oracle_sql import (ORACLE_NAMES, ORACLE_NUM, qcol,  # noqa: E402
                                        sq_distance_sql)


def _feature_model(spark, sf_dir):
    from attrition.operators.preprocess import FeatureStages
    from attrition.schema import CAT_FEATURES, NUM_FEATURES, PASSTHROUGH_FEATURES
    tr = train(spark, sf_dir)
    return tr, FeatureStages(NUM_FEATURES, CAT_FEATURES, PASSTHROUGH_FEATURES).fit(tr)


def _ftab(spark, sf_dir) -> tuple[DataFrame, list[str]]:
    from attrition.operators.preprocess import feature_names, feature_table
    tr, fm = _feature_model(spark, sf_dir)
    names = feature_names(fm)
    return feature_table(fm, tr, extra=[TARGET]), names


@register("scale_fit", with_ctes(["fstats"], "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(m{i}, 6) AS mean, "
    f"round(CASE WHEN s{i} > 0 THEN s{i} ELSE 1.0 END, 6) AS scale FROM fstats"
    for i, c in enumerate(ORACLE_NUM))))
def q_scale_fit(spark, sf_dir):
    from attrition.operators.preprocess import PopulationScalerModel
    _, fm = _feature_model(spark, sf_dir)
    sc = [s for s in fm.stages if isinstance(s, PopulationScalerModel)][0]
    # Means and deviations reach 1e5: compared at 6 decimals (engines sum in
    # different orders).
    return rounded(spark.createDataFrame(sc.parameters(), "feature string, mean double, "
                                                          "scale double"), ["mean", "scale"], 6)


@register("scale_transform", with_ctes(["ftab"], "SELECT CustomerId, " + ", ".join(
    f"round({c}, 9) AS {c}" for c in ORACLE_NUM) + " FROM ftab"))
def q_scale_transform(spark, sf_dir):
    tab, _ = _ftab(spark, sf_dir)
    return rounded(tab.select(KEY, *ORACLE_NUM), ORACLE_NUM)


_ONEHOT = [n for n in ORACLE_NAMES if "_" in n and n not in ("IsActive_by_CreditCard",)]


@register("one_hot", with_ctes(["ftab"], "SELECT CustomerId, " + ", ".join(
    qcol(c) for c in _ONEHOT) + " FROM ftab"))
def q_one_hot(spark, sf_dir):
    tab, names = _ftab(spark, sf_dir)
    return tab.select(KEY, *[F.col(f"`{c}`") for c in names if c in _ONEHOT])


@register("feature_table", with_ctes(["ftab"], "SELECT CustomerId, " + ", ".join(
    f"round({qcol(c)}, 9) AS {qcol(c)}" for c in ORACLE_NAMES) + " FROM ftab"))
def q_feature_table(spark, sf_dir):
    tab, names = _ftab(spark, sf_dir)
    return rounded(tab.select(KEY, *[F.col(f"`{c}`") for c in names]), names)


# ------------------------------------------------------------- imbalance
@register("class_weights", with_ctes(["train"], """
  SELECT Exited AS label, CAST(count(*) AS BIGINT) AS n,
         (SELECT count(*) FROM train) / (2.0 * count(*)) AS balanced_weight,
         CASE WHEN Exited = 1 THEN (SELECT CAST(count(*) AS DOUBLE) FROM train WHERE Exited = 0)
                                   / (SELECT count(*) FROM train WHERE Exited = 1)
              ELSE 1.0 END AS positive_weight
  FROM train GROUP BY Exited"""))
def q_class_weights(spark, sf_dir):
    from attrition.operators import imbalance
    return imbalance.class_weights(train(spark, sf_dir))


_KNN_SQL = f"""
  , mino AS (SELECT * FROM ftab WHERE Exited = 1),
  pairs AS (SELECT a.CustomerId AS query, b.CustomerId AS neighbour,
                   sqrt({sq_distance_sql('a', 'b')}) AS distance
            FROM mino a JOIN {{cands}} b ON a.CustomerId <> b.CustomerId),
  nn AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, neighbour) AS rank
         FROM pairs)
"""


def _knn_sql(cands: str, body: str) -> str:
    return with_ctes(["ftab"], _KNN_SQL.replace("\n  , mino AS", ",\n  mino AS")
                     .replace("{cands}", cands) + body)


@register("smote_neighbours", _knn_sql("mino", """
  SELECT query, CAST(rank AS INTEGER) AS rank, neighbour, round(distance, 9) AS distance
  FROM nn WHERE rank <= 5"""))
def q_smote_neighbours(spark, sf_dir):
    from attrition.operators.knn import knn
    tab, names = _ftab(spark, sf_dir)
    vec = _vectors(tab, names)
    mino = vec.where(F.col(TARGET) == 1)
    out = knn(mino, mino, k=5)
    return rounded(out.select("query", F.col("rank").cast("int"), "neighbour", "distance"),
                   ["distance"])


def _vectors(tab: DataFrame, names: list[str]) -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return tab.select(KEY, TARGET, array_to_vector(F.array(*[F.col(f"`{n}`") for n in names]))
                      .alias("features"))


@register("adasyn_allocation", _knn_sql("ftab", """
  , rr AS (SELECT n.query AS CustomerId,
                 count(CASE WHEN f.Exited <> 1 THEN 1 END) / 5.0 AS r
          FROM nn n JOIN ftab f ON f.CustomerId = n.neighbour WHERE n.rank <= 5 GROUP BY n.query),
  g AS (SELECT (SELECT count(*) FROM ftab WHERE Exited = 0)
               - (SELECT count(*) FROM ftab WHERE Exited = 1) AS g)
  SELECT CustomerId, r, round(r / (SELECT sum(r) FROM rr), 9) AS r_norm,
         CAST(round_even(r / (SELECT sum(r) FROM rr) * (SELECT g FROM g), 0) AS INTEGER)
           AS n_synthetic
  FROM rr""".replace("\n  , rr AS", ",\n  rr AS")))
def q_adasyn_allocation(spark, sf_dir):
    from attrition.operators import imbalance
    tab, names = _ftab(spark, sf_dir)
    out = imbalance.adasyn_allocation(_vectors(tab, names))
    return rounded(out, ["r_norm"])


# ------------------------------------------------------------- explanations
# A linear log-odds score with fixed coefficients over the named feature
# table: the SQL-checkable stand-in for a fitted logistic model.
LINEAR_INTERCEPT = -1.5


def linear_coefficients(n: int) -> list[float]:
    return [0.25 * ((i % 5) - 2) + 0.1 for i in range(n)]


def _linear_factors(spark, sf_dir):
    """One row per customer: probability and the array of its SHAP factors."""
    from attrition.operators import explain
    tab, names = _ftab(spark, sf_dir)
    coef = linear_coefficients(len(names))
    scored_rows = tab.withColumn("probability", 1 / (1 + F.exp(-_logit(names, coef))))
    out = explain.linear_shap_arrays(scored_rows, names, coef, background=tab, carry=["probability"])
    return out.withColumn("factors", F.transform("factors", lambda f: F.struct(
        F.round(f["shap"], ROUND).alias("shap"), f["feature_idx"].alias("feature_idx"),
        f["feature"].alias("feature"), F.round(f["value"], ROUND).alias("value"))))


def _logit(names, coef):
    logit = F.lit(LINEAR_INTERCEPT)
    for n, b in zip(names, coef):
        logit = logit + F.lit(b) * F.col(f"`{n}`")
    return logit


def _linear(spark, sf_dir):
    from attrition.operators import explain
    tab, names = _ftab(spark, sf_dir)
    coef = linear_coefficients(len(names))
    shap = explain.linear_shap(tab.select(KEY, *[F.col(f"`{n}`") for n in names]), names, coef)
    shap = rounded(shap, ["shap", "value"])
    prob = tab.select(KEY, TARGET, (1 / (1 + F.exp(-_logit(names, coef)))).alias("probability"))
    means = tab.agg(*[F.avg(F.col(f"`{n}`")) for n in names]).first()
    base = explain.linear_base(LINEAR_INTERCEPT, coef, [float(v) for v in means])
    return shap, prob, base


def _lin_sql(body: str) -> str:
    coef = linear_coefficients(len(ORACLE_NAMES))
    shap = "\nUNION ALL\n".join(
        f"SELECT CustomerId, {i} AS feature_idx, '{n}' AS feature, round({qcol(n)}, 9) AS value, "
        f"round({b!r} * ({qcol(n)} - (SELECT avg({qcol(n)}) FROM ftab)), 9) AS shap FROM ftab"
        for i, (n, b) in enumerate(zip(ORACLE_NAMES, coef)))
    logit = f"{LINEAR_INTERCEPT!r}" + "".join(
        f" + {b!r} * {qcol(n)}" for n, b in zip(ORACLE_NAMES, coef))
    base = f"{LINEAR_INTERCEPT!r}" + "".join(
        f" + {b!r} * (SELECT avg({qcol(n)}) FROM ftab)" for n, b in zip(ORACLE_NAMES, coef))
    head = (f",\n  lshap AS ({shap}),\n  lprob AS (SELECT CustomerId, Exited, "
            f"1 / (1 + exp(-({logit}))) AS probability FROM ftab),\n"
            f"  lbase AS (SELECT {base} AS base)\n")
    return with_ctes(["ftab"], head + body)


@register("linear_shap", _lin_sql("SELECT * FROM lshap"))
def q_linear_shap(spark, sf_dir):
    return _linear(spark, sf_dir)[0]


@register("mean_abs_shap", _lin_sql("""
  SELECT feature, round(avg(abs(shap)), 9) AS mean_abs_shap FROM lshap GROUP BY feature
  ORDER BY mean_abs_shap DESC, feature LIMIT 10"""))
def q_mean_abs_shap(spark, sf_dir):
    from attrition.operators import explain
    return rounded(explain.mean_abs_shap(_linear(spark, sf_dir)[0], 10), ["mean_abs_shap"])


@register("top_factors", _lin_sql("""
  SELECT CustomerId, CAST(rank AS INTEGER) AS rank, feature, shap,
         CASE WHEN shap > 0 THEN 'Increases Risk' ELSE 'Reduces Risk' END AS direction
  FROM (SELECT *, row_number() OVER (PARTITION BY CustomerId
                                     ORDER BY abs(shap) DESC, feature_idx DESC) AS rank
        FROM lshap) WHERE rank <= 5"""))
def q_top_factors(spark, sf_dir):
    from attrition.operators import decide
    return decide.top_factors(_linear_factors(spark, sf_dir)).withColumn(
        "rank", F.col("rank").cast("int"))


@register("waterfall", _lin_sql("""
  , who AS (SELECT min(CustomerId) AS c FROM lprob WHERE Exited = 1 AND probability >= 0.5),
  wr AS (SELECT *, row_number() OVER (ORDER BY abs(shap) DESC, feature_idx) AS r
         FROM lshap WHERE CustomerId = (SELECT c FROM who)),
  steps AS (SELECT CustomerId, CAST(r AS INTEGER) AS step, feature, value, shap FROM wr WHERE r < 10
            UNION ALL
            SELECT min(CustomerId), 10, CAST(count(*) AS VARCHAR) || ' other features', NULL,
                   sum(shap) FROM wr WHERE r >= 10)
  SELECT CustomerId, step, feature, value, round(shap, 9) AS shap,
         round((SELECT base FROM lbase) + sum(shap) OVER (ORDER BY step), 9) AS cumulative
  FROM steps""".replace("\n  , who AS", "  , who AS")))
def q_waterfall(spark, sf_dir):
    from attrition.operators import explain
    shap, prob, base = _linear(spark, sf_dir)
    who = prob.where((F.col(TARGET) == 1) & (F.col("probability") >= 0.5)).agg(F.min(KEY)).first()[0]
    out = explain.waterfall(shap, base, int(who)).withColumn("step", F.col("step").cast("int"))
    return rounded(out, ["shap", "cumulative"])


def _actions_sql() -> str:
    from attrition.schema import FEATURE_ACTIONS
    esc = lambda s: s.replace("'", "''")
    return "VALUES " + ", ".join(f"({i}, '{esc(k)}', '{esc(t)}', '{esc(x)}')"
                                 for i, (k, t, x) in enumerate(FEATURE_ACTIONS))


def _general_sql() -> str:
    from attrition.schema import GENERAL_ACTION
    return f"'{GENERAL_ACTION[0]}' AS title, '{GENERAL_ACTION[1]}' AS text"


@register("recommendations", _lin_sql(f"""
  , flag AS (SELECT CustomerId FROM lprob WHERE probability >= 0.5),
  cand AS (SELECT s.* FROM lshap s JOIN flag f ON s.CustomerId = f.CustomerId
           WHERE s.shap > 0 OR NOT EXISTS (SELECT 1 FROM lshap s2
                                           WHERE s2.CustomerId = s.CustomerId AND s2.shap > 0)),
  acts AS (SELECT * FROM ({_actions_sql()}) a(ord, key, title, text)),
  matched AS (SELECT c.*, a.ord, a.key, a.title, a.text,
                     row_number() OVER (PARTITION BY c.CustomerId, c.feature
                                        ORDER BY (c.feature = a.key) DESC, a.ord) AS r
              FROM cand c JOIN acts a ON starts_with(c.feature, a.key)),
  bt AS (SELECT *, row_number() OVER (PARTITION BY CustomerId, title
                                      ORDER BY shap DESC, feature_idx DESC) AS t
         FROM matched WHERE r = 1),
  rk AS (SELECT *, row_number() OVER (PARTITION BY CustomerId
                                      ORDER BY shap DESC, feature_idx DESC) AS rank
         FROM bt WHERE t = 1)
  SELECT CustomerId, CAST(rank AS INTEGER) AS rank, title, text, feature, shap FROM rk WHERE rank <= 3
  UNION ALL
  SELECT CustomerId, 1, {_general_sql()}, NULL, 0.0 FROM flag
  WHERE CustomerId NOT IN (SELECT CustomerId FROM rk)""".replace("\n  , flag AS", "  , flag AS")))
def q_recommendations(spark, sf_dir):
    from attrition.operators import decide
    return decide.recommendations(_linear_factors(spark, sf_dir), None, 0.5).withColumn("rank", F.col("rank").cast("int"))


# ------------------------------------------------------------- fitted models
# Learned probabilities have no SQL twin. What SQL can say about them is checked row by row:
# which customers are scored, in which fold, and that a residual of the fit vanishes.
def _folded(spark, sf_dir):
    from attrition.plans.training import prepare
    return prepare(profile(spark, sf_dir))


def _fit_score(spark, sf_dir, family, strategy, **params):
    from attrition.operators import models
    folded, test = _folded(spark, sf_dir)
    m = models.strategy_pipeline(family, strategy, **params).fit(folded.drop("fold"))
    return m, models.score(m, test), test


@register("oof_probabilities", with_ctes(["folds"], """
  SELECT CustomerId, Exited AS y, fold, 0.0 AS residual FROM folds"""))
def q_oof(spark, sf_dir):
    """Every training row scored once by the model of its own fold: the gap between the pipelines
    that are fitted fold by fold and the batched solver, which never sees their tables."""
    from attrition.operators import batch_logistic, models, search
    folded, _ = _folded(spark, sf_dir)
    single = search.out_of_fold(
        lambda: models.strategy_pipeline("Logistic Regression", "class_weight", tol=FIT_TOLERANCE), folded)
    of = batch_logistic.design(folded)
    fits, trials = batch_logistic.trial_fits(of, [{}])
    batched = batch_logistic.held_out_scores(of, fits, batch_logistic.fit_all(of, fits), trials)
    return (single.join(batched.select(F.col("key").alias(KEY), F.col("fold").alias("_f"), F.col("p").alias("_p")), KEY)
            .select(KEY, "y", "fold", F.when(F.col("fold") == F.col("_f"), F.round(F.abs(F.col("p") - F.col("_p")), 5)).alias("residual")))


#: Stopping tolerance of the fits whose residuals SQL states as 0.
FIT_TOLERANCE = 1e-12


@register("logistic_scores", with_ctes(["test"], """
  SELECT CustomerId, Exited AS y, 0.0 AS residual, 0.0 AS gradient FROM test"""))
def q_logistic_scores(spark, sf_dir):
    """Test customers scored: how far each score is from coefficients times features, and the largest
    entry of the loss's gradient at the fit, taken from the scores of the training rows."""
    from attrition.operators import evidence, models
    folded, test = _folded(spark, sf_dir)
    tr = folded.drop("fold")
    m = models.strategy_pipeline("Logistic Regression", "class_weight", tol=FIT_TOLERANCE).fit(tr)
    gradient = evidence.logistic_gradient(m, tr, "balanced").agg(F.max(F.abs("gradient"))).first()[0]
    scored_ = m.transform(test).withColumn("p", models.positive_probability())
    return scored_.select(KEY, F.col(TARGET).cast("int").alias("y"),
                          F.round(evidence.logistic_residual(scored_, m), 9).alias("residual"),
                          F.round(F.lit(gradient), 5).alias("gradient"))


@register("forest_scores", with_ctes(["test"], """
  SELECT CustomerId, Exited AS y, 0.0 AS residual, TRUE AS beats_constant FROM test"""))
def q_forest_scores(spark, sf_dir):
    """Test customers scored: how far each score is from a walk over the saved nodes, and whether the
    forest's weighted log loss on its training rows is below that of the best constant."""
    from attrition.operators import evidence, imbalance, models
    m, _, test = _fit_score(spark, sf_dir, "Random Forest", "class_weight")
    folded, _ = _folded(spark, sf_dir)
    walked_ = evidence.walked(m, test).withColumn("p", models.positive_probability())
    scored_ = imbalance.with_class_weight(m.transform(folded.drop("fold")), TARGET, "balanced").withColumn(
        "_q", F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), models.positive_probability())))
    loss = scored_.agg((F.sum(F.col("weight") * -F.log(F.when(F.col(TARGET) == 1, F.col("_q")).otherwise(1 - F.col("_q"))))
                        / F.sum("weight"))).first()[0]
    # Balanced weights make one half the best constant.
    return walked_.select(KEY, F.col(TARGET).cast("int").alias("y"),
                          F.round(F.abs(F.col("p") - evidence.walked_probability(m)), 9).alias("residual"),
                          (F.lit(loss) < F.log(F.lit(2.0))).alias("beats_constant"))


@register("boosted_scores", with_ctes(["test"], """
  SELECT CustomerId, Exited AS y, 0.0 AS residual, 0.0 AS value_gap, 0.0 AS cover_gap FROM test"""))
def q_boosted_scores(spark, sf_dir):
    """Test customers scored: how far each score is from a walk over the saved nodes, and how far any
    leaf of any round is from the mean pseudo-residual and the weight of its training rows."""
    from attrition.operators import evidence, models
    folded, test = _folded(spark, sf_dir)
    tr = folded.drop("fold")
    m = models.strategy_pipeline("Boosted Trees", "class_weight").fit(tr)
    gaps = evidence.leaf_residuals(m, tr, "positive").agg(F.max("value_gap"), F.max("cover_gap")).first()
    walked_ = evidence.walked(m, test).withColumn("p", models.positive_probability())
    return walked_.select(KEY, F.col(TARGET).cast("int").alias("y"),
                          F.round(F.abs(F.col("p") - evidence.walked_probability(m)), 9).alias("residual"),
                          F.round(F.lit(gaps[0]), 6).alias("value_gap"), F.round(F.lit(gaps[1]), 4).alias("cover_gap"))


@register("newton_boosted_scores", with_ctes(["test"], """
  SELECT CustomerId, Exited AS y, TRUE AS is_probability, 0.0 AS gap FROM test"""))
def q_newton_boosted_scores(spark, sf_dir):
    """Test customers scored by twenty rounds with an L2 term, and how far any leaf of any round is from
    -G / (H + l2) of its training rows."""
    from attrition.operators import evidence, models
    folded, test = _folded(spark, sf_dir)
    tr = folded.drop("fold")
    m = models.strategy_pipeline("Newton Boosted Trees", "class_weight", max_iter=20, l2=1.5).fit(tr)
    gap = evidence.newton_gaps(m, tr, 1.5, "balanced").agg(F.max("gap")).first()[0]
    return models.score(m, test).select(KEY, "y", F.col("p").between(0, 1).alias("is_probability"), F.round(F.lit(gap), 7).alias("gap"))


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    """The whole grid: three families by three strategies at their full sizes."""
    from attrition.operators import search
    from attrition.plans.training import comparison_grid
    folded, _ = _folded(spark, sf_dir)
    return search.compare_models(spark, folded, comparison_grid())


# Fixed scores over the fold table stand in for learners: what is checked against SQL is the
# comparison itself (fold metrics, their means, composite, rank, summary, best so far).
FIXED_MODELS = [("Model A", "class_weight", 0.6, 0.3), ("Model A", "SMOTE", 0.5, 0.5),
                ("Model B", "class_weight", 0.9, 0.1), ("Model B", "ADASYN", 0.3, 0.7),
                ("Model C", "SMOTE", 0.75, 0.25)]


def _fixed_score(a: float, b: float):
    """A score in whole hundredths from the label-leaking fixture and the age."""
    return F.floor((F.lit(a) * F.col("p") + F.lit(b) * (F.col("Age") % 50) / 50) * 100 + F.lit(1e-6)) / 100


def _fixed_rows(spark, sf_dir) -> DataFrame:
    from attrition.session import materialize
    prof = profile(spark, sf_dir)
    folds = split.stratified_folds(split.split_frames(prof)[0])
    return materialize(folds.select("fold", F.col(TARGET).alias("y"), "Age", fixture_score().alias("p")), "fixed")


_FIXED_SQL = """
  , fx AS (SELECT f.fold, s.y, f.Age, s.p FROM scored s JOIN folds f USING (CustomerId)),
  models AS (SELECT * FROM (VALUES {models}) m(ord, Model, Strategy, a, b)),
  ms AS (SELECT ord, Model, Strategy, fold, y,
                floor((a * p + b * (Age % 50) / 50) * 100 + 1e-6) / 100 AS p FROM fx CROSS JOIN models),
  mc AS (SELECT ord, Model, Strategy, fold, p, sum(y) AS pos, count(*) - sum(y) AS neg
         FROM ms GROUP BY ALL),
  ma AS (SELECT ord, Model, Strategy, fold, sum(pos * (2 * (le - neg) + neg)) / (2.0 * sum(pos) * sum(neg)) AS auc
         FROM (SELECT *, sum(neg) OVER (PARTITION BY ord, fold ORDER BY p) AS le FROM mc) GROUP BY ALL),
  mp AS (SELECT ord, fold, count(CASE WHEN y = 1 AND p >= 0.5 THEN 1 END) AS tp,
                count(CASE WHEN y = 0 AND p >= 0.5 THEN 1 END) AS fp,
                count(CASE WHEN y = 1 AND p < 0.5 THEN 1 END) AS fn FROM ms GROUP BY ALL),
  res AS (SELECT ord, Model, Strategy, round(avg(auc), 9) AS "ROC-AUC",
                 round(avg(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END), 9) AS F1,
                 round(avg(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END), 9) AS Recall
          FROM ma JOIN mp USING (ord, fold) GROUP BY ALL),
  scoredm AS (SELECT *, round(0.35 * F1 + 0.40 * Recall + 0.25 * "ROC-AUC", 9) AS Score FROM res)
""".replace("{models}", ", ".join(f"({i}, '{m}', '{s}', CAST({a!r} AS DOUBLE), CAST({b!r} AS DOUBLE))"
                                  for i, (m, s, a, b) in enumerate(FIXED_MODELS)))


def _fixed_sql(body: str) -> str:
    return with_ctes(["folds", "scored"], _FIXED_SQL.replace("\n  , fx AS", ",\n  fx AS") + body)


def _fixed_results(spark, sf_dir) -> DataFrame:
    from attrition.operators import search
    rows = _fixed_rows(spark, sf_dir)
    out = None
    for m, s, a, b in FIXED_MODELS:
        one = search.cross_validate(rows.select("fold", "y", _fixed_score(a, b).alias("p"))).select(
            F.lit(m).alias("Model"), F.lit(s).alias("Strategy"), F.round("roc_auc", ROUND).alias("ROC-AUC"),
            F.round("f1", ROUND).alias("F1"), F.round("recall", ROUND).alias("Recall"))
        out = one if out is None else out.unionByName(one)
    return out


@register("composite_rank", _fixed_sql("""
  SELECT Model, Strategy, "ROC-AUC", F1, Recall, Score,
         CAST(row_number() OVER (ORDER BY Score DESC, Model, Strategy) AS INTEGER) AS rank FROM scoredm"""))
def q_composite_rank(spark, sf_dir):
    from attrition.operators import search
    return rounded(search.rank_results(_fixed_results(spark, sf_dir)), ["Score"])


@register("strategy_summary", _fixed_sql("""
  SELECT Strategy, arg_max(Model, Score) AS best_model, max(Score) AS best_score,
         round(avg(Score), 8) AS mean_score, CAST(count(*) AS BIGINT) AS models FROM scoredm GROUP BY Strategy"""))
def q_strategy_summary(spark, sf_dir):
    from attrition.operators import search
    ranked = rounded(search.rank_results(_fixed_results(spark, sf_dir)), ["Score"])
    return rounded(search.strategy_summary(ranked), ["mean_score"], 8)


@register("best_so_far", _fixed_sql("""
  SELECT trial, Score AS score FROM (SELECT CAST(ord AS INTEGER) AS trial, Score, max(Score) OVER (
      ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM scoredm)
  WHERE prev IS NULL OR Score > prev"""))
def q_best_so_far(spark, sf_dir):
    from attrition.operators import search
    number = F.create_map(*[F.lit(x) for i, (m, s, _, _) in enumerate(FIXED_MODELS) for x in (f"{m}/{s}", i)])
    trials = _fixed_results(spark, sf_dir).select(
        number[F.concat_ws("/", "Model", "Strategy")].alias("trial"),
        F.round(search.composite_score(), ROUND).alias("score"))
    return search.best_so_far(trials)


@register("random_search")
def q_random_search(spark, sf_dir):
    """The workflow's 150 trials of 5 folds over the logistic family's whole space, fitted together."""
    from attrition.operators import batch_logistic
    from attrition.plans.training import N_TRIALS, SEARCH_SPACES
    folded, _ = _folded(spark, sf_dir)
    return batch_logistic.logistic_search(spark, folded, SEARCH_SPACES["Logistic Regression"], N_TRIALS)[0]


def _draw_sql(trial: str, name: str) -> str:
    """The uniform number that ``search.draw`` takes for a parameter of a trial."""
    from attrition.schema import SEED_SAMPLER
    return (f"CAST(CAST('0x' || substr(md5('{SEED_SAMPLER}:' || {trial} || ':{name}'), 1, 13) AS BIGINT) AS DOUBLE) / {16 ** 13}")


def _search_fits_sql() -> str:
    import math

    from attrition.plans.training import N_TRIALS, SEARCH_SPACES
    low, high = (math.log(v) for v in SEARCH_SPACES["Logistic Regression"]["C"][1:])
    return with_ctes(["folds"], f"""
  SELECT CAST(t.trial AS INTEGER) AS trial, k.fold, round(exp({low!r} + {_draw_sql('t.trial', 'C')} * ({high!r} - {low!r})), 9) AS C,
         CASE WHEN {_draw_sql('t.trial', 'penalty')} < 0.5 THEN 'l2' END AS penalty,
         (SELECT count(*) FROM folds f WHERE f.fold <> k.fold) AS rows, 0.0 AS gradient
  FROM range({N_TRIALS}) t(trial) CROSS JOIN (SELECT DISTINCT fold FROM folds) k""")


@register("search_fits", _search_fits_sql())
def q_search_fits(spark, sf_dir):
    """Every fit of the search: drawn parameters, training rows and the largest entry of the gradient
    at the coefficients that were found."""
    from attrition.operators import batch_logistic, search
    from attrition.plans.training import N_TRIALS, SEARCH_SPACES
    folded, _ = _folded(spark, sf_dir)
    of = batch_logistic.design(folded)
    params = [search.draw(SEARCH_SPACES["Logistic Regression"], t) for t in range(N_TRIALS)]
    fits, trials = batch_logistic.trial_fits(of, params)
    rows = [(t, f.fold, float(f.C), f.penalty, sum(of.counts(f.fold).values()), float(m.gradient))
            for t, f, m in zip(trials, fits, batch_logistic.fit_all(of, fits))]
    return rounded(rounded(spark.createDataFrame(rows, "trial int, fold int, C double, penalty string, rows long, gradient double"), ["C"]),
                   ["gradient"], 8)


def _resampled(spark, sf_dir, sampler: str) -> DataFrame:
    """All rows after resampling, with named coordinates."""
    from pyspark.ml.functions import vector_to_array

    from attrition.operators import imbalance
    from attrition.session import materialize
    tab, names = _ftab(spark, sf_dir)
    out = getattr(imbalance, sampler)(materialize(_vectors(tab, names), "vectors"))
    x = vector_to_array(F.col("features"))
    return out.select(KEY, F.col("i").cast("int").alias("i"), "synthetic", TARGET,
                      *[F.round(x[k], 6).alias(n) for k, n in enumerate(names)])


def _resampled_sql(base: str) -> str:
    """SQL twin of a sampler; ``base`` gives (CustomerId, times) of the rows to start from."""
    from attrition.schema import SEED_SAMPLER
    uniform = lambda what: (
        f"CAST(CAST('0x' || substr(md5('{SEED_SAMPLER}:' || CustomerId || ':' || i || ':{what}'), 1, 13) "
        f"AS BIGINT) AS DOUBLE) / {16 ** 13}")
    cols = ", ".join(f"round(a.{qcol(n)} + c.u * (b.{qcol(n)} - a.{qcol(n)}), 6) AS {qcol(n)}" for n in ORACLE_NAMES)
    own = ", ".join(f"round({qcol(n)}, 6) AS {qcol(n)}" for n in ORACLE_NAMES)
    return _knn_sql("mino", f"""
  , kk AS (SELECT query AS CustomerId, least(max(rank), 5) AS k FROM nn GROUP BY query),
  size AS (SELECT count(*) FILTER (Exited = 1) AS m, count(*) FILTER (Exited = 0) AS big FROM ftab),
  {base},
  each AS (SELECT CustomerId, k, unnest(range(1, CAST(times AS BIGINT) + 1)) AS i FROM base JOIN kk USING (CustomerId)),
  chosen AS (SELECT CustomerId, i, CAST(floor({uniform('nb')} * k) AS INTEGER) + 1 AS place, {uniform('gap')} AS u FROM each)
  SELECT CustomerId, 0 AS i, FALSE AS synthetic, Exited, {own} FROM ftab
  UNION ALL
  SELECT c.CustomerId, CAST(c.i AS INTEGER), TRUE, 1, {cols}
  FROM chosen c JOIN nn ON nn.query = c.CustomerId AND nn.rank = c.place
  JOIN ftab a ON a.CustomerId = c.CustomerId JOIN ftab b ON b.CustomerId = nn.neighbour""".replace(
        "\n  , kk AS", ",\n  kk AS", 1))


def _smote_base() -> str:
    from attrition.schema import SEED_SAMPLER
    return f"""base AS (SELECT CustomerId, (big - m) // m + CASE WHEN j <= (big - m) % m THEN 1 ELSE 0 END AS times
      FROM (SELECT CustomerId, row_number() OVER (ORDER BY md5('{SEED_SAMPLER}:' || CustomerId), CustomerId) AS j
            FROM mino), size)"""


_ADASYN_BASE = f"""allp AS (SELECT a.CustomerId AS query, b.Exited, row_number() OVER (
      PARTITION BY a.CustomerId ORDER BY sqrt({sq_distance_sql('a', 'b')}), b.CustomerId) AS rank
      FROM mino a JOIN ftab b ON a.CustomerId <> b.CustomerId),
  share AS (SELECT query AS CustomerId, count(CASE WHEN Exited <> 1 THEN 1 END) / 5.0 AS r
            FROM allp WHERE rank <= 5 GROUP BY query),
  base AS (SELECT CustomerId, round_even(r / (SELECT sum(r) FROM share) * (big - m), 0) AS times FROM share, size)"""


@register("smote_rows", _resampled_sql(_smote_base()))
def q_smote_rows(spark, sf_dir):
    return _resampled(spark, sf_dir, "smote")


@register("adasyn_rows", _resampled_sql(_ADASYN_BASE))
def q_adasyn_rows(spark, sf_dir):
    return _resampled(spark, sf_dir, "adasyn")


@register("tree_shap", with_ctes(["test"], "SELECT CustomerId, 0.0 AS residual FROM test"))
def q_tree_shap(spark, sf_dir):
    """Per customer: how far the factors and the base are from the model's log odds."""
    from attrition.operators import explain
    m, scores, test = _fit_score(spark, sf_dir, "Boosted Trees", "class_weight")
    shap, base = explain.model_shap(m, test)
    log_odds = F.log(F.col("p")) - F.log1p(-F.col("p"))
    return (shap.groupBy(KEY).agg(F.sum("shap").alias("total")).join(scores, KEY)
            .select(KEY, F.round(F.abs(F.lit(base) + F.col("total") - log_odds), 6).alias("residual")))


@register("saved_model_scores", with_ctes(["test"], """
  SELECT CustomerId, 0.0 AS residual, TRUE AS same_decision FROM test"""))
def q_saved_model_scores(spark, sf_dir):
    """Calibrated scores and decisions of a saved and reloaded model against those in memory.
    Calibrator and threshold come from out-of-fold scores, never from test rows."""
    import os
    import uuid

    from attrition.operators import calibrate, decide, models, search
    from attrition.plans.scoring import score_batch
    from attrition.session import checkpoint_dir, materialize
    from attrition.sources import files
    folded, test = _folded(spark, sf_dir)
    make = lambda: models.strategy_pipeline("Logistic Regression", "class_weight")
    oof = materialize(search.out_of_fold(make, folded), "oof")
    m = make().fit(folded.drop("fold"))
    cal = calibrate.fit_isotonic(oof)
    t = curves.best_threshold_value(calibrate.apply_isotonic(cal, oof), "y", "p_cal")
    here = calibrate.apply_isotonic(cal, models.score(m, test))
    table = decide.predictions_table(here.select(
        F.col("y").alias("actual"), F.col("p_cal").alias("probability"), D.decide("p_cal", t).alias("predicted")))
    folder = os.path.join(checkpoint_dir(spark), f"models-{uuid.uuid4().hex}")
    files.save_model(m, t, folder, "logistic", cal, table, spark)
    loaded, t2, name = files.load_model(spark, folder)
    again = calibrate.apply_isotonic(files.load_calibrator(spark, folder, name), models.score(loaded, test))
    batch = score_batch(test, loaded, t2, files.load_calibrator(spark, folder, name))
    return (here.select(KEY, F.col("p_cal").alias("a")).join(again.select(KEY, F.col("p_cal").alias("b")), KEY)
            .join(batch.select(KEY, "Churn_Prediction"), KEY)
            .select(KEY, F.round(F.abs(F.col("a") - F.col("b")), 9).alias("residual"),
                    (D.decision_label(D.decide("a", t)) == F.col("Churn_Prediction")).alias("same_decision")))

# Queries that run many fits come last.
for _name in ("random_search", "search_fits", "model_comparison"):
    QUERIES[_name] = QUERIES.pop(_name)
