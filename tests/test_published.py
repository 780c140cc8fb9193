"""Published results of the workflow, as fixed rows: composite scores, confusion counts, bands."""

import pytest
from pyspark.sql import functions as F

from attrition.functions import decisions as D
from attrition.operators import curves, search

# The published comparison (Model, Strategy, ROC-AUC, F1, Recall, Score), in its order.
COMPARISON = [
    ("CatBoost", "class_weight", 0.856729650564892, 0.6043280399873361, 0.7027039502091987, 0.7067788067204701),
    ("LightGBM", "class_weight", 0.847965110604241, 0.593909250599396, 0.6361415106981732, 0.6743161196401182),
    ("XGBoost", "class_weight", 0.8358579045748973, 0.5866912565672301, 0.6159422879349623, 0.6606833311162398),
    ("Logistic Regression", "class_weight", 0.775309783742383, 0.4947750187453172, 0.7141421360611069, 0.6526555569208996),
    ("Logistic Regression", "SMOTE", 0.77399490311089, 0.49521517836502393, 0.7015842527657419, 0.6474577393117776),
    ("CatBoost", "SMOTE", 0.8578832269665082, 0.6083026675798066, 0.5461115826149104, 0.6458213734405236),
    ("Random Forest", "ADASYN", 0.847235682896103, 0.596547961675531, 0.561392772591236, 0.645157816346956),
    ("CatBoost", "ADASYN", 0.8561886518191081, 0.610491405260946, 0.5422938907997201, 0.6446367111159962),
    ("Random Forest", "SMOTE", 0.8490383775033294, 0.5969023908889379, 0.5499292744301008, 0.6411471409590009),
    ("Logistic Regression", "ADASYN", 0.7669526797989723, 0.48274139873356453, 0.6988579681660487, 0.6402408467729102),
    ("LightGBM", "SMOTE", 0.8502436079713777, 0.5987462005929041, 0.5362814728786051, 0.6366346613518028),
    ("XGBoost", "SMOTE", 0.8404602652995663, 0.5904433308652683, 0.5368323878441357, 0.6315031872653898),
    ("LightGBM", "ADASYN", 0.849286847575662, 0.5883695270672019, 0.5237459239737348, 0.62774941595693),
    ("XGBoost", "ADASYN", 0.8395360980406394, 0.5833769297869627, 0.5270275904170576, 0.6248769861024198),
    ("Extra Trees", "ADASYN", 0.8359532009654147, 0.5785202529510363, 0.5259317163234616, 0.6218430753036011),
    ("Extra Trees", "SMOTE", 0.8378660990884439, 0.5771337492116455, 0.5193862509492116, 0.6192178373758717),
    ("Extra Trees", "class_weight", 0.8390876477630769, 0.5498873316738514, 0.44192016199877904, 0.5790005428261289),
    ("Random Forest", "class_weight", 0.8507032196562268, 0.551870355288674, 0.43045368591891126, 0.5780119036326571),
]
# True and false negatives and positives on the 1,000 test rows, and what follows.
CONFUSION = {"tn": 747, "fp": 49, "fn": 78, "tp": 126}
THRESHOLD = 0.44155844155844143


def test_all_composite_scores_and_ranks(spark):
    rows = spark.createDataFrame([r[:5] for r in COMPARISON], "Model string, Strategy string, `ROC-AUC` double, F1 double, Recall double")
    got = search.rank_results(rows).orderBy("rank").collect()
    assert [(r["Model"], r["Strategy"]) for r in got] == [r[:2] for r in COMPARISON]
    assert [r["Score"] for r in got] == pytest.approx([r[5] for r in COMPARISON], abs=1e-14)
    assert search.rank_results(rows, recall_floor=0.60).count() == 6
    best = {r["Strategy"]: r["best_model"] for r in search.strategy_summary(search.rank_results(rows)).collect()}
    assert best == {"class_weight": "CatBoost", "SMOTE": "Logistic Regression", "ADASYN": "Random Forest"}


def test_confusion_counts_and_point_metrics(spark):
    scored = spark.createDataFrame(
        [(y, p) for (y, p), n in zip([(0, 0.1), (0, THRESHOLD), (1, 0.44), (1, 0.9)], CONFUSION.values()) for _ in range(n)], "y int, p double")
    got = curves.point_metrics(scored, THRESHOLD).first()
    assert {c: got[c] for c in CONFUSION} == CONFUSION
    assert (got["precision"], got["recall"], got["f1"], got["accuracy"]) == pytest.approx((0.72, 0.6176470588235294, 0.6649076517150396, 0.873))
    matrix = {r["actual"]: (r["pred_0"], r["pred_1"]) for r in curves.confusion_matrix(scored, THRESHOLD).collect()}
    assert matrix == {0: (747, 49), 1: (78, 126)}
    status = {r["Metric"]: r["Status"] for r in curves.targets_status(scored, THRESHOLD).collect()}
    assert status["F1"] == status["Recall"] == status["Precision"] == "PASS"


def test_bands_around_the_published_threshold(spark):
    marks = [0.0, THRESHOLD - 0.16, THRESHOLD - 0.14, THRESHOLD, THRESHOLD + 0.05, THRESHOLD + 0.2, THRESHOLD + 0.3]
    frame = spark.createDataFrame([(p,) for p in marks], "p double")
    got = frame.select(D.confidence("p", THRESHOLD).alias("c"), D.risk_label("p", THRESHOLD).alias("r")).collect()
    assert [r["c"] for r in got] == ["Strong", "Moderate", "Moderate", "Borderline", "Borderline", "Moderate", "Strong"]
    assert [r["r"] for r in got] == ["Low", "Low", "Elevated", "High", "High", "High", "High"]
    assert frame.where(F.col("p") >= THRESHOLD).count() == 4
