"""Model generations that survive a crash between any two writes; rejected lines of a CSV."""

import os
import uuid

import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from attrition.operators import models
from attrition.session import checkpoint_dir
from attrition.sources import files
from attrition.sources.profile import customer_profile
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def pairs(spark):
    """Two models with their calibrators and thresholds, told apart by their coefficients."""
    profile = customer_profile(spark, SF_SMALL).cache()
    made = []
    for c, t in ((0.001, 0.31), (10.0, 0.62)):
        m = models.strategy_pipeline("Logistic Regression", "class_weight", C=c).fit(profile)
        iso = IsotonicRegression(featuresCol="p").fit(spark.createDataFrame([(0.0, t), (1.0, t)], "p double, label double"))
        made.append((m, t, iso))
    return made


def loaded(spark, folder):
    model, t, name = files.load_model(spark, folder)
    return model.stages[-1].getRegParam(), t, files.load_calibrator(spark, folder, name).predictions.tolist()[0]


def test_a_crash_between_any_two_writes_keeps_the_pair_before(spark, pairs, monkeypatch):
    folder = os.path.join(checkpoint_dir(spark), f"generations-{uuid.uuid4().hex}")
    preds = spark.createDataFrame([(1,)], "actual int")
    (one, t1, c1), (two, t2, c2) = pairs
    files.save_model(one, t1, folder, "m", c1, preds, spark)
    before = loaded(spark, folder)
    assert before[1:] == (t1, pytest.approx(t1))

    class Crash(Exception):
        pass

    def die(*_, **__):
        raise Crash

    # The writes come in this order: pipeline, calibrator, threshold, predictions, manifest.
    class Dies:
        def __init__(self, whole):
            self.whole = whole

        def write(self):
            if self.whole is None:
                raise Crash
            return self.whole.write()

    for attempt in ("pipeline", "calibrator", "predictions", "manifest"):
        with monkeypatch.context() as patch:
            if attempt == "predictions":
                patch.setattr(files, "write_csv", die)
            if attempt == "manifest":
                patch.setattr(files, "_manifest", die)
            with pytest.raises(Crash):
                files.save_model(Dies(None) if attempt == "pipeline" else two, t2, folder, "m",
                                 Dies(None) if attempt == "calibrator" else c2, preds, spark)
        assert loaded(spark, folder) == before, attempt
    files.save_model(two, t2, folder, "m", c2, preds, spark)
    after = loaded(spark, folder)
    assert after[1] == t2 and after[0] != before[0] and after[2] == pytest.approx(t2)
    assert files.list_models(spark, folder) == ["m"]
    with pytest.raises(FileNotFoundError):
        files.load_calibrator(spark, folder, "other")


HEAD = "RowNumber,CustomerId,Surname,CreditScore,Geography,Gender,Age,Tenure,Balance,NumOfProducts,HasCrCard,IsActiveMember,EstimatedSalary,Exited"


def test_good_and_rejected_lines_are_all_lines(spark, tmp_path):
    good = [f'{i},{i},"Name, {i}",600,France,Male,40,3,{i}.5,1,1,0,100.25,0' for i in range(5)]
    bad = ["6,6,X,six hundred,France,Male,40,3,1.5,1,1,0,100,0", "7,7,X,600,France", "8,8,X,600,France,Male,40,3,1.5,1,1,0,100,0,extra",
           "9,,X,600,France,Male,40,3,1.5,1,1,0,100,0"]
    (tmp_path / "a.csv").write_text("\n".join([HEAD, *good[:3], bad[0], "", bad[1]]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([HEAD, *good[3:], *bad[2:]]) + "\n")
    (tmp_path / "c.csv").write_text("\n".join([HEAD.replace("Age,Tenure", "Tenure,Age"), good[0]]) + "\n")
    rows, rejects = files.read_csv_with_rejects(spark, str(tmp_path), required=["CustomerId"])
    assert rows.schema == files.RAW_SCHEMA
    assert sorted((r["CustomerId"], r["Surname"], r["Balance"]) for r in rows.collect()) == [(i, f"Name, {i}", i + 0.5) for i in range(5)]
    told = {(r["line"], r["reason"]) for r in rejects.collect()}
    assert told == {(bad[0], "fields do not fit the schema"), (bad[1], "fields do not fit the schema"), (bad[2], "fields do not fit the schema"),
                    (bad[3], "no CustomerId"), (good[0], "header of the file does not match")}
    assert rows.count() + rejects.count() == 10
    assert rows.exceptAll(files.read_csv(spark, str(tmp_path / "b.csv"))).count() == 3
    assert rows.where(F.col("Exited") == 0).count() == 5
