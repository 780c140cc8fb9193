"""Batch scoring: read rows -> saved pipeline -> calibrated probability ->
decision -> banded result -> counts -> sorted output. A map-only job until the
final sort; the fitted pipeline applies unchanged to a streaming DataFrame."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.operators import calibrate, decide, models
from attrition.schema import KEY


def score_batch(raw: DataFrame, model: PipelineModel, t: float, calibrator=None,
                key: str = KEY) -> DataFrame:
    """The batch result table for raw customer rows (ids/target ignored if present)."""
    inputs = [c for c in decide.drop_ids(raw).columns if c != key]
    # The inputs travel beside the model's columns, which may overwrite some of them.
    kept = raw.select("*", F.struct(*inputs).alias("_inputs"))
    scored = model.transform(kept).select(key, "_inputs", models.positive_probability().alias("probability"))
    if calibrator is not None:
        scored = calibrate.apply_isotonic(calibrator, scored, "probability", "p_cal").select(
            key, "_inputs", F.col("p_cal").alias("probability"))
    return decide.batch_result(scored.select(key, "probability", "_inputs.*"), t, key=key, inputs=inputs)
