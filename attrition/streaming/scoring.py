"""The batch-scoring plan applied to a stream of customer files.

A fitted ``PipelineModel`` and the decision expressions are stateless, so the
same plan runs on a streaming DataFrame unchanged; each micro-batch is written
by ``foreachBatch`` (idempotent per batch id, so a restarted query rewrites
the same output).
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from attrition.plans.scoring import score_batch
from attrition.schema import RAW_SCHEMA


def read_customer_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(RAW_SCHEMA).option("header", True).csv(folder)


def start_scoring(spark: SparkSession, folder: str, model: PipelineModel, t: float,
                  out: str, checkpoint: str, calibrator=None):
    stream = read_customer_stream(spark, folder)

    def write(batch: DataFrame, batch_id: int) -> None:
        score_batch(batch, model, t, calibrator).write.mode("overwrite").parquet(
            os.path.join(out, f"batch={batch_id}"))

    return (stream.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).start())
