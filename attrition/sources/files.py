"""File sources and sinks: CSV with an explicit schema, CSV/JSON/Parquet outputs,
and the model + threshold pair."""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from attrition.schema import DEFAULT_THRESHOLD, RAW_SCHEMA


def read_csv(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """Header CSV with a declared schema (no inference pass over the data)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csv_with_rejects(spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA,
                          required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Good rows in the declared schema, and rejected lines as ``(line, reason)``: every line of data
    is in one of the two.

    A line is rejected if its fields do not parse into the schema, if their number differs, or if a
    ``required`` column is empty. The header of every file must name the schema's columns in order;
    lines of other files are rejected as a whole. A quoted field may not hold a line break."""
    names = schema.fieldNames()
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    # The first line of a file is the first row of its first block; one row per file.
    heads = lines.where("block = 0").groupBy("file").agg(F.min_by("line", "at").alias("head"), F.min("at").alias("head_at"))
    clean = lambda c: F.transform(F.split(c, ","), lambda v: F.trim(F.regexp_replace(v, "^\\ufeff|\"", "")))
    marked = lines.join(heads.select("file", "head_at", (clean(F.col("head")) == F.array(*[F.lit(n) for n in names])).alias("named")), "file")
    data = marked.where("at <> head_at and trim(line) <> ''")
    parsed = data.withColumn("row", F.from_csv("line", f"{_ddl(schema)}, _corrupt string",
                                               {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    empty = F.lit(None).cast("string")
    for c in reversed(required or []):
        empty = F.when(F.col(f"row.{c}").isNull(), F.lit(f"no {c}")).otherwise(empty)
    reason = (F.when(~F.col("named"), F.lit("header of the file does not match"))
              .when(F.col("row._corrupt").isNotNull(), F.lit("fields do not fit the schema")).otherwise(empty))
    told = parsed.withColumn("reason", reason)
    return told.where("reason is null").select("row.*").select(*names), told.where("reason is not null").select("line", "reason")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json_params(spark: SparkSession, params: dict, path: str) -> None:
    """Best parameters as one JSON record (values as strings, keys kept)."""
    row = {k: str(v) for k, v in params.items()}
    spark.createDataFrame([row]).coalesce(1).write.mode("overwrite").json(path)


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, None if nothing is there; any other error is raised."""
    try:
        return spark.read.option("recursiveFileLookup", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


_MANIFEST = "name string, number long, generation string, threshold double, calibrated boolean, predictions boolean"


def _manifest(spark: SparkSession, model_dir: str) -> DataFrame | None:
    return _read_if_there(spark, os.path.join(model_dir, "manifest"))


def save_model(model: PipelineModel, threshold: float, model_dir: str, name: str,
               calibrator: IsotonicRegressionModel | None = None,
               predictions: DataFrame | None = None, spark: SparkSession | None = None) -> str:
    """Pipeline, its calibrator, threshold and predictions table saved under one name; returns the
    folder of this generation.

    Every save writes a fresh generation and publishes it by one manifest row written last, so a
    save that stops between any two writes leaves the generation before it in force. A threshold
    chosen on calibrated scores is only right together with its calibrator: both are read through
    the same row."""
    spark = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    generation = uuid.uuid4().hex
    base = os.path.join(model_dir, name, generation)
    model.write().overwrite().save(os.path.join(base, "pipeline"))
    if calibrator is not None:
        calibrator.write().overwrite().save(os.path.join(base, "calibrator"))
    spark.createDataFrame([(float(threshold), calibrator is not None)], "threshold double, calibrated boolean") \
        .coalesce(1).write.mode("overwrite").parquet(os.path.join(base, "threshold"))
    if predictions is not None:
        write_csv(predictions, os.path.join(base, "predictions"))
    known = _manifest(spark, model_dir)
    last = known.where(F.col("name") == name).agg(F.max("number")).first()[0] if known is not None else None
    spark.createDataFrame([(name, (last or 0) + 1, generation, float(threshold), calibrator is not None, predictions is not None)], _MANIFEST) \
        .coalesce(1).write.mode("overwrite").parquet(os.path.join(model_dir, "manifest", generation))
    return base


def list_models(spark: SparkSession, model_dir: str) -> list[str]:
    """Names published under model_dir, from its small manifest."""
    known = _manifest(spark, model_dir)
    return sorted({r[0] for r in known.select("name").distinct().collect()}) if known is not None else []


def _published(spark: SparkSession, model_dir: str, name: str) -> str:
    """Folder of the latest published generation of a name."""
    known = _manifest(spark, model_dir)
    rows = known.where(F.col("name") == name).orderBy(F.desc("number"), "generation").limit(1).collect() if known is not None else []
    if not rows:
        raise FileNotFoundError(f"no pipeline named {name} found in {model_dir}")
    return os.path.join(model_dir, name, rows[0]["generation"])


def load_model(spark: SparkSession, model_dir: str,
               name: str | None = None) -> tuple[PipelineModel, float, str]:
    """First published model (by name) and its threshold; a missing threshold
    falls back to 0.50, a missing pipeline is an error."""
    names = list_models(spark, model_dir)
    if name is None:
        if not names:
            raise FileNotFoundError(f"no pipeline found in {model_dir}")
        name = names[0]
    base = _published(spark, model_dir, name)
    model = PipelineModel.load(os.path.join(base, "pipeline"))
    saved = _read_if_there(spark, os.path.join(base, "threshold"))
    row = saved.select("threshold").first() if saved is not None else None
    return model, float(row[0] if row and row[0] is not None else DEFAULT_THRESHOLD), name


def load_calibrator(spark: SparkSession, model_dir: str, name: str) -> IsotonicRegressionModel | None:
    """The calibrator published with a model, None if it was saved without one."""
    base = _published(spark, model_dir, name)
    saved = _read_if_there(spark, os.path.join(base, "threshold"))
    if saved is None or "calibrated" not in saved.columns or not saved.first()["calibrated"]:
        return None
    return IsotonicRegressionModel.load(os.path.join(base, "calibrator"))


def load_predictions(spark: SparkSession, model_dir: str, name: str) -> DataFrame:
    """The predictions table published with a model."""
    return spark.read.option("header", True).csv(os.path.join(_published(spark, model_dir, name), "predictions"))
