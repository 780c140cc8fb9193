"""A durable ledger of fits, so that a stopped comparison or search goes on where it was.

One row per finished piece of work, a model fitted without one fold: its id is a hash of the data's
version, the model's name with all parameters, and the fold. The scores of the held-out fold are
written first, the row after them; a piece without a row is pending and is done again from the
start. What is pending is an anti-join of the planned work with the ledger.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.operators.models import AttritionPipeline, score
from attrition.schema import KEY, TARGET

_ROW = "id string, version string, model string, fold int, rows long"


def data_version(df: DataFrame) -> str:
    """A hash of the rows whatever their order, their number and the schema."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    of = df.agg(F.count("*").alias("n"), F.bit_xor(row).alias("x"), F.sum(F.pmod(row, F.lit((1 << 31) - 1))).alias("s")).first()
    return hashlib.sha256(f"{df.schema.simpleString()}|{of['n']}|{of['x']}|{of['s']}".encode()).hexdigest()


def model_name(**parts) -> str:
    """The canonical text of a model's family, strategy and parameters."""
    return json.dumps(parts, sort_keys=True, default=str)


def work_id(version: str, model: str, fold: int) -> str:
    return hashlib.sha256(f"{version}|{model}|{fold}".encode()).hexdigest()


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(_ROW).option("recursiveFileLookup", True).parquet(os.path.join(self.path, "ledger"))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], _ROW)
            raise

    def pending(self, version: str, models: list[str], folds: list[int]) -> list[tuple[str, int]]:
        """(model, fold) of the planned work without a row, in the planned order."""
        planned = [(i, work_id(version, m, k), m, k) for i, (m, k) in enumerate((m, k) for m in models for k in folds)]
        if not planned:
            return []
        table = self.spark.createDataFrame(planned, "place int, id string, model string, fold int")
        left = table.join(self.rows(), "id", "left_anti").orderBy("place").collect()
        return [(r["model"], r["fold"]) for r in left]

    def _scores(self, version: str, model: str, fold: int) -> str:
        return os.path.join(self.path, "scores", work_id(version, model, fold))

    def record(self, version: str, model: str, fold: int, scores: DataFrame) -> None:
        path = self._scores(version, model, fold)
        scores.write.mode("overwrite").parquet(path)
        n = self.spark.read.parquet(path).count()
        # A folder per row: pieces that end at the same time do not meet in one commit.
        self.spark.createDataFrame([(work_id(version, model, fold), version, model, fold, n)], _ROW) \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(self.path, "ledger", work_id(version, model, fold)))

    def scores(self, version: str, model: str, folds: list[int]) -> DataFrame:
        """Out-of-fold scores of a model whose folds are all done."""
        return self.spark.read.parquet(*[self._scores(version, model, k) for k in folds])


def out_of_fold(ledger: Ledger, folded: DataFrame, models: dict[str, Callable[[], AttritionPipeline]], fold: str = "fold",
                key: str = KEY, label: str = TARGET, parallelism: int = 5) -> dict[str, DataFrame]:
    """Out-of-fold scores of every named model; only folds that the ledger lacks are fitted."""
    version = data_version(folded)
    folds = sorted(r[0] for r in folded.select(fold).distinct().collect())

    def fit(item: tuple[str, int]) -> None:
        name, k = item
        model = models[name]().fit(folded.where(F.col(fold) != k).drop(fold))
        held = score(model, folded.where(F.col(fold) == k), key, label)
        ledger.record(version, name, k, held.withColumn(fold, F.lit(k)))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        list(pool.map(fit, ledger.pending(version, list(models), folds)))
    return {name: ledger.scores(version, name, folds) for name in models}
