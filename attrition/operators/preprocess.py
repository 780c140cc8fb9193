"""Fitted preprocessing as ``pyspark.ml`` stages: feature derivation, population
scaling, drop-first one-hot encoding, and the assembled feature vector.

The stages are plain Python ``Estimator``/``Model`` classes with
``DefaultParams`` persistence, so a fitted ``PipelineModel`` holding them saves
and loads like any Spark pipeline. Fitting reads one aggregate row (means and
deviations) or the distinct categories, both bounded by the column list, not
by the data.
"""

from __future__ import annotations

import importlib

from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.functions.features import engineer

#: Distinct values up to which a category column becomes one named column per value; above, one sparse
#: vector, up to the second number. Beyond that a fit stops with an error.
MAX_CATEGORIES = 1000
MAX_SPARSE = 1_000_000


def step(name: str):
    """The function ``module:function`` of a feature step, which takes and returns a DataFrame."""
    module, _, function = name.partition(":")
    if not function:
        raise ValueError(f"a feature step is named module:function, not {name!r}")
    return getattr(importlib.import_module(module), function)


class FeatureEngineer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Stateless: the four derived features (see ``functions.features``), then steps, which are
    functions from DataFrame to DataFrame named ``module:function``, then extra features as SQL
    expressions by name. Names and expressions are saved with the stage, so a loaded pipeline
    derives the same columns."""

    extraFeatures = Param(Params._dummy(), "extraFeatures", "name and SQL expression of added columns",
                          TypeConverters.identity)
    steps = Param(Params._dummy(), "steps", "functions that add columns, as module:function", TypeConverters.toListString)

    def __init__(self, extraFeatures: dict[str, str] | None = None, steps: list[str] | None = None):
        super().__init__()
        self._setDefault(extraFeatures={}, steps=[])
        if extraFeatures:
            self._set(extraFeatures=dict(extraFeatures))
        if steps:
            self._set(steps=list(steps))

    def _transform(self, df: DataFrame) -> DataFrame:
        out = engineer(df, [step(name) for name in self.getOrDefault(self.steps)])
        for name, expression in self.getOrDefault(self.extraFeatures).items():
            out = out.withColumn(name, F.expr(expression))
        return out


class _ScalerParams(HasInputCols):
    means = Param(Params._dummy(), "means", "column means", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "column scales", TypeConverters.toListFloat)


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Standard scaling with the population deviation; a zero deviation scales by 1."""

    def __init__(self, inputCols: list[str] | None = None):
        super().__init__()
        if inputCols is not None:
            self._set(inputCols=inputCols)

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        return fit_scaler_and_encoder(df, self.getInputCols(), [])[0]


class PopulationScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        cols, means, scales = (self.getInputCols(), self.getOrDefault(self.means),
                               self.getOrDefault(self.scales))
        return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                               for c, m, s in zip(cols, means, scales)})

    def parameters(self) -> list[tuple[str, float, float]]:
        return list(zip(self.getInputCols(), self.getOrDefault(self.means),
                        self.getOrDefault(self.scales)))


class _OneHotParams(HasInputCols):
    categories = Param(Params._dummy(), "categories",
                       "kept categories per input column, sorted, first dropped",
                       TypeConverters.identity)
    maxCategories = Param(Params._dummy(), "maxCategories",
                          "fail when a column has more distinct values", TypeConverters.toInt)


class DropFirstOneHot(Estimator, _OneHotParams, DefaultParamsReadable, DefaultParamsWritable):
    """One-hot in alphabetical category order with the first category dropped;
    a value unseen at fit encodes as all zeros. Output columns are named
    ``<column>_<category>``."""

    def __init__(self, inputCols: list[str] | None = None, maxCategories: int = MAX_CATEGORIES):
        super().__init__()
        self._setDefault(maxCategories=MAX_CATEGORIES)
        if inputCols is not None:
            self._set(inputCols=inputCols)
        self._set(maxCategories=maxCategories)

    def _fit(self, df: DataFrame) -> "DropFirstOneHotModel":
        return fit_scaler_and_encoder(df, [], self.getInputCols(), self.getOrDefault(self.maxCategories))[1]


class DropFirstOneHotModel(Model, _OneHotParams, DefaultParamsReadable, DefaultParamsWritable):
    def output_names(self) -> list[str]:
        return [f"{c}_{v}" for c, cats in zip(self.getInputCols(),
                                              self.getOrDefault(self.categories)) for v in cats]

    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, cats in zip(self.getInputCols(), self.getOrDefault(self.categories)):
            for v in cats:
                out[f"{c}_{v}"] = F.coalesce((F.col(c).cast("string") == F.lit(v))
                                             .cast("double"), F.lit(0.0))
        return df.withColumns(out)


class FeatureStages:
    """Unfitted engineer -> scaler -> one-hot -> assembler, fitted together."""

    def __init__(self, num, cat, passthrough, output: str = "features",
                 extra_features: dict[str, str] | None = None, max_categories: int = MAX_CATEGORIES,
                 steps: list[str] | None = None):
        """``extra_features``: SQL expressions by name; they join the scaled numeric columns.
        ``steps``: functions that add columns, as module:function; ``num`` and ``cat`` may name them.
        ``max_categories``: a category column with more distinct values is encoded as a sparse vector."""
        self.extra = dict(extra_features or {})
        self.num = [*num, *[n for n in self.extra if n not in num]]
        self.cat, self.passthrough, self.output = list(cat), list(passthrough), output
        self.max_categories, self.steps = max_categories, list(steps or [])

    def signature(self) -> str:
        """Stages of the same signature fit the same way."""
        return repr((self.num, self.cat, self.passthrough, self.output, sorted(self.extra.items()), self.max_categories, self.steps))

    def fit(self, df: DataFrame) -> PipelineModel:
        eng = FeatureEngineer(self.extra, self.steps)
        engineered = eng.transform(df)
        wide = wide_categories(engineered, self.cat, self.max_categories)
        narrow = [c for c in self.cat if c not in wide]
        scaler, onehot = fit_scaler_and_encoder(engineered, self.num, narrow, self.max_categories)
        columns = {c: [f"{c}_{v}" for v in kept] for c, kept in zip(narrow, onehot.getOrDefault(onehot.categories))}
        sparse = [stage for c in wide for stage in fit_sparse(engineered, c)]
        columns |= {c: [sparse_column(c)] for c in wide}
        names = self.num + [n for c in self.cat for n in columns[c]] + self.passthrough
        asm = VectorAssembler(inputCols=names, outputCol=self.output, handleInvalid="keep")
        return PipelineModel(stages=[eng, scaler, onehot, *sparse, asm])


def sparse_column(column: str) -> str:
    return f"{column}__onehot"


def wide_categories(df: DataFrame, cat: list[str], most: int) -> list[str]:
    """Category columns with more than ``most`` distinct values, in one aggregate."""
    if not cat:
        return []
    counts = df.agg(*[F.count_distinct(F.col(c)).alias(f"k{i}") for i, c in enumerate(cat)]).first()
    return [c for i, c in enumerate(cat) if counts[f"k{i}"] > most]


def fit_sparse(df: DataFrame, column: str) -> list:
    """Two Spark stages that turn a column into a sparse drop-first one-hot vector.

    The dictionary holds all values but the first in alphabetical order; that one, nulls and values
    unseen at fit share the index past its end, which the encoder drops. Looking a value up is one
    hash lookup, whatever the number of categories."""
    values = df.select(F.col(column).cast("string").alias("v")).where("v is not null").distinct()
    labels = [r["v"] for r in values.orderBy("v").limit(MAX_SPARSE + 2).collect()][1:]
    if len(labels) > MAX_SPARSE:
        raise ValueError(f"too many categories for one-hot encoding: ['{column}']")
    spark = df.sparkSession
    index = f"{column}__index"
    lookup = StringIndexerModel.from_labels(labels, inputCol=column, outputCol=index, handleInvalid="keep")
    ends = spark.createDataFrame([(float(len(labels)),)], f"`{index}` double")
    return [lookup, OneHotEncoder(inputCols=[index], outputCols=[sparse_column(column)], dropLast=True).fit(ends)]


def fit_scaler_and_encoder(df: DataFrame, num: list[str], cat: list[str],
                           max_categories: int = MAX_CATEGORIES):
    """Both fits from two passes: means, deviations and category counts in one
    aggregate, then the (checked, bounded) category lists."""
    stats = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(num)],
                   *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}")
                     for i, c in enumerate(num)],
                   *[F.count_distinct(c).alias(f"k{i}") for i, c in enumerate(cat)]).first()
    means = [float(stats[f"m{i}"] or 0.0) for i in range(len(num))]
    scales = [float(stats[f"s{i}"]) if stats[f"s{i}"] else 1.0 for i in range(len(num))]
    too_many = [c for i, c in enumerate(cat) if stats[f"k{i}"] > max_categories]
    if too_many:
        raise ValueError(f"too many categories for one-hot encoding: {too_many}")
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.sort_array(F.collect_set(F.col(c).cast("string"))).alias(f"v{i}")
                                                for i, c in enumerate(cat)]).first() if cat else {}
    scaler = PopulationScalerModel()._set(inputCols=list(num), means=means, scales=scales)
    onehot = DropFirstOneHotModel()._set(inputCols=list(cat), maxCategories=max_categories,
                                         categories=[list(row[f"v{i}"][1:])
                                                     for i in range(len(cat))])
    return scaler, onehot


def feature_names(model: PipelineModel) -> list[str]:
    """Ordered names of the assembled vector: numerics, one-hots, pass-through."""
    spread = {sparse_column(st.getInputCol()): [f"{st.getInputCol()}_{v}" for v in st.labels]
              for st in model.stages if isinstance(st, StringIndexerModel)}
    for st in model.stages:
        if isinstance(st, VectorAssembler):
            return [n for c in st.getInputCols() for n in spread.get(c, [c])]
    raise ValueError("no assembler in pipeline")


def feature_table(model: PipelineModel, df: DataFrame, key: str = "CustomerId",
                  extra: list[str] | None = None) -> DataFrame:
    """Named transformed columns beside the key and any ``extra`` input columns."""
    names = feature_names(model)
    out = model.transform(df)
    return out.select(key, *(extra or []), *[F.col(f"`{n}`").cast("double").alias(n)
                                             for n in names])

