"""Data audit: shape, duplicate rows, per-column profile, split summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType, FloatType, IntegerType, LongType,
                               MapType, NumericType, ShortType, StringType, StructType, TimestampType)


def duplicates(df: DataFrame) -> DataFrame:
    """``(rows, columns, duplicates)``; duplicates = rows - distinct rows, nulls
    compare equal. One grouping over all columns, combined map-side."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return groups.agg(F.sum("_c").cast("long").alias("rows"),
                      F.lit(len(df.columns)).cast("long").alias("columns"),
                      F.sum(F.col("_c") - 1).cast("long").alias("duplicates"))


def dtype_name(dt) -> str:
    if isinstance(dt, (IntegerType, LongType, ShortType)):
        return "int"
    if isinstance(dt, (DoubleType, FloatType)):
        return "float"
    if isinstance(dt, BooleanType):
        return "bool"
    if isinstance(dt, StringType):
        return "string"
    return dt.simpleString()


def _as_text(field) -> Column:
    """A column's value as text that is equal exactly when the values are."""
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (DoubleType, FloatType)):
        c = F.when(c == 0, F.lit(0).cast(kind)).otherwise(c)
    if isinstance(kind, TimestampType):
        c = F.unix_micros(c)
    if isinstance(kind, BinaryType):
        return F.hex(c)
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c)))
    return c.cast("string")


def _bounds(df: DataFrame) -> DataFrame:
    """One row per column: position, column, dtype, rows, nulls, min, max, in one aggregate without Expand."""
    aggs = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        numeric = isinstance(f.dataType, NumericType)
        aggs.append(F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(dtype_name(f.dataType)).alias("dtype"),
            F.count(F.lit(1)).alias("rows"), F.count_if(c.isNull()).cast("long").alias("nulls"),
            (F.min(c).cast("double") if numeric else F.lit(None).cast("double")).alias("min"),
            (F.max(c).cast("double") if numeric else F.lit(None).cast("double")).alias("max")).alias(f"c{i}"))
    return df.agg(*aggs).select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(aggs))])).alias("a")).select("a.*")


def _values(df: DataFrame) -> DataFrame:
    """Rows (position, value) of every known cell."""
    cells = F.array(*[F.struct(F.lit(i).alias("position"), _as_text(f).alias("value")) for i, f in enumerate(df.schema.fields)])
    return df.select(F.explode(cells).alias("cell")).select("cell.*").where("value is not null")


def column_audit(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: dtype, nulls, distinct non-null values, and min/max
    for numeric columns (null elsewhere). Distinct values come from one grouping by
    (column, value), which combines copies before the shuffle; ``exact=False`` estimates them by
    the sketches of ``column_sketches``."""
    if not exact:
        return audit_of(column_sketches(df))
    distinct = _values(df).groupBy("position", "value").agg(F.lit(1).alias("one")).groupBy("position").agg(F.count("*").alias("distinct"))
    # One row per column on both sides.
    return _bounds(df).join(F.broadcast(distinct), "position", "left").select(
        "position", "column", "dtype", "nulls", F.coalesce("distinct", F.lit(0)).alias("distinct"), "min", "max")


#: Size of a sketch (2 to this power buckets) and the relative standard error of its estimate.
SKETCH_POWER = 12
SKETCH_ERROR = 1.04 / (1 << SKETCH_POWER) ** 0.5


def column_sketches(df: DataFrame) -> DataFrame:
    """One row per column: rows, nulls, min, max and a sketch of its distinct values. Such tables are
    kept (one per day, say) and merged by ``merge_sketches``; no row has to be read again."""
    sketch = _values(df).groupBy("position").agg(F.hll_sketch_agg("value", F.lit(SKETCH_POWER)).alias("sketch"))
    return _bounds(df).join(F.broadcast(sketch), "position", "left")


def merge_sketches(*tables: DataFrame) -> DataFrame:
    """The sketch table of all rows behind the given tables, whose columns are matched by name."""
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    return every.groupBy("column").agg(
        F.min("position").alias("position"), F.min("dtype").alias("dtype"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.hll_union_agg("sketch").alias("sketch")).select(tables[0].columns)


def audit_of(sketches: DataFrame) -> DataFrame:
    """The column audit that a sketch table stands for; distinct values within a few SKETCH_ERROR."""
    return sketches.select("position", "column", "dtype", "nulls",
                           F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).cast("long").alias("distinct"), "min", "max")


def split_summary(df: DataFrame, split_col: str = "is_test", label: str = "Exited") -> DataFrame:
    return (df.groupBy(F.when(F.col(split_col), "test").otherwise("train").alias("split"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.avg(F.col(label).cast("double")).alias("churn_rate")))
