"""Customer attrition analytics on Spark DataFrames, Spark SQL and pyspark.ml."""

from attrition.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
