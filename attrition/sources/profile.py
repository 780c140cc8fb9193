"""Customer profile and scored fixtures derived from the order tables.

The profile has the raw churn-table columns (see ``attrition.schema``):
history is every order before the as-of date, the label looks only at later
orders. Columns without a counterpart in the order data are fixed functions of
the key, so they carry no signal.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.sources.tables import read_table

AS_OF = date(2000, 7, 1)


def _months_before(d: date, months: int) -> date:
    y, m = divmod(d.year * 12 + d.month - 1 - months, 12)
    return date(y, m + 1, d.day)


def order_history(orders: DataFrame, as_of: date = AS_OF) -> DataFrame:
    """One row per customer with history before ``as_of``; one pass over orders.

    Every measure is a conditional aggregate, so the map side combines before
    the single shuffle on ``o_custkey``.
    """
    recent_from = _months_before(as_of, 12)
    active_from = _months_before(as_of, 6)
    d = F.col("o_orderdate")
    hist = d < F.lit(as_of)
    agg = (orders
           .groupBy(F.col("o_custkey").alias("c_custkey"))
           .agg(F.min(F.when(hist, d)).alias("first_order"),
                F.count(F.when(hist, 1)).alias("n_hist"),
                F.count(F.when(hist & (d >= F.lit(recent_from)), 1)).alias("n_recent"),
                F.max(F.when(hist & F.col("o_orderpriority").startswith("1"), 1)
                      .otherwise(0)).alias("has_card"),
                F.max(F.when(hist & (d >= F.lit(active_from)), 1).otherwise(0)).alias("active"),
                F.sum(F.when(hist, F.col("o_totalprice").cast("decimal(18,2)"))).alias("spend"),
                F.max(F.when(~hist, 1).otherwise(0)).alias("has_later")))
    return agg.where(F.col("n_hist") > 0)


def synthetic_int(key: Column, mult: int, mod: int, base: int) -> Column:
    return (F.lit(base) + (key * F.lit(mult)) % F.lit(mod)).cast("int")


def customer_profile(spark: SparkSession, sf_dir: str, as_of: date = AS_OF) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    orders = read_table(spark, sf_dir, "orders",
                        ["o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    # Geography dimension: nation x region is a 25-row lookup; the planner
    # broadcasts it from its measured size and falls back to a shuffle join.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("Geography"))
    hist = order_history(orders, as_of)
    key = F.col("c_custkey")
    return (customer.join(hist, "c_custkey").join(geo, "c_nationkey")
            .select(key.alias("CustomerId"),
                    synthetic_int(key, 7919, 501, 350).alias("CreditScore"),
                    F.col("Geography"),
                    F.when(key % 2 == 0, "Female").otherwise("Male").alias("Gender"),
                    synthetic_int(key, 37, 75, 18).alias("Age"),
                    (F.lit(as_of.year) - F.year("first_order")).cast("int").alias("Tenure"),
                    F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("Balance"),
                    F.least(F.greatest(F.col("n_recent"), F.lit(1)), F.lit(4))
                    .cast("int").alias("NumOfProducts"),
                    F.col("has_card").cast("int").alias("HasCrCard"),
                    F.col("active").cast("int").alias("IsActiveMember"),
                    (F.col("spend").cast("double") / 6).alias("EstimatedSalary"),
                    (1 - F.col("has_later")).cast("int").alias("Exited")))


def scored_fixture(profile: DataFrame) -> DataFrame:
    """``(CustomerId, y, p)``: a label-leaking score with many ties, for
    curve/threshold/calibration/decision tests only."""
    return profile.select("CustomerId", F.col("Exited").cast("int").alias("y"), fixture_score().alias("p"))


def fixture_score() -> Column:
    """The score of ``scored_fixture`` as a column of the profile."""
    m = (F.col("CustomerId") * 7919) % 1000
    return (F.floor((F.lit(300.0) * F.col("Exited") + F.lit(0.7) * m) / 10) / 100).cast("double")
