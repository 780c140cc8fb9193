"""Derived-feature column expressions (stateless, JVM-side)."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.schema import AGE_BINS


def quotient(a: Column, b: Column) -> Column:
    """a / b as floating point has it: a zero divisor gives an infinity, 0/0 NaN, null stays null."""
    a, b = a.cast("double"), b.cast("double")
    by_zero = (F.when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf")))
               .when(a.isNotNull(), F.lit(float("nan"))))
    return F.when(b == 0, by_zero).when(b.isNotNull(), F.try_divide(a, b))


def balance_salary_ratio(balance: str = "Balance", salary: str = "EstimatedSalary") -> Column:
    return quotient(F.col(balance), F.col(salary) + 1)


def active_by_card(active: str = "IsActiveMember", card: str = "HasCrCard") -> Column:
    return F.col(active) * F.col(card)


def products_per_year(products: str = "NumOfProducts", tenure: str = "Tenure") -> Column:
    return quotient(F.col(products), F.col(tenure) + 1)


def age_group(age: Column | str = "Age") -> Column:
    """Right-closed bins; ages outside every bin, or null, give the string 'nan'."""
    a = F.col(age) if isinstance(age, str) else age
    expr = None
    for lo, hi, label in AGE_BINS:
        cond = (a > lo) & (a <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise("nan")


def engineer(df: DataFrame,
             extra_features: Iterable[Callable[[DataFrame], DataFrame]] | None = None) -> DataFrame:
    """Base derived features, then caller callables in order."""
    out = df.withColumns({
        "BalanceSalaryRatio": balance_salary_ratio(),
        "IsActive_by_CreditCard": active_by_card(),
        "ProductsPerYear": products_per_year(),
        "AgeGroup": age_group("Age"),
    })
    for fn in extra_features or []:
        out = fn(out)
    return out


def numeric_columns(df: DataFrame) -> list[str]:
    from pyspark.sql.types import NumericType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
