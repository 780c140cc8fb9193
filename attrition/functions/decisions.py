"""Decision, labelling and banding expressions for scored rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from attrition.schema import CONFIDENCE_MARGINS, ELEVATED_MARGIN, GAUGE_EDGES


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def decide(p="probability", t=0.5) -> Column:
    """1 when p >= t else 0."""
    return (_c(p) >= _c(t)).cast("int")


def decision_label(pred="predicted") -> Column:
    return F.when(_c(pred) == 1, "CHURN").otherwise("RETAIN")


def round_probability(p="probability", digits: int = 4) -> Column:
    # numpy rounds half to even.
    return F.bround(_c(p), digits)


def error_type(actual="actual", predicted="predicted") -> Column:
    a, p = _c(actual), _c(predicted)
    return (F.when((a == 1) & (p == 0), "False Negative")
            .when((a == 0) & (p == 1), "False Positive")
            .otherwise("Correct"))


def confidence(p="probability", t=0.5) -> Column:
    margin = F.abs(_c(p) - _c(t))
    lo, hi = CONFIDENCE_MARGINS
    return (F.when(margin < lo, "Borderline").when(margin < hi, "Moderate")
            .otherwise("Strong"))


def risk_label(p="probability", t=0.5) -> Column:
    """Single-customer rule: p >= t High; |p - t| <= 0.15 Elevated; else Low."""
    p, t = _c(p), _c(t)
    return (F.when(p >= t, "High")
            .when(F.abs(p - t) <= ELEVATED_MARGIN, "Elevated")
            .otherwise("Low"))


def risk_band(p="probability", t=0.5) -> Column:
    """Batch rule, right-closed bins (0, t-0.15], (t-0.15, t], (t, 1].

    The floor is clamped at 0, so with t <= 0.15 the Low bin is empty. p = 0
    and anything outside (0, 1] is null.
    """
    p, t = _c(p), _c(t)
    floor = F.greatest(t - ELEVATED_MARGIN, F.lit(0.0))
    return (F.when((p > 0) & (p <= floor), "Low")
            .when((p > floor) & (p <= t), "Elevated")
            .when((p > t) & (p <= 1.0), "High"))


def gauge_zone(p="probability") -> Column:
    pct = _c(p) * 100
    lo, hi = GAUGE_EDGES
    return F.when(pct < lo, "low").when(pct < hi, "medium").otherwise("high")
