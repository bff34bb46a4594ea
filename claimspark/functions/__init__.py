"""Column expressions shared by the operators (all JVM-side, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimspark.schemas import (
    AGE_BUCKET_TOP,
    AGE_BUCKETS,
    DEFAULT_EXPECTED_LOS,
    DEFAULT_RISK,
    DIAGNOSIS_RISK,
    EXPECTED_LOS,
    RISK_TIER_BOTTOM,
    RISK_TIERS,
)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(key: str | Column, mapping: dict, default) -> Column:
    """Literal map lookup with a default for missing or null keys."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(m[col(key)], F.lit(default))


def diagnosis_risk(code: str | Column = "diagnosis_code") -> Column:
    return lookup(code, DIAGNOSIS_RISK, DEFAULT_RISK).cast("int")


def expected_los(code: str | Column = "diagnosis_code") -> Column:
    return lookup(code, {k: float(v) for k, v in EXPECTED_LOS.items()}, DEFAULT_EXPECTED_LOS)


def age_bucket(age: str | Column = "age") -> Column:
    """Clinical age band; like the source logic, a null age falls to the top band."""
    a = col(age)
    expr = None
    for upper, label in AGE_BUCKETS:
        expr = F.when(a < upper, label) if expr is None else expr.when(a < upper, label)
    return expr.otherwise(AGE_BUCKET_TOP)


def risk_tier(p: str | Column) -> Column:
    x = col(p)
    expr = None
    for lower, label in RISK_TIERS:
        expr = F.when(x >= lower, label) if expr is None else expr.when(x >= lower, label)
    return expr.otherwise(RISK_TIER_BOTTOM)


def mean(c: str | Column) -> Column:
    """avg() as exact-sum / count in double (null when no non-null input).

    Summing first (exactly, for ints and decimals) and dividing once makes
    the result independent of partitioning and row order.
    """
    return F.try_divide(F.sum(col(c)).cast("double"), F.count(col(c)).cast("double"))


def ratio_or(num: str | Column, den: str | Column, default: float) -> Column:
    """num / den when den > 0 else default (double)."""
    d = col(den)
    return F.when(d > 0, col(num).cast("double") / d.cast("double")).otherwise(F.lit(float(default)))


def flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0).cast("int")


def days(d: str | Column) -> Column:
    """Days since the epoch (int) for a date column."""
    return F.datediff(col(d), F.lit("1970-01-01").cast("date"))
