"""Arithmetic that follows pandas where Spark's defaults differ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num, den) -> Column:
    """num / den, NULL when the denominator is zero (plain ``/`` raises in ANSI mode)."""
    return F.try_divide(num, den)


def nan_to_null(c: Column) -> Column:
    """NaN poisons sum and avg and sorts as the largest value, so it becomes NULL on the way in."""
    return F.when(~F.isnan(c), c)


def missing_as_null(df):
    """NaN -> NULL in every floating column of a source."""
    kinds = ("double", "float")
    return df.select(
        *[
            nan_to_null(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() in kinds else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def pearson(a: str, b: str) -> Column:
    """Aggregate: correlation over rows that have both values; NULL if one is constant (``corr`` raises then)."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
    return ratio(F.covar_pop(a, b), F.stddev_pop(x) * F.stddev_pop(y))


def share(flag: Column) -> Column:
    """Aggregate: percentage of rows for which ``flag`` holds."""
    return ratio(F.count_if(flag) * F.lit(100.0), F.count(F.lit(1)))


def adjusted_skew(skew_pop: Column, n: Column) -> Column:
    """Bias-adjusted skewness from the population one; NULL below three values."""
    return F.when(n > 2, skew_pop * F.sqrt(n * (n - 1.0)) / (n - 2.0))


def adjusted_kurtosis(kurt_pop: Column, n: Column) -> Column:
    """Bias-adjusted excess kurtosis from the population one; NULL below four values."""
    return F.when(n > 3, (n - 1.0) / ((n - 2.0) * (n - 3.0)) * ((n + 1.0) * kurt_pop + 6.0))


def tukey_low(q1: Column, q3: Column) -> Column:
    return q1 - 1.5 * (q3 - q1)


def tukey_high(q1: Column, q3: Column) -> Column:
    return q3 + 1.5 * (q3 - q1)


def outside(x: Column, low: Column, high: Column) -> Column:
    return (x < low) | (x > high)
