"""Aggregate expressions whose definitions differ from Spark's own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(x: Column) -> Column:
    """Sum in which nothing adds up to zero."""
    return F.coalesce(F.sum(x), F.lit(0.0))


def sample_skewness(x: Column) -> Column:
    """Bias-adjusted skewness: missing below three values, 0 for a constant."""
    n = F.count(x).cast("double")
    adjusted = F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n < 3, None).when(F.min(x) == F.max(x), 0.0).otherwise(adjusted)


def sample_kurtosis(x: Column) -> Column:
    """Bias-adjusted excess kurtosis: missing below four values, 0 for a constant."""
    n = F.count(x).cast("double")
    adjusted = ((n + 1) * F.kurtosis(x) + 6) * (n - 1) / ((n - 2) * (n - 3))
    return F.when(n < 4, None).when(F.min(x) == F.max(x), 0.0).otherwise(adjusted)


def entropy_of_counts(n: Column) -> Column:
    """Shannon entropy (natural log) of the distribution given by counts, one per row."""
    whole = F.sum(n).cast("double")
    # A group with a single level has entropy 0; rounding must not make it negative.
    raw = F.log(whole) - F.sum(n * F.log(n.cast("double"))) / whole
    return F.when(F.count(n) <= 1, 0.0).otherwise(raw)


SIMPLE_STATS = {
    "amount": F.count,
    "max": F.max,
    "min": F.min,
    "sum": total,
    "std": F.stddev_samp,
    "mean": F.avg,
    "skew": sample_skewness,
    "kurt": sample_kurtosis,
    "nunique": F.count_distinct,
}
