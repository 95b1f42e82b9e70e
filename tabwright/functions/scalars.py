"""Row-wise column expressions: missing values, bounds, dates, logs, weights."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    """Missing is NULL throughout; Spark orders NaN above every number."""
    return F.when(~F.isnan(c), c)


def sentinel_to_value(c: Column, sentinel: str, value: float) -> Column:
    return F.when(c == sentinel, F.lit(float(value))).otherwise(c.try_cast("double"))


def sentinel_to_null(c: Column, sentinel: str) -> Column:
    return F.nullif(c, F.lit(sentinel)).try_cast("float")


def clip(c: Column, lower: float | None = None, upper: float | None = None) -> Column:
    """Winsorise; a missing value stays missing (``least``/``greatest`` would replace it)."""
    out = c
    if upper is not None:
        out = F.when(c > upper, F.lit(float(upper))).otherwise(out)
    if lower is not None:
        out = F.when(c < lower, F.lit(float(lower))).otherwise(out)
    return out


def floor_at_zero(c: Column) -> Column:
    return clip(c, lower=0.0)


def repaired_date(c: Column) -> Column:
    """Date from ``yyyymmdd``, reading month 00 as January; NULL when there is no such day."""
    text = c.cast("string")
    month = F.substring(text, 5, 2)
    month = F.when(month == "00", "01").otherwise(month)
    fixed = F.concat(F.substring(text, 1, 4), month, F.substring(text, 7, 2))
    return F.try_to_date(fixed, "yyyyMMdd")


def date_parts(c: Column, prefix: str) -> list[Column]:
    """Year, month, day and day of week (Monday is 0)."""
    return [
        F.year(c).alias(f"{prefix}_year"),
        F.month(c).alias(f"{prefix}_month"),
        F.dayofmonth(c).alias(f"{prefix}_day"),
        F.weekday(c).alias(f"{prefix}_dayofweek"),
    ]


def day_gap(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def years_of(days: Column) -> Column:
    """Age in years to one decimal. A tie would need a fractional day, so none occurs."""
    return F.round(days / F.lit(365.0), 1)


def days_since(date: Column, as_of: str | None = None) -> Column:
    """Days up to ``as_of`` (ISO date); today when it is left out."""
    end = F.lit(as_of).cast("date") if as_of else F.current_date()
    return F.datediff(end, date)


def text_prefix(c: Column, length: int = 2) -> Column:
    return F.substring(c.cast("string"), 1, length)


def to_log(c: Column) -> Column:
    return F.log1p(c)


def from_log(c: Column) -> Column:
    return F.expm1(c)


WeightHook = Callable[[Column], Column]


def smoothing_weight(k: float = 2.0, f: float = 1.0) -> WeightHook:
    """Weight of the prior after ``n`` observations: one half at ``n = k``, slope ``1/f``."""
    return lambda n: F.lit(1.0) / (F.lit(1.0) + F.exp((n - F.lit(float(k))) / F.lit(float(f))))


def weight_hook(spec: dict | WeightHook | None) -> WeightHook:
    """Accept nothing, ``{"k": .., "f": ..}`` or any ``Column -> Column`` function."""
    if spec is None:
        return smoothing_weight()
    return smoothing_weight(**spec) if isinstance(spec, dict) else spec
