"""Hand-computed cases for the column functions."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.functions import bins, crosses, moments
from tabwright.functions import scalars as S


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_clip_keeps_missing(spark):
    assert column(spark, [700.0, 0.5, 5.0, None], "double", lambda x: S.clip(x, 1, 600)) == [600, 1, 5, None]


def test_nan_becomes_null_before_comparisons(spark):
    assert column(spark, [float("nan"), 700.0], "double", lambda x: S.clip(S.nan_to_null(x), upper=600)) == [None, 600]


def test_sentinels(spark):
    assert column(spark, ["-", "1.0", None, "x"], "string", lambda x: S.sentinel_to_value(x, "-", 0)) == [0, 1, None, None]
    assert column(spark, ["-", "1.0", None], "string", lambda x: S.sentinel_to_null(x, "-")) == [None, 1, None]


def test_repaired_date(spark):
    values = [20160005, 20161231, 20160230, 20161301, None]
    assert column(spark, values, "int", S.repaired_date) == [dt.date(2016, 1, 5), dt.date(2016, 12, 31), None, None, None]


def test_weekday_starts_on_monday(spark):
    monday = dt.date(2024, 1, 1)
    got = column(spark, [monday, dt.date(2024, 1, 7)], "date", lambda x: S.date_parts(x, "d")[3])
    assert got == [0, 6]


def test_days_since_defaults_to_today(spark):
    assert column(spark, [dt.date(2024, 1, 1)], "date", lambda x: S.days_since(x, "2024-01-31")) == [30]
    assert column(spark, [dt.date(2024, 1, 1)], "date", S.days_since)[0] > 300


def test_smoothing_weight(spark):
    assert column(spark, [2, 800, 0], "int", S.weight_hook(None)) == pytest.approx([0.5, 0.0, 1 / (1 + math.exp(-2))])


@pytest.mark.parametrize(
    "x, bin_",
    [(0, None), (-1, None), (0.001, 0), (10, 0), (10.0000001, 1), (300, 29), (301, None), (None, None)],
)
def test_fixed_bins_are_right_closed(spark, x, bin_):
    assert column(spark, [None if x is None else float(x)], "double", lambda c: bins.fixed_bins(c, 0, 10, 30)) == [bin_]


@pytest.mark.parametrize("spread", [2, 7, 50, 599, 1237])
def test_range_bins_match_pandas(spark, spread):
    edges = [i * spread / 50 for i in range(spread)]
    rng = np.random.default_rng(spread)
    values = sorted({*edges, *[e + 1e-9 for e in edges], *rng.uniform(-5, spread * spread / 50 + 5, 200)})
    expected = pd.cut(pd.Series(values), edges, labels=False)
    got = column(spark, [float(v) for v in values], "double", lambda c: bins.range_bins(c, spread))
    assert [None if pd.isna(e) else int(e) for e in expected] == got


def test_range_bins_without_a_range(spark):
    assert column(spark, [1.0], "double", lambda c: bins.range_bins(c, 1.9)) == [None]
    assert column(spark, [1.0], "double", lambda c: bins.range_bins(c, None)) == [None]


@pytest.mark.parametrize(
    "values", [[1.0], [1.0, 2.0], [1.0, 2.0, 9.0], [1.0, 2.0, 3.0, 10.0], [4.0] * 6, [1.0, 5.0, 2.0, 2.0, 8.5, -3.0]]
)
def test_adjusted_moments_match_pandas(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    x = F.col("x")
    got = df.agg(moments.sample_skewness(x), moments.sample_kurtosis(x), F.stddev_samp(x)).first()
    s = pd.Series(values)
    for mine, theirs in zip(got, (s.skew(), s.kurt(), s.std())):
        assert (mine is None and math.isnan(theirs)) or mine == pytest.approx(theirs)


def test_entropy_bounds(spark):
    rng = np.random.default_rng(5)
    rows = [(g, int(n)) for g in range(20) for n in rng.integers(1, 50, g + 1)]
    got = spark.createDataFrame(rows, "g int, n long").groupBy("g").agg(
        moments.entropy_of_counts(F.col("n")).alias("e"), F.count("n").alias("k")
    )
    for r in got.collect():
        assert 0 <= r["e"] <= math.log(r["k"]) + 1e-12


def test_crosses(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    assert df.select(*crosses.self_cross(["a", "b"], "times")).columns == [
        "a_times_a", "a_times_b", "b_times_a", "b_times_b",
    ]
    assert df.select(*crosses.self_cross(["a", "b"], "minus", unordered=True)).first().asDict() == {
        "a_minus_a": 0.0, "a_minus_b": -1.0, "b_minus_b": 0.0,
    }
    arrays = df.select(F.array("a", "b").alias("v"))
    assert arrays.select(crosses.cross_array(F.col("v"), "plus")).first()[0] == [4, 5, 5, 6]
    assert arrays.select(crosses.scaled_array(F.col("v"), F.lit(2.0))).first()[0] == [4, 6]
