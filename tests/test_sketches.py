"""Sketches against exact answers and their stated errors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators import complement, sketches
from tabwright.operators.target import FoldTargetEncoder


def test_million_rows_stay_within_the_stated_errors(spark):
    """A group of a million rows: the median's rank and the distinct count, before and after a merge."""
    rows = spark.range(1_000_000).select(
        (F.col("id") % 2).alias("half"), F.pow(F.rand(3) * 10, F.lit(5.0)).alias("x"), (F.xxhash64("id") % 250_000).alias("d"), F.lit("a").alias("g")
    )
    rows = rows.persist()
    exact = rows.agg(F.countDistinct("d")).first()[0]
    tables = [sketches.sketch(rows.filter(F.col("half") == h), ["g"], {"x": F.col("x")}, {"d": F.col("d")}) for h in (0, 1)]
    for table in (sketches.sketch(rows, ["g"], {"x": F.col("x")}, {"d": F.col("d")}), sketches.merge(tables, ["g"])):
        (got,) = sketches.read(table, ["g"]).collect()
        rank = rows.filter(F.col("x") <= got.x_median).count() / 1e6
        assert abs(rank - 0.5) <= sketches.rank_error()
        assert abs(got.d_nunique - exact) <= sketches.distinct_error() * exact
    rows.unpersist()


def test_small_groups_are_exact_and_gaps_do_not_count(spark):
    rows = [("a", 1.0, "p"), ("a", 4.0, "q"), ("a", None, None), ("b", 2.0, "p"), ("b", 9.0, "p"), ("b", 3.0, "r"), ("c", None, None), (None, 1.0, "p"), ("d", float("inf"), "p"), ("d", float("nan"), "")]
    df = spark.createDataFrame(rows, "g string, x double, s string")
    table = sketches.sketch(df, ["g"], {"x": F.col("x")}, {"s": F.col("s")})
    got = {r.g: (r.x_median, r.s_nunique) for r in sketches.read(table, ["g"]).collect()}
    assert got == {"a": (2.5, 2), "b": (3.0, 2), "c": (None, 0), "d": (float("inf"), 2)}
    whole = sketches.read(sketches.merge([table.withColumn("one", F.lit(1))], ["one"]), ["one"]).first()
    assert whole.s_nunique == 4
    assert sketches.sketch(df.limit(0), ["g"], {"x": F.col("x")}).count() == 0


@pytest.mark.parametrize("size", [4096, 64])
def test_medians_outside_each_fold(spark, size):
    rng = np.random.default_rng(4)
    rows = [(str(i % 3), float(v), int(f)) for i, (v, f) in enumerate(zip(rng.normal(size=3000), rng.integers(0, 4, 3000)))]
    df = spark.createDataFrame(rows + [("own", 1.0, 2), ("none", None, 1)], "g string, x double, f int")
    got = {r.g: r.medians for r in sketches.medians_outside(df, ["g"], "x", "f", 4, size).collect()}
    exact = {r.g: r.medians for r in complement.medians_outside(df, ["g"], "x", "f", 4).collect()}
    assert got["own"] == exact["own"] == [1.0, 1.0, None, 1.0]
    for g in "012":
        for f in range(4):
            others = np.sort([v for h, v, own in rows if h == g and own != f])
            if size > len(others):
                assert got[g][f] == exact[g][f] == np.median(others)
            assert abs(np.searchsorted(others, got[g][f]) / len(others) - 0.5) <= 2 * sketches.rank_error(size)


def test_encoder_with_sketches(spark):
    rows = [(i, i % 5, float((i * 37) % 101), i % 3 if i < 90 else None) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, c int, y double, fold int")
    out = [FoldTargetEncoder(["c"], "y", 3, stats=["median"], approx=a).fit(df).transform(df).select("id", "c_target_median") for a in (False, True)]
    assert out[0].exceptAll(out[1]).count() == 0
