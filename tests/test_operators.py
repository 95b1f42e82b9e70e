"""Operators against brute force, on skewed data and with limits forced low."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.operators import clean, folds, frequency, levels, lookup, profile, ranks, target
from tabwright.session import materialize, scratch_dir


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows under one key, another part without a key, many rare keys."""
    rng = np.random.default_rng(11)
    n = 3000
    key = np.where(rng.random(n) < 0.35, 7, rng.integers(100, 900, n)).astype(float)
    key[rng.random(n) < 0.1] = np.nan
    y = np.round(rng.gamma(2.0, 900.0, n), 2)
    y[rng.random(n) < 0.02] = 0.0
    return pd.DataFrame(
        {"id": np.arange(n), "key": key, "cat": rng.choice(list("abcde"), n), "y": y, "x": rng.normal(size=n)}
    )


def to_spark(spark, pdf, schema):
    rows = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame([tuple(v.item() if hasattr(v, "item") else v for v in r) for r in rows], schema)


@pytest.fixture(scope="module")
def rows(spark, skewed):
    return materialize(to_spark(spark, skewed, "id long, key double, cat string, y double, x double"), "skewed")


def frame(df, index="id"):
    return df.toPandas().set_index(index).sort_index()


def limit(monkeypatch, cells):
    """With no cells allowed, every lookup takes the shuffled way."""
    monkeypatch.setattr(levels, "BROADCAST_CELLS", cells)
    if not cells:
        monkeypatch.setattr(levels, "FEW_LEVELS", 0)


# Lookups.


@pytest.mark.parametrize("broadcast_cells", [levels.BROADCAST_CELLS, 0])
def test_lookup_same_with_and_without_broadcast(rows, skewed, monkeypatch, broadcast_cells):
    limit(monkeypatch, broadcast_cells)
    monkeypatch.setattr(levels, "HOT_SHARE", 0.2)
    out = frequency.count_encode(rows, ["key", ("cat", "key")], spread_by=["id"])
    got = frame(out)
    assert len(got) == len(skewed)
    expected = skewed.key.map(skewed.key.value_counts())
    pd.testing.assert_series_equal(got.key_count, expected, check_names=False, check_index_type=False)
    pairs = skewed.groupby(["cat", "key"])["id"].transform("count").where(skewed.key.notna())
    pd.testing.assert_series_equal(got.cat_key_count.astype(float), pairs, check_names=False, check_index_type=False)


def test_hot_and_missing_keys_are_spread(rows, monkeypatch):
    limit(monkeypatch, 0)
    monkeypatch.setattr(levels, "HOT_SHARE", 0.2)
    facts, counts = levels.measure(rows, ["key"])
    assert facts["key"].hot == ("7.0",)
    out = lookup.lookup_level(rows, counts.select("level", "n"), "key", facts["key"], ["id"])
    plan = out._jdf.queryExecution().toString()
    assert "_spread" in plan and "xxhash64" in plan


def test_packed_lookup_equals_plain(rows, monkeypatch):
    facts, counts = levels.measure(rows, ["key"])
    model = counts.select("level", "n", (F.col("n") * 2).alias("m"))
    plain = frame(lookup.lookup_level(rows, model, "key", facts["key"]).select("id", "n", "m"))
    for cells in (levels.BROADCAST_CELLS, 0):
        limit(monkeypatch, cells)
        packed = lookup.lookup_packed(rows, model, "key", facts["key"], "at_key", ["id"])
        pd.testing.assert_frame_equal(frame(packed.select("id", "at_key.*")), plain)


# Order statistics and folds.


@pytest.mark.parametrize("slices, small", [(4096, 100_000), (4, 1), (7, 20)])
def test_exact_ranks(rows, skewed, slices, small):
    got = ranks.exact_ranks(
        rows, ["cat"], "y", lambda n: F.array(F.lit(0), F.floor(n / 3), n - 1, n + 5), slices, small
    ).collect()
    expected = {}
    for cat, g in skewed.groupby("cat"):
        v = np.sort(g.y.values)
        for p in {0, len(v) // 3, len(v) - 1}:
            expected[cat, p] = v[p]
    assert {(r["cat"], r["pos"]): r["value"] for r in got} == expected


@pytest.mark.parametrize("small", [1, 10])
def test_exact_ranks_with_values_that_are_no_numbers(spark, small):
    inf, nan = float("inf"), float("nan")
    groups = {
        0: [inf, -inf, nan, 1.5, 2.5, -3.0] * 7,
        1: [1e308, -1e308, 5e-324, 0.0, -0.0, 1.0] * 5,
        2: [nan] * 4 + [inf] * 3,
        3: [*range(100), inf],
    }
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g int, v double")
    got = ranks.exact_ranks(df, ["g"], "v", lambda n: F.sequence(F.lit(0), n - 1), 3, small).collect()
    for g, vs in groups.items():
        # NaN is the largest, as in Spark's order.
        want = sorted(map(float, vs), key=lambda v: (np.isnan(v), 0 if np.isnan(v) else v))
        mine = [r["value"] for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["pos"])]
        np.testing.assert_array_equal(mine, want)
    built_in = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    ours = profile.profile(df, "g", {"v": F.col("v")}, ["median"], median_rows=5)
    for r in ours.collect():
        np.testing.assert_equal(r["g_v_median"], built_in[r["g"]])


def test_exact_ranks_of_whole_numbers_with_ties(spark):
    values = [5] * 50 + [9] * 3 + list(range(-20, 0))
    df = spark.createDataFrame([(0, v) for v in values], "g int, v long")
    got = ranks.exact_ranks(df, ["g"], "v", lambda n: F.sequence(F.lit(0), n - 1), 3, 1).collect()
    assert [r["value"] for r in sorted(got, key=lambda r: r["pos"])] == sorted(values)


@pytest.mark.parametrize("n, k", [(11, 4), (100, 10), (103, 10), (3, 5), (1, 2)])
def test_contiguous_folds(spark, n, k):
    ids = [3 * i - 7 for i in range(n)]
    df = spark.createDataFrame([(i,) for i in reversed(ids)], "id long")
    got = frame(folds.contiguous_folds(df, k, F.col("id"))).fold.tolist()
    expected = [f for f, part in enumerate(np.array_split(np.arange(n), k)) for _ in part]
    assert got == expected


def test_fold_columns_need_no_shuffle(rows):
    out = folds.contiguous_folds(rows, 5, F.col("id"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan


def test_stratified_folds(rows, skewed):
    got = frame(folds.stratified_folds(rows, 4, F.col("id"), "cat"))
    for _, g in got.groupby("cat"):
        sizes = g.fold.value_counts()
        assert sizes.max() - sizes.min() <= 1 and g.fold.is_monotonic_increasing


def test_stratified_folds_with_fewer_rows_than_folds(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "id long, c string")
    got = frame(folds.stratified_folds(df, 5, F.col("id"), "c")).fold
    assert got.iloc[:3].tolist() == [0, 0, 1] and math.isnan(got.iloc[3])


def test_shuffled_folds_repeat_and_balance(rows):
    a = frame(folds.shuffled_folds(rows.select("id"), 7, "id", 42)).fold
    b = frame(folds.shuffled_folds(rows.select("id").repartition(5), 7, "id", 42)).fold
    c = frame(folds.shuffled_folds(rows.select("id"), 7, "id", 43)).fold
    assert a.equals(b) and not a.equals(c)
    assert a.value_counts().max() - a.value_counts().min() <= 1
    assert not a.is_monotonic_increasing


def test_repeated_folds_equal_single_ones(rows):
    ids = rows.select("id")
    both = frame(folds.repeated_folds(ids, 10, "id", 2, 2018))
    for r in range(2):
        single = frame(folds.shuffled_folds(ids, 10, "id", 2018 + r)).fold
        assert both[f"fold_{r}"].equals(single)


def test_rows_outside_where_get_no_fold(rows):
    got = frame(folds.contiguous_folds(rows.select("id"), 3, F.col("id"), where=F.col("id") % 2 == 0))
    assert got.fold.isna().sum() == 1500 and got.fold.notna().sum() == 1500


# Profiles.


@pytest.mark.parametrize("median_rows", [profile.MEDIAN_ROWS, 50, 0])
def test_profile(rows, skewed, median_rows):
    y = F.col("y")
    out = profile.profile(rows, "key", {"y": y}, profile.PRICE_STATS, where={"y": y > 0}, median_rows=median_rows)
    got = frame(out, "key")
    kept = skewed[skewed.key.notna()].assign(y=lambda d: d.y.where(d.y > 0))
    g = kept.groupby("key").y
    expected = pd.DataFrame(
        {
            "amount": g.count(), "max": g.max(), "median": g.median(), "min": g.min(), "sum": g.sum(),
            "std": g.std(), "mean": g.mean(), "skew": g.skew(), "kurt": g.apply(pd.Series.kurt),
            "mad": g.apply(lambda v: (v - v.mean()).abs().mean()),
        }
    )
    expected.columns = [f"key_y_{c}" for c in expected]
    pd.testing.assert_frame_equal(got, expected, check_dtype=False, check_index_type=False, rtol=1e-9)


def test_profile_keeps_empty_groups(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", -1.0), (None, 3.0)], "k string, v double")
    v = F.col("v")
    got = {r["k"]: r for r in profile.profile(df, "k", {"v": v}, profile.PRICE_STATS, where={"v": v > 0}).collect()}
    assert set(got) == {"a", "b"}
    assert got["b"]["k_v_amount"] == 0 and got["b"]["k_v_sum"] == 0
    assert all(got["b"][f"k_v_{s}"] is None for s in ("max", "median", "min", "std", "mean", "skew", "kurt", "mad"))


def test_unselected_profiles_are_not_computed(rows):
    out = profile.attach_profile(rows, rows, "cat", {"y": F.col("y")}, profile.PRICE_STATS)
    plan = out.select("id", "x")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_profile_shuffles_once_per_key(rows):
    facts = levels.KeyFacts(5, 3000)
    out = profile.profile(rows, "cat", {"y": F.col("y"), "x": F.col("x")}, ("max", "min", "std", "median"), facts)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


# Pairs.


def test_pair_features(rows, skewed):
    singles = frequency.count_encode(rows, ["key", "cat"], ["id"])
    got = frame(frequency.attach_pair_features(singles, [("key", "cat")], spread_by=["id"]))
    assert len(got) == len(skewed)
    d = skewed.dropna(subset=["key"])
    ent = d.groupby("key").cat.apply(lambda v: -(v.value_counts(normalize=True) * np.log(v.value_counts(normalize=True))).sum())
    np.testing.assert_allclose(got.loc[d.id, "key_cat_ent"], d.key.map(ent), atol=1e-12)
    np.testing.assert_array_equal(got.loc[d.id, "cat_key_nunique"], d.cat.map(d.groupby("cat").key.nunique()))
    assert got.key_cat_count.isna().sum() == skewed.key.isna().sum()


def test_pair_shares_add_up(rows):
    shares = frequency.pair_shares(frequency.pair_counts(rows, "key", "cat"), "key", "cat")
    for key, share in (("cat", "key_in_cat_prop"), ("key", "cat_in_key_prop")):
        sums = [r[0] for r in shares.groupBy(key).agg(F.sum(share)).select(f"sum({share})").collect()]
        assert sums == pytest.approx([1.0] * len(sums))


# Encoders.


def folded(rows, k=5):
    return folds.contiguous_folds(rows, k, F.col("id"), where=F.col("id") % 4 != 0)


def brute_mean(pdf, col, k, weight):
    lab, test = pdf[pdf.fold.notna()], pdf[pdf.fold.isna()]
    out, acc = pd.Series(np.nan, pdf.index), pd.Series(0.0, test.index)
    for f in range(k):
        other = lab[lab.fold != f]
        prior = other.y.mean()
        g = other.groupby(col).y.agg(["mean", "size"])
        w = weight(g["size"])
        enc = w * prior + (1 - w) * g["mean"]
        held = lab[lab.fold == f]
        out[held.index] = held[col].map(enc).fillna(prior)
        acc += test[col].map(enc).fillna(prior) / k
    out[test.index] = acc
    return out


@pytest.mark.parametrize("cells", [levels.BROADCAST_CELLS, 0])
def test_mean_encoder(rows, monkeypatch, cells):
    limit(monkeypatch, cells)
    data = folded(rows)
    model = target.SmoothedMeanEncoder(["key", "cat"], "y", 5).fit(data)
    got = frame(model.transform(data))
    for c in ("key", "cat"):
        expected = brute_mean(got, c, 5, lambda n: 1 / (1 + np.exp(n - 2.0)))
        np.testing.assert_allclose(got[f"{c}_pred"], expected, rtol=1e-9)


def test_mean_encoder_saved_and_loaded(spark, rows, tmp_path):
    data = folded(rows)
    model = target.SmoothedMeanEncoder(["cat"], "y", 5, weight=lambda n: F.lit(1.0) / (F.lit(1.0) + n)).fit(data)
    model.save(str(tmp_path / "m"))
    again = target.MeanEncoding.load(spark, str(tmp_path / "m"))
    a, b = frame(model.transform(data)), frame(again.transform(data))
    pd.testing.assert_frame_equal(a, b)
    np.testing.assert_allclose(a.cat_pred, brute_mean(a, "cat", 5, lambda n: 1 / (1 + n)), rtol=1e-9)


def test_mean_encoder_unseen_level(spark, rows):
    model = target.SmoothedMeanEncoder(["cat"], "y", 5).fit(folded(rows))
    new = spark.createDataFrame([(1, "zzz", None), (2, None, None)], "id long, cat string, fold int")
    got = [r["cat_pred"] for r in model.transform(new).collect()]
    assert got == pytest.approx([float(np.mean(model.priors["pred"]))] * 2)


def test_target_encoder(rows):
    data = folded(rows)
    stats = ["max", "min", "mean", "std", "sum", "median"]
    model = target.FoldTargetEncoder(["key", "cat"], "y", 5, stats=stats).fit(data)
    got = frame(model.transform(data))
    lab, test = got[got.fold.notna()], got[got.fold.isna()]
    for c in ("key", "cat"):
        for s in stats:
            default, acc = getattr(lab.y, s)(), pd.Series(0.0, test.index)
            for f in range(5):
                enc = lab[lab.fold != f].groupby(c).y.agg(s)
                held = lab[lab.fold == f]
                np.testing.assert_allclose(held[f"{c}_target_{s}"], held[c].map(enc).fillna(default), rtol=1e-8, atol=1e-6)
                acc += test[c].map(enc).fillna(default) / 5
            np.testing.assert_allclose(test[f"{c}_target_{s}"], acc, rtol=1e-8, atol=1e-6)


def test_target_encoding_saved_and_loaded(spark, rows, tmp_path):
    data = folded(rows)
    model = target.FoldTargetEncoder(["cat"], "y", 5).fit(data)
    model.save(str(tmp_path / "t"))
    again = target.TargetEncoding.load(spark, str(tmp_path / "t"))
    cols = ["id", "cat_target_max", "cat_target_min", "cat_target_mean"]
    a, b = frame(model.transform(data).select(cols)), frame(again.transform(data).select(cols))
    pd.testing.assert_frame_equal(a, b[a.columns])


def test_level_in_one_fold_only(spark):
    rows = [(i, "solo" if i < 2 else "rest", float(i), 0 if i < 4 else 1) for i in range(8)]
    data = spark.createDataFrame(rows, "id long, c string, y double, fold int")
    got = frame(target.SmoothedMeanEncoder(["c"], "y", 2).fit(data).transform(data))
    assert got.c_pred[0] == pytest.approx(5.5)
    got = frame(target.FoldTargetEncoder(["c"], "y", 2).fit(data).transform(data))
    assert (got.c_target_max[0], got.c_target_min[0], got.c_target_mean[0]) == (7, 0, 3.5)


# Cleaning.


def test_impute_mode_takes_the_lowest_on_ties(spark):
    df = spark.createDataFrame(
        [(1, 10, "b", None), (2, 9, "a", None), (3, 10, None, None), (4, 9, "a", None), (5, None, "b", None)],
        "id int, n int, s string, void double",
    )
    got = frame(clean.impute_mode(df, exclude=["id"]))
    assert got.n.tolist() == [10, 9, 10, 9, 9] and got.s.tolist() == ["b", "a", "a", "a", "b"]
    assert got.void.isna().all()


def test_narrow_types_are_strict_at_the_limits(spark):
    df = spark.createDataFrame([(126, 127, -128, 40000, 2**40, 1.5, "s"), (0, 0, 0, 0, 0, 0.0, "t")],
                               "a long, b long, c long, d long, e long, f double, g string")
    narrowed, report = clean.narrow_types(df)
    assert dict(narrowed.dtypes) == {
        "a": "tinyint", "b": "smallint", "c": "smallint", "d": "int", "e": "bigint", "f": "float", "g": "string",
    }
    assert ("a", "bigint", "tinyint") in report
    assert narrowed.collect()[0]["e"] == 2**40


def test_union_and_split(spark):
    a = spark.createDataFrame([(1, 2.0)], "id int, price double")
    b = spark.createDataFrame([(5,)], "id int")
    labelled, unlabelled = clean.split_labelled(clean.union_labelled(a, b))
    assert [tuple(r) for r in labelled.collect()] == [(1, 2.0)]
    assert [tuple(r) for r in unlabelled.collect()] == [(5, None)]


def test_drop_rows_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "seller int")
    assert [r[0] for r in clean.drop_rows(df, F.col("seller") == 1).collect()] == [None, 2]


def test_scratch_dir_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert scratch_dir(spark) == configured


@pytest.mark.parametrize("estimator", [target.SmoothedMeanEncoder, target.FoldTargetEncoder])
def test_encoders_with_clashing_names_and_on_new_tables(spark, estimator):
    """Features and other columns may be called as the encoder's own; a new table has no folds."""
    rows = [(i, "ab"[i % 2], "xyz"[i % 3], f"k{i}", float(i), i % 4) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, y string, fold string, level string, price double, part int")
    model = estimator(["y", "fold"], "price", 4, fold="part").fit(df)
    out = model.transform(df)
    assert out.columns[: len(df.columns)] == df.columns
    assert {r["level"] for r in out.collect()} == {r[3] for r in rows}
    new = model.transform(df.drop("part"))
    same = model.transform(df.withColumn("part", F.lit(None).cast("int"))).drop("part")
    assert new.exceptAll(same).count() == 0
    plain = df.withColumnsRenamed({"y": "f1", "fold": "f2"})
    other = estimator(["f1", "f2"], "price", 4, fold="part").fit(plain).transform(plain)
    assert out.toDF(*other.columns).exceptAll(other).count() == 0


def test_count_encode_keeps_a_column_called_level(spark):
    df = spark.createDataFrame([("a", 1, 7), ("a", 2, 8), (None, 3, 9)], "k string, level int, _spread int")
    got = sorted(map(tuple, frequency.count_encode(df, ["k"]).collect()), key=lambda r: r[1])
    assert got == [("a", 1, 7, 2), ("a", 2, 8, 2), (None, 3, 9, None)]


def test_scratch_tables_can_be_cleared(spark, monkeypatch):
    from tabwright import session

    monkeypatch.setattr(session, "_WRITTEN", [])
    kept = materialize(spark.range(5).toDF("id"), "kept")
    path = kept.inputFiles()[0]
    assert session.clear_scratch(spark) == 1 and session.clear_scratch(spark) == 0
    with pytest.raises(Exception):
        spark.read.parquet(path.rsplit("/", 1)[0]).count()
