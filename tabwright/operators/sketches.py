"""Approximate medians and distinct counts from stored sketches that merge.

A sketch table has a row per group, and tables over other rows of the same schema merge
with it without the rows. Medians come from KLL sketches, distinct counts from HLL sketches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of a KLL sketch; groups of fewer values have exact medians.
KLL_SIZE = 4096
# Registers of an HLL sketch as a power of two.
HLL_BITS = 14


def rank_error(size: int = KLL_SIZE) -> float:
    """What a KLL median's rank may be off by, as a share of the group, at 99 % confidence."""
    return 2.296 / size**0.9723


def distinct_error(bits: int = HLL_BITS) -> float:
    """Three standard errors of an HLL count, as a share of it."""
    return 3 * 1.04 / 2 ** (bits / 2)


def sketch(
    rows: DataFrame,
    by: Sequence[str],
    medians: Mapping[str, Column] | None = None,
    distincts: Mapping[str, Column] | None = None,
    size: int = KLL_SIZE,
    bits: int = HLL_BITS,
) -> DataFrame:
    """``(*by, <name>_kll ..., <name>_hll ...)`` from one aggregation with partial sketches.

    Missing values and NaN do not take part; rows without a key have no group. Tasks send a sketch
    per group, so a hot group costs no more than another.
    """
    known = reduce(Column.__and__, (F.col(c).isNotNull() for c in by), F.lit(True))
    xs = {f"{name}_x": c.cast("double") for name, c in (medians or {}).items()}
    # Any type is counted by its hash; HLL itself takes whole numbers, strings and bytes only.
    ds = {f"{name}_d": F.when(c.isNotNull(), F.xxhash64(c)) for name, c in (distincts or {}).items()}
    flat = rows.filter(known).select(*by, *[c.alias(n) for n, c in {**xs, **ds}.items()])
    quantiles = [F.expr(f"kll_sketch_agg_double(`{n}_x`, {size})").alias(f"{n}_kll") for n in (medians or {})]
    counts = [F.hll_sketch_agg(f"{n}_d", F.lit(bits)).alias(f"{n}_hll") for n in (distincts or {})]
    return flat.groupBy(*by).agg(*quantiles, *counts)


def merge(tables: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """One sketch table from several, or from one with more keys than ``by``: groups merge, rows are not read."""
    every = reduce(DataFrame.unionByName, tables)
    merged = [F.expr(f"kll_merge_agg_double(`{c}`)").alias(c) for c in every.columns if c.endswith("_kll")]
    merged += [F.hll_union_agg(c).alias(c) for c in every.columns if c.endswith("_hll")]
    return every.groupBy(*by).agg(*merged)


def median_of(sketch_: Column) -> Column:
    """Mean of the two middle values as the sketch knows them; missing if it has none.

    A rank must be a constant, so the upper one is that of a value just above the middle.
    """
    n = F.call_function("kll_sketch_get_n_double", sketch_)
    at = lambda rank: F.call_function("kll_sketch_get_quantile_double", sketch_, F.lit(rank))
    return F.when(n > 0, at(0.5) / 2 + at(0.500001) / 2)


def read(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(*by, <name>_median ..., <name>_nunique ...)`` of a sketch table."""
    kll = [median_of(F.col(c)).alias(f"{c[:-4]}_median") for c in table.columns if c.endswith("_kll")]
    hll = [F.hll_sketch_estimate(c).alias(f"{c[:-4]}_nunique") for c in table.columns if c.endswith("_hll")]
    return table.select(*by, *kll, *hll)


def medians_outside(rows: DataFrame, by: Sequence[str], x: str, fold: str, k: int, size: int = KLL_SIZE) -> DataFrame:
    """``(*by, medians)`` as ``complement.medians_outside``, approximately, from one pass over the rows.

    A sketch per (group, fold) is merged over the other folds: only sketches are repeated.
    """
    by = list(by)
    inside = rows.filter(F.col(fold).between(0, k - 1)).withColumn("_fold", F.col(fold).cast("int"))
    per_fold = sketch(inside, [*by, "_fold"], medians={"_m": F.col(x)}, size=size)
    others = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: f != F.col("_fold"))
    merged = merge([per_fold.withColumn("_held", F.explode(others)).drop("_fold")], [*by, "_held"])
    found = read(merged, [*by, "_held"])
    entry = F.struct("_held", "_m_median")
    per_group = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(entry)).alias("_all"))
    return per_group.select(*by, F.array(*[F.try_element_at("_all", F.lit(f)) for f in range(k)]).alias("medians"))
