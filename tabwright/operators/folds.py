"""Fold assignment.

A contiguous fold is the stretch of an order between two cut points, so once the
few cut points are known a row's fold is plain arithmetic on its own key: no
shuffle of the rows, no ranking window, and a retried task repeats the answer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.operators.levels import FEW_LEVELS, KeyFacts, measure
from tabwright.operators.lookup import attach
from tabwright.operators.ranks import exact_ranks
from tabwright.session import materialize

ShuffleKey = Callable[[Column, int], Column]


def hash_key(id_col: Column, seed: int) -> Column:
    """Seeded order key; distinct ids get (all but) distinct non-negative longs."""
    return F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed)), 1)


def digest_key(id_col: Column, seed: int) -> Column:
    """Slower key any SQL engine can recompute: the first 15 hex digits of an MD5."""
    digest = F.md5(F.concat(id_col.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _starts(k: int) -> Callable[[Column], Column]:
    """Positions where folds 1 .. k-1 begin; the first ``n % k`` folds have one row more."""
    if k < 2:
        raise ValueError(f"folds need k of at least 2, not {k}")

    def positions(n: Column) -> Column:
        size, extra = F.floor(n / k), n % k
        return F.array(*[size * f + F.least(F.lit(f).cast("long"), extra) for f in range(1, k)])

    return positions


def _cut_points(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """``(*by, cuts)`` with the rising first keys of folds 1 .. k-1 (empty folds have none)."""
    ranks = exact_ranks(rows, by, "order_key", _starts(k))
    return ranks.groupBy(*by).agg(F.sort_array(F.collect_list("value")).alias("cuts"))


def _fold_of(order_key: Column, cuts: list[int]) -> Column:
    """How many cut points the key has reached, 0 .. k-1."""
    return sum(((order_key >= F.lit(c)).cast("int") for c in cuts), F.lit(0))


def _with_folds(df: DataFrame, keys: dict[str, Column], cuts: dict[str, list[int]], where: Column | None) -> DataFrame:
    """Add fold columns; each order key is computed once, in a projection of its own."""
    keyed = df.withColumns({f"_key_{name}": key for name, key in keys.items()})
    assigned = {}
    for name in keys:
        fold = _fold_of(F.col(f"_key_{name}"), cuts[name])
        assigned[name] = fold if where is None else F.when(where, fold)
    return keyed.withColumns(assigned).drop(*[f"_key_{name}" for name in keys])


def contiguous_folds(
    df: DataFrame,
    k: int,
    order_key: Column,
    where: Column | None = None,
    name: str = "fold",
) -> DataFrame:
    """``k`` folds of consecutive rows by ``order_key`` (unique whole numbers).

    Rows outside ``where`` get no fold.
    """
    taken = df if where is None else df.filter(where)
    keys = taken.select(F.lit(0).alias("part"), order_key.alias("order_key"))
    found = _cut_points(keys, ["part"], k).collect()
    return _with_folds(df, {name: order_key}, {name: found[0]["cuts"] if found else []}, where)


def stratified_folds(
    df: DataFrame,
    k: int,
    order_key: Column,
    strata: str,
    where: Column | None = None,
    name: str = "fold",
) -> DataFrame:
    """``k`` folds of consecutive rows within every class of ``strata``."""
    taken = df if where is None else df.filter(where)
    keys = taken.select(strata, order_key.alias("order_key"))
    cuts = materialize(_cut_points(keys, [strata], k), "cuts")
    n_classes = cuts.count()
    # Few classes are broadcast; of many, the hot ones must be known.
    facts = KeyFacts(n_classes, 0) if n_classes < FEW_LEVELS else measure(taken, [strata])[0][strata]
    joined = attach(df, cuts, strata, facts, spread_by=df.columns)
    passed = F.coalesce(F.size(F.filter("cuts", lambda c: c <= order_key)), F.lit(0))
    keep = F.col(strata).isNotNull() if where is None else where & F.col(strata).isNotNull()
    return joined.withColumn(name, F.when(keep, F.greatest(passed, F.lit(0)))).drop("cuts")


def shuffled_folds(
    df: DataFrame,
    k: int,
    id_col: str,
    seed: int,
    where: Column | None = None,
    name: str = "fold",
    key: ShuffleKey = hash_key,
) -> DataFrame:
    """``k`` folds, sizes within one row of each other, in a seeded order of the ids."""
    return contiguous_folds(df, k, key(F.col(id_col), seed), where, name)


def modulo_folds(df: DataFrame, k: int, id_col: str, name: str = "fold") -> DataFrame:
    """Folds from the id alone: nothing to measure, sizes only about equal."""
    return df.withColumn(name, F.pmod(F.col(id_col), F.lit(k)).cast("int"))


def repeated_folds(
    df: DataFrame,
    k: int,
    id_col: str,
    repeats: int,
    seed: int,
    where: Column | None = None,
    prefix: str = "fold",
    key: ShuffleKey = hash_key,
) -> DataFrame:
    """One shuffled fold column per repeat, ``<prefix>_0`` onwards, seeds counting up.

    The cut points of all repeats are found together.
    """
    taken = df if where is None else df.filter(where)
    order_keys = [key(F.col(id_col), seed + r) for r in range(repeats)]
    keys = taken.select(F.posexplode(F.array(*order_keys)).alias("repeat", "order_key"))
    found = {r["repeat"]: r["cuts"] for r in _cut_points(keys, ["repeat"], k).collect()}
    names = [f"{prefix}_{r}" for r in range(repeats)]
    cuts = {name: found.get(r, []) for r, name in enumerate(names)}
    return _with_folds(df, dict(zip(names, order_keys)), cuts, where)


def fold_of(df: DataFrame, fold: str) -> Column:
    """The fold column; a table without one, such as a new table, has no folds."""
    return F.col(fold).cast("int") if fold in df.columns else F.lit(None).cast("int")
