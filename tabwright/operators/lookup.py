"""Left joins from rows to a table with one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.levels import Key, KeyFacts, key_columns, level_of, unused


def attach(
    rows: DataFrame,
    stats: DataFrame,
    key: Key,
    facts: KeyFacts,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add the columns of ``stats`` to ``rows``; keys it does not hold give NULL.

    * A table measured small enough is broadcast and the rows stay where they are.
    * Otherwise the rows are shuffled. Hot levels take their values from a
      broadcast of just those levels, and they and the missing keys are spread
      over the shuffle by a hash of ``spread_by``, so no task receives a hot group.
    """
    on = key_columns(key)
    values = [c for c in stats.columns if c not in on]
    if facts.fits_broadcast(stats):
        return rows.join(F.broadcast(stats), on, "left")

    level = level_of(key)
    is_hot = level.isin(*facts.hot) if facts.hot else F.lit(False)
    loose = level.isNull() | is_hot
    spread_by = list(spread_by or rows.columns)
    spread = unused([*rows.columns, *stats.columns], "_spread")
    keyed = rows.withColumn(spread, F.when(loose, F.xxhash64(*spread_by)).otherwise(F.lit(0)))
    cold = stats.filter(~is_hot).withColumn(spread, F.lit(0).cast("long"))
    joined = keyed.join(cold, [*on, spread], "left").drop(spread)
    if facts.hot:
        hot_names = {v: unused([*rows.columns, *stats.columns], f"_hot_{v}") for v in values}
        hot = stats.filter(is_hot).select(*on, *[F.col(v).alias(h) for v, h in hot_names.items()])
        joined = joined.join(F.broadcast(hot), on, "left").select(
            *rows.columns, *[F.coalesce(F.col(v), F.col(h)).alias(v) for v, h in hot_names.items()]
        )
    return joined.select(*rows.columns, *values)


def lookup_level(
    rows: DataFrame,
    model: DataFrame,
    key: Key,
    facts: KeyFacts,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """``attach`` for a table keyed by the text form of the key (column ``level``)."""
    own = unused([*rows.columns, *model.columns], "_level")
    keyed = rows.withColumn(own, level_of(key))
    return attach(keyed, model.withColumnRenamed("level", own), own, facts, spread_by or rows.columns).drop(own)


def lookup_packed(
    rows: DataFrame,
    model: DataFrame,
    key: Key,
    facts: KeyFacts,
    name: str,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """``lookup_level`` into one struct column ``name``.

    A long chain of lookups then carries one column per key, not one per value, and
    the values are unpacked in a single projection at its end.
    """
    packed = model.select("level", F.struct(*[c for c in model.columns if c != "level"]).alias(name))
    if not facts.fits_broadcast(packed):
        return lookup_level(rows, packed, key, facts, spread_by)
    own = unused(rows.columns, f"_level_{name}")
    keyed = F.broadcast(packed.withColumnRenamed("level", own))
    return rows.join(keyed, level_of(key) == F.col(own), "left")


def by_level(stats: DataFrame, key: Key) -> DataFrame:
    """Re-key a one-row-per-key table by the text form of its key."""
    values = [c for c in stats.columns if c not in key_columns(key)]
    return stats.select(level_of(key).alias("level"), *values)


def side_by_side(first: DataFrame, others: Sequence[DataFrame], on: Sequence[str] = ("level",)) -> DataFrame:
    """Level tables joined so that rows look each key up once.

    ``first`` must hold every level, as the level counts do. The joins run over
    levels, not rows.
    """
    return reduce(lambda a, b: a.join(b, list(on), "left"), others, first)
