"""Level counts, and what they say about a key's size and skew."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.session import materialize

Key = str | tuple[str, ...]

# A level holding this share of the rows is hot; there can be at most 1 / share of them.
HOT_SHARE = 0.001
# Cells (levels x values) a table may hold and still be broadcast, some 64 MB in memory.
BROADCAST_CELLS = 4_000_000
# Most cells that all broadcast tables of one plan hold together.
PLAN_CELLS = 4_000_000
# An array in a looked-up table holds one value per fold; count it as this many cells.
ARRAY_CELLS = 16
# Keys with fewer levels than this are broadcast unless a plan has no room, so their hot levels are not measured at first.
FEW_LEVELS = 4_000


def unused(columns: Sequence[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def key_columns(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def key_name(key: Key) -> str:
    return "_".join(key_columns(key))


def level_of(key: Key) -> Column:
    """The key as text; NULL as soon as one part is missing."""
    parts = [F.col(c).cast("string") for c in key_columns(key)]
    if len(parts) == 1:
        return parts[0]
    spaced = [p for part in parts for p in (F.lit("\u0001"), part)][1:]
    return F.concat(*spaced)


def unpivot_levels(df: DataFrame, keys: Sequence[Key], carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row and key: ``(feature, level, *carry)``, missing levels left out.

    All keys share a single scan and, downstream, a single shuffle.
    """
    pairs = [
        F.struct(F.lit(key_name(k)).alias("feature"), level_of(k).alias("level")) for k in keys
    ]
    return (
        df.select(F.explode(F.array(*pairs)).alias("pair"), *carry)
        .select("pair.feature", "pair.level", *carry)
        .filter(F.col("level").isNotNull())
    )


def level_counts(df: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """``(feature, level, n)`` for every key; partial counts keep hot levels cheap."""
    return unpivot_levels(df, keys).groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class KeyFacts:
    """Measured size of one key: distinct levels, largest level and the hot ones."""

    n_levels: int
    largest: int
    hot: tuple[str, ...] = ()
    # False if the plan's budget for broadcasts has no room for it (``within_budget``).
    may_broadcast: bool = True

    def fits_broadcast(self, stats: DataFrame) -> bool:
        if not self.may_broadcast:
            return False
        cells = self.n_levels * cells_per_row(stats.schema)
        return self.n_levels < FEW_LEVELS or cells <= BROADCAST_CELLS


def cells_per_row(kind: T.DataType) -> int:
    if isinstance(kind, T.StructType):
        return sum(cells_per_row(f.dataType) for f in kind)
    return ARRAY_CELLS if isinstance(kind, T.ArrayType) else 1


def within_budget(facts: dict[str, KeyFacts], tables: dict[str, DataFrame], counts: DataFrame, budget: int | None = None) -> dict[str, KeyFacts]:
    """Facts of all lookups of one plan, of which those may broadcast that fit into one budget together.

    ``tables`` has the table that each key is looked up in. The smallest come first, so that as many as
    possible leave the rows where they are. For the others hot levels are measured
    however few levels there are, as their rows will be shuffled.
    """
    left = PLAN_CELLS if budget is None else budget
    size = {name: facts[name].n_levels * cells_per_row(table.schema) for name, table in tables.items()}
    out, refused = dict(facts), []
    for name in sorted(tables, key=lambda n: (size[n], n)):
        if size[name] <= left and facts[name].fits_broadcast(tables[name]):
            left -= size[name]
        else:
            refused.append(name)
    if refused:
        measured = facts_of(counts.filter(F.col("feature").isin(refused)), few=0)
        for name in refused:
            out[name] = replace(measured.get(name, facts[name]), may_broadcast=False)
    return out


def facts_of(counts: DataFrame, hot_share: float | None = None, few: int | None = None) -> dict[str, KeyFacts]:
    """Facts per feature from a ``(feature, level, n)`` table; features of fewer than ``few`` levels have no hot ones."""
    few = FEW_LEVELS if few is None else few
    share = HOT_SHARE if hot_share is None else hot_share
    sizes = (
        counts.groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n_levels"), F.max("n").alias("largest"), F.sum("n").alias("rows"))
        .collect()
    )
    floors = {
        r["feature"]: r["rows"] * share
        for r in sizes
        if r["n_levels"] >= few and r["largest"] >= r["rows"] * share
    }
    hot: dict[str, list[str]] = {}
    if floors:
        is_hot = F.lit(False)
        for feature, floor in floors.items():
            is_hot = is_hot | ((F.col("feature") == feature) & (F.col("n") >= floor))
        # At most 1 / share levels per feature can pass.
        for r in counts.filter(is_hot).select("feature", "level").collect():
            hot.setdefault(r["feature"], []).append(r["level"])
    return {
        r["feature"]: KeyFacts(r["n_levels"], r["largest"], tuple(sorted(hot.get(r["feature"], ()))))
        for r in sizes
    }


def measure(df: DataFrame, keys: Sequence[Key]) -> tuple[dict[str, KeyFacts], DataFrame]:
    """Count all levels of ``keys`` in one pass; returns the facts and the stored counts."""
    counts = materialize(level_counts(df, keys), "levels")
    facts = facts_of(counts)
    for k in keys:
        facts.setdefault(key_name(k), KeyFacts(0, 0))
    return facts, counts
