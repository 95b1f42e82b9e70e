"""Exact order statistics of groups of any size.

A group's values are never brought together. Each round counts, per group, how
many values fall into equal slices of the bracket known to hold the wanted
position, and keeps the slice that holds it. Brackets shrink by the number of
slices per round; once few values are left in one, they are read off directly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.session import materialize

SLICES = 4096
# A bracket with at most this many values is sorted in place.
SMALL_BRACKET = 100_000
# So many brackets (one or two per wanted position) may be broadcast, a few MB.
FEW_BRACKETS = 100_000


def exact_ranks(
    rows: DataFrame,
    by: Sequence[str],
    x: str,
    positions: Callable[[Column], Column],
    slices: int = SLICES,
    small: int = SMALL_BRACKET,
) -> DataFrame:
    """Values at zero-based positions of each group's rising order of ``x``.

    ``positions`` turns a group's size into the short array of wanted positions;
    those outside the group are dropped. Returns ``(*by, pos, value)``. Whole-number
    ``x`` must span less than 2**63. Missing groups and values do not take part.
    """
    by = list(by)
    kind = rows.schema[x].dataType
    whole = isinstance(kind, T.IntegralType)
    x_col = F.col(x).cast("long" if whole else "double")
    rows = rows.select(*by, x_col.alias("_x"))
    for c in (*by, "_x"):
        rows = rows.filter(F.col(c).isNotNull())
    if not whole:
        return _with_extremes(rows, by, positions, slices, small)
    return _ranked(rows, by, positions(F.col("n")), whole, slices, small)


def _with_extremes(
    rows: DataFrame, by: list[str], positions: Callable[[Column], Column], slices: int, small: int
) -> DataFrame:
    """Infinities and NaN by their counts, as they come first and last; the others by rank.

    NaN comes after Infinity, as in Spark's own order.
    """
    infinite = float("inf")
    x = F.col("_x")
    counts = materialize(
        rows.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(x == -infinite, 1)).alias("least"),
            F.count(F.when(x == infinite, 1)).alias("most"),
            F.count(F.when(F.isnan(x), 1)).alias("nan"),
        ),
        "rank_counts",
    )
    wanted = counts.withColumn("pos", F.explode(F.array_distinct(positions(F.col("n")))))
    wanted = wanted.filter((F.col("pos") >= 0) & (F.col("pos") < F.col("n")))
    last = F.col("n") - F.col("nan") - F.col("most")
    outer = (
        F.when(F.col("pos") < F.col("least"), -infinite)
        .when(F.col("pos") >= F.col("n") - F.col("nan"), float("nan"))
        .when(F.col("pos") >= last, infinite)
    )
    outside = wanted.select(*by, "pos", outer.alias("value")).filter(F.col("value").isNotNull())
    inside = wanted.filter((F.col("pos") >= F.col("least")) & (F.col("pos") < last))
    places = inside.groupBy(*by).agg(F.collect_set(F.col("pos") - F.col("least")).alias("places"), F.first("least").alias("least"))
    finite = rows.filter((x != -infinite) & (x != infinite) & ~F.isnan(x))
    places = materialize(places, "rank_places")
    few = places.count() <= FEW_BRACKETS
    finite = finite.join(F.broadcast(places) if few else places, by)
    ranked = _ranked(finite.select(*by, "_x"), by, None, False, slices, small, places)
    return outside.unionByName(
        ranked.join(places.select(*by, "least"), by).select(*by, (F.col("pos") + F.col("least")).alias("pos"), "value")
    )


def _ranked(
    rows: DataFrame,
    by: list[str],
    positions: Column | None,
    whole: bool,
    slices: int,
    small: int,
    places: DataFrame | None = None,
) -> DataFrame:

    sized = rows.groupBy(*by).agg(
        F.min("_x").alias("low"), F.max("_x").alias("high"), F.count(F.lit(1)).alias("n")
    )
    if places is not None:
        sized, positions = sized.join(places.select(*by, "places"), by), F.col("places")
    state = materialize(
        sized.select(
            *by,
            F.explode(F.array_distinct(positions)).alias("pos"),
            "low",
            "high",
            F.lit(0).cast("long").alias("below"),
            "n",
        ).filter((F.col("pos") >= 0) & (F.col("pos") < F.col("n"))),
        "ranks",
    )
    unsettled = (F.col("low") < F.col("high")) & (F.col("n") > small)
    few = state.count() <= FEW_BRACKETS
    size = F.sum(F.when(unsettled, F.col("n")))
    left = state.agg(size).first()[0]
    while left:
        state = materialize(_narrow(rows, state, by, unsettled, whole, slices, few), "ranks")
        now = state.agg(size).first()[0]
        # Least and greatest value of a bracket fall into different slices.
        if now and now >= left:
            raise RuntimeError("a round of ranking narrowed no bracket")
        left = now
    return _read_off(rows, state, by, few)


def _inside(rows: DataFrame, brackets: DataFrame, by: list[str], few: bool) -> DataFrame:
    """Rows within a bracket of their group; brackets of one group never overlap."""
    return rows.join(F.broadcast(brackets) if few else brackets, by).filter(F.col("_x").between(F.col("low"), F.col("high")))


def _narrow(
    rows: DataFrame,
    state: DataFrame,
    by: list[str],
    unsettled: Column,
    whole: bool,
    slices: int,
    few: bool,
) -> DataFrame:
    brackets = state.filter(unsettled).select(*by, "low", "high", "below").distinct()
    if whole:
        piece = F.expr(f"(_x - low) div ((high - low) div {slices} + 1)")
    else:
        # The span of two doubles can be too large for a double; that of their halves is not.
        x, low, high = F.col("_x"), F.col("low"), F.col("high")
        halves = (x / 2 - low / 2) / (high / 2 - low / 2)
        share = F.when(high - low < float("inf"), (x - low) / (high - low)).otherwise(halves)
        piece = F.least(F.floor(share * slices), F.lit(slices - 1))
    counted = (
        _inside(rows, brackets, by, few)
        .groupBy(*by, "low", "below", piece.alias("piece"))
        .agg(
            F.min("_x").alias("piece_low"),
            F.max("_x").alias("piece_high"),
            F.count(F.lit(1)).alias("piece_n"),
        )
    )
    # At most `slices` rows per bracket reach this window.
    running = W.partitionBy(*by, "low").orderBy("piece")
    counted = counted.withColumn(
        "piece_below", F.col("below") + F.sum("piece_n").over(running) - F.col("piece_n")
    ).drop("below")
    moved = (
        state.filter(unsettled)
        .join(counted, [*by, "low"])
        .filter(F.col("pos").between(F.col("piece_below"), F.col("piece_below") + F.col("piece_n") - 1))
        .select(
            *by,
            "pos",
            F.col("piece_low").alias("low"),
            F.col("piece_high").alias("high"),
            F.col("piece_below").alias("below"),
            F.col("piece_n").alias("n"),
        )
    )
    return state.filter(~unsettled).select(*moved.columns).unionByName(moved)


def _read_off(rows: DataFrame, state: DataFrame, by: list[str], few: bool) -> DataFrame:
    settled = state.filter(F.col("low") == F.col("high")).select(
        *by, "pos", F.col("low").alias("value")
    )
    rest = state.filter(F.col("low") < F.col("high"))
    brackets = rest.select(*by, "low", "high").distinct()
    # Every bracket left here was counted and holds at most SMALL_BRACKET values.
    sorted_values = (
        _inside(rows, brackets, by, few)
        .groupBy(*by, "low")
        .agg(F.sort_array(F.collect_list("_x")).alias("values"))
    )
    read = rest.join(sorted_values, [*by, "low"]).select(
        *by,
        "pos",
        F.element_at("values", (F.col("pos") - F.col("below") + 1).cast("int")).alias("value"),
    )
    return settled.unionByName(read)
