"""Group statistics, fused to one aggregation per key, and joined back to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.moments import SIMPLE_STATS
from tabwright.operators.levels import Key, KeyFacts, key_columns, key_name, measure, unused
from tabwright.operators.lookup import attach
from tabwright.operators.ranks import exact_ranks
from tabwright.session import materialize

PRICE_STATS = ("amount", "max", "median", "min", "sum", "std", "mean", "skew", "kurt", "mad")
RANGE_STATS = ("max", "min", "std", "mean", "median", "sum")

# Largest group whose median is taken by Spark's own aggregate, which keeps every
# distinct value of a group in one task; larger groups are ranked in a distributed way.
MEDIAN_ROWS = 250_000


def stat_name(key: Key, x: str, stat: str) -> str:
    return f"{key_name(key)}_{x}_{stat}"


def profile(
    rows: DataFrame,
    key: Key,
    xs: Mapping[str, Column],
    stats: Sequence[str] | Mapping[str, Sequence[str]],
    facts: KeyFacts | None = None,
    where: Mapping[str, Column] | None = None,
    median_rows: int = MEDIAN_ROWS,
) -> DataFrame:
    """One row per level of ``key`` with ``<key>_<x>_<stat>`` for every statistic.

    ``where`` limits the values of an ``x``, not the groups: a level none of whose
    rows qualify stays, with amount and sum 0 and the rest missing.
    """
    where = where or {}
    on = key_columns(key)
    wanted = {x: list(stats[x] if isinstance(stats, Mapping) else stats) for x in xs}
    values = [(F.when(where[x], c) if x in where else c).alias(x) for x, c in xs.items()]
    # Plain null tests, unlike dropna, are pushed into the scan.
    known = reduce(Column.__and__, (F.col(c).isNotNull() for c in on))
    base = rows.select(*on, *values).filter(known)
    if facts is None and any({"median", "mad"} & set(s) for s in wanted.values()):
        facts = measure(base, [key])[0][key_name(key)]

    simple = [
        SIMPLE_STATS[s](F.col(x)).alias(stat_name(key, x, s))
        for x, names in wanted.items()
        for s in names
        if s in SIMPLE_STATS
    ]
    medians = [x for x, names in wanted.items() if "median" in names]
    mads = [x for x, names in wanted.items() if "mad" in names]
    built_in = bool(medians) and facts.largest <= median_rows
    if built_in:
        simple += [F.median(x).alias(stat_name(key, x, "median")) for x in medians]
    out = base.groupBy(*on).agg(*simple) if simple else base.select(*on).distinct()
    if medians and not built_in:
        out = out.join(_large_medians(base, key, medians, median_rows), on, "left")
    if mads:
        out = out.join(_mean_deviations(base, key, mads, facts), on, "left")
    ordered = [stat_name(key, x, s) for x, names in wanted.items() for s in names]
    return out.select(*on, *ordered)


def _mean_deviations(base: DataFrame, key: Key, xs: Sequence[str], facts: KeyFacts) -> DataFrame:
    """Mean absolute deviation around the group mean: needs the means first."""
    on = key_columns(key)
    means = base.groupBy(*on).agg(*[F.avg(x).alias(f"_mean_{x}") for x in xs])
    # A number of its own for every row, so that equal rows of a hot level are spread too.
    row = unused([*on, *xs], "_row")
    joined = attach(base.select(*on, *xs, F.monotonically_increasing_id().alias(row)), means, key, facts, [row])
    return joined.groupBy(*on).agg(
        *[F.avg(F.abs(F.col(x) - F.col(f"_mean_{x}"))).alias(stat_name(key, x, "mad")) for x in xs]
    )


def _large_medians(base: DataFrame, key: Key, xs: Sequence[str], median_rows: int) -> DataFrame:
    """Medians where some groups are too large for one task.

    The levels above ``median_rows`` are few (rows / median_rows at most); only
    they are ranked by rounds of counting, all others keep the built-in aggregate.
    """
    on = key_columns(key)
    counts = base.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    large = materialize(counts.filter(F.col("_n") > median_rows).select(*on), "large")
    flag = large.withColumn("_large", F.lit(True))
    flagged = attach(base, flag, key, KeyFacts(large.count(), 0))
    rest = flagged.filter(F.col("_large").isNull())
    out = rest.groupBy(*on).agg(*[F.median(x).alias(stat_name(key, x, "median")) for x in xs])

    cells = [F.struct(F.lit(x).alias("x"), F.col(x).cast("double").alias("value")) for x in xs]
    ranked = (
        flagged.filter(F.col("_large"))
        .select(*on, F.explode(F.array(*cells)).alias("cell"))
        .select(*on, "cell.x", "cell.value")
    )
    middles = exact_ranks(
        ranked, [*on, "x"], "value", lambda n: F.array(F.floor((n - 1) / 2), F.floor(n / 2))
    )
    large_out = middles.groupBy(*on).agg(
        *[
            F.avg(F.when(F.col("x") == x, F.col("value"))).alias(stat_name(key, x, "median"))
            for x in xs
        ]
    )
    # A large level whose values are all missing has no ranks but still belongs here.
    large_out = large.join(large_out, on, "left").select(*out.columns)
    return out.unionByName(large_out)


def attach_profile(
    rows: DataFrame,
    fitted_on: DataFrame,
    key: Key,
    xs: Mapping[str, Column],
    stats: Sequence[str] | Mapping[str, Sequence[str]],
    facts: KeyFacts | None = None,
    where: Mapping[str, Column] | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Describe the levels of ``key`` on ``fitted_on`` and join that to ``rows``."""
    facts = facts or measure(fitted_on, [key])[0][key_name(key)]
    return attach(rows, profile(fitted_on, key, xs, stats, facts, where), key, facts, spread_by)


def global_profile(rows: DataFrame, x: str, stats: Sequence[str]) -> DataFrame:
    """The same statistics over all rows, as one row ``<x>_<stat>``."""
    one_group = rows.select(F.lit(0).alias("all"), x)
    out = profile(one_group, "all", {x: F.col(x)}, stats)
    return out.select(*[F.col(stat_name("all", x, s)).alias(f"{x}_{s}") for s in stats])
