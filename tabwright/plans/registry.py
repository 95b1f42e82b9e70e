"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.sources.tables import LISTING_SQL

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query; without ``sql`` only its rows are checked."""

    def register(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return register


def on_listing(body: str, extra: str = "") -> str:
    """SQL over the listing view; ``extra`` holds further common table expressions."""
    more = f", {extra}" if extra else ""
    return f"with listing as ({LISTING_SQL}){more}\n{body}"


# Sums of doubles differ in their last digits from engine to engine. A value that is
# exactly halfway between two rounded ones could then go either way; the nudge, larger
# than that noise and far below the rounding step, sends such ties up everywhere.
NUDGE = 1.7e-7


def rounded(c: Column, places: int) -> Column:
    return F.round(c.cast("double") + F.lit(NUDGE), places)


def sql_rounded(expr: str, places: int) -> str:
    return f"round(cast({expr} as double) + {NUDGE}, {places})"


def round_columns(df: DataFrame, places: dict[str, int] | int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Round the double columns of a result for comparison."""
    names = [n for n, t in df.dtypes if t == "double" and n not in keep]
    size = places if isinstance(places, dict) else dict.fromkeys(names, places)
    return df.select(*[rounded(F.col(c), size[c]).alias(c) if c in size else F.col(c) for c in df.columns])
