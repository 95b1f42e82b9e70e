"""Generated column crosses. Each returns named expressions for one ``select``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SIGNS = {"plus": "+", "minus": "-", "times": "*"}

OPS: dict[str, Callable[[Column, Column], Column]] = {
    "plus": lambda a, b: a + b,
    "minus": lambda a, b: a - b,
    "times": lambda a, b: a * b,
}


def cross_name(a: str, op: str, b: str) -> str:
    return f"{a}_{op}_{b}"


def cross_columns(
    left: Sequence[str],
    right: Sequence[str],
    op: str,
    keep: Callable[[str, str], bool] = lambda a, b: True,
) -> list[Column]:
    """Every ``left`` by every ``right`` column, in order, where ``keep`` allows it.

    SQL text makes one driver call per cross; hundreds of them add up otherwise.
    """
    sign = SIGNS[op]
    return [
        F.expr(f"`{a}` {sign} `{b}` as `{cross_name(a, op, b)}`")
        for a in left
        for b in right
        if keep(a, b)
    ]


def self_cross(names: Sequence[str], op: str, unordered: bool = False) -> list[Column]:
    """All ordered pairs with themselves; ``unordered`` drops the mirrored half."""
    place = {name: i for i, name in enumerate(names)}
    keep = (lambda a, b: place[a] <= place[b]) if unordered else (lambda a, b: True)
    return cross_columns(names, names, op, keep)


def cross_array(values: Column, op: str) -> Column:
    """The same crosses held in one ``array<double>``, row by row of the pair grid."""
    combine = OPS[op]
    return F.flatten(F.transform(values, lambda a: F.transform(values, lambda b: combine(a, b))))


def scaled_array(values: Column, factor: Column) -> Column:
    return F.transform(values, lambda x: x * factor)
