"""One budget for all broadcasts of a plan."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabwright.operators.levels import cells_per_row, level_counts, measure, within_budget
from tabwright.operators.lookup import lookup_packed

KEYS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def looked_up(spark):
    rows = [(i, i % 3, i % 50, None if i % 7 == 0 else i % 200) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, a int, b int, c int")
    facts, counts = measure(df, KEYS)
    tables = {k: counts.filter(F.col("feature") == k).select("level", (F.col("n") * 2).alias(f"{k}_n")) for k in KEYS}
    return df, facts, counts, tables


def chain(df, facts, tables):
    for k, table in tables.items():
        df = lookup_packed(df, table, k, facts[k], f"at_{k}", ["id"])
    return df.select("id", *[f"at_{k}.{k}_n" for k in tables])


@pytest.mark.parametrize("budget, fits", [(10_000, 3), (110, 2), (10, 1), (0, 0)])
def test_broadcasts_of_a_plan_stay_within_one_budget(looked_up, budget, fits):
    df, facts, counts, tables = looked_up
    size = {k: facts[k].n_levels * cells_per_row(t.schema) for k, t in tables.items()}
    allowed = within_budget(facts, tables, counts, budget)
    taken = [k for k in KEYS if allowed[k].may_broadcast]
    assert len(taken) == fits and sum(size[k] for k in taken) <= budget
    assert taken == KEYS[:fits]
    # What is refused is shuffled, and levels with many rows are known then.
    assert all(set(allowed[k].hot) == {r.level for r in level_counts(df, [k]).collect()} for k in KEYS if k not in taken)
    got = chain(df, allowed, tables)
    expected = {k: Counter(r[k] for r in df.collect()) for k in KEYS}
    for r in df.join(got, "id").collect():
        assert all(r[f"{k}_n"] == (None if r[k] is None else 2 * expected[k][r[k]]) for k in KEYS)
    hints = got._jdf.queryExecution().analyzed().toString().count("strategy=broadcast")
    assert hints == fits + len(KEYS) - fits  # a refused table still broadcasts its hot levels
