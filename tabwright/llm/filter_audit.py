"""How text filters interact: what each removes in every order, and its Shapley share of all removals."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import WORD
from tabwright.session import materialize

FILTERS = "ABCDE"
# Fixed values of the filters: fewest words, least per cent of distinct words, most per cent of
# capitals, characters of markup.
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
MARKUP = "[#$%&*|]"


def text_failures(text: Column) -> Column:
    """Bits of the filters that a text fails by itself: A 1, B 2, C 4, D 8."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [
        n < LEAST_WORDS,
        F.lit(100) * F.size(F.array_distinct(words)) < F.lit(LEAST_DISTINCT) * n,
        F.lit(100) * capitals > F.lit(MOST_CAPITALS) * F.length(text),
        text.rlike(MARKUP),
    ]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def failures(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """(part, mask, n, good, toxic): how many documents of a part fail exactly the filters in ``mask``.

    Bit 16, filter E, is set if a smaller id has the identical text (SHA-256), wherever it
    is. Of each text one row per (id, part) goes on, with its count, so copies collapse
    before they are shuffled, and the row with the smallest id is found by a join on text
    and id together, which spreads a text with very many copies.

    Null text is empty and a null part is the empty one. A null id has no label, is not
    smaller than any other and has none smaller. Repeated rows count each; a label row that
    is repeated counts once, by its greatest values. Long texts are read whole, in the JVM.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
        text_failures(text).alias("mask"),
    )
    rows = materialize(rows, "audit-rows")
    firsts = rows.filter("doc_id is not null").groupBy("sha").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    counted = rows.groupBy("sha", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    later = F.col("doc_id").isNotNull() & F.col("first").isNull()
    masked = (
        counted.join(firsts, ["sha", "doc_id"], "left")
        .withColumn("mask", F.col("mask") + F.when(later, 1 << 4).otherwise(0))
        .groupBy("doc_id", "part", "mask")
        .agg(F.sum("n").alias("n"))
    )
    masked = materialize(masked, "audit-masks")
    marks = (
        labels.filter("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    )
    known = masked.filter("doc_id is not null").join(marks, "doc_id", "left")
    nameless = masked.filter("doc_id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    every = known.unionByName(nameless)
    of = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0)))
    return every.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good").alias("good"), of("toxic").alias("toxic"))


def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X of ``matrix`` X = ``right`` by Gauss and Jordan, exactly."""
    rows = [[*a, *b] for a, b in zip(matrix, right)]
    n = len(rows)
    for i in range(n):
        lead = next(r for r in range(i, n) if rows[r][i])
        rows[i], rows[lead] = rows[lead], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [row[n:] for row in rows]


def shapley_weights(m: int) -> list[list[int]]:
    """For each of m filters, what m! times its Shapley value takes of every coalition's value.

    The values minimise the squares of (v(S) - sum of the members' values), weighted by the
    kernel (m - 1) / (C(m, s) s (m - s)) over all proper coalitions, under the constraint that
    they add up to v of all. The normal equations with their multiplier are solved in
    rationals for all right-hand sides at once, so the weights hold for any values, and as
    m! clears the denominators they are whole.
    """
    inside = lambda s, i: s >> i & 1
    kernel = [Fraction(0)] * (1 << m)
    for s in range(1, (1 << m) - 1):
        size = s.bit_count()
        kernel[s] = Fraction(m - 1, comb(m, size) * size * (m - size))
    matrix = [[sum((kernel[s] for s in range(1 << m) if inside(s, i) and inside(s, j)), Fraction(0)) for j in range(m)] + [Fraction(1)] for i in range(m)]
    matrix.append([Fraction(1)] * m + [Fraction(0)])
    right = [[kernel[s] * inside(s, i) for s in range(1 << m)] for i in range(m)]
    right.append([Fraction(int(s == (1 << m) - 1)) for s in range(1 << m)])
    found = [[factorial(m) * x for x in row] for row in solve(matrix, right)[:m]]
    if any(x.denominator != 1 for row in found for x in row):
        raise ArithmeticError("the weights are not whole")
    return [[int(x) for x in row] for row in found]


def audit(counts: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from (part, mask, n, good, toxic).

    Bit i of ``mask`` says that filter i fails. The removals of all 2^m coalitions of
    filters are tabulated per part; a step's counts are differences of two of them, and the
    Shapley values, times the number of orders, are whole combinations of them
    (``shapley_weights``). Columns: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley. A table without rows gives none.
    """
    m = len(filters)
    full = (1 << m) - 1
    hit = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    lost = lambda c: F.sum(F.when(hit, F.col(c)).otherwise(F.lit(0))).cast("long").alias(c)
    table = (
        counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(full))))
        .groupBy("part", "coalition")
        .agg(F.sum("n").cast("long").alias("total"), lost("n"), lost("good"), lost("toxic"))
    )
    parts = table.groupBy("part").agg(
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("coalition", "n", "good", "toxic"))).alias("cells")
    )
    share = [
        F.aggregate(F.zip_with("cells", F.lit(w), lambda c, x: c["n"] * x), F.lit(0).cast("long"), lambda a, x: a + x)
        for w in shapley_weights(m)
    ]
    parts = parts.withColumn("shares", F.array(*share))
    steps = [
        ("".join(order[i] for i in range(m)), k + 1, filters.index(order[k]), sum(1 << filters.index(f) for f in order[: k + 1]))
        for order in permutations(filters)
        for k in range(m)
    ]
    # As many rows as there are steps in all orders: a fixed number.
    plan = parts.sparkSession.createDataFrame(steps, "filter_order string, step int, filter int, after int")
    rows = parts.select("*", F.posexplode("cells").alias("after", "now")).join(F.broadcast(plan), "after")
    bit = F.expr("shiftleft(1, filter)")
    cell = lambda at: F.element_at("cells", (at + 1).cast("int"))
    before = cell(F.col("after") - bit)
    removed = F.col("now.n") - before["n"]
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.col("now.n")).alias("kept"),
        removed.alias("removed"),
        (cell(bit)["n"] - removed).alias("redundant"),
        (cell(F.lit(full))["n"] - cell(F.lit(full) - bit)["n"]).alias("unique_fails"),
        (F.col("now.good") - before["good"]).alias("good_lost"),
        (F.col("now.toxic") - before["toxic"]).alias("toxic_lost"),
        F.element_at("shares", F.col("filter") + 1).alias("shapley"),
    )


SQL = r"""
with recursive d as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents),
l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
      from labels group by doc_id),
f as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
           [len(words) < 200,
            100 * len(list_distinct(words)) < 50 * len(words),
            100 * length(regexp_replace(body, '[^A-Z]+', '', 'g')) > 2 * length(body),
            regexp_matches(body, '[#$%&*|]'),
            coalesce(d.doc_id > min(d.doc_id) over (partition by body), false)] as fails
    from d left join l on l.doc_id = d.doc_id),
g as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by part, fails),
o as (
    select '' as filter_order, 0 as step
    union all
    select filter_order || x, step + 1 from o, (select unnest(['A', 'B', 'C', 'D', 'E']) as x) u
    where step < 5 and not contains(filter_order, x)),
s as (
    select filter_order, u.place as step, instr('ABCDE', substr(filter_order, u.place, 1)) as own,
           list_transform(range(1, u.place), lambda i: instr('ABCDE', substr(filter_order, i, 1))) as earlier
    from o, (select cast(unnest(range(1, 6)) as int) as place) u where length(filter_order) = 5),
r as (
    select part, filter_order, s.step, own, n, good, toxic, fails[own] as failing,
           len(list_filter(earlier, lambda i: fails[i])) > 0 as gone, len(list_filter(fails, lambda x: x)) as failed
    from g, s),
t as (
    select part, filter_order, step, own,
           sum(case when not failing and not gone then n else 0 end) as kept,
           sum(case when failing and not gone then n else 0 end) as removed,
           sum(case when failing and gone then n else 0 end) as redundant,
           sum(case when failing and failed = 1 then n else 0 end) as unique_fails,
           sum(case when failing and not gone then good else 0 end) as good_lost,
           sum(case when failing and not gone then toxic else 0 end) as toxic_lost
    from r group by all)
select part, filter_order, cast(step as int) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, own) as bigint) as shapley
from t
"""
