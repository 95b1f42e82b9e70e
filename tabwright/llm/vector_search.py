"""Exact search for the largest inner products by pivot distances and sorted annuli."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabwright.llm.common import ship, sized
from tabwright.session import materialize

PIVOTS = 64
# Vectors of an annulus, queries that search together, annuli that one task walks through.
ANNULUS = 1024
TOGETHER = 128
WALK = 64
# Scaled components are kept in 32 bits; larger finite ones are an error, never left out.
TOO_LARGE = 2.0**31


def quantized(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) of the components as longs; null if the vector takes no part.

    A finite component of 2 ** 31 or more after scaling raises.
    """
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    fits = F.forall(vector, lambda x: F.abs(x.cast("double")) * factor < F.lit(TOO_LARGE))
    refused = F.raise_error(F.lit("a vector's component is too large to be scored")).cast("array<long>")
    return F.when(F.coalesce(sound, F.lit(False)), F.when(fits, whole.cast("array<long>")).otherwise(refused))


class Space:
    """Vectors as points on a sphere: the added component makes all lengths equal.

    For a query with 0 there, the squared distance is |q|^2 + most - 2 * score, so the largest
    scores are the nearest points, and the triangle inequality holds. ``most`` is the largest
    squared length.
    """

    def __init__(self, pivots: np.ndarray, most: float):
        self.pivots, self.most = pivots.astype(np.float64), most
        self.added = self.lift(self.pivots)

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, self.most - (x * x).sum(axis=1)))

    def from_points(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        both = x @ self.pivots.T + np.outer(self.lift(x), self.added)
        return np.sqrt(np.maximum(0.0, 2 * self.most - 2 * both))

    def from_queries(self, q: np.ndarray) -> np.ndarray:
        q = q.astype(np.float64)
        return np.sqrt(np.maximum(0.0, (q * q).sum(axis=1)[:, None] + self.most - 2 * (q @ self.pivots.T)))

    def reach(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Distance within which points with at least that score lie, with room for rounding."""
        squared = (q.astype(np.float64) ** 2).sum(axis=1) + self.most
        return np.sqrt(np.maximum(0.0, squared - 2 * score)) + 1e-6 * (1 + np.sqrt(squared))


def matrix(cells: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(cells, np.int32).reshape(-1, dim)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: doubles hold whole numbers up to 2 ** 53."""
    largest = np.abs(q.astype(np.float64)).max(initial=0) * np.abs(x.astype(np.float64)).max(initial=0) * q.shape[1]
    if largest < 2.0**52:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if largest < 2.0**62:
        return q.astype(np.int64) @ x.astype(np.int64).T
    # Python's integers; a score that no long holds raises.
    return (q.astype(object) @ x.astype(object).T).astype(np.int64)


def best_first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    factor: int = 64,
    pivots: int = PIVOTS,
    annulus: int = ANNULUS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of quantised vectors.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows whose id
    is another one. Ties go to the smaller id. Vectors that are null or hold null or non-finite
    components take no part; nor do rows without an id. Components of 2 ** 31 or more after
    scaling, and scores that no long holds, raise. Shorter vectors count as filled up with zeros. Rows that repeat an id are
    candidates each, and queries each. An empty table gives no rows.

    Pivots are a bounded sample by a hash of the id. Every vector is keyed by its nearest
    pivot and the distance to it; sorted by both, stretches of ``annulus`` rows are annuli.
    A query's own annulus gives a first k-th score. The distance that this score stands for
    rules out, by the triangle inequality, all annuli around a pivot that are too far from the
    query's own distance to it. The others are walked nearest first, while scores improve.
    """
    spark = ship(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), quantized(F.col(vector_col), factor).alias("v"))
    rows = materialize(rows.filter("vec_id is not null and v is not null"), "search-vectors")
    facts = rows.agg(
        F.max(F.size("v")).alias("dim"),
        F.max(F.aggregate(F.transform("v", lambda x: x.cast("double") * x), F.lit(0.0), lambda a, b: a + b)).alias("most"),
    ).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if facts["dim"] is None:
        return spark.createDataFrame([], schema)
    dim = max(1, facts["dim"])
    rows = rows.select("vec_id", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("v"))).cast("array<int>").alias("v"))
    heads = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).toPandas()
    space = Space(np.unique(np.array(heads["v"].tolist(), np.int64).reshape(-1, dim), axis=0), facts["most"])

    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = np.array(batch["v"].tolist(), np.int32).reshape(-1, dim)
            far = space.from_points(x)
            near = far.argmin(axis=1)
            yield pd.DataFrame(
                {"vec_id": batch["vec_id"], "pivot": near.astype(np.int32), "r": far[np.arange(len(x)), near], "v": [row.tobytes() for row in x]}
            )

    keyed = rows.mapInPandas(key, "vec_id long, pivot int, r double, v binary")
    parts = max(1, -(-rows.count() // (16 * annulus)))
    ordered = keyed.repartitionByRange(parts, "pivot", "r", "vec_id").sortWithinPartitions("pivot", "r", "vec_id")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            edges = _stretches(held["pivot"].to_numpy(), annulus)
            if len(edges) > 1:
                yield _packed(held, edges[:-1])
                held = held[edges[-1][0] :].reset_index(drop=True)
        if held is not None and len(held):
            yield _packed(held, _stretches(held["pivot"].to_numpy(), annulus))

    annuli = ordered.mapInPandas(cut, "pivot int, lo double, hi double, n int, ids binary, cells binary")
    annuli = materialize(annuli.withColumn("annulus", F.monotonically_increasing_id()), "search-annuli")

    def seed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for pivot, lo, ids, cells in zip(batch["pivot"], batch["lo"], batch["ids"], batch["cells"]):
                ids, x = np.frombuffer(ids, np.int64), matrix(cells, dim)
                asked = np.flatnonzero(ids % every == 0)
                for i, scores in zip(asked, products(x[asked], x)):
                    scores = scores[ids != ids[i]]
                    least = int(np.partition(scores, -k)[-k]) if len(scores) >= k else None
                    out.append((int(ids[i]), pivot, lo, least, x[i].tobytes()))
            yield pd.DataFrame(out, columns=["query_id", "pivot", "r", "least", "v"]).astype({"least": "Int64"})

    seeded = annuli.mapInPandas(seed, "query_id long, pivot int, r double, least long, v binary")
    # Rows that share an id are queries of their own.
    seeded = materialize(seeded.withColumn("row", F.monotonically_increasing_id()), "search-seeds")
    least_score = -(2**63)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                part = batch[at : at + TOGETHER]
                q = matrix(b"".join(part["v"]), dim)
                least = part["least"].fillna(least_score).to_numpy(np.int64)
                reach = space.reach(q, np.maximum(least, least_score).astype(np.float64))
                far = space.from_queries(q)
                yield pd.DataFrame(
                    {
                        "ids": [part["query_id"].to_numpy(np.int64).tobytes()],
                        "rows": [part["row"].to_numpy(np.int64).tobytes()],
                        "least": [least.tobytes()],
                        "cells": [q.tobytes()],
                        "near": [far.min(axis=0)],
                        "far": [far.max(axis=0)],
                        "a": [(far - reach[:, None]).min(axis=0)],
                        "b": [(far + reach[:, None]).max(axis=0)],
                    }
                )

    asked_parts = max(1, -(-seeded.count() // (16 * TOGETHER)))
    together = seeded.withColumn("least", F.coalesce("least", F.lit(least_score)))
    together = together.repartitionByRange(asked_parts, "pivot", "r", "query_id").sortWithinPartitions("pivot", "r", "query_id")
    floats = ", ".join(f"{c} array<double>" for c in ("near", "far", "a", "b"))
    groups = together.mapInPandas(gather, f"ids binary, rows binary, least binary, cells binary, {floats}")
    groups = materialize(groups.withColumn("grp", F.monotonically_increasing_id()), "search-queries")

    per_pivot = annuli.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / WALK).cast("int").alias("walks"))
    shells = annuli.join(F.broadcast(per_pivot), "pivot").withColumn("walk", F.pmod("annulus", F.col("walks")).cast("int"))
    around = groups.select("grp", F.posexplode(F.arrays_zip("near", "far", "a", "b")).alias("pivot", "z")).select("grp", "pivot", "z.*")
    gap = F.greatest(F.lit(0.0), F.col("near") - F.col("hi"), F.col("lo") - F.col("far"))
    pairs = shells.drop("ids", "cells").join(around, "pivot").filter("hi >= a and lo <= b").select("grp", "pivot", "walk", "annulus", gap.alias("gap"))
    pairs = materialize(pairs, "search-pairs")
    walks = pairs.select("grp", "pivot", "walk").distinct()
    members = pairs.join(annuli.select("annulus", "lo", "hi", "ids", "cells"), "annulus").select(
        "grp", "pivot", "walk", F.lit(1).alias("member"), "gap", "lo", "hi", "ids", "cells", F.lit(b"").alias("least"), F.lit(b"").alias("rows")
    )
    asking = walks.join(groups, "grp").select(
        "grp", "pivot", "walk", F.lit(0).alias("member"), F.lit(0.0).alias("gap"), F.lit(0.0).alias("lo"), F.lit(0.0).alias("hi"), "ids", "cells", "least", "rows"
    )

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.member == 0:
                    out += search.found() if search else []
                    search = Search(space, row, dim, k)
                else:
                    search.visit(row)
            yield pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score"])
        if search:
            yield pd.DataFrame(search.found(), columns=["row", "query_id", "vec_id", "score"])

    dealt = members.unionByName(asking).repartition("grp", "pivot", "walk").sortWithinPartitions("grp", "pivot", "walk", "member", "gap")
    found = dealt.mapInPandas(walk, "row long, query_id long, vec_id long, score long")
    place = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class Search:
    """Queries on their way through the annuli of one pivot, nearest first."""

    def __init__(self, space: Space, head, dim: int, k: int):
        self.space, self.dim, self.k = space, dim, k
        self.ids, self.rows = np.frombuffer(head.ids, np.int64), np.frombuffer(head.rows, np.int64)
        self.q = matrix(head.cells, dim)
        self.least = np.frombuffer(head.least, np.int64).copy()
        self.far = space.from_queries(self.q)[:, head.pivot]
        self.reach = space.reach(self.q, self.least.astype(np.float64))
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(self.ids)

    def visit(self, row) -> None:
        if row.gap > self.reach.max():
            return
        gap = np.maximum(np.maximum(self.far - row.hi, row.lo - self.far), 0)
        active = np.flatnonzero(gap <= self.reach)
        if not len(active):
            return
        ids, x = np.frombuffer(row.ids, np.int64), matrix(row.cells, self.dim)
        scores = products(self.q[active], x)
        good = scores >= self.least[active][:, None]
        improved = []
        for i, s, ok in zip(active, scores, good):
            at = np.flatnonzero(ok & (ids != self.ids[i]))
            if not len(at):
                continue
            all_s, all_i = np.concatenate([self.best[i][0], s[at]]), np.concatenate([self.best[i][1], ids[at]])
            top = best_first(all_s, all_i, self.k)
            self.best[i] = all_s[top], all_i[top]
            if len(top) == self.k and all_s[top[-1]] > self.least[i]:
                self.least[i] = all_s[top[-1]]
                improved.append(i)
        if improved:
            self.reach[improved] = self.space.reach(self.q[improved], self.least[improved].astype(np.float64))

    def found(self) -> list[tuple]:
        asked = zip(self.rows.tolist(), self.ids.tolist(), self.best)
        return [(r, q, int(i), int(s)) for r, q, (scores, ids) in asked for s, i in zip(scores, ids)]


def _stretches(pivot: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Stretches of equal pivots, of ``most`` rows at most."""
    edge = np.append(np.flatnonzero(np.append(True, pivot[1:] != pivot[:-1])), len(pivot))
    return [(i, min(i + most, b)) for a, b in zip(edge[:-1], edge[1:]) for i in range(a, b, most)]


def _packed(rows: pd.DataFrame, edges: list[tuple[int, int]]) -> pd.DataFrame:
    r, ids, v = rows["r"].to_numpy(), rows["vec_id"].to_numpy(np.int64), rows["v"].tolist()
    return pd.DataFrame(
        {
            "pivot": [rows["pivot"].iloc[a] for a, _ in edges],
            "lo": [r[a] for a, _ in edges],
            "hi": [r[b - 1] for _, b in edges],
            "n": [b - a for a, b in edges],
            "ids": [ids[a:b].tobytes() for a, b in edges],
            "cells": [b"".join(v[a:b]) for a, b in edges],
        }
    )


SQL = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (
    select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
    from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from p)
select query_id, rank, vec_id, score from r where rank <= 20
"""
