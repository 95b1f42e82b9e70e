"""Exact n-gram Jaccard join: a prefix filter on shared shingles, rounds of pivots, and bounded regions compared each in a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabwright.llm.bpe import one_by_one
from tabwright.llm.common import fresh, ship, sized
from tabwright.llm.components import components
from tabwright.session import materialize

# Two sets are near when 100 * intersection >= PERCENT * union.
PERCENT = 75
WIDTH = 5
# Percentage of a set, in the common order of shingles, by which candidates meet. Above
# 100 - 75, so that near sets share several of them.
PREFIX = 30
# Documents whose shingles say which ones are frequent, how often a frequent one is there at
# least, and how many of those are remembered. They only shape the order, not the result.
SAMPLE_DOCS = 10_000
SAMPLE_SEEN = 3
FREQUENT = 100_000
# Rows that a function hands on at a time.
ROWS_OUT = 100_000
# Members of a pivot that one task compares.
MEMBERS = 2000
# Rounds of one leading pivot per meeting before what is left is compared by regions.
ROUNDS = 2
# Bytes of sets and meetings in a block of a region, and pivots whose distances prune a block's pairs.
REGION_BYTES = 32 << 20
REGION_PIVOTS = 8
# Sets that are measured together, so that a region is not held a second time.
TOGETHER = 256

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words. Hashing one takes less time than looking it up, so none is remembered."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingles(data: bytes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; a shorter text is one shingle."""
    words = data.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = mixed(word_hashes(words))
    wide = min(width, len(h))
    total = np.full(len(h) - wide + 1, wide, np.uint64)
    for i in range(wide):
        total = (total ^ h[i : len(h) - wide + 1 + i]) * _FACTORS[i % len(_FACTORS)]
    return np.unique(mixed(total))


def prefix_size(n: int) -> int:
    """Shingles of a set of n by which it meets others."""
    return min(n, max(n - -(-PERCENT * n // 100) + 1, PREFIX * n // 100 + 1))


def unmet(n: Column) -> Column:
    """Shingles of a set of n that are not in its prefix."""
    prefix = F.greatest(n - F.ceil(PERCENT * n / 100) + 1, F.floor(PREFIX * n / 100) + 1)
    return n - F.least(n, prefix)


def pair_shared(n: Column, m: Column) -> Column:
    """How many shingles the prefixes of near sets of n and m have in common, at least.

    Near sets share a = ceil(p (n + m) / (100 + p)) shingles. In the common order, those up to
    the earlier prefix's end are in both prefixes; beyond it one of the sets has only what
    its prefix leaves.
    """
    shared = F.ceil(PERCENT * (n + m) / (100 + PERCENT))
    return F.greatest(F.lit(1), shared - F.greatest(unmet(n), unmet(m))).cast("long")


def least_shared(n: Column) -> Column:
    """The same for a set of n and any near set: the bound is least at one end of the sizes it can
    have, up to rounding."""
    ends = (F.ceil(PERCENT * n / 100), F.floor(100 * n / PERCENT), n)
    return F.greatest(F.lit(1), F.least(*[pair_shared(n, m.cast("long")) for m in ends]) - 1)


def frequent_shingles(docs: DataFrame, text: Column, width: int) -> np.ndarray:
    """Shingles that several of a bounded sample of documents have, sorted."""
    total = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(1, total))
    scale = 1 << 30
    drawn = docs.select(text.alias("data")).filter(F.pmod(F.xxhash64("data"), F.lit(scale)) < int(share * scale))

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in one_by_one(batches, "words"):
            found = [shingles(data, width).view(np.int64) for data in batch["data"]]
            if found:
                yield pd.DataFrame({"s": np.concatenate(found)})

    seen = drawn.dropDuplicates(["data"]).mapInPandas(make, "s long").groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    top = seen.filter(F.col("n") >= SAMPLE_SEEN).orderBy(F.desc("n"), "s").limit(FREQUENT).select("s").toPandas()
    return np.sort(top["s"].to_numpy(np.int64).view(np.uint64))


def sets_table(docs: DataFrame, id_col: str, text: Column, width: int, frequent: np.ndarray) -> DataFrame:
    """doc_id, n, cls and the prefix of every document; equal sets have equal ``cls``."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in one_by_one(batches, "words"):
            ids, out = batch["doc_id"], []
            for data in batch["data"]:
                s = shingles(data, width)
                n = len(s)
                cls = xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)
                if n:
                    rare = np.ones(n, bool)
                    if len(frequent):
                        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                        rare = frequent[at] != s
                    k = prefix_size(n)
                    few = s[rare][:k]
                    s = np.concatenate([few, s[~rare][: k - len(few)]])
                out.append((n, cls, s.tobytes()))
            yield pd.concat([ids.reset_index(drop=True), pd.DataFrame(out, columns=["n", "cls", "prefix"])], axis=1)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("data"))
    return rows.mapInPandas(make, "doc_id long, n int, cls long, prefix binary")


def columns(parts: list[tuple], names: tuple[str, ...]) -> pd.DataFrame:
    """Arrays of each part, one after the other, as columns."""
    return pd.DataFrame({name: np.concatenate([p[i] for p in parts]) for i, name in enumerate(names)})


def meetings(sets: DataFrame) -> DataFrame:
    """(s, cls, n) of the prefix shingles that several different sets have."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            out, held = [], 0
            for c, size, prefix in zip(batch["cls"], batch["n"], batch["prefix"]):
                if size == 0 or c in seen:
                    continue
                if len(seen) < 100_000:
                    seen.add(c)
                s = np.frombuffer(prefix, np.int64)
                out.append((s, np.full(len(s), c), np.full(len(s), size, np.int32)))
                held += len(s)
                if held >= ROWS_OUT:
                    yield columns(out, ("s", "cls", "n"))
                    out, held = [], 0
            if out:
                yield columns(out, ("s", "cls", "n"))

    def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Rows come in the order of (s, cls); one row waits to see its successor.
        last = None
        told = False  # whether the waiting row's shingle was shared with the row before it
        for batch in batches:
            if last is not None:
                batch = pd.concat([last, batch], ignore_index=True)
            s, cls = batch["s"].to_numpy(), batch["cls"].to_numpy()
            new = np.ones(len(s), bool)
            new[1:] = (s[1:] != s[:-1]) | (cls[1:] != cls[:-1])
            batch, s = batch[new], s[new]
            same = s[1:] == s[:-1]
            keep = np.append(told, same) | np.append(same, False)
            yield batch[:-1][keep[:-1]]
            last, told = batch[-1:], bool(keep[-1])
        if last is not None and told:
            yield last

    each = sets.mapInPandas(spread, "s long, cls long, n int")
    return each.repartition("s").sortWithinPartitions("s", "cls").mapInPandas(shared, "s long, cls long, n int")


def supported(met: DataFrame) -> DataFrame:
    """Meetings (s, cls, n, label, times) of sets that still meet others, of another label, often enough.

    Two near sets that are neither compared nor in one component meet in all the prefix
    shingles that they share. A meeting of one label is closed, and a set with fewer open
    meetings than near sets share is near to nobody else. Shingles that the same sets meet
    in are one meeting that counts ``times``.
    """

    often = met.groupBy("cls", "n").agg(F.sum("times").alias("often"))
    often = materialize(often.filter(F.col("often") >= least_shared(F.col("n").cast("long"))).select("cls"), "jaccard-often")
    left = met.join(sized(often), "cls", "left_semi")
    members = F.struct(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("cls")), F.bit_xor(F.xxhash64("cls", F.lit(1))))
    open_ = left.groupBy("s").agg(
        F.min("label").alias("a"), F.max("label").alias("b"), members.alias("members"), F.max("times").alias("each")
    )
    once = open_.filter("a <> b").groupBy("members").agg(F.min("s").alias("s"), F.sum("each").alias("all_times"))
    once = once.select("s", "all_times", F.col("members.size").alias("size"))
    return materialize(
        left.join(once, "s").select("s", "size", "cls", "n", "label", F.col("all_times").alias("times")), "jaccard-meetings"
    )


def rare_meetings(met: DataFrame) -> DataFrame:
    """Of each set, the smallest meetings by which it must meet any near set.

    Two near sets have a bound's worth of meetings in common. In a common order of the
    meetings, the smallest first, both have one of those among the meetings that come before the
    last ``bound - 1``. Adds ``open`` (all meetings of the set), ``rest`` (those left out),
    ``cut`` (the last meeting kept, in that order) and ``unmet`` (shingles beyond its prefix).
    """
    order = W.partitionBy("cls").orderBy("size", "s")
    n = F.col("n").cast("long")
    rows = met.withColumn("upto", F.sum("times").over(order.rowsBetween(W.unboundedPreceding, 0)))
    rows = rows.withColumn("open", F.sum("times").over(W.partitionBy("cls")))
    kept = rows.filter(F.col("upto") - F.col("times") <= F.col("open") - least_shared(n))
    kept = kept.withColumn("rest", F.col("open") - F.max("upto").over(W.partitionBy("cls")))
    kept = kept.withColumn("cut", F.max(F.struct("size", "s")).over(W.partitionBy("cls")))
    return kept.withColumn("unmet", unmet(n)).drop("upto")


def leaders(met: DataFrame) -> DataFrame:
    """Sets (cls) that come first in every meeting they are in, in a common order; a meeting holds at most one."""
    place = F.xxhash64("cls").alias("place")
    first = met.groupBy("s").agg(F.min(F.struct(place, "cls")).alias("first"))
    ranked = met.join(first, "s").select("cls", (F.col("first.cls") == F.col("cls")).alias("among"))
    return ranked.groupBy("cls").agg(F.min("among").alias("always")).filter("always").select("cls")


def distances(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """(x, p, d) of pairs (x, p): the exact Jaccard distance, and ``near``.

    A pivot's set meets the sets of its members once per ``MEMBERS`` of them, so a pivot with
    very many members is shared by many tasks.
    """
    sizes = pairs.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("shares"))
    split = pairs.join(sizes, "p").withColumn("share", F.pmod(F.xxhash64("x"), F.col("shares")).cast("int"))
    heads = sizes.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    sets = whole.select("cls", "shingles")
    rows = (
        heads.join(sets, heads["p"] == sets["cls"])
        .select("p", "share", F.lit(0).alias("member"), F.col("p").alias("x"), "shingles")
        .unionByName(split.join(sets, split["x"] == sets["cls"]).select("p", "share", F.lit(1).alias("member"), "x", "shingles"))
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivot, head = None, np.zeros(0, np.uint64)
        for batch in one_by_one(batches, "distances"):
            out = []
            for p, member, x, data in zip(batch["p"], batch["member"], batch["x"], batch["shingles"]):
                s = np.frombuffer(data, np.uint64)
                if not member:
                    pivot, head = p, s
                    continue
                if p != pivot:
                    raise ValueError("members without their pivot")
                a, b = (s, head) if len(s) < len(head) else (head, s)
                at = np.searchsorted(b, a)
                both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                union = len(s) + len(head) - both
                out.append((x, p, 1 - both / union, 100 * both >= PERCENT * union))
            yield pd.DataFrame(out, columns=["x", "p", "d", "near"])

    dealt = rows.repartition("p", "share").sortWithinPartitions("p", "share", "member")
    return dealt.mapInPandas(compare, "x long, p long, d double, near boolean")


def shared_with(head: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of some sets has in common with ``head``."""
    cells, ends = np.concatenate(sets), np.cumsum([len(s) for s in sets])
    at = np.minimum(np.searchsorted(head, cells), len(head) - 1)
    return np.diff(np.append(0, np.cumsum(head[at] == cells)[ends - 1]))


class Region:
    """Sets of one region, or of two of its blocks, that one task compares."""

    def __init__(self, sets: list[np.ndarray], meets: list[np.ndarray], times: list[np.ndarray], labels: np.ndarray):
        self.sets, self.n = sets, np.array([len(s) for s in sets], np.int64)
        self.unmet = self.n - np.array([prefix_size(int(n)) for n in self.n], np.int64)
        sizes = [len(x) for x in meets]
        self.ends = np.cumsum(sizes)
        _, self.codes = np.unique(np.concatenate(meets), return_inverse=True)
        self.times = np.concatenate(times)
        by_meeting = np.argsort(self.codes, kind="stable")
        self.members = np.repeat(np.arange(len(sets)), sizes)[by_meeting]
        self.starts = np.append(0, np.cumsum(np.bincount(self.codes)))
        _, self.root = np.unique(labels, return_inverse=True)
        self.to_pivots = self._measured()

    def _measured(self) -> np.ndarray:
        """Exact distances of all sets to some pivots, each the set farthest from those before it."""
        out, pivot, nearest = [], 0, np.full(len(self.sets), np.inf)
        for _ in range(min(REGION_PIVOTS, len(self.sets))):
            head = self.sets[pivot]
            both = np.concatenate([shared_with(head, self.sets[i : i + TOGETHER]) for i in range(0, len(self.sets), TOGETHER)])
            out.append(1 - both / (self.n + len(head) - both))
            nearest = np.minimum(nearest, out[-1])
            pivot = int(nearest.argmax())
        return np.array(out).T

    def partners(self, x: int) -> np.ndarray:
        """Later sets that may be near: by size, by common meetings and by the triangle inequality."""
        mine = slice(self.ends[x - 1] if x else 0, self.ends[x])
        lists = [self.members[self.starts[c] : self.starts[c + 1]] for c in self.codes[mine]]
        weight = np.repeat(self.times[mine], [len(m) for m in lists])
        met = np.bincount(np.concatenate(lists), weights=weight, minlength=len(self.sets))
        y = np.flatnonzero(met)
        y = y[y > x]
        n, m = self.n[x], self.n[y]
        shared = -(-PERCENT * (n + m) // (100 + PERCENT))
        least = np.maximum(1, shared - np.maximum(self.unmet[x], self.unmet[y]))
        y = y[(100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)) & (met[y] >= least)]
        gap = np.abs(self.to_pivots[y] - self.to_pivots[x]).max(axis=1, initial=0)
        return y[gap <= 1 - PERCENT / 100 + 1e-9]

    def near(self, x: int, y: int) -> bool:
        a, b = sorted((self.sets[x], self.sets[y]), key=len)
        both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
        return 100 * both >= PERCENT * (len(a) + len(b) - both)

    def links(self, blocks: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links that join all near sets of a block, or of two blocks, to each other; none is within one label."""
        root, across = self.root, blocks.min() != blocks.max()
        for x in range(len(self.sets)):
            for y in self.partners(x):
                if across and blocks[x] == blocks[y] or root[x] == root[y]:
                    continue
                if self.near(x, y):
                    root[root == root[y]] = root[x]
                    yield x, int(y)


def region_links(met: DataFrame, whole: DataFrame, block_bytes: int = REGION_BYTES) -> DataFrame:
    """Links (u, v) among the sets of open meetings.

    Sets connected by meetings are a region: near sets that are not in one component yet
    meet, so they are in one. A region is compared in one task, which counts the meetings of
    its pairs in memory; only links leave it. A larger one is cut into blocks of
    ``block_bytes`` by a hash, and every two blocks are compared in a task.
    """
    hubs = met.groupBy("s").agg(F.min("cls").alias("v"))
    region = components(met.join(hubs, "s").select(F.col("cls").alias("u"), "v")).withColumnRenamed("label", "region")
    sets = met.groupBy("cls", "label").agg(F.collect_list(F.struct("s", "times")).alias("m"))
    rows = sets.join(region, sets["cls"] == region["node"]).join(whole, "cls")
    rows = rows.select("region", "cls", "label", F.col("m.s").alias("s"), F.col("m.times").alias("times"), "shingles")
    rows = materialize(rows, "jaccard-regions")
    weight = F.sum(F.length("shingles") + 16 * F.size("s"))
    blocks = rows.groupBy("region").agg(F.ceil(weight / block_bytes).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    rows = rows.join(blocks, "region").withColumn("block", block)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("blocks", "other")

    def compare(group: pa.Table) -> pa.Table:
        # Two blocks of which a hash left one empty have no pairs.
        blocks, found = group["block"].to_numpy(), []
        if group["i"][0] == group["j"][0] or blocks.min() != blocks.max():
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["shingles"]]
            meets, times = ([x.values.to_numpy() for x in group[c]] for c in ("s", "times"))
            cls = group["cls"].to_numpy()
            found = [(cls[x], cls[y]) for x, y in Region(sets, meets, times, group["label"].to_numpy()).links(blocks)]
        u, v = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"u": u, "v": v})

    def one_group(group: pa.Table) -> pa.Table:
        (out,) = map(compare, one_by_one([group], "regions"))
        return out

    return rows.groupBy("region", "i", "j").applyInArrow(one_group, "u long, v long")


def links(met: DataFrame, whole: DataFrame) -> DataFrame:
    """Labels (node, label) of all sets that have links.

    The sets that share a shingle are a meeting. In each of the ``ROUNDS`` first rounds, sets
    that come first in all their meetings are pivots, one per meeting at most.
    Only each set's rare meetings count, without which no near pair meets. A pivot is paired
    with all that it meets there, so there are no more rows than meetings; pairs that share too few
    shingles in all are out. A set is compared with the pivot that
    it shares most with first; other pivots matter only
    while they are in other components. Pairs whose distances to a common pivot differ by
    more than the threshold are too far apart by the triangle inequality. Compared pivots
    leave, meetings that hold one component are closed, and what is left is compared region by region.
    """
    spark = met.sparkSession
    labels = spark.createDataFrame([], "node long, label long")
    windows = spark.createDataFrame([], "node long, pivot long, d double")

    def joined(near: DataFrame) -> DataFrame:
        if near.isEmpty():
            return labels
        return components(near.unionByName(labels.select(F.col("node").alias("u"), F.col("label").alias("v"))))

    for turn in range(ROUNDS):
        if met.isEmpty():
            return labels
        rare = materialize(rare_meetings(met), "jaccard-rare")
        pivots = materialize(leaders(rare), "jaccard-pivots")
        heads = rare.join(sized(pivots), "cls", "left_semi").select(
            "s", *[F.col(c).alias(f"p_{c}") for c in ("cls", "n", "label", "open", "rest", "cut", "unmet")]
        )
        needed = F.ceil(PERCENT * (F.col("n") + F.col("p_n")) / (100 + PERCENT)) - F.greatest("unmet", "p_unmet")
        fits = (
            (F.col("label") != F.col("p_label"))
            & (100 * F.least("n", "p_n") >= PERCENT * F.greatest("n", "p_n"))
            & (needed <= F.least("open", "p_open"))
        )
        # Common meetings up to the earlier cut are kept by both; those beyond it are all left out by
        # the set whose cut that is, whichever of the two leaves out more.
        beyond = F.when(F.col("cut") <= F.col("p_cut"), F.col("rest")).otherwise(F.col("p_rest"))
        stars = rare.join(heads, (rare["s"] == heads["s"]) & fits)
        # A pair of two pivots comes up from both sides, with the same count.
        pairs = stars.groupBy(F.col("cls").alias("x"), F.col("p_cls").alias("p")).agg(
            F.sum("times").alias("c"), F.max(needed - beyond).alias("least")
        )
        pairs = pairs.filter(F.col("c") >= F.col("least"))
        known = pivots.select(F.col("cls").alias("x"), F.lit(True).alias("leads"))
        pairs = pairs.join(sized(known), "x", "left").filter("leads is null or x > p").select("x", "p", "c")
        pairs = materialize(pairs, "jaccard-pairs")
        first = pairs.groupBy("x").agg(F.max(F.struct("c", "p")).alias("b")).select("x", F.col("b.p").alias("region"))
        regions = pairs.join(first, "x")
        for step in ("p = region", "p <> region"):
            wanted = materialize(_apart(regions.filter(step).select("x", "p"), labels, windows), "jaccard-wanted")
            if wanted.isEmpty():
                continue
            found = materialize(distances(wanted, whole), "jaccard-distances")
            labels = joined(found.filter("near").select(F.col("x").alias("u"), F.col("p").alias("v")))
            if turn == 0:
                windows = windows.unionByName(found.select(F.col("x").alias("node"), F.col("p").alias("pivot"), "d"))
        rest = met.join(sized(pivots), "cls", "left_anti").drop("label")
        rest = rest.join(sized(labels), rest["cls"] == labels["node"], "left")
        met = supported(rest.select("s", "cls", "n", F.coalesce("label", "cls").alias("label"), "times"))
    if met.isEmpty():
        return labels
    return joined(materialize(region_links(met, whole), "jaccard-links"))


def _apart(pairs: DataFrame, labels: DataFrame, windows: DataFrame) -> DataFrame:
    """Pairs (x, p) that are not in one component yet and may be near, judged by common pivots."""
    a = labels.select(F.col("node").alias("x"), F.col("label").alias("lx"))
    b = labels.select(F.col("node").alias("p"), F.col("label").alias("lp"))
    joined = pairs.join(sized(a), "x", "left").join(sized(b), "p", "left")
    open_ = joined.filter(F.coalesce("lx", "x") != F.coalesce("lp", "p")).select("x", "p")
    dx = windows.select(F.col("node").alias("x"), "pivot", F.col("d").alias("dx"))
    dp = windows.select(F.col("node").alias("p"), "pivot", F.col("d").alias("dp"))
    gap = F.abs(F.col("dx") - F.col("dp")) > 1 - PERCENT / 100 + 1e-9
    ruled_out = open_.join(dx, "x").join(dp, ["p", "pivot"]).filter(gap).select("x", "p")
    return open_.join(ruled_out, ["x", "p"], "left_anti")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    Documents link when the Jaccard similarity of their sets of word shingles is 0.75 or more;
    a component's id is the smallest doc_id in it. Equal sets are one node of the graph. Null
    and empty texts have no shingles and link with nothing. Null ids are never smallest; a
    component of null ids has a null id. An empty table gives no rows. Shingles are
    compared by 64-bit hashes, and sets are the same if a 64-bit hash of all of them is.
    """
    spark = ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    frequent = frequent_shingles(docs, text, width)
    sets = materialize(sets_table(docs, id_col, text, width, frequent), "jaccard-sets")
    met = supported(materialize(meetings(sets), "jaccard-met").withColumns({"label": F.col("cls"), "times": F.lit(1).cast("long")}))
    alive = materialize(met.select("cls").distinct(), "jaccard-alive")
    one = sets.join(sized(alive), "cls", "left_semi").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    whole = materialize(whole_sets(docs, id_col, text, width, materialize(one, "jaccard-one")), "jaccard-whole")
    labels = links(met, whole)
    nodes = sets.select("doc_id", "n", "cls").join(sized(labels), F.col("cls") == F.col("node"), "left")
    nodes = materialize(nodes.select("doc_id", "n", F.coalesce("label", "cls").alias("label")), "jaccard-nodes")
    least = materialize(nodes.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("k")).filter("k > 1"), "jaccard-least")
    named = nodes.join(sized(least), "label", "left")
    component = F.when((F.col("n") == 0) | F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return named.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are alone or have their component's smallest id, with all columns.

    Rows that share an id go only if all of them would.
    """
    near = materialize(near_duplicates(docs, id_col, text_col), "jaccard-near")
    stays = F.max(F.col("doc_id").eqNullSafe(F.col("component_id")))
    (key,) = fresh(docs, "_id")
    dropped = near.groupBy(F.col("doc_id").alias(key)).agg(stays.alias("stays")).filter("not stays").select(key)
    return docs.join(sized(materialize(dropped, "jaccard-dropped")), F.col(id_col).eqNullSafe(F.col(key)), "left_anti")


def whole_sets(docs: DataFrame, id_col: str, text: Column, width: int, wanted: DataFrame) -> DataFrame:
    """cls and all shingles of the wanted classes (cls, doc_id), one row each."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in one_by_one(batches, "words"):
            out = []
            for cls, data in zip(batch["cls"], batch["data"]):
                s = shingles(data, width).tobytes()
                # Another row with the same id may have another text.
                if xxhash.xxh3_64_intdigest(s) - (1 << 63) == cls:
                    out.append((cls, s))
            yield pd.DataFrame(out, columns=["cls", "shingles"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("data"))
    joined = rows.join(sized(wanted), F.col("_id").eqNullSafe(F.col("doc_id"))).select("cls", "data")
    return joined.mapInPandas(make, "cls long, shingles binary").dropDuplicates(["cls"])
