"""Fuzzy repeated passages: shared seeds, collinear chains by a Fenwick tree, and alignment."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.bpe import Remembered
from tabwright.llm.common import join_spread, ship, sized
from tabwright.llm.jaccard_join import mixed, word_hashes
from tabwright.llm.repeats import sliding
from tabwright.session import materialize

# Words of a seed; of so many neighbouring seeds the one with the least hash is kept.
SEED = 5
NEIGHBOURS = 12
# Besides, one seed in so many is kept whatever its neighbours are, so an edit nearby doesn't change it.
EVERY = 7
# Words that the seeds of a chain cover at least.
COVERED = 8
# A passage has this many words at least, and this share of them agrees with the other place's.
LEAST_WORDS = 50
SIMILARITY = 0.75
# What a seed adds to a chain, and what a word of a gap costs on either side.
GAIN = 5.0
GAP = 0.05
# Words that a chain may skip before it counts as two passages, and mismatches at an end.
SKIP = 25
DROP = 6
# Documents that one task aligns with a reference.
MEMBERS = 2000
# So many seeds in a row meet as one where they have several references.
TOGETHER = (2, 3, 4, 6, 8)

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(data: bytes) -> np.ndarray:
    """64-bit hashes of the words, A-Z in lower case."""
    return word_hashes(data.translate(_LOWER).split())


def seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the kept seeds. Any stretch of SEED + NEIGHBOURS - 1 words has one."""
    n = len(words) - SEED + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for i in range(SEED):
        total = total * _FACTOR + mixed(words[i : n + i])
    total = mixed(total)
    width = min(NEIGHBOURS, n)
    least = sliding(np.minimum, total, width)
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    padded[width - 1 : width - 1 + len(least)] = least
    kept = (total == sliding(np.maximum, padded, width)) | (total < np.uint64((1 << 64) // EVERY))
    at = np.flatnonzero(kept)
    return total[at], at


def seeds_in_a_row(rows: DataFrame) -> DataFrame:
    """Rows (seed, doc_id, at, last) of seeds that follow each other in a document, hashed as one.

    ``rows`` are (seed, doc_id, at, ref). Only seeds with different references and gaps that a
    verbatim passage can have count: those with one reference meet there already.
    """
    most = max(TOGETHER)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            before = 0 if held is None else len(held)
            if before:
                batch = pd.concat([held, batch], ignore_index=True)
            seed, doc, at, ref = (batch[c].to_numpy() for c in ("seed", "doc_id", "at", "ref"))
            changes = np.cumsum(np.append(0, ref[1:] != ref[:-1])) if len(ref) else np.zeros(0, int)
            for width in TOGETHER:
                n = len(seed) - width + 1
                # Those that end among the held rows were told with the batch before.
                i = np.arange(max(0, before - width + 1), max(0, n))
                j = i + width - 1
                i = i[(doc[i] == doc[j]) & (changes[i] < changes[j]) & (at[j] - at[i] <= (width - 1) * NEIGHBOURS)]
                if not len(i):
                    continue
                total = np.full(len(i), width, np.uint64)
                for k in range(width):
                    total = total * _FACTOR + mixed(seed[i + k].view(np.uint64))
                yield pd.DataFrame({"seed": mixed(total).view(np.int64), "doc_id": doc[i], "at": at[i], "last": at[i + width - 1]})
            held = batch[-(most - 1) :]

    ordered = rows.select("seed", "doc_id", "at", "ref").repartition("doc_id").sortWithinPartitions("doc_id", "at", "seed")
    return ordered.mapInPandas(hashed, "seed long, doc_id long, at int, last int")


class Fenwick:
    """Largest (value, index) among the first places."""

    def __init__(self, n: int):
        self.best = [(float("-inf"), -1)] * (n + 1)

    def put(self, at: int, value: tuple[float, int]) -> None:
        at += 1
        while at < len(self.best):
            if value > self.best[at]:
                self.best[at] = value
            at += at & -at

    def before(self, at: int) -> tuple[float, int]:
        found = (float("-inf"), -1)
        while at > 0:
            found = max(found, self.best[at])
            at -= at & -at
        return found


def chains(anchors: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Chains of anchors (place, place in the reference) that ascend in both, best first.

    A chain's score is what its seeds add less what its gaps cost on both sides; the cost is
    a difference of the ends' sums, so the best predecessor is a prefix maximum. Anchors
    are in one chain each.
    """
    anchors = sorted(set(anchors))
    places = sorted({r for _, r in anchors})
    tree = Fenwick(len(places))
    score, previous = [0.0] * len(anchors), [-1] * len(anchors)
    i = 0
    while i < len(anchors):
        j = i
        while j < len(anchors) and anchors[j][0] == anchors[i][0]:
            x, y = anchors[j]
            best, k = tree.before(bisect_left(places, y))
            joined = best - GAP * (x + y)
            if joined > 0:
                score[j], previous[j] = GAIN + joined, k
            else:
                score[j] = GAIN
            j += 1
        # Anchors of one place don't follow each other.
        for k in range(i, j):
            x, y = anchors[k]
            tree.put(bisect_left(places, y), (score[k] + GAP * (x + y), k))
        i = j
    used = [False] * len(anchors)
    out = []
    for end in sorted(range(len(anchors)), key=lambda k: -score[k]):
        chain = []
        while end >= 0 and not used[end]:
            used[end] = True
            chain.append(anchors[end])
            end = previous[end]
        if chain:
            out.append(chain[::-1])
    return out


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    where: dict[int, int] = {}
    for i, w in enumerate(x.tolist()):
        where[w] = where.get(w, 0) | (1 << i)
    full = (1 << len(x)) - 1
    v = full
    for w in y.tolist():
        u = v & where.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(x) - v.bit_count()


def straight(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """How far two sequences agree word by word from their start, and in how many words; few mismatches may lie between."""
    n = min(len(x), len(y))
    if not n:
        return 0, 0
    same = x[:n] == y[:n]
    total = np.cumsum(np.where(same, 1, -2))
    low = np.maximum.accumulate(total) - total > DROP
    if low.any():
        total = total[: int(low.argmax())]
    if not len(total) or total.max() <= 0:
        return 0, 0
    size = int(total.argmax()) + 1
    return size, int(same[:size].sum())


# Words left out on either side where an extension goes on beyond an insertion.
_SHIFTS = [(1, 0), (0, 1), (2, 0), (0, 2), (3, 0), (0, 3), (2, 1), (1, 2)]


def extended(x: np.ndarray, y: np.ndarray) -> tuple[int, int, int]:
    """Words of both sequences that an extension from their start covers, and how many agree."""
    i, hits = straight(x, y)
    j = i
    while True:
        tries = [(straight(x[i + a : i + a + 200], y[j + b : j + b + 200]), a, b) for a, b in _SHIFTS]
        (size, found), a, b = max(tries, key=lambda t: t[0][1] - t[1] - t[2])
        if found < 4:
            return i, j, hits
        more, found = straight(x[i + a :], y[j + b :])
        i, j, hits = i + a + more, j + b + more, hits + found


def align(x: np.ndarray, y: np.ndarray, chain: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Passages (start, end, start and end in the reference, agreeing words) along a chain."""
    out = []
    a, b = chain[0]
    left, left_y, matches = extended(x[:a][::-1], y[:b][::-1])
    start, start_y, at, at_y = a - left, b - left_y, a, b
    for a, b in chain[1:]:
        dx, dy = a - at, b - at_y
        found = int((x[at:a] == y[at_y:b]).sum()) if dx == dy else -1
        if found < dx - SKIP // 5:
            # Gaps whose lengths differ by more than SKIP count as two passages, whatever agrees in them.
            found = max(found, common(x[at:a], y[at_y:b]) if abs(dx - dy) <= SKIP else 0)
        if max(dx, dy) - found > SKIP:
            right, right_y, hits = extended(x[at:a], y[at_y:b])
            out.append((start, at + right, start_y, at_y + right_y, matches + hits))
            # Passages that are shifted against each other may overlap.
            begin, begin_y = (at + right, at_y + right_y) if dx == dy else (start, start_y)
            left, left_y, matches = extended(x[begin:a][::-1], y[begin_y:b][::-1])
            start, start_y = a - left, b - left_y
        else:
            matches += found
        at, at_y = a, b
    right, right_y, hits = extended(x[at:], y[at_y:])
    out.append((start, at + right, start_y, at_y + right_y, matches + hits))
    return out


def long_enough(passage: tuple[int, int, int, int, int], least: int, similarity: float) -> bool:
    a, b, c, d, matches = passage
    return min(b - a, d - c) >= least and matches >= similarity * max(b - a, d - c)


FOUND = "doc_id long, start_word int, end_word int, ref_doc_id long, ref_start_word int, ref_end_word int, agreeing int"


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """doc_id, start_word, end_word, ref_doc_id, ref_start_word, ref_end_word, agreeing, similarity.

    One row per passage of ``least`` words or more that another document, the reference, has
    too, with ``similarity`` of its words in the same order. Word numbers start at 0, ends are
    exclusive. The reference of a seed is the smallest doc_id that has it, so a passage that
    many documents share gives a row per document, not per pair. Where neighbouring seeds have
    different references, two to eight of them in a row also meet at the smallest doc_id that
    has them all, so a verbatim passage whose parts occur in smaller documents is found too.
    An edit within such a row of seeds can hide it, and seeds are sparse: of 60-word
    passages with random substitutions, 0.98, 0.86 and 0.60 are found at a similarity of 0.90, 0.85
    and 0.80.

    Texts that are null, empty or shorter than ``least`` words have no passages, and rows
    without an id can't be named and take no part. Rows that repeat an id and a text are
    one document. Rows that share an id but not the text give the passages that hold for
    either. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("data")).filter("doc_id is not null")

    def sow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Remembered.forget_others("words")
        for batch in batches:
            out = []
            for doc, data in zip(batch["doc_id"].to_numpy(), batch["data"]):
                words = words_of(data)
                if len(words) >= least:
                    s, at = seeds(words)
                    out.append((s.view(np.int64), np.full(len(at), doc), at.astype(np.int32)))
            if out:
                yield pd.DataFrame({n: np.concatenate([o[i] for o in out]) for i, n in enumerate(("seed", "doc_id", "at"))})

    sown = materialize(rows.mapInPandas(sow, "seed long, doc_id long, at int"), "passage-sown")
    n = F.count(F.lit(1)).alias("n")
    shared = sown.groupBy("seed").agg(F.min("doc_id").alias("ref"), F.max("doc_id").alias("last"), n)
    shared = materialize(shared.filter("ref < last").select("seed", "ref", "n"), "passage-shared")
    met = materialize(join_spread(sown, shared, ["seed"], "n"), "passage-seeds")
    there = met.filter("doc_id = ref").groupBy("seed").agg(F.min("at").alias("there"), F.max("n").alias("n"))
    there = materialize(there, "passage-places")
    others = met.filter("doc_id <> ref").drop("n")
    anchors = join_spread(others, there, ["seed"], "n").select("doc_id", "ref", "at", "there")
    rows_of_seeds = materialize(seeds_in_a_row(met), "passage-seed-rows")
    first = rows_of_seeds.groupBy("seed").agg(
        F.min(F.struct("doc_id", "at", "last")).alias("first"), F.max("doc_id").alias("largest"), n
    )
    first = materialize(first.filter("first.doc_id < largest").select("seed", "first", "n"), "passage-first")
    joined = join_spread(rows_of_seeds, first, ["seed"], "n").filter("doc_id <> first.doc_id")
    for end in ("at", "last"):
        anchors = anchors.unionByName(joined.select("doc_id", F.col("first.doc_id").alias("ref"), F.col(end).alias("at"), F.col(f"first.{end}").alias("there")))
    shortest = max(SEED, min(COVERED, least - 2 * (SEED + NEIGHBOURS)))
    # An anchor is one number, its place in the upper half.
    anchor = F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("there").cast("long"))
    reach = [(F.max(c) - F.min(c)).alias(f"{c}_reach") for c in ("at", "there")]
    pairs = anchors.groupBy("doc_id", "ref").agg(F.collect_set(anchor).alias("anchors"), *reach)
    # A passage that agrees in most words has several seeds in common.
    pairs = pairs.filter((F.col("at_reach") >= max(1, shortest - SEED)) & (F.col("there_reach") > 0)).select("doc_id", "ref", "anchors")

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, ref, anchors in zip(batch["doc_id"], batch["ref"], batch["anchors"]):
                found = [c for c in chains([(a >> 32, a & 0xFFFFFFFF) for a in anchors.tolist()]) if len(c) > 1 and c[-1][0] + SEED - c[0][0] >= shortest]
                if found:
                    out.append((doc, ref, [{"chain": i, "at": a, "there": b} for i, c in enumerate(found) for a, b in c]))
            yield pd.DataFrame(out, columns=["doc_id", "ref", "chains"])

    linked = pairs.mapInPandas(link, "doc_id long, ref long, chains array<struct<chain:int,at:int,there:int>>")
    linked = materialize(linked, "passage-chains")
    alive = linked.select("doc_id").unionByName(linked.select(F.col("ref").alias("doc_id"))).distinct()
    alive = materialize(alive, "passage-documents")

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [words_of(data).astype(np.uint32).tobytes() for data in batch["data"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "words": words})

    texts = rows.join(sized(alive), "doc_id", "left_semi").mapInPandas(short, "doc_id long, words binary")
    texts = materialize(texts.dropDuplicates(), "passage-words")
    shares = linked.groupBy("ref").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("shares"))
    heads = shares.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    none = F.array().cast("array<struct<chain:int,at:int,there:int>>")
    heads = heads.join(texts, heads["ref"] == texts["doc_id"]).select(
        "ref", "share", F.lit(0).alias("member"), F.col("ref").alias("doc_id"), none.alias("chains"), "words"
    )
    members = linked.join(shares, "ref").join(texts, "doc_id")
    share = F.pmod(F.xxhash64("doc_id"), F.col("shares")).cast("int")
    members = members.select("ref", share.alias("share"), F.lit(1).alias("member"), "doc_id", "chains", "words")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ref, texts = None, []
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                words = np.frombuffer(row.words, np.uint32)
                if row.member == 0:
                    texts = [*texts, words] if ref == (row.ref, row.share) else [words]
                    ref = row.ref, row.share
                    continue
                for _, links in groupby(row.chains, key=itemgetter("chain")):
                    chain = [(a["at"], a["there"]) for a in links]
                    for y in texts:
                        if chain[-1][0] >= len(words) or chain[-1][1] >= len(y):
                            continue
                        for p in align(words, y, chain):
                            if long_enough(p, least, similarity):
                                out.append((row.doc_id, p[0], p[1], row.ref, *p[2:]))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")])

    dealt = heads.unionByName(members).repartition("ref", "share").sortWithinPartitions("ref", "share", "member")
    found = dealt.mapInPandas(compare, FOUND).dropDuplicates()
    longer = F.greatest(F.col("end_word") - F.col("start_word"), F.col("ref_end_word") - F.col("ref_start_word"))
    return found.withColumn("similarity", F.col("agreeing") / longer)
