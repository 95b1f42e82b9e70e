"""Removal of repeated byte strings: minimizer runs bring equal strings together, and a
Burrows-Wheeler transform of each meeting is searched breadth-first for long common prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.bpe import one_by_one
from tabwright.llm.common import ship, sized
from tabwright.session import materialize

# Length of the strings whose hash decides where the windows around them meet.
MARK = 64
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_ODD = 0xD1342543DE82EF95
# Bytes of a text that are hashed at a time.
SLICE = 1 << 20
# Bytes that are sorted together.
CHUNK = 1 << 19
# Pieces of one minimizer that one task sorts, and their bytes; beyond either their windows are counted by hash.
MOST_PIECES = 20_000
MOST_BYTES = 1 << 22
# Texts that a task remembers to have cut, so that their copies give nothing.
REMEMBERED = 200_000


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2 ** 64, and their inverses."""
    up = np.full(n, _ODD, np.uint64)
    up[0] = 1
    down = np.full(n, pow(_ODD, -1, 1 << 64), np.uint64)
    down[0] = 1
    return np.cumprod(up), np.cumprod(down)


_UP, _DOWN = _powers(SLICE + 4096)
_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def rolling(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every substring of ``length`` bytes of at most a slice."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * _UP[:n], out=total[1:])
    h = (total[length:] - total[:-length]) * _DOWN[: n - length + 1]
    h ^= h >> np.uint64(32)
    h *= _MULTIPLIER
    h ^= h >> np.uint64(29)
    return h


def sliding(best: np.ufunc, h: np.ndarray, width: int) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours, by doubling."""
    done, out = 1, h
    while done * 2 <= width:
        out = best(out[:-done], out[done:])
        done *= 2
    if done < width:
        more = width - done
        out = best(out[:-more], out[more:])
    return out


def runs(data: bytes, length: int, mark: int = MARK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, minimizer, may it repeat itself) of the runs of a text's windows.

    A window is a string of ``length`` bytes, named by its start; its minimizer is the least
    hash of its substrings of ``mark`` bytes. Equal windows have equal minimizers, so they
    are in runs of the same minimizer. A run is a stretch of windows with one minimizer. It
    can hold a window twice only if that minimizer is at two of its places.
    """
    raw = np.frombuffer(data, np.uint8)
    n = len(raw) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none.astype(bool)
    parts = []
    width = length - mark + 1
    for at in range(0, n, SLICE):
        h = rolling(raw[at : at + min(SLICE, n - at) + length - 1], mark)
        least = sliding(np.minimum, h, width)
        new = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
        size = np.diff(np.append(new, len(least)))
        padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
        padded[width - 1 : width - 1 + len(least)] = least
        places = np.flatnonzero(h == sliding(np.maximum, padded, width))
        ties = np.cumsum(np.append(0, h[places[1:]] == h[places[:-1]]))
        lo = np.searchsorted(places, new)
        hi = np.searchsorted(places, new + size + width - 1)
        parts.append((new + at, size, least[new], ties[hi - 1] > ties[lo]))
    return tuple(np.concatenate(p) for p in zip(*parts))


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` (symbols from 1, 0 only as the last) in the order of their first ``depth`` symbols or more."""
    n = len(text)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = text
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = (key << np.uint64(9)) | padded[j : j + n]
    done = 7
    del padded
    # What is sorted at a time is bounded, so places and ranks are 32-bit numbers.
    order = np.argsort(key, kind="stable").astype(np.int32)
    placed = key[order]
    del key
    new = np.append(False, placed[1:] != placed[:-1])
    del placed
    rank = np.empty(n, np.int32)
    rank[order] = np.cumsum(new, dtype=np.int32)
    while done < depth:
        # Only suffixes that share their rank need another look.
        r = rank[order]
        first = np.flatnonzero(np.append(True, r[1:] != r[:-1])).astype(np.int32)
        size = np.diff(np.append(first, np.int32(n)))
        tied = np.repeat(size > 1, size)
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        part = order[slots]
        later = np.zeros(len(part), np.int32)
        inside = part + done < n
        later[inside] = rank[part[inside] + done] + 1
        both = (np.repeat(first, size)[slots].astype(np.int64) << 32) | later
        by = np.argsort(both, kind="stable")
        both = both[by]
        order[slots] = part[by]
        # A rank is the slot of its first suffix, so that untouched ranks stay valid.
        change = np.append(True, both[1:] != both[:-1])
        lead = slots[np.maximum.accumulate(np.where(change, np.arange(len(slots)), 0))]
        rank[order] = np.repeat(first, size)
        rank[order[slots]] = lead
        done *= 2
    return order


def common_prefix_flags(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order, and whether suffix k shares ``length`` symbols with suffix k - 1.

    An interval of the order holds the suffixes that begin with some string w. Level by
    level, each interval is extended backwards by the symbols before its suffixes, which the
    Burrows-Wheeler transform has at the interval's places. The end of the interval of a
    string of l symbols, if not marked before, is where a common prefix of l - 1 symbols
    ends. Only intervals that marked a new end go on. What is unmarked after ``length``
    levels has a longer common prefix; nothing beyond that length is looked at.
    """
    n = len(text)
    order = suffix_order(text, length + 1)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    before = order - 1
    before[before < 0] = n - 1
    transform = text[before]
    back = place[before]
    symbols, counts = np.unique(text, return_counts=True)
    first, counts = np.cumsum(np.append(0, counts), dtype=np.int32)[:-1], counts.astype(np.int32)
    at_symbol = [np.flatnonzero(transform == s).astype(np.int32) for s in symbols]
    marked = np.zeros(n + 1, bool)
    marked[0] = marked[n] = True
    lo, hi = first.copy(), first + counts
    marked[hi] = True
    for _ in range(1, length):
        size = hi - lo
        if not len(size):
            break
        one, wide = size == 1, size > 2 * len(symbols)
        new_lo, new_hi = [back[lo[one]]], [back[lo[one]] + 1]
        if wide.any():
            for c, at in zip(first, at_symbol):
                a, b = (np.searchsorted(at, x[wide]).astype(np.int32) for x in (lo, hi))
                some = a < b
                new_lo.append(c + a[some])
                new_hi.append(c + b[some])
        few = ~one & ~wide
        if few.any():
            counts_few = size[few]
            total = np.cumsum(counts_few)
            rows = np.arange(total[-1]) + np.repeat(lo[few] - (total - counts_few), counts_few)
            to = back[rows]
            by = np.argsort(to, kind="stable")
            owner = np.repeat(np.arange(len(counts_few)), counts_few)[by]
            to = to[by]
            symbol = transform[rows][by]
            new = np.append(True, (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1]))
            begin = np.flatnonzero(new)
            new_lo.append(to[begin])
            new_hi.append(to[np.append(begin[1:], len(to)) - 1] + 1)
        lo, hi = np.concatenate(new_lo), np.concatenate(new_hi)
        fresh = ~marked[hi]
        lo, hi = lo[fresh], hi[fresh]
        marked[hi] = True
    return order, ~marked[:n]


def repeated_windows(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, whether each of its windows of ``length`` bytes is at another place of the pieces too."""
    sizes = np.array([len(p) for p in pieces])
    begin = np.cumsum(np.append(0, sizes + 1))
    text = np.ones(begin[-1] + 1, np.uint16)
    raw = np.frombuffer(b"\x00".join(pieces) + b"\x00\x00", np.uint8)
    text[:] = raw
    text += 2
    text[begin[1:] - 1] = 1
    text[-1] = 0
    order, shared = common_prefix_flags(text, length)
    found = np.zeros(len(text), bool)
    at = np.flatnonzero(shared)
    found[order[at]] = True
    found[order[at - 1]] = True
    return [found[b : b + max(0, n - length + 1)] for b, n in zip(begin, sizes)]


def content(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


RUNS = "th long, size int, mark long, piece long, start int, windows int, own boolean"


def runs_table(texts: DataFrame, length: int, mark: int) -> DataFrame:
    """Runs of (th, size, text): their minimizer, a hash of their bytes, and where they are."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in one_by_one(batches, "repeats"):
            out, held = [], 0
            for th, data in zip(batch["th"].to_numpy(), batch["data"]):
                start, windows, least, own = runs(data, length, mark)
                ends = start + windows + length - 1
                pieces = [content(data[a:b]) for a, b in zip(start.tolist(), ends.tolist())]
                out.append((np.full(len(start), th), np.full(len(start), len(data)), least.view(np.int64), np.array(pieces, np.int64), start, windows, own))
                held += len(start)
                if held > 50_000:
                    yield _frame(out)
                    out, held = [], 0
            yield _frame(out)

    def _frame(out: list[tuple]) -> pd.DataFrame:
        names = [c.split()[0] for c in RUNS.split(", ")]
        return pd.DataFrame({n: np.concatenate([o[i] for o in out]) if out else [] for i, n in enumerate(names)})

    return texts.filter(F.col("size") >= length).select("th", "data").mapInPandas(make, RUNS)


def pieces_table(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(mark, piece, bytes) of the wanted places; a place whose bytes have another hash is left out.

    A task cuts a text once, however many copies it reads.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, bytes]] = set()
        for batch in one_by_one(batches, "repeats"):
            out = []
            for th, data, places in zip(batch["th"], batch["data"], batch["places"]):
                known = th, xxhash.xxh3_128_digest(data)
                if known in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add(known)
                for p in places:
                    part = data[p["start"] : p["start"] + p["windows"] + length - 1]
                    if content(part) == p["piece"]:
                        out.append((p["mark"], p["piece"], part))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=["mark", "piece", "part"])
                    out = []
            yield pd.DataFrame(out, columns=["mark", "piece", "part"])

    rows = texts.join(wanted, ["th", "size"]).select("th", "data", "places")
    return rows.mapInPandas(cut, "mark long, piece long, part binary")


def ranges_of(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], found.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


RANGES = "mark long, piece long, lo int, hi int"


def shared_ranges(pieces: DataFrame, length: int) -> DataFrame:
    """Windows of pieces that are elsewhere among the pieces of the same minimizer, as ranges."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size, last = 0, None

        def flush() -> pd.DataFrame:
            out = []
            for (mark, piece, _), found in zip(held, repeated_windows([h[2] for h in held], length)):
                out += [(mark, piece, a, b) for a, b in zip(*ranges_of(found))]
            return pd.DataFrame(out, columns=["mark", "piece", "lo", "hi"])

        for batch in one_by_one(batches, "repeats"):
            for row in zip(batch["mark"], batch["piece"], batch["part"]):
                # Copies of a piece come from several tasks.
                if row == last:
                    continue
                last = row
                # Pieces of a minimizer stay together.
                if size >= CHUNK and held[-1][0] != row[0]:
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield flush()

    return pieces.repartition("mark").sortWithinPartitions("mark", "piece").mapInPandas(search, RANGES)


def counted_ranges(pieces: DataFrame, length: int) -> DataFrame:
    """The same by counting 128-bit hashes of windows, for minimizers with very many pieces."""

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for mark, piece, part in zip(batch["mark"], batch["piece"], batch["part"]):
                out += [(mark, piece, i, xxhash.xxh3_128_digest(part[i : i + length])) for i in range(len(part) - length + 1)]
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=["mark", "piece", "lo", "window"])
                    out = []
            yield pd.DataFrame(out, columns=["mark", "piece", "lo", "window"])

    each = materialize(pieces.mapInPandas(windows, "mark long, piece long, lo int, window binary"), "repeat-windows")
    often = each.groupBy("window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("window")
    return each.join(often, "window").select("mark", "piece", "lo", (F.col("lo") + 1).alias("hi"))


def covered(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted union of ranges; those that touch are one."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


def merged(ranges: Column) -> Column:
    @F.pandas_udf("array<struct<lo:int,hi:int>>")
    def run(batch: pd.Series) -> pd.Series:
        return pd.Series([[{"lo": a, "hi": b} for a, b in covered([(r["lo"], r["hi"]) for r in each])] for each in batch])

    return run(ranges)


def text_key(text: Column) -> list[Column]:
    data = F.coalesce(text.cast("binary"), F.lit(b""))
    return [F.xxhash64(data).alias("th"), F.octet_length(data).alias("size"), data.alias("data")]


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = 200, mark: int = MARK, most_pieces: int = MOST_PIECES, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(th, size, spans) of texts with bytes covered by a string of ``length`` bytes that also starts elsewhere.

    Texts are named by a hash and their size; equal texts have equal spans, and each of
    their rows counts as a place of its own. Runs whose minimizer is at one place only are
    unique. Runs of equal bytes are repeated as a whole. Different pieces with the same
    minimizer meet in one task, each once, and their common windows are found there.
    """
    ship(docs.sparkSession)
    mark = min(mark, length)
    texts = docs.select(*text_key(F.col(text_col)))
    all_runs = materialize(runs_table(texts, length, mark), "repeat-runs")
    marks = all_runs.groupBy("mark").agg(
        F.count(F.lit(1)).alias("n"), ((F.min("piece") != F.max("piece")) | F.max("own")).alias("several"), F.max("own").alias("own")
    )
    marks = marks.filter("n > 1 or own").select("mark", "several")
    places = (
        all_runs.join(marks, "mark")
        .groupBy("mark", "piece", "several", "th", "size", "start", "windows")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    places = materialize(places, "repeat-places")
    pieces = materialize(
        places.groupBy("mark", "piece", "windows").agg(
            F.sum("n").alias("n"), F.max("several").alias("several"), F.min(F.struct("th", "size", "start")).alias("at")
        ),
        "repeat-pieces",
    )
    wanted = materialize(
        pieces.filter("several")
        .groupBy("at.th", "at.size")
        .agg(F.collect_list(F.struct("mark", "piece", F.col("at.start").alias("start"), "windows")).alias("places")),
        "repeat-wanted",
    )
    parts = pieces_table(texts, sized(wanted, "places"), length)
    load = pieces.filter("several").groupBy("mark").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("windows").cast("long") + (length - 1)).alias("bytes")
    )
    crowded = materialize(load.filter((F.col("n") > most_pieces) | (F.col("bytes") > most_bytes)).select("mark"), "repeat-crowded")
    if crowded.isEmpty():
        ranges = shared_ranges(parts, length)
    else:
        parts = materialize(parts, "repeat-parts")
        ranges = shared_ranges(parts.join(sized(crowded), "mark", "left_anti"), length).unionByName(
            counted_ranges(parts.join(sized(crowded), "mark", "left_semi").distinct(), length)
        )
    whole = pieces.filter("n > 1").select("mark", "piece", F.lit(0).alias("lo"), F.col("windows").alias("hi"))
    spans = (
        places.select("mark", "piece", "th", "size", "start")
        .join(ranges.unionByName(whole), ["mark", "piece"])
        .select("th", "size", (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi") + (length - 1)).alias("hi"))
        .groupBy("th", "size")
        .agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    )
    return materialize(spans.select("th", "size", merged(F.col("ranges")).alias("spans")), "repeat-spans")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, **settings) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row, and ``kept``, the bytes that stay.

    Every byte covered by a string of ``length`` bytes that starts at two places or more of
    the input, in the same text or another, is removed. Null text is empty; texts shorter
    than ``length`` lose nothing; rows that repeat a text lose all of it. An empty table gives
    no rows. Other columns are not read.
    """
    spans = repeated_spans(docs, text_col, length, **settings)

    @F.pandas_udf("n_removed long, n_spans long, kept_sha256 string, kept binary")
    def apply(data: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, found in zip(data, spans):
            found = [] if found is None else [(r["lo"], r["hi"]) for r in found]
            edges = [0, *(x for r in found for x in r), len(text)]
            kept = b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])])
            out.append((len(text) - len(kept), len(found), hashlib.sha256(kept).hexdigest(), kept))
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256", "kept"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *text_key(F.col(text_col)))
    joined = rows.join(sized(spans, "spans"), ["th", "size"], "left")
    made = joined.select("doc_id", F.col("size").cast("long").alias("n_bytes"), apply("data", "spans").alias("r"))
    return made.select("doc_id", "n_bytes", "r.n_removed", "r.n_spans", "r.kept_sha256", "r.kept")
