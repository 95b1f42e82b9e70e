"""Ranks of all rows of a table by a distributed least-significant-digit radix sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabwright.llm.common import running_total
from tabwright.session import materialize

# Most bits of a digit: a pass has at most 2^13 counts per block, and the table of digit
# totals, the only one ordered as a whole, as many rows.
DIGIT_BITS = 13
# Rows that one count covers, as a power of two, and blocks of a stretch of running totals.
BLOCK_BITS = 12
STRETCH_BITS = 12
SIGN = -(1 << 63)


def digits(rows: DataFrame, keys: Sequence[tuple[str, bool]], most: int = DIGIT_BITS) -> list[Column]:
    """Digits of the composite key, the least significant first.

    ``keys`` are (long column, descending), the most significant first; nulls come last.
    Bits in which no two rows differ, told by each key's least and greatest value, are left out.
    """
    bounds = rows.agg(
        *[f(c).alias(f"{name}_{c}") for c, _ in keys for name, f in (("lo", F.min), ("hi", F.max))],
        *[F.max(F.col(c).isNull()).alias(f"null_{c}") for c, _ in keys],
    ).first()
    fields: list[tuple[Column, int]] = []
    for c, descending in reversed(keys):
        low, high = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
        if low is not None:
            value = F.coalesce(F.col(c), F.lit(low))
            value = F.bitwise_not(value) if descending else value
            # With the sign bit turned over, longs order as unsigned numbers.
            fields.append((value.bitwiseXOR(F.lit(SIGN)), ((low ^ high) & ((1 << 64) - 1)).bit_length()))
        if bounds[f"null_{c}"] and low is not None:
            fields.append((F.col(c).isNull().cast("long"), 1))
    total = sum(bits for _, bits in fields)
    if not total:
        return []
    width = -(-total // -(-total // most))
    out = []
    for begin in range(0, total, width):
        pieces, at = [], 0
        for value, bits in fields:
            lo, hi = max(begin, at), min(begin + width, at + bits)
            if lo < hi:
                piece = F.shiftrightunsigned(value, lo - at).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
                pieces.append(F.shiftleft(piece, lo - begin))
            at += bits
        out.append(sum(pieces[1:], pieces[0]))
    return out


def counting_pass(rows: DataFrame, digit: Column) -> DataFrame:
    """One stable counting sort: ``_pos`` becomes a row's place among all rows by (digit, old place).

    Rows come in blocks ``_block`` and places ``_at`` within them, and ``_bundle`` joins neighbouring blocks.
    A row's destination is the number of rows with smaller digits, plus those with its digit in
    earlier blocks, plus those before it in its own block: two prefix sums over counts and a
    numbering inside (block, digit). No group is larger than a block, however often a digit occurs.
    """
    rows = rows.withColumn("_digit", digit)
    counts = rows.groupBy("_digit", "_bundle", "_block").agg(F.count(F.lit(1)).alias("_n"))
    ahead = running_total(counts, ["_digit"], "_bundle", [F.col("_block")], "_n", "_before")
    totals = counts.groupBy("_digit").agg(F.sum("_n").alias("_n"))
    smaller = W.orderBy("_digit").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select("_digit", F.coalesce(F.sum("_n").over(smaller), F.lit(0)).alias("_start"))
    # As many rows as a digit has values.
    offsets = ahead.join(F.broadcast(starts), "_digit").select("_digit", "_block", (F.col("_start") + F.col("_before")).alias("_offset"))
    inside = W.partitionBy("_digit", "_block").orderBy("_at")
    numbered = rows.withColumn("_local", F.row_number().over(inside) - 1)
    placed = numbered.join(offsets, ["_digit", "_block"])
    return placed.withColumn("_pos", (F.col("_offset") + F.col("_local")).cast("long")).drop(
        "_digit", "_block", "_bundle", "_at", "_offset", "_local"
    )


def radix_ranks(rows: DataFrame, keys: Sequence[tuple[str, bool]], name: str, out: str = "rank") -> DataFrame:
    """``rows`` with each one's rank (from 1, long) in the order of the composite key.

    Passes go over the digits from the least significant, and each keeps the order of its
    predecessor among equal digits, so after the last one the whole key orders the rows. Every
    pass is written to the shared folder and its places are numbers in the table, so a lost
    executor repeats its own tasks only. Rows that agree in the whole key get neighbouring
    ranks in no particular order; nulls come last. An empty table gives no rows.
    """
    spark = rows.sparkSession
    columns = rows.columns
    stored = materialize(rows, name)
    path_hash = F.pmod(F.xxhash64(F.col("_metadata.file_path")), F.lit(1 << 31))
    places = digits(stored, keys)
    # The first order is that of the stored files; which one doesn't matter.
    chunk = F.shiftright(F.col("_metadata.row_index"), BLOCK_BITS)
    current = stored.select(
        *columns,
        path_hash.alias("_bundle"),
        F.shiftleft(path_hash, 32).bitwiseOR(chunk).alias("_block"),
        F.col("_metadata.row_index").alias("_at"),
    )
    for i, digit in enumerate(places or [F.lit(0)]):
        if i:
            current = current.select(
                *columns,
                F.shiftright("_pos", BLOCK_BITS + STRETCH_BITS).alias("_bundle"),
                F.shiftright("_pos", BLOCK_BITS).alias("_block"),
                F.col("_pos").alias("_at"),
            )
        current = materialize(counting_pass(current, digit), f"{name}-pass")
    return current.select(*columns, (F.col("_pos") + 1).alias(out))
