"""Importance resampling towards a target's distribution of hashed words and word pairs."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import ship
from tabwright.llm.radix import radix_ranks
from tabwright.session import materialize

BUCKETS = 10_000
GRAMS = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
# Words of a lower-cased text as UTF-8: digits, a to z and whatever is not ASCII.
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
NO_WORD = re.compile(rb"[^0-9a-z\x80-\xff]")
# Bytes of a text whose words are held at once, and buckets counted at once.
SLICE = 1 << 20


def word_slices(text: str) -> Iterator[list[bytes]]:
    """Words of a whole text, a slice of it at a time; no word is cut."""
    data = text.encode("utf-8", "surrogatepass").lower()
    at = 0
    while at < len(data):
        gap = NO_WORD.search(data, at + SLICE)
        end = gap.start() if gap else len(data)
        yield WORDS.findall(data, at, end)
        at = end


def feature_buckets(text: str, buckets: int = BUCKETS, grams: int = GRAMS) -> Iterator[np.ndarray]:
    """Buckets of all runs of 1 to ``grams`` words, the runs of a length together, slice by slice.

    A run's checksum goes on from that of the run without its last word.
    """
    tail: list[bytes] = []
    for found in word_slices(text):
        words = tail + found
        sums = list(map(crc32, words))
        for k in range(1, grams + 1):
            if k > 1:
                sums = list(map(crc32, words[k - 1 :], map(crc32, repeat(b" "), sums)))
            # Runs that end in the tail were counted with the slice before.
            new = sums[max(0, len(tail) - k + 1) :]
            if new:
                yield np.array(new, np.uint32) % np.uint32(buckets)
        tail = words[len(words) - grams + 1 :] if grams > 1 else []


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, grams: int = GRAMS) -> DataFrame:
    """(bucket, n) over all texts of a table; a task gives at most one row per bucket."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        waiting, size = [], 0
        for batch in batches:
            for text in batch.iloc[:, 0]:
                for found in feature_buckets(text or "", buckets, grams):
                    waiting.append(found)
                    size += len(found)
                if size >= SLICE:
                    total += np.bincount(np.concatenate(waiting), minlength=buckets)
                    waiting, size = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=buckets)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    counted = texts.select(F.col(text_col).cast("string").alias("text")).mapInPandas(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """What a feature of each bucket adds: 1000 times the log of the two smoothed shares' ratio, floored."""
    s_all, t_all = sum(corpus.values()), sum(target.values())
    ratio = lambda b: float(target.get(b, 0) + 1) * float(s_all + buckets) / (float(corpus.get(b, 0) + 1) * float(t_all + buckets))
    return np.array([math.floor(1000 * math.log(ratio(b))) for b in range(buckets)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, text_col: str = "text", grams: int = GRAMS) -> Column:
    """Struct of n_words, n_features and weight (floored mean of the gains) of a text, scored through the array of gains."""
    ship(docs.sparkSession)
    buckets = len(gain)

    @F.pandas_udf("n_words long, n_features long, weight long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                n = total = words = 0
                for i, found in enumerate(feature_buckets(text or "", buckets, grams)):
                    n += len(found)
                    total += int(gain[found].sum())
                # Runs of k words are k - 1 fewer than words, as far as there are any.
                words = next((w for w in range(n // grams, n + 1) if sum(max(0, w - k) for k in range(grams)) == n), 0)
                rows.append((words, n, total // n if n else 0))
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "weight"])

    return run(F.col(text_col).cast("string"))


def luck(id_col: Column, seed: int = SEED) -> Column:
    """Gumbel noise of a document, drawn by a hash of its id, in thousandths, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    buckets: int = BUCKETS,
    grams: int = GRAMS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank, all long.

    A document's weight is the mean gain of its features, and its score adds Gumbel noise, so the
    highest scores are a draw without replacement in proportion to the weights' exponentials.
    Of the documents with ``least_words`` words, ``percent`` per cent are drawn; their ranks come
    from a radix sort by score, then id, then number of features (``radix.radix_ranks``), and the
    others' rank is null. Only the counts of the buckets reach the driver.

    Null and empty texts have no features and weight 0. Null ids share one hash and come last
    among equal scores. Repeated rows are drawn each for itself. Very long texts are read
    in slices. Empty tables of documents give no rows; an empty target has all counts 0.
    Other columns are not read.
    """
    s = {r.bucket: r.n for r in bucket_counts(docs, text_col, buckets, grams).collect()}
    t = {r.bucket: r.n for r in bucket_counts(target, target_col, buckets, grams).collect()}
    gain = gains(s, t, buckets)
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), weights(docs, gain, text_col, grams).alias("w"))
    scored = scored.select("doc_id", "w.n_words", "w.n_features", "w.weight")
    scored = materialize(scored.withColumn("score", F.col("weight") + luck(F.col("doc_id"), seed)), "resample-scores")
    able = F.col("n_words") >= least_words
    drawn = scored.filter(able).count() * percent // 100
    ranked = radix_ranks(scored.filter(able).drop("n_words"), [("score", True), ("doc_id", False), ("n_features", False)], "resample")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    short = scored.filter(~able).drop("n_words").withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(short)


SQL = r"""
with crc_table as (
    select list(list_reduce(range(8), lambda c, i: case when c & 1 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end, b::bigint) order by b) as tab
    from range(256) r(b)),
w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words, true as ours
    from documents
    union all
    select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), false
    from benchmark),
f as (
    select doc_id, ours, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) as feature from w),
u as (select distinct feature, hex(encode(feature)) as code from f),
h as (
    select feature,
           xor(list_reduce(range(0, length(code) // 2),
               lambda c, i: xor(c >> 8, tab[xor(c & 255, ('0x' || substr(code, 2 * i + 1, 2))::bigint) + 1]), 4294967295::bigint), 4294967295::bigint) % 10000 as bucket
    from u, crc_table),
b as (select f.doc_id, f.ours, h.bucket from f join h on h.feature = f.feature),
n as (
    select r.bucket, count(*) filter (ours) as s, count(*) filter (not ours) as t
    from range(10000) r(bucket) left join b on b.bucket = r.bucket group by r.bucket),
g as (
    select bucket, cast(floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)::double / ((s + 1)::double * (sum(t) over () + 10000)::double))) as bigint) as gain
    from n),
d as (select doc_id, cast(floor(sum(gain)::double / count(*)) as bigint) as weight from b join g on g.bucket = b.bucket where ours group by doc_id),
e as (
    select w.doc_id, len(words) as n_words, cast(greatest(0, 2 * len(words) - 1) as bigint) as n_features, coalesce(weight, 0) as weight,
           coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || w.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double))) as bigint) as score
    from w left join d on d.doc_id = w.doc_id where ours),
k as (
    select doc_id, row_number() over (order by score desc, doc_id) as place, 25 * count(*) over () // 100 as drawn
    from e where n_words >= 20)
select e.doc_id, n_features, weight, score, cast(case when place <= drawn then place end as bigint) as rank
from e left join k on k.doc_id = e.doc_id
"""
