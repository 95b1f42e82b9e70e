"""Exact deduplication by a 128-bit content hash, with the bytes compared inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import WHITE, fresh, sized
from tabwright.session import materialize


def normalized(text: Column) -> Column:
    """Each run of white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def md5_bytes(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = md5_bytes
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are. Rows meet by ``digest`` of the text;
    the texts of groups with several rows are then compared whole, through an aggregation
    on (digest, text) that collapses copies before the shuffle. A digest with several
    texts therefore yields several groups.

    Null text counts as empty. A null id is never the smallest one unless its whole group
    has null ids; such a group keeps all its rows. Rows that repeat both id and text are all
    marked alike. Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalized(F.col(text_col)).alias("norm"))
    rows = rows.withColumn("digest", digest(F.col("norm")))
    marks = materialize(
        rows.select("doc_id", "digest", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha")), "exact-marks"
    )
    repeated = materialize(
        marks.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest"), "exact-repeated"
    )
    texts = (
        rows.join(sized(repeated), "digest", "left_semi")
        .groupBy("digest", "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    groups = materialize(
        texts.groupBy("digest").agg(
            F.count(F.lit(1)).alias("n_texts"), F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
        ),
        "exact-groups",
    )
    joined = marks.join(sized(groups), "digest", "left")
    found = joined.filter(F.coalesce(F.col("n_texts"), F.lit(1)) == 1).select("doc_id", "sha", "keep_id", "group_size")
    collided = groups.filter("n_texts > 1").select("digest")
    if not collided.isEmpty():
        mixed = rows.join(collided, "digest", "left_semi")
        apart = texts.join(collided, "digest", "left_semi")
        found = found.unionByName(
            mixed.join(apart, ["digest", "norm"]).select(
                "doc_id", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"), "keep_id", "group_size"
            )
        )
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce(F.col("group_size"), F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is at no smaller id, with all their columns.

    Of rows that repeat both id and text, or share a text and have null ids only, one stays.
    """
    marks = materialize(exact_dedup(docs, id_col, text_col).select("doc_id", "text_sha256", "kept"), "exact-kept")
    counted = marks.groupBy("doc_id", "text_sha256", "kept").agg(F.count(F.lit(1)).alias("n"))
    sha, key, digest, stays = fresh(docs, "_sha", "_id", "_text", "_stays")
    special = materialize(
        counted.filter("not kept or n > 1").select(
            F.col("doc_id").alias(key), F.col("text_sha256").alias(digest), F.col("kept").alias(stays)
        ),
        "exact-special",
    )
    rows = docs.withColumn(sha, F.sha2(normalized(F.col(text_col)).cast("binary"), 256))
    same = F.col(id_col).eqNullSafe(F.col(key)) & (F.col(sha) == F.col(digest))
    kept = rows.join(sized(special), same, "left_anti")
    repeated = special.filter(F.col(stays))
    if not repeated.isEmpty():
        kept = kept.unionByName(rows.join(sized(repeated), same, "left_semi").dropDuplicates([id_col, sha]))
    return kept.drop(sha)


SQL = r"""
with n as (
    select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
    from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id is not distinct from min(doc_id) over w as kept, text_sha256
from n window w as (partition by text_sha256)
"""
