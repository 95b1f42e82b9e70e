"""Registered queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabwright.llm import (
    arc_to_warc,
    bpe,
    exact_dedup,
    filter_audit,
    jaccard_join,
    language,
    mixing,
    passages,
    repeats,
    resampling,
    surrogates,
    vector_search,
    wordpiece,
)
from tabwright.llm.common import read_table


# A query needs some key; whoever publishes texts keeps their own one secret.
KEY = "registered query"


def op1_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(read_table(spark, sf_dir, "documents"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.with_surrogates(read_table(spark, sf_dir, "documents"), KEY)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(*mixing.mix(read_table(spark, sf_dir, "documents")))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op5_vector_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(read_table(spark, sf_dir, "embeddings"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.count_tokens(read_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit_corpus(docs))


def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return filter_audit.audit(filter_audit.failures(docs, labels))


def op13_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc_to_warc.through_archives(read_table(spark, sf_dir, "pages"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_fuzzy_passages,
        op2_pii_surrogates,
        op3_mix_sources,
        op4_exact_dedup,
        op5_vector_top_k,
        op6_jaccard_join,
        op7_token_counts,
        op8_language_id,
        op9_repeated_bytes,
        op10_bpe,
        op11_importance_resampling,
        op12_filter_audit,
        op13_arc_to_warc,
    )
}
SQL = {
    "op3_mix_sources": mixing.SQL,
    "op4_exact_dedup": exact_dedup.SQL,
    "op5_vector_top_k": vector_search.SQL,
    "op11_importance_resampling": resampling.SQL,
    "op12_filter_audit": filter_audit.SQL,
    "op13_arc_to_warc": arc_to_warc.SQL,
}
