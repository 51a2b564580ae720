"""Driver queries of the training-data operators, and their SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from hubcat.llm import (
    byte_bpe, exact_dedup, histogram_sort, html_layout, id_store, importance, jaccard_join, pattern_packing, space_curves, suffix_dedup, token_counts,
    toxicity, whitening)
from hubcat.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("*", (F.col("n_tokens") > 512).alias("over_limit"))


def op3_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by bytes; equal texts differ in key, so that a cut may part them."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    key = histogram_sort.sort_key(F.col("doc_id"), F.col("text_crc32"))
    return histogram_sort.histogram_shards(rows, key, F.col("size"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("row.doc_id", toxicity.held_out(F.col("row.doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_space_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return space_curves.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long")
    return cleaned.select("row.doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.octet_length("kept")).alias("n_removed"),
                          F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(_table(spark, sf_dir, "documents"), words=3, part=90).drop("text_hash", "label")


def op9_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract(_table(spark, sf_dir, "pages")).select("page_id", "text", F.length("text").cast("long").alias("n_chars"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_store.document_ids(_table(spark, sf_dir, "documents"), scratch_path(spark, "ids"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_pattern_packing": op1_pattern_packing,
    "op2_token_counts": op2_token_counts,
    "op3_histogram_sort": op3_histogram_sort,
    "op4_toxicity": op4_toxicity,
    "op5_space_curves": op5_space_curves,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_html_layout": op9_html_layout,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_chebyshev_whitening": op11_chebyshev_whitening,
    "op12_id_store": op12_id_store,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE = {
    "op10_exact_dedup": r"""
        with keyed as (
            select doc_id, length(coalesce(text, '')) as n,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body from documents),
        best as (
            select body, count(*) as group_size, min(doc_id) filter (n = longest) as keep_id
            from (select *, max(n) over (partition by body) as longest from keyed) group by body)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256
        from keyed join best using (body)""",
}
