"""Exact de-duplication: 128-bit content hash, smallest stable id, bytes compared in each group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: The characters that the comparison ignores: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def content_hash(text: Column) -> Column:
    """128 bits of a text's UTF-8 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def _keyed(docs: DataFrame, text: str, doc_id: str, digest: Callable[[Column], Column], *carried: Column) -> DataFrame:
    original = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(
        F.col(f"`{doc_id}`").alias("id"), original.alias("original"), F.translate(original, BLANKS, "").alias("body"), *carried
    ).select("*", digest(F.col("body")).alias("hash"), F.sha2(F.col("body").cast("binary"), 256).alias("sha"))


def _order() -> Column:
    """Most code points first, then the smallest id; a row without an id comes last."""
    return F.struct((-F.length("original")).alias("shorter"), F.col("id").isNull().alias("nameless"), F.col("id").alias("id"))


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                 digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree after the deletion of BLANKS; null counts as empty, and
    all empty texts are one group. Documents meet by (hash, text): the grouping itself compares
    the bytes, so that two texts with one hash stay apart. Copies collapse before the
    shuffle, whatever their number. A row finds its group by hash and SHA-256 in a join whose
    hot keys adaptive execution can split. Rows that repeat an id and its text are one document:
    each comes back, with the same decision. No table row: no row.
    """
    keyed = _keyed(docs, text, doc_id, digest)
    groups = (
        keyed.groupBy("hash", "sha", "body")
        .agg(F.min(_order()).alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", "sha", F.col("best.id").alias("keep_id"), "group_size")
    )
    return (
        keyed.select("id", "hash", "sha").join(groups, ["hash", "sha"])
        .select("id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                F.col("sha").alias("text_sha256"))
    )


def drop_exact_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                      digest: Callable[[Column], Column] = content_hash) -> DataFrame:
    """The documents that stay, with all their columns: one row of every group of equal texts.

    One aggregation with a partial step; rows that repeat an id and its text leave one row.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    kept = _keyed(docs, text, doc_id, digest, row).groupBy("hash", "sha", "body").agg(F.min_by("row", _order()).alias("row"))
    return kept.select("row.*")
