"""Choosing documents: keyword filters, samples, and the content and relations that belong to them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_keyword(title: Column, words: list[str]) -> Column:
    """Whether the lower-case title holds any of the (lower-case) words; false for null and empty titles."""
    t = F.lower(title)
    hit = reduce(lambda a, b: a | b, [t.contains(w) for w in words], F.lit(False))
    return F.coalesce(hit & (title != ""), F.lit(False))


def matched(metadata: DataFrame, words: list[str], limit: int | None = None) -> DataFrame:
    """Metadata of documents with a keyword in the title; with a limit the first by id."""
    m = metadata.filter(has_keyword(F.col("title"), words))
    return m.orderBy(F.col("id")).limit(limit) if limit is not None else m


def content_of(content: DataFrame, ids: DataFrame) -> DataFrame:
    return content.join(ids.select(F.col("id").cast("string").alias("_id")).distinct(), F.col("id").cast("string") == F.col("_id"), "left_semi")


def edges_of(rel: DataFrame, ids: DataFrame) -> DataFrame:
    """Relations with either end among the ids, each row once, with flags ``out_`` and ``in_`` for the ends that are."""
    i = ids.select(F.col("id").cast("string").alias("_id")).distinct()
    a = i.select(F.col("_id").alias("_a"))
    b = i.select(F.col("_id").alias("_b"))
    r = rel.join(a, F.col("doc_id") == F.col("_a"), "left").join(b, F.col("other_doc_id") == F.col("_b"), "left")
    return r.filter("_a is not null or _b is not null").withColumn("out_", F.col("_a").isNotNull()).withColumn("in_", F.col("_b").isNotNull()).drop("_a", "_b")


def filtered(metadata: DataFrame, content: DataFrame, rel: DataFrame, words: list[str], limit: int | None = None) -> dict[str, DataFrame]:
    """The three tables of the documents with a keyword; nothing is written where none has."""
    m = matched(metadata, words, limit)
    return {"metadata": m, "content": content_of(content, m), "relationships": edges_of(rel, m).drop("out_", "in_")}


def with_metadata(ids: DataFrame, metadata: DataFrame) -> DataFrame:
    """Ids with their metadata, null where there is none."""
    return ids.join(metadata, "id", "left")


def attached(rel: DataFrame, ids: DataFrame, limit: int | None = None) -> DataFrame:
    """``owner, other_doc_id, relationship, direction``: a relation belongs to its first document if that is among the ids,
    else to its second. ``limit`` keeps the first rows by row_id in all."""
    e = edges_of(rel, ids)
    e = e.orderBy("row_id").limit(limit) if limit is not None else e
    return e.select(
        "row_id", F.when(F.col("out_"), F.col("doc_id")).otherwise(F.col("other_doc_id")).alias("owner"), F.when(F.col("out_"), F.col("other_doc_id")).otherwise(F.col("doc_id")).alias("other_doc_id"),
        "relationship", F.when(F.col("out_"), "outgoing").otherwise("incoming").alias("direction"),
    )


def sample(metadata: DataFrame, content: DataFrame, n: int) -> DataFrame:
    """The first n documents by id with their page, null where there is none."""
    return metadata.orderBy("id").limit(n).join(content.select("id", "content_html"), "id", "left")


def norms(metadata: DataFrame) -> DataFrame:
    """Metadata as rows of the norm table: names of the model, ids as strings, nulls of the three leading texts as ''."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return metadata.select(
        F.col("id").cast("string").alias("norm_id"), text("title").alias("title"), text("so_ky_hieu").alias("norm_number"), text("loai_van_ban").alias("norm_type"), F.col("ngay_ban_hanh").alias("published_date"),
        F.col("ngay_co_hieu_luc").alias("valid_from"), F.col("ngay_het_hieu_luc").alias("valid_to"), F.col("co_quan_ban_hanh").alias("publisher"), F.col("nguoi_ky").alias("signer"),
        F.col("tinh_trang_hieu_luc").alias("validity_status"), F.col("nganh").alias("sector"), F.col("linh_vuc").alias("field"),
    )
