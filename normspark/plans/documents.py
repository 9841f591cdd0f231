"""Queries that choose documents and resolve their relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from normspark import schemas as S
from normspark.operators import extract, relations
from normspark.operators.records import latest
from normspark.session import table

WORDS = ["kế hoạch", "môi trường", "giá dịch vụ công"]
_IN = "(" + " OR ".join(f"contains(lower(title), '{w}')" for w in WORDS) + ")"
_META = "m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, coalesce(title, '')) AS rn FROM metadata) WHERE rn = 1)"
_CONTENT = "c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST) AS rn FROM content) WHERE rn = 1)"
_HIT = f"h AS (SELECT DISTINCT CAST(id AS VARCHAR) AS id FROM m WHERE title <> '' AND {_IN})"


def _meta(s, d):
    return latest(table(s, d, "metadata"), "id", "loaded_at", F.coalesce("title", F.lit("")))


def _content(s, d):
    return latest(table(s, d, "content"), "id", "loaded_at", F.xxhash64("content_html"))


def norm_projection(s, d):
    return extract.norms(_meta(s, d))


def keyword_filter(s, d):
    return extract.matched(_meta(s, d), WORDS).select("id", "title")


def keyword_first(s, d):
    """The limit is the feature: the first ten matches by id."""
    return extract.matched(_meta(s, d), WORDS, 10).select("id", "title")


def content_semi_join(s, d):
    return extract.content_of(_content(s, d), extract.matched(_meta(s, d), WORDS)).select("id", F.length("content_html").cast("long").alias("chars"))


def edge_filter(s, d):
    return extract.edges_of(table(s, d, "relationships"), extract.matched(_meta(s, d), WORDS)).select("row_id", "doc_id", "other_doc_id", "out_", "in_")


def attached_relations(s, d):
    return extract.attached(table(s, d, "relationships"), extract.matched(_meta(s, d), WORDS))


def attached_first(s, d):
    """The limit is the feature: a cap on attached relations, first by row_id."""
    return extract.attached(table(s, d, "relationships"), extract.matched(_meta(s, d), WORDS), 50)


def nested_documents(s, d):
    """One row per matching document with its relations as an array of structs (as JSON)."""
    m = extract.matched(_meta(s, d), WORDS).select(F.col("id").cast("string").alias("owner"), "title")
    a = extract.attached(table(s, d, "relationships"), m.select(F.col("owner").alias("id")))
    a = a.groupBy("owner").agg(F.array_sort(F.collect_list(F.struct("row_id", "other_doc_id", "relationship", "direction"))).alias("r"))
    return m.join(a, "owner", "left").select("owner", "title", F.to_json(F.coalesce(F.col("r"), F.array().cast("array<struct<row_id:bigint,other_doc_id:string,relationship:string,direction:string>>")), {"ignoreNullFields": "false"}).alias("relationships"))


def sample_first(s, d):
    """The sample is the feature: the first 20 documents by id with their page."""
    return extract.sample(_meta(s, d).select("id", "title"), _content(s, d), 20).select("id", "title", F.length("content_html").cast("long").alias("chars"))


def metadata_without_content(s, d):
    return _meta(s, d).join(_content(s, d), "id", "left_anti").select("id", "title")


def content_left_default(s, d):
    return _meta(s, d).join(_content(s, d).select("id", "content_html"), "id", "left").select("id", F.length(F.coalesce("content_html", F.lit(""))).cast("long").alias("chars"))


def content_latest(s, d):
    return _content(s, d).select("id", F.md5("content_html").alias("digest"))


def relation_resolution(s, d):
    return relations.relations(table(s, d, "relationships")).select("row_id", "from_norm_id", "to_norm_id", "relation_type", relations.eligible(F.col("relation_type")).alias("eligible"))


def relation_counts(s, d):
    return relations.relations(table(s, d, "relationships")).groupBy("relation_type").agg(F.count("*").alias("n"))


def unknown_labels(s, d):
    return relations.rejected(table(s, d, "relationships")).groupBy("relationship").agg(F.count("*").alias("n"))


def layer_b_gate(s, d):
    """Eligible relations whose target has a component."""
    known = table(s, d, "component").select(F.col("norm_id").alias("to_norm_id")).distinct()
    r = relations.relations(table(s, d, "relationships")).filter(relations.eligible(F.col("relation_type")))
    return r.join(known, "to_norm_id", "left_semi").select("row_id", "from_norm_id", "to_norm_id", "relation_type")


def norm_number_fallback(s, d):
    n = _meta(s, d).select(F.col("id").cast("string").alias("from_norm_id"), "so_ky_hieu")
    r = relations.relations(table(s, d, "relationships")).join(n, "from_norm_id", "left")
    return r.select("row_id", F.coalesce(F.nullif("so_ky_hieu", F.lit("")), "from_norm_id").alias("amending_doc_number"))


QUERIES = {f.__name__: f for f in (norm_projection, keyword_filter, keyword_first, content_semi_join, edge_filter, attached_relations, attached_first, nested_documents, sample_first, metadata_without_content, content_left_default, content_latest, relation_resolution, relation_counts, unknown_labels, layer_b_gate, norm_number_fallback)}

_MAP = "l(label, kind, back) AS (VALUES " + ", ".join(f"('{a}', '{k}', {str(b).lower()})" for a, k, b in S.LABELS) + ")"
_STRIP = r"regexp_replace(relationship, '^\s+|\s+$', '', 'g')"
_REL = f"""{_MAP}, r0 AS (SELECT r.*, l.kind AS relation_type, CASE WHEN back THEN other_doc_id ELSE doc_id END AS from_norm_id, CASE WHEN back THEN doc_id ELSE other_doc_id END AS to_norm_id
  FROM relationships r LEFT JOIN l ON l.label = {_STRIP}),
r AS (SELECT * FROM r0 WHERE relation_type IS NOT NULL AND from_norm_id <> to_norm_id)"""
_ELIGIBLE = "(" + ", ".join(f"'{x}'" for x in S.ELIGIBLE) + ")"
_EDGES = "e AS (SELECT r.*, doc_id IN (SELECT id FROM h) AS out_, other_doc_id IN (SELECT id FROM h) AS in_ FROM relationships r), f AS (SELECT * FROM e WHERE coalesce(out_, false) OR coalesce(in_, false))"
_OWNED = "SELECT row_id, CASE WHEN out_ THEN doc_id ELSE other_doc_id END AS owner, CASE WHEN out_ THEN other_doc_id ELSE doc_id END AS other_doc_id, relationship, CASE WHEN out_ THEN 'outgoing' ELSE 'incoming' END AS direction FROM f"

ORACLES = {
    "norm_projection": f"WITH {_META} SELECT CAST(id AS VARCHAR) AS norm_id, coalesce(title, '') AS title, coalesce(so_ky_hieu, '') AS norm_number, coalesce(loai_van_ban, '') AS norm_type, ngay_ban_hanh AS published_date, ngay_co_hieu_luc AS valid_from, ngay_het_hieu_luc AS valid_to, co_quan_ban_hanh AS publisher, nguoi_ky AS signer, tinh_trang_hieu_luc AS validity_status, nganh AS sector, linh_vuc AS field FROM m",
    "keyword_filter": f"WITH {_META} SELECT id, title FROM m WHERE title <> '' AND {_IN}",
    "keyword_first": f"WITH {_META} SELECT id, title FROM m WHERE title <> '' AND {_IN} ORDER BY id LIMIT 10",
    "content_semi_join": f"WITH {_META}, {_CONTENT}, {_HIT} SELECT id, length(content_html) AS chars FROM c WHERE CAST(id AS VARCHAR) IN (SELECT id FROM h)",
    "edge_filter": f"WITH {_META}, {_HIT}, {_EDGES} SELECT row_id, doc_id, other_doc_id, coalesce(out_, false) AS out_, coalesce(in_, false) AS in_ FROM f",
    "attached_relations": f"WITH {_META}, {_HIT}, {_EDGES} {_OWNED}",
    "attached_first": f"WITH {_META}, {_HIT}, {_EDGES} {_OWNED} ORDER BY row_id LIMIT 50",
    "nested_documents": f"""WITH {_META}, {_HIT}, {_EDGES}, o AS ({_OWNED}), j AS (SELECT owner, list(struct_pack(row_id := row_id, other_doc_id := other_doc_id, relationship := relationship, direction := direction) ORDER BY row_id) AS r FROM o GROUP BY 1)
      SELECT CAST(m.id AS VARCHAR) AS owner, title, CASE WHEN r IS NULL THEN '[]' ELSE CAST(to_json(r) AS VARCHAR) END AS relationships FROM m LEFT JOIN j ON j.owner = CAST(m.id AS VARCHAR) WHERE CAST(m.id AS VARCHAR) IN (SELECT id FROM h)""",
    "sample_first": f"WITH {_META}, {_CONTENT}, n AS (SELECT id, title FROM m ORDER BY id LIMIT 20) SELECT n.id, n.title, length(content_html) AS chars FROM n LEFT JOIN c USING (id)",
    "metadata_without_content": f"WITH {_META} SELECT id, title FROM m WHERE id NOT IN (SELECT id FROM content WHERE id IS NOT NULL)",
    "content_left_default": f"WITH {_META}, {_CONTENT} SELECT m.id, length(coalesce(content_html, '')) AS chars FROM m LEFT JOIN c USING (id)",
    "content_latest": f"WITH {_CONTENT} SELECT id, md5(content_html) AS digest FROM c",
    "relation_resolution": f"WITH {_REL} SELECT row_id, from_norm_id, to_norm_id, relation_type, relation_type IN {_ELIGIBLE} AS eligible FROM r",
    "relation_counts": f"WITH {_REL} SELECT relation_type, count(*) AS n FROM r GROUP BY 1",
    "unknown_labels": f"WITH {_REL} SELECT relationship, count(*) AS n FROM r0 WHERE relation_type IS NULL GROUP BY 1",
    "layer_b_gate": f"WITH {_REL} SELECT row_id, from_norm_id, to_norm_id, relation_type FROM r WHERE relation_type IN {_ELIGIBLE} AND to_norm_id IN (SELECT norm_id FROM component)",
    "norm_number_fallback": f"WITH {_META}, {_REL} SELECT row_id, coalesce(nullif(so_ky_hieu, ''), from_norm_id) AS amending_doc_number FROM r LEFT JOIN m ON CAST(m.id AS VARCHAR) = r.from_norm_id",
}
