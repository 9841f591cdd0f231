"""The corpus queries by name, and SQL for those that SQL can say."""

from __future__ import annotations

from normspark.llm import encoding, language, lookalikes, markup, near_dup, packing, tokens, vectors

QUERIES = {
    "p1_found": near_dup.found,
    "p1_groups": near_dup.groups,
    "p2_found": markup.residue,
    "p2_clean": markup.cleaned,
    "p2_branches": markup.p2_branches,
    "p3_found": encoding.p3_found,
    "p3_restored": encoding.p3_restored,
    "p6_found": lookalikes.p6_found,
    "p6_forms": lookalikes.p6_forms,
    "p7_found": vectors.p7_found,
    "p7_neighbours": vectors.p7_neighbours,
    "p8_ids": tokens.p8_ids,
    "p8_decoded": tokens.p8_decoded,
    "p9_containers": packing.p9_containers,
    "p9_unused": packing.p9_unused,
    "p10_found": language.p10_found,
    "p10_documents": language.p10_documents,
    "p10_passages": language.p10_passages,
}
_NEAREST = """
WITH u AS (SELECT unit_id, embedding FROM (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY updated_at DESC NULLS LAST) AS rn FROM text_unit WHERE type = 'noi_dung' AND unit_id IS NOT NULL) WHERE rn = 1),
v AS (SELECT unit_id, embedding::DOUBLE[] AS e FROM u WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
w AS (SELECT unit_id, e, sqrt(list_dot_product(e, e)) AS n FROM v),
s AS (SELECT a.unit_id AS a, b.unit_id AS b, round(list_dot_product(a.e, b.e) / a.n / b.n, 12) AS s FROM w a JOIN w b ON a.unit_id <> b.unit_id),
k AS (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS rank FROM s)
"""
ORACLES: dict[str, str] = {
    "p7_found": _NEAREST + "SELECT DISTINCT least(a, b) AS unit_a, greatest(a, b) AS unit_b FROM k WHERE rank <= 5",
    "p7_neighbours": _NEAREST + "SELECT a AS unit_id, CAST(rank AS INTEGER) AS rank, b AS other FROM k WHERE rank <= 5",
    "p8_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
