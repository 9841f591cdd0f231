"""Queries on the graph tables: edges, merges, reachability, sizes, budgets; retrieval; reports and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from normspark.functions import html
from normspark.functions import text as X
from normspark.operators import graph, hierarchy, quality, relations, vector
from normspark.operators.records import latest
from normspark.session import cut, spread, table



def _norms(s, d):
    return latest(table(s, d, "metadata").select("id", "title", "so_ky_hieu", "loaded_at"), "id", "loaded_at", F.coalesce("title", F.lit(""))).select(F.col("id").cast("string").alias("norm_id"), "title", F.col("so_ky_hieu").alias("norm_number"))


def _components(s, d):
    return latest(table(s, d, "component"), "comp_id", "updated_at", F.xxhash64("parent_comp_id", "citation", "order_index"))


def _units(s, d):
    """The latest row of each unit; of rows of one moment one with a vector."""
    return latest(table(s, d, "text_unit"), "unit_id", "updated_at", F.col("embedding").isNull().cast("int"))


def _links(s, d):
    """apply_to as action links: the first component that has an action is its source, the one it applies to its target."""
    a = table(s, d, "apply_to").filter("comp_id is not null")
    t = a.select("action_id", X.strip(F.col("comp_id")).alias("comp_b_id")).filter("comp_b_id <> ''").distinct()
    return t


# ---- edges ------------------------------------------------------------------------------------------------------------------------


def contains_edges(s, d):
    return graph.contains_edges(_components(s, d), _norms(s, d))


def has_textunit_edges(s, d):
    return graph.has_textunit_edges(table(s, d, "text_unit").select("unit_id", "type"))


def apply_to_edges(s, d):
    """Action to component, once each, where both exist."""
    c = _components(s, d).select(F.col("comp_id").alias("comp_b_id"))
    a = table(s, d, "norm_action").select("action_id").distinct()
    return _links(s, d).join(a, "action_id", "left_semi").join(c, "comp_b_id", "left_semi").select(F.col("action_id").alias("src"), F.col("comp_b_id").alias("dst"))


def relation_edges(s, d):
    return graph.relation_edges(relations.relations(table(s, d, "relationships")), _norms(s, d))


def merged_norms(s, d):
    return graph.merged(table(s, d, "metadata").select("id", "so_ky_hieu", "loaded_at"), ["id"], "loaded_at")


def graph_counts(s, d):
    """Nodes and edges by kind."""
    one = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("kind"), "n")
    parts = [
        one("Norm", _norms(s, d)), one("Component", _components(s, d)), one("TextUnit", _units(s, d).filter("type <> 'cache_action'")), one("CacheUnit", _units(s, d).filter("type = 'cache_action'")),
        one("Action", table(s, d, "norm_action").select("action_id").distinct()), one("CONTAINS", contains_edges(s, d)), one("HAS_TEXTUNIT", has_textunit_edges(s, d)), one("APPLY_TO", apply_to_edges(s, d)), one("RELATION", relation_edges(s, d)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def budget_trim(s, d):
    """The budget is the feature: components that fit into 500 nodes, by id."""
    return graph.within_budget(_components(s, d).select("comp_id"), ["comp_id"], 500)


def budget_trim_edges(s, d):
    """Links at two edges each within 300 edges."""
    return graph.within_budget(_links(s, d), ["action_id", "comp_b_id"], 300, 2)


def orphans(s, d):
    """Components that no path from a document reaches."""
    c = cut(_components(s, d), "components")
    h = hierarchy.hierarchy(c.select("comp_id", F.col("parent_comp_id").alias("parent"), "citation"), paths=False)
    blank = F.regexp_replace("parent_comp_id", r"(?U)\s+", "")
    c = c.withColumn("parent_comp_id", F.when(blank != "", F.col("parent_comp_id")))
    return graph.unreached(c, h, _norms(s, d))


def ancestor_chains(s, d):
    """Each component with a parent: its ancestors from the root down, as a path of ids (below a loop, from its member down; members left out)."""
    c = cut(_components(s, d).select("comp_id", F.col("parent_comp_id").alias("parent"), "citation"), "components")
    a = hierarchy.descendants(c, cut(hierarchy.hierarchy(c, paths=False), "resolved"))
    p = a.groupBy("descendant").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(-F.col("distance"), F.col("comp_id")))), lambda x: x["comp_id"]), " > ").alias("path"))
    return p.select(F.col("descendant").alias("comp_id"), "path")


# ---- retrieval --------------------------------------------------------------------------------------------------------------------


def _query(s, d) -> list[float]:
    """One vector, as a question's: that of embeddings row 0."""
    return list(table(s, d, "embeddings").orderBy("vec_id").first()["embedding"])


def vector_top_k(s, d):
    """The k is the feature: the ten nearest vectors of ``embeddings``."""
    return vector.top_k(table(s, d, "embeddings"), _query(s, d), 10, "vec_id").select("vec_id", F.round("score", 6).alias("score"))


def vector_top_k_after(s, d):
    """Ten nearest, then only labels below 5: may be fewer than ten."""
    return vector.top_k(table(s, d, "embeddings"), _query(s, d), 10, "vec_id", then=F.col("label") < 5).select("vec_id", F.round("score", 6).alias("score"))


def vector_top_k_first(s, d):
    return vector.top_k(table(s, d, "embeddings"), _query(s, d), 10, "vec_id", first=F.col("label") < 5).select("vec_id", F.round("score", 6).alias("score"))


def retrieve(s, d):
    """The five units nearest to a question, with document and citation."""
    c = _components(s, d).select("comp_id", "norm_id", "citation")
    return vector.retrieve(_units(s, d), c, _norms(s, d), lambda _: _query(s, d), "câu hỏi").select("text", F.round("score", 6).alias("score"), "norm_title", "citation")


def embed_pending(s, d):
    return vector.pending(_units(s, d)).select("unit_id")


def embed_unembeddable(s, d):
    return vector.unembeddable(_units(s, d)).select("unit_id", "error_log")


def embed_resumed(s, d):
    """After a job that broke off half way and one that went on: how many units have a vector, by what they had before."""
    u = cut(_units(s, d), "units")
    first = cut(vector.embedded(vector.pending(u).filter(F.xxhash64("unit_id") % 2 == 0)), "embedded")
    new = first.unionByName(vector.embedded(vector.pending(u, first)))
    e = vector.with_embeddings(u, new).select("unit_id", "type", F.col("embedding").isNotNull().alias("now"))
    return e.groupBy("type", "now").agg(F.count("*").alias("n"))


def embed_unknown_errors(s, d):
    """Errors of units that are no longer there."""
    u = cut(_units(s, d).select("unit_id", "error_log"), "units")
    bad = u.filter("error_log is not null").select("unit_id")
    _, gone = vector.retried(u, bad.unionByName(bad.select(F.concat(F.lit("gone-"), "unit_id").alias("unit_id"))))
    return gone


def embed_retry(s, d):
    """Units whose last attempt left an error, to be embedded again."""
    u = _units(s, d)
    again, _ = vector.retried(u, u.filter("error_log is not null").select("unit_id"))
    return again.select("unit_id")


# ---- reports ----------------------------------------------------------------------------------------------------------------------


def _content_units(s, d):
    return _units(s, d).filter("type = 'noi_dung'").select("unit_id", "accumulated_text", "type", "embedding")


def quality_report(s, d):
    return quality.report(_content_units(s, d))


def quality_examples(s, d):
    """The first three units of each format class (the three are the feature)."""
    from pyspark.sql import Window

    f = quality.flagged(_content_units(s, d))
    return f.withColumn("r", F.row_number().over(Window.partitionBy("format").orderBy("unit_id"))).filter("r <= 3").select("format", "unit_id")


def leaf_coverage(s, d):
    return quality.leaf_coverage(_components(s, d), table(s, d, "text_unit").select("unit_id", "type"))


def two_ended_actions(s, d):
    """Actions by whether they have a source (a copy of a text made for them) and a target."""
    src = table(s, d, "text_unit").filter("type = 'cache_action'").select(F.regexp_extract("unit_id", r"(action-[0-9a-f]+)", 1).alias("action_id"))
    return quality.one_ended(table(s, d, "norm_action"), src, _links(s, d))


def short_units(s, d):
    return quality.short_units(_units(s, d))


def reversed_citations(s, d):
    return quality.reversed_citations(_components(s, d))


def embedded_share(s, d):
    return quality.embedded_share(_units(s, d))


def norm_reach(s, d):
    """Units by whether their component, its document and the document's number are there."""
    u = _units(s, d).filter("type = 'noi_dung'").select("unit_id", graph.unit_owner(F.col("unit_id")).alias("comp_id"))
    u = u.join(_components(s, d).select("comp_id", "norm_id"), "comp_id", "left").join(_norms(s, d), "norm_id", "left")
    return u.agg(F.count("*").alias("units"), F.count("norm_id").alias("with_component"), F.count("title").alias("with_title"), F.count_if(F.coalesce("norm_number", F.lit("")) != "").alias("with_number"))


def html_lines(s, d):
    """Pages as plain lines: number of lines and of tables."""
    c = latest(table(s, d, "content").select("id", "content_html", "loaded_at"), "id", "loaded_at", F.xxhash64("content_html"))
    c = html.converted(c.drop("loaded_at"))
    return c.select("id", F.when(F.col("markdown") == "", 0).otherwise(F.size(F.split("markdown", "\n"))).cast("long").alias("lines"), X.prose_tables(F.col("markdown")).cast("long").alias("tables"), "convert_error")


def html_tables(s, d):
    """The tables of every page as prose: page, number of tables and of lines, header lines."""
    c = latest(table(s, d, "content"), "id", "loaded_at", F.xxhash64("content_html")).select("id", "content_html")
    t = html.converted(spread(c)).select("id", "convert_error", F.split("markdown", "\n").alias("lines"))
    heads = F.filter("lines", lambda x: x.startswith("Bảng ["))
    return t.select("id", F.size("lines").cast("long").alias("lines"), F.size(heads).cast("long").alias("tables"), heads.alias("headers"), "convert_error")


def header_splits(s, d):
    """The lines of every page that hold more than one marker, broken at these."""
    c = latest(table(s, d, "content"), "id", "loaded_at", F.xxhash64("content_html")).select("id", "content_html")
    t = html.converted(spread(c)).select("id", F.posexplode(F.split("markdown", "\n")).alias("at", "line"))
    return t.select("id", "at", F.array_join(X.split_at_headers(F.col("line")), "|").alias("pieces")).filter(F.col("pieces").contains("|"))


def fallback_share(s, d):
    return quality.fallbacks(_components(s, d))


QUERIES = {f.__name__: f for f in (
    contains_edges, has_textunit_edges, apply_to_edges, relation_edges, merged_norms, graph_counts, budget_trim, budget_trim_edges, orphans, ancestor_chains, vector_top_k, vector_top_k_after, vector_top_k_first, retrieve,
    embed_pending, embed_unembeddable, embed_resumed, embed_retry, embed_unknown_errors, quality_report, quality_examples, leaf_coverage, two_ended_actions, short_units, reversed_citations, embedded_share, norm_reach, html_lines, html_tables, header_splits, fallback_share,
)}

_K = "k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY comp_id ORDER BY updated_at DESC NULLS LAST) AS rn FROM component WHERE comp_id IS NOT NULL) WHERE rn = 1)"
_M = "m AS (SELECT CAST(id AS VARCHAR) AS norm_id, title, so_ky_hieu AS norm_number FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, coalesce(title, '')) AS rn FROM metadata) WHERE rn = 1)"
_U = "u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY updated_at DESC NULLS LAST, (embedding IS NULL)::INT) AS rn FROM text_unit WHERE unit_id IS NOT NULL) WHERE rn = 1)"
_B = "b AS (SELECT DISTINCT action_id, trim(comp_id) AS comp_b_id FROM apply_to WHERE trim(comp_id) <> '')"
_CONTAINS = "ce AS (SELECT DISTINCT k.norm_id AS src, k.comp_id AS dst FROM k JOIN m USING (norm_id) WHERE parent_comp_id IS NULL UNION SELECT DISTINCT k.parent_comp_id, k.comp_id FROM k JOIN k p ON p.comp_id = k.parent_comp_id)"
_HAS = "he AS (SELECT DISTINCT regexp_replace(unit_id, '__tu(__p[0-9]+)?$', '') AS src, unit_id AS dst FROM text_unit WHERE type IS NULL OR type <> 'cache_action')"
_APPLY = "ae AS (SELECT action_id AS src, comp_b_id AS dst FROM b WHERE action_id IN (SELECT action_id FROM norm_action) AND comp_b_id IN (SELECT comp_id FROM k))"
_STRIP = r"regexp_replace(accumulated_text, '^[\s\x{a0}\x{2000}-\x{200a}\x{202f}\x{3000}]+|[\s\x{a0}\x{2000}-\x{200a}\x{202f}\x{3000}]+$', '', 'g')"
_NEAR = "e AS (SELECT vec_id, label, list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings ORDER BY vec_id LIMIT 1)) AS s FROM embeddings)"
_BODY = r"regexp_replace(regexp_replace(accumulated_text, '^\[[^\]]*\](\n+|$)', ''), '^[\s\x{a0}\x{2000}-\x{200a}\x{202f}\x{3000}]+|[\s\x{a0}\x{2000}-\x{200a}\x{202f}\x{3000}]+$', '', 'g')"
_FORMAT = r"CASE WHEN accumulated_text IS NULL THEN 'null_text' WHEN NOT regexp_matches(accumulated_text, '^\[[^\]]*\](\n|$)') THEN 'no_header' WHEN regexp_matches(regexp_extract(accumulated_text, '^\[([^\]]*)\]', 1), '[>→]') THEN 'ok' ELSE 'header_no_separator' END"

from normspark.plans.documents import _REL  # noqa: E402
from normspark.plans.keys import _BELOW, _TREE  # noqa: E402

_RE = f"{_REL}, re AS (SELECT DISTINCT from_norm_id, to_norm_id, relation_type FROM r WHERE from_norm_id IN (SELECT norm_id FROM m) AND to_norm_id IN (SELECT norm_id FROM m))"
_FLAGS = f"""{_U}, v AS (SELECT unit_id, accumulated_text AS t, {_FORMAT} AS format, length({_BODY}) AS n, len(regexp_extract_all(accumulated_text, '(?m)^Bảng \\[')) AS tables,
  contains(accumulated_text, chr(65533)) AS replacement, regexp_matches(accumulated_text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]') AS control,
  regexp_matches(accumulated_text, '(?m)^[ \\t]*\\|.+\\|') AND regexp_matches(accumulated_text, '(?m)^[ \\t]*\\|[ \\t\\-|:]+\\|[ \\t]*$') AS pipe_table, regexp_matches(accumulated_text, '(?m)^Bảng \\[\\]:') AS empty_header FROM u WHERE type = 'noi_dung')"""

ORACLES = {
    "contains_edges": f"WITH {_K}, {_M}, {_CONTAINS} SELECT * FROM ce",
    "has_textunit_edges": f"WITH {_HAS} SELECT * FROM he",
    "apply_to_edges": f"WITH {_K}, {_B}, {_APPLY} SELECT * FROM ae",
    "relation_edges": f"WITH {_M}, {_RE} SELECT * FROM re",
    "merged_norms": "SELECT id, so_ky_hieu, loaded_at FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST) AS rn FROM metadata WHERE id IS NOT NULL) WHERE rn = 1",
    "graph_counts": f"WITH {_K}, {_M}, {_U}, {_B}, {_CONTAINS}, {_HAS}, {_APPLY}, {_RE} SELECT 'Norm' AS kind, count(*) AS n FROM m UNION ALL SELECT 'Component', count(*) FROM k UNION ALL SELECT 'TextUnit', count(*) FROM u WHERE type <> 'cache_action' UNION ALL SELECT 'CacheUnit', count(*) FROM u WHERE type = 'cache_action' UNION ALL SELECT 'Action', count(DISTINCT action_id) FROM norm_action UNION ALL SELECT 'CONTAINS', count(*) FROM ce UNION ALL SELECT 'HAS_TEXTUNIT', count(*) FROM he UNION ALL SELECT 'APPLY_TO', count(*) FROM ae UNION ALL SELECT 'RELATION', count(*) FROM re",
    "budget_trim": f"WITH {_K} SELECT comp_id FROM k ORDER BY comp_id LIMIT 500",
    "budget_trim_edges": f"WITH {_B} SELECT action_id, comp_b_id FROM b ORDER BY action_id, comp_b_id LIMIT 150",
    "orphans": _TREE + ", o AS (SELECT comp_id FROM (SELECT *, row_number() OVER (PARTITION BY comp_id ORDER BY updated_at DESC NULLS LAST) AS rn FROM component) k WHERE rn = 1 AND coalesce(trim(parent_comp_id), '') = '' AND norm_id IN (SELECT CAST(id AS VARCHAR) FROM metadata)) SELECT comp_id FROM r WHERE depth < 0 OR root_comp_id NOT IN (SELECT comp_id FROM o)",
    "fallback_share": "SELECT count(*) AS components, count(*) FILTER (contains(citation, '_FULL_')) AS fallback, round(100.0 * count(*) FILTER (contains(citation, '_FULL_')) / count(*), 1) AS pct, 100.0 * count(*) FILTER (contains(citation, '_FULL_')) / count(*) > 5 AS flagged FROM (SELECT citation, row_number() OVER (PARTITION BY comp_id ORDER BY updated_at DESC NULLS LAST) AS rn FROM component WHERE comp_id IS NOT NULL) WHERE rn = 1",
    "ancestor_chains": _BELOW + "SELECT descendant AS comp_id, string_agg(comp_id, ' > ' ORDER BY distance DESC) AS path FROM b GROUP BY 1",
    "vector_top_k": f"WITH {_NEAR} SELECT vec_id, round(s, 6) AS score FROM e ORDER BY s DESC, vec_id LIMIT 10",
    "vector_top_k_after": f"WITH {_NEAR} SELECT vec_id, round(s, 6) AS score FROM (SELECT * FROM e ORDER BY s DESC, vec_id LIMIT 10) WHERE label < 5",
    "vector_top_k_first": f"WITH {_NEAR} SELECT vec_id, round(s, 6) AS score FROM e WHERE label < 5 ORDER BY s DESC, vec_id LIMIT 10",
    "retrieve": f"""WITH {_U}, {_K}, {_M}, q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings ORDER BY vec_id LIMIT 1),
      n AS (SELECT u.*, list_dot_product(embedding::DOUBLE[], v) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) / sqrt(list_dot_product(v, v)) AS s FROM u, q WHERE len(embedding) = len(v) AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
      t AS (SELECT * FROM n WHERE NOT isnan(s) ORDER BY s DESC, unit_id LIMIT 5) SELECT accumulated_text AS text, round(s, 6) AS score, m.title AS norm_title, k.citation FROM t JOIN k ON k.comp_id = regexp_replace(unit_id, '__tu(__p[0-9]+)?$', '') JOIN m USING (norm_id) WHERE type <> 'cache_action'""",
    "embed_pending": f"WITH {_U} SELECT unit_id FROM u WHERE type <> 'cache_action' AND embedding IS NULL AND {_STRIP} <> ''",
    "embed_unembeddable": f"WITH {_U} SELECT unit_id, 'empty text' AS error_log FROM u WHERE type <> 'cache_action' AND embedding IS NULL AND coalesce({_STRIP}, '') = ''",
    "embed_unknown_errors": f"WITH {_U} SELECT 'gone-' || unit_id AS unit_id FROM u WHERE error_log IS NOT NULL",
    "embed_resumed": f"WITH {_U} SELECT type, embedding IS NOT NULL OR (type <> 'cache_action' AND coalesce({_STRIP}, '') <> '') AS now, count(*) AS n FROM u GROUP BY 1, 2",
    "embed_retry": f"WITH {_U} SELECT unit_id FROM u WHERE error_log IS NOT NULL",
    "quality_report": f"""WITH {_FLAGS}, c AS (SELECT count(*) AS total FROM v),
      g AS (SELECT 'format' AS section, format AS metric, count(*) AS value FROM v GROUP BY 2
      UNION ALL SELECT 'length', CASE WHEN n = 0 THEN '0' WHEN n < 20 THEN '<20' WHEN n < 100 THEN '20-100' WHEN n < 1000 THEN '100-1000' ELSE '>1000' END, count(*) FROM v WHERE t IS NOT NULL GROUP BY 2
      UNION ALL SELECT 'tables', CASE WHEN tables >= 5 THEN '>=5' ELSE CAST(coalesce(tables, 0) AS VARCHAR) END, count(*) FROM v GROUP BY 2
      UNION ALL SELECT 'flags', f, count(*) FROM (SELECT unnest([CASE WHEN replacement THEN 'replacement' END, CASE WHEN control THEN 'control' END, CASE WHEN pipe_table THEN 'pipe_table' END, CASE WHEN empty_header THEN 'empty_header' END, CASE WHEN t IS NULL THEN 'null_text' END, CASE WHEN tables > 0 THEN 'has_table' END]) AS f FROM v) WHERE f IS NOT NULL GROUP BY 2)
      SELECT section, metric, value, round(100.0::DOUBLE * value / total, 1) AS pct FROM g, c""",
    "quality_examples": f"WITH {_FLAGS} SELECT format, unit_id FROM (SELECT *, row_number() OVER (PARTITION BY format ORDER BY unit_id) AS r FROM v) WHERE r <= 3",
    "leaf_coverage": f"WITH {_K}, l AS (SELECT comp_id, comp_id IN (SELECT regexp_replace(unit_id, '__tu(__p[0-9]+)?$', '') FROM text_unit WHERE type <> 'cache_action') AS c FROM k WHERE comp_id NOT IN (SELECT parent_comp_id FROM k WHERE parent_comp_id IS NOT NULL)) SELECT count(*) AS leaves, count(*) FILTER (c) AS covered, round(100.0::DOUBLE * count(*) FILTER (c) / count(*), 1) AS pct FROM l",
    "two_ended_actions": f"WITH {_B} SELECT count(*) AS actions, count(*) FILTER (action_id NOT IN (SELECT regexp_extract(unit_id, '(action-[0-9a-f]+)', 1) FROM text_unit WHERE type = 'cache_action')) AS no_source, count(*) FILTER (action_id NOT IN (SELECT action_id FROM b WHERE action_id IS NOT NULL)) AS no_target FROM (SELECT DISTINCT action_id FROM norm_action)",
    "short_units": f"WITH {_U} SELECT count(*) AS units, count(*) FILTER (coalesce(length({_STRIP}), 0) < 20) AS short, round(100.0::DOUBLE * count(*) FILTER (coalesce(length({_STRIP}), 0) < 20) / count(*), 1) AS pct FROM u WHERE type = 'noi_dung'",
    "reversed_citations": f"WITH {_K} SELECT comp_id, citation FROM k WHERE regexp_matches(citation, '^(Điều\\s+\\S+\\s+Khoản|Khoản\\s+\\S+\\s+Điểm|Điều\\s+\\S+\\s+Điểm)')",
    "embedded_share": f"WITH {_U} SELECT count(*) AS units, count(embedding) AS embedded, round(100.0::DOUBLE * count(embedding) / count(*), 1) AS pct FROM u WHERE type = 'noi_dung'",
    "norm_reach": f"WITH {_U}, {_K}, {_M} SELECT count(*) AS units, count(k.norm_id) AS with_component, count(m.title) AS with_title, count(*) FILTER (coalesce(m.norm_number, '') <> '') AS with_number FROM u LEFT JOIN k ON k.comp_id = regexp_replace(unit_id, '__tu(__p[0-9]+)?$', '') LEFT JOIN m ON m.norm_id = k.norm_id WHERE u.type = 'noi_dung'",
}
