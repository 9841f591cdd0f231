"""Queries that parse, repair and index component trees.

The round trips build documents from relational keys, parse them with the engine, and have SQL compute the tree from the
keys alone. The rules run on the component table, whose rows are taken as they are.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from normspark import schemas as S
from normspark.functions import text as X
from normspark.operators import hierarchy, quality, relations, repair, tree, units
from normspark.operators.records import latest
from normspark.plans import pipeline
from normspark.session import cut, table

# ---- round trip: twenty customers make a document, market segments its chapters, customers articles, orders clauses -----


def documents(s, d):
    c = table(s, d, "customer").select("c_custkey", "c_name", "c_mktsegment", F.expr("c_custkey div 20").alias("doc"))
    w = Window.partitionBy("doc").orderBy("c_mktsegment", "c_custkey")
    c = c.withColumn("chapter", F.dense_rank().over(Window.partitionBy("doc").orderBy("c_mktsegment"))).withColumn("article", F.row_number().over(w))
    o = table(s, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    o = o.withColumn("clause", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")))
    chapters = c.select("doc", "chapter", F.lit(0).alias("article"), F.lit(0).alias("clause"), F.concat(F.lit("Chương "), "chapter", F.lit(". "), "c_mktsegment").alias("line")).distinct()
    articles = c.select("doc", "chapter", "article", F.lit(0).alias("clause"), F.concat(F.lit("Điều "), "article", F.lit(". Khách hàng "), "c_custkey").alias("line"))
    clauses = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("doc", "chapter", "article", "clause", F.concat("clause", F.lit(". Đơn hàng số "), "o_orderkey", F.lit(" trạng thái "), "o_orderstatus").alias("line"))
    lines = chapters.unionByName(articles).unionByName(clauses)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chapter", "article", "clause", "line"))), lambda x: x["line"]), "\n")
    return lines.groupBy(F.col("doc").cast("string").alias("norm_id")).agg(body.alias("markdown"))


def parse_roundtrip(s, d):
    c = tree.components(documents(s, d))
    return c.select("norm_id", "comp_id", "level", "rank", "citation", "order_index", "parent_comp_id", "title_text", "raw_text")


def documents_of_all_levels(s, d):
    """A document for each region: parts, chapters, sections, articles, clauses, points, an annex; text of several lines, and
    article numbers of other documents at the start of a line."""
    n = table(s, d, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("doc")).withColumn("p", F.row_number().over(Window.partitionBy("doc").orderBy("n_nationkey")))
    c = table(s, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.withColumn("ch", F.dense_rank().over(Window.partitionBy("n_nationkey").orderBy("c_mktsegment"))).withColumn("mu", F.col("c_custkey") % 2 + 1)
    c = c.withColumn("ar", F.row_number().over(Window.partitionBy("doc").orderBy("p", "ch", "mu", "c_custkey"))).withColumn("top", F.max("ar").over(Window.partitionBy("doc")))
    key, lit, col = F.col("c_custkey").cast("string"), F.lit, F.col
    at = lambda *k: [(x if not isinstance(x, int) else lit(x)).cast("int").alias(name) for x, name in zip(k, ("p", "ch", "mu", "ar", "kh", "di", "li"))]
    parts = n.select("doc", *at(col("p"), 0, 0, 0, 0, 0, 0), F.concat(lit("Phần thứ "), "p", lit(". "), "n_name").alias("line"))
    chapters = c.select("doc", *at(col("p"), col("ch"), 0, 0, 0, 0, 0), F.concat(lit("CHƯƠNG "), "ch", lit(" - "), "c_mktsegment").alias("line")).distinct()
    sections = c.select("doc", *at(col("p"), col("ch"), col("mu"), 0, 0, 0, 0), F.concat(lit("Mục "), "mu", lit(": Quy định chung")).alias("line")).distinct()
    articles = c.select("doc", *at(col("p"), col("ch"), col("mu"), col("ar"), 0, 0, 0), F.concat(lit("  điều "), "ar", lit(". Khách hàng "), key).alias("line"))
    row = lambda line, **k: F.struct(*(lit(v).alias(n) for n, v in k.items()), line.alias("line"))
    within = F.array(
        row(F.concat(lit("1. Nghĩa vụ của "), key, lit(" gồm:")), kh=1, di=0, li=0),
        row(F.concat(lit("a) nộp "), key), kh=1, di=1, li=0), row(lit("b) báo cáo"), kh=1, di=2, li=0), row(F.concat(lit("  hằng tháng "), key), kh=1, di=2, li=1), row(lit("hoặc hằng năm"), kh=1, di=2, li=2),
        row(lit("2. Thi hành ngay"), kh=2, di=0, li=0), row(F.when((col("ar") % 25 == 12) & (col("ar") < col("top")), F.concat(lit("Điều "), col("ar") + 500, lit(" của luật khác"))), kh=2, di=0, li=1),
    )
    rest = c.select("doc", "p", "ch", "mu", "ar", F.explode(within).alias("x")).select("doc", *at(col("p"), col("ch"), col("mu"), col("ar"), col("x.kh"), col("x.di"), col("x.li")), "x.line").filter("line is not null")
    ends = F.array(row(lit("Căn cứ Hiến pháp"), p=0, li=0), row(lit("PHỤ LỤC số II"), p=999, li=0), row(lit("Biểu mẫu kèm theo"), p=999, li=1))
    ends = n.select("doc").distinct().select("doc", F.explode(ends).alias("x")).select("doc", *at(col("x.p"), 0, 0, 0, 0, 0, col("x.li")), "x.line")
    lines = parts.unionByName(chapters).unionByName(sections).unionByName(articles).unionByName(rest).unionByName(ends)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "ch", "mu", "ar", "kh", "di", "li", "line"))), lambda x: x["line"]), "\n")
    return lines.groupBy(F.col("doc").cast("string").alias("norm_id")).agg(body.alias("markdown"))


def parse_levels(s, d):
    c = tree.components(documents_of_all_levels(s, d))
    return c.select("norm_id", "comp_id", "level", "rank", "citation", "order_index", "parent_comp_id", "title_text", "raw_text")


def accumulated_text(s, d):
    docs = cut(documents(s, d), "documents")
    norms = docs.select("norm_id", F.concat(F.lit("Văn bản "), "norm_id").alias("title"))
    return units.text_units(tree.components(docs), norms).select("unit_id", "accumulated_text", "type")


def component_index(s, d):
    return units.component_index(tree.components(documents(s, d)).withColumn("pos", F.col("order_index").cast("long")))


def round_trip_repaired(s, d):
    """The same documents after all repairs: the tree is sound, so only short clauses and level jumps are reported."""
    _, said = repair.repaired(tree.components(documents(s, d)))
    return said.groupBy("rule", "severity").agg(F.count("*").alias("n"))


_ROUND = """
c AS (SELECT c_custkey, c_mktsegment, c_custkey // 20 AS doc, dense_rank() OVER (PARTITION BY c_custkey // 20 ORDER BY c_mktsegment) AS chapter,
  row_number() OVER (PARTITION BY c_custkey // 20 ORDER BY c_mktsegment, c_custkey) AS article FROM customer),
o AS (SELECT o_custkey, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS clause FROM orders),
l AS (
  SELECT DISTINCT doc, chapter, 0 AS article, 0 AS clause, 'Chuong' AS level, 1 AS rank, 'Chương ' || chapter AS citation, c_mktsegment AS title_text FROM c
  UNION ALL SELECT doc, chapter, article, 0, 'Dieu', 4, 'Điều ' || article, 'Khách hàng ' || c_custkey FROM c
  UNION ALL SELECT doc, chapter, article, clause, 'Khoan', 5, 'Khoản ' || clause, 'Đơn hàng số ' || o_orderkey || ' trạng thái ' || o_orderstatus FROM o JOIN c ON o_custkey = c_custkey),
n AS (SELECT *, CAST(doc AS VARCHAR) AS norm_id, row_number() OVER (PARTITION BY doc ORDER BY chapter, article, clause) AS k FROM l),
t AS (SELECT *, max(CASE WHEN level = 'Chuong' THEN k END) OVER w AS ch, max(CASE WHEN level = 'Dieu' THEN k END) OVER w AS ar,
  lead(rank) OVER (PARTITION BY doc ORDER BY k) AS nxt FROM n WINDOW w AS (PARTITION BY doc ORDER BY k)),
f AS (SELECT norm_id, norm_id || '__c' || k AS comp_id, level, rank, citation, CAST(k AS INTEGER) AS order_index,
  CASE level WHEN 'Dieu' THEN norm_id || '__c' || ch WHEN 'Khoan' THEN norm_id || '__c' || ar END AS parent_comp_id, title_text,
  CASE WHEN coalesce(nxt, 0) <= rank THEN title_text || chr(10) END AS raw_text FROM t)
"""

_LEVELS = """
n AS (SELECT n_nationkey, n_name, n_regionkey AS doc, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS p FROM nation),
c0 AS (SELECT c_custkey, c_mktsegment, doc, p, dense_rank() OVER (PARTITION BY n_nationkey ORDER BY c_mktsegment) AS ch, c_custkey % 2 + 1 AS mu FROM customer JOIN n ON c_nationkey = n_nationkey),
c AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY p, ch, mu, c_custkey) AS ar FROM c0),
l AS (
  SELECT doc, p, 0 AS ch, 0 AS mu, 0 AS ar, 0 AS kh, 0 AS di, 'Phan' AS level, 0 AS rank, 'Phần ' || p AS citation, n_name AS title_text, '' AS more FROM n
  UNION ALL SELECT DISTINCT doc, p, ch, 0, 0, 0, 0, 'Chuong', 1, 'Chương ' || ch, c_mktsegment, '' FROM c
  UNION ALL SELECT DISTINCT doc, p, ch, mu, 0, 0, 0, 'Muc', 2, 'Mục ' || mu, 'Quy định chung', '' FROM c
  UNION ALL SELECT doc, p, ch, mu, ar, 0, 0, 'Dieu', 4, 'Điều ' || ar, 'Khách hàng ' || c_custkey, '' FROM c
  UNION ALL SELECT doc, p, ch, mu, ar, 1, 0, 'Khoan', 5, 'Khoản 1', 'Nghĩa vụ của ' || c_custkey || ' gồm', '' FROM c
  UNION ALL SELECT doc, p, ch, mu, ar, 1, 1, 'Diem', 6, 'Điểm a', 'nộp ' || c_custkey, '' FROM c
  UNION ALL SELECT doc, p, ch, mu, ar, 1, 2, 'Diem', 6, 'Điểm b', 'báo cáo', 'hằng tháng ' || c_custkey || chr(10) || 'hoặc hằng năm' || chr(10) FROM c
  UNION ALL SELECT doc, p, ch, mu, ar, 2, 0, 'Khoan', 5, 'Khoản 2', 'Thi hành ngay', CASE WHEN ar % 25 = 12 AND ar < (SELECT max(ar) FROM c q WHERE q.doc = c.doc) THEN 'Điều ' || (ar + 500) || ' của luật khác' || chr(10) ELSE '' END FROM c
  UNION ALL SELECT DISTINCT doc, 999, 0, 0, 0, 0, 0, 'PhuLuc', 0, 'Phụ lục II', CAST(NULL AS VARCHAR), 'Biểu mẫu kèm theo' || chr(10) FROM n),
k AS (SELECT *, CAST(doc AS VARCHAR) AS norm_id, row_number() OVER (PARTITION BY doc ORDER BY p, ch, mu, ar, kh, di) AS k FROM l),
t AS (SELECT *, lead(rank) OVER (PARTITION BY doc ORDER BY k) AS nxt,
  CASE level WHEN 'Chuong' THEN max(CASE WHEN level = 'Phan' THEN k END) OVER w WHEN 'Muc' THEN max(CASE WHEN level = 'Chuong' THEN k END) OVER w WHEN 'Dieu' THEN max(CASE WHEN level = 'Muc' THEN k END) OVER w
    WHEN 'Khoan' THEN max(CASE WHEN level = 'Dieu' THEN k END) OVER w WHEN 'Diem' THEN max(CASE WHEN level = 'Khoan' THEN k END) OVER w END AS up FROM k WINDOW w AS (PARTITION BY doc ORDER BY k)),
f AS (SELECT *, CASE WHEN coalesce(nxt, 0) <= rank THEN coalesce(title_text || chr(10), '') || more END AS own FROM t),
g AS (SELECT *, min(CASE WHEN own IS NOT NULL THEN k END) OVER (PARTITION BY doc) AS first FROM f)
"""

# ---- rules on the component table -------------------------------------------------------------------------------------------


def _components(s, d):
    """The latest row of each component with its parent as the only ancestor, its unit's text, and its place."""
    c = latest(table(s, d, "component"), "comp_id", "updated_at", F.xxhash64("parent_comp_id", "citation", "order_index"))
    p = c.select(F.col("comp_id").alias("_p"), F.struct("comp_id", "citation", "title_text", "level", "rank").alias("_up"))
    u = latest(table(s, d, "text_unit").filter("type = 'noi_dung'").select("unit_id", "accumulated_text", "updated_at"), "unit_id", "updated_at", F.xxhash64("accumulated_text"))
    u = u.select(F.regexp_replace("unit_id", "__tu$", "").alias("_u"), F.regexp_replace("accumulated_text", r"^[^\n]*\n?", "").alias("raw_text"))
    c = c.join(p, F.col("parent_comp_id") == F.col("_p"), "left").join(u, F.col("comp_id") == F.col("_u"), "left")
    none = F.array().cast("array<struct<comp_id:string,citation:string,title_text:string,level:string,rank:int>>")
    return c.withColumn("ancestors", F.when(F.col("_up").isNotNull(), F.array("_up")).otherwise(none)).withColumn("pos", F.col("order_index").cast("long")).drop("_p", "_up", "_u", "updated_at")


def dedup_winners(s, d):
    """Of components with the same document, parent and citation the one with the best text."""
    w = Window.partitionBy("norm_id", "parent_comp_id", "citation").orderBy(X.text_score(F.col("raw_text")).desc(), "order_index", "comp_id")
    return _components(s, d).withColumn("r", F.row_number().over(w)).filter("r = 1").select("comp_id", "norm_id", "citation")


def duplicate_citations(s, d):
    c = _components(s, d).groupBy("norm_id", "parent_comp_id", "citation").agg(F.count("*").alias("n"))
    return c.filter("n > 1")


def structure_issues(s, d):
    return repair.issues(_components(s, d)).groupBy("issue_type", "severity").agg(F.count("*").alias("n"))


def same_titles(s, d):
    return repair.same_titles(_components(s, d))


def deduplicated(s, d):
    """What is left once the losers among equal citations have gone, with what was directly below them."""
    return repair.deduplicated(_components(s, d)).select("comp_id", "parent_comp_id", "citation")


def article_gaps(s, d):
    return repair.article_gaps(_components(s, d)).groupBy("norm_id", "n", "nxt").agg(F.count("*").alias("rows"))


def sole_clauses(s, d):
    return repair.sole_clauses(_components(s, d)).select("comp_id", "parent_comp_id")


def letter_gaps(s, d):
    return repair.letter_gaps(_components(s, d)).select("comp_id", F.col("at").alias("place"), F.col("nxt").alias("next_place"))


def level_jumps(s, d):
    c = repair.checks(_components(s, d)).filter("rule = 'E1'")
    return c.select("comp_id", F.col("details")["rank_gap"].cast("long").alias("rank_gap"))


def empty_groups(s, d):
    """Chapters, parts and sections without an article anywhere below (members of loops left out, not what is below them)."""
    c = cut(_components(s, d), "components")
    n = c.select("comp_id", F.col("parent_comp_id").alias("parent"), "citation")
    h = cut(hierarchy.hierarchy(n, paths=False), "resolved")
    below = hierarchy.descendants(n, h).join(c.filter("level = 'Dieu'").select(F.col("comp_id").alias("descendant")), "descendant", "left_semi")
    g = c.filter(F.col("level").isin(*S.GROUP_LEVELS)).join(hierarchy.loop_members(n, h), "comp_id", "left_anti")
    return g.join(below.select("comp_id").distinct(), "comp_id", "left_anti").select("comp_id", "level")


def length_outliers(s, d):
    c = repair.checks(_components(s, d)).filter("rule = 'D1'")
    return c.select("comp_id", F.col("details")["text_len"].cast("long").alias("text_len"))


def single_long_article(s, d):
    c = repair.checks(_components(s, d)).filter("rule = 'C1'")
    return c.select("norm_id", "comp_id", F.col("details")["total_content_chars"].cast("long").alias("chars"))


def small_leaves(s, d):
    _, fix = repair.small_leaves_merged(_components(s, d))
    return fix.select("comp_id", F.col("details")["text_len"].cast("long").alias("text_len"), F.col("details")["parent_id"].alias("parent_id"))


def article_resets(s, d):
    """Articles at or after the first descent of numbers among their siblings."""
    return repair._with_resets(_components(s, d)).filter("tail").select("comp_id", F.col("n").cast("long").alias("n"))


def _shifted(s, d):
    """The components with numbers that jump and repeat, so that every rule has something to find."""
    at = F.col("order_index")
    c = F.when(F.col("level") == "Dieu", F.concat(F.lit("Điều "), at * 7 % 11 + 1)).when((F.col("level") == "Khoan") & (at % 5 == 0), F.concat(F.lit("Điều "), at % 4, F.lit(" Khoản 2")))
    return _components(s, d).withColumn("citation", c.otherwise(F.concat_ws(" ", "level", at % 3)))


def shifted_duplicates(s, d):
    c = repair.issues(_shifted(s, d)).filter("issue_type = 'dup_citation'")
    return c.select("norm_id", "comp_id", F.col("details")["parent_id"].alias("parent_id"), F.col("details")["citation"].alias("citation"), F.col("details")["count"].cast("long").alias("n"))


def shifted_issues(s, d):
    return repair.issues(_shifted(s, d)).groupBy("issue_type", "severity").agg(F.count("*").alias("n"))


def shifted_resets(s, d):
    return repair._with_resets(_shifted(s, d)).filter("tail").select("comp_id", F.col("n").cast("long").alias("n"))


def shifted_deduplicated(s, d):
    return repair.deduplicated(_shifted(s, d)).select("comp_id", "parent_comp_id", "citation")


def shifted_without_ghosts(s, d):
    return repair.without_ghosts(_shifted(s, d)).select("comp_id", "citation")


def shifted_reversed(s, d):
    return quality.reversed_citations(_shifted(s, d))


_COMPONENT = """
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY comp_id ORDER BY updated_at DESC NULLS LAST) AS rn FROM component WHERE comp_id IS NOT NULL) WHERE rn = 1),
tu AS (SELECT regexp_replace(unit_id, '__tu$', '') AS u, regexp_replace(accumulated_text, '^[^\\n]*\\n?', '') AS raw_text FROM (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY updated_at DESC) AS rn FROM text_unit WHERE type = 'noi_dung') WHERE rn = 1),
x AS (SELECT k.*, p.level AS plevel, p.rank AS prank, tu.raw_text FROM k LEFT JOIN k p ON p.comp_id = k.parent_comp_id LEFT JOIN tu ON tu.u = k.comp_id)
"""
_SHIFTED = _COMPONENT.replace("SELECT k.*,", """SELECT k.* REPLACE (CASE WHEN k.level = 'Dieu' THEN 'Điều ' || (k.order_index * 7 % 11 + 1) WHEN k.level = 'Khoan' AND k.order_index % 5 = 0 THEN 'Điều ' || (k.order_index % 4) || ' Khoản 2' ELSE concat_ws(' ', k.level, k.order_index % 3) END AS citation),""")
_SCORE = "CASE WHEN raw_text LIKE 'Bảng [%' THEN length(raw_text) * 0.001 ELSE coalesce(length(raw_text), 0) END"
_NUM = r"TRY_CAST(nullif(translate(regexp_extract(citation, '(?i)Điều[\s\x{a0}\x{2000}-\x{200a}\x{202f}\x{3000}]+([0-9０-９]+)', 1), '０１２３４５６７８９', '0123456789'), '') AS INTEGER)"
_RESET = f"""
a AS (SELECT *, {_NUM} AS n FROM x WHERE level = 'Dieu'),
b AS (SELECT *, last_value(n IGNORE NULLS) OVER (PARTITION BY norm_id, parent_comp_id ORDER BY order_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM a),
r AS (SELECT *, max(CASE WHEN n < prev THEN 1 ELSE 0 END) OVER (PARTITION BY norm_id, parent_comp_id ORDER BY order_index) AS tail FROM b)
"""

# ---- amendments ---------------------------------------------------------------------------------------------------------------


def _amending_units(s, d):
    """A sentence for each component that amends a place chosen by its order."""
    c = latest(table(s, d, "component"), "comp_id", "updated_at", F.xxhash64("parent_comp_id", "citation", "order_index"))
    o = F.col("order_index")
    place = F.when(o % 3 == 0, F.concat(F.lit("Khoản "), (o % 4 + 1), F.lit(" Điều "), (o % 5 + 1))).otherwise(F.concat(F.lit("Điều "), (o % 7 + 1)))
    verb = F.element_at(F.array(*(F.lit(x) for x in ("Sửa đổi ", "Bãi bỏ ", 'Bỏ cụm từ "và Sở Tài chính" tại ', 'Thay thế cụm từ "Bộ A" bằng cụm từ "Bộ B" tại '))), (o % 4 + 1).cast("int"))
    return c.select("norm_id", "comp_id", F.concat("comp_id", F.lit("__tu")).alias("unit_id"), F.concat(F.lit("[Văn bản > Điều khoản]\n"), verb, place, F.lit(" của Nghị định này.")).alias("accumulated_text"))


def _index(s, d):
    c = latest(table(s, d, "component"), "comp_id", "updated_at", F.xxhash64("parent_comp_id", "citation", "order_index"))
    p = c.select(F.col("comp_id").alias("_p"), F.col("citation").alias("_pc"), F.col("level").alias("_pl"))
    j = c.join(p, F.col("parent_comp_id") == F.col("_p"), "left").filter("level = 'Dieu' or level = 'Khoan' and _pl = 'Dieu'")
    path = F.when(F.col("level") == "Dieu", F.col("citation")).otherwise(F.concat("citation", F.lit(" > "), "_pc"))
    w = Window.partitionBy("norm_id", "citation_path").orderBy(F.desc("order_index"), F.desc("comp_id"))
    return j.withColumn("citation_path", path).filter("citation_path is not null").withColumn("r", F.row_number().over(w)).filter("r = 1").select("norm_id", "citation_path", "comp_id")


def _norms(s, d):
    m = latest(table(s, d, "metadata"), "id", "loaded_at", F.coalesce("title", F.lit("")))
    return m.select(F.col("id").cast("string").alias("norm_id"), F.col("so_ky_hieu").alias("norm_number"))


def _actions(s, d):
    return relations.actions(table(s, d, "relationships"), _amending_units(s, d), cut(_index(s, d), "index"), _norms(s, d))


def action_links(s, d):
    """Which component does each amending sentence point to?"""
    return _actions(s, d).select("from_norm_id", "comp_a_id", "to_norm_id", "comp_b_id", "citation_path", "relation_type", "amending_doc_number")


def amendment_citations(s, d):
    return relations.citations(_amending_units(s, d)).select("comp_id", "citation_path")


def extraction_outcomes(s, d):
    u = latest(table(s, d, "text_unit").filter("type = 'noi_dung'").select("unit_id", "accumulated_text", "updated_at"), "unit_id", "updated_at", F.xxhash64("accumulated_text"))
    return relations.extraction_outcomes(u)


def amendment_prefilter(s, d):
    u = latest(table(s, d, "text_unit").filter("type = 'noi_dung'").select("unit_id", "accumulated_text", "updated_at"), "unit_id", "updated_at", F.xxhash64("accumulated_text"))
    return u.filter(X.may_amend(F.col("accumulated_text"))).select("unit_id")


# ---- the pipeline on the pages --------------------------------------------------------------------------------------------------


def _run(s, d):
    return pipeline.transform(table(s, d, "metadata"), table(s, d, "content"), table(s, d, "relationships"))


def pipeline_components(s, d):
    return _run(s, d)["components"].drop("pos")


def pipeline_units(s, d):
    return _run(s, d)["text_units"]


def pipeline_warnings(s, d):
    return _run(s, d)["warnings"].groupBy("rule", "severity").agg(F.count("*").alias("n"))


def pipeline_edges(s, d):
    e = pipeline.load(_run(s, d))
    return e["edge_contains"].withColumn("kind", F.lit("CONTAINS")).unionByName(e["edge_has_textunit"].withColumn("kind", F.lit("HAS_TEXTUNIT"))).unionByName(e["edge_action"])


QUERIES = {f.__name__: f for f in (
    parse_roundtrip, parse_levels, accumulated_text, component_index, round_trip_repaired, dedup_winners, deduplicated, same_titles, duplicate_citations, structure_issues, article_gaps, sole_clauses, letter_gaps, level_jumps, empty_groups,
    length_outliers, single_long_article, small_leaves, article_resets, shifted_duplicates, shifted_issues, shifted_resets, shifted_deduplicated, shifted_without_ghosts, shifted_reversed, action_links, amendment_citations, extraction_outcomes, amendment_prefilter, pipeline_components, pipeline_units, pipeline_warnings, pipeline_edges,
)}

_AMEND = r"""
k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY comp_id ORDER BY updated_at DESC NULLS LAST) AS rn FROM component WHERE comp_id IS NOT NULL) WHERE rn = 1),
u AS (SELECT norm_id, comp_id, CASE WHEN order_index % 3 = 0 THEN 'Khoản ' || (order_index % 4 + 1) || ' > Điều ' || (order_index % 5 + 1) ELSE 'Điều ' || (order_index % 7 + 1) END AS citation_path FROM k WHERE order_index IS NOT NULL)
"""

_SP = r"[\s\x{a0}\x{2000}-\x{200a}\x{202f}\x{3000}]"
_AT = rf"(?:Điểm{_SP}+[a-zđ]\)?{_SP}+)?(?:Khoản{_SP}+[0-9０-９]+[a-zđ]?{_SP}+)?Điều{_SP}+[0-9０-９]"
_PHRASE = rf'(?i)(?:(?:Sửa đổi|Bổ sung|Bãi bỏ){_SP}+|Thay thế cụm từ{_SP}*"[^"]+"{_SP}*bằng cụm từ{_SP}*"[^"]+"{_SP}+tại{_SP}+|Bỏ cụm từ{_SP}*"[^"]+"{_SP}+tại{_SP}+){_AT}'
_NEAR = rf"(?is)(?:sửa đổi|bổ sung|bãi bỏ|thay thế|bỏ cụm).{{0,300}}Điều{_SP}+[0-9０-９]"
_LATEST_UNITS = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY updated_at DESC) AS rn FROM text_unit WHERE type = 'noi_dung') WHERE rn = 1)"

ORACLES = {
    "extraction_outcomes": f"SELECT CASE WHEN regexp_matches(accumulated_text, '{_PHRASE}') THEN 'regex_hit' WHEN regexp_matches(accumulated_text, '{_NEAR}') THEN 'prefilter_hit' ELSE 'prefilter_skip' END AS outcome, count(*) AS n FROM {_LATEST_UNITS} WHERE regexp_replace(accumulated_text, '^{_SP}+|{_SP}+$', '', 'g') <> '' GROUP BY 1",
    "parse_roundtrip": f"WITH {_ROUND} SELECT * FROM f",
    "accumulated_text": f"""WITH {_ROUND} SELECT f.comp_id || '__tu' AS unit_id, '[' || concat_ws(' > ', 'Văn bản ' || f.norm_id, CASE WHEN g.comp_id IS NOT NULL THEN g.citation || ' ' || g.title_text END, CASE WHEN p.comp_id IS NOT NULL THEN p.citation || ' ' || p.title_text END) || ']' || chr(10) || f.title_text AS accumulated_text, 'noi_dung' AS type
      FROM f LEFT JOIN f p ON p.comp_id = f.parent_comp_id LEFT JOIN f g ON g.comp_id = p.parent_comp_id WHERE f.raw_text IS NOT NULL""",
    "component_index": f"WITH {_ROUND} SELECT f.norm_id, CASE f.level WHEN 'Khoan' THEN f.citation || ' > ' || p.citation ELSE f.citation END AS citation_path, f.comp_id FROM f LEFT JOIN f p ON p.comp_id = f.parent_comp_id",
    "round_trip_repaired": f"""WITH {_ROUND}, s AS (SELECT parent_comp_id FROM f WHERE level = 'Khoan' GROUP BY 1 HAVING count(*) = 1),
      t2 AS (SELECT norm_id, level, comp_id, length(raw_text) AS len FROM f WHERE raw_text IS NOT NULL),
      md AS (SELECT norm_id, level, median(len) AS med, mad(len) AS mad FROM t2 GROUP BY 1, 2 HAVING count(*) >= 3)
      SELECT 'C2' AS rule, 'warn' AS severity, count(*) AS n FROM s HAVING count(*) > 0
      UNION ALL SELECT 'E1', 'bug', count(*) FROM f WHERE level = 'Dieu' HAVING count(*) > 0
      UNION ALL SELECT 'D1', 'warn', count(*) FROM t2 JOIN md USING (norm_id, level) WHERE len > med + 6 * greatest(mad, 1) HAVING count(*) > 0""",
    "parse_levels": f"WITH {_LEVELS} SELECT norm_id, norm_id || '__c' || k AS comp_id, level, rank, citation, CAST(k AS INTEGER) AS order_index, norm_id || '__c' || up AS parent_comp_id, title_text, CASE WHEN k = first THEN 'Căn cứ Hiến pháp' || chr(10) || own ELSE own END AS raw_text FROM g",
    "shifted_deduplicated": f"WITH {_SHIFTED}, r AS (SELECT *, row_number() OVER (PARTITION BY norm_id, parent_comp_id, citation ORDER BY {_SCORE} DESC, order_index, comp_id) AS place FROM x) SELECT comp_id, parent_comp_id, citation FROM r WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM r q WHERE q.place > 1 AND q.norm_id = r.norm_id AND q.comp_id = r.parent_comp_id)",
    "shifted_issues": f"""WITH {_SHIFTED}, {_RESET}
      SELECT 'dup_citation' AS issue_type, 'warn' AS severity, count(*) AS n FROM (SELECT 1 FROM x GROUP BY norm_id, parent_comp_id, citation HAVING count(*) > 1) HAVING count(*) > 0
      UNION ALL SELECT 'broken_parent', 'error', count(*) FROM x WHERE parent_comp_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k p WHERE p.comp_id = x.parent_comp_id AND p.norm_id = x.norm_id) HAVING count(*) > 0
      UNION ALL SELECT 'ghost_citation', 'warn', count(*) FROM (SELECT DISTINCT norm_id, parent_comp_id FROM r WHERE n < prev) HAVING count(*) > 0""",
    "shifted_resets": f"WITH {_SHIFTED}, {_RESET} SELECT comp_id, CAST(n AS BIGINT) AS n FROM r WHERE tail = 1",
    "shifted_duplicates": f"WITH {_SHIFTED} SELECT norm_id, min(comp_id) AS comp_id, parent_comp_id AS parent_id, citation, count(*) AS n FROM x GROUP BY norm_id, parent_comp_id, citation HAVING count(*) > 1",
    "shifted_reversed": f"WITH {_SHIFTED} SELECT comp_id, citation FROM x WHERE citation LIKE 'Điều _ Khoản%'",
    "shifted_without_ghosts": f"""WITH {_SHIFTED}, {_RESET}, h AS (SELECT *, coalesce(prank, -1) AS depth, min(coalesce(prank, -1)) OVER (PARTITION BY norm_id, citation) AS least FROM r),
      g AS (SELECT norm_id, comp_id FROM h WHERE tail = 1 AND least < depth)
      SELECT comp_id, citation FROM x WHERE comp_id NOT IN (SELECT comp_id FROM g) AND NOT EXISTS (SELECT 1 FROM g WHERE g.norm_id = x.norm_id AND g.comp_id = x.parent_comp_id)""",
    "dedup_winners": f"WITH {_COMPONENT} SELECT comp_id, norm_id, citation FROM (SELECT *, row_number() OVER (PARTITION BY norm_id, parent_comp_id, citation ORDER BY {_SCORE} DESC, order_index, comp_id) AS r FROM x) WHERE r = 1",
    "deduplicated": f"WITH {_COMPONENT}, r AS (SELECT *, row_number() OVER (PARTITION BY norm_id, parent_comp_id, citation ORDER BY {_SCORE} DESC, order_index, comp_id) AS place FROM x) SELECT comp_id, parent_comp_id, citation FROM r WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM r q WHERE q.place > 1 AND q.norm_id = r.norm_id AND q.comp_id = r.parent_comp_id)",
    "same_titles": f"WITH {_COMPONENT} SELECT norm_id, level, title_text, count(*) AS n, min(comp_id) AS first FROM x WHERE trim(coalesce(title_text, '')) <> '' GROUP BY 1, 2, 3 HAVING count(*) > 1",
    "duplicate_citations": f"WITH {_COMPONENT} SELECT norm_id, parent_comp_id, citation, count(*) AS n FROM x GROUP BY ALL HAVING count(*) > 1",
    "structure_issues": f"""WITH {_COMPONENT}, {_RESET}
      SELECT 'dup_citation' AS issue_type, 'warn' AS severity, count(*) AS n FROM (SELECT 1 FROM x GROUP BY norm_id, parent_comp_id, citation HAVING count(*) > 1) HAVING count(*) > 0
      UNION ALL SELECT 'broken_parent', 'error', count(*) FROM x WHERE parent_comp_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k p WHERE p.comp_id = x.parent_comp_id AND p.norm_id = x.norm_id) HAVING count(*) > 0
      UNION ALL SELECT 'ghost_citation', 'warn', count(*) FROM (SELECT DISTINCT norm_id, parent_comp_id FROM r WHERE n < prev) HAVING count(*) > 0""",
    "article_gaps": f"WITH {_COMPONENT}, g AS (SELECT norm_id, n, lead(n) OVER (PARTITION BY norm_id ORDER BY n) AS nxt FROM (SELECT norm_id, {_NUM} AS n FROM x WHERE level = 'Dieu') WHERE n IS NOT NULL) SELECT norm_id, n, nxt, count(*) AS rows FROM g WHERE nxt - n > 1 GROUP BY ALL",
    "sole_clauses": f"WITH {_COMPONENT} SELECT comp_id, parent_comp_id FROM (SELECT *, count(*) OVER (PARTITION BY norm_id, parent_comp_id) AS c FROM x WHERE level = 'Khoan') WHERE c = 1 AND plevel = 'Dieu'",
    "letter_gaps": f"""WITH {_COMPONENT}, q AS (SELECT *, instr('{S.ALPHABET}', nullif(lower(regexp_extract(citation, '(?i)Điểm[\\s\\x{{a0}}\\x{{2000}}-\\x{{200a}}\\x{{202f}}\\x{{3000}}]+([a-zđ])(?:[^\\p{{L}}\\p{{N}}]|$)', 1)), '')) - 1 AS place FROM x WHERE level = 'Diem' AND plevel = 'Khoan'),
      y AS (SELECT *, lead(place) OVER (PARTITION BY norm_id, parent_comp_id ORDER BY order_index, comp_id) AS nxt FROM q WHERE place >= 0)
      SELECT comp_id, CAST(place AS INTEGER) AS place, CAST(nxt AS INTEGER) AS next_place FROM (SELECT *, row_number() OVER (PARTITION BY norm_id, parent_comp_id ORDER BY order_index, comp_id) AS r FROM y WHERE nxt - place > 1) WHERE r = 1""",
    "level_jumps": f"WITH {_COMPONENT} SELECT comp_id, CAST(rank - prank AS BIGINT) AS rank_gap FROM x WHERE rank - prank > 2",
    "empty_groups": "__TREE__, v AS (SELECT DISTINCT b.comp_id FROM b JOIN component k ON k.comp_id = b.descendant AND k.level = 'Dieu'), g AS (SELECT comp_id, level FROM (SELECT *, row_number() OVER (PARTITION BY comp_id ORDER BY updated_at DESC) AS rn FROM component) WHERE rn = 1) SELECT g.comp_id, g.level FROM g WHERE g.level IN ('Phan', 'Chuong', 'Muc', 'TieuMuc') AND g.comp_id NOT IN (SELECT comp_id FROM o) AND g.comp_id NOT IN (SELECT comp_id FROM v)",
    "length_outliers": f"WITH {_COMPONENT}, t AS (SELECT norm_id, level, comp_id, length(raw_text) AS len FROM x WHERE raw_text <> ''), md AS (SELECT norm_id, level, median(len) AS med, mad(len) AS mad FROM t GROUP BY 1, 2 HAVING count(*) >= 3) SELECT comp_id, len AS text_len FROM t JOIN md USING (norm_id, level) WHERE len > med + 6 * greatest(mad, 1)",
    "single_long_article": f"WITH {_COMPONENT} SELECT norm_id, max(CASE WHEN level = 'Dieu' THEN comp_id END) AS comp_id, CAST(sum(length(raw_text)) AS BIGINT) AS chars FROM x GROUP BY 1 HAVING count(*) FILTER (level = 'Dieu') = 1 AND sum(length(raw_text)) >= 3000",
    "small_leaves": f"WITH {_COMPONENT} SELECT comp_id, length(raw_text) AS text_len, parent_comp_id AS parent_id FROM x WHERE length(raw_text) < 10 AND parent_comp_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k q WHERE q.parent_comp_id = x.comp_id AND q.norm_id = x.norm_id)",
    "article_resets": f"WITH {_COMPONENT}, {_RESET} SELECT comp_id, CAST(n AS BIGINT) AS n FROM r WHERE tail = 1",
    "amendment_citations": f"WITH {_AMEND} SELECT comp_id, citation_path FROM u",
    "action_links": f"""WITH {_AMEND}, __META__, __REL__,
      i AS (SELECT k.norm_id, CASE WHEN k.level = 'Dieu' THEN k.citation ELSE k.citation || ' > ' || p.citation END AS citation_path, k.comp_id, k.order_index FROM k LEFT JOIN k p ON p.comp_id = k.parent_comp_id WHERE k.level = 'Dieu' OR (k.level = 'Khoan' AND p.level = 'Dieu')),
      j AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY norm_id, citation_path ORDER BY order_index DESC, comp_id DESC) AS rn FROM i WHERE citation_path IS NOT NULL) WHERE rn = 1)
      SELECT r.from_norm_id, u.comp_id AS comp_a_id, r.to_norm_id, j.comp_id AS comp_b_id, u.citation_path, r.relation_type, coalesce(nullif(m.so_ky_hieu, ''), r.from_norm_id) AS amending_doc_number
      FROM r JOIN u ON u.norm_id = r.from_norm_id JOIN j ON j.norm_id = r.to_norm_id AND j.citation_path = u.citation_path LEFT JOIN m ON CAST(m.id AS VARCHAR) = r.from_norm_id WHERE r.relation_type IN __ELIGIBLE__""",
    "amendment_prefilter": "SELECT unit_id FROM (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY updated_at DESC) AS rn FROM text_unit WHERE type = 'noi_dung') WHERE rn = 1 AND regexp_matches(accumulated_text, '(?is)(?:sửa đổi|bổ sung|bãi bỏ|thay thế|bỏ cụm).{0,300}Điều[\\s\\x{a0}\\x{2000}-\\x{200a}\\x{202f}\\x{3000}]+[0-9０-９]')",
}
from normspark.plans import documents as _documents  # noqa: E402
from normspark.plans import keys as _keys  # noqa: E402

ORACLES["empty_groups"] = ORACLES["empty_groups"].replace("__TREE__", _keys._BELOW)

ORACLES["action_links"] = ORACLES["action_links"].replace("__META__", _documents._META).replace("__REL__", _documents._REL).replace("__ELIGIBLE__", _documents._ELIGIBLE)
