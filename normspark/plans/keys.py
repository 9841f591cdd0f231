"""Queries on keys and references: hierarchies of parents, and references to records that do not exist."""

from __future__ import annotations

from normspark.operators import hierarchy, references

QUERIES = {
    "p4_found": hierarchy.p4_found,
    "p4_paths": hierarchy.p4_paths,
    "p4_descendants": hierarchy.p4_descendants,
    "p4_loops": hierarchy.p4_loops,
    "p5_found": references.p5_found,
    "p5_report": references.p5_report,
}

_TREE = """
WITH RECURSIVE c AS (
  SELECT comp_id, parent_comp_id, citation FROM (
    SELECT *, row_number() OVER (PARTITION BY comp_id ORDER BY updated_at DESC NULLS LAST) AS rn FROM component WHERE comp_id IS NOT NULL) WHERE rn = 1),
p AS (SELECT c.comp_id, c.citation, u.comp_id AS parent FROM c LEFT JOIN c u ON u.comp_id = c.parent_comp_id AND trim(c.parent_comp_id) <> ''),
w AS (
  SELECT comp_id, comp_id AS cur, 0 AS d, [comp_id] AS seen, citation AS path FROM p
  UNION ALL
  SELECT w.comp_id, p.parent, w.d + 1, list_append(w.seen, p.parent), concat_ws(' > ', u.citation, w.path)
  FROM w JOIN p ON p.comp_id = w.cur JOIN p u ON u.comp_id = p.parent WHERE NOT list_contains(w.seen, p.parent)),
t AS (SELECT w.*, p.parent AS again FROM (SELECT *, row_number() OVER (PARTITION BY comp_id ORDER BY d DESC) AS rn FROM w) w JOIN p ON p.comp_id = w.cur WHERE rn = 1),
r AS (
  SELECT comp_id, CASE WHEN again IS NULL THEN cur ELSE list_min(list_slice(seen, list_position(seen, again), len(seen))) END AS root_comp_id,
         CAST(CASE WHEN again IS NULL THEN d ELSE -1 END AS BIGINT) AS depth, path
  FROM t)
"""

_ORPHANS = r"""
WITH e AS (
  SELECT 'm:' || CAST(id AS VARCHAR) AS key, loaded_at AS ts, 1 AS arrived FROM metadata WHERE id IS NOT NULL
  UNION ALL SELECT 'c:' || trim(comp_id), updated_at, 1 FROM component WHERE trim(comp_id) <> ''
  UNION ALL SELECT CASE table_name WHEN 'metadata' THEN 'm:' || CAST(CAST(trim(record_key) AS BIGINT) AS VARCHAR) ELSE 'c:' || trim(record_key) END, deleted_at, 0
    FROM deleted_records),
r AS (
  SELECT 'relationships' AS ref_table, 'doc_id' AS ref_field, row_id, loaded_at AS ts, regexp_extract(doc_id, '^\s*([+-]?\d+)(\.0*)?\s*$', 1) AS v FROM relationships
  UNION ALL SELECT 'relationships', 'other_doc_id', row_id, loaded_at, regexp_extract(other_doc_id, '^\s*([+-]?\d+)(\.0*)?\s*$', 1) FROM relationships),
k AS (
  SELECT ref_table, ref_field, row_id, ts, 'm:' || CAST(CAST(v AS BIGINT) AS VARCHAR) AS key FROM r WHERE v <> ''
  UNION ALL SELECT 'apply_to', 'comp_id', row_id, loaded_at, 'c:' || trim(comp_id) FROM apply_to WHERE trim(comp_id) <> ''),
s AS (
  SELECT k.ref_table, k.ref_field, k.row_id, k.ts, arg_max(e.arrived, {'moment': e.ts, 'gone': 1 - e.arrived}) AS live
  FROM k LEFT JOIN e ON e.key = k.key AND e.ts <= k.ts GROUP BY ALL),
o AS (SELECT ref_table, ref_field, row_id, strftime(ts, '%Y-%m') AS period FROM s WHERE coalesce(live, 0) = 0)
"""

# Members of loops are where a chain comes back to its own start; what is below stays below the member it runs into.
_BELOW = _TREE + """, o AS (SELECT comp_id FROM t WHERE again = comp_id),
f AS (SELECT w.comp_id, min(w.d) AS first FROM w JOIN o ON o.comp_id = w.cur GROUP BY 1),
b AS (SELECT w.cur AS comp_id, w.comp_id AS descendant, CAST(w.d AS BIGINT) AS distance FROM w LEFT JOIN f USING (comp_id)
  WHERE w.d > 0 AND w.d <= coalesce(f.first, w.d) AND w.comp_id NOT IN (SELECT comp_id FROM o))
"""

ORACLES = {
    "p4_found": _TREE + "SELECT comp_id, root_comp_id, depth FROM r",
    "p4_paths": _TREE + """, q AS (
  SELECT comp_id, string_agg(citation, ' > ' ORDER BY i DESC) AS path FROM (
    SELECT s.comp_id, p.citation, s.i FROM (SELECT comp_id, unnest(s) AS x, generate_subscripts(s, 1) AS i FROM (SELECT comp_id, CASE WHEN again IS NULL THEN seen ELSE list_slice(seen, 1, list_position(seen, again)) END AS s FROM t)) s
    JOIN p ON p.comp_id = s.x) GROUP BY 1),
n AS (SELECT cur AS comp_id, count(*) - 1 AS descendants FROM w GROUP BY 1)
SELECT r.comp_id, r.root_comp_id, r.depth, q.path, n.descendants FROM r JOIN q USING (comp_id) JOIN n USING (comp_id)""",
    "p4_loops": _TREE + "SELECT root_comp_id AS loop, count(*) AS components FROM r WHERE depth = -1 GROUP BY 1",
    "p4_descendants": _BELOW + "SELECT * FROM b",
    "p5_found": _ORPHANS + "SELECT * FROM o",
    "p5_report": _ORPHANS + "SELECT ref_table, ref_field, period, count(*) AS orphans FROM o GROUP BY ALL",
}
