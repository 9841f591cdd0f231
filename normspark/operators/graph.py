"""The property graph as keyed tables: edge views, joins along them, reachability, sizes and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from normspark import schemas as S


def contains_edges(c: DataFrame, norms: DataFrame) -> DataFrame:
    """``src, dst``: document to root component, component to component. Edges to missing ends do not exist."""
    ids = c.select(F.col("comp_id").alias("_id")).distinct()
    nested = c.filter("parent_comp_id is not null").join(ids, F.col("parent_comp_id") == F.col("_id"), "left_semi").select(F.col("parent_comp_id").alias("src"), F.col("comp_id").alias("dst"))
    n = norms.select(F.col("norm_id").alias("_n")).distinct()
    root = c.filter("parent_comp_id is null").join(n, F.col("norm_id") == F.col("_n"), "left_semi").select(F.col("norm_id").alias("src"), F.col("comp_id").alias("dst"))
    return root.unionByName(nested).distinct()


def unit_owner(unit_id: Column) -> Column:
    """The component of a unit, by its id; parts of older tables carry a part number."""
    return F.regexp_replace(unit_id, r"__tu(?:__p\d+)?$", "")


def has_textunit_edges(units: DataFrame, owners: DataFrame | None = None) -> DataFrame:
    """``src`` (component), ``dst`` (unit): by the map of owners where it knows the unit, else by the id."""
    u = units.filter("type is null or type <> 'cache_action'")
    if owners is not None:
        u = u.join(owners.select("unit_id", F.col("comp_id").alias("_o")), "unit_id", "left")
        return u.select(F.coalesce("_o", unit_owner(F.col("unit_id"))).alias("src"), F.col("unit_id").alias("dst")).distinct()
    return u.select(unit_owner(F.col("unit_id")).alias("src"), F.col("unit_id").alias("dst")).distinct()


def action_edges(links: DataFrame, actions: DataFrame, cache: DataFrame, c: DataFrame) -> DataFrame:
    """``src, dst, kind`` of links whose action, copy and both components exist: three edges each."""
    ids = c.select(F.col("comp_id").alias("_id")).distinct()
    ok = links.join(actions.select("action_id").distinct(), "action_id", "left_semi").join(cache.select(F.col("unit_id").alias("cache_unit_id")).distinct(), "cache_unit_id", "left_semi")
    ok = ok.join(ids, F.col("comp_a_id") == F.col("_id"), "left_semi").join(ids, F.col("comp_b_id") == F.col("_id"), "left_semi")
    e = F.explode(F.array(
        F.struct(F.col("comp_a_id").alias("src"), F.col("action_id").alias("dst"), F.lit("HAS_ACTION").alias("kind")),
        F.struct(F.col("action_id").alias("src"), F.col("comp_b_id").alias("dst"), F.lit("APPLY_TO").alias("kind")),
        F.struct(F.col("action_id").alias("src"), F.col("cache_unit_id").alias("dst"), F.lit("HAS_TEXTUNIT").alias("kind")),
    ))
    return ok.select(e.alias("e")).select("e.*").distinct()


def relation_edges(rel: DataFrame, norms: DataFrame) -> DataFrame:
    """Distinct relations between documents of the corpus."""
    n = norms.select("norm_id").distinct()
    r = rel.join(n.withColumnRenamed("norm_id", "from_norm_id"), "from_norm_id", "left_semi").join(n.withColumnRenamed("norm_id", "to_norm_id"), "to_norm_id", "left_semi")
    return r.select("from_norm_id", "to_norm_id", "relation_type").distinct()


def unreached(c: DataFrame, resolved: DataFrame, norms: DataFrame) -> DataFrame:
    """Components that no path from a document reaches: their chain of parents ends in none, or in a missing one.

    ``resolved`` is what ``hierarchy`` gives; nothing is traversed again.
    """
    roots = c.filter("parent_comp_id is null").select(F.col("comp_id").alias("root"), "norm_id").join(norms.select("norm_id").distinct(), "norm_id", "left_semi").select("root")
    return resolved.filter("depth >= 0").join(roots, "root", "left_anti").select("comp_id").unionByName(resolved.filter("depth < 0").select("comp_id"))


def merged(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """One row per key, the latest by ``at``, null keys dropped: what repeated merges leave."""
    w = Window.partitionBy(*keys).orderBy(F.col(at).desc_nulls_last(), F.xxhash64(*[c for c in df.columns if c not in keys]))
    return df.filter(" and ".join(f"{k} is not null" for k in keys)).withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def sizes(norms: int, components: int, units: int, cache: int, actions: int, links: int, relations: int) -> dict[str, int]:
    return {"nodes": norms + components + units + cache + actions, "edges": components + units + cache + 2 * links + relations}


def within_budget(df: DataFrame, order: list[str], budget: int, each: int = 1) -> DataFrame:
    """The first rows by ``order`` that a budget of ``each`` per row allows."""
    return df.orderBy(*order).limit(max(0, budget // each))


def budgeted(tables: dict[str, tuple[DataFrame, list[str]]], max_nodes: int = S.MAX_NODES) -> dict[str, DataFrame]:
    """Node tables in the given order, each with what the ones before it left of the budget."""
    out, left = {}, max_nodes
    for name, (df, order) in tables.items():
        out[name] = within_budget(df, order, left)
        left -= min(left, df.count())
    return out


def budgeted_edges(edges: dict[str, DataFrame], nodes: DataFrame, max_edges: int = S.MAX_EDGES) -> dict[str, DataFrame]:
    """Edge tables in the given order: edges between the given ``nodes`` (id), within what is left of the budget.

    The first two columns of an edge table are its ends. Ties are in the order of all columns.
    """
    ids = nodes.select(F.col("id").alias("_id")).distinct()
    out, left = {}, max_edges
    for name, e in edges.items():
        for end in e.columns[:2]:
            e = e.join(ids, F.col(end) == F.col("_id"), "left_semi")
        out[name] = within_budget(e, e.columns, left)
        left -= min(left, e.count())
    return out
