"""The whole way: raw tables to graph tables, as one plan per stage with the cuts where both sides of a stage need it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from normspark.functions import html
from normspark.operators import extract, graph, relations, repair, tree, units, vector
from normspark.operators.records import latest
from normspark.session import cut, spread


def transform(metadata: DataFrame, content: DataFrame, rel: DataFrame, sample: int | None = None, model=None) -> dict[str, DataFrame]:
    """Norms, components, issues, text units, index, relations and actions from the three raw tables.

    Metadata and pages that come more than once count once (the latest). Documents without a page keep their norm row. The
    amending side is the text of ``doc_id``, as relations list it. ``sample`` takes the first documents by id; ``model`` is a
    language model for sentences that the phrases miss (none by default).
    """
    meta = latest(metadata, "id", "loaded_at", F.xxhash64("title"))
    meta = meta.orderBy("id").limit(sample) if sample is not None else meta
    page = latest(content, "id", "loaded_at", F.xxhash64("content_html"))
    norms = extract.norms(meta)
    docs = page.join(meta.select("id"), "id", "left_semi").select(F.col("id").cast("string").alias("norm_id"), "content_html")
    md = html.converted(spread(docs)).drop("content_html")
    comp, said = repair.repaired(tree.components(md.select("norm_id", "markdown")))
    tu = cut(units.text_units(comp, norms), "units")
    index = cut(units.component_index(comp), "index")
    acts = cut(relations.actions(rel, tu, index, norms, model), "actions")
    return {"norms": norms, "components": comp.drop("ancestors", "raw_text"), "warnings": said, "text_units": tu, "component_index": index, "relations": relations.relations(rel), "actions": acts, "cache_units": relations.cache_units(acts)}


def embed(units_: DataFrame, provider=None) -> DataFrame:
    """Text units with vectors: those that lack one are embedded, the others kept."""
    return vector.with_embeddings(units_, vector.embedded(vector.pending(units_), provider))


def load(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Edges of the graph from the tables of ``transform``."""
    return {
        "edge_contains": graph.contains_edges(t["components"], t["norms"]),
        "edge_has_textunit": graph.has_textunit_edges(t["text_units"], t["text_units"].select("unit_id", "comp_id")),
        "edge_action": graph.action_edges(t["actions"], t["actions"], t["cache_units"], t["components"]),
        "edge_relation": graph.relation_edges(t["relations"], t["norms"]),
    }
