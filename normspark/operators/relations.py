"""Relations between documents, and amendments resolved to the component they change."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from normspark import schemas as S
from normspark.functions import text as X


def resolved(rel: DataFrame) -> DataFrame:
    """``rel`` with ``relation_type`` (null for unknown labels), ``from_norm_id`` and ``to_norm_id``; reversed labels swap the ends.

    The label map is 17 fixed rows, written into the expression; nothing is joined.
    """
    t = X.strip(F.col("relationship"))
    kind = F.create_map(*(F.lit(x) for name, k, _ in S.LABELS for x in (name, k)))[t]
    back = t.isin(*(name for name, _, b in S.LABELS if b))
    a, b = F.col("doc_id").cast("string"), F.col("other_doc_id").cast("string")
    return rel.withColumn("relation_type", kind).withColumn("from_norm_id", F.when(back, b).otherwise(a)).withColumn("to_norm_id", F.when(back, a).otherwise(b))


def relations(rel: DataFrame) -> DataFrame:
    """Known relations between two different documents; repeated rows are kept."""
    return resolved(rel).filter("relation_type is not null and from_norm_id <> to_norm_id")


def rejected(rel: DataFrame) -> DataFrame:
    """Rows with an unknown label."""
    return resolved(rel).filter("relation_type is null")


def eligible(c: Column) -> Column:
    return c.isin(*S.ELIGIBLE)


def citations(units: DataFrame) -> DataFrame:
    """``norm_id, comp_id, unit_id, citation_path`` of the units whose text amends a place.

    What a sentence cites does not depend on the document it is about, so it is taken out once per unit, before any join.
    """
    t = units.filter(X.strip(F.col("accumulated_text")) != "").withColumn("citation_path", X.amended(F.col("accumulated_text")))
    return t.filter("citation_path is not null").select("norm_id", "comp_id", "unit_id", "accumulated_text", "citation_path")


def citations_by_model(units: DataFrame, model: Callable[[str], str]) -> DataFrame:
    """The same rows for units that the phrases miss but that may amend: a language model's reply names the place.

    Off unless a model is given; replies that name none, or fail, give no row. Only units that pass the prefilter are sent.
    """
    text = F.col("accumulated_text")
    todo = units.filter(X.amended(text).isNull() & X.may_amend(text)).select("norm_id", "comp_id", "unit_id", "accumulated_text")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            said = []
            for t in p.accumulated_text:
                try:
                    said.append(model(t))
                except Exception:
                    said.append(None)
            yield p.assign(reply=said)

    got = todo.mapInPandas(ask, "norm_id string, comp_id string, unit_id string, accumulated_text string, reply string")
    return got.withColumn("citation_path", X.model_reply(F.col("reply"))).filter("citation_path is not null").drop("reply")


def actions(rel: DataFrame, units: DataFrame, index: DataFrame, norms: DataFrame, model: Callable[[str], str] | None = None) -> DataFrame:
    """Amendments as links: eligible relation, amending component, amended component.

    ``rel`` has ``row_id``. Relations to documents without indexed components fall away before anything else is joined. Ids
    are hashes of what an action is, so that a second run gives the same ones.
    """
    known = index.select(F.col("norm_id").alias("to_norm_id")).distinct()
    r = relations(rel).filter(eligible(F.col("relation_type"))).join(known, "to_norm_id", "left_semi").select("row_id", "from_norm_id", "to_norm_id", "relation_type")
    found = citations(units) if model is None else citations(units).unionByName(citations_by_model(units, model))
    c = found.withColumnRenamed("norm_id", "from_norm_id").withColumnRenamed("comp_id", "comp_a_id")
    i = index.select(F.col("norm_id").alias("to_norm_id"), "citation_path", F.col("comp_id").alias("comp_b_id"))
    n = norms.select(F.col("norm_id").alias("from_norm_id"), "norm_number")
    a = r.join(c, "from_norm_id").join(i, ["to_norm_id", "citation_path"]).join(n, "from_norm_id", "left")
    key = F.concat_ws("/", F.col("row_id").cast("string"), "comp_a_id", "comp_b_id", "relation_type", "citation_path")
    return a.select(
        F.sha2(key, 256).alias("action_id"), "relation_type", F.coalesce(F.nullif(F.col("norm_number"), F.lit("")), F.col("from_norm_id")).alias("amending_doc_number"), "comp_a_id", "comp_b_id",
        F.concat(F.sha2(key, 256), F.lit("__cache")).alias("cache_unit_id"), F.col("accumulated_text").alias("cache_text"), "from_norm_id", "to_norm_id", "citation_path",
    )


def cache_units(a: DataFrame) -> DataFrame:
    """The copies of amending texts that belong to actions, in the shape of text units."""
    return a.select(F.col("cache_unit_id").alias("unit_id"), F.col("cache_text").alias("accumulated_text"), F.lit("cache_action").alias("type"), F.lit("vi").alias("language"))


def extraction_outcomes(units: DataFrame) -> DataFrame:
    """``outcome, n``: units with a citation, units worth a language model's look, and the rest."""
    text = F.col("accumulated_text")
    o = F.when(X.amended(text).isNotNull(), "regex_hit").when(X.may_amend(text), "prefilter_hit").otherwise("prefilter_skip")
    return units.filter(X.strip(text) != "").groupBy(o.alias("outcome")).agg(F.count("*").alias("n"))
