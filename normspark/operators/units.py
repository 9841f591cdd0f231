"""Text units that carry their context, and the index from citation paths to components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from normspark.functions import text as X


def text_units(c: DataFrame, norms: DataFrame) -> DataFrame:
    """``unit_id, comp_id, norm_id, accumulated_text, type, language``: one unit for each component with text.

    The context line names the document and every ancestor. Documents without a row in ``norms`` have an empty title.
    """
    t = c.filter("raw_text is not null").join(norms.select("norm_id", "title"), "norm_id", "left")
    path = F.concat(F.array(F.coalesce("title", F.lit(""))), F.transform("ancestors", lambda x: X.label(x["citation"], x["title_text"])))
    text = F.concat(F.lit("["), F.array_join(path, " > "), F.lit("]\n"), X.strip(F.col("raw_text")))
    return t.select(F.concat("comp_id", F.lit("__tu")).alias("unit_id"), "comp_id", "norm_id", text.alias("accumulated_text"), F.lit("noi_dung").alias("type"), F.lit("vi").alias("language"))


def citation_paths(c: DataFrame) -> DataFrame:
    """``norm_id, comp_id, citation_path, pos``: from the component up to its article; without one, up to the root."""
    up = F.reverse("ancestors")
    # up to and including the nearest article
    upto = F.aggregate(up, F.struct(F.array().cast("array<string>").alias("p"), (F.col("level") == "Dieu").alias("over")), lambda a, x: F.struct(F.when(a["over"], a["p"]).otherwise(F.array_append(a["p"], x["citation"])).alias("p"), (a["over"] | (x["level"] == "Dieu")).alias("over")))
    return c.select("norm_id", "comp_id", F.array_join(F.concat(F.array("citation"), upto["p"]), " > ").alias("citation_path"), "pos")


def component_index(c: DataFrame) -> DataFrame:
    """``norm_id, citation_path, comp_id``: of components with the same path the one last in the document's list."""
    w = Window.partitionBy("norm_id", "citation_path").orderBy(F.col("pos").desc())
    return citation_paths(c).withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("norm_id", "citation_path", "comp_id")
