"""Why a sentence does or doesn't resolve: its citation, the index entry, and the nearest entries there are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from normspark.functions import text as X
from normspark.sources.files import exists


def explained(units: DataFrame, index: DataFrame, from_norm: str, to_norm: str, candidates: int = 5) -> DataFrame:
    """``comp_id, citation_path, comp_b_id, may_amend, candidates`` for each unit of one document against another.

    Candidates are paths of the target that hold the citation's last part; how many to show is the feature.
    """
    u = units.filter(F.col("norm_id") == from_norm).select("comp_id", X.amended(F.col("accumulated_text")).alias("citation_path"), X.may_amend(F.col("accumulated_text")).alias("may_amend"))
    i = index.filter(F.col("norm_id") == to_norm).select(F.col("citation_path").alias("path"), F.col("comp_id").alias("comp_b_id"))
    hit = u.join(i, u["citation_path"] == i["path"], "left").drop("path")
    # a path is near where it ends in the same article: an equality on the last part, not a comparison of all with all
    last = lambda c: F.element_at(F.split(c, " > "), -1)
    near = i.select(last(F.col("path")).alias("last"), "path").withColumn("r", F.row_number().over(Window.partitionBy("last").orderBy("path"))).filter(F.col("r") <= candidates)
    near = near.groupBy("last").agg(F.array_sort(F.collect_list("path")).alias("candidates"))
    return hit.join(near, last(F.col("citation_path")) == F.col("last"), "left").drop("last")


def tables_present(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """``name, present, rows`` of the tables of a folder; counting reads no columns."""
    out = [(n, p := exists(spark, f"{folder}/{n}.parquet"), spark.read.parquet(f"{folder}/{n}.parquet").count() if p else None) for n in names]
    return spark.createDataFrame(out, "name string, present boolean, rows long")
