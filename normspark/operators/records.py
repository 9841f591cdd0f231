"""Record-level operators: the latest version of a key, whatever else repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def latest(df: DataFrame, key: str, at: str, tie: Column | None = None) -> DataFrame:
    """One row per ``key``: the one with the latest ``at`` (nulls last), ties by ``tie`` ascending.

    Rows with a null key are dropped (they name no record). An empty table gives an empty table. Repeated identical
    rows give one row. Only the key is shuffled on, so a key with many versions is one small group; ordering is done
    by a sort, never by collecting the versions. Other columns pass through, whatever their names.
    """
    rn = fresh(df, "rn")
    order = [F.col(at).desc_nulls_last(), *([tie.asc_nulls_last()] if tie is not None else [])]
    w = Window.partitionBy(key).orderBy(*order)
    return df.filter(F.col(key).isNotNull()).withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)
