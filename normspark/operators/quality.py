"""Data quality: the report over text units, and the checks of a loaded graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from normspark.functions import text as X

# Control characters, citations that name an outer level before an inner one, the mark of a citation that the
# parser could not take apart, and the share of such from which a report is flagged.
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
REVERSED = r"^(?:Điều\s+\S+\s+Khoản|Khoản\s+\S+\s+Điểm|Điều\s+\S+\s+Điểm).*$"
FALLBACK, FALLBACK_SHARE = "_FULL_", 5.0


def flagged(units: DataFrame, text: str = "accumulated_text") -> DataFrame:
    """Units with all flags of the report as columns, from one pass over the text."""
    t, b = F.col(text), X.body(F.col(text))
    n = F.length(X.strip(b))
    return units.select(
        "unit_id", X.format_class(t).alias("format"), X.length_bucket(n).alias("length"), F.coalesce(t.contains("�"), F.lit(False)).alias("replacement"),
        F.coalesce(t.rlike(CONTROL), F.lit(False)).alias("control"), F.coalesce(X.prose_tables(t), F.lit(0)).alias("tables"), F.coalesce(X.has_pipe_table(b), F.lit(False)).alias("pipe_table"),
        F.coalesce(t.rlike(r"(?m)^Bảng \[\]:"), F.lit(False)).alias("empty_header"), t.isNull().alias("null_text"),
    )


def sampled(units: DataFrame, n: int | None) -> DataFrame:
    """``n`` units drawn by a hash of their ids: the same ones whenever it is asked; all without ``n``."""
    return units if n is None else units.orderBy(F.xxhash64("unit_id", F.lit(7)), "unit_id").limit(n)


def report(units: DataFrame) -> DataFrame:
    """``section, metric, value, pct``: format classes, length buckets, odd characters, tables. One pass over the text."""
    f = flagged(units)
    row = lambda section, metric: F.struct(F.lit(section).alias("section"), metric.alias("metric"))
    marks = [row("flags", F.when(F.col(c), F.lit(c))) for c in ("replacement", "control", "pipe_table", "empty_header", "null_text")]
    said = F.array(
        row("format", F.col("format")), row("length", F.when(~F.col("null_text"), F.col("length"))), row("tables", F.when(F.col("tables") >= 5, F.lit(">=5")).otherwise(F.col("tables").cast("string"))),
        row("flags", F.when(F.col("tables") > 0, F.lit("has_table"))), *marks,
    )
    r = f.select(F.explode(said).alias("x")).select("x.*").filter("metric is not null").groupBy("section", "metric").agg(F.count("*").alias("value"))
    # every unit has one format, so these rows sum to the units; the table is a handful of rows by now
    total = F.sum(F.when(F.col("section") == "format", F.col("value"))).over(Window.partitionBy(F.lit(0)))
    return r.withColumn("pct", F.round(100.0 * F.col("value") / total, 1))


def fallbacks(c: DataFrame) -> DataFrame:
    """``components, fallback, pct, flagged``: citations that the parser could not take apart; flagged above 5 %."""
    hit = F.coalesce(F.col("citation").contains(FALLBACK), F.lit(False))
    r = c.agg(F.count("*").alias("components"), F.count_if(hit).alias("fallback"))
    pct = F.coalesce(F.try_divide(100.0 * F.col("fallback"), F.col("components")), F.lit(0.0))
    return r.select("components", "fallback", F.round(pct, 1).alias("pct"), (pct > FALLBACK_SHARE).alias("flagged"))


def leaf_coverage(c: DataFrame, units: DataFrame) -> DataFrame:
    """``leaves, covered, pct``: leaves that have a text unit; 0 % where there are no leaves."""
    parents = c.select(F.col("parent_comp_id").alias("comp_id")).filter("comp_id is not null").distinct()
    owned = units.filter("type <> 'cache_action'").select(F.regexp_replace("unit_id", r"__tu(?:__p\d+)?$", "").alias("comp_id"), F.lit(1).alias("u")).distinct()
    leaves = c.select("comp_id").distinct().join(parents, "comp_id", "left_anti").join(owned, "comp_id", "left")
    return leaves.agg(F.count("*").alias("leaves"), F.count("u").alias("covered")).select("leaves", "covered", F.coalesce(F.round(F.try_divide(100.0 * F.col("covered"), F.col("leaves")), 1), F.lit(0.0)).alias("pct"))


def one_ended(actions: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """``actions, no_source, no_target``: actions without a component that has them, or that they apply to."""
    a = actions.select("action_id").distinct()
    s = sources.select("action_id", F.lit(1).alias("s")).distinct()
    t = targets.select("action_id", F.lit(1).alias("t")).distinct()
    a = a.join(s, "action_id", "left").join(t, "action_id", "left")
    return a.agg(F.count("*").alias("actions"), F.count_if(F.col("s").isNull()).alias("no_source"), F.count_if(F.col("t").isNull()).alias("no_target"))


def short_units(units: DataFrame, least: int = 20) -> DataFrame:
    """``units, short, pct``: content units with fewer than 20 characters."""
    u = units.filter("type = 'noi_dung'")
    n = F.length(X.strip(F.col("accumulated_text")))
    return u.agg(F.count("*").alias("units"), F.count_if(F.coalesce(n, F.lit(0)) < least).alias("short")).select("units", "short", F.coalesce(F.round(F.try_divide(100.0 * F.col("short"), F.col("units")), 1), F.lit(0.0)).alias("pct"))


def reversed_citations(c: DataFrame) -> DataFrame:
    """Components whose citation names an outer level before an inner one."""
    return c.filter(F.col("citation").rlike(REVERSED)).select("comp_id", "citation")


def embedded_share(units: DataFrame) -> DataFrame:
    """``units, embedded, pct`` of content units."""
    u = units.filter("type = 'noi_dung'")
    return u.agg(F.count("*").alias("units"), F.count("embedding").alias("embedded")).select("units", "embedded", F.coalesce(F.round(F.try_divide(100.0 * F.col("embedded"), F.col("units")), 1), F.lit(0.0)).alias("pct"))
