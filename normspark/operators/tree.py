"""Documents to component trees, by windows over their lines.

A marker's parent is the nearest earlier marker of smaller rank. One pass over the lines keeps, for each rank, the last
marker so far; of those the ones that no later marker of a smaller rank has closed are the ancestors, so parents, whole
ancestor chains and the flow of text from parents to first children need no self-join. Everything is partitioned by
document once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from normspark import schemas as S
from normspark.functions import text as X

RANKS = range(7)


def marked(docs: DataFrame) -> DataFrame:
    """``norm_id, i, line, level``: the lines of ``norm_id, markdown``, level null for body text.

    Article markers whose number jumps away and comes back are citations that a line break made look like markers; they
    count as body text. Null and empty documents have no lines.
    """
    # a given number of parts: the work is in the patterns, so parts must not be merged for being few bytes
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = docs.repartition(parts, "norm_id").select("norm_id", F.posexplode(X.lines(F.col("markdown"))).alias("i", "line"))
    d = d.withColumn("n", F.nullif(F.regexp_extract("line", r"(?U)^\s*[Đđ]iều\s+(\d+)", 1), F.lit("")).try_cast("int"))
    w = Window.partitionBy("norm_id").orderBy("i")
    last = F.last("n", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    # by an offset: a frame up to the end would be gone through again from every line
    nxt = F.expr("lead(n) IGNORE NULLS OVER (PARTITION BY norm_id ORDER BY i)")
    hits = F.count("n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = (F.col("n") - last > S.OUTLIER_JUMP) & (nxt < F.col("n")) & (nxt - last <= S.OUTLIER_RETURN) & (hits >= S.OUTLIER_LEAST)
    return d.withColumn("outlier", F.coalesce(out, F.lit(False))).select("norm_id", "i", "line", F.when(~F.col("outlier"), X.level(F.col("line"))).alias("level"))


def rank_of(level: Column) -> Column:
    return F.create_map(*(F.lit(x) for kv in S.RANK.items() for x in kv))[level]


def components(docs: DataFrame) -> DataFrame:
    """Components of ``norm_id, markdown``: ids, level, rank, citation, order, parent, title, ancestors and text.

    ``ancestors`` lists the chain from the root to the parent. ``raw_text`` is the text of leaves: the title on the marker's
    own line, the lines below, before them long text of a parent (first children only) and, for the first leaf, what stands
    before the first marker. Documents without any marker become one article; blank ones have no components.
    """
    m = marked(docs)
    w = Window.partitionBy("norm_id").orderBy("i")
    m = m.withColumn("owner", F.count("level").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    lv = F.col("level")
    m = m.select("norm_id", "i", "owner", "line", "level", F.when(lv.isNotNull(), X.citation(F.col("line"), lv)).alias("citation"), F.when(lv.isNotNull(), X.title(F.col("line"), lv)).alias("title_text"))
    m = m.withColumn("own", F.when(lv.isNull(), X.strip(F.col("line"))).otherwise(F.col("title_text")))
    n = m.groupBy("norm_id", F.col("owner").alias("ord")).agg(
        F.max("level").alias("level"), F.max("citation").alias("citation"), F.max("title_text").alias("title_text"),
        F.array_sort(F.collect_list(F.when(F.col("own").isNotNull(), F.struct("i", "own")))).alias("parts"),
    )
    text = F.when(F.size("parts") > 0, F.concat(F.array_join(F.transform("parts", lambda x: x["own"]), "\n"), F.lit("\n")))
    n = n.withColumn("raw", text).withColumn("rank", rank_of(F.col("level")))

    # what windows hold stays until their task ends, so there are two of them, and ids are spelled out after them
    wd = Window.partitionBy("norm_id").orderBy("ord")
    before, whole = wd.rowsBetween(Window.unboundedPreceding, -1), wd.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    node = F.struct("ord", "citation", "title_text", "level")
    lasts = [F.last(F.when(F.col("rank") == k, node), ignorenulls=True).over(before) for k in RANKS]
    ago = range(1, len(RANKS))
    alone = F.coalesce(F.max("ord").over(whole), F.lit(0)) == 0  # a document without markers
    n = n.select("norm_id", "ord", "level", "citation", "title_text", "raw", "rank", F.lead("rank").over(wd).alias("next_rank"), F.array(*lasts).alias("lasts"), alone.alias("alone"), *(F.lag(c, k).over(wd).alias(f"{c}{k}") for c in ("rank", "raw") for k in ago))
    # open: of a smaller rank than the node, and later than every marker of a rank smaller still
    at = lambda k: F.coalesce(F.col("lasts")[k]["ord"], F.lit(0))
    open_ = [F.when((F.lit(k) < F.col("rank")) & (at(k) > (reduce(F.greatest, [at(j) for j in range(k)], F.lit(0)) if k else F.lit(0))), F.col("lasts")[k]) for k in RANKS]
    n = n.withColumn("chain", F.filter(F.array(*open_), lambda x: x.isNotNull()))
    # text of long parents flows to first children: those that directly follow it. Each marker that a deeper one follows
    # gives its text to that one only, so the text of a chapter is in no other row
    given = F.array(*(F.when(F.col(f"rank{k - 1}" if k > 1 else "rank") > F.col(f"rank{k}"), F.col(f"raw{k}")) for k in reversed(ago)))
    long = lambda t: F.length(X.strip(t)) > S.PARENT_TEXT
    passed = F.aggregate(given, F.lit(""), lambda acc, g: F.when(long(F.concat(acc, g)), F.concat(acc, g)).otherwise(""))
    leaf = F.coalesce(F.col("next_rank") <= F.col("rank"), F.lit(True))
    kept = (F.col("ord") > 0) | F.col("alone")
    n = n.select("norm_id", "ord", "level", "citation", "title_text", "rank", "chain", "alone", F.when(F.col("ord") == 0, F.col("raw")).alias("preamble"), F.when(kept & leaf & F.col("raw").isNotNull(), F.concat(passed, "raw")).alias("raw_text"))
    first, preamble = F.min(F.when(F.col("raw_text").isNotNull(), F.col("ord"))).over(whole), F.max("preamble").over(whole)
    n = n.withColumns({"first": first, "preamble": preamble}).filter(kept)
    n = n.withColumn("raw_text", F.when((F.col("ord") == F.col("first")) & F.col("preamble").isNotNull() & ~F.col("alone"), F.concat("preamble", "raw_text")).otherwise(F.col("raw_text")))
    comp_id = lambda at: F.concat("norm_id", F.lit("__c"), at.cast("string"))
    short = F.transform("chain", lambda x: F.struct(comp_id(x["ord"]).alias("comp_id"), x["citation"].alias("citation"), x["title_text"].alias("title_text"), x["level"].alias("level"), rank_of(x["level"]).alias("rank")))
    k = F.when(F.col("alone"), 1).otherwise(F.col("ord"))
    return n.select(
        "norm_id", comp_id(k).alias("comp_id"), F.when(F.col("alone"), "Dieu").otherwise(F.col("level")).alias("level"), F.when(F.col("alone"), 4).otherwise(F.col("rank")).alias("rank"),
        F.when(F.col("alone"), "Điều 1").otherwise(F.col("citation")).alias("citation"), k.cast("int").alias("order_index"), F.when(F.size("chain") > 0, comp_id(F.element_at("chain", -1)["ord"])).alias("parent_comp_id"),
        "title_text", short.alias("ancestors"), "raw_text",
    )
