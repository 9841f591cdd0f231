"""Repairs and checks of component trees: duplicates, ghosts, small leaves, swallowed clauses, articles and points.

Every operator takes and gives components as ``tree.components`` makes them, plus ``pos``, the place in the document's list:
original components by order, recovered ones after all others, in the order of the repairs. All windows are by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from normspark import schemas as S
from normspark.functions import text as X
from normspark.session import cut

def _asked(c: DataFrame, flag: Column, of: Column) -> DataFrame:
    """``c`` with ``_flag``, what ``flag`` says of a component, and ``_any``: whether it says so of any component in ``of``.

    A row goes out once for itself and once, without its columns, for each component it asks about. What is asked of one
    component meets at its id, and answers meet at the one that asked: no row holds the ids of its document, and with the
    document's rows together nothing is shuffled.
    """
    ask = lambda k, yes: F.struct(k.alias("k"), F.lit(yes).alias("asks"))
    e = c.select("norm_id", F.col("comp_id").alias("_id"), F.coalesce(flag, F.lit(False)).alias("_said"), F.struct("*").alias("_row"), F.explode(F.concat(F.array(ask(F.col("comp_id"), False)), F.transform(of, lambda x: ask(x, True)))).alias("_x"))
    mine = ~F.col("_x.asks")
    e = e.select("norm_id", "_id", F.col("_x.k").alias("_k"), mine.alias("_mine"), F.when(mine, F.col("_said")).alias("_flag"), F.when(mine, F.col("_row")).alias("_row"))
    e = e.withColumn("_told", F.max("_flag").over(Window.partitionBy("norm_id", "_k")))
    e = e.withColumn("_any", F.coalesce(F.max(F.when(~F.col("_mine"), F.col("_told"))).over(Window.partitionBy("norm_id", "_id")), F.lit(False)))
    return e.filter("_mine").select("_row.*", "_flag", "_any")


def _without(c: DataFrame, bad: Column) -> DataFrame:
    """Components left when those marked ``bad`` go, with everything below them."""
    return _asked(c, bad, F.transform("ancestors", lambda x: x["comp_id"])).filter("not _flag and not _any").drop("_flag", "_any")


def _with_parents_marked(c: DataFrame) -> DataFrame:
    """``c`` with ``_parent``: whether a component of its document names it as parent."""
    e = c.select("norm_id", F.struct("*").alias("_row"), F.explode(F.array(F.struct(F.col("comp_id").alias("k"), F.lit(True).alias("own")), F.struct(F.col("parent_comp_id").alias("k"), F.lit(False).alias("own")))).alias("_x"))
    e = e.select("norm_id", F.col("_x.k").alias("_k"), F.col("_x.own").alias("_own"), F.when(F.col("_x.own"), F.col("_row")).alias("_row"))
    return e.withColumn("_parent", F.max(~F.col("_own")).over(Window.partitionBy("norm_id", "_k"))).filter("_own").select("_row.*", "_parent")


def deduplicated(c: DataFrame) -> DataFrame:
    """Of components with the same parent and citation the one with the best text; losers go with their descendants.

    Scores tie to the earlier component. Null parents (the root) count as equal.
    """
    w = Window.partitionBy("norm_id", "parent_comp_id", "citation").orderBy(X.text_score(F.col("raw_text")).desc(), "order_index", "comp_id")
    c = c.withColumn("_best", F.row_number().over(w) == 1)
    return _without(c, ~F.col("_best")).drop("_best")


def _with_resets(c: DataFrame) -> DataFrame:
    """``n`` (article number), ``prev`` (last number among sibling articles) and ``tail``: at or after their first descent."""
    article = F.col("level") == "Dieu"
    w = Window.partitionBy("norm_id", "parent_comp_id").orderBy("order_index")
    c = c.withColumn("n", F.when(article, X.article_number(F.col("citation"))))
    c = c.withColumn("prev", F.last("n", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return c.withColumn("tail", article & (F.max(F.coalesce(F.col("n") < F.col("prev"), F.lit(False))).over(w)))


def _parent_rank(c: Column) -> Column:
    return F.when(F.size(c) == 0, F.lit(-1)).otherwise(F.element_at(c, -1)["rank"])


def without_ghosts(c: DataFrame) -> DataFrame:
    """Articles after a descent of sibling numbers whose citation also stands under a shallower parent go, with all below."""
    d = _with_resets(c).withColumn("_depth", _parent_rank(F.col("ancestors")))
    same = Window.partitionBy("norm_id", "citation")
    least = F.min(F.when(F.col("level") == "Dieu", F.col("_depth"))).over(same)
    d = d.withColumn("_ghost", F.col("tail") & (least < F.col("_depth")))
    return _without(d, F.col("_ghost")).drop("n", "prev", "tail", "_depth", "_ghost")


_ISSUE = ("norm_id", "issue_type", "severity", "comp_id", "details")


def _issue(d: DataFrame, kind: str, severity: str, comp: Column, **details: Column) -> DataFrame:
    kv = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    return d.select("norm_id", F.lit(kind).alias("issue_type"), F.lit(severity).alias("severity"), comp.alias("comp_id"), F.create_map(*kv).alias("details"))


def issues(c: DataFrame) -> DataFrame:
    """What is still inconsistent: duplicate citations, parents that do not exist, descending article numbers."""
    dup = c.groupBy("norm_id", "parent_comp_id", "citation").agg(F.count("*").alias("n"), F.min("comp_id").alias("first")).filter("n > 1")
    ids = c.select(F.col("norm_id").alias("_n"), F.col("comp_id").alias("_p"))
    lost = c.filter("parent_comp_id is not null").join(ids, (F.col("norm_id") == F.col("_n")) & (F.col("parent_comp_id") == F.col("_p")), "left_anti")
    g = _with_resets(c).filter(F.col("n") < F.col("prev"))
    g = g.withColumn("_k", F.row_number().over(Window.partitionBy("norm_id", "parent_comp_id").orderBy("order_index"))).filter("_k = 1")
    return (
        _issue(dup, "dup_citation", "warn", F.col("first"), parent_id=F.col("parent_comp_id"), citation=F.col("citation"), count=F.col("n"))
        .unionByName(_issue(lost, "broken_parent", "error", F.col("comp_id"), missing_parent=F.col("parent_comp_id")))
        .unionByName(_issue(g, "ghost_citation", "warn", F.col("comp_id"), parent_id=F.col("parent_comp_id"), prev_num=F.col("prev"), curr_num=F.col("n")))
    )


def same_titles(c: DataFrame) -> DataFrame:
    """A2: components of one document and level that share a title: ``norm_id, level, title_text, n, first``.

    A group instead of its pairs, as a title that many share would give their square. Components without a title are none.
    """
    t = c.filter(F.coalesce(X.strip(F.col("title_text")), F.lit("")) != "")
    return t.groupBy("norm_id", "level", "title_text").agg(F.count("*").alias("n"), F.min("comp_id").alias("first")).filter("n > 1")


def _rule(d: DataFrame, rule: str, severity: Column | str, comp: Column, **details: Column) -> DataFrame:
    kv = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    sev = F.lit(severity) if isinstance(severity, str) else severity
    return d.select(F.lit(rule).alias("rule"), "norm_id", comp.alias("comp_id"), sev.alias("severity"), F.create_map(*kv).alias("details"))


def small_leaves_merged(c: DataFrame) -> tuple[DataFrame, DataFrame]:
    """D2: a leaf of fewer than 10 characters gives its text to its parent; the component stays. Components and rows of the fix."""
    c = _with_parents_marked(c).withColumn("_small", F.coalesce(~F.col("_parent") & (F.length("raw_text") < S.SMALL_LEAF) & F.col("parent_comp_id").isNotNull(), F.lit(False))).drop("_parent")
    small = c.filter("_small")
    given = small.groupBy(F.col("norm_id").alias("_n"), F.col("parent_comp_id").alias("_p")).agg(F.array_sort(F.collect_list(F.struct("pos", "raw_text"))).alias("_t"))
    given = given.select("_n", "_p", F.regexp_replace(F.array_join(F.transform("_t", lambda x: x["raw_text"]), "\n"), r"^\n+", "").alias("_given"))
    d = c.join(given, (c["norm_id"] == F.col("_n")) & (c["comp_id"] == F.col("_p")), "left")
    kept = F.when(F.col("_small"), None).when(F.col("_given").isNull(), F.col("raw_text")).when(F.coalesce(F.col("raw_text"), F.lit("")) == "", F.col("_given")).otherwise(F.concat("raw_text", F.lit("\n"), "_given"))
    fix = _rule(small, "D2", "fix", F.col("comp_id"), text_len=F.length("raw_text"), parent_id=F.col("parent_comp_id"))
    return d.withColumn("raw_text", kept).drop("_small", "_n", "_p", "_given"), fix


def _segments(text: Column, pattern: str) -> Column:
    """The text cut before each line that begins with a marker: (text, number or letter of its marker, '' for the intro)."""
    return F.transform(F.split(text, rf"(?m)(?={pattern})"), lambda x: F.struct(x.alias("text"), F.regexp_extract(x, pattern.replace("(?m)", ""), 1).alias("no")))


def _recovered(found: DataFrame, level: str, word: str, tag: str, parent: Column, ancestors: Column) -> DataFrame:
    """New components from ``take``, the segments taken out of the text of each row's component."""
    e = found.select("*", F.posexplode("take").alias("_j", "_seg"))
    return e.select(
        "norm_id", F.concat("comp_id", F.lit(f"__{tag}"), F.col("_seg.no"), F.lit("_rec")).alias("comp_id"), F.lit(level).alias("level"), F.lit(S.RANK[level]).alias("rank"),
        F.concat(F.lit(word + " "), F.col("_seg.no")).alias("citation"), (F.col("order_index") + F.col("_j") + 1).cast("int").alias("order_index"), parent.alias("parent_comp_id"),
        F.lit(None).cast("string").alias("title_text"), ancestors.alias("ancestors"), X.rstrip(F.col("_seg.text")).alias("raw_text"), (F.col("pos") * 1000 + F.col("_j")).alias("_by"),
    )


def _added(c: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` after all others of its document, in the order of the components they came from."""
    top = c.groupBy("norm_id").agg(F.max("pos").alias("_top"))
    w = Window.partitionBy("norm_id").orderBy("_by")
    n = new.withColumn("_r", F.row_number().over(w)).join(top, "norm_id").withColumn("pos", F.col("_top") + F.col("_r")).drop("_by", "_r", "_top")
    return c.unionByName(n)


def _taken(c: DataFrame, hit: DataFrame, level: str, word: str, tag: str, rule: str, comp: Column, **details: Column) -> tuple[DataFrame, DataFrame]:
    """Apply a recovery: ``hit`` has a component's columns, ``take`` (segments to become components) and ``keep`` (its own text then)."""
    hit = hit.withColumn("_some", F.size("take") > 0)
    some = hit.filter("_some")
    left = some.select(F.col("norm_id").alias("_n"), F.col("comp_id").alias("_c"), F.col("keep").alias("_keep"))
    d = c.join(left, (c["norm_id"] == F.col("_n")) & (c["comp_id"] == F.col("_c")), "left").withColumn("raw_text", F.when(F.col("_c").isNotNull(), F.col("_keep")).otherwise(F.col("raw_text"))).drop("_n", "_c", "_keep")
    said = _rule(hit, rule, F.when(F.col("_some"), "fix").otherwise("warn"), comp, recovered=F.array_join(F.transform("take", lambda x: x["no"]), ","), **details)
    return _added(d, _recovered(some, level, word, tag, F.col("parent_comp_id"), F.col("ancestors"))), said


def sole_clauses(c: DataFrame) -> DataFrame:
    """Clauses that are the only one of their article."""
    w = Window.partitionBy("norm_id", "parent_comp_id")
    return c.filter("level = 'Khoan'").withColumn("_n", F.count("*").over(w)).filter("_n = 1 and size(ancestors) > 0 and element_at(ancestors, -1).level = 'Dieu'").drop("_n")


def article_gaps(c: DataFrame) -> DataFrame:
    """Articles (number ``n``) after which numbers of the document's articles are missing, up to ``nxt``; by number, not place."""
    a = c.filter("level = 'Dieu'").withColumn("n", X.article_number(F.col("citation"))).filter("n is not null")
    return a.withColumn("nxt", F.lead("n").over(Window.partitionBy("norm_id").orderBy("n", "pos"))).filter("nxt - n > 1")


def letter_gaps(c: DataFrame) -> DataFrame:
    """The first point of each clause (place ``at`` in the alphabet) after which letters are missing, up to ``nxt``."""
    w = Window.partitionBy("norm_id", "parent_comp_id").orderBy("order_index", "comp_id")
    p = c.filter("level = 'Diem' and size(ancestors) > 0 and element_at(ancestors, -1).level = 'Khoan'").withColumn("at", X.letter_position(F.col("citation"))).filter("at is not null")
    p = p.withColumn("nxt", F.lead("at").over(w)).filter("nxt - at > 1")
    return p.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def clauses_recovered(c: DataFrame, original: DataFrame) -> tuple[DataFrame, DataFrame]:
    """C2: where an article has one clause only, clauses 2 and up that its text swallowed become components."""
    kin = sole_clauses(original).select("norm_id", "comp_id")
    sole = c.join(kin, ["norm_id", "comp_id"], "left_semi")
    pattern = r"(?m)^(\d+)\.\s"
    s = sole.withColumn("segs", F.when(F.coalesce("raw_text", F.lit("")) != "", _segments(F.col("raw_text"), pattern)).otherwise(F.array().cast("array<struct<text:string,no:string>>")))
    more = lambda x: F.coalesce(x["no"].try_cast("bigint") > 1, F.lit(False))
    s = s.withColumn("take", F.filter("segs", more))
    # what stands before the first of them stays
    before = F.aggregate("segs", F.struct(F.lit("").alias("t"), F.lit(False).alias("over")), lambda a, x: F.struct(F.when(a["over"] | more(x), a["t"]).otherwise(F.concat(a["t"], x["text"])).alias("t"), (a["over"] | more(x)).alias("over")))
    s = s.withColumn("keep", X.rstrip(before["t"])).withColumn("_article", F.col("parent_comp_id"))
    return _taken(c, s, "Khoan", "Khoản", "k", "C2", F.col("_article"), only_khoan=F.col("citation"))


def articles_recovered(c: DataFrame) -> tuple[DataFrame, DataFrame]:
    """B1: where the numbers of a document's articles leave a gap, articles of the gap in the text before it become components."""
    a = article_gaps(c)
    pattern = r"(?m)^(?iu:Điều)\s+(\d+)\s*[.:]"
    s = a.withColumn("segs", F.when(F.coalesce("raw_text", F.lit("")) != "", _segments(F.col("raw_text"), pattern)).otherwise(F.array().cast("array<struct<text:string,no:string>>")))
    inside = lambda x: F.coalesce((x["no"].try_cast("bigint") > F.col("n")) & (x["no"].try_cast("bigint") < F.col("nxt")), F.lit(False))
    s = s.withColumn("take", F.filter("segs", inside))
    rest = F.filter(F.transform(F.filter("segs", lambda x: ~inside(x)), lambda x: X.rstrip(x["text"])), lambda x: x != "")
    s = s.withColumn("keep", X.strip(F.array_join(rest, "\n")))
    return _taken(c, s, "Dieu", "Điều", "d", "B1", F.col("comp_id"), from_dieu=F.col("n"), to_dieu=F.col("nxt"))


def points_recovered(c: DataFrame, original: DataFrame) -> tuple[DataFrame, DataFrame]:
    """B4: the first gap in the letters of a clause's points, filled from the text before it."""
    p = letter_gaps(original).select("norm_id", "comp_id", "at", "nxt")
    s = c.join(p, ["norm_id", "comp_id"])
    pattern = r"(?m)^((?iu:[a-zđ]))\.\s"
    s = s.withColumn("segs", F.when(F.coalesce("raw_text", F.lit("")) != "", _segments(F.col("raw_text"), pattern)).otherwise(F.array().cast("array<struct<text:string,no:string>>")))
    s = s.withColumn("segs", F.transform("segs", lambda x: F.struct(x["text"].alias("text"), F.lower(x["no"]).alias("no"))))
    gap = F.expr(f"substring('{S.ALPHABET}', at + 2, nxt - at - 1)")
    inside = lambda x: (x["no"] != "") & (F.instr(gap, x["no"]) > 0)
    s = s.withColumn("take", F.filter("segs", inside))
    rest = F.filter(F.transform(F.filter("segs", lambda x: ~inside(x)), lambda x: X.rstrip(x["text"])), lambda x: x != "")
    s = s.withColumn("keep", X.strip(F.array_join(rest, "\n"))).withColumn("_clause", F.col("parent_comp_id"))
    letter = lambda k: F.expr(f"substring('{S.ALPHABET}', {k} + 1, 1)")
    return _taken(c, s, "Diem", "Điểm", "dp", "B4", F.col("_clause"), from_char=letter("at"), to_char=letter("nxt"))


def checks(c: DataFrame) -> DataFrame:
    """C1, C3, D1, E1: one long article alone, groups without articles, texts of unusual length, jumps of level."""
    per = c.groupBy("norm_id").agg(F.count_if(F.col("level") == "Dieu").alias("articles"), F.sum(F.length("raw_text")).alias("total"), F.max(F.when(F.col("level") == "Dieu", F.col("comp_id"))).alias("comp_id"))
    c1 = _rule(per.filter((F.col("articles") == 1) & (F.col("total") >= S.LONG_TEXT)), "C1", "warn", F.col("comp_id"), dieu_count=F.lit(1), total_content_chars=F.col("total"))
    have = c.filter("level = 'Dieu'").select("norm_id", F.explode("ancestors").alias("a")).select("norm_id", F.col("a.comp_id").alias("comp_id")).distinct()
    c3 = _rule(c.filter(F.col("level").isin(*S.GROUP_LEVELS)).join(have, ["norm_id", "comp_id"], "left_anti"), "C3", "warn", F.col("comp_id"), level=F.col("level"))
    t = c.filter(F.coalesce("raw_text", F.lit("")) != "").select("norm_id", "comp_id", "level", F.length("raw_text").alias("len"))
    med = t.groupBy("norm_id", "level").agg(F.median("len").alias("med"), F.count("*").alias("k")).filter("k >= 3")
    t = t.join(med, ["norm_id", "level"])
    mad = t.groupBy("norm_id", "level").agg(F.median(F.abs(F.col("len") - F.col("med"))).alias("mad"))
    t = t.join(mad, ["norm_id", "level"]).withColumn("most", F.col("med") + S.MAD_FACTOR * F.greatest("mad", F.lit(1.0)))
    d1 = _rule(t.filter("len > most"), "D1", "warn", F.col("comp_id"), text_len=F.col("len"), threshold=F.round("most"))
    up = F.element_at("ancestors", -1)
    e1 = _rule(c.filter((F.size("ancestors") > 0) & (F.col("rank") - up["rank"] > 2)), "E1", "bug", F.col("comp_id"), parent_id=F.col("parent_comp_id"), rank_gap=F.col("rank") - up["rank"])
    return c1.unionByName(c3).unionByName(d1).unionByName(e1)


def repaired(c: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deduplicated and repaired components (with ``pos``), and the rows of all rules. The order of repairs is fixed:

    duplicates, ghosts, D2, C2, B1, B4, then the checks; C2 and B4 look at the children there were before any recovery.
    """
    base = cut(without_ghosts(deduplicated(c)).withColumn("pos", F.col("order_index").cast("long")), "components")
    d2, w1 = small_leaves_merged(base)
    c2, w2 = clauses_recovered(d2 := cut(d2, "d2"), d2)
    b1, w3 = articles_recovered(c2 := cut(c2, "c2"))
    b4, w4 = points_recovered(b1 := cut(b1, "b1"), d2)
    done = cut(b4, "repaired")
    return done, w1.unionByName(w2).unionByName(w3).unionByName(w4).unionByName(checks(done))
