"""Hierarchies and orphan references against brute force, on awkward rows."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from normspark.operators import hierarchy as H
from normspark.operators import references as R
from normspark.operators.records import latest


def brute(parent):
    out = {}
    for x in parent:
        seen, cur = [], x
        while cur not in seen:
            seen.append(cur)
            up = parent[cur]
            if up is None or not up.strip() or up not in parent:
                out[x] = (len(seen) - 1, cur)
                break
            cur = up
        else:
            out[x] = (-1, min(seen[seen.index(cur):]))
    return out


def test_hierarchy_equals_brute_force_by_every_way(spark):
    rng = random.Random(1)
    ids = [f"n{i}" for i in range(400)]
    parent = {x: rng.choice([None, "", " ", "missing", *ids[: max(1, i)]]) for i, x in enumerate(ids)}
    parent |= {"a": "b", "b": "c", "c": "a", "s": "s", "under": "a", "below": "under", "deep0": None} | {f"deep{i}": f"deep{i - 1}" for i in range(1, 14)}
    want = brute(parent)
    df = spark.createDataFrame([(k, v, None if k == "n3" else f"C{k}", 1) for k, v in parent.items()] + [(None, "n1", "x", 1)], "comp_id string, parent string, citation string, depth int")
    for bound in (10_000, 20, 0):  # one task, a few supersteps, supersteps to the end with loops left
        got = {r["comp_id"]: r for r in H.hierarchy(df, local_nodes=bound).collect()}
        assert {k: (v["depth"], v["root"]) for k, v in got.items()} == want
        assert got["deep2"]["path"] == "Cdeep0 > Cdeep1 > Cdeep2"
        assert got["deep0"]["size"] == 14 and got["deep13"]["size"] == 1 and got["under"]["size"] == 2 and got["a"]["size"] == 5
    pairs = {(r["comp_id"], r["descendant"]): r["distance"] for r in H.ancestors(df.drop("depth"), H.hierarchy(df)).collect()}
    assert len(pairs) == sum(d for d, _ in want.values() if d > 0) and pairs["deep0", "deep13"] == 13 and ("a", "b") not in pairs


def test_descendants_below_loops(spark):
    parent = {"r": None, "x": "r", "y": "x", "a": "b", "b": "c", "c": "a", "s": "s", "under": "a", "below": "under", "side": "under", "low": "below", "lower": "low", "own": "s", "lost": "missing"}
    df = spark.createDataFrame([(k, v, "C") for k, v in parent.items()], "comp_id string, parent string, citation string")
    h = H.hierarchy(df)
    assert {r["comp_id"] for r in H.loop_members(df, h).collect()} == {"a", "b", "c", "s"}
    want = set()
    for x in parent:
        cur, d = x, 0
        while cur not in "abcs" and parent[cur] in parent:
            cur, d = parent[cur], d + 1
            want.add((cur, x, d))
    got = [tuple(r) for r in H.descendants(df, h).select("comp_id", "descendant", "distance").collect()]
    assert len(got) == len(want) and set(got) == want and ("under", "lower", 3) in want and ("a", "below", 2) in want
    tree = df.filter("comp_id in ('r', 'x', 'y')")
    assert H.descendants(tree, H.hierarchy(tree)).count() == 3 and H.descendants(tree.filter("false"), H.hierarchy(tree.filter("false"))).count() == 0


def test_hierarchy_of_nothing(spark):
    df = spark.createDataFrame([], "comp_id string, parent string, citation string")
    assert H.hierarchy(df).count() == 0 and H.ancestors(df, H.hierarchy(df)).count() == 0


def test_orphans_equal_brute_force(spark):
    rng, t0 = random.Random(2), datetime(2024, 1, 1)
    ev = [(rng.choice("abcdef"), t0 + timedelta(hours=rng.randint(0, 50)), rng.random() < 0.6) for _ in range(200)] + [(None, t0, True), ("a", None, True)]
    refs = [(i, rng.choice(["a", "b", "f", "zz", None]), rng.choice([None, t0 + timedelta(hours=rng.randint(-2, 60))]), "u") for i in range(300)]
    refs += refs[:3]  # repeated rows stay repeated
    want = []
    for r in refs:
        if r[1] is None:
            continue
        past = [(at, not up) for k, at, up in ev if k == r[1] and at is not None and r[2] is not None and at <= r[2]]
        if not past or max(past)[1]:
            want.append(r[0])
    e = spark.createDataFrame(ev, "key string, at timestamp, arrived boolean")
    f = spark.createDataFrame(refs, "row_id long, key string, at timestamp, until string").withColumn("since", F.lit(1)).withColumn("_word", F.lit(2))
    for bits in (1 << 25, 64):  # a good filter, and one that is full: the same rows
        got = R.orphans(f, e, max_bits=bits)
        assert got.columns == f.columns and sorted(r["row_id"] for r in got.collect()) == sorted(want)
    assert R.orphans(f.filter("false"), e).count() == 0
    assert R.orphans(f, e.filter("false")).count() == sum(r[1] is not None for r in refs)


def test_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    t = R.Bloom(keys).tested(spark.range(10000).select(F.col("id").cast("string").alias("k")), "k")
    n = t.groupBy("_may", (F.col("k").cast("int") < 5000).alias("own")).count().collect()
    assert {(r["_may"], r["own"]): r["count"] for r in n}.get((False, True)) is None
    assert sum(r["count"] for r in n if r["_may"] and not r["own"]) < 250


def test_spelled_integers(spark):
    rows = [("007", "7"), (" 12 ", "12"), ("21626.0", "21626"), ("-1", "-1"), ("+5", "5"), ("000", "0"), ("-0", "0"), ("1.5", None), ("N/A", None), ("", None), (None, None), ("1 2", None)]
    df = spark.createDataFrame([(a,) for a, _ in rows], "v string").select("v", R.spelled_integer(F.col("v")).alias("i"))
    assert {r["v"]: r["i"] for r in df.collect()} == dict(rows)


def test_latest_keeps_clashing_columns_and_breaks_ties(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([("k", t, 1, "b"), ("k", t, 2, "a"), ("k", None, 3, "c"), (None, t, 4, "d"), ("l", None, 5, "e")], "id string, at timestamp, rn int, v string")
    got = latest(df, "id", "at", F.col("v")).collect()
    assert {(r["id"], r["rn"]) for r in got} == {("k", 2), ("l", 5)}
    assert latest(df.filter("false"), "id", "at").count() == 0
