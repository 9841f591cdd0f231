"""Near-duplicates and nearest vectors against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from normspark.llm import near_dup as N
from normspark.llm import vector_groups as G
from normspark.llm import vectors as V
from normspark.llm.text import body, visible
from normspark.session import cut

WORDS = [f"từ{i}" for i in range(400)]


def texts(seed=3):
    rng = random.Random(seed)
    out = []
    for g in range(25):
        base = [rng.choice(WORDS) for _ in range(rng.randint(40, 90))]
        out.append(base)
        for _ in range(rng.randint(0, 4)):
            t = list(base)
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = rng.choice(WORDS)
            cut = rng.randrange(len(t))
            out.append(t[cut:] + t[:cut] if rng.random() < 0.3 else t)
    return [" ".join(t) for t in out]


def brute(recs, run, least, words=30):
    sets = {}
    for s, k, t in recs:
        w = N.WORD.findall((body(t) if s == "text_unit" else visible(t)).lower()) if t else []
        if len(w) >= words:
            sets[s, k] = {tuple(w[i : i + run]) for i in range(len(w) - run + 1)}
    ks = sorted(sets)
    return {(a[0], a[1], b[1]) for i, a in enumerate(ks) for b in ks[i + 1 :] if a[0] == b[0] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= least}


def expand(member, pairs):
    by = {}
    for r in member.collect():
        by.setdefault(r["id"], []).append((r["source_table"], r["key"]))
    out = {(m[0][0], *sorted((x[1], y[1]))) for m in by.values() for i, x in enumerate(m) for y in m[i + 1 :]}
    for r in pairs.collect():
        out |= {(x[0], *sorted((x[1], y[1]))) for x in by[r["a"]] for y in by[r["b"]]}
    return out


def test_pairs_equal_brute_force(spark):
    t = texts()
    recs = [("text_unit", f"u{i}", f"[ngữ cảnh]\n{x}") for i, x in enumerate(t)] + [("content", str(i), f"<p>{x}</p><script>no</script>") for i, x in enumerate(t[:40])]
    # a hot group of copies, and rows that have no words to compare
    recs += [("text_unit", f"hot{i}", f"[khác {i}]\n{t[0]}") for i in range(60)] + [("text_unit", "null", None), ("text_unit", "empty", ""), ("text_unit", "short", "[x]\na b c"), ("content", "blank", "   ")]
    recs += [("text_unit", "long", "[x]\n" + " ".join(WORDS * 50)), ("text_unit", "long2", "[y]\n" + " ".join(WORDS * 50) + " thêm")]
    df = spark.createDataFrame(recs, "source_table string, key string, text string").withColumn("id", F.lit(1)).withColumn("fp", F.lit("x"))
    for run, least in ((3, 0.55), (5, 0.8)):
        assert expand(*N.near_classes(df, run, least)) == brute(recs, run, least)


def test_no_records(spark):
    df = spark.createDataFrame([], "source_table string, key string, text string")
    m, p = N.near_classes(df)
    assert m.count() == 0 and p.count() == 0


def test_rows_of_a_prefix_meet_and_others_do_not():
    prefix = np.repeat(np.arange(40), np.arange(40))
    got = list(N.neighbours(prefix, np.arange(len(prefix)), np.zeros((4, len(prefix)), np.uint64)))
    a, b = (np.concatenate(x) for x in zip(*got))
    assert len(a) == len(set(zip(a, b))) == sum(n * (n - 1) // 2 for n in range(40)) and (prefix[a] == prefix[b]).all()


def test_agreement_counts_equal_hashes():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 16, (2, 64)).astype(np.uint64)
    shift = np.arange(16, dtype=np.uint64) * np.uint64(4)
    sketch = np.array([[np.bitwise_or.reduce(row[w * 16 : w * 16 + 16] << shift) for row in h] for w in range(4)])
    assert N._agreement(sketch, np.array([0]), np.array([1]))[0] == (h[0] == h[1]).sum()
    assert N._agreement(sketch, np.array([0]), np.array([0]))[0] == 64


def test_a_hot_prefix_is_taken_in_parts():
    import pandas as pd

    rng = np.random.default_rng(1)
    n = 4000
    d = np.sort(rng.integers(-(2**62), 2**62, n))
    p = pd.DataFrame({"prefix": np.r_[np.zeros(n - 5, np.int64), np.ones(5, np.int64)], "deeper": d, "id": np.arange(n), "s0": 0, "s1": 0, "s2": 0, "s3": 0})
    run = lambda most: set(map(tuple, pd.concat(N._regions((p.iloc[i : i + 500] for i in range(0, n, 500)), most)).to_numpy()))
    assert run(1000) == run(10**9)


def test_sets_that_share_an_id_are_told_apart(spark):
    rows = [(7, "a", b"x"), (7, "b", b"x"), (7, "c", b"y"), (8, "d", b"z"), (8, "e", b"z"), (9, "f", b"w")]
    s, first = N.classed(spark.createDataFrame(rows, "id long, key string, fp binary"))
    ids = {r["key"]: r["id"] for r in s.collect()}
    assert ids["a"] == ids["b"] != ids["c"] and ids["d"] == ids["e"] == 8 and ids["f"] == 9 and "fp" not in s.columns
    assert {r["first"] for r in first.collect()} == {"a", "d"}


def test_a_large_group_of_near_copies_keeps_its_pairs(spark):
    """400 rows that all share a template: about the pairs that stand near the threshold, in one piece and in blocks."""
    rng = random.Random(5)
    base = [f"mẫu{i}" for i in range(60)]
    recs = []
    for i in range(400):
        t = base + [f"riêng{i}x{k}" for k in range(rng.randint(18, 26))]
        recs.append(("text_unit", f"u{i:03}", "[x]\n" + " ".join(t)))
    df = spark.createDataFrame(recs, "source_table string, key string, text string")
    want = brute(recs, 3, 0.55)
    assert 40_000 < len(want) < 79_800
    for block in (N.BLOCK, 100):
        got = expand(*N.near_classes(df, 3, 0.55, block=block))
        assert not got - want and len(got) >= 0.995 * len(want)


def test_blocks_meet_all_rows_of_a_region_once():
    import pandas as pd

    n = 1500
    p = pd.DataFrame({"prefix": np.zeros(n, np.int64), "id": np.arange(n), "s0": 0, "s1": 0, "s2": 0, "s3": 0})
    both_sides = p.assign(side=np.where(p.id < 700, 1, 2))
    all_ = pd.concat(N._regions(iter([p.iloc[:600], p.iloc[600:]])))
    across = pd.concat(N._regions(iter([both_sides])))
    assert len(all_) == len(all_.drop_duplicates()) == n * (n - 1) // 2
    assert len(across) == len(across.drop_duplicates()) == 700 * 800 and (across.a < 700).all() and (across.b >= 700).all()


def knn(ids, x, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(u @ u.T, 12)
    out = {}
    for i, a in enumerate(ids):
        out[a] = [ids[j] for j in sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-s[i, j], ids[j]))[:k]]
    return out


def test_nearest_equal_brute_force_with_ties(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 64)).astype("float32").astype(float)
    x[50:60] = x[0]  # more copies than the list is long
    x[70] = 2 * x[71]
    x[80:86] = 4 * x[0]  # as similar to the copies as they are to each other
    ids = [f"u{i:03d}" for i in rng.permutation(300)]
    bad = [("null", None), ("short", [1.0] * 32), ("zero", [0.0] * 64), ("nan", [float("nan")] + [1.0] * 63), ("inf", [float("inf")] + [1.0] * 63), ("hole", [None] + [1.0] * 63)]
    df = spark.createDataFrame([(a, [float(y) for y in v]) for a, v in zip(ids, x)] + bad, "unit_id string, embedding array<float>").withColumn("vkey", F.lit(0)).withColumn("vec", F.lit("x"))
    want = knn(ids, x, 5)
    for block in (V.BLOCK, 64):  # one block, several
        got = {r["unit_id"]: list(r["others"]) for r in V.nearest(df, 5, block).collect()}
        assert got == want


def test_groups_of_vectors_give_the_same_as_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(G, "CELL", 200)
    rng = np.random.default_rng(4)
    parts = [c + rng.normal(size=(m, 64)) * w for c, m, w in zip(rng.normal(size=(170, 64)), rng.integers(4, 40, 170), rng.uniform(0.02, 0.5, 170))]
    parts += [rng.normal(size=(60, 64)), np.ones((1, 64)) + rng.normal(size=(300, 64)) * 1e-4]  # near nothing, and near-copies
    x = np.concatenate(parts).astype(np.float32) * rng.uniform(0.1, 50, (sum(map(len, parts)), 1)).astype(np.float32)
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(x)], "no long, vec binary")
    asked = []
    monkeypatch.setattr(G, "cut", lambda d, name: asked.append((name, c := cut(d, name))) or c)
    got = {(r["no"], r["rank"]): r["other"] for r in V.similar(df, 5, 500, many=0).collect()}
    n = dict(asked)["pairs"].count()
    assert n < len(x) * 2  # of pairs of items, where there are len(x) ** 2 / 2 pairs of rows
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = np.round(u @ u.T, 12)
    np.fill_diagonal(s, -2)
    want = np.argsort(-s, axis=1, kind="stable")[:, :5]
    assert got == {(i, r): o for i, row in enumerate(want.tolist()) for r, o in enumerate(row)}


def test_vectors_without_groups_are_left_to_all_pairs(spark):
    x = np.random.default_rng(5).normal(size=(700, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(x)], "no long, vec binary")
    assert G.grouped(df, 700, 5, 500, 64) is None
    assert sorted(V.similar(df, 5, 500, many=0).collect()) == sorted(V.similar(df, 5, 500).collect())


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([("a", [1.0] * 64), ("b", [1.0] * 63 + [0.5])], "unit_id string, embedding array<float>")
    assert {r["unit_id"]: list(r["others"]) for r in V.nearest(df).collect()} == {"a": ["b"], "b": ["a"]}
    assert V.nearest(df.filter("false")).count() == 0


def test_connected_equals_union_find(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(400 + i, 401 + i) for i in range(40)] + [(900, 900 + i) for i in range(1, 80)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r["id"]: r["root"] for r in N.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert N.connected(spark.createDataFrame([], "a long, b long")).count() == 0
