"""Encoding by a distinct-word table, decoding, and packing."""

import random

import pytest
from pyspark.sql import functions as F

from normspark.llm import packing as P
from normspark.llm import tokens as T

TEXTS = [
    None, "", " ", "\n\n  \t", "Điều 1. Phạm vi điều chỉnh", "it's we'll IT'S", "<|endoftext|> x", "a  b   c\n d", "12,345 ½ ② x²", "農業合作社　審査", "naïve 😀👍🏽 é", "x" * 3000, "​­ zero", "tab\tnew\r\nline sep\u0085nel ",
    "từ " * 5000, "'s's '' \"q\" --- ...", "  lead", "ПРИВЕТ мир",
]


def docs(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("pos", F.lit("x"))


def test_ids_equal_the_tokenizer_and_decode_to_the_text(spark):
    enc = T._encoding(T.VOCABULARY)
    e = T.encode(docs(spark))
    got = {r["doc_id"]: list(r["ids"]) for r in e.collect()}
    assert got == {i: enc.encode_ordinary(t or "") for i, t in enumerate(TEXTS)}
    back = {r["doc_id"]: r["text"] for r in T.decode(e).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    assert {r["doc_id"]: r["tokens"] for r in T.sizes(docs(spark)).collect()} == {i: len(v) for i, v in got.items()}
    for hot in (0, 7):  # words that come back from the table
        assert {r["doc_id"]: list(r["ids"]) for r in T.encode(docs(spark), hot=hot).collect()} == got
        assert {r["doc_id"]: r["tokens"] for r in T.sizes(docs(spark), hot=hot).collect()} == {i: len(v) for i, v in got.items()}


def test_no_documents(spark):
    d = docs(spark).filter("false")
    assert T.encode(d).count() == 0 and T.decode(T.encode(d)).count() == 0 and P.pack(T.sizes(d)).count() == 0


def check(rows, sizes, cap):
    load, pieces = {}, {}
    for r in rows:
        load[r["container"]] = load.get(r["container"], 0) + r["size"]
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["size"]))
    assert max(load.values(), default=0) <= cap
    for d, n in sizes.items():
        got = [s for _, s in sorted(pieces.pop(d, []))]
        assert sum(got) == (n or 0) and len(got) == -(-(n or 0) // cap) and all(s == cap for s in got[:-1])
    assert not pieces
    return len(load)


@pytest.mark.parametrize("cap, draw", [(100, lambda g: g.randint(0, 60)), (100, lambda g: g.choice([34, 34, 34, 66, 51, 250])), (64, lambda g: 33), (50, lambda g: g.randint(1, 5)), (10, lambda g: g.randint(0, 40))])
def test_packing_is_whole_and_tight(spark, cap, draw):
    g = random.Random(7)
    sizes = {i: draw(g) for i in range(400)} | {1000: None}
    df = spark.createDataFrame(list(sizes.items()), "doc_id long, tokens long").withColumn("size", F.lit("x")).withColumn("salt", F.lit(1))
    n = check(P.pack(df, cap).collect(), sizes, cap)
    # no worse than plain best fit decreasing
    bins: list[int] = []
    for s in sorted((p for v in sizes.values() if v for p in [cap] * (v // cap) + [v % cap] if p), reverse=True):
        fit = [b for b in range(len(bins)) if bins[b] >= s]
        if fit:
            b = min(fit, key=lambda b: bins[b])
            bins[b] -= s
        else:
            bins.append(cap - s)
    assert n <= len(bins)


def placed(spark, counts, cap):
    df = spark.createDataFrame(list(counts.items()), "size long, number long")
    return sorted((r["size"], r["first"], r["number"], r["container"], r["per"]) for r in P.placed(df, cap).collect())


def test_every_rank_has_a_place_and_no_container_overflows(spark, monkeypatch):
    counts = {60: 5, 40: 7, 20: 9, 7: 31, 1: 3}
    for runs in (P.RUNS, 2):  # in one range, in several
        monkeypatch.setattr(P, "RUNS", runs)
        load: dict[int, int] = {}
        seen = {s: 0 for s in counts}
        for size, first, number, container, per in placed(spark, counts, 100):
            assert first == seen[size]
            seen[size] += number
            for k in range(number):
                load[container + k // per] = load.get(container + k // per, 0) + size
        assert seen == counts and max(load.values()) <= 100 and sorted(load) == list(range(len(load)))
    assert placed(spark, {}, 10) == []
