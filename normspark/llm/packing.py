"""Filling fixed-capacity containers: best fit in bulk-synchronous supersteps.

Pieces and gaps are kept as sorted *runs*: all pieces of one size, or a range of containers with one gap. A superstep
range-sorts the runs of both kinds from large to small and sweeps over them: each piece gets the smallest gap that holds it
(its successor in the order) among those that larger pieces left over. Conflicts go by rank: the k-th piece of a run gets the
k-th container of the gap run it met. Then the gaps are what is left of them, and the next superstep follows, with the pieces
that found no gap and, when these are all placed, the next smaller ones, down to half their size. Where no gap is large
enough, containers are opened.

Runs are few whatever the number of documents, as sizes are integers up to the capacity; supersteps grow with the logarithm
of the capacity and with the pieces of a container. The documents are only read to count their sizes, and once more to turn
size and rank into a container.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from normspark.llm.tokens import sizes
from normspark.session import cut, release, table

CAPACITY = 2048
#: Parts into which the documents of one size are ranked apart, so that no size has to fit into one task.
SALTS = 64
#: Runs that one task sweeps over; more are swept by ranges, and what is left of these by wider ones.
RUNS = 1 << 16
#: Placements that are broadcast to the documents; more are joined as the planner sees fit.
PLACES = 1 << 20

GAP, PIECE, PLACED = 0, 1, 2
#: A run of gaps has the first of its containers as first, one of pieces the rank of the first in its size. Of a placed one,
#: ``per`` pieces go into each container from ``container`` on.
_STATE = "kind int, size long, first long, number long, container long, per long"


def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The runs of a range, from large to small, gaps first among equals: a piece takes from the gaps met last."""
    gaps: list[list[int]] = []
    out: list[tuple] = []
    for p in batches:
        for kind, size, first, number in zip(p.kind, p["size"], p["first"], p["number"]):
            if kind == GAP:
                gaps.append([size, first, number])
                continue
            while number and gaps:
                gap = gaps[-1]
                n = min(number, gap[2])
                out.append((PLACED, size, first, n, gap[1], 1))
                if gap[0] > size:
                    out.append((GAP, gap[0] - size, gap[1], n, 0, 0))
                gap[1], gap[2] = gap[1] + n, gap[2] - n
                if not gap[2]:
                    gaps.pop()
                first, number = first + n, number - n
            if number:
                out.append((PIECE, size, first, number, 0, 0))
    out += [(GAP, *g, 0, 0) for g in gaps]
    yield pd.DataFrame(out, columns=["kind", "size", "first", "number", "container", "per"])


def opened(made: int, capacity: int):
    """Containers for runs of pieces that no gap holds, numbered from ``made`` on and filled from large to small."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        new, left = made, 0  # the next number, and the room in the container before it
        for p in batches:
            for size, first, number in zip(p["size"], p["first"], p["number"]):
                if n := min(number, left // size):
                    out.append((PLACED, size, first, n, new - 1, n))
                    first, number, left = first + n, number - n, left - n * size
                if not number:
                    continue
                if left:
                    out.append((GAP, left, new - 1, 1, 0, 0))
                per = capacity // size
                full, rest = divmod(number, per)
                out.append((PLACED, size, first, number, new, per))
                if full and capacity > per * size:
                    out.append((GAP, capacity - per * size, new, full, 0, 0))
                new, left = new + full + (rest > 0), capacity - rest * size if rest else 0
        if left:
            out.append((GAP, left, new - 1, 1, 0, 0))
        yield pd.DataFrame(out, columns=["kind", "size", "first", "number", "container", "per"])

    return run


def _swept(active: DataFrame, runs: int) -> DataFrame:
    """The runs after one sweep: by ranges of RUNS runs, then what these left over by ranges eight times as wide, and on."""
    ranges = -(-runs // RUNS)
    done = []
    while ranges > 1:
        s = cut(active.repartitionByRange(ranges, F.desc("size")).sortWithinPartitions(F.desc("size"), "kind", "first").mapInPandas(sweep, _STATE), "swept")
        # gaps made in this sweep are for the next superstep, but meeting a piece now does no harm
        done.append(s.filter(F.col("kind") == PLACED))
        active, ranges = s.filter(F.col("kind") < PLACED), ranges // 8
    last = active.coalesce(1).sortWithinPartitions(F.desc("size"), "kind", "first").mapInPandas(sweep, _STATE)
    for d in done:
        last = last.unionByName(d)
    return last


def placed(counts: DataFrame, capacity: int) -> DataFrame:
    """``size, first, number, container, per``: where the pieces of each size go, of ``size, number`` (sizes up to capacity).

    Each row holds for the ranks from first on; ranks of a size start at 0. No row of it passes through the driver, which
    only learns how many runs and pieces are left.
    """
    zero = F.lit(0).cast("long")
    state = counts.select(F.lit(PIECE).alias("kind"), F.col("size").cast("long").alias("size"), zero.alias("first"), F.col("number").cast("long").alias("number"), zero.alias("container"), zero.alias("per"))
    kind, size, number = F.col("kind"), F.col("size"), F.col("number")
    low = capacity

    def step(nxt: DataFrame, least: int) -> tuple[DataFrame, dict]:
        seen = Observation()
        sees = (
            F.max(F.when(kind == PIECE, size)).alias("largest"), F.count(F.when(kind == PIECE, 1)).alias("pieces"), F.count(F.when(kind < PLACED, 1)).alias("runs"),
            F.sum(F.when((kind == PIECE) & (size > least), number)).alias("left"), F.min(F.when((kind == PIECE) & (size > least), size)).alias("smallest"), F.max(F.when(kind == GAP, size)).alias("gap"),
            F.max(F.when(kind == PLACED, F.col("container") + F.ceil(number / F.col("per")))).alias("made"),
        )
        got = cut(nxt.observe(seen, *sees), "runs")
        return got, seen.get

    state, now = step(state.coalesce(1), capacity)
    while now["pieces"]:
        if not now["left"]:  # the next sizes
            while low >= now["largest"]:
                low //= 2
            fits = bool(now["gap"])
        else:
            fits = (now["gap"] or 0) >= now["smallest"]
        part = (kind < PLACED) & (size > low)
        still = state.filter(~part)
        if fits:
            nxt = still.unionByName(_swept(state.filter(part), now["runs"]))
        else:
            nxt = still.unionByName(state.filter(part & (kind == GAP))).unionByName(
                state.filter(part & (kind == PIECE)).coalesce(1).sortWithinPartitions(F.desc("size"), "first").mapInPandas(opened(now["made"] or 0, capacity), _STATE)
            )
        before, (state, now) = state, step(nxt.coalesce(1 + now["runs"] // RUNS), low)
        release(before)
    return state.filter(kind == PLACED).drop("kind")


def pack(sized: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``container, doc_id, piece, size`` of ``doc_id, tokens``.

    Documents of size 0 (or null) are left out; one larger than the capacity is split into full pieces and a rest, others
    never. doc_id is taken as unique; repeated rows would count as separate documents with the same pieces. An empty
    table gives an empty result. A size that a third of all documents share is ranked in SALTS parts.
    """
    cap = F.lit(capacity).cast("long")
    items = (
        sized.filter("tokens > 0")
        .select("doc_id", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / cap))).alias("piece"))
        .select("doc_id", "piece", F.least(cap, F.col("tokens") - F.col("piece") * cap).alias("size"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
    )
    items = cut(items, "items")
    counted = cut(items.groupBy("size", "salt").agg(F.count("*").alias("n")), "sizes")  # capacity x SALTS rows at most
    places = placed(counted.groupBy("size").agg(F.sum("n").alias("number")), capacity)
    w = Window.partitionBy("size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    start = counted.select("size", "salt", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("start"))
    order = Window.partitionBy("size", "salt").orderBy("doc_id", "piece")
    ranked = items.withColumn("n", F.row_number().over(order) - 1).join(F.broadcast(start), ["size", "salt"]).select("doc_id", "piece", "size", (F.col("start") + F.col("n")).alias("rank"))
    places = places.withColumnRenamed("size", "of")
    places = F.broadcast(places) if places.count() <= PLACES else places
    here = (F.col("size") == F.col("of")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("number"))
    return ranked.join(places, here).select((F.col("container") + F.floor((F.col("rank") - F.col("first")) / F.col("per"))).alias("container"), "doc_id", "piece", "size")


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, sized in tokens of byte_bpe_50k, in containers of 2,048 tokens."""
    return pack(sizes(table(spark, sf_dir, "documents").select("doc_id", "text")))


def p9_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``containers, tokens, unused, fewest``: how full the containers are, and how few could do."""
    c = p9_containers(spark, sf_dir).agg(F.count_distinct("container").alias("containers"), F.coalesce(F.sum("size"), F.lit(0)).alias("tokens"))
    return c.select("containers", "tokens", (F.col("containers") * CAPACITY - F.col("tokens")).alias("unused"), F.ceil(F.col("tokens") / CAPACITY).alias("fewest"))
