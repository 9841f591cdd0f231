"""The k most similar vectors of every vector: a block matrix join on int8 product tiles.

Equal vectors are one row of the matrix. The rows are dealt into blocks, and every pair of blocks meets once, in one task: its
tiles serve the rows of both. A tile of products of int8 codes gives every similarity within a known error of quantisation;
pairs that may still belong to the k best of either row are recomputed in float and merged. Each row's lists, one from each
pair of blocks that it was in, are merged last. The result is exact.

With n rows in blocks of b, work grows as n * n and a row is sent to n / b tasks. A block is as large as a task's memory
allows, so that reading two blocks takes no time beside multiplying them; smaller blocks serve only to give all cores a pair.
From ``MANY`` rows on, ``vector_groups`` does the same for groups of close vectors, if they form such.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from normspark.operators.records import latest
from normspark.session import cut, table

K, DIM = 5, 64
#: Rows of a block at most: two such blocks and what is worked out of them take some 270 MB of a task (measured).
BLOCK = 1 << 17
#: Rows of a block below which it is not worth a task of its own.
SMALL = 4096
#: Rows and columns of a tile: it stays in the processor's cache between product and comparison.
TILE, WIDE = 512, 2048
SALTS = 64
#: Rows from which on groups are worth their fixed cost.
MANY = 1 << 17


def usable(df: DataFrame, dim: int = DIM) -> DataFrame:
    """Rows whose ``embedding`` has ``dim`` finite values that are not all zero."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return df.filter((F.size(e) == dim) & finite & F.exists(e, lambda x: x != 0))


class Best:
    """The k best (similarity, smaller number first among equals) of each row of a block."""

    def __init__(self, rows: int, k: int) -> None:
        self.k = k
        self.sim = np.full((rows, k), -np.inf)
        self.at = np.full((rows, k), -1, np.int64)
        #: Where the k-th best is not known yet: what it is at least.
        self.bound = np.full(rows, -np.inf, np.float32)

    def least(self, rows: slice) -> np.ndarray:
        return np.maximum(self.sim[rows, -1].astype(np.float32) - np.float32(1e-6), self.bound[rows])

    def merge(self, row: np.ndarray, sim: np.ndarray, at: np.ndarray) -> None:
        ok = sim >= self.sim[row, -1]
        row, sim, at = row[ok], sim[ok], at[ok]
        if not len(row):
            return
        seen = np.zeros(len(self.sim), bool)
        seen[row] = True
        rows = np.flatnonzero(seen)
        old = self.at[rows] >= 0
        r = np.concatenate([row, np.repeat(rows, old.sum(1))])
        s = np.concatenate([sim, self.sim[rows][old]])
        a = np.concatenate([at, self.at[rows][old]])
        o = np.lexsort((a, -s, r))
        r, s, a = r[o], s[o], a[o]
        place = np.arange(len(r)) - np.searchsorted(r, rows)[np.cumsum(np.r_[False, r[1:] != r[:-1]])]
        keep = place < self.k
        self.sim[rows], self.at[rows] = -np.inf, -1
        self.sim[r[keep], place[keep]], self.at[r[keep], place[keep]] = s[keep], a[keep]


class Block:
    """Rows with their numbers, int8 codes and the error that the codes leave."""

    def __init__(self, p: pd.DataFrame, k: int) -> None:
        self.no = np.frombuffer(b"".join(p["nos"]), np.int64)
        self.vec = np.frombuffer(b"".join(p["vecs"]), np.float32).reshape(len(self.no), -1)
        n = len(self.no)
        self.norm, self.scale, self.err = np.empty(n), np.empty(n, np.float32), np.empty(n, np.float32)
        self.codes = np.empty(self.vec.shape, np.int8)
        for lo in range(0, n, 8192):
            at = slice(lo, lo + 8192)
            x = self.vec[at].astype(np.float64)
            self.norm[at] = np.linalg.norm(x, axis=1)
            u = x / self.norm[at, None]
            scale = np.abs(u).max(axis=1, keepdims=True) / 127
            q = np.rint(u / scale)
            self.codes[at], self.scale[at] = q, scale[:, 0]
            self.err[at] = np.linalg.norm(u - q * self.scale[at, None], axis=1) + 1e-6
        self.best = Best(n, k)

    def tile(self, at: slice) -> np.ndarray:
        """The codes times their scales: products of two such rows are the int8 products times both scales."""
        return self.codes[at] * self.scale[at, None]

    def unit(self, at: np.ndarray) -> np.ndarray:
        return self.vec[at].astype(np.float64) / self.norm[at, None]


def meet(a: Block, b: Block, k: int) -> None:
    """All rows of ``a`` with all of ``b`` (or, if these are one block, all pairs of its rows), into the best of both."""
    same = a is b
    wide = [slice(c, min(c + WIDE, len(b.no))) for c in range(0, len(b.no), WIDE)]
    tiles = [np.ascontiguousarray(b.tile(c).T) for c in wide]
    errs = [b.err[c].max() for c in wide]
    for lo in range(0, len(a.no), TILE):
        rows = slice(lo, min(lo + TILE, len(a.no)))
        left, err = a.tile(rows), a.err[rows]
        for c, right, most in zip(wide, tiles, errs):
            if same and c.stop <= lo:  # met before, the other way round
                continue
            tile = left @ right
            slack = err + most * (1 + err)
            across = err.max() + b.err[c] * (1 + err.max())
            # nothing known yet: the k best of this tile (one of which may be the row itself) bound from below
            for best, at, t, gap in ((a.best, rows, tile, slack), (b.best, c, tile.T, across)):
                if t.shape[1] > k and not np.isfinite(best.least(at)).all():
                    best.bound[at] = np.maximum(best.bound[at], np.partition(t, t.shape[1] - k - 1, axis=1)[:, t.shape[1] - k - 1] - gap)
            over = tile >= (a.best.least(rows) - slack)[:, None]
            over |= tile >= (b.best.least(c) - across)[None, :]
            i, j = np.divmod(np.flatnonzero(over.ravel()), over.shape[1])
            i, j = i + lo, j + c.start
            if same:
                ok = i < j
                i, j = i[ok], j[ok]
            for at in range(0, len(i), 1 << 16):  # in pieces, whatever the number
                x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                sim = np.round(np.einsum("ij,ij->i", a.unit(x), b.unit(y)), 12)
                a.best.merge(x, sim, b.no[y])
                b.best.merge(y, sim, a.no[x])


LISTS = "no long, sims binary, others binary"


def lists_of(no: np.ndarray, best: Best) -> pd.DataFrame:
    n = (best.at >= 0).sum(1)
    return pd.DataFrame({"no": no, "sims": [s[:m].tobytes() for s, m in zip(best.sim, n)], "others": [x[:m].tobytes() for x, m in zip(best.at, n)]})


def _pairs(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a partition is one pair of blocks, or none
        p = pd.concat(list(batches) or [pd.DataFrame({"role": [], "nos": [], "vecs": []})])
        blocks = [Block(q, k) for r in (0, 1) if len(q := p[p.role == r])]
        alone = len(p) and p.alone.iloc[0]
        del p
        if blocks and (alone or len(blocks) == 2):
            meet(blocks[0], blocks[-1], k)
        for b in blocks:
            yield lists_of(b.no, b.best)

    return run


def _merged(k: int):
    """The k best of all lists of a number; rows come sorted by number."""

    def few(p: pd.DataFrame) -> pd.DataFrame:
        n = p.sims.map(len).to_numpy() // 8
        r = np.repeat(p.no.to_numpy(), n)
        s, a = np.frombuffer(b"".join(p.sims), np.float64), np.frombuffer(b"".join(p.others), np.int64)
        o = np.lexsort((a, -s, r))
        r, s, a = r[o], s[o], a[o]
        first = np.r_[True, r[1:] != r[:-1]] if len(r) else np.empty(0, bool)
        rank = np.arange(len(r)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(r) else np.empty(0, np.int64)
        ok = rank < k
        return pd.DataFrame({"no": r[ok], "rank": rank[ok], "sim": s[ok], "other": a[ok]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left: pd.DataFrame | None = None
        for p in batches:
            p = p if left is None else pd.concat([left, p], ignore_index=True)
            if len(p):
                whole = p.no != p.no.iloc[-1]
                yield few(p[whole])
                left = p[~whole]
        if left is not None:
            yield few(left)

    return run


def _chunks(blocks: int):
    """Rows of many vectors each, by block: a row of its own for each vector would double what is sent."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            own = p.block.to_numpy()
            o = np.argsort(own, kind="stable")
            ends = np.searchsorted(own[o], np.arange(blocks + 1))
            no, vec = p.no.to_numpy()[o], p.vec.to_numpy()[o]
            some = [b for b in range(blocks) if ends[b] < ends[b + 1]]
            yield pd.DataFrame({"block": some, "nos": [no[ends[b] : ends[b + 1]].tobytes() for b in some], "vecs": [b"".join(vec[ends[b] : ends[b + 1]]) for b in some]})

    return run


def parts(spark: SparkSession, n: int, block: int) -> int:
    """Blocks of ``n`` rows: as few as have a pair for each core, while blocks are not small; more where memory asks."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, ceil(n / block), min(ceil((isqrt(8 * cores + 1) - 1) / 2), n // SMALL))


def by_pairs(vectors: DataFrame, g: int, run, schema: str) -> DataFrame:
    """``run`` on each pair of ``g`` blocks of ``no, vec``, a partition each."""
    d = vectors.select("no", "vec", F.pmod(F.xxhash64("no"), F.lit(g)).cast("int").alias("block"))
    d = d.mapInPandas(_chunks(g), "block int, nos binary, vecs binary").withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(g - 1))))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    pair = (high * (high + 1) / 2 + low).cast("int")
    met = d.select(pair.alias("pair"), (F.col("block") == high).cast("int").alias("role"), (low == high).alias("alone"), "nos", "vecs")
    met = met.repartitionById(g * (g + 1) // 2, F.col("pair")).select("role", "alone", "nos", "vecs")
    return met.mapInPandas(run, schema)


def similar(vectors: DataFrame, k: int = K, block: int = BLOCK, many: int = MANY) -> DataFrame:
    """``no, rank, sim, other`` of unique ``no, vec`` (bytes of float32): the k most similar other rows of each row.

    rank starts at 0. Equal similarities (to 12 digits) go by the smaller number.
    """
    n = vectors.count()
    lists = None
    if n >= many:
        from normspark.llm.vector_groups import grouped

        lists = grouped(vectors, n, k, block, DIM)
    if lists is None:
        lists = by_pairs(vectors, parts(vectors.sparkSession, n, block), _pairs(k), LISTS)
    return lists.repartition("no").sortWithinPartitions("no").mapInPandas(_merged(k), "no long, rank int, sim double, other long")


def _as_bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    # a vector as bytes of float32: arrays would cost an object a value on their way to Python
    for p in batches:
        yield pd.DataFrame({"unit_id": p.unit_id, "no": p.no, "vec": [np.asarray(e, np.float32).tobytes() for e in p.embedding]})


def numbered(units: DataFrame, at: str | None = None, tie: Column | None = None) -> DataFrame:
    """``unit_id, no, vec``: the usable vectors, numbered in the order of unit_id; of each unit_id the row latest by ``at``.

    One shuffle by ranges of unit_id serves both to find the latest rows and to number in order.
    """
    u = units.repartitionByRange("unit_id")
    u = latest(u, "unit_id", at, tie) if at else u.filter("unit_id is not null")
    u = usable(u).select("unit_id", "embedding").sortWithinPartitions("unit_id")
    return u.withColumn("no", F.monotonically_increasing_id()).mapInPandas(_as_bytes, "unit_id string, no long, vec binary")


def by_number(u: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """``no, rank, other`` (rank from 1) of ``no, vec``: the k most similar others of every row, equal vectors among them.

    Copies of a vector are found by two independent hashes of it. Only one row of each goes into the blocks, so a vector that
    a third of all rows hold costs no more than others; its k + 1 first numbers stand for them all in any list.
    """
    two = [F.xxhash64("vec").alias("h0"), F.xxhash64("vec", F.lit(1)).alias("h1")]
    keys = u.select("no", *two)
    first = keys.groupBy("h0", "h1").agg(F.min("no").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    copies = cut(keys.join(first, ["h0", "h1"]).select("no", "first"), "copies")
    alone = u.join(copies.filter("no <> first").select("no"), "no", "left_anti").select("no", "vec")
    lists = similar(alone, k, block)
    if not copies.limit(1).count():
        return lists.select("no", (F.col("rank") + 1).alias("rank"), "other")
    lists = cut(lists, "lists")
    # the k + 1 first members of a class, ranked within salts before they meet
    c = copies.withColumn("salt", F.pmod(F.xxhash64("no"), F.lit(SALTS)))
    c = c.withColumn("r", F.row_number().over(Window.partitionBy("first", "salt").orderBy("no"))).filter(F.col("r") <= k + 1)
    c = c.withColumn("r", F.row_number().over(Window.partitionBy("first").orderBy("no"))).filter(F.col("r") <= k + 1).select("first", F.col("no").alias("member"))
    own = copies.filter("no = first").select("no", F.lit(1.0).alias("sim"), F.col("no").alias("other"))
    touched = lists.join(own.select(F.col("other").alias("o")), F.col("other") == F.col("o"), "left_semi").select("no").union(own.select("no")).distinct()
    x = lists.select("no", "sim", "other").join(touched, "no").unionByName(own)
    x = x.join(c, F.col("other") == F.col("first"), "left").select("no", "sim", F.coalesce("member", "other").alias("other"))
    best = Window.partitionBy("no").orderBy(F.desc("sim"), "other")
    # one more than k, as each member of a class leaves itself out
    x = x.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).groupBy("no").agg(F.array_sort(F.collect_list(F.struct("r", "other"))).alias("all"))
    each = x.join(copies.select(F.col("no").alias("unit"), "first"), F.col("no") == F.col("first"), "left").select(F.coalesce("unit", "no").alias("no"), "all")
    each = each.select("no", F.slice(F.filter(F.transform("all", lambda y: y["other"]), lambda y: y != F.col("no")), 1, k).alias("all"))
    rest = lists.join(touched, "no", "left_anti").select("no", (F.col("rank") + 1).alias("rank"), "other")
    return rest.unionByName(each.select("no", F.posexplode("all").alias("rank", "other")).withColumn("rank", F.col("rank") + 1))


def named(pairs: DataFrame, u: DataFrame, **columns: str) -> DataFrame:
    """``pairs`` with the unit_id of each number: ``columns`` gives the new name of each column of numbers."""
    for old, new in columns.items():
        pairs = pairs.join(u.select(F.col("no").alias(old), F.col("unit_id").alias(new)), old).drop(old)
    return pairs


def nearest(units: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """``unit_id, others``: for each of ``unit_id, embedding`` the ids of the k most similar other units, best first.

    Unusable vectors (null, other length, NaN, infinite, all zero) have no row and are in no list. Equal similarities (to
    12 digits) go by the smaller unit_id. Units with equal vectors are each other's most similar. unit_id has to be unique.
    With fewer than k other units the list is shorter, a unit without any others has no row; an empty table gives an empty
    result.
    """
    u = cut(numbered(units.select("unit_id", "embedding")), "vectors")
    got = named(by_number(u.select("no", "vec"), k, block), u, no="unit_id", other="name")
    return got.groupBy("unit_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "name"))), lambda x: x["name"]).alias("others"))


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "text_unit").filter("type = 'noi_dung' and unit_id is not null").select("unit_id", "updated_at", "embedding")
    return cut(numbered(t, "updated_at", F.xxhash64("embedding")), "vectors")


def p7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most similar units of every unit with a usable vector, by rank."""
    u = _units(spark, sf_dir)
    return named(by_number(u.select("no", "vec")), u, no="unit_id", other="name").select("unit_id", F.col("rank").cast("int").alias("rank"), F.col("name").alias("other"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of units of which either is among the other's five most similar."""
    u = _units(spark, sf_dir)
    p = by_number(u.select("no", "vec")).select(F.least("no", "other").alias("a"), F.greatest("no", "other").alias("b")).distinct()
    return named(p, u, a="unit_a", b="unit_b")  # numbers are in the order of the ids
