"""Near-duplicate records by an LSH forest: several sorted signature orders, neighbours by longest common prefix.

Each record becomes the set of its runs of ``SHINGLE`` words. Records with equal sets form a class and only one
representative goes on. A representative gets ``TREES`` labels, each a sequence of min-hashes. Rows of one tree are
sorted by label; a *region* is a run of rows with a common prefix of two levels. All rows of a region are compared with
each other by four-bit min-hash sketches, however many they are: small regions along the order, dense ones in tiles, and the
densest in pairs of salted blocks that are spread over the tasks. Surviving pairs are verified on the exact sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from normspark.llm.text import WORD, body, both, visible
from normspark.operators.references import Bloom
from normspark.session import cut

TREES, REGION = 24, 16
#: Min-hashes of a sketch, four bits of each: four words of 64 bits.
SKETCH, WORDS = 64, ("s0", "s1", "s2", "s3")
#: Candidates that a task gathers before it hands them on.
HELD = 1_000_000
#: Rows of a region that are compared at once: 512 x 512 sketches stay in the processor's cache.
TILE = 512
#: A region of more rows goes in blocks of about so many; how many it has is judged from one row in SAMPLE.
BLOCK, SAMPLE = 16_384, 16
#: Agreement of 64 that a pair must reach to be verified. At a similarity of 0.55 the mean is 37.0, the deviation 4.0, so
#: that one such pair in 2000 falls short; at 0.1, where most pairs of a prefix are, 10.0 and 2.9.
AGREE = 24
_rng = np.random.default_rng(20240607)
PERMS = TREES * 3
_A = _rng.integers(1, 2**63, PERMS, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 2**63, PERMS, dtype=np.uint64)
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, w: str) -> int:
        if len(self) > 2_000_000:  # a dictionary of whatever passes by; it may be emptied at any time
            self.clear()
        self[w] = h = xxhash.xxh64_intdigest(w)
        return h


def shingles(texts: list[str], words: dict, run: int, least_words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the runs of ``run`` words of each text; none below ``least_words`` words."""
    toks = [WORD.findall(t.lower()) for t in texts]
    toks = [x if len(x) >= max(least_words, run) else [] for x in toks]
    flat = np.fromiter((words[w] for x in toks for w in x), dtype=np.uint64, count=sum(map(len, toks)))
    if len(flat) < run:
        return [np.empty(0, np.uint64)] * len(texts)
    n = len(flat) - run + 1
    h = np.zeros(n, np.uint64)
    for k in range(run):
        h = _mix(h * _M1 + flat[k : k + n] + _M2)
    out, at = [], 0
    for x in toks:
        out.append(np.unique(h[at : at + len(x) - run + 1]) if x else np.empty(0, np.uint64))
        at += len(x)
    return out


def _short(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(32)).astype(np.uint32)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """One row of PERMS 32-bit min-hashes per (non-empty) set."""
    out = np.empty((len(sets), PERMS), np.uint32)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    lo = 0
    while lo < len(sets):  # pieces that stay in the processor's cache
        hi = max(lo + 1, int(np.searchsorted(np.cumsum(sizes[lo:]), 1 << 15, "right")) + lo)
        flat, at = np.concatenate(sets[lo:hi]), np.concatenate([[0], np.cumsum(sizes[lo:hi])[:-1]])
        for j in range(PERMS):
            out[lo:hi, j] = np.minimum.reduceat(((flat * _A[j] + _B[j]) >> np.uint64(32)).astype(np.uint32), at)
        lo = hi
    return out


def _signer(run: int, least_words: int):
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words()
        for pdf in batches:
            for lo in range(0, len(pdf), 2000):
                p = pdf.iloc[lo : lo + 2000]
                texts = [body(t) if s == "text_unit" else visible(t) for s, t in zip(p.source_table, p.text)]
                sets = shingles(texts, words, run, least_words)
                keep = np.array([len(s) > 0 for s in sets], bool)
                if not keep.any():
                    continue
                kept = [s for s, k in zip(sets, keep) if k]
                yield pd.DataFrame({
                    "source_table": p.source_table.to_numpy()[keep],
                    "key": p.key.to_numpy()[keep],
                    # two independent 64-bit sums of the set: equal for equal sets
                    "fp": [xxhash.xxh3_128_digest(s.tobytes()) for s in kept],
                    "grams": [np.unique(_short(s)).tobytes() for s in kept],
                })
    return sign


def signed(records: DataFrame, run: int, least_words: int) -> DataFrame:
    """``source_table, key, fp, grams`` of the records with enough words; grams holds the sorted shingle hashes, of 32 bits
    each: two sets of n shingles share about n*n/2**32 by chance, too few to move a similarity."""
    return records.select("source_table", "key", "text").mapInPandas(_signer(run, least_words), "source_table string, key string, fp binary, grams binary")


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of the trees: ``prefix`` (tree and two levels), ``id`` and a sketch."""
    for pdf in batches:
        for lo in range(0, len(pdf), 4000):
            p = pdf.iloc[lo : lo + 4000]
            m = minhashes([_mix(np.frombuffer(g, np.uint32).astype(np.uint64)) for g in p.grams]).astype(np.uint64)
            src = np.fromiter((xxhash.xxh64_intdigest(s) for s in p.source_table), np.uint64, len(p))
            bits = m[:, :SKETCH] & np.uint64(15)
            part = SKETCH // len(WORDS)
            sk = {w: np.bitwise_or.reduce(bits[:, h * part : (h + 1) * part] << (np.arange(part, dtype=np.uint64) * np.uint64(4)), axis=1).view(np.int64) for h, w in enumerate(WORDS)}
            parts = []
            for t in range(TREES):
                prefix = _mix(_mix(_mix(src + np.uint64(t)) + m[:, t * 3]) + m[:, t * 3 + 1])
                parts.append(pd.DataFrame({"prefix": prefix.view(np.int64), "id": p.id.to_numpy(), **sk}))
            yield pd.concat(parts)


def _agreement(sketch: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many of the min-hashes of rows ``i`` and ``j`` agree in their four bits; ``sketch`` holds a word in each row."""
    one, two = np.uint64(1), np.uint64(2)
    n = np.uint8(0)
    for s in sketch:
        x = s[i] ^ s[j]
        x |= x >> two
        x |= x >> one
        n = n + np.bitwise_count(x & np.uint64(0x1111111111111111))
    return SKETCH - n


def neighbours(prefix: np.ndarray, ids: np.ndarray, sketch: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs among rows in the trees' order, each with all that follow it under the same prefix."""
    live, k = np.arange(len(ids) - 1), 0
    while len(live):
        k += 1
        live = live[live + k < len(ids)]
        # rows of a region are adjacent, so a row without a partner at this distance has none farther away
        live = live[prefix[live] == prefix[live + k]]
        if len(live):
            ok = live[_agreement(sketch, live, live + k) >= AGREE]
            if len(ok):
                yield ids[ok], ids[ok + k]


def _all_pairs(ids: np.ndarray, sketch: np.ndarray, split: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs among all rows of a region, or, with ``split``, of the rows before it with those from it on."""
    n = len(ids)
    for lo in range(0, split or n, TILE):
        i = np.arange(lo, min(lo + TILE, split or n))[:, None]
        for at in range(split or lo, n, TILE):
            j = np.arange(at, min(at + TILE, n))[None, :]
            x, y = np.nonzero(_agreement(sketch, i, j) >= AGREE)
            if at == lo:
                x, y = x[x < y], y[x < y]
            if len(x):
                yield ids[lo + x], ids[at + y]


def _regions(batches: Iterator[pd.DataFrame], most: int = HELD) -> Iterator[pd.DataFrame]:
    """Candidates of the rows of a task, sorted by ``prefix`` (and ``side``, where there is one), in frames of about ``most``.

    side is 0 where a row meets all rows of its prefix, and 1 or 2 where it meets the rows of the other side.
    """
    left: list[pd.DataFrame] = []
    got: list[tuple[np.ndarray, np.ndarray]] = []

    def pairs(p: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        prefix, ids = p.prefix.to_numpy(), p.id.to_numpy()
        sketch = np.array([p[w].to_numpy() for w in WORDS]).view(np.uint64)
        side = p.side.to_numpy() if "side" in p else np.zeros(len(p), np.int64)
        ends = np.r_[np.flatnonzero(prefix[1:] != prefix[:-1]) + 1, len(p)]
        size = np.diff(ends, prepend=0)
        few = np.repeat(size <= REGION, size)
        yield from neighbours(prefix[few], ids[few], sketch[:, few])
        for hi, n in zip(ends[size > REGION], size[size > REGION]):
            r = slice(hi - n, hi)
            firsts = int((side[r] == 1).sum())
            if side[r].all():
                if 0 < firsts < n:
                    yield from _all_pairs(ids[r], sketch[:, r], firsts)
            else:
                yield from _all_pairs(ids[r], sketch[:, r])

    def frame() -> pd.DataFrame:
        x, y = (np.concatenate(c) for c in zip(*got))
        got.clear()
        return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    def out(p: pd.DataFrame) -> Iterator[pd.DataFrame]:
        n = 0
        for x in pairs(p):
            got.append(x)
            n += len(x[0])
            if n >= most:
                yield frame()
                n = 0
        if got:
            yield frame()

    for pdf in batches:
        if not len(pdf):
            continue
        if left and pdf.prefix.iloc[-1] == left[-1].prefix.iloc[-1]:  # all of one region that goes on
            left.append(pdf)
            continue
        p = pd.concat([*left, pdf], ignore_index=True)
        n = int((p.prefix.to_numpy() != p.prefix.iloc[-1]).sum())
        if n:
            yield from out(p.iloc[:n])
        left = [p.iloc[n:]]
    if left:
        yield from out(pd.concat(left, ignore_index=True))


def in_blocks(rows: DataFrame, dense: DataFrame) -> DataFrame:
    """``rows`` of the trees with a ``side``; those of a prefix in ``dense`` (prefix, blocks) once for each pair of blocks.

    A row's own block is drawn by its id. Any two rows of a prefix meet in just one pair of blocks, so whatever ``dense``
    says of a prefix changes where its rows are compared, not which ones.
    """
    own, one = F.pmod(F.xxhash64("id"), F.col("blocks")), F.col("blocks").isNull()
    r = rows.join(dense, "prefix", "left").withColumn("own", own)
    r = r.withColumn("other", F.explode(F.when(one, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    prefix = F.when(one, F.col("prefix")).otherwise(F.xxhash64("prefix", F.least("own", "other"), F.greatest("own", "other")))
    side = F.when(one | (F.col("own") == F.col("other")), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    return r.select(prefix.alias("prefix"), "id", *WORDS, side.cast("long").alias("side"))


def _exact(least: float):
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            sim = []
            for x, y in zip(p.grams_a, p.grams_b):
                x, y = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                both_ = len(np.intersect1d(x, y, assume_unique=True))
                sim.append(both_ / (len(x) + len(y) - both_))
            sim = np.array(sim, float)
            ok = sim >= least
            yield pd.DataFrame({"a": p.a[ok], "b": p.b[ok], "similarity": sim[ok]})
    return check


def classed(s: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``s`` (id, key, fp, ...) with an id for each set, and ``id, first`` of the sets that several records have.

    An id is 64 bits of a set's fingerprint. Where two sets share one, which a second hash of the fingerprint tells, their
    records get other ids, until each id is of one set.
    """
    while True:
        second = F.xxhash64("fp", F.lit(1))
        c = cut(s.groupBy("id").agg(F.min("key").alias("first"), F.count("*").alias("n"), F.min(second).alias("low"), F.max(second).alias("high")).filter("n > 1"), "classes")
        clash = c.filter("low <> high").select("id", F.lit(True).alias("clash"))
        if not clash.limit(1).count():
            return s.drop("fp"), c.select("id", "first")
        s = cut(s.join(clash, "id", "left").withColumn("id", F.when(F.col("clash"), F.xxhash64("id", "fp")).otherwise(F.col("id"))).drop("clash"), "grams")


def near_classes(records: DataFrame, run: int = 5, least: float = 0.8, least_words: int = 30, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Membership ``source_table, key, id`` (equal shingle sets share an id) and pairs ``a, b, similarity`` of ids (a < b).

    Null, empty and short texts have no row. Repeated keys are taken as given (callers pass one row per key). Long texts
    are used whole. Equal texts never meet in the forest: their class is one row there, however many copies it has.
    """
    s, first = classed(cut(signed(records, run, least_words).withColumn("id", F.xxhash64("source_table", "fp")), "grams"))
    member = s.select("source_table", "key", "id")
    # of equal sets the smallest key goes on; finding the others takes keys only, and of a hot class each is one short row
    others = cut(member.join(first, "id").filter("key > first").select("source_table", "key"), "copies")
    reps = s.join(others, ["source_table", "key"], "left_anti")
    trees = lambda r: r.select("source_table", "id", "grams").mapInPandas(_forest, "prefix long, id long, s0 long, s1 long, s2 long, s3 long")
    dense = trees(reps.filter(F.pmod("id", F.lit(SAMPLE)) == 0)).groupBy("prefix").agg(F.count("*").alias("n")).filter(F.col("n") > block / SAMPLE)
    dense = cut(dense.select("prefix", F.ceil(F.col("n") * SAMPLE / block).alias("blocks")), "dense")
    rows, by = trees(reps), ["prefix"]
    if dense.limit(1).count():
        rows, by = in_blocks(rows, dense), ["prefix", "side"]
    cand = rows.repartition("prefix").sortWithinPartitions(*by).mapInPandas(_regions, "a long, b long").distinct()
    cand = cut(cand, "pairs")
    ids = cand.select(F.col("a").alias("id")).union(cand.select("b")).distinct()
    # most sets are in no pair: a filter of bounded size keeps them out of the shuffle, the joins are exact
    g = Bloom(ids, "id").tested(reps.select("id", "grams"), "id").filter("_may").drop("_may")
    pairs = (
        cand.join(g.select(F.col("id").alias("a"), F.col("grams").alias("grams_a")), "a")
        .join(g.select(F.col("id").alias("b"), F.col("grams").alias("grams_b")), "b")
        .select("a", "b", "grams_a", "grams_b")
        .mapInPandas(_exact(least), "a long, b long, similarity double")
    )
    return member, pairs


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p1_found: pairs of near-identical records, runs of three words, similarity 0.55."""
    member, pairs = near_classes(both(spark, sf_dir), run=3, least=0.55, least_words=30)
    m = lambda s: member.select(F.col("id").alias(s), F.col("source_table").alias("t" + s), F.col("key").alias("k" + s))
    across = pairs.join(m("a"), "a").join(m("b"), "b").select(F.col("ta").alias("source_table"), "ka", "kb")
    copies = m("a").join(member.select(F.col("id").alias("a"), F.col("key").alias("kb")), "a").filter("ka < kb").select(F.col("ta").alias("source_table"), "ka", "kb")
    return across.unionByName(copies).select("source_table", F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b"))


def connected(pairs: DataFrame) -> DataFrame:
    """``id, root`` of the ids in ``pairs`` (a, b): the smallest id that links lead to, by large and small stars in turn.

    Each round hangs the neighbours of a node on its smallest one; rounds grow with the logarithm of the longest chain. A
    node with any number of links is a minimum and a join, never a list.
    """
    e = cut(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    while True:
        both_ = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both_.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both_.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        n = cut(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        same = [x.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first() for x in (e, n)]
        e = n
        if same[0] == same[1]:
            roots = e.select(F.col("v").alias("id")).distinct()
            return e.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots.select("id", F.col("id").alias("root")))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p1_groups: every compared record with its class (equal sets), its links to other classes and its group.

    One row per record: copies share a class and are not spread out into pairs. Runs of five words, similarity 0.8. The
    group is named by its smallest key.
    """
    member, pairs = near_classes(both(spark, sf_dir))
    pairs = cut(pairs, "verified")
    links = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).groupBy("id").agg(F.count("*").alias("links"))
    m = member.join(links, "id", "left").join(connected(pairs), "id", "left").withColumn("root", F.coalesce("root", "id"))
    name = m.groupBy("root").agg(F.min("key").alias("group_key"))
    return m.join(name, "root").select("source_table", F.col("key").alias("record_key"), F.hex("id").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), "group_key")
