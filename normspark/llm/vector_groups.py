"""The k most similar vectors of every vector, where vectors lie in groups: whole groups are told apart by their centres.

Vectors close to each other are gathered into groups: in each round all groups go to the nearest of some sampled vectors, and
what meets there and is close becomes one. How well this goes decides only on the time. A group has a centre, the largest
angle ``radius`` of a member to it, and ``reach``, the largest sum of a member's angles to the centre and to the k-th best
that is known of it (its ``far``); vectors that would make either large, and those of groups too small to know k others, are
items of their own with radius 0.

Angles keep the triangle inequality: no member of item a has one of the k best in item b if their centres are further apart
than reach a + radius b. The block matrix join meets the centres of all items, each pair of blocks once, and leaves
the pairs of items that this doesn't rule out; then members are ruled out one by one in the same way (by far and by their
own angle to the centre of b), and the others are sent to item b and compared with all of its members in float. The result is exact.

Work is about a round's cells for each row, and the square of the number of items, not of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from normspark.llm.vectors import LISTS, TILE, WIDE, Best, Block, by_pairs, lists_of, meet, parts
from normspark.session import cut

ROUNDS = 6
#: Groups that meet in a cell on average, at most at once, and cells at most.
CELL, MOST_AT_ONCE, CELLS = 2048, 4096, 4096
#: Centres this similar become one group, of so many rows at most.
NEAR, HELD = 0.88, 1 << 16
#: Radians to the centre, and from there over the vector to its k-th best, up to which a vector stays in its group.
RADIUS, REACH = np.radians(21), np.radians(46.5)
#: Rows of a group up to which all its products are looked at together.
FEW = 1024
#: What rounding may take from a product of float32 or float64.
EPS32, EPS64 = 1e-5, 1e-9


def _unit(vecs: np.ndarray) -> np.ndarray:
    x = vecs.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _angle(cos: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cos, -1, 1))


def _cos(angle: np.ndarray) -> np.ndarray:
    """The product from which on vectors are within ``angle``."""
    return np.cos(np.minimum(angle, np.pi))


# ---- groups ------------------------------------------------------------------------------------------------------------

_CELL = "cell int, sizes binary, nos binary, sums binary"


def _dealt(sizes: np.ndarray, nos: np.ndarray, sums: np.ndarray, pivots: np.ndarray) -> pd.DataFrame:
    """Groups by the nearest pivot of each: many to a row."""
    cell = np.concatenate([(sums[lo : lo + WIDE] @ pivots.T).argmax(1) for lo in range(0, len(sizes), WIDE)])
    sizes, nos, sums, starts = _ordered(cell, sizes, nos, sums)
    cell = np.sort(cell, kind="stable")[starts]
    ends, rows = np.r_[starts[1:], len(sizes)], np.r_[0, np.cumsum(sizes)]
    return pd.DataFrame({
        "cell": cell.astype(np.int32), "sizes": [sizes[a:b].tobytes() for a, b in zip(starts, ends)], "nos": [nos[rows[a] : rows[b]].tobytes() for a, b in zip(starts, ends)],
        "sums": [sums[a:b].tobytes() for a, b in zip(starts, ends)],
    })


def _ordered(label: np.ndarray, sizes: np.ndarray, nos: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups in the order of ``label``, and where each label starts."""
    o = np.argsort(label, kind="stable")
    rows = np.argsort(np.repeat(label, sizes), kind="stable")
    own = label[o]
    return sizes[o], nos[rows], sums[o], np.flatnonzero(np.r_[True, own[1:] != own[:-1]])


def _joined(sizes: np.ndarray, nos: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of one cell with those close to each other made one: each goes to its neighbour with the most neighbours."""
    u = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-30)
    close = u @ u.T >= NEAR
    np.fill_diagonal(close, True)
    m = len(sizes)
    rank = np.empty(m, np.int32)
    rank[np.lexsort((-np.arange(m), close.sum(1)))] = np.arange(1, m + 1)
    to = (close * rank).argmax(1)
    lead = to == np.arange(m)
    other = np.flatnonzero(~lead[to])
    if len(other):  # its neighbour went elsewhere itself
        got = close[other] * np.where(lead, rank, 0)
        to[other] = np.where(got.max(1) > 0, got.argmax(1), other)
    total = np.bincount(to, sizes, m)
    to = np.where(total[to] > HELD, np.arange(m), to)
    sizes, nos, sums, starts = _ordered(to, sizes, nos, sums)
    return np.add.reduceat(sizes, starts).astype(np.int32), nos, np.add.reduceat(sums, starts).astype(np.float32)


def _first(pivots: np.ndarray) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            if len(p):
                u = _unit(np.frombuffer(b"".join(p.vec), np.float32).reshape(len(p), -1)).astype(np.float32)
                yield _dealt(np.ones(len(p), np.int32), p.no.to_numpy(np.int64), u, pivots)

    return run


def _round(pivots: np.ndarray | None, dim: int) -> Callable:
    """Rows come sorted by cell. Groups by their next cell, or after the last round ``no, item``."""

    def out(done: list) -> pd.DataFrame:
        sizes, nos, sums = (np.concatenate(x) for x in zip(*done))
        if pivots is not None:
            return _dealt(sizes, nos, sums, pivots)
        return pd.DataFrame({"no": nos, "item": np.repeat(nos[np.cumsum(sizes) - sizes], sizes)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, done, cell, many = [], [], None, 0

        def close() -> None:
            s, n, v = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*held), (np.int32, np.int64, np.float32)))
            v, rows = v.reshape(len(s), dim), np.r_[0, np.cumsum(s)]
            for lo in range(0, len(s), MOST_AT_ONCE):
                hi = min(lo + MOST_AT_ONCE, len(s))
                done.append(_joined(s[lo:hi], n[rows[lo] : rows[hi]], v[lo:hi]))
            held.clear()

        for p in batches:
            for c, s, n, v in zip(p.cell, p.sizes, p.nos, p.sums):
                if held and (c != cell or many >= MOST_AT_ONCE):
                    close()
                    many = 0
                cell, many = c, many + len(s) // 4
                held.append((s, n, v))
            if sum(len(x[0]) for x in done) >= 1 << 15:
                yield out(done)
                done = []
        if held:
            close()
        if done:
            yield out(done)

    return run


def _labels(vectors: DataFrame, n: int, dim: int) -> DataFrame:
    """``no, item``: the group of each vector."""
    cells = int(np.clip(n // CELL, 1, CELLS))
    some = vectors.select("vec", F.xxhash64("no", F.lit(7)).alias("h"), "no").orderBy("h", "no").limit(cells * ROUNDS).select("vec").collect()
    pivots = _unit(np.frombuffer(b"".join(r[0] for r in some), np.float32).reshape(len(some), dim)).astype(np.float32)
    own = [pivots[r::ROUNDS] for r in range(ROUNDS)]
    d = vectors.select("no", "vec").mapInPandas(_first(own[0]), _CELL)
    for r in range(ROUNDS):
        last = r == ROUNDS - 1
        d = d.repartition("cell").sortWithinPartitions("cell").mapInPandas(_round(None if last else own[r + 1], dim), "no long, item long" if last else _CELL)
    return d


# ---- items -------------------------------------------------------------------------------------------------------------

_ITEM = "item long, n int, centre binary, radius double, reach double, nos binary, vecs binary, fars binary, sims binary, others binary"


def _itemised(k: int, dim: int) -> Callable:
    """Rows come sorted by item, a group each; items of what is close enough in it, and of each other vector."""

    def best(no: np.ndarray, vec: np.ndarray) -> Best:
        if len(no) > FEW:
            b = Block(pd.DataFrame({"nos": [no.tobytes()], "vecs": [vec.tobytes()]}), k)
            meet(b, b, k)
            return b.best
        u, got = _unit(vec), Best(len(no), k)
        s = u @ u.T
        np.fill_diagonal(s, -np.inf)
        i, j = np.nonzero(s >= np.partition(s, len(no) - k, axis=1)[:, len(no) - k, None] - EPS64)
        got.merge(i, np.round(np.einsum("ij,ij->i", u[i], u[j]), 12), no[j])
        return got

    def items(no: np.ndarray, vec: np.ndarray) -> list[tuple]:
        stay, far = np.zeros(len(no), bool), np.full(len(no), np.pi)
        rows = []
        if len(no) > k:
            u, got = _unit(vec), best(no, vec)
            far = _angle(got.sim[:, -1] - EPS64)
            c = u.sum(0)
            out = _angle(u @ (c / max(np.linalg.norm(c), 1e-30)))
            stay = (out <= RADIUS) & (out + far <= REACH)
            if stay.sum() > k:
                if not stay.all():
                    got = best(no[stay], vec[stay])
                    far[stay] = np.minimum(far[stay], _angle(got.sim[:, -1] - EPS64))
                c = u[stay].sum(0)
                c = (c / np.linalg.norm(c)).astype(np.float32)
                out = _angle(u[stay] @ _unit(c[None])[0] - EPS64)
                rows.append((no[stay][0], stay.sum(), c.tobytes(), out.max(), (out + far[stay]).max(), no[stay].tobytes(), vec[stay].tobytes(), far[stay].tobytes(), got.sim.tobytes(), got.at.tobytes()))
            else:
                stay[:] = False
        alone = np.flatnonzero(~stay)
        c = _unit(vec[alone]).astype(np.float32)
        # a centre in float32 is not quite the vector
        return rows + [(no[i], 1, c[j].tobytes(), 1e-6, far[i] + 1e-6, no[i : i + 1].tobytes(), vec[i].tobytes(), far[i : i + 1].tobytes(), b"", b"") for j, i in enumerate(alone)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left = None
        names = [x.split()[0] for x in _ITEM.split(", ")]

        def made(p: pd.DataFrame) -> pd.DataFrame:
            no, vec = p.no.to_numpy(np.int64), np.frombuffer(b"".join(p.vec), np.float32).reshape(len(p), dim)
            own = p["item"].to_numpy()
            at = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            return pd.DataFrame([r for lo, hi in zip(at, np.r_[at[1:], len(no)]) for r in items(no[lo:hi], vec[lo:hi])], columns=names)

        for p in batches:
            p = p if left is None else pd.concat([left, p], ignore_index=True)
            if len(p):
                whole = p["item"] != p["item"].iloc[-1]
                if whole.any():
                    yield made(p[whole])
                left = p[~whole]
        if left is not None and len(left):
            yield made(left)

    return run


# ---- pairs of items ----------------------------------------------------------------------------------------------------


class Centres:
    """A block of items, by radius."""

    def __init__(self, p: pd.DataFrame, dim: int) -> None:
        no, x = np.frombuffer(b"".join(p["nos"]), np.int64), np.frombuffer(b"".join(p["vecs"]), np.float32).reshape(-1, dim + 3)
        o = np.argsort(x[:, dim], kind="stable")
        self.no, x = no[o], x[o]
        self.vec = np.ascontiguousarray(x[:, :dim])
        # float32 may have rounded both down
        self.radius, self.reach = (x[:, i].astype(np.float64) + 1e-6 for i in (dim, dim + 1))
        self.many = x[:, dim + 2]


def _slices(n: int, step: int) -> list[slice]:
    return [slice(lo, min(lo + step, n)) for lo in range(0, n, step)]


def _bounds(a: Centres, b: Centres, k: int) -> Iterator[pd.DataFrame]:
    """``no, whole, lows`` for items of ``a`` of which no k others are known: what the k most similar items of ``b`` are at
    least, and what the most similar is of those that hold k vectors or more."""
    loose = np.flatnonzero(a.reach >= np.pi)
    for at in (loose[lo : lo + TILE] for lo in range(0, len(loose), TILE)):
        low, kth = np.full(len(at), -1.0), np.full((len(at), k), -1.0)
        for c in _slices(len(b.no), WIDE):
            s = np.clip(a.vec[at] @ b.vec[c].T - EPS32, -1, 1)
            r = (b.radius[c] + 2e-6).astype(np.float32)
            s = np.where(_angle(s) + r < np.pi, s * np.cos(r) - np.sqrt(1 - s * s) * np.sin(r), -1) - EPS32
            if a is b:
                s[a.no[at][:, None] == b.no[c][None, :]] = -1
            if (full := b.many[c] >= k).any():
                low = np.maximum(low, s[:, full].max(1))
            both = np.concatenate([kth, s], axis=1)
            kth = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        yield pd.DataFrame({"no": a.no[at], "whole": low, "lows": list(kth)})


def _survivors(a: Centres, b: Centres) -> Iterator[pd.DataFrame]:
    """``no, other``: items whose members may have one of their k best in the other, of the two that were met."""
    wide = _slices(len(b.no), WIDE)
    right = [np.ascontiguousarray(b.vec[c].T) for c in wide]
    for rows in _slices(len(a.no), TILE):
        for c, r in zip(wide, right):
            if a is b and c.stop <= rows.start:
                continue
            tile = a.vec[rows] @ r
            x = (_cos(a.reach[rows] + b.radius[c].max()) - EPS32).astype(np.float32)
            y = (_cos(b.reach[c] + a.radius[rows].max()) - EPS32).astype(np.float32)
            if tile.max() < min(x.min(), y.min()):
                continue
            i, j = np.divmod(np.flatnonzero(((tile >= x[:, None]) | (tile >= y[None, :])).ravel()), tile.shape[1])
            s, i, j = tile[i, j].astype(np.float64), i + rows.start, j + c.start
            if a is b:
                ok = i < j
                s, i, j = s[ok], i[ok], j[ok]
            for one, two, ok in ((a.no[i], b.no[j], s >= _cos(a.reach[i] + b.radius[j]) - EPS32), (b.no[j], a.no[i], s >= _cos(b.reach[j] + a.radius[i]) - EPS32)):
                if ok.any():
                    yield pd.DataFrame({"no": one[ok], "other": two[ok]})


def _pairs(k: int, dim: int, bounds: bool) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = pd.concat(list(batches) or [pd.DataFrame({"role": [], "nos": [], "vecs": []})])
        blocks = [Centres(q, dim) for r in (0, 1) if len(q := p[p.role == r])]
        alone = len(p) and p.alone.iloc[0]
        del p
        if blocks and (alone or len(blocks) == 2):
            if not bounds:
                yield from _survivors(blocks[0], blocks[-1])
                return
            yield from _bounds(blocks[0], blocks[-1], k)
            if not alone:
                yield from _bounds(blocks[1], blocks[0], k)

    return run


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in batches:
        more = p[["radius", "reach", "n"]].to_numpy(np.float32)
        yield pd.DataFrame({"no": p["item"], "vec": [c + m.tobytes() for c, m in zip(p.centre, more)]})


# ---- members -----------------------------------------------------------------------------------------------------------

_MEMBERS = "item long, role int, nos binary, vecs binary, fars binary"


def _by_item(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, tuple]]:
    """``nos, vecs, fars`` of an item (role 0), and those of role 1 sent to it, some at a time; rows come sorted by item, role."""
    own = None
    for p in batches:
        item, role = p["item"].to_numpy(), p["role"].to_numpy()
        x = [p[c].to_numpy() for c in ("nos", "vecs", "fars")]
        at = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (role[1:] != role[:-1])]) if len(p) else []
        for lo, hi in zip(at, [*at[1:], len(p)]):
            if role[lo] == 0:
                own = tuple(c[lo] for c in x)
            else:
                yield own, tuple(b"".join(c[lo:hi]) for c in x)


def _sent(dim: int) -> Callable:
    """Members to each item where one of their k best may be. Role 1: number, centre and radius of such an item, and reach of one's own."""

    def out(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["item", "nos", "vecs", "fars"]).assign(role=np.int32(1))[["item", "role", "nos", "vecs", "fars"]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, held = [], 0
        for own, to in _by_item(batches):
            no, vec = np.frombuffer(own[0], np.int64), np.frombuffer(own[1], np.float32).reshape(-1, dim)
            two = np.frombuffer(to[2], np.float64).reshape(-1, 2)
            far = np.minimum(np.frombuffer(own[2], np.float64), two[0, 1])
            other, c, u = np.frombuffer(to[0], np.int64), _unit(np.frombuffer(to[1], np.float32).reshape(-1, dim)), _unit(vec)
            for at in _slices(len(other), max(1, (1 << 22) // len(no))):
                need = u @ c[at].T >= _cos(far[:, None] + two[None, at, 0]) - EPS64
                for j in np.flatnonzero(need.any(0)):
                    x = need[:, j]
                    rows.append((other[at][j], no[x].tobytes(), vec[x].tobytes(), far[x].tobytes()))
                    held += x.sum()
                    if held >= 1 << 15:
                        yield out(rows)
                        rows, held = [], 0
        if rows:
            yield out(rows)

    return run


def _met(k: int, dim: int) -> Callable:
    """The k best of what was sent to each item among its members."""

    def out(done: list[tuple]) -> pd.DataFrame:
        no, sim, at = (np.concatenate(x) for x in zip(*done))
        best = Best(0, k)
        best.sim, best.at = sim, at
        return lists_of(no, best)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done, held = [], 0
        for own, to in _by_item(batches):
            there, u = np.frombuffer(own[0], np.int64), _unit(np.frombuffer(own[1], np.float32).reshape(-1, dim))
            no, v, far = np.frombuffer(to[0], np.int64), _unit(np.frombuffer(to[1], np.float32).reshape(-1, dim)), np.frombuffer(to[2], np.float64)
            for at in _slices(len(no), TILE):
                best = Best(len(no[at]), k)
                for c in _slices(len(there), WIDE):
                    i, j = np.nonzero(v[at] @ u[c].T >= np.maximum(_cos(far[at]) - EPS64, best.sim[:, -1] - EPS64)[:, None])
                    for lo in range(0, len(i), 1 << 16):
                        x, y = i[lo : lo + (1 << 16)], j[lo : lo + (1 << 16)]
                        best.merge(x, np.round(np.einsum("ij,ij->i", v[at][x], u[c][y]), 12), there[c][y])
                if (some := best.at[:, 0] >= 0).any():
                    done.append((no[at][some], best.sim[some], best.at[some]))
                    held += some.sum()
                if held >= 1 << 14:
                    yield out(done)
                    done, held = [], 0
        if done:
            yield out(done)

    return run


def _own(k: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            no = np.frombuffer(b"".join(p.nos), np.int64)
            best = Best(len(no), k)
            best.sim, best.at = (np.frombuffer(b"".join(x), t).reshape(-1, k) for x, t in ((p.sims, np.float64), (p.others, np.int64)))
            yield lists_of(no, best)

    return run


def grouped(vectors: DataFrame, n: int, k: int, block: int, dim: int) -> DataFrame | None:
    """Lists of similar rows as ``by_pairs`` makes them, together the k best of each row; None where groups would not help."""
    labels = cut(_labels(vectors, n, dim), "labels")
    if labels.select("item").distinct().count() > n // 3:
        return None
    d = labels.join(vectors.select("no", "vec"), "no").repartition("item").sortWithinPartitions("item")
    all_items = cut(d.mapInPandas(_itemised(k, dim), _ITEM), "items")
    items = all_items.select("item", "n", "centre", "radius", "reach")
    m, loose = items.agg(F.count("*"), F.count_if(F.col("reach") >= 3.14159)).first()
    if m > n // 3:
        return None
    packed = lambda x: x.mapInPandas(_packed, "no long, vec binary")
    g = parts(vectors.sparkSession, m, block)
    if loose:
        low = by_pairs(packed(items), g, _pairs(k, dim, True), "no long, whole double, lows array<double>")
        low = low.groupBy("no").agg(F.max("whole").alias("whole"), F.sort_array(F.flatten(F.collect_list("lows")), False).alias("lows"))  # k for each block
        low = cut(low.select("no", F.greatest("whole", F.col("lows")[k - 1]).alias("low")), "bounds").select(F.col("no").alias("item"), (F.acos(F.greatest("low", F.lit(-1.0))) + 2e-6).alias("bound"))
        items = cut(items.join(low, "item", "left").select("item", "n", "centre", "radius", F.least("reach", "bound").alias("reach")), "items")
    pairs = cut(by_pairs(packed(items), g, _pairs(k, dim, False), "no long, other long"), "pairs")
    to = pairs.join(items.select(F.col("item").alias("other"), "centre", "radius"), "other").join(items.select(F.col("item").alias("no"), "reach"), "no")
    members = all_items.select("item", F.lit(0).alias("role"), "nos", "vecs", "fars")
    sent = to.mapInPandas(_addressed, _MEMBERS)
    visits = members.unionByName(sent).repartition("item").sortWithinPartitions("item", "role").mapInPandas(_sent(dim), _MEMBERS)
    got = members.unionByName(visits).repartition("item").sortWithinPartitions("item", "role").mapInPandas(_met(k, dim), LISTS)
    return got.unionByName(all_items.filter("n > 1").select("nos", "sims", "others").mapInPandas(_own(k), LISTS))


def _addressed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for p in batches:
        other, two = p.other.to_numpy(np.int64), p[["radius", "reach"]].to_numpy(np.float64)
        yield pd.DataFrame({"item": p.no, "role": np.int32(1), "nos": [x.tobytes() for x in other], "vecs": p.centre, "fars": [x.tobytes() for x in two]})
