"""Parent-child rows to full hierarchies by bottom-up leaf peeling.

Each superstep takes the nodes without remaining children off the graph; they send their subtree size, their lists of
descendants and the number of their kind to the parent. What can never be peeled is exactly the members of loops. The reverse
of the peel order then gives every node its root, depth and path from its parent, which was peeled later. Supersteps are
joins over tables cut in the shared folder.

Peeling goes on while a layer is at least one in ``SLOW`` of what is left, so that all layers together cost a few times the
first, in both directions, and their number grows with the logarithm of the nodes. What is left then is deep chains and loops.
They are resolved by pointer jumping, in rounds that grow with the logarithm of the depth, or, up to ``LOCAL_NODES`` nodes, by
one task in memory.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from normspark.operators.records import latest
from normspark.session import cut, release, table

LOCAL_NODES = 50_000
SLOW = 8
SEP = " > "


def _finish(paths: bool):
    """Depth, root, path and subtree size of the remaining nodes, whose parents all remain too (or are none)."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        parent = dict(zip(p.comp_id, p.parent))
        label = dict(zip(p.comp_id, p.citation))
        size = dict(zip(p.comp_id, p["size"]))
        done: dict[str, tuple[int, str, str | None]] = {}
        for node in parent:
            chain, on = [], set()
            while node is not None and node not in done and node not in on:
                chain.append(node)
                on.add(node)
                node = parent[node]
            if node is not None and node in on:  # a loop that this chain ran into
                loop = chain[chain.index(node):]
                for x in loop:
                    done[x] = (-1, min(loop), label[x])
                chain = chain[: chain.index(node)]
                node = loop[0]
            for x in reversed(chain):
                if (up := parent[x]) is None:
                    done[x] = (0, x, label[x])
                else:
                    d, root, path = done[up]
                    done[x] = (d + 1 if d >= 0 else -1, root, SEP.join(t for t in (path, label[x]) if t is not None) if paths else None)
        kids = dict.fromkeys(parent, 0)
        for up in parent.values():
            if up is not None:
                kids[up] += 1
        leaves = [x for x, k in kids.items() if not k]
        while leaves:  # the same peeling, within the task
            x = leaves.pop()
            if (up := parent[x]) is not None:
                size[up] += size[x]
                kids[up] -= 1
                if not kids[up]:
                    leaves.append(up)
        whole: dict[str, int] = {}  # what can't be peeled is in a loop, where every member has all of it below
        for x, k in kids.items():
            if k:
                whole[done[x][1]] = whole.get(done[x][1], 0) + size[x]
        n = [whole[done[x][1]] if kids[x] else size[x] for x in p.comp_id]
        d = [done[x] for x in p.comp_id]
        return pd.DataFrame({"comp_id": p.comp_id, "depth": [x[0] for x in d], "root": [x[1] for x in d], "path": [x[2] if paths else None for x in d], "size": n})

    return run


_RESOLVED = "comp_id string, depth long, root string, path string, size long"


def _counted(df: DataFrame, name: str, **what) -> tuple[DataFrame, dict]:
    """``df`` cut, and what was counted on the way."""
    seen = Observation()
    got = cut(df.observe(seen, *(c.alias(n) for n, c in what.items())), name)
    return got, seen.get


def _looped(rest: DataFrame) -> DataFrame:
    """``comp_id, low`` of the members of loops among ``comp_id, parent``: where enough steps up lead, by pointer jumping.

    A node whose chain of parents ends drops out; the others' pointers end in loops, whose members keep the smallest id.
    """
    s, now = _counted(rest.filter("parent is not null").select("comp_id", F.col("parent").alias("to")), "chain", n=F.count("*"))
    while now["n"]:
        o = s.select(F.col("comp_id").alias("to"), F.col("to").alias("far"))
        was, before = now["n"], s
        s, now = _counted(s.join(o, "to").select("comp_id", F.col("far").alias("to")), "chain", n=F.count("*"))
        release(before)
        if now["n"] == was:  # in each round the nodes of some depths drop out, until none is left that could
            break
    ends = cut(s.select(F.col("to").alias("comp_id")).distinct(), "ends")
    size, n = ends.count(), -1
    while size != n:  # the ends of 2k steps are those of k, once no tail is left
        o = s.select(F.col("comp_id").alias("to"), F.col("to").alias("far"))
        s = cut(s.join(o, "to").select("comp_id", F.col("far").alias("to")), "chain")
        ends = cut(s.select(F.col("to").alias("comp_id")).distinct(), "ends")
        n, size = size, ends.count()
    s = cut(rest.join(ends, "comp_id", "left_semi").select("comp_id", F.col("parent").alias("to"), F.least("comp_id", "parent").alias("low")), "loop")
    moved = size
    while moved:
        o = s.select(F.col("comp_id").alias("to"), F.col("to").alias("far"), F.col("low").alias("their"))
        less = F.least("low", "their")
        s, now = _counted(s.join(o, "to").select("comp_id", F.col("far").alias("to"), less.alias("low"), (less != F.col("low")).alias("moved")), "loop", n=F.count(F.when(F.col("moved"), 1)))
        s, moved = s.drop("moved"), now["n"]
    return s.select("comp_id", "low")


def _jumped(rest: DataFrame, paths: bool) -> DataFrame:
    """Depth, root, path and subtree size of ``comp_id, parent, citation, size`` by pointer jumping, loops included.

    Members of loops count as roots, so that a path below a loop starts at its member. In each round a pointer doubles its
    reach, a path grows by that of the node it points to, and a node's size by those of the nodes that point to it.
    """
    members = cut(_looped(rest), "members")
    r = rest.join(members, "comp_id", "left")
    to = F.when(F.col("low").isNull(), F.col("parent"))
    s, now = _counted(
        r.select("comp_id", to.alias("to"), F.coalesce(to, "comp_id").alias("root"), to.isNotNull().cast("long").alias("depth"), (F.col("citation") if paths else F.lit(None).cast("string")).alias("path"), "size"),
        "jump", n=F.count("to"),
    )
    while now["n"]:
        sent = s.filter("to is not null").groupBy(F.col("to").alias("comp_id")).agg(F.sum("size").alias("more"))
        o = s.select(F.col("comp_id").alias("to"), F.col("to").alias("far"), F.col("root").alias("top"), F.col("depth").alias("up"), F.col("path").alias("before"))
        n = s.join(o, "to", "left").join(sent, "comp_id", "left")
        path = F.concat_ws(SEP, "before", "path") if paths else F.col("path")
        before = s
        s, now = _counted(
            n.select("comp_id", F.col("far").alias("to"), F.coalesce("top", "root").alias("root"), (F.col("depth") + F.coalesce("up", F.lit(0))).alias("depth"), path.alias("path"), (F.col("size") + F.coalesce("more", F.lit(0))).alias("size")),
            "jump", n=F.count("to"),
        )
        release(before)
    # a loop's members share one root, and each has all of the loop below it
    s = s.join(members.select(F.col("comp_id").alias("root"), F.col("low").alias("loop")), "root", "left")
    whole = s.filter("comp_id = root and loop is not null").groupBy("loop").agg(F.sum("size").alias("whole"))
    s = s.join(whole, "loop", "left")
    size = F.when(F.col("comp_id") == F.col("root"), F.coalesce("whole", "size")).otherwise(F.col("size"))
    return s.select("comp_id", F.when(F.col("loop").isNull(), F.col("depth")).otherwise(-1).alias("depth"), F.coalesce("loop", "root").alias("root"), "path", size.alias("size"))


def _peel(rest: DataFrame, left: int, least: int, send=None) -> tuple[list[DataFrame], DataFrame, int]:
    """Layers of leaves of ``comp_id, parent, citation, kids, size``, and what is left of it where layers become thin."""
    layers: list[DataFrame] = []
    leaf = F.col("kids") == 0
    while left > least:
        leaves = rest.filter(leaf)
        sent = leaves.filter("parent is not null").groupBy(F.col("parent").alias("pid")).agg(F.count("*").alias("n"), F.sum("size").alias("s"))
        inner = rest.filter(~leaf)
        nxt = inner.join(sent, inner["comp_id"] == F.col("pid"), "left").select("comp_id", "parent", "citation", (F.col("kids") - F.coalesce("n", F.lit(0))).alias("kids"), (F.col("size") + F.coalesce("s", F.lit(0))).alias("size"))
        if send:
            send(leaves)
        rest, now = _counted(nxt, "rest", n=F.count("*"))
        was, left = left, now["n"]
        layers.append(leaves)
        if (was - left) * SLOW < was:
            break
    return layers, rest, left


def _resolved(nodes: DataFrame) -> tuple[DataFrame, int]:
    """Rows to peel, and their number: ``comp_id, parent, citation, kids, size``, the parent null where it is none."""
    ids = nodes.select(F.col("comp_id").alias("pid"))
    blank = F.coalesce(F.regexp_replace("parent", r"(?U)\s+", "") == "", F.lit(True))
    n = nodes.filter("comp_id is not null").select("comp_id", F.when(~blank, F.col("parent")).alias("parent"), "citation")
    n = cut(n.join(ids, n["parent"] == F.col("pid"), "left").select("comp_id", F.col("pid").alias("parent"), "citation"), "nodes")
    kids = n.filter("parent is not null").groupBy(F.col("parent").alias("pid")).agg(F.count("*").alias("kids"))
    rest, now = _counted(n.join(kids, n["comp_id"] == F.col("pid"), "left").select("comp_id", "parent", "citation", F.coalesce("kids", F.lit(0)).alias("kids"), F.lit(1).cast("long").alias("size")), "rest", n=F.count("*"))
    return rest, now["n"]


def hierarchy(nodes: DataFrame, paths: bool = True, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """``comp_id, depth, root, path, size`` of unique ``comp_id, parent, citation``.

    A node whose parent is null, blank or no node is a root of depth 0. In and below a loop the depth is -1 and the root
    is the loop's smallest comp_id. path holds the citations from the root down (from the loop on, below one); null
    citations are left out of it. size counts the node and all its descendants. Rows with a null comp_id are dropped. An
    empty table gives an empty table.
    """
    rest, left = _resolved(nodes)
    layers, rest, left = _peel(rest, left, local_nodes)
    if left <= local_nodes:
        done = rest.select("comp_id", "parent", "citation", "size").groupBy(F.lit(0).alias("one")).applyInPandas(lambda p: _finish(paths)(p), _RESOLVED)
    else:
        done = _jumped(rest.select("comp_id", "parent", "citation", "size"), paths)
    done = cut(done, "done")
    for leaves in reversed(layers):  # layers grow on the way down, so what is joined again adds up to a few times the last
        up = done.select(F.col("comp_id").alias("pid"), F.col("depth").alias("d"), F.col("root").alias("r"), F.col("path").alias("pp"))
        got = leaves.join(up, leaves["parent"] == F.col("pid"), "left")
        path = F.concat_ws(SEP, "pp", "citation") if paths else F.lit(None).cast("string")
        got = got.select("comp_id", F.when(F.col("pid").isNull(), 0).when(F.col("d") < 0, -1).otherwise(F.col("d") + 1).cast("long").alias("depth"), F.coalesce("r", "comp_id").alias("root"), path.alias("path"), "size")
        done = done.unionByName(cut(got, "done"))
    return done


def _doubled(links: DataFrame) -> DataFrame:
    """``comp_id, descendant, distance`` of all that lies below by ``links`` (comp_id, parent), which hold no loop.

    Pairs are built by doubling: what lies 1..2k steps below is what lies up to k below, and what lies up to k below that.
    """
    near = cut(links.select(F.col("parent").alias("comp_id"), F.col("comp_id").alias("descendant"), F.lit(1).cast("long").alias("distance")), "below")
    step = 1
    while True:
        far = near.filter(F.col("distance") == step).select(F.col("comp_id").alias("top"), F.col("descendant").alias("comp_id"))
        more, now = _counted(near.join(far, "comp_id").select(F.col("top").alias("comp_id"), "descendant", (F.col("distance") + step).alias("distance")), "below", n=F.count("*"))
        if not now["n"]:
            return near
        near = near.unionByName(more)
        step *= 2


def _all_below(nodes: DataFrame) -> DataFrame:
    """``comp_id, descendant, distance`` of all that lies below by ``comp_id, parent, citation``, which hold no loop.

    A node that is peeled sends its list, and itself, to its parent: a row for each descendant, written once. Where layers
    become thin, what lies below by the links that are left is joined with the lists received there.
    """
    rest, left = _resolved(nodes)
    lists: list[DataFrame] = []

    def received() -> DataFrame:
        got = lists[0]
        for x in lists[1:]:
            got = got.unionByName(x)
        return got

    def send(leaves: DataFrame) -> None:
        up = leaves.filter("parent is not null").select("comp_id", "parent")
        out = up.select(F.col("parent").alias("comp_id"), F.col("comp_id").alias("descendant"), F.lit(1).cast("long").alias("distance"))
        if lists:
            out = out.unionByName(received().join(up, "comp_id").select(F.col("parent").alias("comp_id"), "descendant", (F.col("distance") + 1).alias("distance")))
        lists.append(cut(out, "lists"))

    _, rest, left = _peel(rest, left, 0, send)
    near = _doubled(rest.filter("parent is not null").select("comp_id", "parent"))
    if not lists:
        return near
    own = near.select("comp_id", F.col("descendant").alias("at"), F.col("distance").alias("so_far"))
    far = received().withColumnRenamed("comp_id", "at").join(own, "at").select("comp_id", "descendant", (F.col("distance") + F.col("so_far")).alias("distance"))
    return received().unionByName(near).unionByName(far)


def ancestors(nodes: DataFrame, resolved: DataFrame) -> DataFrame:
    """``comp_id, descendant, distance``: every node with each node below it, over trees with a root only."""
    return _all_below(nodes.join(resolved.filter("depth >= 0").select("comp_id"), "comp_id", "left_semi").select("comp_id", "parent", "citation"))


def loop_members(nodes: DataFrame, resolved: DataFrame) -> DataFrame:
    """``comp_id`` of the members of loops, without what hangs below them."""
    lost = resolved.filter("depth < 0").select("comp_id")
    return _looped(nodes.join(lost, "comp_id", "left_semi").select("comp_id", "parent")).select("comp_id")


def descendants(nodes: DataFrame, resolved: DataFrame) -> DataFrame:
    """``comp_id, descendant, distance``: every node with each node below it; of a loop only the links among its members
    are left out, so what hangs below it is below its member and has its own descendants."""
    members = loop_members(nodes, resolved).withColumn("member", F.lit(True))
    n = nodes.join(members, "comp_id", "left")
    return _all_below(n.select("comp_id", F.when(F.col("member").isNull(), F.col("parent")).alias("parent"), "citation"))


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "component").select("comp_id", "parent_comp_id", "citation", "updated_at")
    return latest(c, "comp_id", "updated_at", F.xxhash64("parent_comp_id", "citation")).select("comp_id", F.col("parent_comp_id").alias("parent"), "citation")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Root and depth of every component; -1 and the loop's smallest id where the chain of parents never ends."""
    return hierarchy(_nodes(spark, sf_dir), paths=False).select("comp_id", F.col("root").alias("root_comp_id"), "depth")


def p4_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path of citations, depth, root and number of descendants of every component."""
    h = hierarchy(_nodes(spark, sf_dir), local_nodes=0)  # by joins to the end, however few nodes are left
    return h.select("comp_id", F.col("root").alias("root_comp_id"), "depth", "path", (F.col("size") - 1).alias("descendants"))


def p4_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every component with each of its descendants and their distance; a loop is not followed, what hangs below it is."""
    n = cut(_nodes(spark, sf_dir), "components")
    return descendants(n, cut(hierarchy(n, paths=False), "resolved"))


def p4_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loops: smallest comp_id, and the number of components in or below each."""
    return p4_found(spark, sf_dir).filter("depth = -1").groupBy(F.col("root_comp_id").alias("loop")).agg(F.count("*").alias("components"))
