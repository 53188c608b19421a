"""Deep graphs in few rounds: pointer doubling, longest paths, cycles.

``jump`` composes pointers with themselves, so a chain of n steps is followed in
log2(n) rounds.  ``longest_levels`` uses it on every node with one incoming edge
left: such a node's level is that of its predecessor plus the edge's length, so whole
trees and chains hang themselves on their nearest node with more edges, and the
graph shrinks to those.  ``on_cycles`` splits what no order reaches into
strongly connected components by forward and backward reach.  A hot node only ever
sits on the many side of a join whose other side has it once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from math import log2

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tributary.operators.frontier import cut, cut_counting, union_all

#: Level of nodes that no order reaches; lengths add up far below it.
NEVER = 1 << 60


def _cut_counts(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict]:
    """``cut`` plus row counts by condition, from the same job."""
    seen = Observation(f"graph-{uuid.uuid4().hex[:8]}")
    out = cut(df.observe(seen, *(F.sum(F.when(c, 1).otherwise(0)).alias(n) for n, c in counts.items())))
    return out, {n: int(seen.get.get(n) or 0) for n in counts}


def jump(pointers: DataFrame, trace: list | None = None, compose: dict[str, Callable[[Column, Column], Column]] | None = None) -> DataFrame:
    """(node, to, d, done, ...) with one row a node -> the same with ``to`` moved to
    where the pointers lead and ``d`` summed up on the way; ``compose`` says how other
    columns come from a node's own value and the next one's.

    ``done`` rows stay; the others must point to a node of the table.  Each
    round follows twice as many steps.  Pointers that run in a circle get ``to``
    NULL and ``d`` NEVER."""
    compose = compose or {}
    extra = [compose[c](F.col(c), F.col(f"_{c}")).alias(c) if c in compose else c for c in pointers.columns if c not in ("node", "to", "d", "done")]
    state, n = _cut_counts(pointers, rows=F.lit(True), live=~F.col("done"))
    rounds = 0
    while n["live"] and rounds <= log2(n["rows"]) + 1:
        nxt = state.select(F.col("node").alias("_n"), F.col("to").alias("_to"), F.col("d").alias("_d"), F.col("done").alias("_done"),
                           *(F.col(c).alias(f"_{c}") for c in compose))
        live = state.where("NOT done").join(nxt, F.col("to") == F.col("_n")).select(
            "node", F.col("_to").alias("to"), F.least(F.col("d") + F.col("_d"), F.lit(NEVER)).alias("d"), F.col("_done").alias("done"), *extra)
        state, more = _cut_counts(state.where("done").unionByName(live), live=~F.col("done"))
        n["live"], rounds = more["live"], rounds + 1
        if trace is not None:
            trace.append(n["live"])
    stuck = ~F.col("done")
    return state.withColumn("to", F.when(~stuck, F.col("to"))).withColumn("d", F.when(stuck, NEVER).otherwise(F.col("d"))).withColumn("done", F.lit(True))


def _arrivals(e: DataFrame) -> DataFrame:
    """(node, w, one, of): a row per edge for the node it ends at; ``of`` is a
    number for the node it comes from, NULL for the one source."""
    return e.select(F.col("dst").alias("node"), "w", F.lit(1).alias("one"), F.when(F.col("src").isNotNull(), F.xxhash64("src")).alias("of"))


def _with_names(few: DataFrame, degree: DataFrame, e: DataFrame) -> tuple[DataFrame, dict]:
    """Nodes with at most one edge as (node, to, d), and how many there are and have one.

    ``to`` is the node of the number ``of``: every source is a node of ``degree``, so
    each gets one at least.  Should two nodes share a number, ``to`` comes from the edges."""
    inner = few.where("of IS NOT NULL")
    outer = few.where("of IS NULL").select("node", F.lit(None).cast(e.schema["src"].dataType).alias("to"), "d")
    names = degree.where("node IS NOT NULL").select(F.col("node").alias("to"), F.xxhash64("node").alias("of"))
    found = outer.unionByName(inner.join(names, "of").select("node", "to", "d"))
    single, n = _cut_counts(found, rows=F.lit(True), inner=F.col("to").isNotNull())
    n_inner = inner.count()
    if n["inner"] != n_inner:
        found = outer.unionByName(inner.join(e.select(F.col("src").alias("to"), F.col("dst").alias("node")), "node").select("node", "to", "d"))
        single, n = _cut_counts(found, rows=F.lit(True), inner=F.col("to").isNotNull())
    return single, n


def longest_levels(edges: DataFrame, nodes: DataFrame | None = None, trace: list | None = None) -> DataFrame:
    """(node, level) of every node: edges on the longest path that ends there, or
    NEVER on a cycle and downstream of one.

    Roots are one source (a NULL ``src``; the edge's length is the level it
    gives), so a node all of whose predecessors are settled has one edge.  A
    phase hangs every node with at most one edge on its nearest ancestor with more
    (``jump``), moves the edges that leave it there and keeps the longest of
    parallel ones.  Edges never become more.  Chains, trees and series of
    branches that join again take a logarithm of their depth in rounds; a graph
    of layers, each node with several predecessors in the last, a phase a layer.
    ``trace`` collects a number per Spark round.  No edges and nodes give no
    rows; self loops and their downstream are NEVER."""
    e, _ = cut_counting(edges.select("src", "dst", F.lit(1).cast("long").alias("w")).distinct())
    alone = [F.lit(0).cast("long").alias("w"), F.lit(0).alias("one"), F.lit(None).cast("long").alias("of")]
    ends = _arrivals(e).unionByName(e.select(F.col("src").alias("node"), *alone))
    if nodes is not None:
        ends = ends.unionByName(nodes.select("node", *alone))
    settled = []  # per phase: (node, to, d); to is settled in a later phase
    while True:
        # numbers only, which Spark adds up in hash tables; a node's name as a maximum would have every edge sorted
        degree = cut(ends.groupBy("node").agg(F.sum("one").alias("n"), F.max("of").alias("of"), F.max("w").alias("d")))
        few = degree.where("n <= 1")
        single, n = _with_names(few, degree, e)
        if not n["rows"]:
            break
        known = single.select(F.col("node").alias("_n"))
        state = single.join(known, F.col("to") == F.col("_n"), "left").select("node", "to", "d", F.col("_n").isNull().alias("done"))
        state = jump(state, trace) if n["inner"] else single.withColumn("done", F.lit(True))
        settled.append((state.select("node", "to", "d"), n["inner"]))
        moved = state.select(F.col("node").alias("_n"), F.col("to").alias("_to"), F.col("d").alias("_d"))
        left = (e.join(moved, F.col("src") == F.col("_n"), "left")
                .select(F.when(F.col("_n").isNull(), F.col("src")).otherwise(F.col("_to")).alias("src"), "dst",
                        (F.col("w") + F.coalesce("_d", F.lit(0))).alias("w")))
        circle = F.col("src") == F.col("dst")
        left = left.select(F.when(~circle, F.col("src")).alias("src"), "dst", F.when(circle, NEVER).otherwise(F.least("w", F.lit(NEVER))).alias("w"))
        # edges into settled nodes go last: parallel ones are one by then
        e, n_edges = cut_counting(left.groupBy("src", "dst").agg(F.max("w").alias("w"))
                                  .join(state.select(F.col("node").alias("dst")), "dst", "left_anti").select("src", "dst", "w"))
        if trace is not None:
            trace.append(n_edges)
        ends = _arrivals(e)
        if not n_edges:
            break
    levels = cut(ends.select("node").distinct().withColumn("level", F.lit(NEVER)) if n["rows"] == 0 else ends.select("node", F.col("w").alias("level")).limit(0))
    for state, n_inner in reversed(settled):
        own = state.where("to IS NULL").select("node", F.col("d").alias("level"))
        if n_inner:
            above = levels.select(F.col("node").alias("to"), "level")
            hung = state.join(above, "to").select("node", F.least(F.col("d") + F.col("level"), F.lit(NEVER)).alias("level"))
            levels = cut(levels.unionByName(own).unionByName(hung))
        else:
            levels = levels.unionByName(own)
    return levels


def _reach(edges: DataFrame, starts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``starts`` and all that edges (``keys`` -> to) lead to; each round
    meets only rows found in the last one."""
    frontier, found = cut(starts), []
    while True:
        found.append(frontier)
        step = edges.join(frontier, keys).select(F.col("to").alias("node"), *[k for k in keys if k != "node"]).distinct()
        frontier, n = cut_counting(step.join(union_all(found, found[0]), keys, "left_anti"))
        if not n:
            return union_all(found, found[0])


def on_cycles(edges: DataFrame) -> DataFrame:
    """The nodes that lie on a cycle, also of one self loop: (node).

    Nodes with one edge in and one out are first drawn together to the edge they
    lie on.  Then every node learns the largest node that reaches it (its colour),
    and the nodes of a colour that reach the colour's own node are its
    strongly connected component; they go, and the rest is coloured anew."""
    selves = edges.where("src = dst").select(F.col("src").alias("node"))
    e = cut(edges.select("src", "dst").where("src <> dst").distinct())
    ends = e.select(F.explode(F.array(
        F.struct(F.col("src").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o"), F.lit(None).cast(e.schema["src"].dataType).alias("before"), F.col("dst").alias("after")),
        F.struct(F.col("dst").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o"), F.col("src").alias("before"), F.lit(None).cast(e.schema["src"].dataType).alias("after")))).alias("x")).select("x.*")
    chain = cut(ends.groupBy("node").agg(F.sum("i").alias("i"), F.sum("o").alias("o"), F.max("before").alias("before"), F.max("after").alias("after"))
                .where("i = 1 AND o = 1").select("node", "before", "after"))
    inside = chain.select(F.col("node").alias("_c"))

    def ends_of(side: str) -> DataFrame:
        p = chain.select("node", F.col(side).alias("to"), F.lit(1).cast("long").alias("d"))
        return jump(p.join(inside, F.col("to") == F.col("_c"), "left").select("node", "to", "d", F.col("_c").isNull().alias("done")))

    before, after = ends_of("before"), ends_of("after")
    drawn = cut(before.select("node", F.col("to").alias("a")).join(after.select("node", F.col("to").alias("b")), "node"))
    # circles of chain nodes alone: all their nodes point at each other
    circles = drawn.where("a IS NULL").select("node")
    short = drawn.where("a IS NOT NULL").select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()
    plain = e.join(inside, F.col("src") == F.col("_c"), "left_anti").join(inside, F.col("dst") == F.col("_c"), "left_anti")
    work, n = cut_counting(plain.unionByName(short).distinct())
    loops = work.where("src = dst").select(F.col("src").alias("node"))  # a circle through one other node
    out = []
    while n:
        step = work.where("src <> dst").select(F.col("src").alias("node"), F.col("dst").alias("to"))
        colours = cut(work.select(F.explode(F.array("src", "dst")).alias("node")).distinct().withColumn("colour", F.col("node")))
        fresh, n_new = colours, 1
        while n_new:
            told = step.join(fresh, "node").groupBy(F.col("to").alias("node")).agg(F.max("colour").alias("_told"))
            colours, n_new = cut_counting(colours.drop("new").join(told, "node", "left").select(
                "node", F.greatest("colour", "_told").alias("colour"), F.coalesce(F.col("_told") > F.col("colour"), F.lit(False)).alias("new")), F.col("new"))
            fresh = colours.where("new").drop("new")
        colours = colours.drop("new")
        of_src, of_dst = (colours.select(F.col("node").alias(s), F.col("colour").alias(f"_{s}")) for s in ("src", "dst"))
        same = cut(work.join(of_src, "src").join(of_dst, "dst").where("_src = _dst").select(F.col("dst").alias("node"), F.col("_src").alias("colour"), F.col("src").alias("to")))
        members = cut(_reach(same, colours.where("node = colour"), ["node", "colour"]))
        big = members.groupBy("colour").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("colour")
        out.append(cut(members.join(big, "colour", "left_semi").select("node", F.col("colour").alias("component"))))
        gone = members.select(F.col("node").alias("_g"))
        work, n = cut_counting(work.join(gone, F.col("src") == F.col("_g"), "left_anti").join(gone, F.col("dst") == F.col("_g"), "left_anti"))
    found = union_all(out, loops.select("node", F.col("node").alias("component")).limit(0))
    lone = loops.join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    of = cut(found.unionByName(lone))
    a, b = (of.select(F.col("node").alias(side), F.col("component").alias(f"_{side}")) for side in ("a", "b"))
    on_edge = drawn.join(a, "a").join(b, "b").where("_a = _b").select("node")
    return of.select("node").unionByName(on_edge).unionByName(circles).unionByName(selves).distinct()
