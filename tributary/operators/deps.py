"""Step dependencies as edge tables (ops E1-E5).

A step graph is an edge DataFrame ``(src, dst)``: ``dst`` depends on
``src``.  Levels equal longest-path depth from the roots (``graph.longest_levels``:
rounds grow with the logarithm of a chain's length); nodes without one sit on a
cycle or downstream of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.errors import CycleError
from tributary.operators import graph as G
from tributary.operators.frontier import cut, cut_counting, in_place, union_all


def step_edges(steps: DataFrame, name: str = "name", depends_on: str = "depends_on") -> DataFrame:
    """Edges from step rows; ``depends_on`` may be NULL (a root), a
    single name or an array of names."""
    dep = F.col(depends_on)
    if steps.schema[depends_on].dataType.typeName() == "array":
        steps = steps.select(name, F.explode_outer(dep).alias("_dep"))
        dep = F.col("_dep")
    return (steps.where(dep.isNotNull())
            .select(dep.alias("src"), F.col(name).alias("dst")).distinct())


def step_nodes(steps: DataFrame | None, edges: DataFrame, name: str = "name") -> DataFrame:
    """Every node: steps (if given) plus both ends of every edge."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node"))
    if steps is not None:
        ends = ends.unionByName(steps.select(F.col(name).alias("node")))
    return ends.distinct()


def vet_edges(requests: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Verdict per distinct requested edge.  The first request of an edge
    is accepted (``ok``) and repeats are rejected as duplicates; a self loop
    is always rejected.  One aggregate (map-side combined, so a hot edge is
    cheap): ``src, dst, n_requests, verdict, n_rejected``."""
    g = requests.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst")).agg(
        F.count(F.lit(1)).alias("n_requests"))
    self_loop = F.col("src") == F.col("dst")
    return g.select(
        "src", "dst", "n_requests",
        F.when(self_loop, "self_loop").otherwise("ok").alias("verdict"),
        F.when(self_loop, F.col("n_requests")).otherwise(F.col("n_requests") - 1).alias("n_rejected"),
    )


def vet_requests(requests: DataFrame, order: str, src: str = "src", dst: str = "dst") -> DataFrame:
    """E2 per request: ``verdict`` is ``self_loop``, ``ok`` for the first
    request of an edge (smallest ``order``; it must be unique) or
    ``duplicate``.  The first request per edge comes from an aggregate that
    is joined back -- no window, so a hot edge is never sorted in one task
    (AQE splits the skewed side of the join)."""
    first = requests.groupBy(F.col(src).alias("_s"), F.col(dst).alias("_d")).agg(
        F.min(order).alias("_first"))
    j = requests.join(first, (requests[src] == first["_s"]) & (requests[dst] == first["_d"]))
    return j.select(
        *[requests[c] for c in requests.columns],
        F.when(F.col(src) == F.col(dst), "self_loop")
         .when(F.col(order) == F.col("_first"), "ok").otherwise("duplicate").alias("verdict"))


def accepted_edges(requests: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """The edge set after vetting: distinct, no self loops."""
    return (requests.select(F.col(src).alias("src"), F.col(dst).alias("dst"))
            .where(F.col("src") != F.col("dst")).distinct())


def peel(edges: DataFrame, nodes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(levels ``node, level``, remaining ``node``: on a cycle, also of
    one self loop, or downstream of one)."""
    found = cut(G.longest_levels(edges, nodes))
    return (found.where(F.col("level") < G.NEVER).select("node", F.col("level").cast("int").alias("level")),
            found.where(F.col("level") >= G.NEVER).select("node"))


def topological_levels(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Level per node; raises CycleError when some node can't be ordered
    (the unfinished sort of the reference)."""
    levels, remaining = peel(edges, nodes)
    if not remaining.isEmpty():
        raise CycleError("some steps wait for each other")
    return levels


def cycle_report(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Every node with ``blocked`` (on a cycle or downstream of one) and
    ``on_cycle``.  What is blocked from both ends is looked at more closely: it
    is on a cycle or between two.  What makes the edges runs once."""
    edges = cut(edges.select("src", "dst").distinct())
    levels, blocked = peel(edges, nodes)
    among = cut(edges.join(blocked.select(F.col("node").alias("src")), "src", "left_semi")
                .join(blocked.select(F.col("node").alias("dst")), "dst", "left_semi"))
    _, core = peel(among.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    core_edges = among.join(core.select(F.col("node").alias("src")), "src", "left_semi").join(
        core.select(F.col("node").alias("dst")), "dst", "left_semi")
    cyclic = G.on_cycles(core_edges).withColumn("on_cycle", F.lit(True))
    return (levels.select("node", F.lit(False).alias("blocked"), F.lit(False).alias("on_cycle"))
            .unionByName(blocked.join(cyclic, "node", "left").select("node", F.lit(True).alias("blocked"), F.coalesce("on_cycle", F.lit(False)).alias("on_cycle"))))


def has_cycle(edges: DataFrame) -> bool:
    _, remaining = peel(edges)
    return not remaining.isEmpty()


def step_count(edges: DataFrame, steps: DataFrame | None = None, name: str = "name") -> DataFrame:
    """E5: number of distinct steps."""
    return step_nodes(steps, edges, name).agg(F.count(F.lit(1)).alias("n_steps"))


def blocked_by_failures(edges: DataFrame, failed: DataFrame) -> DataFrame:
    """Steps downstream of failed steps (the BLOCKED status): a frontier walk
    along the edges from the failed nodes, one join per level."""
    e = in_place(cut(edges.select("src", "dst").distinct()), "src")
    frontier = cut(failed.select(F.col("node")).distinct())
    start, out = frontier, []
    while True:
        nxt, n = cut_counting(e.join(frontier.select(F.col("node").alias("src")), "src")
                              .select(F.col("dst").alias("node")).distinct()
                              .join(union_all([start, *out], start), "node", "left_anti"))
        if n == 0:
            break
        out.append(nxt)
        frontier = nxt
    e.unpersist()
    return union_all(out, frontier.limit(0))
