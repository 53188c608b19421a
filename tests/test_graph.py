"""Deep and cyclic step graphs against plain Python."""

from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.operators import deps as E
from tributary.operators import graph as G


def edges_df(spark, edges):
    return spark.createDataFrame(list(edges), "src LONG, dst LONG")


def plain(edges):
    """(levels, blocked nodes, nodes on a cycle) by peeling and closure."""
    nodes = {n for e in edges for n in e}
    into = {n: {a for a, b in edges if b == n} for n in nodes}
    levels = {}
    while True:
        ready = [n for n in nodes if n not in levels and into[n] <= levels.keys()]
        if not ready:
            break
        levels.update({n: max([levels[a] + 1 for a in into[n]], default=0) for n in ready})
    out = {n: {b for a, b in edges if a == n} for n in nodes}
    cyclic = set()
    for n in nodes:
        seen, todo = set(), list(out[n])
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += out[x]
        if n in seen:
            cyclic.add(n)
    return levels, nodes - levels.keys(), cyclic


def check(spark, edges):
    levels, blocked, cyclic = plain(edges)
    df = edges_df(spark, edges)
    got, rest = E.peel(df)
    assert {r.node: r.level for r in got.collect()} == levels
    assert {r.node for r in rest.collect()} == blocked
    rows = {r.node: (r.blocked, r.on_cycle) for r in E.cycle_report(df).collect()}
    assert rows == {n: (n in blocked, n in cyclic) for n in levels.keys() | blocked}


def test_chain_of_20000_steps_takes_few_rounds(spark):
    n, trace = 20_000, []
    chain = spark.range(n).selectExpr("id AS src", "id + 1 AS dst")
    lv = G.longest_levels(chain, trace=trace)
    assert len(trace) < 20
    assert lv.where("level <> node").count() == 0 and lv.count() == n + 1


def test_long_circle_with_a_tail(spark):
    n, trace = 3_000, []
    ring = spark.range(n).selectExpr("id AS src", f"(id + 1) % {n} AS dst")
    tail = spark.range(n, 2 * n).selectExpr("id - 1 AS src", "id AS dst")
    lv = G.longest_levels(ring.union(tail), trace=trace)
    assert len(trace) < 20 and lv.where(f"level < {G.NEVER}").count() == 0 and lv.count() == 2 * n
    rows = E.cycle_report(ring.union(tail))
    assert rows.where("on_cycle").count() == n and rows.where("blocked AND NOT on_cycle").count() == n


SHAPES = [
    {(1, 2), (1, 3), (2, 4), (3, 4), (4, 5), (4, 6), (5, 7), (6, 7), (1, 7)},  # branches that join again
    {(a, b) for a in range(4) for b in range(4, 8)} | {(a, b) for a in range(4, 8) for b in range(8, 11)},  # layers
    {(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 6), (6, 5), (6, 7), (0, 1)},  # a node between two cycles
    {(a, b) for a in range(5) for b in range(5) if a != b} | {(9, 0), (4, 10)},  # all of each other
    {(1, 1), (1, 2), (2, 3), (4, 5)},  # a self loop
    {(1, 2), (2, 1), (1, 3), (3, 4), (4, 1)},  # two circles through one node
    {(1, 2), (2, 3), (3, 4), (4, 5), (5, 2), (6, 7), (7, 6)},  # a circle with a way in, one without
]


def test_shapes(spark):
    check(spark, {(100 * i + a, 100 * i + b) for i, shape in enumerate(SHAPES) for a, b in shape})


@settings(max_examples=3, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=16))
def test_random_graphs(spark, edges):
    check(spark, edges)


def test_no_edges(spark):
    none = edges_df(spark, [])
    assert G.longest_levels(none).count() == 0 and E.cycle_report(none).count() == 0
    lone = spark.createDataFrame([(7,)], "node LONG")
    assert [tuple(r) for r in E.peel(none, lone)[0].collect()] == [(7, 0)]


def test_deep_folders_take_few_rounds(spark):
    from tributary.operators import items as B
    n, trace = 3_000, []
    deep = spark.range(n).selectExpr("concat('f', id) AS id", "if(id = 0, 'root', concat('f', id - 1)) AS parent_id", "concat('n', id % 3) AS name", "'folder' AS type")
    circle = spark.createDataFrame([("x", "y", "x", "folder"), ("y", "x", "y", "folder"), ("z", "y", "z", "file"), ("last", f"f{n - 1}", "file", "file")],
                                   "id STRING, parent_id STRING, name STRING, type STRING")
    walked = B.walk_tree(deep.union(circle), "root", trace=trace)
    assert len(trace) < 16 and walked.count() == n + 1
    last = walked.where("id = 'last'").first()
    assert last.level == n and last.walk_path == "/".join([f"n{i % 3}" for i in range(n)] + ["file"])


def test_normal_paths(spark):
    from os.path import normpath

    from tributary.functions import exprs as X
    paths = ["/a/../b", "/../a", "a/./b//c/", "../../a/..", "/", "", ".", "a/..", "/a/b/../../..", "x/../../y", "/a/...", "a/..b/.c"]
    rows = spark.createDataFrame([(p,) for p in paths], "p STRING").select("p", X.normal_path("p").alias("q")).collect()
    assert [(r.p, r.q) for r in rows] == [(p, normpath(p)) for p in paths]


def test_cycle_report_makes_its_edges_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    pairs = [(0, 1), (1, 2), (2, 1), (2, 3), (3, 4), (4, 5), (5, 3), (5, 6), (1, 2)]
    edges = spark.createDataFrame(pairs, "src LONG, dst LONG").mapInPandas(counted, "src LONG, dst LONG")
    got = {r.node: (r.blocked, r.on_cycle) for r in E.cycle_report(edges).collect()}
    assert got == {0: (False, False), **{i: (True, True) for i in range(1, 6)}, 6: (True, False)}
    assert read.value == len(pairs)


def test_degrees_are_counted_in_hash_tables(spark, monkeypatch):
    plans, cut = [], G.cut
    monkeypatch.setattr(G, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    edges = spark.createDataFrame([(f"n{a}", f"n{b}") for a, b in [(0, 1), (1, 2), (0, 2), (2, 3), (3, 4), (1, 4)]], "src STRING, dst STRING")
    got = {r.node: r.level for r in G.longest_levels(edges).collect()}
    assert got == {f"n{i}": i for i in range(5)}
    assert any("HashAggregate" in p for p in plans) and not any("SortAggregate" in p for p in plans)


def test_a_shared_number_is_settled_by_the_edges(spark):
    kinds = "node LONG, n LONG, of LONG, d LONG"
    of = spark.range(1, 2).selectExpr("xxhash64(id) AS h").first().h
    degree = spark.createDataFrame([(1, 0, None, 0), (1, 0, None, 0), (2, 1, of, 1)], kinds)  # as if two nodes had one number
    single, n = G._with_names(degree.where("node = 2"), degree, spark.createDataFrame([(1, 2, 1)], "src LONG, dst LONG, w LONG"))
    assert [tuple(r) for r in single.collect()] == [(2, 1, 1)] and n == {"rows": 1, "inner": 1}
