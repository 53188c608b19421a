"""Spark operators against brute-force Python on small random inputs."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tributary.operators import deps as E
from tributary.operators import items as B
from tributary.operators import runlog as D

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

changes_st = st.lists(
    st.tuples(st.sampled_from(["r1", "r2", "r3"]),
              st.one_of(st.none(), st.sampled_from(["QUEUED", "RUNNING", "SUCCESS", "FAILED"])),
              st.one_of(st.none(), st.text(alphabet="abc", min_size=1, max_size=3))),
    min_size=1, max_size=25)


@SETTINGS
@given(changes=changes_st)
def test_fold_equals_replaying_sparse_saves(spark, changes):
    rows = [(rid, status, msg, i) for i, (rid, status, msg) in enumerate(changes)]
    df = spark.createDataFrame(rows, "run_id STRING, status STRING, error_message STRING, seq LONG")
    got = {r.run_id: (r.status, r.error_message) for r in D.fold_changes(df).collect()}
    want: dict = {}
    for rid, status, msg, _ in rows:          # UPDATE only the columns that were set
        cur = list(want.get(rid, (None, None)))
        if status is not None:
            cur[0] = status
        if msg is not None:
            cur[1] = msg
        want[rid] = tuple(cur)
    assert got == want


edges_st = st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7)), max_size=18)


def kahn_levels(edges):
    nodes = {n for e in edges for n in e}
    es = set(edges)
    level, out, remaining = 0, {}, set(nodes)
    while True:
        ready = {n for n in remaining if not any(d == n and s in remaining for s, d in es)}
        if not ready:
            return out, remaining
        for n in ready:
            out[n] = level
        remaining -= ready
        level += 1


@SETTINGS
@given(edges=edges_st)
def test_peel_equals_kahn(spark, edges):
    named = [(f"n{s}", f"n{d}") for s, d in edges]
    df = spark.createDataFrame(named or [("x", "x")], "src STRING, dst STRING")
    if not named:
        df = df.limit(0)
    levels, remaining = E.peel(df)
    want_levels, want_remaining = kahn_levels(named)
    assert {r.node: r.level for r in levels.collect()} == want_levels
    assert {r.node for r in remaining.collect()} == want_remaining


tree_st = st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["A", "B", "a"]),
                             st.sampled_from(["folder", "file"])), min_size=1, max_size=14)


@SETTINGS
@given(tree=tree_st, paths=st.lists(st.lists(st.sampled_from(["A", "B", "a", "Q"]), min_size=1, max_size=3),
                                     min_size=1, max_size=6))
def test_resolve_equals_walking_a_dict(spark, tree, paths):
    # item i hangs under item parent (< i) or under root; names unique per parent
    rows, seen = [], set()
    for i, (p, name, typ) in enumerate(tree):
        parent = "root" if p >= i else f"i{p}"
        if (parent, name) in seen:
            continue
        seen.add((parent, name))
        rows.append((f"i{i}", parent, name, typ))
    items = spark.createDataFrame(rows, "id STRING, parent_id STRING, name STRING, type STRING")
    req = spark.createDataFrame([(k, "/".join(p)) for k, p in enumerate(paths)], "k INT, path STRING")
    got = {r.k: r.folder_id for r in B.resolve_folder_paths(items, req).collect()}
    folders = {(p, n): i for i, p, n, t in rows if t == "folder"}
    want = {}
    for k, segs in enumerate(paths):
        cur = "root"
        for s in segs:
            cur = folders.get((cur, s))
            if cur is None:
                break
        want[k] = cur
    assert got == want


@SETTINGS
@given(edges=edges_st, failed=st.sets(st.integers(0, 7), max_size=3))
def test_blocked_equals_reachability(spark, edges, failed):
    named = [(f"n{s}", f"n{d}") for s, d in edges]
    df = spark.createDataFrame(named or [("x", "x")], "src STRING, dst STRING")
    if not named:
        df = df.limit(0)
    f = spark.createDataFrame([(f"n{x}",) for x in failed] or [("none",)], "node STRING")
    if not failed:
        f = f.limit(0)
    got = {r.node for r in E.blocked_by_failures(df, f).collect()}
    adj = defaultdict(set)
    for s, d in named:
        adj[s].add(d)
    seen, stack = set(), [f"n{x}" for x in failed]
    start = set(stack)
    while stack:
        for d in adj[stack.pop()]:
            if d not in seen:
                seen.add(d)
                stack.append(d)
    assert got == seen - start
