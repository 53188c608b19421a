"""Plan properties that matter at scale, checked on ``explain`` output."""

import contextlib
import io

from pyspark.sql import functions as F

from tributary.operators import deps as E
from tributary.operators import runlog as D
from tributary.plans import fixtures as FX
from tributary.sources import locations as L

from .conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_file_listing_never_reads_bodies(spark):
    p = plan(L.list_files(spark, SF_SMALL, "parquet"))
    schema_lines = [x for x in p.splitlines() if "ReadSchema" in x]
    assert schema_lines and all("content" not in x for x in schema_lines)


def test_single_partition_read_touches_one_folder(spark):
    locs = FX.days_location(spark, SF_SMALL)
    p = plan(L.read_partition(spark, locs, "days", "2024-01-15", FX.DAYS_SCHEMA))
    loc = [x for x in p.splitlines() if x.strip().startswith("Location")]
    assert loc and all("partition_value=2024-01-15" in x for x in loc)


def test_partition_filter_prunes_folders(spark):
    locs = FX.days_location(spark, SF_SMALL)
    df = L.read_partitions(spark, locs, "days", FX.DAYS_SCHEMA).where(F.col("partition_value") == "2024-01-15")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(partition_value" in p and "2024-01-15" in p


def test_projection_reaches_the_scan(spark):
    ev = FX.table(spark, SF_SMALL, "events")
    p = plan(ev.where(F.col("event_type") == "error").select("event_id", "props"))
    read = [x for x in p.splitlines() if "ReadSchema" in x][0]
    assert "value" not in read and "user_id" not in read
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in p


def test_hot_keys_are_combined_before_the_shuffle(spark):
    ch = FX.changes(spark, SF_SMALL)
    ids = spark.createDataFrame([("x",)], "run_id STRING")
    p = plan(D.run_counts(ch, ids))
    # a partial (map-side) aggregate feeds the exchange; the final one follows it
    assert "partial_count" in p and p.count("HashAggregate") >= 2
    p2 = plan(E.vet_edges(FX.trade(spark, SF_SMALL)))
    assert "partial_count" in p2


def test_fold_is_a_partial_aggregate(spark):
    p = plan(D.current_runs(FX.changes(spark, SF_SMALL), F.struct("ts", "event_id")))
    assert "partial_max_by" in p


def test_only_fixed_tables_are_broadcast_by_hint(spark):
    df = spark.createDataFrame([(1, "Invalid Source")], "k INT, err STRING")
    p = plan(D.exit_codes(df, "err"))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_loops_leave_no_lineage_behind(spark):
    from tributary.operators import items as B
    walked = B.walk_tree(FX.items(spark, SF_SMALL), "root", carry=[])
    p = plan(walked)
    assert "Join" not in p and "ExistingRDD" in p      # only checkpointed levels
    levels, remaining = E.peel(E.accepted_edges(FX.entity_edges(spark, SF_SMALL)))
    assert "Join" not in plan(levels) and "Join" not in plan(remaining)
