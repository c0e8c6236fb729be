"""Plan-shape checks for the scale design (guards against regressions)."""

import os

from conftest import SF_SMALL, many_partitions

from svcvitals.operators import events as E, metrics as M
from svcvitals.sources import adapters as A
from svcvitals.sources.tables import read_points, write_points


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_points_scan_pushdown_and_hash_aggregate(spark, tmp_dir):
    path = os.path.join(tmp_dir, "points")
    A.metric_points(spark, SF_SMALL).write.parquet(path)
    pts = spark.read.parquet(path)
    df = M.daily_service_counts(M.day_slice(pts, "2024-01-15"), None)
    pushed = [ln for ln in _formatted(df).splitlines() if ln.startswith("PushedFilters")]
    assert any("GreaterThanOrEqual(ts," in ln and "LessThan(ts," in ln and "In(metric_type," in ln
               for ln in pushed), pushed
    plan = _plan(df)
    # the aggregate over raw points is hash-based with a partial (map-side) step
    assert "HashAggregate(keys=[day" in plan and "partial_sum" in plan


def test_days_prune_folders(spark, tmp_dir):
    """A table stored by day: the daily job and the backfill list only their days' folders."""
    path = os.path.join(tmp_dir, "points_by_day")
    with many_partitions(spark):
        write_points(A.metric_points(spark, SF_SMALL), path)
    pts = read_points(spark, path)
    sliced = M.day_slice(pts, "2024-01-14", "2024-01-15")
    filters = [ln for ln in _formatted(M.daily_service_counts(sliced)).splitlines() if ln.startswith("PartitionFilters")]
    assert filters and all("day" in ln and "2024-01-14" in ln and "2024-01-15" in ln for ln in filters), filters
    days = {f.split("day=")[1][:10] for f in sliced.inputFiles()}
    assert {"2024-01-14", "2024-01-15"} <= days
    whole = A.metric_points(spark, SF_SMALL)
    rows = lambda p: sorted(map(tuple, M.ingest_day(p, None, "2024-01-16", "2024-01-16 00:00:00").collect()), key=str)
    assert rows(pts) == rows(whole) != []
    assert max(len([f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")]) for d in os.listdir(path) if d.startswith("day=")) > 1


def test_deploy_payload_parsed_once(spark):
    df = E.expand_targets(E.deploy_events(A.cloud_deploy_raw(spark, SF_SMALL)))
    plan = _plan(df)
    assert plan.count("json_tuple(") == 1
    assert "from_json" not in plan and "get_json_object" not in plan
