"""Batch job entry points append what the operators compute."""

import datetime as dt
import os

from conftest import SF_SMALL

from svcvitals.plans.jobs import run_backfill, run_daily
from svcvitals.sources import adapters as A
from svcvitals.sources.tables import read_raw_metrics


def test_backfill_and_daily_jobs(spark, tmp_dir):
    pts, out = os.path.join(tmp_dir, "points"), os.path.join(tmp_dir, "raw_metrics")
    A.metric_points(spark, SF_SMALL).write.parquet(pts)
    n = run_backfill(spark, pts, out, 1, 31, dt.date(2024, 2, 1))
    got = read_raw_metrics(spark, out).drop("timestamp")
    want = A.backfilled_raw_metrics(spark, SF_SMALL).drop("timestamp")
    cols = sorted(want.columns)
    assert n == want.count() > 0
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(map(tuple, want.select(cols).collect()), key=str)
    # daily job for a day without points writes nothing; re-running a day appends it again
    assert run_daily(spark, pts, out, dt.date(2030, 1, 1)) == 0
    k = run_daily(spark, pts, out, dt.date(2024, 1, 16))
    k2 = run_daily(spark, pts, out, dt.date(2024, 1, 16))
    assert k == k2 > 0
    assert spark.read.parquet(out).count() == n + 2 * k
