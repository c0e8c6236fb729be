"""Days of raw_metrics written again: same table, also after a crash."""

import datetime as dt
import os

import pytest
from conftest import SF_SMALL
from helpers import raw_metrics_df
from pyspark.sql import functions as F

from svcvitals import schemas as S
from svcvitals.operators import metrics as M
from svcvitals.plans.jobs import run_backfill, run_daily
from svcvitals.sources import adapters as A
from svcvitals.sources.commits import DayCommits
from svcvitals.sources.tables import write_points

D1, D2, D3 = "2026-07-01", "2026-07-02", "2026-07-03"


def _rows(spark, *days, total=5):
    return raw_metrics_df(spark, [{"target_date": d, "service_name": s, "total_requests": total} for d in days for s in ("a", "b")])


def _read(table):
    return sorted((r.target_date, r.service_name, r.total_requests) for r in table.read(S.RAW_METRICS).collect())


def _want(*days):
    return sorted((d, s, n) for d, n in days for s in ("a", "b"))


def test_replacing_a_day_leaves_the_others(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    table = DayCommits(spark, path)
    assert table.committed() == [] and _read(table) == []
    assert M.replace_raw_metrics(_rows(spark, D1, D2), path, [D1, D2, D3]) == {D1: 2, D2: 2, D3: 0}
    assert table.committed() == [D1, D2, D3] and table.missing([D3, "2026-07-04"]) == ["2026-07-04"]
    for _ in range(2):
        M.replace_raw_metrics(_rows(spark, D2, total=9), path, [D2])
        assert _read(table) == _want((D1, 5), (D2, 9))
    # a day that has lost its rows is empty afterwards; no days: nothing happens
    assert M.replace_raw_metrics(_rows(spark, D1).limit(0), path, [D1]) == {D1: 0}
    assert M.replace_raw_metrics(_rows(spark, D1), path, []) == {}
    assert _read(table) == _want((D2, 9))


def test_rows_of_other_days_are_refused(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    with pytest.raises(Exception, match="another target_date"):
        M.replace_raw_metrics(_rows(spark, D1, D2), path, [D1])
    with pytest.raises(ValueError):
        M.replace_raw_metrics(_rows(spark, D1).drop("project_id"), path, [D1])


def test_crash_and_rerun(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "raw")
    table = DayCommits(spark, path)
    M.replace_raw_metrics(_rows(spark, D1), path, [D1])
    # in the middle of the write
    broken = _rows(spark, D2, D3).withColumn("total_requests", F.when(F.col("service_name") == "b", F.raise_error(F.lit("lost")).cast("long")).otherwise(F.lit(1)))
    with pytest.raises(Exception, match="lost"):
        M.replace_raw_metrics(broken, path, [D2, D3])
    assert table.committed() == [D1] and _read(table) == _want((D1, 5))
    # after the write, before the closing mark: rows are there, the days are not committed
    with monkeypatch.context() as m:
        m.setattr(DayCommits, "_stored", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            M.replace_raw_metrics(_rows(spark, D1, D2, total=7), path, [D1, D2])
    assert spark.read.parquet(path).filter(f"target_date = '{D2}'").count() == 2
    assert table.committed() == [] and _read(table) == []
    M.replace_raw_metrics(_rows(spark, D1, D2, D3), path, table.missing([D1, D2, D3]))
    assert _read(table) == _want((D1, 5), (D2, 5), (D3, 5))


def test_only_committed_folders_are_listed(spark, tmp_dir):
    path = os.path.join(tmp_dir, "raw")
    M.replace_raw_metrics(_rows(spark, D1, D2), path, [D1, D2])
    plan = spark._jvm.PythonSQLUtils.explainString(DayCommits(spark, path).read(S.RAW_METRICS)._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [target_date" in plan


def test_jobs_replace_and_fill_gaps(spark, tmp_dir):
    pts, out = os.path.join(tmp_dir, "points"), os.path.join(tmp_dir, "raw")
    write_points(A.metric_points(spark, SF_SMALL), pts)
    as_of = dt.date(2024, 1, 11)
    table = DayCommits(spark, out)
    first = run_backfill(spark, pts, out, 3, 5, as_of, replace=True)
    assert first == run_backfill(spark, pts, out, 3, 5, as_of, replace=True) == spark.read.parquet(out).count() > 0
    more = run_backfill(spark, pts, out, 1, 6, as_of, only_missing=True)
    assert run_backfill(spark, pts, out, 1, 6, as_of, only_missing=True) == 0
    cols = [c for c in S.RAW_METRICS.names if c != "timestamp"]
    want = M.backfill(A.metric_points(spark, SF_SMALL), None, as_of, 1, 6, A.INGESTED_AT).select(cols)
    got = table.read(S.RAW_METRICS).select(cols)
    assert first + more == got.count() and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert run_daily(spark, pts, out, as_of, only_missing=True) == 0
    assert run_daily(spark, pts, out, dt.date(2030, 1, 1), replace=True) == 0 and "2029-12-31" in table.committed()
