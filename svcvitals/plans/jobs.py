"""Batch jobs: the daily ingestion and the backfill, as a scheduler would run them.

    python -m svcvitals.plans.jobs daily    --points P --raw-metrics R [--as-of YYYY-MM-DD]
    python -m svcvitals.plans.jobs backfill --points P --raw-metrics R --start-days-ago 2 --end-days-ago 42

Both read a points table (``schemas.METRIC_POINTS``; stored by day with
``sources.tables.write_points``, only the window's folders are read) and append to ``raw_metrics`` partitioned by ``target_date``.
A day without points writes nothing. Re-running a day appends its rows again, as the
stored table does not deduplicate.

With ``--replace`` a run writes its days as all that the table holds of them and marks each
when complete (``sources.commits``), so that a re-run adds nothing; ``--only-missing`` passes
over days that are marked already. Use one way for one table: appended days carry no mark.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from svcvitals.operators import metrics as M
from svcvitals.session import configure, own_folders
from svcvitals.sources.commits import DayCommits
from svcvitals.sources.tables import POINTS_DAY, read_points


def _append_if_rows(rows: DataFrame, path: str) -> int:
    # rows are a handful per service and day: count them once, then write
    rows = rows.cache()
    n = rows.count()
    if n:
        M.append_raw_metrics(rows, path)
    rows.unpersist()
    return n


def _days(as_of: dt.date, start_days_ago: int, end_days_ago: int) -> list[str]:
    return [str(as_of - dt.timedelta(days=k)) for k in range(end_days_ago, start_days_ago - 1, -1)]


def _on_days(points: DataFrame, days: list[str]) -> DataFrame:
    """Points of the days; of a table stored by day, only those folders."""
    day = F.col(POINTS_DAY) if POINTS_DAY in points.columns else F.to_date("ts")
    return points.filter(day.isin([dt.date.fromisoformat(d) for d in days]))


def run_daily(spark: SparkSession, points_path: str, raw_metrics_path: str,
              as_of: dt.date | None = None, method: str = "exact", replace: bool = False,
              only_missing: bool = False) -> int:
    """Ingest yesterday (UTC, relative to ``as_of``, default today)."""
    configure(spark)
    as_of = as_of or dt.datetime.now(dt.timezone.utc).date()
    days = _days(as_of, 1, 1)
    if only_missing and not DayCommits(spark, raw_metrics_path).missing(days):
        return 0
    with own_folders(spark):
        rows = M.ingest_day(read_points(spark, points_path), None, as_of, F.current_timestamp(), method=method)
        if replace or only_missing:
            return sum(M.replace_raw_metrics(rows, raw_metrics_path, days).values())
        return _append_if_rows(rows, raw_metrics_path)


def run_backfill(spark: SparkSession, points_path: str, raw_metrics_path: str,
                 start_days_ago: int = 1, end_days_ago: int = 51, as_of: dt.date | None = None,
                 method: str = "exact", replace: bool = False, only_missing: bool = False) -> int:
    """Every day from ``end_days_ago`` to ``start_days_ago`` before ``as_of``, in one job."""
    configure(spark)
    as_of = as_of or dt.datetime.now(dt.timezone.utc).date()
    points = read_points(spark, points_path)
    days = _days(as_of, start_days_ago, end_days_ago)
    if only_missing:
        days = DayCommits(spark, raw_metrics_path).missing(days)
        if not days:
            return 0
        points = _on_days(points, days)
    with own_folders(spark):
        rows = M.backfill(points, None, as_of, start_days_ago, end_days_ago,
                          F.current_timestamp(), method=method)
        if replace or only_missing:
            return sum(M.replace_raw_metrics(rows, raw_metrics_path, days).values())
        return _append_if_rows(rows, raw_metrics_path)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="svcvitals.plans.jobs")
    ap.add_argument("job", choices=["daily", "backfill"])
    ap.add_argument("--points", required=True)
    ap.add_argument("--raw-metrics", required=True)
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    ap.add_argument("--start-days-ago", type=int, default=2)
    ap.add_argument("--end-days-ago", type=int, default=42)
    ap.add_argument("--method", default="exact", choices=["exact", "builtin", "approx"])
    ap.add_argument("--replace", action="store_true")
    ap.add_argument("--only-missing", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"svcvitals-{a.job}").getOrCreate()
    if a.job == "daily":
        n = run_daily(spark, a.points, a.raw_metrics, a.as_of, a.method, a.replace, a.only_missing)
    else:
        n = run_backfill(spark, a.points, a.raw_metrics, a.start_days_ago, a.end_days_ago, a.as_of, a.method,
                         a.replace, a.only_missing)
    print(f"{a.job}: wrote {n} rows to {a.raw_metrics}")


if __name__ == "__main__":
    main()
