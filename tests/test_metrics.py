"""Metric roll-up operators on literal points."""

import datetime as dt
import os

import pytest
from helpers import approx
from pyspark.sql import functions as F

from svcvitals import schemas as S
from svcvitals.operators import metrics as M
from svcvitals.sources.survey_sheet import read_survey, write_survey

RUN_C, RUN_L = "run.googleapis.com/request_count", "run.googleapis.com/request_latencies"
EP_C, EP_L = "serviceruntime.googleapis.com/api/request_count", "serviceruntime.googleapis.com/api/request_latencies"


def _points(spark, rows):
    """rows: (metric_type, label_key, label, extra_labels, cls, ts, int, double)"""
    data = []
    for mt, key, label, extra, cls, t, i, d in rows:
        rl = {key: label, **(extra or {})}
        ml = {} if cls is None else {"response_code_class": cls}
        data.append((mt, rl, ml, t, i, d))
    return spark.createDataFrame(data, S.METRIC_POINTS)


def T(d, h=0, m=0, s=0, us=0):
    return dt.datetime(2026, 7, d, h, m, s, us)


def test_day_slice_half_open(spark):
    p = _points(spark, [(RUN_C, "service_name", "a", None, None, t, 1, None)
                        for t in (T(9, 23, 59, 59, 999999), T(10), T(10, 23, 59, 59), T(11))])
    got = [r.ts for r in M.day_slice(p, "2026-07-10").collect()]
    assert sorted(got) == [T(10), T(10, 23, 59, 59)]


def test_service_key_filters(spark):
    rows = [(RUN_C, "service_name", x, None, None, T(1), 1, None) for x in ("a", "", None, "x.googleapis.com")]
    rows.append((EP_C, "service", "x.googleapis.com", None, None, T(1), 1, None))
    rows.append((EP_C, "service", "api.example.org", None, None, T(1), 1, None))
    got = sorted(r.service_name for r in M.service_key(M.attach_sources(_points(spark, rows), M.metric_sources(spark))).collect())
    assert got == ["cloudrun--a", "cloudrun--x.googleapis.com", "endpoints--api.example.org"]


def test_class_rollup_and_merge(spark):
    rows = [(RUN_C, "service_name", "a", {"project_id": "p1"}, "2xx", T(1, 1), 100, None),
            (RUN_C, "service_name", "a", {"project_id": "p2"}, "503", T(1, 2), 5, None),
            (RUN_C, "service_name", "a", {"project_id": ""}, "404", T(1, 3), 3, None),
            (RUN_C, "service_name", "a", None, None, T(1, 4), 7, None),
            (RUN_L, "service_name", "b", None, None, T(1, 4), None, 12.5)]
    p, s = _points(spark, rows), M.metric_sources(spark)
    m = M.merge_counts_latency(M.daily_service_counts(p, s), M.daily_latency_percentiles(p, s))
    got = {r.service_name: r for r in M.project_attribution(m).collect()}
    a, b = got["cloudrun--a"], got["cloudrun--b"]
    assert (a.total_requests, a.error_5xx_requests, a.error_4xx_requests, a.project_id) == (115, 5, 3, "p2")
    assert a.latency_p50 is None
    assert (b.total_requests, b.project_id, b.latency_p50) == (0, "unknown", 12.5)


def test_percentiles_two_levels_and_scale(spark):
    rows = [(EP_L, "service", "api.x.org", {"instance": "1"}, None, T(1, h), None, v)
            for h, v in enumerate([0.001, 0.002, 0.010, 0.011])]
    rows += [(EP_L, "service", "api.x.org", {"instance": "2"}, None, T(1, 5), None, 0.004)]
    p, s = _points(spark, rows), M.metric_sources(spark)
    r = M.daily_latency_percentiles(p, s).collect()[0]
    # series 1: p50 = 6.0 ms, p95 = 10.85 ms; series 2: 4 ms. Across: p50(6, 4) = 5; p95(10.85, 4)
    assert approx(r.latency_p50, 5.0) and approx(r.latency_p95, 4 + 0.95 * 6.85, 1e-9)
    ap = M.daily_latency_percentiles(p, s, method="approx").collect()[0]
    assert ap.latency_p50 is not None


def test_host_attribution(spark):
    df = spark.createDataFrame(
        [("endpoints", "web.endpoints.proj-y.cloud.goog", "p"),
         ("endpoints", "x.endpoints..cloud.goog", "p"),
         ("endpoints", "api.example.org", "p"),
         ("cloudrun", "a.endpoints.b.cloud.goog", None)], "prefix string, label string, project_id string")
    got = [r.project_id for r in M.project_attribution(M.host_projects(df)).collect()]
    assert got == ["proj-y", "unknown", "p", "unknown"]


def test_host_project_needs_a_count_point(spark):
    label = "web.endpoints.proj-x.cloud.goog"
    rows = [(EP_L, "service", label, {"project_id": "p"}, None, T(1, 5), None, 0.1),
            (EP_L, "service", label, {"project_id": "p"}, None, T(2, 5), None, 0.1),
            (EP_C, "service", label, {"project_id": "p"}, "2xx", T(2, 6), 10, None)]
    got = {r.target_date: r.project_id for r in M.backfill(_points(spark, rows), None, "2026-07-04", 1, 3, "2026-07-04 00:00:00").collect()}
    assert got == {"2026-07-01": "unknown", "2026-07-02": "proj-x"}


def test_append_refuses_what_does_not_fit(spark, tmp_dir):
    rows = [(RUN_C, "service_name", "a", {"project_id": "p"}, "2xx", T(1, 6), 10, None)]
    good = M.ingest_day(_points(spark, rows), None, "2026-07-02", "2026-07-02 00:00:00")
    M.append_raw_metrics(good, os.path.join(tmp_dir, "t"))
    with pytest.raises(ValueError):
        M.append_raw_metrics(good.drop("archetype"), os.path.join(tmp_dir, "t"))
    with pytest.raises(ValueError):
        M.append_raw_metrics(good.withColumn("total_requests", F.col("total_requests").cast("string")), os.path.join(tmp_dir, "t"))
    with pytest.raises(Exception, match="service_name is required"):
        M.append_raw_metrics(good.withColumn("service_name", F.lit(None).cast("string")), os.path.join(tmp_dir, "t"))
    assert spark.read.parquet(os.path.join(tmp_dir, "t")).count() == 1


def test_backfill_equals_union_of_days(spark):
    rows = [(RUN_C, "service_name", "a", {"project_id": "p"}, "2xx", T(d, h), 10 * d + h, None)
            for d in (1, 2, 3) for h in (1, 5)]
    rows += [(RUN_L, "service_name", "a", None, None, T(d, h), None, float(d * h)) for d in (1, 2, 3) for h in (1, 5)]
    p, s = _points(spark, rows), M.metric_sources(spark)
    whole = M.backfill(p, s, dt.date(2026, 7, 4), 1, 3, "2026-07-04 00:00:00")
    parts = [M.backfill(p, s, dt.date(2026, 7, 4), k, k, "2026-07-04 00:00:00") for k in (1, 2, 3)]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, u.collect()))
    assert whole.count() == 3


def test_survey_sheet_roundtrip_multi_file(spark, tmp_dir):
    rows = [(f"svc-{i}",) + (" TRUE ", None, "a,b", 'q"x') * 2 + ("t", "f", "y") for i in range(50)]
    df = spark.createDataFrame(rows, S.SURVEY).repartition(3)
    path = os.path.join(tmp_dir, "sheet")
    write_survey(df, path)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) >= 2
    got = read_survey(spark, path)
    assert sorted(map(tuple, got.collect())) == sorted(rows)
    assert got.filter(F.col("service_name") == "service_name").count() == 0


def test_survey_records(spark, tmp_dir):
    """Cells and headers of several lines, doubled quotes, blank lines; two records lead each file."""
    rest = ",".join(["TRUE"] * 11)
    for k in (1, 2):
        with open(os.path.join(tmp_dir, f"s{k}.csv"), "w") as f:
            f.write(f'"Survey, part\n{k}"\n"service\nname",' + ",".join(f"h{i}" for i in range(11)) + "\n\n")
            f.write(f'a{k},"see\nrunbook",' + rest[:-5] + f'\n\n"b""{k}",,' + rest[:-5] + "\n")
    got = {r.service_name: r for r in read_survey(spark, tmp_dir).collect()}
    assert sorted(got) == ["a1", "a2", 'b"1', 'b"2']
    assert got["a1"].has_staging == "see\nrunbook" and got['b"2'].has_staging is None and got["a2"].has_feature_flags == "TRUE"


def test_as_of_column(spark):
    rows = [(RUN_C, "service_name", "a", {"project_id": "p"}, "2xx", T(d, 6), 10, None) for d in (1, 2, 3)]
    p = _points(spark, rows)
    as_of = F.lit("2026-07-04").cast("date")
    assert M.backfill(p, None, as_of, 1, 3, "2026-07-04 00:00:00").count() == 3
    assert M.backfill(p, None, "2026-07-04", 1, 3, "2026-07-04 00:00:00").count() == 3
    assert M.ingest_day(p, None, as_of, "2026-07-04 00:00:00").collect()[0].target_date == "2026-07-03"
    assert M.ingest_day(p, None, F.current_date()).count() == 0
