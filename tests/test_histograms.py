"""Distribution-valued latencies: layouts, merging, interpolation."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from svcvitals import config as C, schemas as S
from svcvitals.operators import histograms as H, metrics as M

CLOUDRUN, ENDPOINTS = C.METRIC_SOURCES[0], C.METRIC_SOURCES[2]
DAY = dt.datetime(2026, 3, 1, 5)
PS = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def explicit(*bounds):
    return ("explicit", list(map(float, bounds)), None, None, None, None, None)


def exponential(n, scale, growth):
    return ("exponential", None, n, float(scale), float(growth), None, None)


def linear(n, offset, width):
    return ("linear", None, n, None, None, float(offset), float(width))


def points(spark, rows, source=CLOUDRUN):
    """rows: (service, series, ts, layout, counts)."""
    data = [(source[2], {source[3]: svc, "instance_id": inst}, {}, ts, layout, counts) for svc, inst, ts, layout, counts in rows]
    return spark.createDataFrame(data, S.DISTRIBUTION_POINTS)


def bounds_of(layout):
    kind, bounds, n, scale, growth, offset, width = layout
    if kind == "explicit":
        return bounds
    return [scale * growth ** i for i in range(n + 1)] if kind == "exponential" else [offset + width * i for i in range(n + 1)]


def by_hand(parts, p):
    """The quantile of (layout, counts) pairs by inverting the sum of their distribution functions."""
    spread = []
    for layout, counts in parts:
        b = bounds_of(layout)
        for i, n in enumerate(counts):
            if n:
                lo = (0.0 if b[0] > 0 else b[0]) if i == 0 else b[min(i, len(b)) - 1]
                spread.append((lo, b[min(i, len(b) - 1)], n))
    total = sum(n for *_, n in spread)
    below = lambda x, closed: sum(n * ((closed if lo <= x else 0) if lo == hi and lo == x else 1.0 if x >= hi and (lo < hi or x > lo) else max(0.0, (x - lo) / (hi - lo)) if hi > lo else 0.0)
                                  for lo, hi, n in spread)
    edges = sorted({x for lo, hi, _ in spread for x in (lo, hi)})
    rank = p * total
    for a, b in zip([None, *edges], edges):
        if a is not None and below(b, 0) >= rank - 1e-9 and below(b, 0) > below(a, 1):
            return a + (max(rank, below(a, 1)) - below(a, 1)) / (below(b, 0) - below(a, 1)) * (b - a)
        if below(b, 1) >= rank - 1e-9 and below(b, 1) > below(b, 0):
            return b
    return None


def test_worked_values(spark):
    rows = [("svc", "1", DAY, explicit(10, 20, 40), [0, 4, 4, 2])]
    r = H.histogram_percentiles(points(spark, rows).withColumn("g", F.lit(1)), ["g"], PS).first()
    assert (r.n, r.p0, r.p50, r.p100) == (10, 10.0, 25.0, 40.0) and r.p95 == 40.0


def test_layouts_of_every_kind_and_mixed_days(spark):
    rng = random.Random(4)
    layouts = [explicit(8, 16, 32, 64), explicit(0, 5), explicit(-4, 4, 12), exponential(5, 1, 2), exponential(3, 0.5, 4), linear(6, 0, 16), linear(2, 3, 8), explicit(7)]
    rows, parts = [], {}
    for k in range(120):
        g = str(rng.randrange(25))
        layout = rng.choice(layouts)
        counts = [rng.choice([0, 0, 1, 3, 20]) for _ in range(rng.randint(0, len(bounds_of(layout)) + 1))]
        rows.append(("svc", g, DAY, layout, counts))
        parts.setdefault(g, []).append((layout, counts))
    df = points(spark, rows).withColumn("g", F.col("resource_labels")["instance_id"])
    got = {r.g: r for r in H.histogram_percentiles(df, ["g"], PS).collect()}
    for g, own in parts.items():
        total = sum(sum(c) for _, c in own)
        if not total:
            assert g not in got
            continue
        assert got[g].n == total
        for name, p in PS.items():
            assert got[g][name] == pytest.approx(by_hand(own, p), abs=1e-6), (g, name, own)


def test_odd_points(spark):
    no = (None,) * 7
    rows = [("svc", "1", DAY, explicit(1, 2), None), ("svc", "1", DAY, None, [1]), ("svc", "1", DAY, no, [1, 2]), ("svc", "1", DAY, explicit(), [5]),
            ("svc", "1", DAY, explicit(1, 2), []), ("svc", "1", DAY, explicit(1, 2), [0, None, -3]), ("svc", "1", DAY, ("other", [1.0], 1, 1.0, 2.0, 0.0, 1.0), [4]),
            ("svc", "1", DAY, exponential(-1, 1, 2), [4])]
    assert H.daily_histogram_percentiles(points(spark, rows)).collect() == []
    assert H.daily_histogram_percentiles(points(spark, [])).collect() == []
    beyond = points(spark, [("svc", "1", DAY, explicit(1, 2), [0, 0, 0, 0, 9])])  # counts behind the last bucket lie at the last bound
    assert H.daily_histogram_percentiles(beyond).first().latency_p50 == 2.0


def test_series_then_services_and_scale(spark):
    two = explicit(0.25, 0.5, 1)
    rows = [("a", "1", DAY, two, [0, 2]), ("a", "1", DAY + dt.timedelta(hours=3), two, [0, 2]), ("a", "2", DAY, two, [0, 0, 8]), ("a", "3", DAY + dt.timedelta(days=1), two, [4]),
            ("x.googleapis.com", "1", DAY, two, [4]), ("", "1", DAY, two, [4])]
    df = points(spark, rows, ENDPOINTS)
    got = {(r.service_name, r.day.day): r for r in H.daily_histogram_percentiles(df).collect()}
    assert set(got) == {("endpoints--a", 1), ("endpoints--a", 2)}
    assert got["endpoints--a", 1].latency_p50 == pytest.approx((0.375 + 0.75) / 2 * 1000)
    assert got["endpoints--a", 2].latency_p50 == pytest.approx(125.0)
    merged = {r.day.day: r for r in H.daily_histogram_percentiles(df, across="merged").collect()}
    assert merged[1].latency_p50 == pytest.approx((0.5 + 0.5 * (6 - 4) / 8) * 1000)
    with pytest.raises(ValueError):
        H.daily_histogram_percentiles(df, across="no")


def test_joins_the_counts_like_scalar_samples(spark):
    counts = spark.createDataFrame([(CLOUDRUN[1], {CLOUDRUN[3]: "svc"}, {}, DAY, 5, None)], S.METRIC_POINTS)
    lat = H.daily_histogram_percentiles(points(spark, [("svc", "1", DAY, explicit(10, 20), [0, 4])]))
    r = M.raw_metrics_rows(M.project_attribution(M.merge_counts_latency(M.daily_service_counts(counts), lat)), "2026-03-02").first()
    assert (r.service_name, r.total_requests, r.latency_p50_ms, r.latency_p95_ms) == ("cloudrun--svc", 5, 15.0, 19.5)


def test_points_of_a_series_are_added_before_the_shuffle(spark):
    """What is shuffled is a row per series, day and bucket: partial sums on the map side."""
    df = points(spark, [("svc", str(k % 2), DAY, explicit(1, 2), [1, 1, 1]) for k in range(50)])
    merged = H.merged_buckets(M.with_day(df).withColumn("g", F.col("resource_labels")["instance_id"]), ["day", "g"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(n" in plan and all(len(r.buckets) == 3 and r.buckets[0].n == 25 for r in merged.collect())
