"""Exact percentiles equal Spark's percentile at every size, in one plan."""


import random

from conftest import SF_SMALL
from pyspark.sql import functions as F

from svcvitals.operators import metrics as M
from svcvitals.operators.quantiles import exact_percentiles, value_range
from svcvitals.sources import adapters as A

PS = {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0, "p33": 0.33}


def _data(spark):
    rnd = random.Random(7)
    rows = []
    for g, n in enumerate([1, 2, 5, 40, 300]):
        for _ in range(n):
            v = rnd.choice([rnd.random() * 100, round(rnd.random() * 10, 1), 1e9 * rnd.random(), 3.0, None])
            rows.append((g, "x" if g % 2 else None, v))
    rows.append((9, "y", None))
    return spark.createDataFrame(rows, "g int, h string, v double")


def _want(df):
    return {(r.g, r.h): tuple(r[2:]) for r in
            df.groupBy("g", "h").agg(*[F.percentile("v", p).alias(n) for n, p in PS.items()]).collect()}


def test_equals_percentile(spark):
    df = _data(spark)
    got = {(r.g, r.h): tuple(r[2:]) for r in exact_percentiles(df, ["g", "h"], "v", PS).collect()}
    assert got == _want(df)


def test_rollup_equals_builtin(spark):
    p = A.metric_points(spark, SF_SMALL)
    key = lambda r: (r.day, r.service_name)
    want = sorted(M.daily_latency_percentiles(p, None, method="builtin").collect(), key=key)
    got = sorted(M.daily_latency_percentiles(p, None, method="exact").collect(), key=key)
    assert got == want


def test_single_hot_group(spark):
    """Every latency sample in one group: its values are dealt over several ranges."""
    p = A.metric_points(spark, SF_SMALL).filter(F.col("double_value").isNotNull())
    hot = p.select(F.lit("hot").alias("g"), F.col("double_value").alias("v"))
    ps = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    want = hot.groupBy("g").agg(*[F.percentile("v", q).alias(n) for n, q in ps.items()]).collect()
    got = exact_percentiles(hot, ["g"], "v", ps)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want]
    ranges = hot.groupBy(value_range(F.col("v"))).count()
    assert ranges.count() > 500 and ranges.agg(F.max("count")).first()[0] < hot.count() / 50


def test_ranges_follow_the_order_of_doubles(spark):
    rnd = random.Random(3)
    values = [float("-inf"), -1.7e308, -1.0, -1e-300, -5e-324, -0.0, 0.0, 5e-324, 1e-300, 1.0, 1.0000001, 2.0, 1.7e308, float("inf"), float("nan"), None]
    values += [rnd.choice([-1, 1]) * 10 ** rnd.uniform(-300, 300) for _ in range(300)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").orderBy("v").select("v", value_range(F.col("v")).alias("r")).collect()
    ranges = [r.r for r in rows if r.v is not None]
    assert ranges == sorted(ranges) and [r.r for r in rows if r.v is None] == [None]
    df = spark.createDataFrame([(k % 3, v) for k, v in enumerate(values)], "g int, v double").filter("v IS NULL OR NOT isnan(v)")
    key = lambda r: r.g
    want = df.groupBy("g").agg(*[F.percentile("v", q).alias(n) for n, q in PS.items()]).collect()
    assert repr(sorted(exact_percentiles(df, ["g"], "v", PS).collect(), key=key)) == repr(sorted(want, key=key))


def test_extreme_values_in_a_handful_of_jobs(spark):
    """Values near the largest double are nothing special, and building the frame runs no job."""
    values = [-1.7e308, -1.0, 0.0, 1.0, 2.0, 1.7e308]
    df = spark.createDataFrame([(1, v) for v in values], "g int, v double")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("extreme", "extreme")
    try:
        frame = exact_percentiles(df, ["g"], "v", {"p0": 0.0, "p50": 0.5, "p100": 1.0})
        assert len(tracker.getJobIdsForGroup("extreme")) == 0
        got = frame.collect()
        jobs = len(tracker.getJobIdsForGroup("extreme"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert [tuple(r) for r in got] == [(1, -1.7e308, 0.5, 1.7e308)]
    assert jobs <= 12


def test_points_are_scanned_once(spark, tmp_dir):
    """Both branches of both levels read one shuffle of the points."""
    points = A.metric_points(spark, SF_SMALL)
    points.write.parquet(tmp_dir + "/points")
    got = M.daily_latency_percentiles(spark.read.parquet(tmp_dir + "/points"), None)
    got.collect()
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") >= 2
