"""Stored latency sketches: merged windows against all samples."""

import datetime as dt
import os

from conftest import SF_ORACLE, SF_SMALL

from pyspark.sql import functions as F

from svcvitals.operators import sketches as SK
from svcvitals.sources import adapters as A


def _near(answer, values, p, k, times=3):
    values = sorted(values)
    below, upto = sum(v < answer for v in values), sum(v <= answer for v in values)
    slack = times * SK.rank_error(k) * len(values) + 1
    return below - slack <= p * len(values) <= upto + slack


def test_windows_against_samples(spark, tmp_dir):
    k, path = 32, os.path.join(tmp_dir, "sketches")
    points = A.metric_points(spark, SF_ORACLE)
    SK.write_sketches(SK.daily_sketches(points, A.sources(spark), k), path)
    stored = SK.read_sketches(spark, path)
    samples = SK.latency_samples(points, A.sources(spark)).select("day", "service_name", "ms").collect()
    weeks, days = {}, {}
    for r in samples:
        weeks.setdefault((r.day - dt.timedelta(days=r.day.weekday()), r.service_name), []).append(r.ms)
        days.setdefault((r.day, r.service_name), []).append(r.ms)
    got = {(r.window, r.service_name): r for r in SK.window_percentiles(stored).collect()}
    assert set(got) == set(weeks) and max(map(len, weeks.values())) > 2 * k
    assert all(got[w].n == len(v) and _near(got[w].latency_p50, v, 0.5, k) and _near(got[w].latency_p95, v, 0.95, k) for w, v in weeks.items())
    rolled = {(r.day, r.service_name): r for r in SK.rolling_percentiles(stored, 3, {"p": 0.9}).collect()}
    assert set(rolled) == set(days)
    for (day, service), r in rolled.items():
        values = [x for b in range(3) for x in days.get((day - dt.timedelta(days=b), service), [])]
        assert r.n == len(values) and _near(r.p, values, 0.9, k)
    # a day written again is replaced, the others stay
    one = min(d for d, _ in days)
    SK.write_sketches(SK.daily_sketches(points.filter(F.to_date("ts") == F.lit(one)), A.sources(spark), k), path)
    assert SK.read_sketches(spark, path).agg(F.sum("n")).first()[0] == len(samples)


def test_measured_error_sees_a_wrong_answer(spark):
    samples = spark.range(1000).select(F.lit(dt.date(2024, 1, 1)).alias("window"), F.lit("s").alias("service_name"), F.col("id").cast("double").alias("ms"))
    answers = spark.createDataFrame([(dt.date(2024, 1, 1), "s", 500.0, 700.0)], "window date, service_name string, latency_p50 double, latency_p95 double")
    r = SK.measured_rank_error(answers, samples).first()
    assert r.n == 1000 and r.latency_p50_error <= 0.001 and abs(r.latency_p95_error - 0.249) < 0.002


def test_no_samples(spark):
    points = A.metric_points(spark, SF_SMALL).limit(0)
    assert SK.window_percentiles(SK.daily_sketches(points, A.sources(spark))).count() == 0
    odd = A.metric_points(spark, SF_SMALL).withColumn("double_value", F.when(F.col("int64_value").isNull(), F.lit(float("nan"))))
    assert SK.daily_sketches(odd, A.sources(spark)).count() == 0
