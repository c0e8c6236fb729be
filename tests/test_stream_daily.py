"""The daily job as a stream: what the batch job gives for days that are over."""

import datetime as dt
import os

from conftest import SF_SMALL

from pyspark.sql import functions as F

from svcvitals import schemas as S
from svcvitals.operators import metrics as M
from svcvitals.sources import adapters as A
from svcvitals.sources.tables import read_raw_metrics
from svcvitals.streaming import daily as D

COLS = [c for c in S.RAW_METRICS.names if c != "timestamp"]


def _same(got, want):
    got, want = got.select(COLS), want.select(COLS)
    assert sorted(map(str, got.exceptAll(want).collect())) == sorted(map(str, want.exceptAll(got).collect()))


def test_stream_equals_batch_with_late_points_aside(spark, tmp_dir):
    landing, gate, sink, c1, c2 = (os.path.join(tmp_dir, x) for x in ("landing", "gate", "sink", "c1", "c2"))
    points = A.metric_points(spark, SF_SMALL).filter("ts < '2024-01-09'").cache()
    sources = A.sources(spark)

    def deliver(part):
        part.write.mode("append").parquet(landing)
        D.stream_gate(spark, landing, gate, c1, "6 hours").awaitTermination()
        D.stream_raw_metrics(spark, gate, sink, c2, sources, "6 hours", A.INGESTED_AT).awaitTermination()  # each time from its checkpoint
    deliver(points.filter("ts < '2024-01-04 12:00:00'"))
    done = {r.target_date for r in read_raw_metrics(spark, sink).select("target_date").distinct().collect()}
    assert done == {"2024-01-01", "2024-01-02", "2024-01-03"}
    # out of order, but not late: the rest in two halves; then a day that is over, and no time at all
    rest = points.filter("ts >= '2024-01-04 12:00:00'")
    deliver(rest.filter("ts < '2024-01-05' AND hour(ts) % 2 = 1"))
    deliver(rest.filter("ts < '2024-01-05' AND hour(ts) % 2 = 0"))
    again = points.filter("ts < '2024-01-02'")
    deliver(rest.filter("ts >= '2024-01-05'").unionByName(again).unionByName(again.limit(3).withColumn("ts", F.lit(None).cast("timestamp"))))
    got = read_raw_metrics(spark, sink)
    assert got.agg(F.max("target_date")).first()[0] == "2024-01-07"  # the 8th is open
    want = M.raw_metrics_rows(M.project_attribution(M.merge_counts_latency(
        M.daily_service_counts(points, sources), M.daily_latency_percentiles(points, sources))), A.INGESTED_AT)
    _same(got, want.filter("target_date < '2024-01-08'"))
    assert D.read_late_points(spark, gate).count() == again.count() + 3
    deliver(points.limit(0))
    assert read_raw_metrics(spark, sink).count() == got.count()


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_dir):
    gate = D._Gate(os.path.join(tmp_dir, "gate"), "1 day")
    points = A.metric_points(spark, SF_SMALL).filter("ts < '2024-01-03'")
    gate(points, 0)
    listed = sorted(os.listdir(os.path.join(tmp_dir, "gate", D.ON_TIME, "batch=0")))
    gate(points, 0)
    assert sorted(os.listdir(os.path.join(tmp_dir, "gate", D.ON_TIME, "batch=0"))) == listed
    gate(points.withColumn("ts", F.lit(dt.datetime(2023, 12, 30))), 1)
    assert D.read_late_points(spark, gate.folder).count() == points.count()
