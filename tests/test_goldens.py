"""Hand-computed goldens."""

import datetime as dt

from helpers import approx, events_df, one, raw_metrics_df, ts

from svcvitals.operators import legacy as W, scores as SC, survey as SV
from svcvitals import schemas as S

AS_OF = dt.date(2026, 8, 1)
EPOCH = dt.date(2026, 3, 1)


def test_performance_score(spark):
    rm = raw_metrics_df(spark, [dict(service_name="cloudrun--a", total_requests=1000, error_5xx_requests=2,
                                     error_4xx_requests=3, latency_p50_ms=400.0, latency_p95_ms=5000.0)])
    r = one(SC.service_performance_scores(rm))
    assert approx(r.availability_ratio, 0.995)
    assert approx(r.performance_score, 57.5)
    assert r.p50_target_ms == 500.0 and r.p95_target_ms == 2500.0


def test_performance_no_traffic(spark):
    rm = raw_metrics_df(spark, [dict(service_name="cloudrun--a", total_requests=0, error_5xx_requests=0,
                                     error_4xx_requests=0),
                                dict(service_name="cloudrun--b")])
    for r in SC.service_performance_scores(rm).collect():
        assert r.availability_ratio == 1.0
        assert approx(r.performance_score, 100.0)


def _r7_inputs(spark, archetype="sync", events=True):
    rm = raw_metrics_df(spark, [dict(service_name="svc", archetype=archetype, target_date=d, total_requests=10,
                                     error_5xx_requests=0, error_4xx_requests=0)
                                for d in ("2026-07-30", "2026-07-31")])
    perf = SC.service_performance_scores(rm)
    ev = events_df(spark, [
        (ts(AS_OF - dt.timedelta(days=5)), "SUCCESS", "svc", False),
        (ts(dt.date(2026, 7, 10)), "SUCCEEDED", "svc", False),
        (ts(dt.date(2026, 6, 15)), "SUCCESS", "svc", False),
        (ts(AS_OF - dt.timedelta(days=20)), "FAILED", "svc", True),
    ] if events else [])
    return perf, ev


def test_pipeline_fanout(spark):
    perf, ev = _r7_inputs(spark)
    r = one(SC.pipeline_robustness_scores(perf, ev, AS_OF, EPOCH))
    assert r.total_deployments_in_window == 8
    assert approx(r.raw_delivery_success, 75.0)
    assert r.total_rollbacks_30d == 2 and r.rollback_score == 0.0
    assert approx(r.delivery_success_score, 37.5)
    assert approx(r.cadence_score, 100.0 / 3)
    assert approx(r.pipeline_score, 21.25)
    assert r.days_since_last_deploy == 5 and r.months_deployed_in_window == 2


def test_pipeline_distinct(spark):
    perf, ev = _r7_inputs(spark)
    r = one(SC.pipeline_robustness_scores(perf, ev, AS_OF, EPOCH, fanout=False))
    assert r.total_deployments_in_window == 4
    assert r.total_rollbacks_30d == 1 and r.rollback_score == 50.0
    assert approx(r.delivery_success_score, 62.5)
    assert approx(r.pipeline_score, 28.75)


def test_pipeline_async(spark):
    perf, ev = _r7_inputs(spark, archetype="async")
    r = one(SC.pipeline_robustness_scores(perf, ev, AS_OF, EPOCH))
    assert approx(r.pipeline_score, 11.25 + 40.0 / 3)


def test_pipeline_no_events(spark):
    perf, ev = _r7_inputs(spark, events=False)
    r = one(SC.pipeline_robustness_scores(perf, ev, AS_OF, EPOCH))
    assert r.days_since_last_deploy == 999
    assert approx(r.delivery_success_score, 50.0)
    assert r.cadence_score == 0.0
    assert approx(r.pipeline_score, 15.0)


def _survey(spark, rows):
    return spark.createDataFrame(rows, S.SURVEY)


def test_observability(spark):
    s = _survey(spark, [("svc",) + ("TRUE",) * 10 + (" Yes ",)])
    r = one(SV.observability_scores(s))
    assert r.observability_score == 125.0 and r.feature_flag_score == 100.0


def _composite(spark, with_survey):
    rm = raw_metrics_df(spark, [dict(service_name="svc", total_requests=1000, error_5xx_requests=2,
                                     error_4xx_requests=3, latency_p50_ms=400.0, latency_p95_ms=5000.0)])
    perf = SC.service_performance_scores(rm)
    pipe = spark.createDataFrame([("svc", 21.25)], "service_name string, pipeline_score double")
    for c in SC.PIPELINE_COLUMNS:
        if c not in pipe.columns:
            pipe = pipe.withColumn(c, SC.F.lit(None).cast("double"))
    obs = SV.observability_scores(_survey(spark, [("svc",) + ("TRUE",) * 8 + ("no",) * 2 + ("yes",)])) \
        if with_survey else None
    return one(SC.composite_health_scores(perf, obs, pipe))


def test_composite(spark):
    r = _composite(spark, True)
    assert approx(r.cat2_pipeline_score, 31.25)
    assert approx(r.composite_service_health_score, 61.5625)


def test_composite_no_survey(spark):
    r = _composite(spark, False)
    assert approx(r.cat2_pipeline_score, 21.25)
    assert approx(r.composite_service_health_score, 34.0625)


def _legacy(spark, archetype):
    df = spark.createDataFrame([("svc", archetype, 0.99, None, 1000.0, 5, 1000, None, None)], S.LEGACY_METRICS)
    return one(W.legacy_final_score(df)), one(W.legacy_component_scores(df))


def test_legacy_sync(spark):
    f, c = _legacy(spark, "sync")
    assert approx(c.availability_score, 99.0) and approx(c.latency_score, 50.0) and approx(c.log_health_score, 95.0)
    assert approx(f.performance_pillar_score, 86.35) and approx(f.final_service_health_score, 93.175)


def test_legacy_async(spark):
    f, _ = _legacy(spark, "async")
    assert approx(f.performance_pillar_score, 99.2) and approx(f.final_service_health_score, 99.6)


def test_legacy_other(spark):
    f, _ = _legacy(spark, "batch")
    assert f.performance_pillar_score == 0.0 and approx(f.final_service_health_score, 50.0)
