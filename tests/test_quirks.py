"""One small DataFrame per documented quirk."""

import datetime as dt

import pytest
from helpers import approx, events_df, one, raw_metrics_df, ts
from pyspark.sql import functions as F

from svcvitals import config as C, schemas as S
from svcvitals.functions.columns import environment, json_scalar, py_round
from svcvitals.operators import events as E, legacy as W, metrics as M, scores as SC, survey as SV

AS_OF = dt.date(2026, 8, 1)
EPOCH = dt.date(2026, 3, 1)


def _perf(spark, rows):
    return SC.service_performance_scores(raw_metrics_df(spark, rows))


def test_q1_fanout_multiplies_counts(spark):
    perf = _perf(spark, [dict(service_name="s", target_date=f"2026-07-{d:02d}") for d in (1, 2, 3)])
    ev = events_df(spark, [(ts(AS_OF - dt.timedelta(days=3)), "SUCCESS", "s", True)])
    r = one(SC.deployment_base_metrics(perf, ev, AS_OF, EPOCH))
    assert r.total_deployments_in_window == 3 and r.total_rollbacks_30d == 3
    assert r.raw_delivery_success == 100.0 and r.months_deployed_in_window == 1


def test_q2_two_archetypes_double_composite_rows(spark):
    perf = _perf(spark, [dict(service_name="s", archetype="sync", target_date="2026-07-02"),
                         dict(service_name="s", archetype="cron", target_date="2026-07-01")])
    pipe = SC.pipeline_robustness_scores(perf, events_df(spark, []), AS_OF, EPOCH)
    assert pipe.count() == 2
    assert SC.composite_health_scores(perf, None, pipe).count() == 4


def test_q3_observability_up_to_125(spark):
    s = spark.createDataFrame([("a",) + ("true",) * 10 + (None,), ("b",) + ("no",) * 11], S.SURVEY)
    got = {r.service_name: r.observability_score for r in SV.observability_scores(s).collect()}
    assert got == {"a": 125.0, "b": 0.0}


def test_q4_cadence_over_100_and_zero_denominator(spark):
    perf = _perf(spark, [dict(service_name="s")])
    months = [dt.date(2026, m, 10) for m in (2, 3, 4, 5, 6, 7)] + [dt.date(2026, 7, 30)]
    ev = events_df(spark, [(ts(d), "SUCCESS", "s", False) for d in months])
    r = one(SC.pipeline_robustness_scores(perf, ev, AS_OF, dt.date(2026, 5, 1)))
    assert r.cadence_score > 100.0  # 6 months / denominator 4
    with pytest.raises(Exception):
        SC.pipeline_robustness_scores(perf, ev, AS_OF, dt.date(2026, 9, 1)).collect()


def test_q5_python_rounding(spark):
    vals = [2.675, 0.125, 1.005, 2.5, 0.375, 1234.5678, 1e-3, 99.995]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(py_round("v", 2)).collect()]
    assert got == [round(v, 2) for v in vals]


def test_q6_project_is_greatest_non_empty(spark):
    df = spark.createDataFrame([("d", "svc", "cloudrun", "x", "proj-b")], "day string, service_name string, prefix string, label string, project_id string")
    assert one(M.project_attribution(df)).project_id == "proj-b"
    df = df.withColumn("project_id", F.lit(None).cast("string"))
    assert one(M.project_attribution(df)).project_id == "unknown"


def test_q7_zero_latency_stored_null_scores_one(spark):
    m = spark.createDataFrame([(dt.date(2026, 7, 1), "svc", "p", 10, 0, 0, 0.0, 0.0)],
                              "day date, service_name string, project_id string, total_requests long, "
                              "error_5xx_requests long, error_4xx_requests long, latency_p50 double, latency_p95 double")
    r = one(M.raw_metrics_rows(m, "2026-07-02 00:00:00"))
    assert r.latency_p50_ms is None and r.latency_p95_ms is None
    p = one(SC.service_performance_scores(M.raw_metrics_rows(m, "2026-07-02 00:00:00")))
    assert approx(p.performance_score, 100.0)


def test_q8_json_scalar(spark):
    df = spark.createDataFrame([('{"a": {"x": 1}, "b": [1], "c": 5, "d": null}',), ("not json",)], "j string")
    rows = df.select(*[json_scalar(F.get_json_object("j", f"$.{k}")).alias(k) for k in "abcd"]).collect()
    assert tuple(rows[0]) == (None, None, "5", None)
    assert tuple(rows[1]) == (None, None, None, None)


def test_json_string_that_looks_nested(spark):
    df = spark.createDataFrame([('{"a": "[beta]svc", "b": ["x"], "c": "{", "d": {"e": 1}}',), (None,)], "j string")
    got = df.select(*[json_scalar(F.get_json_object("j", f"$.{k}"), "j", f"$.{k}").alias(k) for k in "abcd"]).collect()
    assert tuple(got[0]) == ("[beta]svc", None, "{", None) and tuple(got[1]) == (None,) * 4
    builds = spark.createDataFrame([("s", "m", None, '{"status":"SUCCESS","tags":["[beta]svc"],"buildTriggerId":"t"}', None),
                                    ("s", "m", None, '{"status":"SUCCESS","tags":[["svc"]],"buildTriggerId":"t"}', None)], S.EVENT_ENVELOPE)
    assert [r.service_name for r in E.build_events(builds).collect()] == ["[beta]svc"]


def test_q9_legacy_least_is_null_on_null(spark):
    df = spark.createDataFrame([("a", "sync", 0.99, None, None, 0, 10, 1.0, 1.0),
                                ("b", "sync", 0.99, None, 0.0, 0, 10, 1.0, 1.0),
                                ("c", "sync", 0.99, None, 100.0, 0, 10, 1.0, 1.0)], S.LEGACY_METRICS)
    got = {r.service_name: r.latency_score for r in W.legacy_component_scores(df).collect()}
    assert got == {"a": None, "b": None, "c": 100.0}


def test_q10_missing_pillars_default_differently(spark):
    df = spark.createDataFrame([("a", "batch", 1.0, None, 100.0, 0, 10, None, None)], S.LEGACY_METRICS)
    assert one(W.legacy_final_score(df)).final_service_health_score == 50.0  # 0*.5 + 100*.25 + 100*.25


def test_q11_never_deployed_scores_15(spark):
    perf = _perf(spark, [dict(service_name="s", archetype=a) for a in ("sync", "async", None)])
    for r in SC.pipeline_robustness_scores(perf, events_df(spark, []), AS_OF, EPOCH).collect():
        assert approx(r.pipeline_score, 15.0)


def test_q12_two_availabilities(spark):
    m = spark.createDataFrame([(100, 10, 20)], "total_requests long, error_5xx_requests long, error_4xx_requests long")
    stored = one(M.stored_availability(m)).availability_ratio
    view = one(m.select(SC.availability_ratio().alias("a"))).a
    assert stored == 0.9 and approx(view, 0.7)


def test_q13_only_exact_succeed_becomes_succeeded(spark):
    env = spark.createDataFrame([(None, None, ts(AS_OF), None, f'{{"Action":"{a}","TargetId":"mixer-prod","ResourceType":"Rollout"}}')
                                 for a in ("Succeed", "SUCCEED", "Failed", "Start")], S.EVENT_ENVELOPE)
    got = sorted(r.status for r in E.deploy_events(env).collect())
    assert got == ["FAILED", "SUCCEED", "SUCCEEDED"]


def test_q14_null_target_one_null_service(spark):
    env = spark.createDataFrame([(None, None, ts(AS_OF), None, '{"Action":"Failed","ResourceType":"Rollout"}')],
                                S.EVENT_ENVELOPE)
    r = one(E.expand_targets(E.deploy_events(env)))
    assert r.service_name is None and r.environment == "Unknown"


def test_q15_answers_untrimmed_flag_trimmed(spark):
    s = spark.createDataFrame([("a",) + (" true",) * 10 + ("  Y  ",)], S.SURVEY)
    r = one(SV.observability_scores(s))
    assert r.observability_score == 0.0 and r.feature_flag_score == 100.0


def test_q16_future_events_negative_days(spark):
    perf = _perf(spark, [dict(service_name="s")])
    ev = events_df(spark, [(ts(AS_OF + dt.timedelta(days=10)), "SUCCESS", "s", True)])
    r = one(SC.pipeline_robustness_scores(perf, ev, AS_OF, EPOCH))
    assert r.days_since_last_deploy == -10 and r.total_rollbacks_30d == 1 and r.cadence_score > 0


def test_q17_pipeline_repeats_on_every_date(spark):
    perf = _perf(spark, [dict(service_name="s", target_date=f"2026-07-{d:02d}") for d in (1, 2)])
    ev = events_df(spark, [(ts(AS_OF - dt.timedelta(days=1)), "SUCCESS", "s", False)])
    pipe = SC.pipeline_robustness_scores(perf, ev, AS_OF, EPOCH)
    rows = SC.composite_health_scores(perf, None, pipe).collect()
    assert len(rows) == 2 and len({r.cat2_pipeline_score for r in rows}) == 1


def test_q18_rerun_appends_duplicates(spark, tmp_dir):
    rows = raw_metrics_df(spark, [dict(service_name="s")])
    M.append_raw_metrics(rows, tmp_dir)
    M.append_raw_metrics(rows, tmp_dir)
    assert spark.read.parquet(tmp_dir).count() == 2


def test_q19_classifier_order(spark):
    df = spark.createDataFrame([("product-dev",), ("x-staging-dev",), (C.TARGET_SERVICES["mixer-prod"][0],),
                                (C.TARGET_SERVICES["mixer-staging"][0],), (None,)], "n string")
    assert [r[0] for r in df.select(environment("n")).collect()] == ["Prod", "Staging", "Prod", "Staging", "Unknown"]


def test_q20_legacy_zero_requests_raise(spark):
    df = spark.createDataFrame([("a", "sync", 1.0, None, 100.0, 3, 0, None, None)], S.LEGACY_METRICS)
    with pytest.raises(Exception):
        W.legacy_final_score(df).collect()
    ok = spark.createDataFrame([("a", "sync", 1.0, None, 100.0, 3, None, None, None)], S.LEGACY_METRICS)
    assert one(W.legacy_component_scores(ok)).log_health_score == 0.0  # NULL requests count as 1
