"""Property checks (hypothesis); each example is one small DataFrame."""

import datetime as dt

from helpers import events_df, raw_metrics_df, ts
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from naive import deployment_base_metrics_naive
from svcvitals.functions.columns import environment, py_round
from svcvitals.operators import scores as SC

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
AS_OF = dt.date(2026, 8, 1)
EPOCH = dt.date(2026, 3, 1)


@SETTINGS
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=200),
       st.sampled_from([2, 4]))
def test_py_round_matches_python(spark, values, digits):
    # halves, quarters and eighths are exact binary ties
    values = values + [v / 8 for v in range(-40, 40)]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [r[0] for r in df.select(py_round("v", digits)).collect()]
    want = [round(v, digits) + 0.0 for v in values]
    assert [g + 0.0 for g in got] == want


@SETTINGS
@given(st.lists(st.text(alphabet="abcdefghijklmnoprstuvwxyzDEPROGST.-", max_size=20), min_size=1, max_size=50))
def test_environment_total(spark, names):
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "n string")
    got = [r[0] for r in df.select(environment("n")).collect()]
    assert all(g in {"Prod", "Staging", "Autopush", "Dev", "Unknown"} for g in got)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 1000), st.integers(0, 1000),
                          st.one_of(st.none(), st.floats(0, 1e5)), st.one_of(st.none(), st.floats(0, 1e5))),
                min_size=1, max_size=30))
def test_performance_in_range(spark, rows):
    rm = raw_metrics_df(spark, [dict(service_name="s", total_requests=t + a + b, error_5xx_requests=a,
                                     error_4xx_requests=b, latency_p50_ms=p50, latency_p95_ms=p95)
                                for t, a, b, p50, p95 in rows])
    for r in SC.service_performance_scores(rm).collect():
        assert -1e-9 <= r.performance_score <= 100 + 1e-9


_svc = st.sampled_from(["a", "b", "c"])
_event = st.tuples(st.integers(-20, 240), st.sampled_from(["SUCCESS", "SUCCEEDED", "FAILURE", "FAILED", "SUCCEED"]),
                   _svc, st.booleans())


@SETTINGS
@given(st.lists(st.tuples(_svc, st.sampled_from(["sync", "async", None])), min_size=1, max_size=12),
       st.lists(_event, max_size=40), st.booleans())
def test_preaggregated_equals_naive(spark, perf_rows, ev_rows, fanout):
    rm = raw_metrics_df(spark, [dict(service_name=s, archetype=a) for s, a in perf_rows])
    perf = SC.service_performance_scores(rm)
    ev = events_df(spark, [(ts(AS_OF - dt.timedelta(days=d)), s, svc, rb) for d, s, svc, rb in ev_rows])
    fast = SC.deployment_base_metrics(perf, ev, AS_OF, EPOCH, fanout=fanout)
    if fanout:
        naive = deployment_base_metrics_naive(perf, ev, AS_OF, EPOCH)
    else:
        naive = deployment_base_metrics_naive(perf.select("service_name", "archetype").distinct(), ev, AS_OF, EPOCH)
    key = lambda r: (r.service_name, r.archetype or "")
    assert sorted(fast.collect(), key=key) == sorted(naive.collect(), key=key)
    for r in SC.pipeline_scores_from_base(fast).collect():
        assert 0 <= r.delivery_success_score <= 100


_answer = st.one_of(st.none(), st.sampled_from(["TRUE", "true", " TRUE ", "FALSE", "yes", "True", "no", "1", "t", "Y"]))


@SETTINGS
@given(st.lists(st.tuples(*[_answer] * 11), min_size=1, max_size=30))
def test_observability_in_range(spark, rows):
    from svcvitals import schemas as S
    from svcvitals.operators import survey as SV
    df = spark.createDataFrame([(f"s{i}",) + r for i, r in enumerate(rows)], S.SURVEY)
    for r in SV.observability_scores(df).collect():
        assert 0.0 <= r.observability_score <= 125.0
        assert r.feature_flag_score in (0.0, 100.0)
