"""Scores as of each day: the per-day loop over the stacked views' operators."""

import datetime as dt
import random

from helpers import events_df, raw_metrics_df, ts

from svcvitals.operators import history as HI, scores as SC

EPOCH = dt.date(2026, 1, 1)
STATUSES = ["SUCCESS", "SUCCEEDED", "FAILURE", "FAILED"]


def _tables(spark):
    rnd = random.Random(5)
    first = dt.date(2026, 2, 10)
    days = [dt.date(2026, 8, 29) + dt.timedelta(days=k) for k in range(4)] + [dt.date(2026, 3, 1), dt.date(2026, 2, 28)]
    events = [(ts(first + dt.timedelta(days=rnd.randrange(220)), rnd.randrange(24)), rnd.choice(STATUSES), f"s-{rnd.randrange(3)}", rnd.random() < 0.2)
              for _ in range(400)]
    # on and around the window's edges, twice, after every day, without a service or a time
    events += [(ts(dt.date(2026, 2, d)), "SUCCESS", "edge", True) for d in (27, 28, 28)]
    events += [(ts(dt.date(2026, 7, d)), "FAILURE", "edge", True) for d in (29, 30, 31)]
    events += [(ts(dt.date(2027, 1, 1)), "SUCCESS", "s-0", True), (ts(first), "SUCCESS", None, True), (None, "SUCCESS", "s-1", True)]
    perf = [{"service_name": s, "target_date": str(d), "archetype": a, "total_requests": 10, "error_5xx_requests": 1, "error_4xx_requests": 0}
            for d in days for s, a in (("s-0", "sync"), ("s-1", "async"), ("s-1", "sync"), ("s-1", "sync"), ("s-2", None), ("edge", "sync"), ("none", "sync"))]
    return days, events_df(spark, events), SC.service_performance_scores(raw_metrics_df(spark, perf))


def _rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def test_history_equals_a_loop_over_the_days(spark):
    days, events, perf = _tables(spark)
    events, perf = events.cache(), perf.cache()
    pipes, composites = [], []
    for day in days:
        on_day = perf.filter(perf.target_date == str(day))
        known = events.filter(f"to_date(publish_time) <= date'{day}'")
        pipe = SC.pipeline_robustness_scores(on_day, known, str(day), EPOCH, fanout=False, keep_archetype=True)
        pipes += _rows(pipe.selectExpr("*", f"'{day}' AS target_date"))
        composites += _rows(SC.composite_health_scores(on_day, None, pipe))
    for span in ((), (min(days), max(days))):
        got = HI.pipeline_robustness_history(perf, events, EPOCH, *span)
        assert _rows(got) == sorted(pipes, key=repr)
    assert _rows(HI.composite_health_history(perf, None, events, EPOCH)) == sorted(composites, key=repr)
    assert len({p for p in pipes}) > len(days) * 4


def test_no_event_is_joined_to_a_day(spark):
    _, events, perf = _tables(spark)
    plan = spark._jvm.PythonSQLUtils.explainString(HI.pipeline_robustness_history(perf, events, EPOCH)._jdf.queryExecution(), "simple")
    assert plan.count("Join") == 1 and plan.count("Window ") == 1  # the one join brings a grid row its own facts


def test_empty_tables(spark):
    _, events, perf = _tables(spark)
    nothing = HI.pipeline_robustness_history(perf, events.limit(0), EPOCH)
    assert nothing.filter("total_deployments_in_window > 0 OR last_successful_deployment IS NOT NULL").count() == 0 < nothing.count()
    assert HI.pipeline_robustness_history(perf.limit(0), events, EPOCH).count() == 0
