"""Scores: runtime performance (P), delivery robustness (R), composite (C).

``as_of`` replaces "today": pass a date / 'yyyy-MM-dd' string, or a Column such as
``F.current_date()``. Pass the same value everywhere for reproducible results.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from svcvitals import config as C
from svcvitals.functions.columns import (
    bounded_decay, environment, is_async_like, latency_ratio, month_diff, null_if_zero,
)


def _date(d) -> Column:
    if d is None:
        return F.current_date()
    if isinstance(d, Column):
        return d.cast("date")
    return F.lit(str(d)).cast("date")


# --------------------------------------------------------------------------- P1
def availability_ratio(total="total_requests", e5="error_5xx_requests", e4="error_4xx_requests") -> Column:
    """(total - 5xx - 4xx) / total; 1.0 when there is no traffic or a count is missing."""
    t, a, b = F.col(total), F.col(e5), F.col(e4)
    return F.coalesce((t - a - b) / null_if_zero(t), F.lit(1.0))


# --------------------------------------------------------------------------- P4
PERFORMANCE_COLUMNS = [
    "target_date", "service_name", "project_id", "archetype", "environment", "availability_ratio",
    "latency_p50_ms", "latency_p95_ms", "total_requests", "error_5xx_requests", "error_4xx_requests",
    "total_errors", "p50_target_ms", "p95_target_ms", "performance_score",
]


def performance_score(avail="availability_ratio", p50="latency_p50_ms", p95="latency_p95_ms",
                      p50_target="p50_target_ms", p95_target="p95_target_ms") -> Column:
    w = C.PERF_WEIGHTS
    return (((bounded_decay(avail) * F.lit(w["availability"]))
             + (latency_ratio(p50, p50_target) * F.lit(w["p50"]))
             + (latency_ratio(p95, p95_target) * F.lit(w["p95"]))
             + (F.lit(C.LOG_HEALTH_PLACEHOLDER) * F.lit(w["log_health"])))
            * F.lit(100.0))


def service_performance_scores(raw_metrics: DataFrame) -> DataFrame:
    """One row per raw_metrics row: availability recomputed from counts (the stored
    ratio is not read), environment, targets and the 0..100 performance score."""
    base = raw_metrics.select(
        "target_date", "service_name", "project_id", "archetype",
        environment("service_name").alias("environment"),
        availability_ratio().alias("availability_ratio"),
        "latency_p50_ms", "latency_p95_ms", "total_requests", "error_5xx_requests",
        "error_4xx_requests", "total_errors",
        F.lit(C.P50_TARGET_MS).alias("p50_target_ms"),
        F.lit(C.P95_TARGET_MS).alias("p95_target_ms"))
    return base.withColumn("performance_score", performance_score()).select(*PERFORMANCE_COLUMNS)


# --------------------------------------------------------------------------- R1
BASE_COLUMNS = [
    "service_name", "archetype", "last_successful_deployment", "total_deployments_in_window",
    "days_since_last_deploy", "months_deployed_in_window", "raw_delivery_success",
    "total_rollbacks_30d", "valid_months_denominator",
]


def months_denominator(as_of, epoch) -> Column:
    """min(6, calendar months from epoch to as_of + 1)."""
    return F.least(F.lit(C.MAX_MONTHS_DENOMINATOR),
                   month_diff(_date(as_of), _date(epoch)) + F.lit(1)).cast("long")


def _window_events(events: DataFrame, as_of) -> DataFrame:
    # The date bound reaches the events scan as a pushed filter on publish_time.
    start = F.add_months(_date(as_of), -C.DEPLOY_WINDOW_MONTHS)
    return events.filter(F.to_date("publish_time") >= start)


def _event_aggs(as_of) -> list[Column]:
    ok = F.col("status").isin(C.SUCCESS_STATUSES)
    recent_rb = (F.col("is_rollback") == F.lit(True)) & (
        F.datediff(_date(as_of), F.to_date("publish_time")) <= C.ROLLBACK_WINDOW_DAYS)
    return [
        F.max(F.when(ok, F.col("publish_time"))).alias("_last_ok"),
        F.count("publish_time").alias("_n"),
        F.count_if(ok).alias("_n_ok"),
        # distinct success months as a 12-bit mask: a fixed-width aggregate
        F.bit_or(F.when(ok, F.call_function("shiftleft", F.lit(1), F.month("publish_time")))).alias("_months"),
        F.count_if(recent_rb).alias("_n_rb"),
    ]


def _finish_base(df: DataFrame, as_of, epoch, k: Column, keep: tuple = ()) -> DataFrame:
    n = F.coalesce(F.col("_n"), F.lit(0)) * k
    n_ok = F.coalesce(F.col("_n_ok"), F.lit(0)) * k
    return df.select(
        *keep, "service_name", "archetype",
        F.col("_last_ok").alias("last_successful_deployment"),
        n.cast("long").alias("total_deployments_in_window"),
        F.coalesce(F.datediff(_date(as_of), F.to_date("_last_ok")), F.lit(C.NEVER_DEPLOYED_DAYS))
        .cast("long").alias("days_since_last_deploy"),
        F.coalesce(F.bit_count("_months"), F.lit(0)).cast("long").alias("months_deployed_in_window"),
        F.coalesce((n_ok / F.nullif(n, F.lit(0))) * F.lit(100.0), F.lit(0.0)).alias("raw_delivery_success"),
        (F.coalesce(F.col("_n_rb"), F.lit(0)) * k).cast("long").alias("total_rollbacks_30d"),
        months_denominator(as_of, epoch).alias("valid_months_denominator"))


def deployment_base_metrics(perf: DataFrame, events: DataFrame, as_of=None,
                            epoch=C.DEFAULT_EPOCH, fanout: bool = True) -> DataFrame:
    """Per (service_name, archetype) of ``perf``: delivery facts over the last 6 months.

    Computed without the row fan-out: events are aggregated per service first (partial
    aggregation before the shuffle, so a hot service costs one buffer per map task),
    ``perf`` is reduced to (service, archetype, k = its row count), and the two are
    joined. With ``fanout=True`` (default, as the stacked views compute it) the event
    count and rollback count are multiplied by k, exactly as joining every perf row to
    every event would; max / distinct-month / success-ratio are unaffected by k.
    ``fanout=False`` counts each event once.
    """
    groups = perf.groupBy("service_name", "archetype").agg(F.count(F.lit(1)).alias("_k"))
    ev = (_window_events(events, as_of).filter(F.col("service_name").isNotNull())
          .groupBy("service_name").agg(*_event_aggs(as_of)))
    joined = groups.join(ev, "service_name", "left")
    k = F.col("_k") if fanout else F.lit(1)
    return _finish_base(joined, as_of, epoch, k)


# --------------------------------------------------------------------------- R2..R5
def rollback_score(n="total_rollbacks_30d") -> Column:
    n = F.col(n)
    return F.when(n == 0, F.lit(100.0)).when(n == 1, F.lit(50.0)).otherwise(F.lit(0.0))


def delivery_success_score(raw="raw_delivery_success", n="total_rollbacks_30d") -> Column:
    return (F.col(raw) + rollback_score(n)) / F.lit(2.0)


def cadence_score(days="days_since_last_deploy", months="months_deployed_in_window",
                  denominator="valid_months_denominator") -> Column:
    return F.when(F.col(days) > C.STALE_AFTER_DAYS, F.lit(0.0)).otherwise(
        (F.col(months) / F.col(denominator)) * F.lit(100.0))


def pipeline_score(archetype="archetype", delivery="delivery_success_score", cadence="cadence_score",
                   lead_time="code_lead_time_score", feature_flag="feature_flag_score") -> Column:
    a, s = C.PIPELINE_WEIGHTS_ASYNC, C.PIPELINE_WEIGHTS_SYNC
    d, c, lt, ff = F.col(delivery), F.col(cadence), F.col(lead_time), F.col(feature_flag)
    async_form = (d * F.lit(a["delivery"])) + (c * F.lit(a["cadence"])) + (lt * F.lit(a["lead_time"]))
    sync_form = ((d * F.lit(s["delivery"])) + (c * F.lit(s["cadence"])) + (lt * F.lit(s["lead_time"]))
                 + (ff * F.lit(s["feature_flag"])))
    return F.when(is_async_like(archetype), async_form).otherwise(sync_form)


PIPELINE_COLUMNS = [
    "service_name", "last_successful_deployment", "total_deployments_in_window",
    "days_since_last_deploy", "months_deployed_in_window", "raw_delivery_success",
    "total_rollbacks_30d", "rollback_score", "delivery_success_score", "cadence_score",
    "code_lead_time_score", "feature_flag_score", "pipeline_score",
]


# --------------------------------------------------------------------------- R7
def pipeline_scores_from_base(base: DataFrame, keep_archetype: bool = False, keep: tuple = ()) -> DataFrame:
    out = (base
           .withColumn("rollback_score", rollback_score())
           .withColumn("delivery_success_score", delivery_success_score())
           .withColumn("cadence_score", cadence_score())
           .withColumn("code_lead_time_score", F.lit(0.0))
           .withColumn("feature_flag_score", F.lit(0.0))
           .withColumn("pipeline_score", pipeline_score()))
    cols = [*keep, *PIPELINE_COLUMNS] + (["archetype"] if keep_archetype else [])
    return out.select(*cols)


def pipeline_robustness_scores(perf: DataFrame, events: DataFrame, as_of=None,
                               epoch=C.DEFAULT_EPOCH, fanout: bool = True,
                               keep_archetype: bool = False) -> DataFrame:
    """13 columns per (service, archetype) group; archetype itself is not output
    unless ``keep_archetype``."""
    return pipeline_scores_from_base(
        deployment_base_metrics(perf, events, as_of, epoch, fanout), keep_archetype)


# --------------------------------------------------------------------------- C1 / C2
COMPOSITE_COLUMNS = [
    "target_date", "project_id", "service_name", "archetype", "environment", "availability_ratio",
    "latency_p50_ms", "latency_p95_ms", "total_requests", "error_5xx_requests", "error_4xx_requests",
    "total_errors", "p50_target_ms", "p95_target_ms", "cat1_performance_score",
    "cat3_observability_score", "cat2_pipeline_score", "pipeline_cadence_score",
    "pipeline_delivery_success_score", "pipeline_code_lead_time_score", "pipeline_feature_flag_score",
    "total_rollbacks_30d", "days_since_last_deploy", "months_deployed_in_window",
    "last_successful_deployment", "total_deployments_in_window", "composite_service_health_score",
]


def cat2_pipeline_score(archetype: Column, pipe: Column, flag: Column) -> Column:
    p = F.coalesce(pipe, F.lit(0.0))
    return F.when(is_async_like(archetype), p).otherwise(
        p + (F.coalesce(flag, F.lit(0.0)) * F.lit(C.FEATURE_FLAG_WEIGHT)))


def composite_health_scores(perf: DataFrame, obs: DataFrame | None, pipe: DataFrame, by_day: bool = False) -> DataFrame:
    """perf LEFT JOIN observability LEFT JOIN pipeline, on service_name only; with
    ``by_day``, pipeline rows have a ``target_date`` and join the perf rows of that day.

    Both right sides are per-service summaries (survey rows; service x archetype
    groups); the planner broadcasts them when their measured size is under the
    broadcast threshold and sort-merges otherwise.
    """
    r = perf.alias("r")
    if obs is None:
        obs = perf.sparkSession.createDataFrame(
            [], "service_name string, feature_flag_score double, observability_score double")
    o = obs.select("service_name", "feature_flag_score", "observability_score").alias("o")
    p = pipe.alias("p")
    same = F.col("r.service_name") == F.col("p.service_name")
    if by_day:
        same = same & (F.col("r.target_date") == F.col("p.target_date"))
    j = (r.join(o, F.col("r.service_name") == F.col("o.service_name"), "left").join(p, same, "left"))
    obs_score = F.coalesce(F.col("o.observability_score"), F.lit(0.0))
    cat2 = cat2_pipeline_score(F.col("r.archetype"), F.col("p.pipeline_score"), F.col("o.feature_flag_score"))
    w = C.COMPOSITE_WEIGHTS
    return j.select(
        *[F.col(f"r.{c}") for c in PERFORMANCE_COLUMNS[:1]],
        F.col("r.project_id"), F.col("r.service_name"), F.col("r.archetype"), F.col("r.environment"),
        *[F.col(f"r.{c}") for c in ["availability_ratio", "latency_p50_ms", "latency_p95_ms",
                                    "total_requests", "error_5xx_requests", "error_4xx_requests",
                                    "total_errors", "p50_target_ms", "p95_target_ms"]],
        F.col("r.performance_score").alias("cat1_performance_score"),
        obs_score.alias("cat3_observability_score"),
        cat2.alias("cat2_pipeline_score"),
        F.coalesce(F.col("p.cadence_score"), F.lit(0.0)).alias("pipeline_cadence_score"),
        F.coalesce(F.col("p.delivery_success_score"), F.lit(0.0)).alias("pipeline_delivery_success_score"),
        F.coalesce(F.col("p.code_lead_time_score"), F.lit(0.0)).alias("pipeline_code_lead_time_score"),
        F.coalesce(F.col("o.feature_flag_score"), F.lit(0.0)).alias("pipeline_feature_flag_score"),
        F.coalesce(F.col("p.total_rollbacks_30d"), F.lit(0)).cast("long").alias("total_rollbacks_30d"),
        F.col("p.days_since_last_deploy"), F.col("p.months_deployed_in_window"),
        F.col("p.last_successful_deployment"), F.col("p.total_deployments_in_window"),
        ((F.col("r.performance_score") * F.lit(w["performance"]))
         + (obs_score * F.lit(w["observability"]))
         + (cat2 * F.lit(w["pipeline"]))).alias("composite_service_health_score"),
    )
