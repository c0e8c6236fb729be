"""Registered queries: one per operator, each over whole test tables.

Every callable takes (spark, sf_dir) and returns a DataFrame whose column names match
the oracle SQL in :mod:`svcvitals.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from svcvitals import config as C, schemas as S
from svcvitals.functions.columns import environment, is_async_like
from svcvitals.functions.sql import register_sql_functions
from svcvitals.operators import cumulative as CU, events as E, histograms as H, history as HI, legacy as W, logs as L, metrics as M, scores as SC, sketches as SK, survey as SV
from svcvitals.plans import catalog as CAT
from svcvitals.plans.health import HealthStack, materialize
from svcvitals.plans.views import register_views
from svcvitals.session import configure, shared_dir
from svcvitals.sources import adapters as A
from svcvitals.sources.commits import DayCommits
from svcvitals.sources.survey_sheet import read_survey, write_survey
from svcvitals.sources.tables import read_deployment_events, read_envelopes, read_raw_metrics, read_routed_logs
from svcvitals.streaming import daily as _daily
from svcvitals.streaming.ingest import (
    stream_deployment_events as _stream_deployment_events, stream_events as _stream_events,
    stream_route_logs as _stream_route_logs,
)

Query = Callable[[SparkSession, str], DataFrame]


def _pts(spark, sf):
    configure(spark)
    return A.metric_points(spark, sf), A.sources(spark)


def _keyed_counts(spark, sf):
    p, s = _pts(spark, sf)
    return M.service_key(M.daily_request_counts(p, s))


def _merged(spark, sf, latency=True, host=False):
    """Merged rows; without ``latency`` the latency side gives its services only."""
    p, s = _pts(spark, sf)
    counts = M.daily_service_counts(p, s)
    return M.merge_counts_latency(M.host_projects(counts) if host else counts,
                                  M.daily_latency_percentiles(p, s, None if latency else {}))


# --------------------------------------------------------------------------- metrics
def q_metric_sources_join(spark, sf):
    p, s = _pts(spark, sf)
    return M.attach_sources(p, s).select("metric_type", "kind", "prefix", "service_label", "label",
                                         "ts", "int64_value", "double_value")


def q_day_slice(spark, sf):
    p, _ = _pts(spark, sf)
    first = A.METRICS_AS_OF - dt.timedelta(days=A.BACKFILL_END_DAYS_AGO)
    last = A.METRICS_AS_OF - dt.timedelta(days=A.BACKFILL_START_DAYS_AGO)
    return M.day_slice(p, first, last).select("metric_type", "ts", "day", "int64_value", "double_value")


def q_daily_request_counts(spark, sf):
    p, s = _pts(spark, sf)
    return M.daily_request_counts(p, s)


def q_service_key(spark, sf):
    return _keyed_counts(spark, sf).select("day", "service_name", "prefix", "label",
                                           "response_code_class", "request_count")


def q_response_class_rollup(spark, sf):
    return M.response_class_rollup(_keyed_counts(spark, sf))


def q_daily_latency_p50(spark, sf):
    p, s = _pts(spark, sf)
    return M.daily_latency_percentile(p, s, 0.5, "latency_p50").select("day", "service_name", "latency_p50")


def q_daily_latency_p95(spark, sf):
    p, s = _pts(spark, sf)
    return M.daily_latency_percentile(p, s, 0.95, "latency_p95").select("day", "service_name", "latency_p95")


def q_daily_latency_p95_bounded(spark, sf):
    """p95 out of a roll-up of several percentiles (one pass for all), with bounded memory
    per task as every exact percentile."""
    p, s = _pts(spark, sf)
    both = M.daily_latency_percentiles(p, s, {"latency_p50": 0.5, "latency_p95": 0.95})
    return both.select("day", "service_name", "latency_p95")


def q_merge_counts_latency(spark, sf):
    return _merged(spark, sf)


def q_project_attribution_label(spark, sf):
    return M.project_attribution(_merged(spark, sf, latency=False)).select("day", "service_name", "project_id")


def q_project_attribution_host(spark, sf):
    return M.project_attribution(_merged(spark, sf, latency=False, host=True)).select("day", "service_name", "project_id")


def q_raw_metrics_rows(spark, sf):
    return M.raw_metrics_rows(M.project_attribution(_merged(spark, sf)), A.INGESTED_AT)


def q_stored_availability(spark, sf):
    return M.stored_availability(_merged(spark, sf, latency=False)).select(
        "day", "service_name", "total_requests", "error_5xx_requests", "availability_ratio")


def q_ingest_day(spark, sf):
    p, s = _pts(spark, sf)
    return M.ingest_day(p, s, A.INGEST_AS_OF, A.INGESTED_AT)


def q_backfill_range(spark, sf):
    configure(spark)
    return A.backfilled_raw_metrics(spark, sf)


def q_backfill_rerun(spark, sf):
    """The backfill written by replacing days, twice, read back over its committed days."""
    configure(spark)
    rows = materialize(A.backfilled_raw_metrics(spark, sf))
    path = shared_dir(spark, "raw-metrics")
    days = [str(A.METRICS_AS_OF - dt.timedelta(days=k)) for k in range(A.BACKFILL_START_DAYS_AGO, A.BACKFILL_END_DAYS_AGO + 1)]
    for _ in range(2):
        M.replace_raw_metrics(rows, path, days)
    return DayCommits(spark, path).read(S.RAW_METRICS)


def q_daily_histogram_percentiles(spark, sf):
    """Distribution-valued latencies: per series and day, then across the series."""
    configure(spark)
    found = H.daily_histogram_percentiles(A.distribution_points(spark, sf), A.sources(spark))
    return found.select("day", "service_name", "latency_p50", "latency_p95")


def q_daily_histogram_merged(spark, sf):
    """The same points, the buckets of a service's series merged first."""
    configure(spark)
    ps = {"latency_p50": 0.5, "latency_p95": 0.95, "latency_p99": 0.99}
    found = H.daily_histogram_percentiles(A.distribution_points(spark, sf), A.sources(spark), ps, across="merged")
    return found.select("day", "service_name", *ps)


def q_weekly_sketch_percentiles(spark, sf):
    """Weekly percentiles out of the stored daily sketches, held against all samples: whether
    each lies within twice the sketch's rank error (the sketches draw at random)."""
    configure(spark)
    points, path = A.metric_points(spark, sf), shared_dir(spark, "sketches")
    SK.write_sketches(SK.daily_sketches(points, A.sources(spark)), path)
    answers = SK.window_percentiles(SK.read_sketches(spark, path))
    week = F.to_date(F.date_trunc("week", "day")).alias("window")
    samples = SK.latency_samples(points, A.sources(spark)).select(week, "service_name", "ms")
    errors = SK.measured_rank_error(answers, samples)
    within = [(F.col(f"{c}_error") <= 2 * SK.rank_error()).alias(f"{c}_within") for c in SK.PERCENTILES]
    return errors.join(answers.select("window", "service_name", F.col("n").alias("n_sketched")), ["window", "service_name"]).select(
        F.col("window").alias("week"), "service_name", "n", "n_sketched", *within)


def q_daily_counter_deltas(spark, sf):
    """Request counts per day out of cumulative counters and intervals."""
    configure(spark)
    return M.daily_request_counts(CU.daily_deltas(A.interval_points(spark, sf)), A.sources(spark))


# --------------------------------------------------------------------------- events
def q_stream_events(spark, sf):
    """Stream both envelope feeds (landed as Parquet files) into their raw tables with
    ``availableNow`` (both streams run concurrently), then read the tables back."""
    configure(spark)
    feeds = (("cloud_builds_raw", A.cloud_builds_raw(spark, sf)), ("cloud_deploy_raw", A.cloud_deploy_raw(spark, sf)))
    running, sinks = [], []
    for name, df in feeds:
        landing, sink, ckpt = (shared_dir(spark, f"{name}-{x}") for x in ("landing", "sink", "ckpt"))
        df.write.mode("overwrite").parquet(landing)
        running.append(_stream_events(spark, landing, sink, ckpt, fmt="parquet"))
        sinks.append((name, sink, df.schema))
    for q in running:
        q.awaitTermination()
    out = [read_envelopes(spark, sink).withColumn("table_name", F.lit(name)) for name, sink, _ in sinks]
    return out[0].unionByName(out[1])


def q_stream_events_once(spark, sf):
    """Both feeds with every message delivered twice, in files that arrive in different
    batches (a batch takes as many files as the first delivery has, oldest first), streamed
    into their tables once: each message's key there."""
    configure(spark)
    running, sinks = [], []
    for name, df in (("cloud_builds_raw", A.cloud_builds_raw(spark, sf)), ("cloud_deploy_raw", A.cloud_deploy_raw(spark, sf))):
        landing, sink, ckpt = (shared_dir(spark, f"{name}-{x}") for x in ("landing", "sink", "ckpt"))
        df.write.parquet(landing)
        files = len(read_envelopes(spark, landing).inputFiles())
        df.write.mode("append").parquet(landing)
        running.append(_stream_events(spark, landing, sink, ckpt, fmt="parquet", max_files_per_trigger=files, redelivered_within="7 days"))
        sinks.append((name, sink))
    for q in running:
        q.awaitTermination()
    out = [read_envelopes(spark, sink).select("subscription_name", "message_id", F.lit(name).alias("table_name")) for name, sink in sinks]
    return out[0].unionByName(out[1])


STREAM_DELAY = "1 day"


def q_stream_raw_metrics(spark, sf):
    """The daily job as a stream over all points, delivered in two halves by time and then
    the first day once more, which is late: the days that are over."""
    p, s = _pts(spark, sf)
    landing, gate, sink, c1, c2 = (shared_dir(spark, f"daily-{x}") for x in ("landing", "gate", "sink", "gate-ckpt", "ckpt"))
    middle = F.lit(A.METRICS_AS_OF - dt.timedelta(days=A.BACKFILL_END_DAYS_AGO // 2)).cast("timestamp")
    first = A.METRICS_AS_OF - dt.timedelta(days=A.BACKFILL_END_DAYS_AGO)
    for part in (p.filter(F.col("ts") < middle), p.filter(F.col("ts") >= middle), M.day_slice(p, first, first).select(p.columns)):
        part.write.mode("append").parquet(landing)
        _daily.stream_gate(spark, landing, gate, c1, STREAM_DELAY).awaitTermination()
        _daily.stream_raw_metrics(spark, gate, sink, c2, s, STREAM_DELAY, A.INGESTED_AT).awaitTermination()
    return read_raw_metrics(spark, sink)


def q_stream_deployment_events(spark, sf):
    """Both envelope feeds streamed through E2-E5 into a table stored by publish day."""
    configure(spark)
    landing = {}
    for name, df in (("builds", A.cloud_builds_raw(spark, sf)), ("deploys", A.cloud_deploy_raw(spark, sf))):
        landing[name] = shared_dir(spark, f"{name}-landing")
        df.write.parquet(landing[name])
    sink, ckpt = shared_dir(spark, "events-sink"), shared_dir(spark, "events-ckpt")
    _stream_deployment_events(spark, landing["builds"], landing["deploys"], sink, ckpt, fmt="parquet").awaitTermination()
    return read_deployment_events(spark, sink)


def q_stream_route_logs(spark, sf):
    """A log feed streamed through the router into a table stored by day."""
    configure(spark)
    landing, sink, ckpt = (shared_dir(spark, f"logs-{x}") for x in ("landing", "sink", "ckpt"))
    A.log_entries(spark, sf).write.parquet(landing)
    _stream_route_logs(spark, landing, sink, ckpt, partition_by_day=True).awaitTermination()
    return read_routed_logs(spark, sink).select(
        "ts", "severity", F.try_element_at(F.col("labels"), F.lit(C.LOG_SERVICE_LABEL)).alias("service_name"))


def q_build_events(spark, sf):
    configure(spark)
    return E.build_events(A.cloud_builds_raw(spark, sf))


def q_deploy_events(spark, sf):
    configure(spark)
    return E.deploy_events(A.cloud_deploy_raw(spark, sf))


def q_expand_targets(spark, sf):
    configure(spark)
    return E.expand_targets(E.deploy_events(A.cloud_deploy_raw(spark, sf)))


def q_deployment_events_raw(spark, sf):
    configure(spark)
    return E.deployment_events_raw(A.cloud_builds_raw(spark, sf), A.cloud_deploy_raw(spark, sf))


def q_environment_classifier(spark, sf):
    """Environment of every service name seen in deployment events or raw metrics, by
    the Column helper and by the registered SQL function."""
    configure(spark)
    register_sql_functions(spark)
    names = (E.deployment_events_raw(A.cloud_builds_raw(spark, sf), A.cloud_deploy_raw(spark, sf))
             .select("service_name")
             .unionByName(A.backfilled_raw_metrics(spark, sf, latency=False).select("service_name"))
             .groupBy("service_name").agg(F.count(F.lit(1)).alias("n_rows")))
    return names.select("service_name", "n_rows", environment("service_name").alias("environment"),
                        F.expr("get_environment(service_name)").alias("environment_sql"))


# --------------------------------------------------------------------------- logs / survey
def q_route_logs(spark, sf):
    configure(spark)
    return L.route_logs(A.log_entries(spark, sf)).select(
        "ts", "severity", F.try_element_at(F.col("labels"), F.lit(C.LOG_SERVICE_LABEL)).alias("service_name"))


def q_error_log_counts(spark, sf):
    configure(spark)
    return L.error_log_counts(L.route_logs(A.log_entries(spark, sf)))


def q_read_survey(spark, sf):
    configure(spark)
    path = shared_dir(spark, "survey-sheet")
    write_survey(A.survey(spark, sf), path)
    return read_survey(spark, path)


def q_observability_scores(spark, sf):
    configure(spark)
    return SV.observability_scores(A.survey(spark, sf))


# --------------------------------------------------------------------------- scores
def _stack(spark, sf, fanout=True, materialized=True, backfilled=None, latency=True) -> HealthStack:
    configure(spark)
    rm = A.raw_metrics(spark, sf, backfilled=backfilled, latency=latency)
    if materialized and backfilled is None:
        rm = materialize(rm)
    return HealthStack(rm, A.cloud_builds_raw(spark, sf), A.cloud_deploy_raw(spark, sf),
                       A.survey(spark, sf), as_of=A.AS_OF, epoch=A.EPOCH, fanout=fanout)


def q_service_performance_scores(spark, sf):
    return _stack(spark, sf, materialized=False).performance()


def q_deployment_base_metrics(spark, sf):
    return _base(spark, sf)


def _base(spark, sf):
    st = _stack(spark, sf, materialized=False, latency=False)
    return SC.deployment_base_metrics(st.performance(), st.deployment_events(), A.AS_OF, A.EPOCH)


def q_rollback_score(spark, sf):
    return _base(spark, sf).select("service_name", "archetype", "total_rollbacks_30d",
                                   SC.rollback_score().alias("rollback_score"))


def q_delivery_success_score(spark, sf):
    return _base(spark, sf).select("service_name", "archetype", "raw_delivery_success",
                                   SC.rollback_score().alias("rollback_score"),
                                   SC.delivery_success_score().alias("delivery_success_score"))


def q_cadence_score(spark, sf):
    return _base(spark, sf).select("service_name", "archetype", "days_since_last_deploy",
                                   "months_deployed_in_window", "valid_months_denominator",
                                   SC.cadence_score().alias("cadence_score"))


def q_async_like_archetypes(spark, sf):
    configure(spark)
    rm = A.raw_metrics(spark, sf, latency=False)
    return (rm.groupBy("archetype").agg(F.count(F.lit(1)).alias("n_rows"))
            .select("archetype", F.coalesce(is_async_like("archetype"), F.lit(False)).alias("async_like"),
                    "n_rows"))


def q_pipeline_robustness_scores(spark, sf):
    return _stack(spark, sf, materialized=False, latency=False).pipeline()


def q_pipeline_robustness_scores_distinct(spark, sf):
    return _stack(spark, sf, fanout=False, materialized=False, latency=False).pipeline()


def q_composite_health_scores(spark, sf):
    return _stack(spark, sf).composite()


def _perf_in_event_time(spark, sf):
    """Performance rows of the backfilled days, moved as a block to the days before AS_OF;
    the delivery events lie there."""
    configure(spark)
    days = (A.METRICS_AS_OF - A.AS_OF).days
    moved = F.date_format(F.date_sub(F.to_date("target_date"), days), "yyyy-MM-dd")
    return SC.service_performance_scores(A.raw_metrics(spark, sf).withColumn("target_date", moved))


def _history_span():
    return (A.AS_OF - dt.timedelta(days=A.BACKFILL_END_DAYS_AGO), A.AS_OF - dt.timedelta(days=A.BACKFILL_START_DAYS_AGO))


def _events(spark, sf):
    return E.deployment_events_raw(A.cloud_builds_raw(spark, sf), A.cloud_deploy_raw(spark, sf))


def q_pipeline_robustness_history(spark, sf):
    """Pipeline robustness of each service on each day, as of that day."""
    return HI.pipeline_robustness_history(_perf_in_event_time(spark, sf), _events(spark, sf), A.EPOCH, *_history_span())


def q_composite_health_history(spark, sf):
    """Composite scores of each day with the pipeline part as of that day."""
    perf = materialize(_perf_in_event_time(spark, sf))
    obs = SV.observability_scores(A.survey(spark, sf))
    return HI.composite_health_history(perf, obs, _events(spark, sf), A.EPOCH, *_history_span())


# --------------------------------------------------------------------------- legacy
def q_legacy_component_scores(spark, sf):
    configure(spark)
    return W.legacy_component_scores(A.legacy_metrics(spark, sf))


def q_legacy_pillar_score(spark, sf):
    configure(spark)
    return W.legacy_pillar_score(W.legacy_component_scores(A.legacy_metrics(spark, sf)))


def q_legacy_final_score(spark, sf):
    configure(spark)
    return W.legacy_final_score(A.legacy_metrics(spark, sf))


# --------------------------------------------------------------------------- views
def _cell(c, kind: str):
    """A cell as a long: what the checksum of a view adds up."""
    if kind == "string":
        return F.conv(F.substring(F.md5(c), 1, 7), 16, 10).cast("long")
    if kind == "timestamp":
        return F.unix_seconds(c)
    if kind == "date":
        return F.unix_date(c).cast("long")
    return c.cast("long") if kind == "boolean" else F.round(c * F.lit(1000)).cast("long")


#: Columns that name one of a few things (services, statuses, subscriptions), however many rows there are.
LABEL_COLUMNS = ("archetype", "environment", "event_category", "service_name", "status", "subscription_name")


def view_checksum(df: DataFrame):
    """Row count and checksum of a view: every cell's code times its column's place by name.
    Rows are counted by their labels first, so that a label is coded once, not for every row."""
    kinds = dict(df.dtypes)
    cells = {c: F.coalesce(_cell(F.col(c), kinds[c]), F.lit(0)) * F.lit(k) for k, c in enumerate(sorted(kinds), start=1)}
    labels = [c for c in LABEL_COLUMNS if kinds.get(c) == "string"]
    added = lambda names: functools.reduce(lambda x, y: x + y, [cells[c] for c in names], F.lit(0).cast("long"))
    counted = df.groupBy(*labels).agg(F.count(F.lit(1)).alias("_n"), F.sum(added(c for c in cells if c not in labels)).alias("_rest"))
    return counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
                       F.coalesce(F.sum(F.coalesce("_rest", F.lit(0)) + F.col("_n") * added(labels)), F.lit(0)).alias("checksum"))


def q_registered_views(spark, sf):
    """Publish the whole view stack, then count and checksum every published view."""
    configure(spark)
    backfilled = materialize(A.backfilled_raw_metrics(spark, sf))  # shared by both inputs
    st = _stack(spark, sf, backfilled=backfilled)
    names = register_views(spark, st, A.legacy_metrics(spark, sf, backfilled=backfilled))
    parts = [view_checksum(spark.table(n)).select(F.lit(n).alias("view_name"), "row_count", "checksum") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fill_catalog(spark, sf, database: str) -> None:
    """The input tables of a catalog database, in the shared folder, with the test data's rows."""
    CAT.create_tables(spark, database, shared_dir(spark, database))
    backfilled = materialize(A.backfilled_raw_metrics(spark, sf))
    rows = {"raw_metrics": A.raw_metrics(spark, sf, backfilled=backfilled), "cloud_builds_raw": A.cloud_builds_raw(spark, sf),
            "cloud_deploy_raw": A.cloud_deploy_raw(spark, sf), "observability_survey_sheet": A.survey(spark, sf),
            "legacy_metrics": A.legacy_metrics(spark, sf, backfilled=backfilled)}
    for name, df in rows.items():
        CAT.append_rows(df, database, name)


def q_catalog_views(spark, sf):
    """The stack as SQL views over stored tables of a catalog database, each counted
    and checksummed."""
    configure(spark)
    database = f"vitals_{uuid.uuid4().hex[:12]}"
    fill_catalog(spark, sf, database)
    views = CAT.create_views(spark, database, A.AS_OF, A.EPOCH)
    names = [n for n in CAT.TABLES if n != "legacy_metrics"] + views
    parts = [view_checksum(spark.table(f"{database}.{n}")).select(F.lit(n).alias("view_name"), "row_count", "checksum") for n in names]
    return functools.reduce(DataFrame.unionByName, parts)


QUERIES: dict[str, Query] = {
    "metric_sources_join": q_metric_sources_join,
    "day_slice": q_day_slice,
    "daily_request_counts": q_daily_request_counts,
    "service_key": q_service_key,
    "response_class_rollup": q_response_class_rollup,
    "daily_latency_p50": q_daily_latency_p50,
    "daily_latency_p95": q_daily_latency_p95,
    "daily_latency_p95_bounded": q_daily_latency_p95_bounded,
    "merge_counts_latency": q_merge_counts_latency,
    "project_attribution_label": q_project_attribution_label,
    "project_attribution_host": q_project_attribution_host,
    "raw_metrics_rows": q_raw_metrics_rows,
    "stored_availability": q_stored_availability,
    "ingest_day": q_ingest_day,
    "backfill_range": q_backfill_range,
    "backfill_rerun": q_backfill_rerun,
    "daily_histogram_percentiles": q_daily_histogram_percentiles,
    "daily_histogram_merged": q_daily_histogram_merged,
    "weekly_sketch_percentiles": q_weekly_sketch_percentiles,
    "daily_counter_deltas": q_daily_counter_deltas,
    "stream_events": q_stream_events,
    "stream_events_once": q_stream_events_once,
    "stream_raw_metrics": q_stream_raw_metrics,
    "stream_deployment_events": q_stream_deployment_events,
    "stream_route_logs": q_stream_route_logs,
    "build_events": q_build_events,
    "deploy_events": q_deploy_events,
    "expand_targets": q_expand_targets,
    "deployment_events_raw": q_deployment_events_raw,
    "environment_classifier": q_environment_classifier,
    "route_logs": q_route_logs,
    "error_log_counts": q_error_log_counts,
    "read_survey": q_read_survey,
    "observability_scores": q_observability_scores,
    "service_performance_scores": q_service_performance_scores,
    "deployment_base_metrics": q_deployment_base_metrics,
    "rollback_score": q_rollback_score,
    "delivery_success_score": q_delivery_success_score,
    "cadence_score": q_cadence_score,
    "async_like_archetypes": q_async_like_archetypes,
    "pipeline_robustness_scores": q_pipeline_robustness_scores,
    "pipeline_robustness_scores_distinct": q_pipeline_robustness_scores_distinct,
    "composite_health_scores": q_composite_health_scores,
    "pipeline_robustness_history": q_pipeline_robustness_history,
    "composite_health_history": q_composite_health_history,
    "legacy_component_scores": q_legacy_component_scores,
    "legacy_pillar_score": q_legacy_pillar_score,
    "legacy_final_score": q_legacy_final_score,
    "registered_views": q_registered_views,
    "catalog_views": q_catalog_views,
}
