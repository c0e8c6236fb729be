"""The scoring stack as logical views of a catalog database, over its stored tables.

``create_tables`` makes the input tables, ``create_views`` the stored SQL functions and the
views. A view holds a query, no rows: any session of the catalog that reads it sees what the
tables hold at that time, without a job in between. Filters and column selection on a view
reach the stored tables as in any other query (a day of ``service_performance_scores`` reads
one ``target_date`` folder).

The views give the rows of :class:`svcvitals.plans.health.HealthStack`; ``as_of`` None means
the day on which a view is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from svcvitals import config as C, schemas as S
from svcvitals.functions.sql import _sql_str as text, register_sql_functions

#: Input tables: name -> (schema, partition columns).
TABLES = {
    "raw_metrics": (S.RAW_METRICS, ["target_date"]),
    "cloud_builds_raw": (S.EVENT_ENVELOPE, []),
    "cloud_deploy_raw": (S.EVENT_ENVELOPE, []),
    "observability_survey_sheet": (S.SURVEY, []),
    "legacy_metrics": (S.LEGACY_METRICS, []),
}


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """The database and its input tables, where they are not there yet. ``location`` is the
    database's folder, default the warehouse."""
    where = f" LOCATION {text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    for name, (schema, parts) in TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet" + (f" PARTITIONED BY ({', '.join(parts)})" if parts else ""))


def append_rows(df: DataFrame, database: str, table: str) -> None:
    """Append rows, by column name, to an input table."""
    schema, _ = TABLES[table]
    if set(df.columns) != {f.name for f in schema}:
        raise ValueError(f"rows do not fit {table}: {df.columns}")
    names = df.sparkSession.table(f"{database}.{table}").columns  # partition columns come last
    df.select(*[df[n].cast(schema[n].dataType).alias(n) for n in names]).write.mode("append").insertInto(f"{database}.{table}")


def _in(values) -> str:
    return "(" + ", ".join(text(v) for v in values) + ")"


def _num(x: float) -> str:
    return f"{float(x)!r}D"


def _scalar(value: str, document: str, path: str) -> str:
    """A JSON value as text where it is a scalar; text that starts like an object or array may
    be a string, which its JSON type decides: in a branch, so that no other row's document
    is parsed again (see :func:`svcvitals.functions.columns.json_scalar`)."""
    kind = f"schema_of_variant(try_variant_get(try_parse_json({document}), {text(path)}, 'variant'))"
    return f"CASE WHEN startswith({value}, '{{') OR startswith({value}, '[') THEN CASE WHEN {kind} = 'STRING' THEN {value} END ELSE {value} END"


def _events(db: str) -> str:
    excluded = "".join(f" AND NOT startswith(tag, {text(p)})" for p in C.BUILD_EXCLUDED_TAG_PREFIXES)
    targets = "map(" + ", ".join(f"{text(k)}, array({', '.join(map(text, v))})" for k, v in C.TARGET_SERVICES.items()) + ")"
    return f"""
WITH builds AS (
  SELECT publish_time, {_scalar('p.status', 'data', '$.status')} AS status, {_scalar('get(p.tags, 0)', 'data', '$.tags[0]')} AS tag,
         {_scalar('p.buildTriggerId', 'data', '$.buildTriggerId')} AS started_by
  FROM {db}.cloud_builds_raw LATERAL VIEW OUTER inline(array(from_json(data, 'status STRING, tags ARRAY<STRING>, buildTriggerId STRING'))) p),
finished AS (
  SELECT publish_time, status, replace(tag, '::', '--') AS service_name FROM builds
  WHERE status IN {_in(C.BUILD_STATUSES_KEPT)} AND tag <> ''{excluded} AND NOT startswith(coalesce(started_by, ''), {text(C.BUILD_EXCLUDED_TRIGGER_PREFIX)})),
operations AS (
  SELECT publish_time, {_scalar('p.action', 'attributes', '$.Action')} AS action, {_scalar('p.target', 'attributes', '$.TargetId')} AS target,
         {_scalar('p.resource', 'attributes', '$.ResourceType')} AS resource, {_scalar('p.undone', 'attributes', '$.RollbackOfRollout')} AS undone
  FROM {db}.cloud_deploy_raw LATERAL VIEW json_tuple(attributes, 'Action', 'TargetId', 'ResourceType', 'RollbackOfRollout') p AS action, target, resource, undone),
rollouts AS (
  SELECT publish_time, CASE WHEN action = {text(C.DEPLOY_SUCCESS_ACTION)} THEN {text(C.DEPLOY_SUCCESS_STATUS)} ELSE upper(action) END AS status, target,
         undone IS NOT NULL AS is_rollback,
         CASE WHEN undone IS NOT NULL THEN 'Rollback' WHEN upper(action) = 'FAILED' THEN 'Failure' ELSE 'Success' END AS event_category
  FROM operations WHERE resource = {text(C.DEPLOY_RESOURCE_TYPE)} AND upper(action) IN {_in(C.DEPLOY_ACTIONS_KEPT)}),
events AS (
  SELECT publish_time, status, service_name, false AS is_rollback,
         CASE WHEN status IN {_in(C.BUILD_FAILURE_STATUSES)} THEN 'Failure' ELSE 'Success' END AS event_category FROM finished
  UNION ALL
  SELECT publish_time, status, s.service_name, is_rollback, event_category
  FROM rollouts LATERAL VIEW explode(coalesce(try_element_at({targets}, target), array(concat({text(C.UNMAPPED_TARGET_PREFIX)}, target)))) s AS service_name)
SELECT publish_time, status, service_name, {db}.get_environment(service_name) AS environment, is_rollback, event_category FROM events"""


def _performance(db: str) -> str:
    def latency(actual: str, target: float) -> str:
        return f"CASE WHEN {actual} IS NULL OR {actual} < {_num(target)} THEN 1.0D ELSE {_num(target)} / {actual} END"
    w = C.PERF_WEIGHTS
    return f"""
WITH base AS (
  SELECT *, coalesce((total_requests - error_5xx_requests - error_4xx_requests) / nullif(total_requests, 0), 1.0D) AS available FROM {db}.raw_metrics)
SELECT target_date, service_name, project_id, archetype, {db}.get_environment(service_name) AS environment, available AS availability_ratio,
       latency_p50_ms, latency_p95_ms, total_requests, error_5xx_requests, error_4xx_requests, total_errors,
       {_num(C.P50_TARGET_MS)} AS p50_target_ms, {_num(C.P95_TARGET_MS)} AS p95_target_ms,
       (greatest(0.0D, 1.0D - ((1.0D - available) * {_num(C.AVAILABILITY_DECAY_SLOPE)})) * {_num(w['availability'])}
        + ({latency('latency_p50_ms', C.P50_TARGET_MS)}) * {_num(w['p50'])} + ({latency('latency_p95_ms', C.P95_TARGET_MS)}) * {_num(w['p95'])}
        + {_num(C.LOG_HEALTH_PLACEHOLDER)} * {_num(w['log_health'])}) * 100.0D AS performance_score
FROM base"""


def _observability(db: str) -> str:
    yes = " + ".join(f"CASE WHEN lower({c}) = 'true' THEN 1 ELSE 0 END" for c in C.SURVEY_ANSWER_COLUMNS)
    return f"""
SELECT service_name, CASE WHEN trim(lower({C.SURVEY_FLAG_COLUMN})) IN {_in(C.FEATURE_FLAG_TRUE)} THEN 100.0D ELSE 0.0D END AS feature_flag_score,
       ({yes}) / {_num(C.OBSERVABILITY_DIVISOR)} * 100.0D AS observability_score
FROM {db}.observability_survey_sheet"""


def _pipeline(db: str, as_of: str, epoch: str, fanout: bool) -> str:
    k = "days" if fanout else "1"
    a, s = C.PIPELINE_WEIGHTS_ASYNC, C.PIPELINE_WEIGHTS_SYNC
    return f"""
WITH services AS (SELECT service_name, archetype, count(*) AS days FROM {db}.service_performance_scores GROUP BY service_name, archetype),
recent AS (
  SELECT *, status IN {_in(C.SUCCESS_STATUSES)} AS ok FROM {db}.deployment_events_raw
  WHERE to_date(publish_time) >= add_months({as_of}, -{C.DEPLOY_WINDOW_MONTHS}) AND service_name IS NOT NULL),
delivered AS (
  SELECT service_name, max(CASE WHEN ok THEN publish_time END) AS last_ok, count(publish_time) AS n, count_if(ok) AS n_ok,
         bit_or(CASE WHEN ok THEN shiftleft(1, month(publish_time)) END) AS months,
         count_if(is_rollback AND datediff({as_of}, to_date(publish_time)) <= {C.ROLLBACK_WINDOW_DAYS}) AS n_rb
  FROM recent GROUP BY service_name),
facts AS (
  SELECT service_name, archetype, last_ok AS last_successful_deployment, CAST(coalesce(n, 0) * {k} AS BIGINT) AS total_deployments_in_window,
         CAST(coalesce(datediff({as_of}, to_date(last_ok)), {C.NEVER_DEPLOYED_DAYS}) AS BIGINT) AS days_since_last_deploy,
         CAST(coalesce(bit_count(months), 0) AS BIGINT) AS months_deployed_in_window,
         coalesce((n_ok * {k}) / nullif(n * {k}, 0) * 100.0D, 0.0D) AS raw_delivery_success, CAST(coalesce(n_rb, 0) * {k} AS BIGINT) AS total_rollbacks_30d,
         least({C.MAX_MONTHS_DENOMINATOR}, (year({as_of}) - year({epoch})) * 12 + month({as_of}) - month({epoch}) + 1) AS valid_months
  FROM services LEFT JOIN delivered USING (service_name)),
scored AS (
  SELECT *, CASE total_rollbacks_30d WHEN 0 THEN 100.0D WHEN 1 THEN 50.0D ELSE 0.0D END AS rollback_score,
         CASE WHEN days_since_last_deploy > {C.STALE_AFTER_DAYS} THEN 0.0D ELSE (months_deployed_in_window / valid_months) * 100.0D END AS cadence_score,
         0.0D AS code_lead_time_score, 0.0D AS feature_flag_score FROM facts),
weighed AS (SELECT *, (raw_delivery_success + rollback_score) / 2.0D AS delivery_success_score FROM scored)
SELECT service_name, last_successful_deployment, total_deployments_in_window, days_since_last_deploy, months_deployed_in_window, raw_delivery_success,
       total_rollbacks_30d, rollback_score, delivery_success_score, cadence_score, code_lead_time_score, feature_flag_score,
       CASE WHEN {db}.is_async_like(archetype)
            THEN delivery_success_score * {_num(a['delivery'])} + cadence_score * {_num(a['cadence'])} + code_lead_time_score * {_num(a['lead_time'])}
            ELSE delivery_success_score * {_num(s['delivery'])} + cadence_score * {_num(s['cadence'])} + code_lead_time_score * {_num(s['lead_time'])}
                 + feature_flag_score * {_num(s['feature_flag'])} END AS pipeline_score
FROM weighed"""


def _composite(db: str) -> str:
    w = C.COMPOSITE_WEIGHTS
    return f"""
WITH joined AS (
  SELECT r.*, coalesce(o.observability_score, 0.0D) AS observed, p.cadence_score, p.delivery_success_score, p.code_lead_time_score, o.feature_flag_score,
         p.total_rollbacks_30d, p.days_since_last_deploy, p.months_deployed_in_window, p.last_successful_deployment, p.total_deployments_in_window,
         CASE WHEN {db}.is_async_like(r.archetype) THEN coalesce(p.pipeline_score, 0.0D)
              ELSE coalesce(p.pipeline_score, 0.0D) + coalesce(o.feature_flag_score, 0.0D) * {_num(C.FEATURE_FLAG_WEIGHT)} END AS delivered
  FROM {db}.service_performance_scores r LEFT JOIN {db}.observability_scores o ON r.service_name = o.service_name
       LEFT JOIN {db}.pipeline_robustness_scores p ON r.service_name = p.service_name)
SELECT target_date, project_id, service_name, archetype, environment, availability_ratio, latency_p50_ms, latency_p95_ms, total_requests,
       error_5xx_requests, error_4xx_requests, total_errors, p50_target_ms, p95_target_ms, performance_score AS cat1_performance_score,
       observed AS cat3_observability_score, delivered AS cat2_pipeline_score, coalesce(cadence_score, 0.0D) AS pipeline_cadence_score,
       coalesce(delivery_success_score, 0.0D) AS pipeline_delivery_success_score, coalesce(code_lead_time_score, 0.0D) AS pipeline_code_lead_time_score,
       coalesce(feature_flag_score, 0.0D) AS pipeline_feature_flag_score, coalesce(total_rollbacks_30d, 0L) AS total_rollbacks_30d,
       days_since_last_deploy, months_deployed_in_window, last_successful_deployment, total_deployments_in_window,
       performance_score * {_num(w['performance'])} + observed * {_num(w['observability'])} + delivered * {_num(w['pipeline'])} AS composite_service_health_score
FROM joined"""


def _legacy(db: str) -> str:
    s, a, w = C.LEGACY_SYNC_WEIGHTS, C.LEGACY_ASYNC_WEIGHTS, C.LEGACY_FINAL_WEIGHTS
    return f"""
WITH components AS (
  SELECT service_name, archetype, availability_ratio * 100 AS available,
         CASE WHEN latency_p95_ms <> 0 THEN least(1.0D, {_num(C.LEGACY_P95_TARGET_MS)} / latency_p95_ms) * 100 END AS fast,
         greatest(0.0D, 100.0D - coalesce(error_log_count, 0) / coalesce(total_requests, 1) * {_num(C.LEGACY_LOG_PENALTY)}) AS quiet,
         coalesce(pipeline_robustness_score, {_num(C.LEGACY_DEFAULT_PILLAR)}) AS pipeline_robustness_score,
         coalesce(observability_score, {_num(C.LEGACY_DEFAULT_PILLAR)}) AS observability_score
  FROM {db}.legacy_metrics),
pillars AS (
  SELECT service_name, archetype,
         CASE archetype WHEN 'sync' THEN available * {_num(s['availability'])} + fast * {_num(s['latency'])} + quiet * {_num(s['log_health'])}
                        WHEN 'async' THEN available * {_num(a['availability'])} + {_num(C.LEGACY_FRESHNESS_PLACEHOLDER)} * {_num(a['freshness'])} + quiet * {_num(a['log_health'])}
                        ELSE 0.0D END AS performance_pillar_score, pipeline_robustness_score, observability_score FROM components)
SELECT *, performance_pillar_score * {_num(w['pillar'])} + pipeline_robustness_score * {_num(w['pipeline'])} + observability_score * {_num(w['observability'])}
         AS final_service_health_score FROM pillars"""


def view_queries(database: str, as_of=None, epoch=C.DEFAULT_EPOCH, fanout: bool = True) -> dict[str, str]:
    """The views' SQL by name, each after those it reads."""
    day = "current_date()" if as_of is None else f"DATE {text(str(as_of))}"
    return {
        "deployment_events_raw": _events(database),
        "service_performance_scores": _performance(database),
        "observability_scores": _observability(database),
        "pipeline_robustness_scores": _pipeline(database, day, f"DATE {text(str(epoch))}", fanout),
        "composite_health_scores": _composite(database),
        "final_service_health_scores": _legacy(database),
    }


def create_views(spark: SparkSession, database: str, as_of=None, epoch=C.DEFAULT_EPOCH, fanout: bool = True) -> list[str]:
    """Create or replace the SQL functions and views of a database that holds the input tables
    (:func:`create_tables`); returns the views' names."""
    register_sql_functions(spark, database)
    queries = view_queries(database, as_of, epoch, fanout)
    for name, sql in queries.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {sql}")
    return list(queries)


__all__ = ["TABLES", "create_tables", "append_rows", "view_queries", "create_views"]
