"""Oracle SQL (DuckDB dialect) for every registered query.

Independent of the Spark code: the adapter rules and every operator are written out
again as plain SQL over the driver's tables (views ``events orders lineitem supplier``
...). Literals are typed DOUBLE explicitly (a bare 0.65 is DECIMAL in DuckDB).
Percentiles are written out as closest-rank linear interpolation with window functions.
"""

from __future__ import annotations

from svcvitals import config as C
from svcvitals.sources import adapters as A


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def D(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def _case(expr: str, values: list) -> str:
    return "CASE " + expr + " " + " ".join(f"WHEN {i} THEN {_lit(v)}" for i, v in enumerate(values)) + " END"


def _in(values) -> str:
    return "(" + ", ".join(_lit(v) for v in values) + ")"


def env_sql(x: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({x}, {_lit(p)}) THEN {_lit(l)}" for p, l in C.ENVIRONMENT_RULES)
    return f"CASE {whens} ELSE {_lit(C.DEFAULT_ENVIRONMENT)} END"


def async_sql(x: str) -> str:
    return f"regexp_matches({x}, {_lit(C.ASYNC_LIKE_PATTERN)})"


def py_round_sql(x: str, digits: int) -> str:
    return f"CAST(format('{{:.{digits}f}}', {x}) AS DOUBLE)"


AS_OF = f"DATE '{A.AS_OF}'"
EPOCH = f"DATE '{A.EPOCH}'"
INGESTED_AT = f"TIMESTAMP '{A.INGESTED_AT}'"
SUCCESS = _in(C.SUCCESS_STATUSES)

# --------------------------------------------------------------------------- adapters
_srcs = C.METRIC_SOURCES
EV = f"""ev AS (
  SELECT CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE user_id % 24 WHEN {A.LATENCY_ONLY[0]} THEN {_lit(A.LATENCY_ONLY[1])} WHEN {A.COUNTS_ONLY[0]} THEN {_lit(A.COUNTS_ONLY[1])}
           ELSE {_case('user_id % 12', A.SERVICE_LABELS)} END AS label,
         {_case('(user_id % 12) % 4', [s[0] for s in _srcs])} AS prefix,
         {_case('(user_id % 12) % 4', [s[1] for s in _srcs])} AS counts_type,
         {_case('(user_id % 12) % 4', [s[2] for s in _srcs])} AS latency_type,
         {_case('(user_id % 12) % 4', [s[3] for s in _srcs])} AS label_key
  FROM events)"""

PTS = f"""pts AS (
  SELECT counts_type AS metric_type, 'counts' AS kind, prefix, label_key AS service_label, label, ts,
         CAST(ts AS DATE) AS day,
         CAST(CASE WHEN event_type = 'error' THEN 1 + k % 10 ELSE 50 * (1 + k % 10) END AS BIGINT) AS int64_value,
         CAST(NULL AS DOUBLE) AS double_value,
         CASE WHEN event_type = 'error' AND k < 50 THEN '5xx' WHEN event_type = 'error' THEN '404'
              WHEN event_type = 'signup' THEN NULL ELSE '2xx' END AS cls,
         'proj-' || CAST(user_id % 3 AS VARCHAR) AS project, user_id
  FROM ev WHERE user_id % 24 <> {A.LATENCY_ONLY[0]}
  UNION ALL
  SELECT latency_type, 'latency', prefix, label_key, label, ts, CAST(ts AS DATE),
         CAST(NULL AS BIGINT),
         CASE WHEN prefix = 'endpoints' THEN (value * {D(14)}) / {D(1000)} ELSE value * {D(14)} END,
         NULL, 'proj-' || CAST(user_id % 3 AS VARCHAR), user_id
  FROM ev WHERE user_id % 24 <> {A.COUNTS_ONLY[0]})"""

KEYED = f"""keyed AS (
  SELECT *, prefix || '--' || label AS service_name FROM pts
  WHERE label IS NOT NULL AND label <> '' AND NOT (prefix = 'endpoints' AND label LIKE '%.googleapis.com'))"""

M3 = """m3 AS (
  SELECT day, prefix, label, cls AS response_code_class, CAST(sum(int64_value) AS BIGINT) AS request_count,
         max(CASE WHEN project <> '' THEN project END) AS project_id
  FROM pts WHERE kind = 'counts' GROUP BY day, prefix, label, cls)"""

COUNTS = """cnt AS (
  SELECT day, service_name, max(prefix) AS prefix, max(label) AS label,
         CAST(coalesce(sum(int64_value), 0) AS BIGINT) AS total_requests,
         CAST(coalesce(sum(CASE WHEN coalesce(cls, '2xx') LIKE '5%' THEN int64_value END), 0) AS BIGINT) AS error_5xx_requests,
         CAST(coalesce(sum(CASE WHEN coalesce(cls, '2xx') NOT LIKE '5%' AND coalesce(cls, '2xx') LIKE '4%'
                                THEN int64_value END), 0) AS BIGINT) AS error_4xx_requests,
         max(CASE WHEN project <> '' THEN project END) AS project_id
  FROM keyed WHERE kind = 'counts' GROUP BY day, service_name)"""


def _interp(src: str, keys: str, val: str, p: float, out: str) -> str:
    """Closest-rank linear interpolation: pos=(n-1)p; lo/hi = floor/ceil(pos);
    (hi-pos)*x[lo] + (pos-lo)*x[hi], or x[lo] when lo=hi or x[lo]=x[hi]."""
    return f"""(
    SELECT {keys}, CASE WHEN hi = lo OR v_lo = v_hi THEN v_lo
                        ELSE (hi - pos) * v_lo + (pos - lo) * v_hi END AS {out}
    FROM (
      SELECT {keys}, pos, lo, hi, max(CASE WHEN rn = lo THEN v END) AS v_lo, max(CASE WHEN rn = hi THEN v END) AS v_hi
      FROM (
        SELECT {keys}, v, rn, (n - 1) * {D(p)} AS pos, CAST(floor((n - 1) * {D(p)}) AS BIGINT) AS lo,
               CAST(ceil((n - 1) * {D(p)}) AS BIGINT) AS hi
        FROM (SELECT {keys}, {val} AS v, row_number() OVER (PARTITION BY {keys} ORDER BY {val}) - 1 AS rn,
                     count(*) OVER (PARTITION BY {keys}) AS n
              FROM {src} WHERE {val} IS NOT NULL))
      GROUP BY {keys}, pos, lo, hi))"""


def _latency(p: float, out: str) -> str:
    series = _interp("keyed_lat", "day, service_name, user_id", "double_value", p, "sv")
    across = _interp(f"{series}", "day, service_name", "sv", p, "v")
    return f"""{out}_t AS (
  SELECT x.day, x.service_name,
         CASE WHEN s.prefix = 'endpoints' THEN x.v * {D(1000)} ELSE x.v END AS {out}
  FROM {across} x JOIN (SELECT DISTINCT day, service_name, prefix FROM keyed_lat) s
    ON x.day = s.day AND x.service_name = s.service_name)"""


KEYED_LAT = "keyed_lat AS (SELECT * FROM keyed WHERE kind = 'latency')"
LAT = ",\n".join([KEYED_LAT, _latency(0.5, "latency_p50"), _latency(0.95, "latency_p95")])

MERGED = f"""lat AS (
  SELECT coalesce(a.day, b.day) AS day, coalesce(a.service_name, b.service_name) AS service_name,
         a.latency_p50, b.latency_p95
  FROM latency_p50_t a FULL OUTER JOIN latency_p95_t b ON a.day = b.day AND a.service_name = b.service_name),
prefixes AS (SELECT DISTINCT day, service_name, prefix, label FROM keyed),
merged AS (
  SELECT coalesce(c.day, l.day) AS day, coalesce(c.service_name, l.service_name) AS service_name,
         CAST(coalesce(c.total_requests, 0) AS BIGINT) AS total_requests,
         CAST(coalesce(c.error_5xx_requests, 0) AS BIGINT) AS error_5xx_requests,
         CAST(coalesce(c.error_4xx_requests, 0) AS BIGINT) AS error_4xx_requests,
         c.project_id, c.service_name IS NOT NULL AS has_counts, l.latency_p50, l.latency_p95
  FROM cnt c FULL OUTER JOIN lat l ON c.day = l.day AND c.service_name = l.service_name),
merged_full AS (
  SELECT m.*, p.prefix, p.label FROM merged m JOIN prefixes p ON m.day = p.day AND m.service_name = p.service_name)"""

# a project is set only where a count point was seen
HOST_PID = ("CASE WHEN NOT has_counts THEN NULL WHEN prefix = 'endpoints' AND contains(label, '.endpoints.') THEN "
            "nullif(split_part(split_part(label, '.endpoints.', 2), '.cloud.goog', 1), '') "
            "ELSE project_id END")


def _raw_rows(src: str, host: bool) -> str:
    pid = f"coalesce({HOST_PID if host else 'project_id'}, 'unknown')"
    avail = (f"CASE WHEN total_requests = 0 THEN {D(1)} ELSE "
             f"{py_round_sql('(total_requests - error_5xx_requests) / total_requests', 4)} END") if host \
        else "CAST(NULL AS DOUBLE)"

    def lat(c):
        return f"CASE WHEN {c} IS NULL OR {c} = 0 THEN CAST(NULL AS DOUBLE) ELSE {py_round_sql(c, 2)} END"
    return f"""
  SELECT {INGESTED_AT} AS timestamp, strftime(day, '%Y-%m-%d') AS target_date, {pid} AS project_id,
         service_name, 'sync' AS archetype, {avail} AS availability_ratio,
         total_requests, error_5xx_requests, error_4xx_requests,
         CAST(error_5xx_requests + error_4xx_requests AS BIGINT) AS total_errors,
         {lat('latency_p50')} AS latency_p50_ms, {lat('latency_p95')} AS latency_p95_ms
  FROM {src}"""


_bf_first = f"DATE '{A.METRICS_AS_OF}' - INTERVAL {A.BACKFILL_END_DAYS_AGO} DAY"
_bf_end = f"DATE '{A.METRICS_AS_OF}' - INTERVAL {A.BACKFILL_START_DAYS_AGO - 1} DAY"
BACKFILL = f"""bf AS ({_raw_rows(f"(SELECT * FROM merged_full WHERE day >= {_bf_first} AND day < {_bf_end})", True)})"""

ROLLUP = ",\n".join([EV, PTS, KEYED, COUNTS, LAT, MERGED])

_odd = "dayofmonth(CAST(target_date AS DATE)) % 2 = 1"
_arch = " ".join(f"WHEN service_name = {_lit(s)} THEN {_lit(a)}" for s, a in A.SCORE_ARCHETYPES.items())
RM = f"""rm AS (
  SELECT * REPLACE (CASE WHEN service_name = {_lit(A.ODD_DAY_ARCHETYPE[0])} AND {_odd} THEN {_lit(A.ODD_DAY_ARCHETYPE[1])}
                         {_arch} ELSE 'sync' END AS archetype)
  FROM bf)"""

# builds / deploys -----------------------------------------------------------
_tag = _case("o_custkey % 8", A.BUILD_TAGS)
_stale = " OR ".join(f"(tag0 = {_lit(t)} AND CAST(o_orderdate AS DATE) >= DATE '{d}')"
                     for t, d in A.BUILD_TAG_LAST_DAY.items())
BR = f"""br0 AS (
  SELECT *, CASE o_orderstatus WHEN 'F' THEN 'FAILURE' WHEN 'O' THEN 'SUCCESS'
              WHEN 'P' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'TIMEOUT' ELSE 'WORKING' END END AS st,
            {_tag} AS tag0
  FROM orders),
br1 AS (
  SELECT *, CASE WHEN o_orderkey % 13 = 0 THEN NULL
                 WHEN o_orderkey % 17 = 0 THEN 'trigger-' || CAST(o_orderkey AS VARCHAR)
                 WHEN o_orderkey % 19 = 0 THEN 'cloud-deploy-r'
                 WHEN {_stale} THEN NULL ELSE tag0 END AS tag,
            CASE WHEN o_orderkey % 11 = 0 THEN 'cloud-deploy-project-' || CAST(o_orderkey AS VARCHAR)
                 ELSE 'build-trigger-' || CAST(o_custkey % 5 AS VARCHAR) END AS trig
  FROM br0),
br AS (
  SELECT 'cloud-builds-bq-sub' AS subscription_name, 'b-' || CAST(o_orderkey AS VARCHAR) AS message_id,
         CAST(o_orderdate AS TIMESTAMP) AS publish_time,
         '{{' || '"status":"' || st || '"' || coalesce(',"tags":["' || tag || '"]', '')
              || ',"buildTriggerId":"' || trig || '"' || '}}' AS data,
         '{{"buildId":"' || CAST(o_orderkey AS VARCHAR) || '"}}' AS attributes
  FROM br1)"""

DR = f"""dr0 AS (
  SELECT *, {_case('l_suppkey % 11', A.DEPLOY_TARGETS)} AS target,
         CASE WHEN l_linestatus = 'F' THEN 'Failed' WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN 'Start'
              WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN 'SUCCEED' ELSE 'Succeed' END AS action,
         CASE WHEN l_returnflag = 'R' AND l_orderkey % 50 = 0 THEN 'rollout-' || CAST(l_orderkey AS VARCHAR) END AS rb,
         CASE WHEN l_linenumber <= 4 THEN 'Rollout' ELSE 'Release' END AS rtype
  FROM lineitem),
dr AS (
  SELECT 'clouddeploy-bq-sub' AS subscription_name,
         'd-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS message_id,
         CAST(l_shipdate AS TIMESTAMP) AS publish_time, CAST(NULL AS VARCHAR) AS data,
         '{{"Action":"' || action || '","ResourceType":"' || rtype || '"'
           || coalesce(',"TargetId":"' || target || '"', '') || coalesce(',"RollbackOfRollout":"' || rb || '"', '')
           || '}}' AS attributes
  FROM dr0)"""

BUILD_EVENTS = f"""be0 AS (
  SELECT publish_time, json_extract_string(data, '$.status') AS status,
         json_extract_string(data, '$.tags[0]') AS tag0, json_extract_string(data, '$.buildTriggerId') AS trig
  FROM br),
be AS (
  SELECT publish_time, status, replace(tag0, '::', '--') AS service_name,
         {env_sql("replace(tag0, '::', '--')")} AS environment, FALSE AS is_rollback,
         CASE WHEN status IN {_in(C.BUILD_FAILURE_STATUSES)} THEN 'Failure' ELSE 'Success' END AS event_category
  FROM be0
  WHERE coalesce(trig, '') NOT LIKE 'cloud-deploy-project-%' AND coalesce(tag0, '') NOT LIKE 'cloud-deploy-%'
    AND coalesce(tag0, '') NOT LIKE 'trigger-%' AND coalesce(tag0, '') <> ''
    AND status IN {_in(C.BUILD_STATUSES_KEPT)})"""

_targets = " ".join(f"WHEN {_lit(t)} THEN [{', '.join(_lit(s) for s in v)}]" for t, v in C.TARGET_SERVICES.items())
DEPLOY_EVENTS = f"""de0 AS (
  SELECT publish_time, json_extract_string(attributes, '$.Action') AS action,
         json_extract_string(attributes, '$.TargetId') AS target_id,
         json_extract_string(attributes, '$.ResourceType') AS rtype,
         json_extract_string(attributes, '$.RollbackOfRollout') AS rb
  FROM dr),
de AS (
  SELECT publish_time, CASE WHEN action = 'Succeed' THEN 'SUCCEEDED' ELSE upper(action) END AS status, target_id,
         rb IS NOT NULL AS is_rollback,
         CASE WHEN rb IS NOT NULL THEN 'Rollback' WHEN upper(action) = 'FAILED' THEN 'Failure' ELSE 'Success' END
           AS event_category
  FROM de0 WHERE rtype = 'Rollout' AND upper(action) IN ('SUCCEED', 'FAILED')),
xt0 AS (
  SELECT publish_time, status, unnest(CASE target_id {_targets} ELSE ['endpoints--' || target_id] END) AS service_name,
         is_rollback, event_category
  FROM de),
xt AS (
  SELECT publish_time, status, service_name, {env_sql('service_name')} AS environment, is_rollback, event_category
  FROM xt0)"""

EVENTS = ",\n".join([BR, DR, BUILD_EVENTS, DEPLOY_EVENTS,
                     "evs AS (SELECT * FROM be UNION ALL SELECT * FROM xt)"])

# logs / survey -----------------------------------------------------------------
_rank = "CASE severity " + " ".join(f"WHEN {_lit(k)} THEN {v}" for k, v in C.SEVERITY_RANKS.items()) + " END"
LOGS = f"""lg0 AS (
  SELECT ts, {_case('k % 6', A.LOG_SEVERITIES)} AS severity, prefix || '--' || label AS key, k FROM ev),
lg AS (
  SELECT ts, severity, CASE WHEN k % 7 <> 0 AND key IS NOT NULL THEN key END AS service_name,
         (k % 7 <> 0 AND key IS NOT NULL) AS has_label FROM lg0),
routed AS (SELECT ts, severity, service_name FROM lg WHERE has_label AND {_rank} >= {C.SEVERITY_RANKS[C.MIN_LOG_SEVERITY]}),
elc AS (
  SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS target_date, service_name, CAST(count(*) AS BIGINT) AS error_log_count
  FROM routed GROUP BY 1, 2)"""


def _answer(j: int) -> str:
    return (f"CASE s_suppkey % 8 WHEN 0 THEN 'TRUE' WHEN 1 THEN NULL "
            f"ELSE {_case(f'(s_suppkey % 8 * 3 + 5 * {j}) % 8', A.SURVEY_ANSWERS)} END")


SURVEY = ("sv AS (SELECT " + f"coalesce({_case('s_suppkey', A.SURVEY_SERVICES)}, '{A.SURVEY_OTHER}' || CAST(s_suppkey AS VARCHAR)) AS service_name, "
          + ", ".join(f"{_answer(j)} AS {c}" for j, c in enumerate(C.SURVEY_ANSWER_COLUMNS, start=1))
          + f", {_case('s_suppkey % 8', A.SURVEY_FLAGS)} AS {C.SURVEY_FLAG_COLUMN} FROM supplier)")

_true_sum = " + ".join(f"CASE WHEN lower({c}) = 'true' THEN 1 ELSE 0 END" for c in C.SURVEY_ANSWER_COLUMNS)
OBS = f"""obs AS (
  SELECT service_name,
         CASE WHEN trim(lower({C.SURVEY_FLAG_COLUMN})) IN {_in(C.FEATURE_FLAG_TRUE)} THEN {D(100)} ELSE {D(0)} END
           AS feature_flag_score,
         ({_true_sum}) / {D(8)} * {D(100)} AS observability_score
  FROM sv)"""

# scores ------------------------------------------------------------------------
PERF = f"""perf0 AS (
  SELECT target_date, service_name, project_id, archetype, {env_sql('service_name')} AS environment,
         coalesce((total_requests - error_5xx_requests - error_4xx_requests) / nullif(total_requests, 0), {D(1)})
           AS availability_ratio,
         latency_p50_ms, latency_p95_ms, total_requests, error_5xx_requests, error_4xx_requests, total_errors,
         {D(500)} AS p50_target_ms, {D(2500)} AS p95_target_ms
  FROM rm),
perf AS (
  SELECT *, (((greatest({D(0)}, {D(1)} - (({D(1)} - availability_ratio) * {D(100)})) * {D(0.65)})
             + (CASE WHEN latency_p50_ms IS NULL THEN {D(1)} WHEN latency_p50_ms < p50_target_ms THEN {D(1)}
                     ELSE p50_target_ms / latency_p50_ms END * {D(0.05)})
             + (CASE WHEN latency_p95_ms IS NULL THEN {D(1)} WHEN latency_p95_ms < p95_target_ms THEN {D(1)}
                     ELSE p95_target_ms / latency_p95_ms END * {D(0.20)})
             + ({D(1)} * {D(0.10)})) * {D(100)}) AS performance_score
  FROM perf0)"""


def base_sql(left: str) -> str:
    ok = f"d.status IN {SUCCESS}"
    return f"""base AS (
  SELECT r.service_name, r.archetype,
         max(CASE WHEN {ok} THEN d.publish_time END) AS last_successful_deployment,
         CAST(count(d.publish_time) AS BIGINT) AS total_deployments_in_window,
         CAST(coalesce(date_diff('day', CAST(max(CASE WHEN {ok} THEN d.publish_time END) AS DATE), {AS_OF}), 999)
              AS BIGINT) AS days_since_last_deploy,
         CAST(count(DISTINCT CASE WHEN {ok} THEN month(d.publish_time) END) AS BIGINT) AS months_deployed_in_window,
         coalesce((CAST(count(CASE WHEN {ok} THEN 1 END) AS DOUBLE) / nullif(CAST(count(d.publish_time) AS DOUBLE), 0)) * {D(100)},
                  {D(0)}) AS raw_delivery_success,
         CAST(count(CASE WHEN d.is_rollback = TRUE AND date_diff('day', CAST(d.publish_time AS DATE), {AS_OF}) <= 30 THEN 1 END)
              AS BIGINT) AS total_rollbacks_30d,
         CAST(least(6, (year({AS_OF}) - year({EPOCH})) * 12 + month({AS_OF}) - month({EPOCH}) + 1) AS BIGINT)
           AS valid_months_denominator
  FROM {left} r LEFT JOIN evs d
    ON r.service_name = d.service_name AND CAST(d.publish_time AS DATE) >= {AS_OF} - INTERVAL 6 MONTH
  GROUP BY r.service_name, r.archetype)"""


_rb = f"CASE WHEN total_rollbacks_30d = 0 THEN {D(100)} WHEN total_rollbacks_30d = 1 THEN {D(50)} ELSE {D(0)} END"
_deliv = f"((raw_delivery_success + {_rb}) / {D(2)})"
_cad = (f"CASE WHEN days_since_last_deploy > 30 THEN {D(0)} "
        f"ELSE (months_deployed_in_window / valid_months_denominator) * {D(100)} END")
PIPE = f"""pipe AS (
  SELECT service_name, archetype, last_successful_deployment, total_deployments_in_window, days_since_last_deploy,
         months_deployed_in_window, raw_delivery_success, total_rollbacks_30d, {_rb} AS rollback_score,
         {_deliv} AS delivery_success_score, {_cad} AS cadence_score,
         {D(0)} AS code_lead_time_score, {D(0)} AS feature_flag_score,
         CASE WHEN {async_sql('archetype')}
              THEN ({_deliv} * {D(0.3)}) + (({_cad}) * {D(0.4)}) + ({D(0)} * {D(0.3)})
              ELSE ({_deliv} * {D(0.3)}) + (({_cad}) * {D(0.3)}) + ({D(0)} * {D(0.3)}) + ({D(0)} * {D(0.1)}) END
           AS pipeline_score
  FROM base)"""
PIPE_COLS = ("service_name, last_successful_deployment, total_deployments_in_window, days_since_last_deploy, "
             "months_deployed_in_window, raw_delivery_success, total_rollbacks_30d, rollback_score, "
             "delivery_success_score, cadence_score, code_lead_time_score, feature_flag_score, pipeline_score")

_cat2 = (f"CASE WHEN {async_sql('r.archetype')} THEN coalesce(p.pipeline_score, {D(0)}) "
         f"ELSE coalesce(p.pipeline_score, {D(0)}) + (coalesce(o.feature_flag_score, {D(0)}) * {D(0.1)}) END")
COMPOSITE = f"""comp AS (
  SELECT r.target_date, r.project_id, r.service_name, r.archetype, r.environment, r.availability_ratio,
         r.latency_p50_ms, r.latency_p95_ms, r.total_requests, r.error_5xx_requests, r.error_4xx_requests,
         r.total_errors, r.p50_target_ms, r.p95_target_ms, r.performance_score AS cat1_performance_score,
         coalesce(o.observability_score, {D(0)}) AS cat3_observability_score,
         {_cat2} AS cat2_pipeline_score,
         coalesce(p.cadence_score, {D(0)}) AS pipeline_cadence_score,
         coalesce(p.delivery_success_score, {D(0)}) AS pipeline_delivery_success_score,
         coalesce(p.code_lead_time_score, {D(0)}) AS pipeline_code_lead_time_score,
         coalesce(o.feature_flag_score, {D(0)}) AS pipeline_feature_flag_score,
         CAST(coalesce(p.total_rollbacks_30d, 0) AS BIGINT) AS total_rollbacks_30d,
         p.days_since_last_deploy, p.months_deployed_in_window, p.last_successful_deployment,
         p.total_deployments_in_window,
         (r.performance_score * {D(0.5)}) + (coalesce(o.observability_score, {D(0)}) * {D(0.25)})
           + (({_cat2}) * {D(0.25)}) AS composite_service_health_score
  FROM perf r LEFT JOIN obs o ON r.service_name = o.service_name
              LEFT JOIN pipe p ON r.service_name = p.service_name)"""

# scores of each day: every grid day joined to the events of its window
_shift = (A.METRICS_AS_OF - A.AS_OF).days
RM_MOVED = f"""rmh AS (
  SELECT * REPLACE (strftime(CAST(target_date AS DATE) - {_shift}, '%Y-%m-%d') AS target_date) FROM rm)"""
PERF_MOVED = PERF.replace("FROM rm)", "FROM rmh)")
_hok = f"d.status IN {SUCCESS}"
_day = "CAST(r.target_date AS DATE)"
BASE_HISTORY = f"""base AS (
  SELECT r.target_date, r.service_name, r.archetype,
         max(CASE WHEN {_hok} THEN d.publish_time END) AS last_successful_deployment,
         CAST(count(d.publish_time) AS BIGINT) AS total_deployments_in_window,
         CAST(coalesce(date_diff('day', CAST(max(CASE WHEN {_hok} THEN d.publish_time END) AS DATE), {_day}), 999)
              AS BIGINT) AS days_since_last_deploy,
         CAST(count(DISTINCT CASE WHEN {_hok} THEN month(d.publish_time) END) AS BIGINT) AS months_deployed_in_window,
         coalesce((CAST(count(CASE WHEN {_hok} THEN 1 END) AS DOUBLE) / nullif(CAST(count(d.publish_time) AS DOUBLE), 0)) * {D(100)},
                  {D(0)}) AS raw_delivery_success,
         CAST(count(CASE WHEN d.is_rollback = TRUE AND date_diff('day', CAST(d.publish_time AS DATE), {_day}) <= 30 THEN 1 END)
              AS BIGINT) AS total_rollbacks_30d,
         CAST(least(6, (year({_day}) - year({EPOCH})) * 12 + month({_day}) - month({EPOCH}) + 1) AS BIGINT)
           AS valid_months_denominator
  FROM (SELECT DISTINCT target_date, service_name, archetype FROM perf) r LEFT JOIN evs d
    ON r.service_name = d.service_name AND CAST(d.publish_time AS DATE) >= {_day} - INTERVAL 6 MONTH
       AND CAST(d.publish_time AS DATE) <= {_day}
  GROUP BY r.target_date, r.service_name, r.archetype)"""
PIPE_HISTORY = PIPE.replace("SELECT service_name, archetype,", "SELECT target_date, service_name, archetype,")
COMPOSITE_HISTORY = COMPOSITE.replace("ON r.service_name = p.service_name)", "ON r.service_name = p.service_name AND r.target_date = p.target_date)")

# legacy ------------------------------------------------------------------------
_dom = "dayofmonth(CAST(b.target_date AS DATE))"
_larch = " ".join(f"WHEN b.service_name = {_lit(s)} THEN {_lit(a)}" for s, a in A.LEGACY_ARCHETYPES.items())
LEGACY_IN = f"""lm AS (
  SELECT b.service_name, CASE {_larch} ELSE 'sync' END AS archetype, b.availability_ratio, b.latency_p50_ms,
         CASE WHEN {_dom} % 5 = 0 THEN CAST(NULL AS DOUBLE) WHEN {_dom} % 5 = 1 THEN {D(0)} ELSE b.latency_p95_ms END
           AS latency_p95_ms,
         CAST(e.error_log_count AS BIGINT) AS error_log_count, nullif(b.total_requests, 0) AS total_requests,
         CASE WHEN {_dom} % 2 = 1 THEN CAST(NULL AS DOUBLE) ELSE {D(40)} + {_dom} END AS pipeline_robustness_score,
         CASE WHEN {_dom} % 2 = 1 THEN CAST(NULL AS DOUBLE) ELSE {D(100)} - {_dom} END AS observability_score
  FROM bf b LEFT JOIN elc e ON b.target_date = e.target_date AND b.service_name = e.service_name)"""
W1 = f"""w0 AS (
  SELECT service_name, archetype, availability_ratio, latency_p50_ms, latency_p95_ms,
         CAST(coalesce(error_log_count, 0) AS BIGINT) AS error_log_count,
         CAST(coalesce(total_requests, 1) AS BIGINT) AS total_requests,
         coalesce(pipeline_robustness_score, {D(100)}) AS pipeline_robustness_score,
         coalesce(observability_score, {D(100)}) AS observability_score
  FROM lm),
w1 AS (
  SELECT service_name, archetype, availability_ratio * 100 AS availability_score,
         CAST(CASE WHEN {D(500)} / nullif(latency_p95_ms, {D(0)}) IS NOT NULL
                   THEN least({D(1)}, {D(500)} / nullif(latency_p95_ms, {D(0)})) END * 100 AS DOUBLE) AS latency_score,
         greatest({D(0)}, {D(100)} - ((error_log_count / total_requests) * {D(1000)})) AS log_health_score,
         pipeline_robustness_score, observability_score
  FROM w0)"""
W2 = f"""w2 AS (
  SELECT service_name, archetype,
         CASE WHEN archetype = 'sync' THEN (availability_score * {D(0.65)}) + (latency_score * {D(0.25)})
                                            + (log_health_score * {D(0.10)})
              WHEN archetype = 'async' THEN (availability_score * {D(0.30)}) + ({D(100)} * {D(0.60)})
                                            + (log_health_score * {D(0.10)})
              ELSE {D(0)} END AS performance_pillar_score,
         pipeline_robustness_score, observability_score
  FROM w1)"""
W3 = f"""w3 AS (
  SELECT *, (performance_pillar_score * {D(0.5)}) + (pipeline_robustness_score * {D(0.25)})
            + (observability_score * {D(0.25)}) AS final_service_health_score
  FROM w2)"""


# distributions: buckets by plain comparisons, bounds written out per layout
_finite = {"explicit": A.HISTOGRAM_BOUNDS, "exponential": [float(2 ** i) for i in range(A.HISTOGRAM_FINITE + 1)],
           "linear": [A.HISTOGRAM_LINEAR[1] * i for i in range(A.HISTOGRAM_LINEAR[0] + 1)]}
_layouts = ", ".join(f"('{k}', {i}, {D(lo)}, {D(hi)}, {int(first)}, {int(last)})" for k, v in _finite.items()
                     for i, (lo, hi, first, last) in enumerate([((0.0 if v[0] > 0 else v[0]), v[0], 1, 0), *((a, b, 0, 0) for a, b in zip(v, v[1:])), (v[-1], v[-1], 0, 1)]))
HIST = f"""hraw AS (
  SELECT CAST(ts AS DATE) AS day, prefix, label, prefix || '--' || label AS service_name, user_id,
         CASE WHEN user_id % 3 = 0 THEN 'explicit' WHEN user_id % 3 = 1 THEN 'exponential' WHEN hour(ts) < 12 THEN 'linear' ELSE 'explicit' END AS kind,
         CASE WHEN prefix = 'endpoints' THEN {D(A.HISTOGRAM_UNIT)} ELSE {D(1)} END AS unit,
         CASE WHEN prefix = 'endpoints' THEN (value * {D(14)}) / {D(1000)} ELSE value * {D(14)} END AS x
  FROM ev WHERE user_id % 24 <> {A.COUNTS_ONLY[0]} AND label IS NOT NULL AND label <> '' AND NOT (prefix = 'endpoints' AND label LIKE '%.googleapis.com')),
lay(kind, i, lo, hi, below, above) AS (VALUES {_layouts}),
hb AS (
  SELECT h.day, h.prefix, h.service_name, h.user_id, l.lo / h.unit AS lo, l.hi / h.unit AS hi
  FROM hraw h JOIN lay l ON l.kind = h.kind AND (below = 1 OR x >= l.lo / h.unit) AND (above = 1 OR x < l.hi / h.unit))"""


def _histogram(keys: str, ps: dict[str, float]) -> str:
    """Percentiles of merged buckets: all bounds cut the axis, masses by share of each bucket."""
    on = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys.split(", "))
    cols = ", ".join(f"min(CASE WHEN upto >= n * {D(p)} AND upto - mass < n * {D(p)} THEN lo + ((n * {D(p)} - (upto - mass)) / mass) * (hi - lo) END) AS {c}" for c, p in ps.items())
    return f"""hm AS (SELECT {keys}, lo, hi, CAST(count(*) AS DOUBLE) AS c FROM hb GROUP BY {keys}, lo, hi),
he AS (SELECT {keys}, lo AS e FROM hm UNION SELECT {keys}, hi FROM hm),
hs AS (SELECT {keys}, e AS lo, lead(e) OVER (PARTITION BY {keys} ORDER BY e) AS hi FROM he UNION ALL SELECT {keys}, e, e FROM he),
hw AS (SELECT {", ".join("s." + k for k in keys.split(", "))}, s.lo, s.hi,
              sum(CASE WHEN s.lo = s.hi THEN CASE WHEN m.lo = s.lo AND m.hi = s.lo THEN m.c ELSE 0 END
                       WHEN m.lo <= s.lo AND m.hi >= s.hi AND m.lo < m.hi THEN m.c * ((s.hi - s.lo) / (m.hi - m.lo)) ELSE 0 END) AS mass
       FROM hs s JOIN hm m ON {on("s", "m")} WHERE s.hi IS NOT NULL GROUP BY ALL),
hc AS (SELECT *, sum(mass) OVER (PARTITION BY {keys} ORDER BY lo, hi) AS upto, sum(mass) OVER (PARTITION BY {keys}) AS n FROM hw WHERE mass > 0),
hq AS (SELECT {keys}, {cols} FROM hc GROUP BY {keys})"""


def _histogram_series() -> str:
    def across(p, out):
        return (f"{out}_t AS (SELECT x.day, x.service_name, CASE WHEN x.prefix = 'endpoints' THEN x.v * {D(1000)} ELSE x.v END AS {out} "
                f"FROM {_interp('hq', 'day, service_name, prefix', out, p, 'v')} x)")
    ps = {"latency_p50": 0.5, "latency_p95": 0.95}
    return ",\n".join([HIST, _histogram("day, service_name, prefix, user_id", ps), *[across(p, c) for c, p in ps.items()]])


# counters: every step by lag, days by a join with a calendar, shares in whole microseconds
COUNTERS = f"""c0 AS (
  SELECT user_id, ts, label, prefix, counts_type, CASE WHEN event_type = 'error' THEN '5xx' ELSE '2xx' END AS cls,
         CAST(sum(CASE WHEN event_type = 'error' THEN 1 + k % 10 ELSE 50 * (1 + k % 10) END) AS BIGINT) AS cnt
  FROM ev WHERE user_id % 24 <> {A.LATENCY_ONLY[0]} GROUP BY ALL),
c1 AS (SELECT *, CAST(floor((date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) - 4) / {A.COUNTER_DAYS}) AS BIGINT) AS wk FROM c0),
c2 AS (SELECT *, CAST(sum(cnt) OVER (PARTITION BY user_id, cls, wk ORDER BY ts) AS BIGINT) AS running,
              CAST(DATE '1970-01-01' + CAST(wk * {A.COUNTER_DAYS} + 4 AS INTEGER) AS TIMESTAMP) AS wk_start FROM c1),
c3 AS (SELECT *, lag(ts) OVER w AS ts0, lag(running) OVER w AS running0, lag(wk) OVER w AS wk0 FROM c2 WINDOW w AS (PARTITION BY user_id, cls ORDER BY ts)),
c4 AS (
  SELECT user_id, label, prefix, cls, CAST(CAST(ts AS DATE) - 3 AS TIMESTAMP) AS a, ts AS b, cnt AS d FROM c3 WHERE user_id % 4 = 3
  UNION ALL
  SELECT user_id, label, prefix, cls, CASE WHEN ts0 IS NULL THEN wk_start WHEN wk <> wk0 THEN greatest(wk_start, ts0) ELSE ts0 END, ts,
         CASE WHEN ts0 IS NULL OR wk <> wk0 THEN running ELSE running - running0 END FROM c3 WHERE user_id % 4 < 2
  UNION ALL
  SELECT user_id, label, prefix, cls, ts0, ts, CASE WHEN running < running0 THEN running ELSE running - running0 END FROM c3 WHERE user_id % 4 = 2 AND ts0 IS NOT NULL),
c5 AS (SELECT *, CAST(epoch_us(a) AS HUGEINT) AS ua, CAST(epoch_us(b) AS HUGEINT) AS ub FROM c4),
cal0 AS (SELECT CAST(unnest(generate_series((SELECT min(a) FROM c4)::DATE::TIMESTAMP, (SELECT max(b) FROM c4), INTERVAL 1 DAY)) AS DATE) AS day),
cal AS (SELECT day, CAST(epoch_us(CAST(day AS TIMESTAMP)) AS HUGEINT) AS u0 FROM cal0),
c6 AS (SELECT c5.*, day, u0 FROM c5 JOIN cal ON u0 + 86400000000 > ua AND (u0 < ub OR (ua = ub AND u0 <= ub))),
c7 AS (
  SELECT day, prefix, label, cls, user_id, CASE WHEN ua = ub THEN d ELSE
         (CASE WHEN u0 + 86400000000 >= ub THEN d ELSE (d * (u0 + 86400000000 - ua)) // (ub - ua) END) - (CASE WHEN u0 <= ua THEN 0 ELSE (d * (u0 - ua)) // (ub - ua) END) END AS part
  FROM c6)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_STACK = (ROLLUP, BACKFILL, RM, EVENTS, SURVEY, OBS, PERF)
_LEGACY = (ROLLUP, BACKFILL, LOGS, LEGACY_IN, W1, W2, W3)
_dslice_end = f"DATE '{A.METRICS_AS_OF}' - INTERVAL {A.BACKFILL_START_DAYS_AGO - 1} DAY"

ORACLE_SQL: dict[str, str] = {
    "metric_sources_join": _with(EV, PTS) +
        "SELECT metric_type, kind, prefix, service_label, label, ts, int64_value, double_value FROM pts",
    "day_slice": _with(EV, PTS) +
        f"SELECT metric_type, ts, day, int64_value, double_value FROM pts WHERE ts >= {_bf_first} AND ts < {_dslice_end}",
    "daily_request_counts": _with(EV, PTS, M3) + "SELECT * FROM m3",
    "service_key": _with(EV, PTS, M3) +
        "SELECT day, prefix || '--' || label AS service_name, prefix, label, response_code_class, request_count "
        "FROM m3 WHERE label IS NOT NULL AND label <> '' AND NOT (prefix = 'endpoints' AND label LIKE '%.googleapis.com')",
    "response_class_rollup": _with(EV, PTS, KEYED, COUNTS) + "SELECT * FROM cnt",
    "daily_latency_p50": _with(EV, PTS, KEYED, LAT) + "SELECT day, service_name, latency_p50 FROM latency_p50_t",
    "daily_latency_p95": _with(EV, PTS, KEYED, LAT) + "SELECT day, service_name, latency_p95 FROM latency_p95_t",
    "daily_latency_p95_bounded": _with(EV, PTS, KEYED, LAT) + "SELECT day, service_name, latency_p95 FROM latency_p95_t",
    "merge_counts_latency": _with(ROLLUP) + "SELECT * EXCLUDE (has_counts) FROM merged_full",
    "project_attribution_label": _with(ROLLUP) +
        "SELECT day, service_name, coalesce(project_id, 'unknown') AS project_id FROM merged_full",
    "project_attribution_host": _with(ROLLUP) +
        f"SELECT day, service_name, coalesce({HOST_PID}, 'unknown') AS project_id FROM merged_full",
    "raw_metrics_rows": _with(ROLLUP) + _raw_rows("merged_full", False),
    "stored_availability": _with(ROLLUP) +
        "SELECT day, service_name, total_requests, error_5xx_requests, "
        f"CASE WHEN total_requests = 0 THEN {D(1)} ELSE "
        f"{py_round_sql('(total_requests - error_5xx_requests) / total_requests', 4)} END AS availability_ratio "
        "FROM merged_full",
    "ingest_day": _with(ROLLUP) + _raw_rows(
        f"(SELECT * FROM merged_full WHERE day = DATE '{A.INGEST_AS_OF}' - INTERVAL 1 DAY)", False),
    "backfill_range": _with(ROLLUP, BACKFILL) + "SELECT * FROM bf",
    "stream_raw_metrics": _with(ROLLUP) + _raw_rows(
        "(SELECT * FROM merged_full WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM pts) - INTERVAL 1 DAY)", False),
    "daily_histogram_percentiles": _with(EV, _histogram_series()) +
        "SELECT a.day, a.service_name, latency_p50, latency_p95 FROM latency_p50_t a JOIN latency_p95_t b ON a.day = b.day AND a.service_name = b.service_name",
    "daily_histogram_merged": _with(EV, HIST, _histogram("day, service_name, prefix", {"latency_p50": 0.5, "latency_p95": 0.95, "latency_p99": 0.99})) +
        "SELECT day, service_name, " + ", ".join(f"CASE WHEN prefix = 'endpoints' THEN {c} * {D(1000)} ELSE {c} END AS {c}" for c in ("latency_p50", "latency_p95", "latency_p99")) + " FROM hq",
    "weekly_sketch_percentiles": _with(EV, PTS, KEYED, KEYED_LAT) +
        "SELECT CAST(date_trunc('week', day) AS DATE) AS week, service_name, CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS n_sketched, "
        "TRUE AS latency_p50_within, TRUE AS latency_p95_within FROM keyed_lat WHERE double_value IS NOT NULL GROUP BY 1, 2",
    "daily_counter_deltas": _with(EV, COUNTERS) +
        "SELECT day, prefix, label, cls AS response_code_class, CAST(sum(part) AS BIGINT) AS request_count, max('proj-' || CAST(user_id % 3 AS VARCHAR)) AS project_id "
        "FROM c7 GROUP BY day, prefix, label, cls",
    "stream_events": _with(BR, DR) +
        "SELECT *, 'cloud_builds_raw' AS table_name FROM br UNION ALL SELECT *, 'cloud_deploy_raw' FROM dr",
    "build_events": _with(BR, BUILD_EVENTS) + "SELECT * FROM be",
    "deploy_events": _with(DR, DEPLOY_EVENTS.split("xt0 AS")[0].rstrip().rstrip(",")) + "SELECT * FROM de",
    "expand_targets": _with(DR, DEPLOY_EVENTS) + "SELECT * FROM xt",
    "deployment_events_raw": _with(EVENTS) + "SELECT * FROM evs",
    "environment_classifier": _with(ROLLUP, BACKFILL, EVENTS) +
        f"SELECT service_name, n_rows, {env_sql('service_name')} AS environment, "
        f"{env_sql('service_name')} AS environment_sql FROM ("
        "SELECT service_name, CAST(count(*) AS BIGINT) AS n_rows FROM "
        "(SELECT service_name FROM evs UNION ALL SELECT service_name FROM bf) GROUP BY service_name)",
    "route_logs": _with(EV, LOGS) + "SELECT ts, severity, service_name FROM routed",
    "error_log_counts": _with(EV, LOGS) + "SELECT * FROM elc",
    "read_survey": _with(SURVEY) + "SELECT * FROM sv",
    "observability_scores": _with(SURVEY, OBS) + "SELECT * FROM obs",
    "service_performance_scores": _with(ROLLUP, BACKFILL, RM, PERF) +
        "SELECT target_date, service_name, project_id, archetype, environment, availability_ratio, latency_p50_ms, "
        "latency_p95_ms, total_requests, error_5xx_requests, error_4xx_requests, total_errors, p50_target_ms, "
        "p95_target_ms, performance_score FROM perf",
    "deployment_base_metrics": _with(*_STACK, base_sql("perf")) + "SELECT * FROM base",
    "rollback_score": _with(*_STACK, base_sql("perf"), PIPE) +
        "SELECT service_name, archetype, total_rollbacks_30d, rollback_score FROM pipe",
    "delivery_success_score": _with(*_STACK, base_sql("perf"), PIPE) +
        "SELECT service_name, archetype, raw_delivery_success, rollback_score, delivery_success_score FROM pipe",
    "cadence_score": _with(*_STACK, base_sql("perf"), PIPE) +
        "SELECT b.service_name, b.archetype, b.days_since_last_deploy, b.months_deployed_in_window, "
        "b.valid_months_denominator, p.cadence_score FROM base b JOIN pipe p "
        "ON b.service_name = p.service_name AND b.archetype IS NOT DISTINCT FROM p.archetype",
    "async_like_archetypes": _with(ROLLUP, BACKFILL, RM) +
        f"SELECT archetype, coalesce({async_sql('archetype')}, FALSE) AS async_like, n_rows FROM "
        "(SELECT archetype, CAST(count(*) AS BIGINT) AS n_rows FROM rm GROUP BY archetype)",
    "pipeline_robustness_scores": _with(*_STACK, base_sql("perf"), PIPE) + f"SELECT {PIPE_COLS} FROM pipe",
    "pipeline_robustness_scores_distinct": _with(
        *_STACK, base_sql("(SELECT DISTINCT service_name, archetype FROM perf)"), PIPE) +
        f"SELECT {PIPE_COLS} FROM pipe",
    "composite_health_scores": _with(*_STACK, base_sql("perf"), PIPE, COMPOSITE) + "SELECT * FROM comp",
    "pipeline_robustness_history": _with(ROLLUP, BACKFILL, RM, RM_MOVED, EVENTS, PERF_MOVED, BASE_HISTORY, PIPE_HISTORY) +
        f"SELECT target_date, archetype, {PIPE_COLS} FROM pipe",
    "composite_health_history": _with(ROLLUP, BACKFILL, RM, RM_MOVED, EVENTS, SURVEY, OBS, PERF_MOVED, BASE_HISTORY, PIPE_HISTORY, COMPOSITE_HISTORY) +
        "SELECT * FROM comp",
    "legacy_component_scores": _with(ROLLUP, BACKFILL, LOGS, LEGACY_IN, W1) + "SELECT * FROM w1",
    "legacy_pillar_score": _with(*_LEGACY) + "SELECT * FROM w2",
    "legacy_final_score": _with(*_LEGACY) + "SELECT * FROM w3",
}
ORACLE_SQL["stream_deployment_events"] = ORACLE_SQL["deployment_events_raw"]
ORACLE_SQL["stream_events_once"] = _with(BR, DR) + (
    "SELECT DISTINCT subscription_name, message_id, 'cloud_builds_raw' AS table_name FROM br "
    "UNION ALL SELECT DISTINCT subscription_name, message_id, 'cloud_deploy_raw' FROM dr")
ORACLE_SQL["backfill_rerun"] = ORACLE_SQL["backfill_range"]
ORACLE_SQL["stream_route_logs"] = ORACLE_SQL["route_logs"]

# Columns of the published views by kind: s string, n number, b boolean, t timestamp, d date.
_METRICS = "timestamp:t target_date:s project_id:s service_name:s archetype:s availability_ratio:n total_requests:n " \
    "error_5xx_requests:n error_4xx_requests:n total_errors:n latency_p50_ms:n latency_p95_ms:n"
VIEW_COLUMNS = {
    "raw_metrics": ("rm", _METRICS),
    "cloud_builds_raw": ("br", "subscription_name:s message_id:s publish_time:t data:s attributes:s"),
    "cloud_deploy_raw": ("dr", "subscription_name:s message_id:s publish_time:t data:s attributes:s"),
    "observability_survey_sheet": ("sv", " ".join(f"{c}:s" for c in C.SURVEY_COLUMNS)),
    "deployment_events_raw": ("evs", "publish_time:t status:s service_name:s environment:s is_rollback:b event_category:s"),
    "service_performance_scores": ("perf",
        "target_date:s service_name:s project_id:s archetype:s environment:s availability_ratio:n "
        "latency_p50_ms:n latency_p95_ms:n total_requests:n error_5xx_requests:n error_4xx_requests:n "
        "total_errors:n p50_target_ms:n p95_target_ms:n performance_score:n"),
    "observability_scores": ("obs",
        "service_name:s feature_flag_score:n observability_score:n"),
    "pipeline_robustness_scores": ("pipe",
        "service_name:s last_successful_deployment:t total_deployments_in_window:n days_since_last_deploy:n "
        "months_deployed_in_window:n raw_delivery_success:n total_rollbacks_30d:n rollback_score:n "
        "delivery_success_score:n cadence_score:n code_lead_time_score:n feature_flag_score:n "
        "pipeline_score:n"),
    "composite_health_scores": ("comp",
        "target_date:s project_id:s service_name:s archetype:s environment:s availability_ratio:n "
        "latency_p50_ms:n latency_p95_ms:n total_requests:n error_5xx_requests:n error_4xx_requests:n "
        "total_errors:n p50_target_ms:n p95_target_ms:n cat1_performance_score:n cat3_observability_score:n "
        "cat2_pipeline_score:n pipeline_cadence_score:n pipeline_delivery_success_score:n "
        "pipeline_code_lead_time_score:n pipeline_feature_flag_score:n total_rollbacks_30d:n "
        "days_since_last_deploy:n months_deployed_in_window:n last_successful_deployment:t "
        "total_deployments_in_window:n composite_service_health_score:n"),
    "final_service_health_scores": ("w3",
        "service_name:s archetype:s performance_pillar_score:n pipeline_robustness_score:n "
        "observability_score:n final_service_health_score:n"),
}


def _cell(column: str) -> str:
    name, kind = column.split(":")
    return {"s": f"CAST('0x' || substr(md5({name}), 1, 7) AS BIGINT)", "n": f"CAST(round({name} * {D(1000)}) AS BIGINT)",
            "b": f"CAST({name} AS BIGINT)", "t": f"CAST(floor(epoch({name})) AS BIGINT)",
            "d": f"CAST(epoch({name}) / 86400 AS BIGINT)"}[kind]


def _checksum(view: str, source: str, columns: str) -> str:
    row = " + ".join(f"coalesce({_cell(c)}, 0) * {k}" for k, c in enumerate(sorted(columns.split(), key=lambda c: c.split(":")[0]), start=1))
    return f"SELECT '{view}' AS view_name, count(*) AS row_count, CAST(coalesce(sum({row}), 0) AS BIGINT) AS checksum FROM {source}"


ORACLE_SQL["registered_views"] = (
    _with(*_STACK, base_sql("perf"), PIPE, COMPOSITE, LOGS, LEGACY_IN, W1, W2, W3) +
    " UNION ALL ".join(_checksum(v, *VIEW_COLUMNS[v]) for v in VIEW_COLUMNS))
ORACLE_SQL["catalog_views"] = ORACLE_SQL["registered_views"]
