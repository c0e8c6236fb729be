"""Deterministic adapters: the driver's test tables -> the inputs this library reads.

The test data has no metric points, event envelopes, survey or logs, so they are
derived from ``events`` / ``orders`` / ``lineitem`` / ``supplier`` by fixed rules
(documented in FIXTURES.md). The DuckDB oracle repeats the same rules in SQL.
Every adapter is a Spark projection over the whole table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from svcvitals import config as C, schemas as S
from svcvitals.operators import logs as L, metrics as M

# ---------------------------------------------------------------------------
# FIXED VALUES: adapter parameters.
# ---------------------------------------------------------------------------
AS_OF = dt.date(2001, 8, 1)             # "today" for the delivery scores
EPOCH = dt.date(2001, 3, 1)             # month-denominator epoch (denominator 6)
METRICS_AS_OF = dt.date(2024, 2, 1)     # backfill reference day
BACKFILL_START_DAYS_AGO = 1
BACKFILL_END_DAYS_AGO = 31              # 2024-01-01 .. 2024-01-31
INGEST_AS_OF = dt.date(2024, 1, 16)     # daily job: ingests 2024-01-15
INGESTED_AT = "2024-02-01 01:00:00"

# Two endpoint services of the target map, one with a project in its host and one without.
HOST_SERVICE = C.TARGET_SERVICES["website-dev"][0]
API_SERVICE = C.TARGET_SERVICES["mixer-prod"][0]
# Service label by i = user_id % 12 (None = label missing); source by i % 4.
SERVICE_LABELS = [
    "web-prod", "lb-staging", HOST_SERVICE.removeprefix("endpoints--"),
    "proxy-autopush", "batch-dev", "", "logging.googleapis.com", "autorater", "job-x",
    "LB-PROD", API_SERVICE.removeprefix("endpoints--"), None,
]
# Services seen on one side only, by user_id % 24: latencies without requests (an endpoint
# service with a project in its host), and requests without latencies.
LATENCY_ONLY = (14, "lat-only.endpoints.proj-x.cloud.goog")
COUNTS_ONLY = (12, "counts-only")
# Build tag by o_custkey % 8.
BUILD_TAGS = [
    "cloudrun::web-prod", "gke-lb::lb-staging", "apigee::proxy-autopush", "cloudrun::batch-dev",
    "apigee::autorater", "cloudrun::job-x", "gke-lb::LB-PROD", "cloudrun::no-metrics",
]
# Builds of these tags stop on these dates (staleness).
BUILD_TAG_LAST_DAY = {"cloudrun::job-x": "2001-06-15", "apigee::autorater": "2001-02-01"}
# Deploy target by l_suppkey % 11 (None = TargetId missing).
DEPLOY_TARGETS = list(C.TARGET_SERVICES) + ["custom-x", None]
# Survey service by s_suppkey 0..7; further suppliers are services of their own name.
SURVEY_SERVICES = [
    "cloudrun--web-prod", "gke-lb--lb-staging", HOST_SERVICE, "apigee--proxy-autopush",
    "cloudrun--batch-dev", "apigee--autorater", "gke-lb--LB-PROD", API_SERVICE,
]
SURVEY_OTHER = "supplier--"
# Answers and flags by s_suppkey % 8; one answer is a cell of two lines.
SURVEY_ANSWERS = ["TRUE", "true", " TRUE ", "FALSE", "see\nrunbook", None, "True", "no"]
SURVEY_FLAGS = ["  Yes ", "TRUE", "t", "no", None, "1", "Y", "maybe"]
LOG_SEVERITIES = ["DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL", None]
SCORE_ARCHETYPES = {"apigee--proxy-autopush": "async", "cloudrun--batch-dev": "Data-Pipeline",
                    "cloudrun--job-x": None}
ODD_DAY_ARCHETYPE = ("gke-lb--lb-staging", "cron")
LEGACY_ARCHETYPES = {"apigee--proxy-autopush": "async", "cloudrun--batch-dev": "batch"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: list, idx: Column, cast: str = "string") -> Column:
    """values[idx] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v).cast(cast) for v in values]), idx.cast("int") + 1)


def _json_str(key: str, v: Column, first: bool = False) -> Column:
    """``"key":"v"`` (with a leading comma unless first); NULL when v is NULL."""
    return F.concat(F.lit(("" if first else ",") + f'"{key}":"'), v, F.lit('"'))


# ---------------------------------------------------------------------------
def _event_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    i = (F.col("user_id") % 12).cast("int")
    src = i % 4
    srcs = C.METRIC_SOURCES
    return e.select(
        F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.when(F.col("user_id") % 24 == LATENCY_ONLY[0], F.lit(LATENCY_ONLY[1]))
        .when(F.col("user_id") % 24 == COUNTS_ONLY[0], F.lit(COUNTS_ONLY[1]))
        .otherwise(_pick(SERVICE_LABELS, i)).alias("label"),
        _pick([s[0] for s in srcs], src).alias("prefix"),
        _pick([s[1] for s in srcs], src).alias("counts_type"),
        _pick([s[2] for s in srcs], src).alias("latency_type"),
        _pick([s[3] for s in srcs], src).alias("label_key"))


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two points per event: a request-count delta and a latency sample; one point for the
    services that are seen on one side only."""
    b = _event_base(spark, sf_dir)
    k10 = (F.col("k") % 10) + 1
    is_err = F.col("event_type") == "error"
    count = F.when(is_err, k10).otherwise(k10 * 50).cast("long")
    cls = (F.when(is_err & (F.col("k") < 50), F.lit("5xx")).when(is_err, F.lit("404"))
           .when(F.col("event_type") == "signup", F.lit(None).cast("string")).otherwise(F.lit("2xx")))
    empty = F.create_map().cast(S.LABELS)
    project = F.concat(F.lit("proj-"), (F.col("user_id") % 3).cast("string"))
    count_labels = F.create_map(F.col("label_key"), F.col("label"), F.lit("project_id"), project)
    lat_labels = F.create_map(F.col("label_key"), F.col("label"), F.lit("project_id"), project,
                              F.lit("instance_id"), F.col("user_id").cast("string"))
    lat = F.col("value") * F.lit(14.0)
    lat = F.when(F.col("prefix") == C.ENDPOINTS_PREFIX, lat / F.lit(1000.0)).otherwise(lat)
    point_t = "struct<metric_type:string, resource_labels:map<string,string>, metric_labels:map<string,string>, int64_value:bigint, double_value:double>"
    counts_pt = F.struct(F.col("counts_type").alias("metric_type"), count_labels.alias("resource_labels"),
                         F.when(cls.isNull(), empty).otherwise(F.create_map(F.lit("response_code_class"), cls))
                         .alias("metric_labels"),
                         count.alias("int64_value"), F.lit(None).cast("double").alias("double_value")).cast(point_t)
    lat_pt = F.struct(F.col("latency_type").alias("metric_type"), lat_labels.alias("resource_labels"),
                      empty.alias("metric_labels"), F.lit(None).cast("long").alias("int64_value"),
                      lat.alias("double_value")).cast(point_t)
    side = F.col("user_id") % 24
    points = (F.when(side == LATENCY_ONLY[0], F.array(lat_pt)).when(side == COUNTS_ONLY[0], F.array(counts_pt))
              .otherwise(F.array(counts_pt, lat_pt)))
    return (b.select("ts", F.inline(points))
            .select("metric_type", "resource_labels", "metric_labels", "ts", "int64_value", "double_value"))


# Bucket layouts of the distribution points, in the unit of a sample that is not scaled; all
# widths are powers of two, so that shares of buckets are exact.
HISTOGRAM_BOUNDS = [8.0, 16.0, 32.0, 64.0, 96.0, 128.0, 192.0, 256.0, 384.0, 512.0, 768.0, 1024.0, 1536.0, 2048.0]
HISTOGRAM_FINITE = 12                  # bounds 1, 2, 4, ..., 4096
HISTOGRAM_LINEAR = (16, 64.0)          # bounds 0, 64, ..., 1024
HISTOGRAM_UNIT = 1024.0                # divides bounds of sources measured in seconds


def distribution_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One distribution point per user (a series) and six hours: its latencies in buckets. The
    layout is explicit for user_id % 3 = 0, exponential for 1; for 2 it changes over the day
    (linear in the morning half, explicit in the other)."""
    b = _event_base(spark, sf_dir)
    seconds = F.col("prefix") == C.ENDPOINTS_PREFIX
    unit = F.when(seconds, F.lit(HISTOGRAM_UNIT)).otherwise(F.lit(1.0))
    sample = F.col("value") * F.lit(14.0)
    sample = F.when(seconds, sample / F.lit(1000.0)).otherwise(sample)
    slot = F.floor(F.hour("ts") / 6)
    kind = (F.when(F.col("user_id") % 3 == 0, F.lit("explicit")).when(F.col("user_id") % 3 == 1, F.lit("exponential"))
            .when(slot < 2, F.lit("linear")).otherwise(F.lit("explicit")))
    n, width = HISTOGRAM_LINEAR
    finite = {"explicit": HISTOGRAM_BOUNDS, "exponential": [float(1 << i) for i in range(HISTOGRAM_FINITE + 1)], "linear": [width * i for i in range(n + 1)]}
    bounds = {k: F.transform(F.array(*[F.lit(x) for x in v]), lambda x: x / unit) for k, v in finite.items()}
    own = F.when(kind == "explicit", bounds["explicit"]).when(kind == "exponential", bounds["exponential"]).otherwise(bounds["linear"])
    bucket = F.size(F.filter(own, lambda x: x <= sample))
    base = (b.filter(F.col("user_id") % 24 != COUNTS_ONLY[0])
            .select("ts", "user_id", "label", "label_key", "prefix", "latency_type", kind.alias("kind"), unit.alias("unit"), slot.alias("slot"), bucket.alias("bucket")))
    counted = (base.groupBy("user_id", F.to_date("ts").alias("d"), "slot", "label", "label_key", "prefix", "latency_type", "kind", "unit")
               .agg(*[F.count_if(F.col("bucket") == i).alias(f"b{i}") for i in range(n + 2)]))
    labels = F.create_map(F.col("label_key"), F.col("label"), F.lit("project_id"), F.concat(F.lit("proj-"), (F.col("user_id") % 3).cast("string")),
                          F.lit("instance_id"), F.col("user_id").cast("string"))
    expo, lin = F.col("kind") == "exponential", F.col("kind") == "linear"
    layout = F.struct(
        F.col("kind").alias("kind"),
        F.when(F.col("kind") == "explicit", F.transform(F.array(*[F.lit(x) for x in HISTOGRAM_BOUNDS]), lambda x: x / F.col("unit"))).alias("bounds"),
        F.when(expo, F.lit(HISTOGRAM_FINITE)).when(lin, F.lit(n)).alias("num_finite_buckets"),
        F.when(expo, F.lit(1.0) / F.col("unit")).alias("scale"), F.when(expo, F.lit(2.0)).alias("growth_factor"),
        F.when(lin, F.lit(0.0)).alias("offset"), F.when(lin, F.lit(width) / F.col("unit")).alias("width"))
    size = {k: len(v) + 1 for k, v in finite.items()}
    counts = F.slice(F.array(*[F.col(f"b{i}") for i in range(n + 2)]), 1, F.when(expo, size["exponential"]).when(lin, size["linear"]).otherwise(size["explicit"]))
    return counted.select(
        F.col("latency_type").alias("metric_type"), labels.alias("resource_labels"), F.create_map().cast(S.LABELS).alias("metric_labels"),
        (F.col("d").cast("timestamp") + F.make_dt_interval(hours=F.col("slot").cast("int") * 6 + 5)).alias("ts"),
        layout.alias("layout"), counts.alias("bucket_counts"))


COUNTER_DAYS = 7  # days from one restart of a counter to the next


def interval_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One counter per user and response class, restarted every week. For user_id % 4 = 3 the
    points are deltas since midnight three days before instead; for user_id % 4 = 2 restarts are
    not told (no start), so they show by smaller values only."""
    from pyspark.sql import Window
    b = _event_base(spark, sf_dir).filter(F.col("user_id") % 24 != LATENCY_ONLY[0])
    k10 = (F.col("k") % 10) + 1
    count = F.when(F.col("event_type") == "error", k10).otherwise(k10 * 50).cast("long")
    cls = F.when(F.col("event_type") == "error", F.lit("5xx")).otherwise(F.lit("2xx"))
    once = b.groupBy("user_id", "ts", "label", "label_key", "counts_type", cls.alias("cls")).agg(F.sum(count).alias("count"))
    week = F.floor((F.unix_date(F.to_date("ts")) - F.lit(4)) / COUNTER_DAYS)
    running = Window.partitionBy("user_id", "cls", "week").orderBy("ts")
    rows = once.withColumn("week", week).withColumn("running", F.sum("count").over(running))
    delta, blind = F.col("user_id") % 4 == 3, F.col("user_id") % 4 == 2
    start = F.date_from_unix_date((F.col("week") * COUNTER_DAYS + 4).cast("int")).cast("timestamp")
    return rows.select(
        F.col("counts_type").alias("metric_type"),
        F.create_map(F.col("label_key"), F.col("label"), F.lit("project_id"), F.concat(F.lit("proj-"), (F.col("user_id") % 3).cast("string")),
                     F.lit("instance_id"), F.col("user_id").cast("string")).alias("resource_labels"),
        F.create_map(F.lit("response_code_class"), F.col("cls")).alias("metric_labels"),
        F.when(delta, F.lit("delta")).otherwise(F.lit("cumulative")).alias("value_kind"),
        F.when(delta, F.date_sub(F.to_date("ts"), 3).cast("timestamp")).when(blind, F.lit(None).cast("timestamp")).otherwise(start).alias("start_ts"),
        "ts", F.when(delta, F.col("count")).otherwise(F.col("running")).alias("int64_value"))


def log_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log entry per event: severity by k % 6; service label unless k % 7 = 0."""
    b = _event_base(spark, sf_dir)
    key = F.concat(F.col("prefix"), F.lit("--"), F.col("label"))
    has = ((F.col("k") % 7) != 0) & key.isNotNull()
    labels = F.when(has, F.create_map(F.lit(C.LOG_SERVICE_LABEL), key)).otherwise(F.create_map().cast(S.LABELS))
    return b.select("ts", _pick(LOG_SEVERITIES, F.col("k") % 6).alias("severity"), labels.alias("labels"))


def cloud_builds_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    status = (F.when(st == "F", F.lit("FAILURE")).when(st == "O", F.lit("SUCCESS"))
              .when(st == "P", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("TIMEOUT"))
                    .otherwise(F.lit("WORKING"))))
    tag = _pick(BUILD_TAGS, F.col("o_custkey") % 8)
    day = F.to_date("o_orderdate")
    stale = F.lit(False)
    for t, last in BUILD_TAG_LAST_DAY.items():
        stale = stale | ((tag == t) & (day >= F.lit(last).cast("date")))
    tag = (F.when(key % 13 == 0, F.lit(None).cast("string"))
           .when(key % 17 == 0, F.concat(F.lit("trigger-"), key.cast("string")))
           .when(key % 19 == 0, F.lit("cloud-deploy-r"))
           .when(stale, F.lit(None).cast("string"))
           .otherwise(tag))
    trigger = F.when(key % 11 == 0, F.concat(F.lit("cloud-deploy-project-"), key.cast("string"))).otherwise(
        F.concat(F.lit("build-trigger-"), (F.col("o_custkey") % 5).cast("string")))
    data = F.concat(F.lit("{"), _json_str("status", status, first=True),
                    F.coalesce(F.concat(F.lit(',"tags":["'), tag, F.lit('"]')), F.lit("")),
                    _json_str("buildTriggerId", trigger), F.lit("}"))
    return o.select(F.lit("cloud-builds-bq-sub").alias("subscription_name"),
                    F.concat(F.lit("b-"), key.cast("string")).alias("message_id"),
                    F.col("o_orderdate").cast("timestamp").alias("publish_time"),
                    data.alias("data"),
                    F.concat(F.lit('{"buildId":"'), key.cast("string"), F.lit('"}')).alias("attributes"))


def cloud_deploy_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    target = _pick(DEPLOY_TARGETS, F.col("l_suppkey") % 11)
    rf, ln = F.col("l_returnflag"), F.col("l_linenumber")
    action = (F.when(F.col("l_linestatus") == "F", F.lit("Failed"))
              .when((rf == "N") & (ln == 1), F.lit("Start"))
              .when((rf == "A") & (ln == 2), F.lit("SUCCEED"))
              .otherwise(F.lit("Succeed")))
    rollback = F.when((rf == "R") & (F.col("l_orderkey") % 50 == 0),
                      F.concat(F.lit("rollout-"), F.col("l_orderkey").cast("string")))
    rtype = F.when(ln <= 4, F.lit("Rollout")).otherwise(F.lit("Release"))
    attrs = F.concat(F.lit("{"), _json_str("Action", action, first=True), _json_str("ResourceType", rtype),
                     F.coalesce(_json_str("TargetId", target), F.lit("")),
                     F.coalesce(_json_str("RollbackOfRollout", rollback), F.lit("")), F.lit("}"))
    return li.select(F.lit("clouddeploy-bq-sub").alias("subscription_name"),
                     F.concat(F.lit("d-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                              ln.cast("string")).alias("message_id"),
                     F.col("l_shipdate").cast("timestamp").alias("publish_time"),
                     F.lit(None).cast("string").alias("data"),
                     attrs.alias("attributes"))


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One survey row per supplier."""
    s = table(spark, sf_dir, "supplier")
    key, k8 = F.col("s_suppkey"), F.col("s_suppkey") % 8
    cols = [F.when(key < 8, _pick(SURVEY_SERVICES, k8)).otherwise(F.concat(F.lit(SURVEY_OTHER), key.cast("string"))).alias("service_name")]
    for j, c in enumerate(C.SURVEY_ANSWER_COLUMNS, start=1):
        a = (F.when(k8 == 0, F.lit("TRUE")).when(k8 == 1, F.lit(None).cast("string"))
             .otherwise(_pick(SURVEY_ANSWERS, (k8 * 3 + 5 * j) % 8)))
        cols.append(a.alias(c))
    cols.append(_pick(SURVEY_FLAGS, k8).alias(C.SURVEY_FLAG_COLUMN))
    return s.select(*cols)


# ---------------------------------------------------------------------------
def sources(spark: SparkSession):
    """The metric-source registry as configuration (operators build the broadcast
    registry from it and push the metric types into the points scan)."""
    return C.METRIC_SOURCES


def backfilled_raw_metrics(spark: SparkSession, sf_dir: str, method: str = "exact", latency: bool = True) -> DataFrame:
    return M.backfill(metric_points(spark, sf_dir), sources(spark), METRICS_AS_OF,
                      BACKFILL_START_DAYS_AGO, BACKFILL_END_DAYS_AGO, INGESTED_AT, method=method, latency=latency)


def raw_metrics(spark: SparkSession, sf_dir: str, method: str = "exact", backfilled: DataFrame | None = None,
                latency: bool = True) -> DataFrame:
    """Backfilled raw_metrics with archetypes overridden for score tests; without
    ``latency`` for queries that read no latency."""
    rm = backfilled_raw_metrics(spark, sf_dir, method, latency) if backfilled is None else backfilled
    svc = F.col("service_name")
    odd = (F.dayofmonth(F.col("target_date").cast("date")) % 2) == 1
    arch = F.when((svc == ODD_DAY_ARCHETYPE[0]) & odd, F.lit(ODD_DAY_ARCHETYPE[1]))
    for s, a in SCORE_ARCHETYPES.items():
        arch = arch.when(svc == s, F.lit(a).cast("string"))
    return rm.withColumn("archetype", arch.otherwise(F.lit(C.DEFAULT_ARCHETYPE)))


def legacy_metrics(spark: SparkSession, sf_dir: str, method: str = "exact",
                   backfilled: DataFrame | None = None) -> DataFrame:
    """Legacy-query input: backfilled rows + error-log counts per service and day. A day without
    requests has a NULL count (zero is a division error there)."""
    rm = backfilled_raw_metrics(spark, sf_dir, method) if backfilled is None else backfilled
    logs = L.error_log_counts(L.route_logs(log_entries(spark, sf_dir)))
    j = rm.join(logs, ["target_date", "service_name"], "left")
    dom = F.dayofmonth(F.col("target_date").cast("date"))
    odd = (dom % 2) == 1
    arch = None
    for s, a in LEGACY_ARCHETYPES.items():
        arch = F.when(F.col("service_name") == s, F.lit(a)) if arch is None else arch.when(F.col("service_name") == s, F.lit(a))
    p95 = F.when(dom % 5 == 0, F.lit(None).cast("double")).when(dom % 5 == 1, F.lit(0.0)).otherwise(F.col("latency_p95_ms"))
    return j.select(
        "service_name", arch.otherwise(F.lit(C.DEFAULT_ARCHETYPE)).alias("archetype"),
        "availability_ratio", "latency_p50_ms", p95.alias("latency_p95_ms"),
        F.col("error_log_count").cast("long").alias("error_log_count"), F.nullif("total_requests", F.lit(0)).alias("total_requests"),
        F.when(odd, F.lit(None).cast("double")).otherwise(F.lit(40.0) + dom).alias("pipeline_robustness_score"),
        F.when(odd, F.lit(None).cast("double")).otherwise(F.lit(100.0) - dom).alias("observability_score"))
