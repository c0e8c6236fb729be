"""Configuration. Everything here is overridable by passing arguments to the operators.

The blocks marked FIXED VALUES must equal the values used by the scoring stack
this library reproduces; they are stated as plain data, in their natural order.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# FIXED VALUES: metric sources.
# (prefix, request-count metric type, latency metric type, service label key,
#  latency multiplier to milliseconds)
# ---------------------------------------------------------------------------
METRIC_SOURCES: list[tuple[str, str, str, str, float]] = [
    ("cloudrun", "run.googleapis.com/request_count",
     "run.googleapis.com/request_latencies", "service_name", 1.0),
    ("gke-lb", "loadbalancing.googleapis.com/https/request_count",
     "loadbalancing.googleapis.com/https/backend_latencies", "backend_service_name", 1.0),
    ("endpoints", "serviceruntime.googleapis.com/api/request_count",
     "serviceruntime.googleapis.com/api/request_latencies", "service", 1000.0),
    ("apigee", "apigee.googleapis.com/proxyv2/request_count",
     "apigee.googleapis.com/proxyv2/total_response_time", "proxy", 1.0),
]
# Endpoint-style labels with this suffix are platform APIs, not services.
ENDPOINTS_PREFIX = "endpoints"
PLATFORM_API_SUFFIX = ".googleapis.com"
DEFAULT_RESPONSE_CLASS = "2xx"
UNKNOWN_PROJECT = "unknown"
DEFAULT_ARCHETYPE = "sync"

# ---------------------------------------------------------------------------
# FIXED VALUES: environment classifier, evaluated in order, case-insensitive,
# substring match; first hit wins.
# ---------------------------------------------------------------------------
ENVIRONMENT_RULES: list[tuple[str, str]] = [
    (r"(?i)prod", "Prod"),
    (r"(?i)--api\.datacommons\.org", "Prod"),
    (r"(?i)autorater", "Prod"),
    (r"(?i)staging", "Staging"),
    (r"(?i)autopush", "Autopush"),
    (r"(?i)dev", "Dev"),
]
DEFAULT_ENVIRONMENT = "Unknown"

# ---------------------------------------------------------------------------
# FIXED VALUES: deploy target -> services it deploys.
# Targets not listed map to ["endpoints--" + target].
# ---------------------------------------------------------------------------
TARGET_SERVICES: dict[str, list[str]] = {
    "website-dev": [
        "endpoints--website-esp.endpoints.datcom-website-dev.cloud.goog",
        "endpoints--mixer-esp.endpoints.datcom-website-dev.cloud.goog",
    ],
    "website-autopush": [
        "endpoints--website-esp.endpoints.datcom-website-autopush.cloud.goog",
        "endpoints--mixer-esp.endpoints.datcom-website-autopush.cloud.goog",
    ],
    "website-staging": [
        "endpoints--website-esp.endpoints.datcom-website-staging.cloud.goog",
        "endpoints--mixer-esp.endpoints.datcom-website-staging.cloud.goog",
    ],
    "website-prod-central": [
        "endpoints--website-esp.endpoints.datcom-website-prod.cloud.goog",
        "endpoints--mixer-esp.endpoints.datcom-website-prod.cloud.goog",
    ],
    "website-prod-west": [
        "endpoints--website-esp.endpoints.datcom-website-prod.cloud.goog",
        "endpoints--mixer-esp.endpoints.datcom-website-prod.cloud.goog",
    ],
    "mixer-dev": ["endpoints--dev.api.datacommons.org"],
    "mixer-autopush": ["endpoints--autopush.api.datacommons.org"],
    "mixer-staging": ["endpoints--staging.api.datacommons.org"],
    "mixer-prod": ["endpoints--api.datacommons.org"],
}
UNMAPPED_TARGET_PREFIX = "endpoints--"

# ---------------------------------------------------------------------------
# FIXED VALUES: deployment event vocabulary.
# ---------------------------------------------------------------------------
BUILD_STATUSES_KEPT = ["SUCCESS", "FAILURE", "TIMEOUT"]
BUILD_FAILURE_STATUSES = ["FAILURE", "TIMEOUT"]
BUILD_EXCLUDED_TRIGGER_PREFIX = "cloud-deploy-project-"
BUILD_EXCLUDED_TAG_PREFIXES = ["cloud-deploy-", "trigger-"]
DEPLOY_RESOURCE_TYPE = "Rollout"
DEPLOY_ACTIONS_KEPT = ["SUCCEED", "FAILED"]
DEPLOY_SUCCESS_ACTION = "Succeed"
DEPLOY_SUCCESS_STATUS = "SUCCEEDED"
SUCCESS_STATUSES = ["SUCCESS", "SUCCEEDED"]

# ---------------------------------------------------------------------------
# FIXED VALUES: scoring constants.
# ---------------------------------------------------------------------------
P50_TARGET_MS = 500.0
P95_TARGET_MS = 2500.0
AVAILABILITY_DECAY_SLOPE = 100.0          # 99 % availability -> 0 points
PERF_WEIGHTS = {"availability": 0.65, "p50": 0.05, "p95": 0.20, "log_health": 0.10}
LOG_HEALTH_PLACEHOLDER = 1.0
ASYNC_LIKE_PATTERN = r"(?i)async|pipeline|cron|ingest"
DEPLOY_WINDOW_MONTHS = 6
ROLLBACK_WINDOW_DAYS = 30
STALE_AFTER_DAYS = 30
NEVER_DEPLOYED_DAYS = 999
MAX_MONTHS_DENOMINATOR = 6
DEFAULT_EPOCH = _dt.date(2026, 3, 1)
PIPELINE_WEIGHTS_ASYNC = {"delivery": 0.3, "cadence": 0.4, "lead_time": 0.3}
PIPELINE_WEIGHTS_SYNC = {"delivery": 0.3, "cadence": 0.3, "lead_time": 0.3, "feature_flag": 0.1}
COMPOSITE_WEIGHTS = {"performance": 0.50, "observability": 0.25, "pipeline": 0.25}
FEATURE_FLAG_WEIGHT = 0.1

# ---------------------------------------------------------------------------
# FIXED VALUES: observability survey.
# ---------------------------------------------------------------------------
SURVEY_ANSWER_COLUMNS = [
    "has_staging", "has_sanity_tests", "has_test_coverage", "has_routing_rule",
    "has_runbook", "has_error_signal", "has_blackbox_prober", "has_latency_threshold",
    "has_staleness_alert", "has_silent_failure_monitor",
]
SURVEY_FLAG_COLUMN = "has_feature_flags"
SURVEY_COLUMNS = ["service_name"] + SURVEY_ANSWER_COLUMNS + [SURVEY_FLAG_COLUMN]
SURVEY_LEADING_ROWS = 2
OBSERVABILITY_DIVISOR = 8.0
FEATURE_FLAG_TRUE = ["true", "yes", "y", "1", "t"]

# ---------------------------------------------------------------------------
# FIXED VALUES: log routing. Severity order of the logging service (public enum).
# ---------------------------------------------------------------------------
LOG_SERVICE_LABEL = "datacommons-service"
MIN_LOG_SEVERITY = "WARNING"
SEVERITY_RANKS: dict[str, int] = {
    "DEFAULT": 0, "DEBUG": 100, "INFO": 200, "NOTICE": 300, "WARNING": 400,
    "ERROR": 500, "CRITICAL": 600, "ALERT": 700, "EMERGENCY": 800,
}

# ---------------------------------------------------------------------------
# FIXED VALUES: legacy (undeployed) score query.
# ---------------------------------------------------------------------------
LEGACY_P95_TARGET_MS = 500.0
LEGACY_LOG_PENALTY = 1000.0
LEGACY_DEFAULT_PILLAR = 100.0
LEGACY_SYNC_WEIGHTS = {"availability": 0.65, "latency": 0.25, "log_health": 0.10}
LEGACY_ASYNC_WEIGHTS = {"availability": 0.30, "freshness": 0.60, "log_health": 0.10}
LEGACY_FRESHNESS_PLACEHOLDER = 100.0
LEGACY_FINAL_WEIGHTS = {"pillar": 0.50, "pipeline": 0.25, "observability": 0.25}
