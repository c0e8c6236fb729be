"""StructTypes for every input and stored table."""

from pyspark.sql import types as T

RAW_METRICS = T.StructType([
    T.StructField("timestamp", T.TimestampType(), False),
    T.StructField("target_date", T.StringType(), False),
    T.StructField("project_id", T.StringType(), True),
    T.StructField("service_name", T.StringType(), False),
    T.StructField("archetype", T.StringType(), True),
    T.StructField("availability_ratio", T.DoubleType(), True),
    T.StructField("total_requests", T.LongType(), True),
    T.StructField("error_5xx_requests", T.LongType(), True),
    T.StructField("error_4xx_requests", T.LongType(), True),
    T.StructField("total_errors", T.LongType(), True),
    T.StructField("latency_p50_ms", T.DoubleType(), True),
    T.StructField("latency_p95_ms", T.DoubleType(), True),
])

EVENT_ENVELOPE = T.StructType([
    T.StructField("subscription_name", T.StringType(), True),
    T.StructField("message_id", T.StringType(), True),
    T.StructField("publish_time", T.TimestampType(), True),
    T.StructField("data", T.StringType(), True),
    T.StructField("attributes", T.StringType(), True),
])

DEPLOYMENT_EVENTS = T.StructType([
    T.StructField("publish_time", T.TimestampType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("service_name", T.StringType(), True),
    T.StructField("environment", T.StringType(), True),
    T.StructField("is_rollback", T.BooleanType(), True),
    T.StructField("event_category", T.StringType(), True),
])

# Payload shapes, parsed once per row. Every leaf is a string so that numbers and
# booleans come back as their JSON text, like a JSON scalar extraction.
BUILD_PAYLOAD = T.StructType([
    T.StructField("status", T.StringType(), True),
    T.StructField("tags", T.ArrayType(T.StringType()), True),
    T.StructField("buildTriggerId", T.StringType(), True),
])
DEPLOY_PAYLOAD = T.StructType([
    T.StructField("Action", T.StringType(), True),
    T.StructField("TargetId", T.StringType(), True),
    T.StructField("ResourceType", T.StringType(), True),
    T.StructField("RollbackOfRollout", T.StringType(), True),
])

SURVEY = T.StructType([T.StructField(c, T.StringType(), True) for c in [
    "service_name", "has_staging", "has_sanity_tests", "has_test_coverage",
    "has_routing_rule", "has_runbook", "has_error_signal", "has_blackbox_prober",
    "has_latency_threshold", "has_staleness_alert", "has_silent_failure_monitor",
    "has_feature_flags",
]])

LABELS = T.MapType(T.StringType(), T.StringType())

METRIC_POINTS = T.StructType([
    T.StructField("metric_type", T.StringType(), True),
    T.StructField("resource_labels", LABELS, True),
    T.StructField("metric_labels", LABELS, True),
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("int64_value", T.LongType(), True),
    T.StructField("double_value", T.DoubleType(), True),
])

#: Counts over an interval: ``value_kind`` is 'cumulative' (since the start) or 'delta'.
INTERVAL_POINTS = T.StructType([
    T.StructField("metric_type", T.StringType(), True),
    T.StructField("resource_labels", LABELS, True),
    T.StructField("metric_labels", LABELS, True),
    T.StructField("value_kind", T.StringType(), True),
    T.StructField("start_ts", T.TimestampType(), True),
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("int64_value", T.LongType(), True),
])

#: A bucket layout: explicit bounds, or n + 1 bounds by scale and growth, or by offset and width.
BUCKET_LAYOUT = T.StructType([
    T.StructField("kind", T.StringType(), True),
    T.StructField("bounds", T.ArrayType(T.DoubleType()), True),
    T.StructField("num_finite_buckets", T.IntegerType(), True),
    T.StructField("scale", T.DoubleType(), True),
    T.StructField("growth_factor", T.DoubleType(), True),
    T.StructField("offset", T.DoubleType(), True),
    T.StructField("width", T.DoubleType(), True),
])

DISTRIBUTION_POINTS = T.StructType([
    T.StructField("metric_type", T.StringType(), True),
    T.StructField("resource_labels", LABELS, True),
    T.StructField("metric_labels", LABELS, True),
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("layout", BUCKET_LAYOUT, True),
    T.StructField("bucket_counts", T.ArrayType(T.LongType()), True),
])

LOG_ENTRIES = T.StructType([
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("severity", T.StringType(), True),
    T.StructField("labels", LABELS, True),
])

LEGACY_METRICS = T.StructType([
    T.StructField("service_name", T.StringType(), True),
    T.StructField("archetype", T.StringType(), True),
    T.StructField("availability_ratio", T.DoubleType(), True),
    T.StructField("latency_p50_ms", T.DoubleType(), True),
    T.StructField("latency_p95_ms", T.DoubleType(), True),
    T.StructField("error_log_count", T.LongType(), True),
    T.StructField("total_requests", T.LongType(), True),
    T.StructField("pipeline_robustness_score", T.DoubleType(), True),
    T.StructField("observability_score", T.DoubleType(), True),
])
