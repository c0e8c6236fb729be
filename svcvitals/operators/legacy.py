"""The legacy (undeployed) single-query score over ``schemas.LEGACY_METRICS``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from svcvitals import config as C
from svcvitals.functions.columns import null_safe_least


def _inputs(df: DataFrame) -> DataFrame:
    return df.select(
        "service_name", "archetype", "availability_ratio", "latency_p50_ms", "latency_p95_ms",
        F.coalesce(F.col("error_log_count"), F.lit(0)).cast("long").alias("error_log_count"),
        F.coalesce(F.col("total_requests"), F.lit(1)).cast("long").alias("total_requests"),
        F.coalesce(F.col("pipeline_robustness_score"), F.lit(C.LEGACY_DEFAULT_PILLAR)).alias("pipeline_robustness_score"),
        F.coalesce(F.col("observability_score"), F.lit(C.LEGACY_DEFAULT_PILLAR)).alias("observability_score"))


# --------------------------------------------------------------------------- W1
def legacy_component_scores(df: DataFrame) -> DataFrame:
    """availability x 100; min(1, 500 / p95) x 100 (NULL when p95 is NULL or 0: the
    least of a NULL is NULL here); max(0, 100 - error logs / requests x 1000).

    Zero requests raise a division error under ANSI mode; NULL requests count as 1.
    """
    x = _inputs(df)
    q = F.lit(C.LEGACY_P95_TARGET_MS) / F.nullif(F.col("latency_p95_ms"), F.lit(0.0))
    return x.select(
        "service_name", "archetype",
        (F.col("availability_ratio") * F.lit(100)).alias("availability_score"),
        (null_safe_least(F.lit(1.0), q) * F.lit(100)).try_cast("double").alias("latency_score"),
        F.greatest(F.lit(0.0), F.lit(100.0) - ((F.col("error_log_count") / F.col("total_requests"))
                                                * F.lit(C.LEGACY_LOG_PENALTY))).alias("log_health_score"),
        "pipeline_robustness_score", "observability_score")


# --------------------------------------------------------------------------- W2
def legacy_pillar_score(components: DataFrame) -> DataFrame:
    """Archetype-weighted pillar: exact 'sync' / 'async' weights, any other archetype 0."""
    s, a = C.LEGACY_SYNC_WEIGHTS, C.LEGACY_ASYNC_WEIGHTS
    av, lat, lh = F.col("availability_score"), F.col("latency_score"), F.col("log_health_score")
    arch = F.col("archetype")
    pillar = (F.when(arch == "sync", (av * F.lit(s["availability"])) + (lat * F.lit(s["latency"]))
                     + (lh * F.lit(s["log_health"])))
              .when(arch == "async", (av * F.lit(a["availability"]))
                    + (F.lit(C.LEGACY_FRESHNESS_PLACEHOLDER) * F.lit(a["freshness"]))
                    + (lh * F.lit(a["log_health"])))
              .otherwise(F.lit(0.0)))
    return components.select("service_name", "archetype", pillar.alias("performance_pillar_score"),
                             "pipeline_robustness_score", "observability_score")


# --------------------------------------------------------------------------- W3
def legacy_final_score(df: DataFrame) -> DataFrame:
    """service_name, archetype, the three pillars and the 50/25/25 final score."""
    w = C.LEGACY_FINAL_WEIGHTS
    p = legacy_pillar_score(legacy_component_scores(df))
    return p.withColumn(
        "final_service_health_score",
        (F.col("performance_pillar_score") * F.lit(w["pillar"]))
        + (F.col("pipeline_robustness_score") * F.lit(w["pipeline"]))
        + (F.col("observability_score") * F.lit(w["observability"])))
