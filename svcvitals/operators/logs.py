"""Warning-level log routing and per-service error-log counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from svcvitals import config as C
from svcvitals.functions.columns import severity_rank


def route_logs(logs: DataFrame, label_key: str = C.LOG_SERVICE_LABEL,
               min_severity: str = C.MIN_LOG_SEVERITY, ranks: dict[str, int] | None = None) -> DataFrame:
    """Entries that carry the service label and are at least ``min_severity``.

    A map-only filter: works on batch and streaming DataFrames.
    """
    ranks = ranks or C.SEVERITY_RANKS
    return logs.filter(F.map_contains_key(F.col("labels"), F.lit(label_key))
                       & (severity_rank("severity", ranks) >= F.lit(ranks[min_severity])))


def error_log_counts(routed: DataFrame, label_key: str = C.LOG_SERVICE_LABEL,
                     by_day: bool = True) -> DataFrame:
    """Routed entries per service (and UTC day): ``error_log_count``.

    A plain count: partial aggregation runs before the shuffle, so a hot service
    costs one counter per map task.
    """
    svc = F.try_element_at(F.col("labels"), F.lit(label_key)).alias("service_name")
    keys = ([F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("target_date")] if by_day else []) + [svc]
    return routed.groupBy(*keys).agg(F.count(F.lit(1)).alias("error_log_count"))
