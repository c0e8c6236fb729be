"""Observability survey scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from svcvitals import config as C


def feature_flag_score(col: str = C.SURVEY_FLAG_COLUMN):
    """100 when the trimmed, lower-cased answer is a yes-like spelling, else 0."""
    v = F.trim(F.lower(F.col(col).cast("string")))
    return F.when(v.isin(C.FEATURE_FLAG_TRUE), F.lit(100.0)).otherwise(F.lit(0.0))


def observability_score(columns=None, divisor: float = C.OBSERVABILITY_DIVISOR):
    """Count of answers equal to 'true' (lower-cased, not trimmed) / divisor * 100.

    With ten questions and divisor 8 the range is 0..125.
    """
    columns = columns or C.SURVEY_ANSWER_COLUMNS
    total = None
    for c in columns:
        hit = F.when(F.lower(F.col(c).cast("string")) == "true", F.lit(1)).otherwise(F.lit(0))
        total = hit if total is None else total + hit
    return total / F.lit(divisor) * F.lit(100.0)


def observability_scores(survey: DataFrame) -> DataFrame:
    """service_name, feature_flag_score, observability_score: one row per survey row."""
    return survey.select("service_name",
                         feature_flag_score().alias("feature_flag_score"),
                         observability_score().alias("observability_score"))
