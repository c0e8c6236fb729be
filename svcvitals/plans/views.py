"""Publish the view stack under the reference names: as session views, or in the catalog."""


from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from svcvitals.functions.sql import register_sql_functions
from svcvitals.operators import legacy as W
from svcvitals.plans.health import HealthStack

TABLE_NAMES = ["raw_metrics", "cloud_builds_raw", "cloud_deploy_raw", "observability_survey_sheet"]
VIEW_NAMES = ["deployment_events_raw", "service_performance_scores", "observability_scores",
              "pipeline_robustness_scores", "composite_health_scores", "final_service_health_scores"]


def _published(stack: HealthStack, legacy_metrics: DataFrame | None) -> list[tuple[str, DataFrame]]:
    """(name, DataFrame) of the input tables and of the view stack. The survey-dependent
    pair (observability, composite) needs a survey, ``final_service_health_scores`` needs
    ``legacy_metrics``."""
    out = [("raw_metrics", stack.raw_metrics), ("cloud_builds_raw", stack.builds_raw), ("cloud_deploy_raw", stack.deploys_raw)]
    obs = stack.observability()
    if obs is not None:
        out.append(("observability_survey_sheet", stack.survey))
    out += [("deployment_events_raw", stack.deployment_events()), ("service_performance_scores", stack.performance())]
    if obs is not None:
        out.append(("observability_scores", obs))
    out.append(("pipeline_robustness_scores", stack.pipeline()))
    if obs is not None:
        out.append(("composite_health_scores", stack.composite()))
    if legacy_metrics is not None:
        out.append(("final_service_health_scores", W.legacy_final_score(legacy_metrics)))
    return out


def register_views(spark: SparkSession, stack: HealthStack,
                   legacy_metrics: DataFrame | None = None) -> list[str]:
    """Create/replace temp views for the input tables and the view stack, and the SQL
    functions; returns the names published. Views are lazy: each query on a view re-plans
    from the inputs.
    """
    register_sql_functions(spark)
    published = _published(stack, legacy_metrics)
    for name, df in published:
        df.createOrReplaceTempView(name)
    return [name for name, _ in published]


def publish_tables(spark: SparkSession, database: str, stack: HealthStack,
                   legacy_metrics: DataFrame | None = None) -> list[str]:
    """The same names as tables of a catalog database, with the SQL functions, for any
    session of the catalog. Each is written in full; run it again to bring the stack up to
    date. An input that is a table of this database already is left as it is."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    register_sql_functions(spark, database)
    names = []
    for name, df in _published(stack, legacy_metrics):
        if not (name in TABLE_NAMES and spark.catalog.tableExists(f"{database}.{name}")):
            df.write.mode("overwrite").saveAsTable(f"{database}.{name}")
        names.append(name)
    return names
