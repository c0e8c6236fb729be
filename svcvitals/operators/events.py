"""Deployment events: raw build / deploy envelopes -> one normalised event table.

All operators are projections + filters (+ an explode), so they run unchanged on a
streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from svcvitals import config as C, schemas as S
from svcvitals.functions.columns import environment, json_scalar

EVENT_COLUMNS = ["publish_time", "status", "service_name", "environment", "is_rollback", "event_category"]


def _with_payload(df: DataFrame, col: str, schema, keep: list[str]) -> DataFrame:
    """Parse the JSON payload once per row and expose its fields as columns.

    The parse sits in a generator (``inline`` of the one-element array), so its output
    fields are plain attributes: predicates and projections above read them instead of
    re-running the parse (a projected ``from_json`` would be inlined into every
    predicate by filter pushdown and evaluated once per reference).
    """
    return df.select(*keep, F.inline_outer(F.array(F.from_json(F.col(col), schema))))


def _with_fields(df: DataFrame, col: str, fields: list[str], keep: list[str]) -> DataFrame:
    """Top-level JSON fields as strings, one streaming parse per row (``json_tuple``).
    Objects/arrays come back as their JSON text; missing keys and JSON null as NULL."""
    return df.select(*keep, F.json_tuple(F.col(col), *fields)).toDF(*keep, *fields)


# --------------------------------------------------------------------------- E2
def build_events(builds_raw: DataFrame) -> DataFrame:
    """Finished builds tagged with a service.

    Keeps SUCCESS / FAILURE / TIMEOUT; drops builds started by the deploy system
    (trigger id ``cloud-deploy-project-*``) and builds whose first tag is empty,
    missing, ``cloud-deploy-*`` or ``trigger-*``. Service = first tag with ``::``
    replaced by ``--``.
    """
    j = _with_payload(builds_raw, "data", S.BUILD_PAYLOAD, ["publish_time", "data"])
    b = j.select(
        "publish_time",
        json_scalar("status", "data", "$.status").alias("status"),
        json_scalar(F.get("tags", F.lit(0)), "data", "$.tags[0]").alias("_tag0"),
        json_scalar("buildTriggerId", "data", "$.buildTriggerId").alias("_trigger"))
    tag = F.coalesce(F.col("_tag0"), F.lit(""))
    keep = (~F.coalesce(F.col("_trigger"), F.lit("")).startswith(C.BUILD_EXCLUDED_TRIGGER_PREFIX)
            & (tag != ""))
    for prefix in C.BUILD_EXCLUDED_TAG_PREFIXES:
        keep = keep & ~tag.startswith(prefix)
    keep = keep & F.col("status").isin(C.BUILD_STATUSES_KEPT)
    service = F.replace(F.col("_tag0"), F.lit("::"), F.lit("--"))
    return (b.filter(keep)
            .select("publish_time", "status", service.alias("service_name"))
            .select("publish_time", "status", "service_name",
                    environment("service_name").alias("environment"),
                    F.lit(False).alias("is_rollback"),
                    F.when(F.col("status").isin(C.BUILD_FAILURE_STATUSES), F.lit("Failure"))
                    .otherwise(F.lit("Success")).alias("event_category")))


# --------------------------------------------------------------------------- E3
def deploy_events(deploys_raw: DataFrame) -> DataFrame:
    """Rollout operations that succeeded or failed, with status, rollback flag and category.

    Output keeps ``target_id`` for :func:`expand_targets`. Only the exact action
    ``Succeed`` is renamed ``SUCCEEDED``; other actions are upper-cased.
    """
    j = _with_fields(deploys_raw, "attributes", [f.name for f in S.DEPLOY_PAYLOAD.fields], ["publish_time", "attributes"])
    d = j.select(
        "publish_time",
        json_scalar("Action", "attributes", "$.Action").alias("_action"),
        json_scalar("TargetId", "attributes", "$.TargetId").alias("target_id"),
        json_scalar("ResourceType", "attributes", "$.ResourceType").alias("_rtype"),
        json_scalar("RollbackOfRollout", "attributes", "$.RollbackOfRollout").alias("_rollback_of"))
    action_u = F.upper(F.col("_action"))
    rollback = F.col("_rollback_of").isNotNull()
    return (d.filter((F.col("_rtype") == C.DEPLOY_RESOURCE_TYPE) & action_u.isin(C.DEPLOY_ACTIONS_KEPT))
            .select("publish_time",
                    F.when(F.col("_action") == C.DEPLOY_SUCCESS_ACTION, F.lit(C.DEPLOY_SUCCESS_STATUS))
                    .otherwise(action_u).alias("status"),
                    "target_id",
                    rollback.alias("is_rollback"),
                    F.when(rollback, F.lit("Rollback"))
                    .when(action_u == "FAILED", F.lit("Failure"))
                    .otherwise(F.lit("Success")).alias("event_category")))


# --------------------------------------------------------------------------- E4
def target_map_column(target_map: dict[str, list[str]] | None = None) -> Column:
    """The target map as a map literal: a projection, no join and no broadcast."""
    target_map = target_map or C.TARGET_SERVICES
    return F.create_map(*[x for k, v in target_map.items()
                          for x in (F.lit(k), F.array(*[F.lit(s) for s in v]))])


def expand_targets(deploys: DataFrame, target_map: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per service a deploy target covers; unmapped targets become
    ``endpoints--<target>`` (NULL target -> one row with NULL service)."""
    services = F.coalesce(F.try_element_at(target_map_column(target_map), F.col("target_id")),
                          F.array(F.concat(F.lit(C.UNMAPPED_TARGET_PREFIX), F.col("target_id"))))
    return (deploys.withColumn("service_name", F.explode(services))
            .select("publish_time", "status", "service_name",
                    environment("service_name").alias("environment"),
                    "is_rollback", "event_category"))


# --------------------------------------------------------------------------- E5
def deployment_events_raw(builds_raw: DataFrame, deploys_raw: DataFrame,
                          target_map: dict[str, list[str]] | None = None) -> DataFrame:
    """UNION ALL of build events and target-expanded deploy events (6 columns)."""
    return build_events(builds_raw).unionByName(expand_targets(deploy_events(deploys_raw), target_map))
