"""SQL-language functions registered in the session (inlined by Catalyst)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from svcvitals import config as C


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_sql_functions(spark: SparkSession, database: str | None = None) -> None:
    """``get_environment(STRING) -> STRING`` and ``is_async_like(STRING) -> BOOLEAN``: for the
    session, or stored in a database of the catalog, where any session finds them."""
    kind, where = ("FUNCTION", f"{database}.") if database else ("TEMPORARY FUNCTION", "")
    whens = " ".join(f"WHEN name RLIKE {_sql_str(p)} THEN {_sql_str(l)}" for p, l in C.ENVIRONMENT_RULES)
    spark.sql(
        f"CREATE OR REPLACE {kind} {where}get_environment(name STRING) RETURNS STRING "
        f"RETURN CASE {whens} ELSE {_sql_str(C.DEFAULT_ENVIRONMENT)} END")
    spark.sql(
        f"CREATE OR REPLACE {kind} {where}is_async_like(archetype STRING) RETURNS BOOLEAN "
        f"RETURN archetype RLIKE {_sql_str(C.ASYNC_LIKE_PATTERN)}")
