"""Stored tables: explicit schemas on read, append on write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from svcvitals import schemas as S


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_raw_metrics(spark: SparkSession, path: str) -> DataFrame:
    """raw_metrics, partitioned by target_date: filters on target_date prune folders."""
    return read_parquet(spark, path, S.RAW_METRICS)


POINTS_DAY = "day"


def write_points(points: DataFrame, path: str, mode: str = "append", files_per_day: int = 8) -> None:
    """Store metric points by UTC day, each day in up to ``files_per_day`` files, so that a
    day's volume is not one task's."""
    salt = F.pmod(F.xxhash64("metric_type", "ts", "double_value", "int64_value"), F.lit(files_per_day))
    names = [f.name for f in S.METRIC_POINTS.fields]
    (points.select(*names, F.to_date("ts").alias(POINTS_DAY)).repartition(F.col(POINTS_DAY), salt)
     .write.mode(mode).partitionBy(POINTS_DAY).parquet(path))


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """A metric-points table; with its ``day`` column when it is stored by day, so that
    day windows (``operators.metrics.day_slice``) read only those days' folders."""
    stored = spark.read.parquet(path)
    schema = T.StructType(list(S.METRIC_POINTS.fields))
    if POINTS_DAY in stored.columns:
        schema = schema.add(POINTS_DAY, T.DateType())
    return spark.read.schema(schema).parquet(path)


DATE_PARTITION = "publish_date"
LOG_DATE_PARTITION = "log_date"


def read_by_day(spark: SparkSession, path: str, schema, since=None,
                partition_col: str = DATE_PARTITION) -> DataFrame:
    """Read a table stored partitioned by a day column (as the stream sinks write it).

    ``since`` (date, 'yyyy-MM-dd' or Column) becomes a partition filter, so only the
    folders of those days are listed and read; the result has exactly ``schema``'s columns.
    Tables without the partition column are read whole (the caller's own time filter
    still applies).
    """
    df = read_parquet(spark, path, schema)
    if since is not None and partition_col in df.columns:
        bound = since if isinstance(since, Column) else F.lit(str(since)).cast("date")
        df = df.filter(F.col(partition_col) >= bound.cast("date"))
    return df.select(*[f.name for f in schema.fields])


def read_envelopes(spark: SparkSession, path: str, since=None) -> DataFrame:
    """A raw build / deploy envelope table (``schemas.EVENT_ENVELOPE``)."""
    return read_by_day(spark, path, S.EVENT_ENVELOPE, since)


def read_routed_logs(spark: SparkSession, path: str, since=None) -> DataFrame:
    """A routed-log table (``schemas.LOG_ENTRIES``) written by the streaming L1 path."""
    return read_by_day(spark, path, S.LOG_ENTRIES, since, LOG_DATE_PARTITION)


def read_deployment_events(spark: SparkSession, path: str, since=None) -> DataFrame:
    """A stored ``deployment_events_raw`` table (written by the streaming E5 path)."""
    return read_by_day(spark, path, S.DEPLOYMENT_EVENTS, since)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None, schema=None) -> None:
    """Append rows; with ``schema``, rows of other columns or types are refused."""
    if schema is not None and {(f.name, f.dataType) for f in schema.fields} != {(f.name, f.dataType) for f in df.schema.fields}:
        raise ValueError(f"rows do not fit the table: {df.schema.simpleString()}")
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def materialize(df: DataFrame, purpose: str = "materialized") -> DataFrame:
    """Cut lineage by writing a Parquet table into the shared checkpoint folder and
    reading it back.

    Used where one derived table feeds several later steps. The data is computed once (an
    eager ``checkpoint()`` would compute it a second time for the checkpoint write),
    survives executor loss, and the re-read table carries real size statistics for the
    planner's join choices.
    """
    from svcvitals.session import shared_dir
    path = shared_dir(df.sparkSession, purpose)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
