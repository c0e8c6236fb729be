"""The daily job as a stream: points in, a raw_metrics row per service and day out, once the
day is over.

Two queries, each with its own checkpoint:

- :func:`stream_gate` splits every micro-batch into points that are on time and points whose
  day was over before the batch began: the end of their day lies at least ``delay`` before
  the latest point of earlier batches. Late points go to a table of their own, for a batch re-run of
  their days (``jobs --replace``); nothing is dropped.
- :func:`stream_raw_metrics` reads the points on time with a watermark of the same
  ``delay`` and rolls them up in the state store: per series and day, then per service and day.
  A day's rows are appended when the watermark has passed its end. The gate has let through
  no point that the watermark would drop.

Percentiles are exact (Spark's ``percentile``): the state holds a series' distinct values of
its open days. Use the RocksDB state store for large feeds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from svcvitals import schemas as S
from svcvitals.operators import metrics as M
from svcvitals.streaming.ingest import _sink

ON_TIME, LATE, MARKS = "on_time", "late", "marks"
PERCENTILES = {"latency_p50": 0.5, "latency_p95": 0.95}


class _Gate:
    """What the gate does with a micro-batch; each part of a batch appears whole or not at
    all, and a batch that comes again is left as it is."""

    def __init__(self, folder: str, delay: str):
        self.folder, self.delay = folder.rstrip("/"), delay

    def _publish(self, df: DataFrame, part: str, batch_id: int) -> None:
        spark = df.sparkSession
        final, staged = (f"{self.folder}/{name}/batch={batch_id}" for name in (part, f"_staged/{part}"))
        path = spark._jvm.org.apache.hadoop.fs.Path
        fs = path(final).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if fs.exists(path(final)):
            return
        df.write.mode("overwrite").parquet(staged)
        fs.mkdirs(path(final).getParent())
        if not fs.rename(path(staged), path(final)):
            raise OSError(f"cannot move {staged} to {final}")

    def __call__(self, points: DataFrame, batch_id: int) -> None:
        spark = points.sparkSession
        bound = None
        if batch_id:  # the latest point of all earlier batches, one row per batch
            marks = spark.read.schema("latest timestamp, batch long").parquet(f"{self.folder}/{MARKS}")
            bound = marks.filter(F.col("batch") < batch_id).agg((F.max("latest") - F.expr(f"INTERVAL {self.delay}")).alias("b")).first().b
        late = F.lit(False) if bound is None else F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY") <= F.lit(bound)
        late = F.coalesce(late, F.lit(True))  # a point without a time belongs to no day
        points = points.persist()
        try:
            self._publish(points.filter(~late), ON_TIME, batch_id)
            self._publish(points.filter(late), LATE, batch_id)
            self._publish(points.agg(F.max("ts").alias("latest")), MARKS, batch_id)
        finally:
            points.unpersist()


def stream_gate(spark: SparkSession, source_path: str, folder: str, checkpoint_path: str, delay: str = "1 day",
                fmt: str = "parquet", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Points (``schemas.METRIC_POINTS``) that land in ``source_path`` into the tables
    ``on_time`` and ``late`` of ``folder``."""
    r = spark.readStream.schema(S.METRIC_POINTS).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return (r.load(source_path).writeStream.foreachBatch(_Gate(folder, delay))
            .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())


def read_late_points(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(S.METRIC_POINTS).parquet(f"{folder.rstrip('/')}/{LATE}/*")


def daily_rollup(points: DataFrame, sources, delay: str) -> DataFrame:
    """Merged daily rows (as ``metrics.merge_counts_latency`` gives them) of a stream of
    points, by two chained aggregations over one watermark."""
    p = M.service_key(M.attach_sources(points.withWatermark("ts", delay), sources))
    is_counts = F.col("kind") == M.COUNTS
    cls = F.when(is_counts, F.coalesce(F.try_element_at(F.col("metric_labels"), F.lit("response_code_class")), F.lit(M.C.DEFAULT_RESPONSE_CLASS)))
    p = p.select("ts", "service_name", "prefix", "label", "kind", "latency_scale", "int64_value", "double_value", cls.alias("cls"),
                 F.when(is_counts, M._project_label()).alias("project"), F.when(~is_counts, M._series_key()).alias("series"))
    series = p.groupBy(F.window("ts", "1 day"), "service_name", "prefix", "label", "kind", "cls", "project", "series").agg(
        F.sum("int64_value").alias("n"), F.max("latency_scale").alias("scale"),
        *[F.percentile("double_value", q).alias(f"s_{c}") for c, q in PERCENTILES.items()])
    e5 = F.col("cls").startswith("5")
    e4 = ~e5 & F.col("cls").startswith("4")

    def total(of: Column) -> Column:
        return F.coalesce(F.sum(of), F.lit(0)).cast("long")
    latency = F.col("kind") == M.LATENCY
    daily = series.groupBy(F.window(F.window_time("window"), "1 day").alias("w"), "service_name").agg(
        F.max("prefix").alias("prefix"), F.max("label").alias("label"),
        total(F.when(F.col("kind") == M.COUNTS, F.col("n"))).alias("total_requests"),
        total(F.when(e5, F.col("n"))).alias("error_5xx_requests"), total(F.when(e4, F.col("n"))).alias("error_4xx_requests"),
        F.max("project").alias("project_id"),
        *[(F.percentile(F.when(latency, F.col(f"s_{c}")), q) * F.max(F.when(latency, F.col("scale")))).alias(c) for c, q in PERCENTILES.items()])
    return daily.withColumn("day", F.to_date("w.start")).drop("w")


def stream_raw_metrics(spark: SparkSession, folder: str, sink_path: str, checkpoint_path: str, sources=None,
                       delay: str = "1 day", ingested_at=None) -> StreamingQuery:
    """raw_metrics rows, partitioned by ``target_date``, of the days that are over, out of the
    gate's points on time."""
    points = spark.readStream.schema(S.METRIC_POINTS).parquet(f"{folder.rstrip('/')}/{ON_TIME}/*")
    rows = M.raw_metrics_rows(M.project_attribution(daily_rollup(points, sources, delay)),
                              F.current_timestamp() if ingested_at is None else ingested_at)
    return _sink(rows, sink_path, checkpoint_path, True, None, ["target_date"])
