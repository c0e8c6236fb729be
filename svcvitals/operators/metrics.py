"""Metric ingestion: a table of time-series points -> daily per-service rows.

Input points (``schemas.METRIC_POINTS``): metric_type, resource_labels, metric_labels,
ts, int64_value, double_value. Counts points are per-interval deltas; latency points
are samples of one series (a series is identified by its metric type and label sets).

Every day here is a UTC day; run with ``spark.sql.session.timeZone=UTC``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from svcvitals import config as C, schemas as S
from svcvitals.functions.columns import py_round
from svcvitals.operators.quantiles import exact_percentiles
from svcvitals.sources.commits import DayCommits

COUNTS, LATENCY = "counts", "latency"


# --------------------------------------------------------------------------- M1
def metric_sources(spark: SparkSession, sources=None) -> DataFrame:
    """Registry of metric types: one row per (metric_type) with its kind and source."""
    rows = []
    for prefix, counts_type, latency_type, label_key, scale in (sources or C.METRIC_SOURCES):
        rows.append((counts_type, COUNTS, prefix, label_key, float(scale)))
        rows.append((latency_type, LATENCY, prefix, label_key, float(scale)))
    return spark.createDataFrame(
        rows, "metric_type string, kind string, prefix string, service_label string, latency_scale double")


def _registry(spark: SparkSession, sources) -> tuple[DataFrame, dict[str, list[str]] | None]:
    """``sources`` is a registry DataFrame, or a config list (None = the default list).
    From a config list the metric types are also known as literals."""
    if isinstance(sources, DataFrame):
        return sources, None
    cfg = sources or C.METRIC_SOURCES
    types = {COUNTS: [s[1] for s in cfg], LATENCY: [s[2] for s in cfg]}
    return metric_sources(spark, cfg), types


def attach_sources(points: DataFrame, sources=None, kind: str | None = None) -> DataFrame:
    """Keep points of registered metric types (of one ``kind`` if given) and attach
    source attributes.

    A registry made from the configuration has two rows per source and is broadcast; how a
    caller's own registry is joined is left to the planner. When the metric types are
    known literals, they are also applied as an IN filter that reaches the points scan
    (row groups of other metric types are skipped).
    """
    reg, types = _registry(points.sparkSession, sources)
    if kind is not None:
        reg = reg.filter(F.col("kind") == kind)
    if types is not None:
        wanted = types[kind] if kind is not None else types[COUNTS] + types[LATENCY]
        points = points.filter(F.col("metric_type").isin(wanted))
        reg = F.broadcast(reg)
    return (points.join(reg, "metric_type", "inner")
            .withColumn("label", F.try_element_at(F.col("resource_labels"), F.col("service_label"))))


# --------------------------------------------------------------------------- M2
def _day_start(d) -> Column:
    if isinstance(d, Column):
        return d.cast("date").cast("timestamp")
    return F.lit(str(d)).cast("date").cast("timestamp")


def day_slice(points: DataFrame, first_day, last_day=None, ts_col: str = "ts") -> DataFrame:
    """Points with ``first_day 00:00 <= ts < (last_day + 1) 00:00`` (UTC), plus ``day``.

    Bounds are literals, so the range reaches the Parquet scan as a pushed filter. A points
    table stored by ``day`` (``sources.tables.write_points``) is also filtered on that
    column, so only the folders of those days are read.
    """
    last_day = first_day if last_day is None else last_day
    if isinstance(last_day, Column):
        last, end = last_day.cast("date"), F.date_add(last_day.cast("date"), 1).cast("timestamp")
    else:
        last = F.lit(str(_as_date(last_day))).cast("date")
        end = F.lit(str(_as_date(last_day) + dt.timedelta(days=1))).cast("date").cast("timestamp")
    ts = F.col(ts_col)
    sliced = points.filter((ts >= _day_start(first_day)) & (ts < end))
    if "day" in points.columns:
        return sliced.filter((F.col("day") >= _day_start(first_day).cast("date")) & (F.col("day") <= last))
    return sliced.withColumn("day", F.to_date(ts))


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def with_day(points: DataFrame, ts_col: str = "ts") -> DataFrame:
    return points if "day" in points.columns else points.withColumn("day", F.to_date(F.col(ts_col)))


# --------------------------------------------------------------------------- M4
def keep_service_labels(df: DataFrame) -> DataFrame:
    """Drop NULL / empty labels and platform-API endpoint labels."""
    label, prefix = F.col("label"), F.col("prefix")
    return df.filter(label.isNotNull() & (label != "")
                     & ~((prefix == C.ENDPOINTS_PREFIX) & label.endswith(C.PLATFORM_API_SUFFIX)))


def service_key(df: DataFrame) -> DataFrame:
    """``prefix--label`` service key, after dropping labels that are not services."""
    return keep_service_labels(df).withColumn("service_name", F.concat_ws("--", "prefix", "label"))


# --------------------------------------------------------------------------- M3
def _project_label() -> Column:
    p = F.try_element_at(F.col("resource_labels"), F.lit("project_id"))
    return F.when(p != "", p)


def daily_request_counts(points: DataFrame, sources=None) -> DataFrame:
    """Per UTC day, source, service label and response-code class: summed request deltas.

    Output: day, prefix, label, response_code_class, request_count, project_id (the
    greatest non-empty ``project_id`` resource label seen in the group).

    Level 1 runs over the raw points with the project label as a grouping key and only a
    numeric buffer (hash aggregate with map-side partial aggregation); level 2 takes the
    greatest project over the few level-1 rows of each group.
    """
    p = with_day(attach_sources(points, sources, COUNTS))
    keys = ["day", "prefix", "label", "response_code_class"]
    level1 = (p.withColumn("response_code_class",
                           F.try_element_at(F.col("metric_labels"), F.lit("response_code_class")))
              .withColumn("_project", _project_label())
              .groupBy(*keys, "_project")
              .agg(F.sum("int64_value").alias("request_count")))
    return (level1.groupBy(*keys)
            .agg(F.sum("request_count").alias("request_count"), F.max("_project").alias("project_id")))


# --------------------------------------------------------------------------- M5
def _class_sums(cls: Column, value: Column) -> list[Column]:
    cls = F.coalesce(cls, F.lit(C.DEFAULT_RESPONSE_CLASS))
    is5 = cls.startswith("5")
    is4 = ~is5 & cls.startswith("4")
    return [
        F.coalesce(F.sum(value), F.lit(0)).cast("long").alias("total_requests"),
        F.coalesce(F.sum(F.when(is5, value)), F.lit(0)).cast("long").alias("error_5xx_requests"),
        F.coalesce(F.sum(F.when(is4, value)), F.lit(0)).cast("long").alias("error_4xx_requests"),
    ]


def response_class_rollup(keyed_counts: DataFrame) -> DataFrame:
    """Service-keyed class counts (M3 + M4 rows) -> per (day, service) totals.

    A missing class counts as 2xx; a class starting with 5 / 4 counts as 5xx / 4xx.
    Grouped on exactly (day, service_name); prefix/label are determined by the key.
    """
    return (keyed_counts.groupBy("day", "service_name")
            .agg(F.max("prefix").alias("prefix"), F.max("label").alias("label"),
                 *_class_sums(F.col("response_code_class"), F.col("request_count")),
                 F.max("project_id").alias("project_id")))


def daily_service_counts(points: DataFrame, sources=None) -> DataFrame:
    """M3 + M4 + M5 in two aggregation levels.

    Level 1 runs over the raw points with only numeric buffers (string columns are
    grouping keys), so it is a hash aggregate with map-side partial aggregation: a hot
    service costs one row per map task. Level 2 reduces the few (day, service, project)
    rows to one row per (day, service_name), the key the latency side is also grouped
    on, so the merge join reuses the partitioning.
    """
    p = service_key(with_day(attach_sources(points, sources, COUNTS)))
    cls = F.try_element_at(F.col("metric_labels"), F.lit("response_code_class"))
    level1 = (p.withColumn("_project", _project_label())
              .groupBy("day", "service_name", "prefix", "label", "_project")
              .agg(*_class_sums(cls, F.col("int64_value"))))
    return (level1.groupBy("day", "service_name")
            .agg(F.max("prefix").alias("prefix"), F.max("label").alias("label"),
                 *[F.sum(c).cast("long").alias(c)
                   for c in ("total_requests", "error_5xx_requests", "error_4xx_requests")],
                 F.max("_project").alias("project_id")))


# --------------------------------------------------------------------------- M6
def _series_key() -> Column:
    """128-bit digest of what makes a series: its metric type and both label sets. Entries
    are sorted, so that map order does not matter; the digest is what is shuffled."""
    parts = [F.col("metric_type")] + [F.array_sort(F.map_entries(F.coalesce(F.col(c), F.create_map())))
                                      for c in ("resource_labels", "metric_labels")]
    return F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("series"), *parts).alias("h2"))


SERIES_KEYS = ["day", "service_name", "prefix", "label", "_series"]


def daily_latency_percentiles(points: DataFrame, sources=None,
                              percentiles: dict[str, float] | None = None,
                              method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Daily latency percentiles per service: align (percentile per series and day),
    then reduce (same percentile across the service's series), then scale to ms.

    ``percentiles`` maps output column -> p, default p50 and p95; all are computed in
    the same passes. With none (``{}``) only the services seen are returned. Methods:

    - ``exact`` (default): linear interpolation between closest ranks by
      :func:`svcvitals.operators.quantiles.exact_percentiles`, which splits a hot
      series-day over many tasks. Each of the two levels writes its distinct values once.
    - ``builtin``: Spark's ``percentile``, the same results; one task holds a group's
      distinct values.
    - ``approx``: ``percentile_approx`` (fixed-size mergeable sketch per group).
    """
    percentiles = {"latency_p50": 0.5, "latency_p95": 0.95} if percentiles is None else percentiles
    names = list(percentiles)
    p = service_key(with_day(attach_sources(points, sources, LATENCY)))
    if not percentiles:
        return (p.groupBy("day", "service_name", "prefix", "label").agg(F.count(F.lit(1)))
                .groupBy("day", "service_name").agg(F.max("prefix").alias("prefix"), F.max("label").alias("label")))
    p = p.select("day", "service_name", "prefix", "label", "latency_scale", "double_value", _series_key().alias("_series"))
    scale = [F.max("latency_scale").alias("latency_scale")]
    if method != "exact":
        if method not in ("builtin", "approx"):
            raise ValueError(f"unknown percentile method {method!r}")

        def pct(col, q):
            return F.percentile(col, q) if method == "builtin" else F.percentile_approx(col, q, accuracy)
        per_series = p.groupBy(*SERIES_KEYS).agg(*scale, *[pct("double_value", q).alias(f"_s_{n}") for n, q in percentiles.items()])
        return (per_series.groupBy("day", "service_name")
                .agg(F.max("prefix").alias("prefix"), F.max("label").alias("label"),
                     *[(pct(f"_s_{n}", q) * F.max("latency_scale")).alias(n) for n, q in percentiles.items()]))
    per_series = exact_percentiles(p, SERIES_KEYS, "double_value", {f"_s_{n}": q for n, q in percentiles.items()}, extra=scale)
    # one row per (series, percentile name): each name is reduced over its own values
    long = per_series.select("day", "service_name", "prefix", "label", "latency_scale", F.inline(F.array(
        *[F.struct(F.lit(n).alias("_q"), F.col(f"_s_{n}").alias("_sv")) for n in names])))
    across = exact_percentiles(long, ["day", "service_name", "prefix", "label", "_q"], "_sv", percentiles, extra=scale)
    return (across.groupBy("day", "service_name")
            .agg(F.max("prefix").alias("prefix"), F.max("label").alias("label"),
                 *[F.max(F.when(F.col("_q") == n, F.col(n) * F.col("latency_scale"))).alias(n)
                   for n in names]))


def daily_latency_percentile(points: DataFrame, sources, p: float,
                             name: str | None = None, method: str = "exact") -> DataFrame:
    """Single-percentile form of :func:`daily_latency_percentiles`."""
    name = name or f"latency_p{int(round(p * 100))}"
    return daily_latency_percentiles(points, sources, {name: p}, method=method)


# --------------------------------------------------------------------------- M7
def merge_counts_latency(counts: DataFrame, latencies: DataFrame) -> DataFrame:
    """Full outer merge on (day, service_name): a service seen on either side gets a
    row; missing counts -> 0, missing latencies -> NULL; a missing project stays NULL
    here and becomes ``unknown`` in :func:`project_attribution`.

    Both inputs are aggregated on exactly (day, service_name), so the join reuses that
    partitioning (no extra exchange).
    """
    lat_cols = [c for c in latencies.columns if c not in ("day", "service_name", "prefix", "label")]
    l = latencies.select("day", "service_name", F.col("prefix").alias("_lp"), F.col("label").alias("_ll"),
                         *lat_cols)
    m = counts.join(l, ["day", "service_name"], "full")
    return m.select(
        "day", "service_name",
        F.coalesce("prefix", "_lp").alias("prefix"), F.coalesce("label", "_ll").alias("label"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
          for c in ("total_requests", "error_5xx_requests", "error_4xx_requests")],
        F.col("project_id").alias("project_id"),
        *lat_cols)


# --------------------------------------------------------------------------- M8
def host_projects(counts: DataFrame) -> DataFrame:
    """Daily counts with the backfill's project rule: for endpoint services whose label
    holds ``.endpoints.``, the project is the text between ``.endpoints.`` and
    ``.cloud.goog`` (none when that text is empty); other services keep their label's.

    Applied to the counts, before the merge: a service seen only by its latencies gets no
    project from its host.
    """
    host_rule = (F.col("prefix") == C.ENDPOINTS_PREFIX) & F.col("label").contains(".endpoints.")
    host_pid = F.substring_index(F.split(F.col("label"), r"\.endpoints\.").getItem(1), ".cloud.goog", 1)
    return counts.withColumn("project_id", F.when(host_rule, F.when(host_pid != "", host_pid)).otherwise(F.col("project_id")))


def project_attribution(merged: DataFrame) -> DataFrame:
    """Resolve ``project_id``: the project the counts gave (greatest non-empty label stands
    in for "last seen", or :func:`host_projects`), else ``unknown``."""
    return merged.withColumn("project_id", F.coalesce("project_id", F.lit(C.UNKNOWN_PROJECT)))


# --------------------------------------------------------------------------- M10
def stored_availability(df: DataFrame) -> DataFrame:
    """(total - 5xx) / total rounded to 4 places as Python rounds; 1.0 when no requests."""
    t, e5 = F.col("total_requests"), F.col("error_5xx_requests")
    return df.withColumn("availability_ratio",
                         F.when(t == 0, F.lit(1.0)).otherwise(py_round((t - e5) / t, 4)))


# --------------------------------------------------------------------------- M9
def _stored_latency(df: DataFrame, c: str) -> Column:
    v = F.col(c) if c in df.columns else F.lit(None).cast("double")
    return F.when(v.isNull() | (v == 0), F.lit(None).cast("double")).otherwise(py_round(v, 2))


def raw_metrics_rows(df: DataFrame, ingested_at, archetype: str = C.DEFAULT_ARCHETYPE) -> DataFrame:
    """Shape merged daily rows into the ``raw_metrics`` layout.

    ``ingested_at`` (string / Column) becomes ``timestamp``; latencies are rounded to 2
    places, and zero or missing latencies are stored as NULL. ``availability_ratio`` is
    kept if present (backfill) else NULL (daily job).
    """
    ts = ingested_at if isinstance(ingested_at, Column) else F.lit(str(ingested_at)).cast("timestamp")
    avail = (F.col("availability_ratio") if "availability_ratio" in df.columns
             else F.lit(None).cast("double"))
    e5, e4 = F.col("error_5xx_requests"), F.col("error_4xx_requests")
    return df.select(
        ts.alias("timestamp"),
        F.date_format("day", "yyyy-MM-dd").alias("target_date"),
        "project_id", "service_name",
        F.lit(archetype).alias("archetype"),
        avail.alias("availability_ratio"),
        "total_requests", "error_5xx_requests", "error_4xx_requests",
        (e5 + e4).alias("total_errors"),
        _stored_latency(df, "latency_p50").alias("latency_p50_ms"),
        _stored_latency(df, "latency_p95").alias("latency_p95_ms"),
    )


# --------------------------------------------------------------------------- M11 / M12
def _daily_rollup(points: DataFrame, sources, mode: str, method: str, latency: bool = True) -> DataFrame:
    counts = daily_service_counts(points, sources)
    if mode == "host":
        counts = host_projects(counts)
    lat = daily_latency_percentiles(points, sources, None if latency else {}, method=method)
    return project_attribution(merge_counts_latency(counts, lat))


def ingest_day(points: DataFrame, sources, as_of, ingested_at=None,
               method: str = "exact") -> DataFrame:
    """The daily job: yesterday (relative to ``as_of``) rolled up into raw_metrics rows."""
    day = (F.date_sub(as_of, 1) if isinstance(as_of, Column) else _as_date(as_of) - dt.timedelta(days=1))
    sliced = day_slice(points, day, day)
    ingested_at = F.current_timestamp() if ingested_at is None else ingested_at
    return raw_metrics_rows(_daily_rollup(sliced, sources, "label", method), ingested_at)


def backfill(points: DataFrame, sources, as_of, start_days_ago: int = 1,
             end_days_ago: int = 51, ingested_at=None, method: str = "exact",
             latency: bool = True) -> DataFrame:
    """Every day from ``as_of - end_days_ago`` to ``as_of - start_days_ago`` inclusive,
    grouped by day, with host project attribution and the stored availability ratio.
    Without ``latency`` the same rows come with NULL latencies and no percentile is computed."""
    if isinstance(as_of, Column):
        first, last = F.date_sub(as_of, end_days_ago), F.date_sub(as_of, start_days_ago)
    else:
        first = _as_date(as_of) - dt.timedelta(days=end_days_ago)
        last = _as_date(as_of) - dt.timedelta(days=start_days_ago)
    sliced = day_slice(points, first, last)
    ingested_at = F.current_timestamp() if ingested_at is None else ingested_at
    rolled = stored_availability(_daily_rollup(sliced, sources, "host", method, latency))
    return raw_metrics_rows(rolled, ingested_at)


REQUIRED = ("timestamp", "target_date", "service_name")


def _fitting(rows: DataFrame) -> DataFrame:
    """Rows with the columns of ``schemas.RAW_METRICS`` in order; others are refused."""
    want = {f.name: f.dataType for f in S.RAW_METRICS.fields}
    have = {f.name: f.dataType for f in rows.schema.fields}
    if want != have:
        raise ValueError(f"raw_metrics rows do not fit the table: {sorted(set(want.items()) ^ set(have.items()), key=str)}")
    return rows.select(*[F.coalesce(c, F.raise_error(F.lit(f"raw_metrics.{c} is required"))).alias(c) if c in REQUIRED else F.col(c) for c in want])


def append_raw_metrics(rows: DataFrame, path: str) -> None:
    """Append rows to the raw_metrics table, partitioned by ``target_date``.

    The rows' columns and types must be those of ``schemas.RAW_METRICS``, and a NULL in a
    required column fails the write. Re-running a day appends its rows again (the stored
    table keeps duplicates).
    """
    _fitting(rows).write.mode("append").partitionBy("target_date").parquet(path)


def replace_raw_metrics(rows: DataFrame, path: str, days) -> dict[str, int]:
    """Write rows as all that raw_metrics holds of ``days``, each marked when complete
    (:class:`svcvitals.sources.commits.DayCommits`): re-running a day adds nothing."""
    return DayCommits(rows.sparkSession, path).replace(_fitting(rows), days)
