"""Distribution-valued latencies: bucket histograms per point instead of scalar samples.

Input points (``schemas.DISTRIBUTION_POINTS``) hold ``bucket_counts`` and the layout of their
buckets: explicit bounds, or exponential (scale * growth ^ i) or linear (offset + width * i)
ones. Bucket 0 lies below the first bound, the last one above the last; counts behind the
last bucket that holds any may be left out.

A series' points of one day are merged by adding up equal buckets (one row per series, day
and bucket, with map-side combine, whatever the number of points). A percentile is where the
merged distribution reaches the share p of its count, a bucket's count being spread evenly
over it. Points of one day may have different layouts: all bounds cut the axis into segments
and every bucket gives each segment its share, so equal layouts are the case in which each
segment is a bucket. What lies below the first bound spreads from zero (or lies at a first
bound that is not above zero), what lies above the last bound lies at it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from svcvitals.operators import metrics as M
from svcvitals.operators.quantiles import exact_percentiles

EXPLICIT, EXPONENTIAL, LINEAR = "explicit", "exponential", "linear"


def bucket_bounds(layout: Column) -> Column:
    """The finite bounds of a layout, in order; NULL for a layout without a known kind."""
    kind, n = layout["kind"], layout["num_finite_buckets"]
    steps = F.when(n >= 0, F.sequence(F.lit(0), n))
    return (F.when(kind == EXPLICIT, layout["bounds"])
            .when(kind == EXPONENTIAL, F.transform(steps, lambda i: layout["scale"] * F.pow(layout["growth_factor"], i.cast("double"))))
            .when(kind == LINEAR, F.transform(steps, lambda i: layout["offset"] + layout["width"] * i.cast("double"))))


def buckets(points: DataFrame, keep: list[str]) -> DataFrame:
    """Kept columns, lo, hi, n: one row per bucket of a point that holds any count. Points
    without a layout or counts have none; counts that are not above zero are left out."""
    bounded = points.select(*keep, bucket_bounds(F.col("layout")).alias("_bounds"), F.posexplode("bucket_counts").alias("_i", "n"))
    bounds, i = F.col("_bounds"), F.col("_i")
    last = F.size(bounds)
    first = F.element_at(bounds, 1)
    lower = F.when(i == 0, F.least(F.lit(0.0), first)).when(i <= last, F.try_element_at(bounds, i)).otherwise(F.try_element_at(bounds, last))
    upper = F.when(i < last, F.try_element_at(bounds, i + 1)).otherwise(F.try_element_at(bounds, last))
    # below a first bound that is not above zero: at that bound
    lower = F.when((i == 0) & (first <= 0), first).otherwise(lower)
    return (bounded.filter((F.col("n") > 0) & (last > 0)).select(*keep, lower.alias("lo"), upper.alias("hi"), F.col("n").cast("long").alias("n")))


def merged_buckets(points: DataFrame, keys: list[str], extra: list[Column] | None = None) -> DataFrame:
    """Per group of ``keys``: equal buckets added up, as an array of (lo, hi, n) in order. A
    group's array is as long as its layouts have buckets, whatever its number of points."""
    names = keys + [c for c in ("latency_scale",) if c in points.columns and c not in keys]
    added = buckets(points, names).groupBy(*keys, "lo", "hi").agg(F.sum("n").alias("n"), *(extra or []))
    others = [c for c in added.columns if c not in (*keys, "lo", "hi", "n")]
    return added.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "n"))).alias("buckets"), *[F.max(c).alias(c) for c in others])


def segments(merged: Column) -> Column:
    """The axis cut at every bound: (lo, hi, mass) in order, segments of no width for what
    lies at one place. Sums run over buckets in order, so they do not depend on the plan."""
    zero = F.lit(0.0)
    edges = F.array_sort(F.array_distinct(F.flatten(F.transform(merged, lambda b: F.array(b["lo"], b["hi"])))))

    def at(e: Column) -> Column:
        here = F.aggregate(merged, zero, lambda s, b: s + F.when((b["lo"] == e) & (b["hi"] == e), b["n"].cast("double")).otherwise(zero))
        return F.struct(e.alias("lo"), e.alias("hi"), here.alias("mass"))

    def between(i: Column) -> Column:
        lo, hi = F.element_at(edges, i), F.element_at(edges, i + 1)
        share = F.aggregate(merged, zero, lambda s, b: s + F.when(
            (b["lo"] <= lo) & (b["hi"] >= hi) & (b["lo"] < b["hi"]), b["n"].cast("double") * ((hi - lo) / (b["hi"] - b["lo"]))).otherwise(zero))
        return F.struct(lo.alias("lo"), hi.alias("hi"), share.alias("mass"))

    spans = F.when(F.size(edges) > 1, F.transform(F.sequence(F.lit(1), F.size(edges) - 1), between)).otherwise(
        F.array().cast("array<struct<lo:double,hi:double,mass:double>>"))
    return F.filter(F.array_sort(F.concat(F.transform(edges, at), spans)), lambda s: s["mass"] > 0)


def quantile(segs: Column, total: Column, p: float) -> Column:
    """Where the segments' running mass reaches p * total: linear within a segment."""
    rank = total.cast("double") * F.lit(float(p))
    start = F.struct(F.lit(0.0).alias("before"), F.lit(None).cast("double").alias("value"))

    def step(state: Column, s: Column) -> Column:
        after = state["before"] + s["mass"]
        found = s["lo"] + ((rank - state["before"]) / s["mass"]) * (s["hi"] - s["lo"])
        return F.struct(after.alias("before"), F.when(state["value"].isNull() & (after >= rank), found).otherwise(state["value"]).alias("value"))

    # rounding may leave the last sum a hair below the total: then the last bound counts
    return F.coalesce(F.aggregate(segs, start, step)["value"], F.element_at(segs, -1)["hi"])


def histogram_percentiles(points: DataFrame, keys: list[str], percentiles: dict[str, float], extra: list[Column] | None = None) -> DataFrame:
    """Per group of ``keys``: ``n`` (its count), extra columns, one column per percentile."""
    merged = merged_buckets(points, keys, extra)
    others = [c for c in merged.columns if c not in (*keys, "buckets")]
    total = F.aggregate("buckets", F.lit(0).cast("long"), lambda s, b: s + b["n"])
    cut = merged.select(*keys, *others, total.alias("n"), segments(F.col("buckets")).alias("_segments"))
    return cut.select(*keys, *others, "n", *[quantile(F.col("_segments"), F.col("n"), p).alias(c) for c, p in percentiles.items()])


def daily_histogram_percentiles(points: DataFrame, sources=None, percentiles: dict[str, float] | None = None, across: str = "series") -> DataFrame:
    """Daily latency percentiles per service of distribution points, in milliseconds: day,
    service_name, prefix, label and one column per percentile (default p50 and p95), as
    :func:`svcvitals.operators.metrics.daily_latency_percentiles` gives for scalar samples,
    so that the result joins the counts in ``merge_counts_latency``.

    ``across='series'`` aligns each series by itself and reduces the series' values by the
    same percentile; ``across='merged'`` merges the buckets of all series of a service first.
    """
    percentiles = {"latency_p50": 0.5, "latency_p95": 0.95} if percentiles is None else percentiles
    p = M.service_key(M.with_day(M.attach_sources(points, sources, M.LATENCY)))
    scale = [F.max("latency_scale").alias("latency_scale")]
    service = ["day", "service_name", "prefix", "label"]
    if across == "merged":
        found = histogram_percentiles(p, service, percentiles, scale)
        return found.select(*service, *[(F.col(c) * F.col("latency_scale")).alias(c) for c in percentiles])
    if across != "series":
        raise ValueError(f"unknown way across series {across!r}")
    p = p.withColumn("_series", M._series_key())
    per_series = histogram_percentiles(p, M.SERIES_KEYS, percentiles, scale)
    long = per_series.select(*service, "latency_scale", F.inline(F.array(*[F.struct(F.lit(c).alias("_q"), F.col(c).alias("_sv")) for c in percentiles])))
    reduced = exact_percentiles(long, [*service, "_q"], "_sv", percentiles, extra=scale)
    return reduced.groupBy(*service).agg(*[F.max(F.when(F.col("_q") == c, F.col(c) * F.col("latency_scale"))).alias(c) for c in percentiles])
