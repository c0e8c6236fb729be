"""Latency sketches: one mergeable quantile sketch per series and day, kept as a table.

Exact percentiles of a month need the month's points again. A sketch table is written once a
day and answers any longer window: sketches of a bounded size are merged over series and
days, with partial merges before the shuffle, and no point is read again. The answers are
approximate in rank: see :func:`rank_error`. Unlike the stacked views' daily percentile
(a percentile of the series' percentiles) a merged window is the percentile of all samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from svcvitals.operators.metrics import LATENCY, SERIES_KEYS, _series_key, attach_sources, service_key, with_day

#: Items a sketch keeps at its top level: 0.7 % rank error.
SKETCH_K = 400
SKETCH_SCHEMA = T.StructType([
    T.StructField("day", T.DateType()), T.StructField("service_name", T.StringType()),
    T.StructField("series", T.StringType()), T.StructField("n", T.LongType()), T.StructField("sketch", T.BinaryType())])


def rank_error(k: int = SKETCH_K) -> float:
    """How far, as a share of all samples, the rank of an answer lies from the rank asked
    for, with 99 % confidence (the sketch family's published fit for single quantiles)."""
    return 2.296 / k ** 0.9723


def latency_samples(points: DataFrame, sources=None) -> DataFrame:
    """Every latency sample in milliseconds with its day, service and series. Samples that
    are null or not a number are none."""
    p = service_key(with_day(attach_sources(points, sources, LATENCY)))
    ms = F.col("double_value") * F.col("latency_scale")
    return p.filter(F.col("double_value").isNotNull() & ~F.isnan("double_value")).select(
        *SERIES_KEYS[:2], _series_key().alias("_series"), ms.alias("ms"))


def daily_sketches(points: DataFrame, sources=None, k: int = SKETCH_K) -> DataFrame:
    """day, service_name, series, n, sketch: one row per series and day."""
    series = F.concat_ws("-", F.hex("_series.h1"), F.hex("_series.h2"))
    return (latency_samples(points, sources).groupBy("day", "service_name", "_series")
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("ms", k).alias("sketch"))
            .select("day", "service_name", series.alias("series"), "n", "sketch"))


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Store sketches by day; days that are there already are replaced."""
    (sketches.repartition("day", F.pmod(F.xxhash64("series"), F.lit(8))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SKETCH_SCHEMA).parquet(path)


def _answers(merged: DataFrame, keys: list[str], percentiles: dict[str, float]) -> DataFrame:
    return merged.select(*keys, "n", *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(c) for c, p in percentiles.items()])


def _merge(sketches: DataFrame, *keys) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


PERCENTILES = {"latency_p50": 0.5, "latency_p95": 0.95}


def window_percentiles(sketches: DataFrame, window: Column | None = None, percentiles: dict[str, float] | None = None) -> DataFrame:
    """window, service_name, n and percentiles in ms over all series of a window of days.
    ``window`` maps a day to its window; default the week's Monday."""
    window = F.to_date(F.date_trunc("week", "day")) if window is None else window
    return _answers(_merge(sketches, window.alias("window"), "service_name"), ["window", "service_name"], percentiles or PERCENTILES)


def rolling_percentiles(sketches: DataFrame, days: int = 28, percentiles: dict[str, float] | None = None) -> DataFrame:
    """day, service_name, n and percentiles of the ``days`` days that end on each day that
    has samples. Series are merged per day first, so a service sends ``days`` sketches a day."""
    daily = _merge(sketches, "day", "service_name")
    ends = F.explode(F.sequence("day", F.date_add("day", days - 1))).alias("end")
    spread = daily.select("service_name", "n", "sketch", ends)
    seen = daily.select(F.col("day").alias("end"), "service_name")
    merged = _merge(spread.join(seen, ["end", "service_name"], "left_semi"), "end", "service_name")
    return _answers(merged.withColumnRenamed("end", "day"), ["day", "service_name"], percentiles or PERCENTILES)


def measured_rank_error(answers: DataFrame, samples: DataFrame, percentiles: dict[str, float] | None = None) -> DataFrame:
    """window, service_name, n and per percentile the measured rank error ``<name>_error``:
    the share of samples between the rank asked for and the ranks that the answer's value
    takes. ``samples`` has window, service_name, ms."""
    percentiles = percentiles or PERCENTILES
    held = answers.select("window", "service_name", *percentiles)
    counts = [F.count(F.lit(1)).alias("n")]
    for c in percentiles:
        counts += [F.count_if(F.col("ms") < F.col(c)).alias(f"{c}_below"), F.count_if(F.col("ms") <= F.col(c)).alias(f"{c}_upto")]
    ranked = samples.join(held, ["window", "service_name"]).groupBy("window", "service_name").agg(*counts)
    errors = [F.greatest(F.col(f"{c}_below") / F.col("n") - F.lit(p), F.lit(p) - F.col(f"{c}_upto") / F.col("n"), F.lit(0.0)).alias(f"{c}_error")
              for c, p in percentiles.items()]
    return ranked.select("window", "service_name", "n", *errors)
