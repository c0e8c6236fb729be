"""Delivery and composite scores as they stood on each day.

The stacked views know one "today". Here every (service, archetype, day) row of a grid gets
the delivery facts of the six months that end on its own day: what the views would have
shown, had they been read that evening. Events of later days play no part, and each event
counts once.

No grid day is joined to the events of its window. Events become one partial aggregate per
service and day; each grid day asks the service's timeline at three places (its own day, the
day before its window, the day before its rollback window), and running aggregates over the
timeline answer them: counts as differences of running sums, latest successes as running
maxima that lie inside the window or not. A timeline holds at most a row per calendar day
plus three per grid day, however many events a service has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from svcvitals import config as C
from svcvitals.operators.scores import (
    _date, _finish_base, composite_health_scores, pipeline_scores_from_base,
)

MONTHS = range(1, 13)
AT_END, BEFORE_WINDOW, BEFORE_ROLLBACKS = 0, 1, 2


def _window_start(day):
    return F.add_months(day, -C.DEPLOY_WINDOW_MONTHS)


def daily_event_partials(events: DataFrame, first=None, last=None) -> DataFrame:
    """One row per service and day with events: counts, latest success. ``first`` and
    ``last`` are the grid's outermost days, if known: the events of no window are then
    left out in the scan."""
    published = F.to_date("publish_time")
    events = events.filter(F.col("service_name").isNotNull() & F.col("publish_time").isNotNull())
    if first is not None:
        events = events.filter(published >= _window_start(_date(first)))
    if last is not None:
        events = events.filter(published <= _date(last))
    ok = F.col("status").isin(C.SUCCESS_STATUSES)
    return (events.groupBy("service_name", published.alias("day"))
            .agg(F.count("publish_time").alias("n"), F.count_if(ok).alias("n_ok"),
                 F.count_if(F.col("is_rollback") == F.lit(True)).alias("n_rb"),
                 F.max(F.when(ok, F.col("publish_time"))).alias("last_ok")))


def _asks(grid: DataFrame) -> DataFrame:
    """The days on which a grid day needs its service's running aggregates."""
    day = F.col("as_of")
    places = ((AT_END, day), (BEFORE_WINDOW, F.date_sub(_window_start(day), 1)),
              (BEFORE_ROLLBACKS, F.date_sub(day, C.ROLLBACK_WINDOW_DAYS + 1)))
    asks = F.array(*[F.struct(F.lit(k).alias("place"), d.alias("day")) for k, d in places])
    return (grid.select("service_name", "as_of").filter("service_name IS NOT NULL AND as_of IS NOT NULL").distinct()
            .select("service_name", "as_of", F.inline(asks)))


def deployment_base_metrics_as_of(grid: DataFrame, events: DataFrame, epoch=C.DEFAULT_EPOCH,
                                  first=None, last=None) -> DataFrame:
    """``as_of`` and the columns of :func:`scores.deployment_base_metrics`, one row per
    distinct (service_name, archetype, as_of) of ``grid``. A service without events in a
    day's window, or of no name, has zeros and no last success."""
    timeline = daily_event_partials(events, first, last).unionByName(_asks(grid), allowMissingColumns=True)
    so_far = Window.partitionBy("service_name").orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    month_ok = [F.max(F.when((F.col("n_ok") > 0) & (F.month("day") == m), F.col("day"))).over(so_far).alias(f"ok_{m}") for m in MONTHS]
    running = timeline.select(
        "service_name", "as_of", "place",
        *[F.coalesce(F.sum(c).over(so_far), F.lit(0)).alias(c) for c in ("n", "n_ok", "n_rb")],
        F.max("last_ok").over(so_far).alias("last_ok"), *month_ok).filter("as_of IS NOT NULL")

    def at(place, c):
        return F.max(F.when(F.col("place") == place, F.col(c)))

    def since(place, c):
        return at(AT_END, c) - at(place, c)
    start = _window_start(F.col("as_of"))
    facts = running.groupBy("service_name", "as_of").agg(
        since(BEFORE_WINDOW, "n").alias("_n"), since(BEFORE_WINDOW, "n_ok").alias("_n_ok"),
        since(BEFORE_ROLLBACKS, "n_rb").alias("_n_rb"), at(AT_END, "last_ok").alias("_latest"),
        *[at(AT_END, f"ok_{m}").alias(f"ok_{m}") for m in MONTHS])
    months = sum((F.when(F.col(f"ok_{m}") >= start, F.lit(1 << m)).otherwise(F.lit(0)) for m in MONTHS), F.lit(0))
    facts = facts.select("service_name", "as_of", "_n", "_n_ok", "_n_rb", months.alias("_months"),
                         F.when(F.to_date("_latest") >= start, F.col("_latest")).alias("_last_ok"))
    groups = grid.select("service_name", "archetype", "as_of").distinct()
    return _finish_base(groups.join(facts, ["service_name", "as_of"], "left"), F.col("as_of"), epoch, F.lit(1), keep=("as_of",))


def pipeline_robustness_history(perf: DataFrame, events: DataFrame, epoch=C.DEFAULT_EPOCH,
                                first=None, last=None) -> DataFrame:
    """Pipeline robustness of every (service, archetype) of a day of ``perf``, as of that day:
    ``target_date``, ``archetype`` and the pipeline columns."""
    grid = perf.select("service_name", "archetype", F.to_date("target_date").alias("as_of"))
    base = deployment_base_metrics_as_of(grid, events, epoch, first, last)
    base = base.withColumn("target_date", F.date_format("as_of", "yyyy-MM-dd"))
    return pipeline_scores_from_base(base, keep_archetype=True, keep=("target_date",))


def composite_health_history(perf: DataFrame, obs: DataFrame | None, events: DataFrame, epoch=C.DEFAULT_EPOCH,
                             first=None, last=None) -> DataFrame:
    """Composite scores whose pipeline part is that of each row's own day. ``perf`` is read
    twice: give it stored."""
    pipe = pipeline_robustness_history(perf, events, epoch, first, last)
    return composite_health_scores(perf, obs, pipe, by_day=True)
