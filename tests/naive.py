"""The literal form of the delivery base metrics, to compare the library's with."""

from pyspark.sql import DataFrame, functions as F

from svcvitals import config as C
from svcvitals.operators.scores import _event_aggs, _finish_base, _window_events


def deployment_base_metrics_naive(perf: DataFrame, events: DataFrame, as_of=None,
                                  epoch=C.DEFAULT_EPOCH) -> DataFrame:
    """The literal form: every perf row left-joined to every windowed event of its
    service, then grouped. Rows grow as perf rows x events."""
    r = perf.select("service_name", "archetype").alias("r")
    d = _window_events(events, as_of).alias("d")
    j = r.join(d, F.col("r.service_name") == F.col("d.service_name"), "left").select(
        F.col("r.service_name").alias("service_name"), F.col("r.archetype").alias("archetype"),
        "d.publish_time", "d.status", "d.is_rollback")
    g = j.groupBy("service_name", "archetype").agg(*_event_aggs(as_of))
    return _finish_base(g, as_of, epoch, F.lit(1))
