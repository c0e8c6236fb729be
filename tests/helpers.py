import datetime as dt

from pyspark.sql import functions as F

from svcvitals import schemas as S

EVENT_SCHEMA = ("publish_time timestamp, status string, service_name string, environment string, "
                "is_rollback boolean, event_category string")


def raw_metrics_df(spark, rows):
    """rows: dicts with raw_metrics fields; missing fields -> NULL."""
    names = [f.name for f in S.RAW_METRICS.fields]
    data = []
    for r in rows:
        r = dict(r)
        r.setdefault("timestamp", dt.datetime(2026, 8, 1, 1, 0))
        r.setdefault("target_date", "2026-07-31")
        r.setdefault("archetype", "sync")
        data.append(tuple(r.get(n) for n in names))
    schema = S.RAW_METRICS
    schema = type(schema)([type(f)(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame(data, schema)


def events_df(spark, rows):
    """rows: (publish_time, status, service_name, is_rollback)."""
    data = [(t, s, svc, None, rb, None) for t, s, svc, rb in rows]
    return spark.createDataFrame(data, EVENT_SCHEMA)


def ts(d: dt.date, h: int = 12):
    return dt.datetime(d.year, d.month, d.day, h)


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def approx(a, b, tol=1e-9):
    return a is not None and b is not None and abs(a - b) <= tol


__all__ = ["F"]
