"""Commit marks for a table partitioned by day, so that a day can be written again.

A mark is a row (day, state, run, rows, marked_at) appended to a small Parquet table beside
the data. A day is committed when its newest mark says so; a run that dies between its two
marks leaves the day open, readers of committed days pass it over, and the next run writes
it anew. The driver handles marks and days only, never the table's rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

BEGUN, DONE = "begun", "done"
_MARKS = "day string, state string, run string, rows long, marked_at timestamp"


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop


class DayCommits:
    """The marks of the table at ``path``, whose partition column is ``day_col``."""

    def __init__(self, spark: SparkSession, path: str, day_col: str = "target_date"):
        self.spark, self.path, self.day_col = spark, path.rstrip("/"), day_col
        self.marks_path = self.path + "_commits"

    def _mark(self, state: str, run: str, rows: dict[str, int | None]) -> None:
        now = dt.datetime.now(dt.timezone.utc)
        marks = [(day, state, run, n, now) for day, n in sorted(rows.items())]
        self.spark.createDataFrame(marks, _MARKS).coalesce(1).write.mode("append").parquet(self.marks_path)

    def marks(self) -> DataFrame:
        """The newest mark of each day."""
        fs, path = _fs(self.spark, self.marks_path)
        if not fs.exists(path):
            return self.spark.createDataFrame([], _MARKS)
        # a run's two marks may share a moment: the later state of it counts
        rank = F.struct("marked_at", F.when(F.col("state") == DONE, 1).otherwise(0))
        newest = F.max_by(F.struct("state", "run", "rows", "marked_at"), rank).alias("m")
        return self.spark.read.schema(_MARKS).parquet(self.marks_path).groupBy("day").agg(newest).select("day", "m.*")

    def committed(self) -> list[str]:
        return sorted(r.day for r in self.marks().filter(F.col("state") == DONE).select("day").collect())

    def missing(self, days: Iterable) -> list[str]:
        """Those of ``days`` that are not committed."""
        done = set(self.committed())
        return [d for d in sorted(str(x) for x in days) if d not in done]

    def replace(self, rows: DataFrame, days: Iterable) -> dict[str, int]:
        """Write ``rows`` as all that the table holds of ``days``; other days stay as they
        are. Rows of other days are an error. A day without rows becomes empty. Returns the
        rows of each day. Running it again, also after a crash at any point, gives the
        same table."""
        days = sorted({str(d) for d in days})
        if not days:
            return {}
        run = uuid.uuid4().hex
        stray = F.raise_error(F.lit(f"a row of another {self.day_col} than those replaced"))
        rows = rows.withColumn(self.day_col, F.when(F.col(self.day_col).cast("string").isin(days), F.col(self.day_col)).otherwise(stray))
        seen = Observation()
        observed = rows.observe(seen, F.collect_set(self.day_col).alias("days"))
        self._mark(BEGUN, run, dict.fromkeys(days))
        (observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.day_col).parquet(self.path))
        for day in set(days) - set(map(str, seen.get["days"])):  # the write left its folder as it was
            fs, folder = _fs(self.spark, f"{self.path}/{self.day_col}={day}")
            fs.delete(folder, True)
        found = self._stored(days, rows.schema)
        self._mark(DONE, run, found)
        return found

    def _stored(self, days: list[str], schema) -> dict[str, int]:
        fs, path = _fs(self.spark, self.path)
        table = self.spark.read.schema(schema).parquet(self.path) if fs.exists(path) else self.spark.createDataFrame([], schema)
        day = F.col(self.day_col)
        counted = table.filter(day.isin(days)).groupBy(day.cast("string").alias("day")).count().collect()
        return dict.fromkeys(days, 0) | {r["day"]: r["count"] for r in counted}

    def read(self, schema) -> DataFrame:
        """The rows of committed days; the filter on days reaches the folder listing."""
        days = self.committed()
        fs, path = _fs(self.spark, self.path)
        if not days or not fs.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path).filter(F.col(self.day_col).isin(days))
