"""Native Column helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from svcvitals.session import ship_package

#: White space of the word definitions: space and U+0009 to U+000D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def utf8(text: Column) -> Column:
    """UTF-8 bytes of a text; null is empty."""
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select input columns under the names an operator works with, so that further
    columns of the input, whatever their names, never clash with its own."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in columns.items()])


#: Bytes of an Arrow batch that a Python task takes at once.
BATCH_BYTES = 16 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The session, ready for the operators: its Python workers have this package, and Arrow
    batches hold at most BATCH_BYTES (one longer row makes a batch of its own), so that what
    a worker holds does not depend on the documents' lengths."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


__all__ = ["WORD_PATTERN", "utf8", "word_count", "pick", "prepared"]
