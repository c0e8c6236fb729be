"""The observability survey sheet: CSV files with a fixed 12-column string schema
whose first two records (title + header) are not data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from svcvitals import config as C, schemas as S


def read_survey(spark: SparkSession, path: str, skip_leading_rows: int = C.SURVEY_LEADING_ROWS) -> DataFrame:
    """Read every CSV file under ``path`` with the survey schema (no inference),
    dropping the first ``skip_leading_rows`` records of each file.

    Records follow RFC 4180 as sheet exports write it: a quoted cell may hold line breaks,
    and a quote inside it is doubled. Blank lines are no records. A file is read by one
    task (a record may span any line), files in parallel; a task numbers its records in
    file order, and the smallest number of each file (one row per file) tells which lead.
    """
    records = (spark.read.schema(S.SURVEY).option("multiLine", True).option("escape", '"').option("mode", "PERMISSIVE").csv(path)
               .select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_id")))
    firsts = records.groupBy("_file").agg(F.min("_id").alias("_first"))
    return (records.join(firsts, "_file").filter(F.col("_id") >= F.col("_first") + F.lit(skip_leading_rows))
            .select(*[f.name for f in S.SURVEY.fields]))


def _csv_field(c: Column) -> Column:
    # NULL -> empty unquoted field; any value -> quoted, quotes doubled (spaces kept).
    return F.when(c.isNull(), F.lit("")).otherwise(
        F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))


def write_survey(survey: DataFrame, path: str, title: str = "Observability survey") -> None:
    """Write survey rows as CSV text files, each starting with a title record, a header
    record whose first cell has a line break, and a blank line.

    Each partition becomes one file; a partition's first row carries the leading records.
    """
    header = ",".join(['"service\nname"'] + [f.name for f in S.SURVEY.fields[1:]])
    line = F.concat_ws(",", *[_csv_field(F.col(f.name)) for f in S.SURVEY.fields])
    numbered = survey.select(line.alias("value"), F.monotonically_increasing_id().alias("_id"))
    in_partition = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    numbered.select(F.when(in_partition == 0, F.concat(F.lit(f"{title}\n{header}\n\n"), "value")).otherwise(F.col("value")).alias("value")
                    ).write.mode("overwrite").text(path)
