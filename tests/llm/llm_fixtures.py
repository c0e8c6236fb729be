"""Rows with the cases every operator must take."""

import os
import tempfile

import pytest


@pytest.fixture()
def table(spark):
    """Rows -> a stored table of two files, as operators read them."""
    def make(rows, schema, files=2):
        path = os.path.join(tempfile.mkdtemp(prefix="svcvitals-llm-"), "t.parquet")
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
        return spark.read.parquet(path)
    return make


#: Texts that every operator must take: null, empty, blank, long, non-ASCII, repeated.
ODD_TEXTS = [None, "", " \n\t", "word", "a b c", "é ñ 漢字 😀", "x" * 5000, "the same line of text here\n" * 400,
             "repeat me exactly please now", "repeat me exactly please now", "\x00\x1c odd \u00a0 blanks \u2028 here"]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, rate double, n long, codes string, size long"


def odd_docs():
    """Rows with nulls in any column, ties, repeats and columns that clash with operators' own."""
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 2}", None, 0.5, 1, None, i, "c", 3) for i, t in enumerate(ODD_TEXTS)]
    return rows + [rows[4], rows[8]]
