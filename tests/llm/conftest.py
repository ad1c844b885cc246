import datetime as dt

import pytest
from pyspark import cloudpickle

import payscore.llm

# As the driver file does; what a test sets in a module then holds in tasks too.
cloudpickle.register_pickle_by_value(payscore.llm)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, _row string, _text string, when date"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text, lang, source), with columns whose names the operators use too."""

    def make(rows, parts=3):
        full = [(*r, *[None] * (4 - len(r)), len(r[1] or ""), 7, "x", "y", "z", dt.date(2020, 1, 2)) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """Given documents, with a few odd ones."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    return [*rows, (-1, None, None, None), (-2, "", "en", "a"), (None, rows[3][1], "en", None), (None, rows[3][1], "en", None), rows[5], (10**12, "word " * 30_000, "xx", "b")]
