from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, or from (doc_id, text, source); the row's number is the default id."""

    def make(rows):
        rows = [r if isinstance(r, tuple) else (i, r, "s") for i, r in enumerate(rows)]
        return spark.createDataFrame(
            [(i, t, None, s, len(t) if t is not None else None) for i, t, s in rows], DOCS
        )

    return make


@pytest.fixture(scope="session")
def small_table(spark, tmp_path_factory):
    """Write rows as a named table of a folder; returns the folder."""

    def write(**tables):
        folder = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.write.parquet(str(folder / f"{name}.parquet"))
        return str(folder)

    return write


def by_id(df, key="doc_id"):
    return {row[key]: row for row in df.collect()}
