from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return SF


@pytest.fixture(scope="session")
def rows_of(spark):
    """rows_of(name) -> the rows of a driver table as tuples of the asked columns."""

    def read(name: str, *columns: str):
        return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*columns).collect()]

    return read


@pytest.fixture(scope="session")
def database():
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.fixture(scope="session")
def odd_documents(frame):
    """Nulls in every column, empty and long texts, repeated rows, copies, and clashing extra columns."""
    long = " ".join(f"word{i % 977} of {i}" for i in range(9000))
    rows = [
        (1, None, "a", 1, 9, "x"),
        (2, "", "a", 2, 9, "x"),
        (3, " \n\t ", None, 3, 9, None),
        (None, "one two three", "b", 4, None, "y"),
        (4, long, "b", 5, 9, "y"),
        (4, long, "b", 5, 9, "y"),
        (5, long, None, 6, 9, "y"),
        (6, "a\u00a0b é \U0001f600 \x1c d", "c", 7, 9, "z"),
        (None, None, None, None, None, None),
    ]
    schema = (
        "doc_id long, text string, source string, size long, label int, "
        "family string"
    )
    columns = "key string, kept boolean, _row long, shard int, block long, row long, score double"
    extra = [(*r, "k", False, 7, 1, 2, 3, 0.5) for r in rows]
    return frame(f"{schema}, {columns}", *extra)
