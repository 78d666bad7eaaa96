"""Fixtures of the operators' tests (imported by name, as a second conftest would hide the first)."""

import pytest

from widetab.llm.queries import prepare


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


DOC = "doc_id bigint, text string, source string, size string, k string, h bigint"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties and repeated
    rows, and extra columns whose names operators use inside."""
    long = "lorem ipsum dolor sit amet " * 8000
    rows = [(1, None, "a", "x", "y", 5), (2, "", "a", None, None, None), (None, "some words here", None, "x", "y", 1),
            (3, "same text " * 40, "a", "x", "y", 1), (3, "same text " * 40, "a", "x", "y", 1), (4, "same text " * 40, "b", "", "", 2),
            (5, long, "b", "x", "y", 0), (6, "Zwölf Boxkämpfer 😀 jagen", "b", "x", "y", 0), (7, " \t\n", None, None, None, None)]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def sample_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
