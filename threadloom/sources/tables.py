"""Batch sources: collections, parameterized SQL, fetched pages."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession

from threadloom.operators.documents import find


def read_collection(
    spark: SparkSession, fmt: str, condition: dict[str, Any] | None = None, **options: str
) -> DataFrame:
    """Matching documents of a collection; an empty frame if there are none.

    `options` are the format's own, such as path="..." for files or the connection, database and
    collection of a document store whose connector is on the classpath.
    """
    return find(spark.read.format(fmt).options(**options).load(), condition)


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Fetched pages: url, html and whatever keys the crawl stored."""
    return spark.read.format(fmt).load(path)


def run_sql(spark: SparkSession, query: str, **args: Any) -> DataFrame:
    """SQL text, or the text of a `.sql` file, with named markers (`:name`) bound to `args`."""
    if query.strip().endswith(".sql"):
        query = Path(query.strip()).read_text(encoding="utf-8").strip()
    return spark.sql(query, args=args)


def fetch_first(spark: SparkSession, query: str, **args: Any) -> Row | None:
    """First row of a query, or None; the limit is part of the plan."""
    return run_sql(spark, query, **args).limit(1).first()


def fetch_rows(spark: SparkSession, query: str, **args: Any) -> Iterator[Row]:
    """Rows of a query as a cursor: one partition at a time is on the driver."""
    return run_sql(spark, query, **args).toLocalIterator()
