"""Routing of typed records to the table of their type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.scalars import map_lookup
from threadloom.schema import COMMENT_COLUMNS, DEFAULT_TARGET, POST_COLUMNS, TARGETS


def route_target(kind: Column | str, targets: dict[str, str] | None = None) -> Column:
    """Table name of a record type, with the default for types that have none."""
    return map_lookup(TARGETS if targets is None else targets, kind, DEFAULT_TARGET)


def posts(records: DataFrame) -> DataFrame:
    return records.filter(F.col("Type") == "Post").select(*POST_COLUMNS)


def comments(records: DataFrame) -> DataFrame:
    return records.filter(F.col("Type") == "Comment").select(*COMMENT_COLUMNS)


def split(records: DataFrame) -> dict[str, DataFrame]:
    """The records of each routed type; every other type is left out."""
    return {"Post": posts(records), "Comment": comments(records)}
