"""Collection operators: find, insert, update one, delete many.

Conditions are equality documents, `{column: value}`, all of which must hold; a None value matches
null. Results are new frames, to be written where the caller wants.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matches(condition: dict[str, Any]) -> Column:
    """The condition as a column that is never null; an empty condition matches every row."""
    terms = [
        F.col(name).isNull() if value is None else F.col(name) == F.lit(value)
        for name, value in condition.items()
    ]
    return F.coalesce(reduce(lambda a, b: a & b, terms, F.lit(True)), F.lit(False))


def find(collection: DataFrame, condition: dict[str, Any] | None = None) -> DataFrame:
    """Matching rows. Plain conjuncts, so that the scan can push them down."""
    for name, value in (condition or {}).items():
        test = F.col(name).isNull() if value is None else F.col(name) == F.lit(value)
        collection = collection.filter(test)
    return collection


def insert(collection: DataFrame, new: DataFrame, id_column: str | None = None) -> DataFrame:
    """Collection with the new rows appended; `id_column` gives rows without an id a fresh one."""
    if id_column:
        given = F.col(id_column) if id_column in new.columns else F.lit(None).cast("string")
        new = new.withColumn(id_column, F.coalesce(given, F.uuid()))
    return collection.unionByName(new, allowMissingColumns=True)


def _first_match(collection: DataFrame, condition: dict[str, Any], order: str) -> Column:
    """Scalar subquery: the least `order` among matching rows, null if none match."""
    return find(collection, condition).agg(F.min(order)).scalar()


def _differs(changes: dict[str, Any]) -> Column:
    return reduce(
        lambda a, b: a | b,
        [~F.col(name).eqNullSafe(F.lit(value)) for name, value in changes.items()])


def update_first(
    collection: DataFrame, condition: dict[str, Any], changes: dict[str, Any], order: str
) -> DataFrame:
    """Collection with `changes` set on the first match, first by the unique column `order`."""
    chosen = F.coalesce(
        F.col(order) == _first_match(collection, condition, order), F.lit(False))
    return collection.withColumn("_chosen", chosen).withColumns({
        name: F.when(F.col("_chosen"), F.lit(value)).otherwise(
            F.col(name) if name in collection.columns else F.lit(None))
        for name, value in changes.items()
    }).drop("_chosen")


def update_counts(
    collection: DataFrame, condition: dict[str, Any], changes: dict[str, Any], order: str
) -> DataFrame:
    """One row: how many rows update_first matches and how many it modifies, each 0 or 1."""
    first = _first_match(collection, condition, order)
    return collection.filter(F.col(order) == first).agg(
        F.count("*").alias("matched"), F.count_if(_differs(changes)).alias("modified"))


def delete_matching(collection: DataFrame, condition: dict[str, Any]) -> DataFrame:
    return collection.filter(~matches(condition))


def delete_count(collection: DataFrame, condition: dict[str, Any]) -> DataFrame:
    """One row: how many rows delete_matching removes."""
    return find(collection, condition).agg(F.count("*").alias("deleted"))
