"""As-of join: for each event the state in force at its time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.joins import spread_join


def asof_join(events: DataFrame, states: DataFrame, key: str, time: str, tie: str,
              width: int) -> DataFrame:
    """`events` with `state`, a struct of the latest state of its key at or before its time.

    `states` has `key`, `time` and other columns; of states of one key and time the one of the
    greatest `tie` counts. `time` is a whole number, and keys are split into spans of `width` of it,
    so no task orders all rows of a key: within a span the last state is carried forward, and what
    was in force when a span began comes from one row per span. An event before its key's first
    state has a null state. Events without key or time keep their row, with a null state; such
    states are left out.
    """
    span: Column = F.floor(F.col(time) / width).cast("bigint")
    keyed = F.col(key).isNotNull() & F.col(time).isNotNull()
    state = F.struct(time, *[c for c in states.columns if c not in (key, time)])
    given = states.where(keyed).groupBy(key, time).agg(
        F.max_by(state, F.col(tie)).alias("_state")).withColumn("_span", span)
    asked = events.where(keyed).withColumn("_span", span)

    # what each span leaves to the next ones: one row per key and span
    left = given.groupBy(key, "_span").agg(F.max_by("_state", F.col(time)).alias("_last"))
    spans = asked.select(key, "_span").distinct().join(left, [key, "_span"], "full")
    before = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select(key, "_span", F.last("_last", True).over(before).alias("_carried"))

    rows = asked.withColumn("_event", F.lit(True)).unionByName(
        given.withColumn("_event", F.lit(False)), allowMissingColumns=True)
    so_far = Window.partitionBy(key, "_span").orderBy(time, "_event").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    within = rows.withColumn("_state", F.last("_state", True).over(so_far)).where("_event").drop(
        "_event")
    joined = spread_join(
        within.withColumn("_at", F.struct(key, "_span")).drop("_span"),
        carried.select(F.struct(key, "_span").alias("_at"), "_carried"), "_at", "left")
    found = joined.withColumn("state", F.coalesce("_state", "_carried")).drop(
        "_at", "_state", "_carried")
    return found.unionByName(events.where(~keyed), allowMissingColumns=True).select(
        *events.columns, "state")
