"""Job sessions: runs of events of one job that follow each other closely.

A session is the events of a job whose distance is less than a gap. It is closed if its last event
ends a job, else stuck: such a job was started, and was never told to have ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.scalars import literal_map
from threadloom.schema import JOB_STATUSES

STUCK, CLOSED = "stuck", "closed"


def _code() -> Column:
    """Place of a known status among the statuses; null for any other word."""
    codes = literal_map({word: str(i) for i, word in enumerate(JOB_STATUSES)})
    return F.try_element_at(codes, "JobStatus").cast("int")


def _measures() -> list[Column]:
    # Equal times: the closing status wins, as for the latest state of a job.
    last = F.max(F.struct("at", "_code"))["_code"]
    return [
        F.min("at").alias("first_at"),
        F.max("at").alias("last_at"),
        F.count("*").alias("n_events"),
        F.sum((F.col("_code") == 0).cast("bigint")).alias("n_started"),
        F.element_at(F.array(*map(F.lit, JOB_STATUSES)), last + 1).alias("JobStatus"),
        F.when(last > 0, CLOSED).otherwise(STUCK).alias("state"),
    ]


def job_sessions(events: DataFrame, gap: str) -> DataFrame:
    """Sessions of (SubredditJobId, at, JobStatus) events.

    Events of an unknown status, without a job or without a time belong to no session. Repeated
    events count as often as they come. Works on streams, too: with a watermark on `at` a session
    comes out (append mode) once the watermark has passed its end, stuck ones included.
    Partial sessions are merged before the shuffle where
    spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition is on.
    """
    known = events.withColumn("_code", _code()).filter(
        F.col("_code").isNotNull() & F.col("SubredditJobId").isNotNull())
    return known.groupBy("SubredditJobId", F.session_window("at", gap).alias("_session")).agg(
        *_measures()).drop("_session")


def streaming_job_sessions(events: DataFrame, gap: str, late: str) -> DataFrame:
    """As job_sessions, for a stream whose events come up to `late` behind the newest one.

    Later events are dropped and counted by `streaming.router.late_records`. The state holds the
    sessions that may still grow, no others.
    """
    return job_sessions(events.withWatermark("at", late), gap)
