"""The ledger as tables, and runs recorded in it.

Boards, schedules and topics are appended when first asked for; what happens to jobs and schedules
is appended as events, from which `jobs` and `schedules` give the current state. Every step takes
any number of boards as a frame. Ids are numbered from the current maximum, so one ledger has one
writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from threadloom.operators import ledger
from threadloom.operators.serial import assign_serials
from threadloom.schema import LEDGER
from threadloom.session import materialize
from threadloom.sources.sinks import ensure_table

JOB_EVENT = StructType([
    StructField("SubredditJobId", LongType()),
    StructField("at", TimestampType()),
    StructField("JobStatus", StringType()),
    StructField("SubredditId", LongType()),
    StructField("JobTypeId", IntegerType()),
    StructField("TopicId", LongType()),
])
SCHEDULE_EVENT = StructType([
    StructField("SubredditScheduleId", LongType()),
    StructField("at", TimestampType()),
    StructField("LastCheckStatus", StringType()),
    StructField("LastParsedDate", TimestampType()),
])
_STORED = {
    name: schema for name, schema in LEDGER.items() if name not in ("SubredditJob", "JobType")
} | {"JobEvent": JOB_EVENT, "ScheduleEvent": SCHEDULE_EVENT}


def schedule_latest(schedules: DataFrame, events: DataFrame) -> DataFrame:
    """Schedules with the last status and the last parsed date their events tell."""
    parsed_at = F.when(F.col("LastParsedDate").isNotNull(), F.col("at"))
    last = events.groupBy("SubredditScheduleId").agg(
        F.max_by("LastCheckStatus", "at").alias("_status"),
        F.max_by("LastParsedDate", parsed_at).alias("_parsed"))
    return schedules.join(last, "SubredditScheduleId", "left").withColumns({
        "LastCheckStatus": F.coalesce("_status", "LastCheckStatus"),
        "LastParsedDate": F.coalesce("_parsed", "LastParsedDate"),
    }).drop("_status", "_parsed")


class Ledger:
    """Ledger tables in one database of the session's catalog."""

    def __init__(self, spark: SparkSession, database: str, fmt: str = "parquet") -> None:
        self.spark, self.database, self.fmt = spark, database, fmt

    def _name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self._name(table))

    def _append(self, table: str, rows: DataFrame) -> None:
        schema = _STORED[table]
        full = rows.select(*[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ])
        full.write.mode("append").format(self.fmt).saveAsTable(self._name(table))

    def deploy(self) -> None:
        """Create what is missing; the job types are written anew."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        for table, schema in _STORED.items():
            ensure_table(self.spark, self._name(table), schema, self.fmt)
        ledger.seed_job_types(self.spark).write.mode("overwrite").format(self.fmt).saveAsTable(
            self._name("JobType"))

    def schedules(self) -> DataFrame:
        return schedule_latest(self.table("SubredditSchedule"), self.table("ScheduleEvent"))

    def jobs(self) -> DataFrame:
        """Current state of every job, with the columns of the job table."""
        events = self.table("JobEvent")
        attached = events.groupBy("SubredditJobId").agg(
            *[F.max(name).alias(name) for name in ("SubredditId", "JobTypeId", "TopicId")])
        state = ledger.job_latest(events.filter(F.col("JobStatus").isNotNull()))
        both = ledger.with_job_defaults(state.join(attached, "SubredditJobId"))
        return both.select(*[
            F.col(f.name).cast(f.dataType).alias(f.name) for f in LEDGER["SubredditJob"].fields])

    def topic_id(self, topic: str) -> int:
        wanted = self.spark.createDataFrame([(topic,)], "TopicName string")
        found = materialize(ledger.get_or_create_topic(self.table("KafkaTopic"), wanted))
        self._append("KafkaTopic", found.filter("created").withColumns(_new_row()))
        return found.first()["TopicId"]

    def boards(self, names: DataFrame) -> DataFrame:
        """Ids and last parsed date of the named boards, which are added where missing."""
        found = materialize(ledger.get_or_create_board(
            self.table("Subreddit"), self.schedules(), names))
        self._append("Subreddit", found.filter("created_board").withColumns(_new_row()))
        self._append("SubredditSchedule", found.filter("created_schedule").withColumns(_new_row()))
        return found

    def open(self, names: DataFrame) -> DataFrame:
        """Open one job per named board."""
        boards = self.boards(names)
        first = self.table("JobEvent").agg(
            F.coalesce(F.max("SubredditJobId"), F.lit(0))).scalar()
        runs = materialize(assign_serials(boards, "SubredditName", {"SubredditJobId": first}))
        opened = runs.withColumns({"at": F.current_timestamp(), "JobStatus": F.lit("started")})
        self._append("JobEvent", opened.select("SubredditJobId", "at", "JobStatus"))
        return runs

    def attach(self, runs: DataFrame, topic: str, execution_type: str = "manual") -> None:
        """Attach board, type and topic to the jobs of `runs`."""
        attached = ledger.attach_job(
            runs.withColumns({
                "JobTypeId": F.lit(None).cast("int"), "TopicId": F.lit(None).cast("bigint")}),
            self.table("JobType"), F.lit(True), execution_type,
            F.col("SubredditId"), F.lit(self.topic_id(topic)))
        self._append("JobEvent", attached.withColumn("at", F.current_timestamp()).select(
            "SubredditJobId", "at", "SubredditId", "JobTypeId", "TopicId"))

    def finish(self, runs: DataFrame, ok: bool, parsed_at: Column | None = None) -> None:
        """Close the jobs and schedules of `runs`; success moves their last parsed date."""
        now = F.current_timestamp()
        ended = runs.select("SubredditJobId", "SubredditScheduleId").withColumns({
            "at": now,
            "LastParsedDate": F.lit(None).cast("timestamp"),
            "LastCheckStatus": F.lit(None).cast("string"),
        })
        status = F.lit("success" if ok else "failed")
        closed = ledger.close_schedule(
            ended, status, F.lit(True), now if parsed_at is None else parsed_at)
        self._append("ScheduleEvent", closed)
        self._append("JobEvent", ended.withColumn("JobStatus", F.lit("success" if ok else "fail")))


def _new_row() -> dict[str, Column]:
    return {"IsActive": F.lit(True), "AddedDate": F.localtimestamp()}


def run_logged(
    store: Ledger,
    names: DataFrame,
    topic: str,
    work: Callable[[DataFrame], datetime | None],
    execution_type: str = "manual",
    watermark: str = "end",
) -> None:
    """Run `work` on the named boards and record how it ended; its error is raised again.

    From the moment the jobs are open, whatever fails is recorded: attaching them, too.
    `work` gets one row per board: ids, LastParsedDate, SubredditJobId. The date success leaves
    behind is the end of the run, its start (`watermark="start"`), or what `work` returns.
    """
    if watermark not in ("start", "end"):
        raise ValueError("watermark is 'start' or 'end'")
    runs = store.open(names)
    try:
        store.attach(runs, topic, execution_type)
        started = store.spark.sql("SELECT current_timestamp()").first()[0]
        newest = work(runs)
    except Exception:
        store.finish(runs, ok=False)
        raise
    if newest is None and watermark == "start":
        newest = started
    store.finish(runs, ok=True, parsed_at=None if newest is None else F.lit(newest))
