"""Run ledger: boards, schedules, jobs and topics, as DataFrame transforms.

State changes are appended as events and the current state is an aggregate over them, so no store
that updates in place is needed. All of these take many boards or jobs at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.scalars import literal_map, seconds_between
from threadloom.operators.joins import spread_join
from threadloom.operators.serial import assign_serials
from threadloom.schema import (
    DEFAULT_JOB_TYPE,
    JOB_STATUSES,
    JOB_TYPES,
    LEDGER,
    SCHEDULE_RUNNING,
    SCHEDULE_STATUSES,
)

_CODE_BITS = 2  # room for a status code below each microsecond


def seed_job_types(spark: SparkSession, now: Column | None = None) -> DataFrame:
    """The job type table with its fixed rows."""
    now = F.localtimestamp() if now is None else now
    rows = spark.createDataFrame(JOB_TYPES, "JobTypeId int, JobTypeName string")
    rows = rows.withColumns({"IsActive": F.lit(True), "AddedDate": now})
    return rows.select(*[
        F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in LEDGER["JobType"].fields
    ])


# --- boards and schedules -------------------------------------------------------------------

def active_schedules(boards: DataFrame, schedules: DataFrame) -> DataFrame:
    """Boards with each of their active schedules; a board without one does not appear."""
    side = schedules.filter("IsActive").select(
        "SubredditId", "SubredditScheduleId", "LastParsedDate")
    return spread_join(
        side, boards.select("SubredditId", "SubredditName"), "SubredditId"
    ).select("SubredditId", "SubredditName", "SubredditScheduleId", "LastParsedDate")


def _schedules_by_name(boards: DataFrame, schedules: DataFrame, how: str) -> DataFrame:
    """Per board name: its greatest board id as `_any_board`, and of the greatest board id with an
    active schedule that id, its last schedule and date.

    Schedules are first reduced to one per board, so that neither the join nor the grouping by
    name sees a hot key.
    """
    per_board = schedules.filter("IsActive").groupBy("SubredditId").agg(
        F.max("SubredditScheduleId").alias("SubredditScheduleId"),
        F.max_by("LastParsedDate", "SubredditScheduleId").alias("LastParsedDate"),
    )
    both = boards.select("SubredditId", "SubredditName").join(per_board, "SubredditId", how)
    scheduled = F.when(F.col("SubredditScheduleId").isNotNull(), F.col("SubredditId"))
    return both.groupBy("SubredditName").agg(
        F.max("SubredditId").cast("bigint").alias("_any_board"),
        F.max(scheduled).cast("bigint").alias("SubredditId"),
        F.max_by("SubredditScheduleId", scheduled).cast("bigint").alias("SubredditScheduleId"),
        F.max_by("LastParsedDate", scheduled).alias("LastParsedDate"),
    )


def latest_schedule(boards: DataFrame, schedules: DataFrame) -> DataFrame:
    """Per board name: the greatest board id that has an active schedule, and its last schedule."""
    return _schedules_by_name(boards, schedules, "inner").drop("_any_board")


def lookup_board(boards: DataFrame, schedules: DataFrame, name: str) -> DataFrame:
    """The one-row answer for a board name (empty if it has no active schedule)."""
    found = active_schedules(boards.filter(F.col("SubredditName") == name), schedules)
    return found.orderBy(F.desc("SubredditId"), F.desc("SubredditScheduleId")).limit(1)


def is_ready() -> Column:
    """True where board, schedule and last parsed date are all known."""
    return (
        F.col("SubredditId").isNotNull()
        & F.col("SubredditScheduleId").isNotNull()
        & F.col("LastParsedDate").isNotNull()
    )


def _max_id(table: DataFrame, id_column: str) -> Column:
    return table.agg(F.coalesce(F.max(id_column).cast("bigint"), F.lit(0))).scalar()


def get_or_create(
    existing: DataFrame, requested: DataFrame, name: str, id_column: str
) -> DataFrame:
    """(name, id, created) for every distinct requested name; names not yet there get new ids."""
    wanted = requested.select(name).filter(F.col(name).isNotNull()).distinct()
    known = existing.groupBy(name).agg(F.max(id_column).cast("bigint").alias(id_column))
    both = wanted.join(known, name, "left")
    found = both.filter(F.col(id_column).isNotNull()).withColumn("created", F.lit(False))
    new = assign_serials(
        both.filter(F.col(id_column).isNull()).select(name), name,
        {id_column: _max_id(existing, id_column)})
    return found.unionByName(new.withColumn("created", F.lit(True)))


def get_or_create_topic(topics: DataFrame, requested: DataFrame) -> DataFrame:
    return get_or_create(topics, requested, "TopicName", "TopicId")


def get_or_create_board(
    boards: DataFrame, schedules: DataFrame, requested: DataFrame
) -> DataFrame:
    """Board id, schedule id and last parsed date for every distinct requested name.

    A name that is known but has no active schedule keeps its board and gets a new schedule
    without a date; an unknown name gets both. `created_board` and `created_schedule` tell which
    rows to append.
    """
    wanted = requested.select("SubredditName").filter(
        F.col("SubredditName").isNotNull()).distinct()
    known = _schedules_by_name(boards, schedules, "left")
    state = wanted.join(known, "SubredditName", "left").withColumns({
        "created_board": F.col("_any_board").isNull(),
        "created_schedule": F.col("SubredditScheduleId").isNull(),
        "SubredditId": F.coalesce("SubredditId", "_any_board"),
    }).drop("_any_board")
    ready = state.filter(~F.col("created_schedule"))
    new = assign_serials(
        state.filter("created_schedule"), "SubredditName",
        {"SubredditId": _max_id(boards, "SubredditId"),
         "SubredditScheduleId": _max_id(schedules, "SubredditScheduleId")},
        {"SubredditId": F.col("created_board")})
    return ready.unionByName(new).select(
        "SubredditName", "SubredditId", "SubredditScheduleId", "LastParsedDate",
        "created_board", "created_schedule")


def close_schedule(
    schedules: DataFrame, status: Column, when: Column, now: Column
) -> DataFrame:
    """Schedules after their runs ended with `status`, where `when` holds.

    Success sets date and status, failure only the status, any other word changes nothing.
    """
    word = F.lower(status)
    success, failed = SCHEDULE_STATUSES
    return schedules.withColumns({
        "LastParsedDate": F.when(when & (word == success), now).otherwise(F.col("LastParsedDate")),
        "LastCheckStatus": F.when(when & word.isin(success, failed), status).otherwise(
            F.col("LastCheckStatus")),
    })


def mark_running(schedules: DataFrame, when: Column) -> DataFrame:
    return schedules.withColumn(
        "LastCheckStatus",
        F.when(when, F.lit(SCHEDULE_RUNNING)).otherwise(F.col("LastCheckStatus")))


# --- jobs ------------------------------------------------------------------------------------

def job_type_id(job_types: DataFrame, name: str) -> Column:
    """Scalar subquery: id of a job type, by name without regard to case. Fails on two matches."""
    return (
        job_types.filter(F.lower("JobTypeName") == F.lower(F.lit(name)))
        .select("JobTypeId").scalar()
    )


def attach_job(
    jobs: DataFrame, job_types: DataFrame, when: Column, execution_type: str,
    board_id: Column, topic_id: Column,
) -> DataFrame:
    """Jobs with board, type and topic set where `when` holds."""
    new = {
        "SubredditId": board_id,
        "JobTypeId": job_type_id(job_types, execution_type),
        "TopicId": topic_id,
    }
    hit = F.coalesce(when, F.lit(False))
    return jobs.withColumns({
        name: F.when(hit, value).otherwise(F.col(name)) for name, value in new.items()
    })


def job_latest(events: DataFrame) -> DataFrame:
    """Current state of every job from its events (SubredditJobId, at, JobStatus).

    Time and status are packed into one number, so the latest event is a plain maximum, hashed and
    combined before the shuffle. At the same microsecond a closing status wins. Events of any other
    status change nothing; unknown_statuses counts them.
    """
    code = F.try_element_at(
        literal_map({word: str(i) for i, word in enumerate(JOB_STATUSES)}), "JobStatus")
    packed = F.shiftleft(F.unix_micros(F.col("at").cast("timestamp")), _CODE_BITS) + code.cast("bigint")
    last = F.col("_last")
    last_code = last.bitwiseAND(F.lit((1 << _CODE_BITS) - 1))
    status = F.element_at(
        F.array(*[F.lit(word) for word in JOB_STATUSES]), (last_code + 1).cast("int"))
    ended = F.timestamp_micros(F.shiftright(last, _CODE_BITS)).cast("timestamp_ntz")
    state = events.groupBy("SubredditJobId").agg(
        F.min("at").alias("JobStartDate"), F.max(packed).alias("_last"))
    return state.select(
        "SubredditJobId", "JobStartDate",
        F.when(last_code > 0, ended).alias("JobEndDate"),
        status.alias("JobStatus"),
    )


def unknown_statuses(events: DataFrame) -> DataFrame:
    """Events per status that job_latest does not know, so that none is ignored without a trace."""
    return events.filter(~F.coalesce("JobStatus", F.lit("")).isin(*JOB_STATUSES)).groupBy(
        "JobStatus").agg(F.count("*").alias("n"))


def with_job_defaults(jobs: DataFrame) -> DataFrame:
    """Jobs with the default type where none was attached."""
    return jobs.withColumn("JobTypeId", F.coalesce("JobTypeId", F.lit(DEFAULT_JOB_TYPE)))


# --- incremental runs ------------------------------------------------------------------------

def incremental_period(plan: DataFrame, now: Column) -> DataFrame:
    """Plan rows whose falsy `period` is set to the seconds since LastParsedDate, if known."""
    given = F.nullif(F.col("period").cast("double"), F.lit(0.0))
    since = seconds_between(now.cast("timestamp"), F.col("LastParsedDate").cast("timestamp"))
    return plan.withColumn("period", F.coalesce(given, since))


def resolve_mode(plan: DataFrame, now: Column) -> DataFrame:
    """Plan rows with the `mode` of their run: all, count or period.

    `plan` has take_all, count_limit, period, LastParsedDate. With nothing to go by the whole
    board is taken; a count limit beats a period.
    """
    limit = F.nullif(F.col("count_limit"), F.lit(0))
    known = F.col("period").isNotNull() & (F.col("period") != 0)
    nothing = ~known & F.col("LastParsedDate").isNull() & limit.isNull()
    mode = (
        F.when(F.coalesce("take_all", F.lit(False)) | nothing, "all")
        .when(limit.isNotNull(), "count")
        .otherwise("period")
    )
    return incremental_period(plan.withColumn("mode", mode), now)
