from datetime import datetime

import pytest
from pyspark.sql import functions as F

from threadloom.operators import ledger
from threadloom.plans.runs import Ledger, run_logged

BOARD = "SubredditId bigint, SubredditName string"
SCHEDULE = ("SubredditScheduleId bigint, SubredditId bigint, LastParsedDate timestamp, "
            "LastCheckStatus string, IsActive boolean")
DAY = [datetime(2024, 1, d) for d in range(1, 10)]


def now():
    return F.lit(datetime(2024, 1, 31)).cast("timestamp")


@pytest.fixture
def boards(small):
    return small([(1, "ready"), (2, "no date"), (3, "inactive"), (4, "twice"), (5, "twice")], BOARD)


@pytest.fixture
def schedules(small):
    return small([
        (10, 1, DAY[1], "success", True), (11, 2, None, None, True),
        (12, 3, DAY[2], "success", False), (13, 4, DAY[3], "failed", True),
        (14, 5, DAY[4], "success", True), (15, 5, DAY[5], "success", True)], SCHEDULE)


def test_lookup_one_board(boards, schedules):
    def found(name):
        return [tuple(r) for r in ledger.lookup_board(boards, schedules, name).collect()]

    assert found("ready") == [(1, "ready", 10, DAY[1])]
    assert found("twice") == [(5, "twice", 15, DAY[5])]
    assert found("inactive") == found("unheard of") == found("x' OR '1'='1") == []


def test_latest_schedule_of_all_boards(boards, schedules):
    latest = ledger.latest_schedule(boards, schedules).withColumn("ready", ledger.is_ready())
    got = {r.SubredditName: tuple(r)[1:] for r in latest.collect()}
    assert got == {
        "ready": (1, 10, DAY[1], True),
        "no date": (2, 11, None, False),
        "twice": (5, 15, DAY[5], True),
    }


def test_left_join_hides_boards_without_active_schedule(boards, schedules):
    names = {r.SubredditName for r in ledger.active_schedules(boards, schedules).collect()}
    assert names == {"ready", "no date", "twice"}


def test_get_or_create_board(small, boards, schedules):
    asked = small([(n,) for n in
                   ["ready", "no date", "inactive", "twice", "new", "new", "newer", None]],
                  "SubredditName string")
    got = {r.SubredditName: tuple(r)[1:]
           for r in ledger.get_or_create_board(boards, schedules, asked).collect()}
    assert got["ready"] == (1, 10, DAY[1], False, False)
    assert got["no date"] == (2, 11, None, False, False)
    assert got["twice"] == (5, 15, DAY[5], False, False)
    board, schedule, last, new_board, new_schedule = got["inactive"]
    assert (board, last, new_board, new_schedule) == (3, None, False, True)
    assert {got["new"][0], got["newer"][0]} == {6, 7}
    assert {schedule, got["new"][1], got["newer"][1]} == {16, 17, 18}
    assert len(got) == 6


def test_get_or_create_on_empty_tables(small):
    topics = small([], "TopicId bigint, TopicName string")
    asked = small([("a",), ("a",)], "TopicName string")
    rows = ledger.get_or_create_topic(topics, asked).collect()
    assert [tuple(r) for r in rows] == [("a", 1, True)]


def test_close_schedule(schedules):
    close = ledger.close_schedule

    def state(status, key=10):
        out = close(schedules, F.lit(status), F.col("SubredditScheduleId") == key, now())
        return {r.SubredditScheduleId: (r.LastParsedDate, r.LastCheckStatus) for r in out.collect()}

    before = state("other")
    assert before[10] == (DAY[1], "success")
    assert state("Success")[10] == (datetime(2024, 1, 31), "Success")
    assert state("failed")[10] == (DAY[1], "failed")
    assert {k: v for k, v in state("failed").items() if k != 10} == {
        k: v for k, v in before.items() if k != 10}
    running = ledger.mark_running(schedules, F.col("SubredditId") == 5)
    assert {r.SubredditScheduleId for r in running.filter("LastCheckStatus = 'running'").collect()
            } == {14, 15}


def test_attach_job(spark, small):
    types = ledger.seed_job_types(spark)
    jobs = small([(1, None, 1, None), (2, None, 1, None)],
                 "SubredditJobId int, SubredditId int, JobTypeId int, TopicId int")

    def attach(job_types, name):
        return sorted(tuple(r) for r in ledger.attach_job(
            jobs, job_types, F.col("SubredditJobId") == 2, name, F.lit(7), F.lit(9)).collect())

    assert attach(types, "MANUAL") == [(1, None, 1, None), (2, 7, 2, 9)]
    assert attach(types, "unknown") == [(1, None, 1, None), (2, 7, None, 9)]
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        attach(types.unionByName(types), "manual")


def test_job_latest(small):
    events = small([
        (1, DAY[0], "started"), (2, DAY[0], "started"), (2, DAY[1], "success"),
        (3, DAY[2], "fail"), (3, DAY[1], "started"), (4, DAY[1], "started"), (4, DAY[1], "fail")],
        "SubredditJobId bigint, at timestamp, JobStatus string")
    got = {tuple(r) for r in ledger.job_latest(events).collect()}
    assert got == {
        (1, DAY[0], None, "started"), (2, DAY[0], DAY[1], "success"),
        (3, DAY[1], DAY[2], "fail"), (4, DAY[1], DAY[1], "fail")}


@pytest.mark.parametrize("take_all, limit, period, last, want", [
    (False, None, None, None, ("all", None)),            # nothing known
    (False, None, 0.0, None, ("all", None)),
    (True, 5, 60.0, DAY[0], ("all", 60.0)),
    (False, 5, None, None, ("count", None)),
    (False, 5, 60.0, None, ("count", 60.0)),             # a limit beats a period
    (False, None, 60.0, DAY[0], ("period", 60.0)),
    (False, 0, None, DAY[0], ("period", 30 * 86400.0)),  # since the last run
    (False, None, 0.0, DAY[0], ("period", 30 * 86400.0)),
])
def test_resolve_mode(small, take_all, limit, period, last, want):
    plan = small([(take_all, limit, period, last)],
                 "take_all boolean, count_limit int, period double, LastParsedDate timestamp")
    row = ledger.resolve_mode(plan, now()).first()
    assert (row.mode, row.period) == want


# --- the stored ledger ------------------------------------------------------------------------

@pytest.fixture
def store(spark, request):
    made = Ledger(spark, f"ledger_{request.node.name}")
    made.deploy()
    return made


def names(small, *values):
    return small([(v,) for v in values], "SubredditName string")


def test_deploy_keeps_rows_and_reseeds_types(small, store):
    store.topic_id("t")
    store.deploy()
    assert store.topic_id("t") == 1
    assert store.topic_id("u") == 2
    types = store.table("JobType").orderBy("JobTypeId").collect()
    assert [(r.JobTypeId, r.JobTypeName, r.IsActive) for r in types] == [
        (1, "scheduled", True), (2, "manual", True)]


def test_successful_runs(small, store):
    seen = []

    def work(runs):
        seen.append({r.SubredditName: r.LastParsedDate for r in runs.collect()})

    run_logged(store, names(small, "a", "b"), "topic", work)
    run_logged(store, names(small, "a", "c"), "topic", work, execution_type="Scheduled")
    assert set(seen[0].items()) == {("a", None), ("b", None)}
    assert seen[1]["a"] is not None and seen[1]["c"] is None
    assert store.table("Subreddit").count() == store.table("SubredditSchedule").count() == 3
    jobs = store.jobs().collect()
    assert sorted(j.SubredditJobId for j in jobs) == [1, 2, 3, 4]
    assert {j.JobStatus for j in jobs} == {"success"}
    assert sorted(j.JobTypeId for j in jobs) == [1, 1, 2, 2]
    assert {j.TopicId for j in jobs} == {1}
    assert all(j.JobEndDate >= j.JobStartDate for j in jobs)
    assert {s.LastCheckStatus for s in store.schedules().collect()} == {"success"}


def test_failed_run_keeps_the_date_and_raises(small, store):
    run_logged(store, names(small, "a"), "topic", lambda runs: DAY[0])
    before = store.schedules().first().LastParsedDate
    assert before == DAY[0]

    def broken(runs):
        raise ValueError("site is down")

    with pytest.raises(ValueError, match="site is down"):
        run_logged(store, names(small, "a"), "topic", broken)
    after = store.schedules().first()
    assert (after.LastParsedDate, after.LastCheckStatus) == (before, "failed")
    status = {j.SubredditJobId: j.JobStatus for j in store.jobs().collect()}
    assert status == {1: "success", 2: "fail"}


def test_failure_to_attach_is_recorded(small, store):
    twice = store.table("JobType").withColumn("JobTypeName", F.lit("manual"))
    rows = [tuple(r) for r in twice.collect()]
    store.spark.createDataFrame(rows, twice.schema).write.mode("overwrite").saveAsTable(
        store._name("JobType"))
    with pytest.raises(Exception):
        run_logged(store, names(small, "a"), "topic", lambda runs: None)
    assert {j.JobStatus for j in store.jobs().collect()} == {"fail"}
    assert {s.LastCheckStatus for s in store.schedules().collect()} == {"failed"}


def test_unknown_job_statuses_are_counted(small):
    events = small([(1, "started"), (1, "lost"), (2, None), (3, "lost")],
                   "SubredditJobId bigint, JobStatus string")
    assert {(r.JobStatus, r.n) for r in ledger.unknown_statuses(events).collect()} == {
        ("lost", 2), (None, 1)}


def test_watermark_start(small, store):
    run_logged(store, names(small, "a"), "topic", lambda runs: None, watermark="start")
    job, schedule = store.jobs().first(), store.schedules().first()
    assert schedule.LastParsedDate <= job.JobEndDate
    with pytest.raises(ValueError):
        run_logged(store, names(small, "a"), "topic", lambda runs: None, watermark="now")
