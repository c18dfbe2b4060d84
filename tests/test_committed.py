"""Batches that appear whole and once, and messages that are taken once."""

import json

import pytest
from check import TABLES, duck, duck_bag, spark_bag  # noqa: F401
from conftest import DATA
from pyspark.sql import functions as F
from test_streaming import COMMENTS_ROUTED, POSTS_ROUTED, options, run, topic  # noqa: F401

from threadloom.jobs import stream_messages
from threadloom.plans import views
from threadloom.streaming import committed, router


class DyingBeforeItsSecondTable(committed.CommittedWriter):
    def __init__(self, root, fmt, at):
        super().__init__(root, router._run_id, fmt)
        self.at, self.calls = at, []

    def __call__(self, rows, table, batch_id):
        if len(self.calls) == self.at:
            self.calls.append("died")
            raise OSError("store is away")
        self.calls.append(table)
        super().__call__(rows, table, batch_id)


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_a_batch_killed_between_its_tables_adds_rows_once(spark, options, tmp_path, fmt):  # noqa: F811
    root = f"{tmp_path}/tables"
    with pytest.raises(Exception, match="store is away"):
        run(spark, options(), DyingBeforeItsSecondTable(root, fmt, 1))
    # the first table's files are there, and no reader sees them
    assert list((tmp_path / "tables/_data").iterdir())
    assert committed.read_committed(spark, root, "Posts", fmt).count() == 0
    run(spark, options(), router.committed_writer(root, fmt))
    posts = committed.read_committed(spark, root, "Posts", fmt)
    comments = committed.read_committed(spark, root, "Comments", fmt)
    assert (posts.count(), comments.count()) == (POSTS_ROUTED, COMMENTS_ROUTED)
    assert {"Id", "run_id", "batch_id"} < set(posts.columns)
    assert committed.read_committed(spark, root, "None", fmt).count() == 0


def test_a_batch_that_is_committed_is_not_written_again(spark, options, topic, tmp_path):  # noqa: F811
    root = f"{tmp_path}/tables"

    class DyingAfterItsCommit(committed.CommittedWriter):
        def commit(self, batch, batch_id):
            super().commit(batch, batch_id)
            raise OSError("killed after the rename")

    with pytest.raises(Exception, match="killed after"):
        run(spark, options(), DyingAfterItsCommit(root, router._run_id))
    run(spark, options(), router.committed_writer(root))
    assert committed.read_committed(spark, root, "Posts").count() == POSTS_ROUTED
    (topic / "1.txt").write_text('{"Type":"Comment","Id":"t1_new"}\n')
    run(spark, options(), router.committed_writer(root))
    assert committed.read_committed(spark, root, "Comments").count() == COMMENTS_ROUTED + 1
    newer = committed.read_committed(spark, root, "Comments", since=0)
    assert [(r.Id, r.batch_id) for r in newer.select("Id", "batch_id").collect()] == [("t1_new", 1)]


def test_two_attempts_that_race_leave_one_manifest(spark, tmp_path):
    rows = spark.createDataFrame([(1,)], "a int")
    one, two = (committed.CommittedWriter(str(tmp_path), lambda _: "r") for _ in range(2))
    assert one.begin(rows, 0) and two.begin(rows, 0)
    one(rows, "T", 0)
    two(rows, "T", 0)
    one.commit(rows, 0)
    two.commit(rows, 0)
    assert not two.begin(rows, 0)
    assert committed.read_committed(spark, str(tmp_path), "T").count() == 1


def replayed(spark, topic, tmp_path, repeats):  # noqa: F811
    """Messages of the conversations, several times over, as files of a topic."""
    (topic / "0.txt").unlink()
    for i in range(repeats):
        lines = [r.value for r in views.envelope(spark, f"{DATA}/sf0.001").select(
            F.to_json(F.struct("*")).alias("value")).collect()]
        (topic / f"{i}.txt").write_text("\n".join(lines) + "\n")
    return lines


def test_replayed_messages_leave_each_id_once(spark, options, topic, tmp_path):  # noqa: F811
    lines = replayed(spark, topic, tmp_path, 3)
    want = {}
    for line in map(json.loads, lines):
        want.setdefault(line["Type"], set()).add(line["Id"])
    root = f"{tmp_path}/tables"
    query = run(spark, options(once_within="3650 days", max_per_trigger=1),
                router.committed_writer(root))
    for kind, table in (("Post", "Posts"), ("Comment", "Comments")):
        ids = [r.Id for r in committed.read_committed(spark, root, table).select("Id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) == want[kind]
    assert router.late_records(query) == 0


def test_late_messages_are_dropped_and_counted(spark, options, topic, tmp_path):  # noqa: F811
    (topic / "0.txt").unlink()
    minute = 60_000

    def message(name, at):
        return json.dumps({"Type": "Comment", "Id": name, "CreatedAt": at and str(at * minute)})

    batches = [[message("a", 100), message("a", 101)], [message("b", 200), message("a", 195)],
               [message("c", 100), message("b", 199), message(None, 100), message("d", None)]]
    root = f"{tmp_path}/tables"
    late = 0
    for i, lines in enumerate(batches):
        (topic / f"{i}.txt").write_text("\n".join(lines) + "\n")
        late += router.late_records(run(
            spark, options(once_within="10 minutes"), router.committed_writer(root)))
    ids = [r.Id for r in committed.read_committed(spark, root, "Comments").select("Id").collect()]
    # `a` is forgotten once the time is past its ten minutes, `c` comes too late
    assert sorted(ids, key=str) == sorted(["a", "b", "a", None, "d"], key=str) or sorted(
        ids, key=str) == sorted(["a", "b", None, "d"], key=str)
    assert "c" not in ids and late == 1


def test_job_arguments():
    args = stream_messages.parse_args(
        ["-kt", "t", "-sf", "text", "-cp", "c", "-od", "o", "-cb", "-ow", "5 minutes"])
    assert args.committed and stream_messages.to_options(args).once_within == "5 minutes"
    with pytest.raises(SystemExit):
        stream_messages.parse_args(["-kt", "t", "-sf", "text", "-cp", "c", "-mu", "u", "-md", "d", "-cb"])
