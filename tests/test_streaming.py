"""The streaming split, with a folder of text files as the topic and parquet folders as tables."""

import json

import pytest
from test_messages import CASES

from threadloom.jobs import stream_messages
from threadloom.streaming import router

POSTS_ROUTED, COMMENTS_ROUTED = 6, 1


@pytest.fixture
def topic(tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    lines = [value for value, _, _ in CASES if value]
    (folder / "0.txt").write_text("\n".join(lines) + "\n")
    return folder


@pytest.fixture
def options(topic, tmp_path):
    def make(**changes):
        values = {
            "name": "test", "topic": str(topic), "checkpoint": str(tmp_path / "checkpoint"),
            "source_format": "text", "sink_format": "parquet", "table_option": "path",
            "table_prefix": f"{tmp_path}/out/", "trigger": {"availableNow": True},
        }
        return router.StreamOptions(**{**values, **changes})

    return make


def run(spark, options, write=None):
    query = router.start_job(spark, options, write)
    query.awaitTermination()
    return query


def rows(spark, tmp_path):
    return tuple(spark.read.parquet(f"{tmp_path}/out/{t}").count() for t in ("Posts", "Comments"))


def test_split_and_restart(spark, options, topic, tmp_path):
    first = run(spark, options())
    assert rows(spark, tmp_path) == (POSTS_ROUTED, COMMENTS_ROUTED)
    again = run(spark, options())
    assert rows(spark, tmp_path) == (POSTS_ROUTED, COMMENTS_ROUTED)
    assert first.id == again.id
    (topic / "1.txt").write_text('{"Type":"Comment","Id":"t1_new"}\n')
    run(spark, options())
    assert rows(spark, tmp_path) == (POSTS_ROUTED, COMMENTS_ROUTED + 1)


def test_fresh_checkpoint_reads_again_and_keeps_old_rows(spark, options, tmp_path):
    run(spark, options())
    run(spark, options(fresh_checkpoint=True))
    assert rows(spark, tmp_path) == (2 * POSTS_ROUTED, 2 * COMMENTS_ROUTED)


def failing_once(write):
    """A writer whose second write of the first attempt fails."""
    calls = []

    def run_write(batch, table, batch_id):
        calls.append(table)
        if len(calls) == 2:
            raise OSError("store is away")
        write(batch, table, batch_id)

    return run_write


def retry(spark, options, write):
    write = failing_once(write)
    with pytest.raises(Exception, match="store is away"):
        run(spark, options(), write)
    run(spark, options(), write)


def test_retry_with_plain_appends_repeats_rows(spark, options, tmp_path):
    retry(spark, options, router.append_writer(options()))
    assert rows(spark, tmp_path) == (2 * POSTS_ROUTED, COMMENTS_ROUTED)


def test_retry_with_batch_folders_does_not(spark, options, tmp_path):
    write = router.batch_folder_writer(f"{tmp_path}/out")
    retry(spark, options, write)
    assert rows(spark, tmp_path) == (POSTS_ROUTED, COMMENTS_ROUTED)
    run(spark, options(fresh_checkpoint=True), write)  # batch ids start over, old rows stay
    assert rows(spark, tmp_path) == (2 * POSTS_ROUTED, 2 * COMMENTS_ROUTED)
    stored = spark.read.parquet(f"{tmp_path}/out/Posts")
    assert stored.select("run_id").distinct().count() == 2


def test_many_batches(spark, options, topic, tmp_path):
    for n in range(1, 4):
        (topic / f"{n}.txt").write_text('{"Type":"Post","Id":"t3_%d"}\n' % n)
    run(spark, options(max_per_trigger=1), router.batch_folder_writer(f"{tmp_path}/out"))
    stored = spark.read.parquet(f"{tmp_path}/out/Posts")
    assert stored.count() == POSTS_ROUTED + 3
    assert stored.select("batch_id").distinct().count() == 4


def test_targets_audit_and_preview(spark, options, tmp_path, capfd):
    query = run(spark, options(targets={"Comment": "Replies"}, audit=True, preview=True,
                               author_alias=True))
    unknown = spark.read.parquet(f"{tmp_path}/out/Unknown")
    replies = spark.read.parquet(f"{tmp_path}/out/Replies").collect()
    assert unknown.count() == POSTS_ROUTED
    assert [(r.AuthorName, r.run_id, r.batch_id) for r in replies] == [("v", query.id, 0)]


def test_a_batch_is_parsed_once(spark, options, tmp_path):
    seen = []

    def write(batch, table, batch_id):
        seen.append(batch._jdf.queryExecution().executedPlan().toString())

    run(spark, options(), write)
    assert len(seen) == 2 and all("InMemoryTableScan" in plan for plan in seen)
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


def test_batch_and_stream_agree(spark, options, topic, tmp_path):
    from threadloom.operators import parse, route

    run(spark, options())
    batch = route.posts(parse.parse_envelope(spark.read.text(str(topic))))
    stored = spark.read.parquet(f"{tmp_path}/out/Posts")
    assert sorted(map(str, batch.collect())) == sorted(map(str, stored.collect()))


def test_job_arguments(tmp_path):
    args = stream_messages.parse_args(
        ["-kt", "t", "-ks", "b:1", "-mu", "mongodb://h", "-md", "d", "-cp", "/c", "-fcp"])
    options = stream_messages.to_options(args)
    assert (options.source_format, options.starting_offsets) == ("kafka", "latest")
    assert options.sink_options == {
        "spark.mongodb.connection.uri": "mongodb://h", "spark.mongodb.database": "d"}
    assert router.checkpoint_path(options).startswith("/c/")
    for argv in (["-kt", "t", "-ks", "b:1", "-cp", "/c"], ["-kt", "t", "-cp", "/c", "-od", "/o"]):
        with pytest.raises(SystemExit):
            stream_messages.parse_args(argv)


def test_unrouted_messages_are_kept_with_their_status(spark, options, topic, tmp_path, capfd):
    from collections import Counter

    run(spark, options(unrouted_table="Unrouted", print_schema=True))
    assert rows(spark, tmp_path) == (POSTS_ROUTED, COMMENTS_ROUTED)
    left = spark.read.parquet(f"{tmp_path}/out/Unrouted").collect()
    total = spark.read.text(str(topic)).count()
    assert len(left) + POSTS_ROUTED + COMMENTS_ROUTED == total
    assert not {r.status for r in left} & {"ok", "partial"}
    assert Counter(r.status for r in left)["malformed"] > 0
    assert "RelatedCommentId: map" in capfd.readouterr().out


def test_job_to_files(spark, topic, tmp_path):
    argv = ["-kt", str(topic), "-sf", "text", "-od", f"{tmp_path}/out", "-cp",
            f"{tmp_path}/checkpoint", "--once"]
    stream_messages.main(argv)
    stream_messages.main(argv)
    assert rows(spark, tmp_path) == (POSTS_ROUTED, COMMENTS_ROUTED)
    assert json.loads(CASES[0][0])["Id"] in {
        r.Id for r in spark.read.parquet(f"{tmp_path}/out/Posts").collect()}
