"""Fetched pages to a topic to tables, with the ledger in between."""

import json
import time

import pytest
from pyspark.sql import functions as F
from test_extract import comment, page

from threadloom.jobs import publish_pages, stream_messages
from threadloom.operators import extract
from threadloom.plans import publish
from threadloom.plans.publish import publish_records
from threadloom.plans.runs import Ledger

SITE = "https://forum.example"


def element(n, created, promoted="false"):
    return (f'<div class="thing" data-fullname="t3_{n}" data-timestamp="{created}" '
            f'data-permalink="/p/{n}/" data-promoted="{promoted}"></div>')


@pytest.fixture
def site(spark, tmp_path):
    now = int(time.time() * 1000)
    hour = 3_600_000
    listing = [
        ("r/x", 0, element(1, now - hour) + element(2, now, "true") + element(3, now - 2 * hour)),
        ("r/x", 1, element(4, now - 90 * hour) + element(5, now)),
        ("r/news", 0, element(6, now - hour)),
    ]
    threads = [
        (f"{SITE}/p/{n}/", page(comment(f"t1_{n}a", inside=comment(f"t1_{n}b"))).replace("t3_p", f"t3_{n}"))
        for n in range(1, 8)
    ]
    paths = f"{tmp_path}/listing", f"{tmp_path}/threads"
    spark.createDataFrame(listing, "board string, page_no bigint, html string").write.parquet(paths[0])
    spark.createDataFrame(threads, "url string, html string").write.parquet(paths[1])
    return paths


def publish_to(site, tmp_path, *extra):
    topic = f"{tmp_path}/topic"
    publish_pages.main(["-lp", site[0], "-tp", site[1], "-bu", SITE, "-kf", "text", "-kt", topic,
                        "-db", f"ledger_{tmp_path.name}", *extra])
    return topic


def messages(spark, topic):
    return [json.loads(r.value) for r in spark.read.text(topic).collect()]


@pytest.mark.parametrize("extra, want", [
    (["-a"], {"t3_1", "t3_3", "t3_6"}),  # page 0 of r/x is short: page 1 is behind the end
    (["-l", "1"], {"t3_1", "t3_6"}),
    (["-p", "5400"], {"t3_1", "t3_6"}),
    (["-p", "86400"], {"t3_1", "t3_3", "t3_6"}),
    ([], {"t3_1", "t3_3", "t3_6"}),  # nothing known: whole boards
])
def test_modes(spark, site, extra, want):
    args = publish_pages.parse_args(
        ["-lp", site[0], "-tp", site[1], "-bu", SITE, "-kt", "t", "-kf", "text", *extra])
    runs = spark.createDataFrame(
        [("r/x", None), ("r/news", None)], "SubredditName string, LastParsedDate timestamp")
    listing, threads = (spark.read.parquet(path) for path in site)
    found = publish_records(
        listing, threads, publish_pages.run_plan(runs, args), int(time.time() * 1000), SITE
    ).select("Type", "Id").collect()
    assert {r.Id for r in found if r.Type == "Post"} == want
    assert len(found) == 3 * len(want)


def test_messages(spark, site, tmp_path):
    found = messages(spark, publish_to(site, tmp_path, "-a"))
    assert len(found) == 9
    post = next(m for m in found if m["Id"] == "t3_6")
    assert post["SubredditName"] == "/r/news/"
    assert post["RelatedCommentId"] == {"id": ["t1_6a", "t1_6b"]}
    reply = next(m for m in found if m["Id"] == "t1_1b")
    assert reply["SubredditName"] == "/r/x/new/"
    assert (reply["ParentCommentId"], reply["ParentPostId"]) == ("t1_1a", "t3_1")
    assert (reply["Author"], reply["CreatedAt"], reply["IsActive"]) == ("bob", 1700000000000, True)
    assert "RelatedCommentId" not in reply and "ParentPostId" not in post


def test_many_wanted_threads_are_joined_after_reading(spark, site):
    listing, threads = (spark.read.parquet(path) for path in site)
    plan = spark.createDataFrame(
        [("r/x", "all", None, None, "/r/x/new/", "new"), ("r/news", "all", None, None, "/r/news/", "new")],
        "board string, mode string, count_limit int, period double, path string, ranking string")

    def records(max_broadcast, page_size=None):
        out = publish_records(
            listing, threads, plan, 0, SITE, max_broadcast=max_broadcast, page_size=page_size)
        return sorted(str(sorted(r.asDict().items())) for r in out.drop("ParsedTime").collect())

    assert len(records(10_000)) == 15 and len(records(10_000, 25)) == 9
    assert records(10_000) == records(0)


def test_only_wanted_pages_are_read(spark, monkeypatch):
    pages = spark.range(500).select(F.concat(F.lit("u"), "id").alias("url"))
    wanted = pages.filter("url in ('u7', 'u8', 'u499')").unionAll(spark.sql("select 'x' as url"))
    assert {r.url for r in publish.wanted_pages(pages, wanted).collect()} == {"u7", "u8", "u499"}
    monkeypatch.setattr(publish, "URL_BITS", 1 << 10)  # some others may pass, none is lost
    got = {r.url for r in publish.wanted_pages(pages, wanted).collect()}
    assert {"u7", "u8", "u499"} <= got and len(got) < 20
    assert publish.wanted_pages(pages, wanted.limit(0)).count() == 0


def test_parts_of_a_thread_are_one_post(spark, small):
    shown = comment("t1_b").replace("data-type", 'data-context="1" data-type')
    parts = [("u", 1, page(shown.replace('<div class="child">', '<div class="child">' + comment("t1_c")))),
             ("u", 0, page(comment("t1_a", inside=comment("t1_b")))), ("v", 0, page())]
    found = extract.combine_parts(extract.extract_thread(
        small(parts, "url string, part int, html string"), ("url", "part")), ("url",), "part")
    rows = found.collect()
    posts = {r.url: r.RelatedCommentId["id"] for r in rows if r.Type == "Post"}
    assert posts == {"u": ["t1_a", "t1_b", "t1_c"], "v": []} and len(rows) == 5
    assert {r.Id: r.ParentCommentId for r in rows if r.Type == "Comment"} == {
        "t1_a": None, "t1_b": "t1_a", "t1_c": "t1_b"}


def test_second_run_takes_what_is_new(spark, site, tmp_path):
    publish_to(site, tmp_path)
    before = len(messages(spark, f"{tmp_path}/topic"))
    publish_to(site, tmp_path)
    assert len(messages(spark, f"{tmp_path}/topic")) == before  # all older than the last run
    store = Ledger(spark, f"ledger_{tmp_path.name}")
    assert store.table("Subreddit").count() == 2
    assert {j.JobStatus for j in store.jobs().collect()} == {"success"}


def test_failed_run_is_recorded(spark, site, tmp_path):
    with pytest.raises(Exception):
        publish_pages.main([
            "-lp", site[0], "-tp", site[1], "-bu", SITE, "-kt", "t",
            "-ks", "b:1", "-db", f"ledger_{tmp_path.name}"])  # there is no kafka connector here
    store = Ledger(spark, f"ledger_{tmp_path.name}")
    assert {j.JobStatus for j in store.jobs().collect()} == {"fail"}
    assert {s.LastCheckStatus for s in store.schedules().collect()} == {"failed"}


def test_to_tables(spark, site, tmp_path):
    topic = publish_to(site, tmp_path, "-a", "-dn", "-ld", f"{tmp_path}/rows", "-wm", "start")
    stream_messages.main(["-kt", topic, "-sf", "text", "-od", f"{tmp_path}/out", "-aa",
                          "-cp", f"{tmp_path}/checkpoint", "--once"])
    posts = spark.read.parquet(f"{tmp_path}/out/Posts").collect()
    comments = spark.read.parquet(f"{tmp_path}/out/Comments")
    assert len(posts) == 3 and {p.SubredditName for p in posts} == {"r/x", "r/news"}
    assert comments.count() == 6
    assert {r.AuthorName for r in comments.collect()} == {"bob"}
