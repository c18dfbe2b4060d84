"""Registered queries: each operator over whole driver tables, with flat, named columns."""

from __future__ import annotations

import datetime
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import scalars as fx
from threadloom.operators import asof, documents, extract, forest, ledger, listing, parse, route, threads
from threadloom.plans import publish, views
from threadloom.session import ensure_checkpoint_dir
from threadloom.sources import tables
from threadloom.sources.collection import Collection

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STAMP = "yyyy-MM-dd HH:mm:ss"
# Names the path queries run over; the last one is no known order.
RANKING_CHOICES = [*fx.RANKING_PATHS, "bogus"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def stamp(ts: Column) -> Column:
    return F.date_format(ts, STAMP)


def utc(ts: Column) -> Column:
    """Instant as UTC wall-clock time, whatever the session's zone."""
    return F.to_utc_timestamp(ts, F.current_timezone())


def ids_text(related: str = "RelatedCommentId") -> Column:
    return F.array_join(F.try_element_at(F.col(related), F.lit("id")), ",")


def flat(records: DataFrame) -> DataFrame:
    """Records with the id map as text, so that they compare as plain values."""
    if "RelatedCommentId" not in records.columns:
        return records
    return records.withColumn("related_ids", ids_text()).drop("RelatedCommentId")


# --- messages --------------------------------------------------------------------------------

@query
def value_decode(spark, sf_dir):
    raw = views.table(spark, sf_dir, "conversations").select(
        F.col("text").cast("binary").alias("value"))
    return parse.decode_value(raw).select(
        F.md5("value").alias("digest"), F.length("value").cast("bigint").alias("n_chars"))


@query
def envelope_roundtrip(spark, sf_dir):
    messages = parse.encode_json(views.envelope(spark, sf_dir))
    return flat(parse.parse_envelope(messages, author_alias=True))


@query
def posts(spark, sf_dir):
    messages = parse.encode_json(views.envelope(spark, sf_dir))
    return flat(route.posts(parse.parse_envelope(messages)))


@query
def comments(spark, sf_dir):
    messages = parse.encode_json(views.envelope(spark, sf_dir))
    return route.comments(parse.parse_envelope(messages))


@query
def bad_record_counts(spark, sf_dir):
    """The messages of the conversations, each broken in one of seven ways or left whole."""
    messages = parse.encode_json(
        views.envelope(spark, sf_dir).withColumn(
            "n", F.conv(F.substring(F.md5("Id"), 1, 1), 16, 10).cast("int") % 8), "n", "pos")
    value = F.col("value")

    def changed(old: str, new: str) -> Column:
        return F.replace(value, F.lit(old), F.lit(new))

    broken = F.element_at(F.array(
        value,
        F.expr("left(value, length(value) - 1)"),
        F.concat(F.lit("["), value, F.lit("]")),
        changed('"Type":"', '"Type":"un'),
        changed('"Type":', '"Kind":'),
        changed('"IsActive":true', '"IsActive":"yes"'),
        F.repeat(F.lit(" "), F.col("pos")),
        F.lit(None).cast("string"),
    ), (F.col("n") + 1).cast("int"))
    return parse.bad_record_counts(messages.select(broken.alias("value")))


@query
def route_target(spark, sf_dir):
    kind = F.when(F.col("event_type") == "view", "Post").when(
        F.col("event_type") == "click", "Comment").otherwise(F.col("event_type"))
    return views.table(spark, sf_dir, "events").select(
        "event_id", route.route_target(kind).alias("target"))


@query
def encode_json(spark, sf_dir):
    return parse.encode_json(views.envelope(spark, sf_dir), "Id")


@query
def enrich(spark, sf_dir):
    records = views.envelope(spark, sf_dir).select("Id", (F.col("pos") % 2).alias("odd"))
    ranking = F.when(F.col("odd") == 1, "topall").otherwise("new")
    return parse.enrich(
        records, fx.board_path(F.lit("r/b"), ranking), ranking, views.run_time()
    ).drop("odd")


# --- threads ---------------------------------------------------------------------------------

def _thread_parts(spark, sf_dir):
    records = views.envelope(spark, sf_dir)
    return records.filter(F.col("Type") == "Post"), records.filter(F.col("Type") == "Comment")


@query
def thread_related_ids(spark, sf_dir):
    headings, replies = _thread_parts(spark, sf_dir)
    return threads.attach_related_ids(headings.select("Id"), replies).select(
        "Id", ids_text().alias("related_ids"),
        F.size(F.col("RelatedCommentId")["id"]).cast("bigint").alias("n_related"))


@query
def thread_messages(spark, sf_dir):
    """Records to messages to typed posts with their related ids."""
    headings, replies = _thread_parts(spark, sf_dir)
    records = threads.thread_union(
        threads.attach_related_ids(headings, replies), replies.drop("RelatedCommentId"))
    return flat(route.posts(parse.parse_envelope(parse.encode_json(records))))


@query
def thread_union(spark, sf_dir):
    headings, replies = _thread_parts(spark, sf_dir)
    return threads.thread_union(
        headings.select("Type", "Id", "AuthorName", "Comment"),
        replies.select("Type", "Id", F.col("AuthorName").alias("Author"), "Comment",
                       "ParentPostId", "ParentCommentId"))


@query
def thread_order(spark, sf_dir):
    return threads.thread_order(views.envelope(spark, sf_dir)).select(
        "ThreadId", F.col("pos").alias("nth"), "Id")


@query
def comment_with_post(spark, sf_dir):
    headings, replies = _thread_parts(spark, sf_dir)
    return threads.comment_with_post(
        replies.select("Id", "ParentPostId", "AuthorName", "Comment"), headings)


@query
def comment_with_parent(spark, sf_dir):
    _, replies = _thread_parts(spark, sf_dir)
    return threads.comment_with_parent(
        replies.select("Id", "ParentCommentId", "AuthorName", "CreatedAt"))


@query
def comment_depths(spark, sf_dir):
    _, replies = _thread_parts(spark, sf_dir)
    return forest.forest(replies.select("Id", "ParentCommentId"))


@query
def event_schedule_asof(spark, sf_dir):
    """For each event the state of its board's schedule, which signups and errors set."""
    rows = views.table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", (F.col("user_id") % 5).alias("board"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    states = rows.where(F.col("event_type").isin("signup", "error")).select(
        "board", "at", F.col("event_id").alias("set_by"), F.col("event_type").alias("status"))
    day = 86_400_000_000
    return asof.asof_join(rows, states, "board", "at", "set_by", day).select(
        "event_id", "board", F.col("state.set_by").alias("set_by"),
        F.col("state.status").alias("status"))


# --- listings --------------------------------------------------------------------------------

_LISTED = ["board", "fullname", "created_ms"]


@query
def listing_select(spark, sf_dir):
    return listing.select_listing(
        views.listing(spark, sf_dir), views.NOW_MS, take_all=True, page_size=None
    ).select(*_LISTED, "permalink")


@query
def listing_counts(spark, sf_dir):
    rows = views.listing(spark, sf_dir)
    modes = {
        "all": listing.select_listing(rows, views.NOW_MS, take_all=True, count_limit=7, page_size=None),
        "count": listing.select_listing(
            rows, views.NOW_MS, count_limit=7, period=views.PERIOD, page_size=None),
        "period": listing.select_listing(
            rows, views.NOW_MS, period=views.PERIOD, page_size=None),
    }
    counts = [
        listing.listing_counts(chosen).withColumn("mode", F.lit(mode))
        for mode, chosen in modes.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def take_while_recent(spark, sf_dir):
    return listing.take_while_recent(
        views.listing(spark, sf_dir), views.NOW_MS, views.PERIOD).select(*_LISTED)


@query
def first_n_per_group(spark, sf_dir):
    return listing.first_n(views.listing(spark, sf_dir), 10).select(*_LISTED)


@query
def recent_in_period(spark, sf_dir):
    return listing.recent(
        views.listing(spark, sf_dir), views.NOW_MS, views.PERIOD).select(*_LISTED)


@query
def listing_pages(spark, sf_dir):
    return listing.listing_pages(views.listing(spark, sf_dir))


@query
def listing_pages_sparse(spark, sf_dir):
    return listing.listing_pages(views.listing(spark, sf_dir, n_boards=50), page_size=2)


@query
def listing_reached(spark, sf_dir):
    return listing.reached_listing(
        views.listing(spark, sf_dir, n_boards=50), page_size=2).select(*_LISTED, "page_no")


def _board_plan(rows: DataFrame) -> DataFrame:
    """A run per board of the listing: all, first n, a given period, or since the last run."""
    number = F.col("board").cast("int")
    plan = rows.groupBy("board").agg(F.count("*").alias("_n")).select(
        "board",
        (number == 0).alias("take_all"),
        F.when(number.isin(1, 2), number * 10).alias("count_limit"),
        F.when(number == 3, F.lit(views.PERIOD).cast("double")).alias("period"),
        F.when(number == 4, F.timestamp_millis(F.lit(views.NOW_MS - 100_000 * 1000)))
        .alias("LastParsedDate"),
    )
    return ledger.resolve_mode(plan, F.timestamp_millis(F.lit(views.NOW_MS)))


@query
def listing_by_plan(spark, sf_dir):
    rows = views.listing(spark, sf_dir)
    return listing.select_by_plan(
        rows, _board_plan(rows), views.NOW_MS, page_size=None).select(*_LISTED)


@query
def listing_crawl(spark, sf_dir):
    """Every mode, ending where the listing ends: at a page that is not full or not there."""
    rows = views.listing(spark, sf_dir, n_boards=50)
    chosen = {
        "all": listing.select_listing(rows, views.NOW_MS, take_all=True, page_size=2),
        "count": listing.select_listing(rows, views.NOW_MS, count_limit=9, page_size=2),
        "period": listing.select_listing(rows, views.NOW_MS, period=views.PERIOD, page_size=2),
        "plan": listing.select_by_plan(rows, _board_plan(rows), views.NOW_MS, page_size=2),
    }
    return functools.reduce(DataFrame.unionByName, [
        part.select(F.lit(mode).alias("mode"), "board", "fullname", "page_no")
        for mode, part in chosen.items()])


# --- scalar functions ------------------------------------------------------------------------

def _ranking(event: Column) -> Column:
    return F.element_at(
        F.array(*[F.lit(r) for r in RANKING_CHOICES]),
        (event % len(RANKING_CHOICES) + 1).cast("int"))


@query
def board_path(spark, sf_dir):
    name = (
        F.when(F.col("event_type") == "view", "r/news")
        .when(F.col("event_type") == "click", "/r/friday/")
        .otherwise(F.concat(F.lit("r/b"), F.col("user_id").cast("string")))
    )
    return views.table(spark, sf_dir, "events").select(
        "event_id", fx.board_path(name, _ranking(F.col("event_id"))).alias("path"))


@query
def next_page_suffix(spark, sf_dir):
    path = fx.board_path(F.lit("r/b"), _ranking(F.col("event_id")))
    cursor = F.concat(F.lit("t3_"), F.col("props"), F.lit("~*"))
    return views.table(spark, sf_dir, "events").select(
        "event_id", fx.next_page_suffix(path, cursor).alias("suffix"))


@query
def absolute_url(spark, sf_dir):
    path = F.regexp_extract("url", r"^https?://[^/]+(.*)$", 1)
    return views.table(spark, sf_dir, "pages").select(
        "page_id", fx.absolute_url(views.BASE_URL, path).alias("full_url"))


@query
def hms(spark, sf_dir):
    return views.table(spark, sf_dir, "events").select(
        "event_id", fx.hms(F.col("value") * 1000 - 5000).alias("hms"))


@query
def created_ts(spark, sf_dir):
    text = F.when(F.col("promoted") == "true", F.col("permalink")).otherwise(
        F.col("created_ms").cast("string"))
    return views.listing(spark, sf_dir).select(
        "fullname", stamp(utc(fx.created_ts(text))).alias("created"))


@query
def iso_to_millis(spark, sf_dir):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+04:00"))
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(iso)
    return views.table(spark, sf_dir, "events").select(
        "event_id", fx.iso_to_millis(text).alias("millis"))


@query
def zone_display(spark, sf_dir):
    return views.table(spark, sf_dir, "events").select(
        "event_id", stamp(fx.to_zone("ts", "Asia/Baku")).alias("shown"))


# --- ledger ----------------------------------------------------------------------------------

@query
def ledger_left_join_filtered(spark, sf_dir):
    return ledger.active_schedules(
        views.boards(spark, sf_dir), views.schedules(spark, sf_dir)
    ).withColumn("LastParsedDate", stamp(F.col("LastParsedDate")))


@query
def ledger_lookup_top1(spark, sf_dir):
    found = ledger.latest_schedule(views.boards(spark, sf_dir), views.schedules(spark, sf_dir))
    return found.withColumn("is_ready", ledger.is_ready()).withColumn(
        "LastParsedDate", stamp(F.col("LastParsedDate")))


@query
def lookup_board(spark, sf_dir):
    """The board and schedule of one name, many boards sharing it."""
    found = ledger.lookup_board(
        views.boards(spark, sf_dir), views.schedules(spark, sf_dir), "r/BUILDING3")
    return found.select(
        "SubredditId", "SubredditName", "SubredditScheduleId",
        stamp(F.col("LastParsedDate")).alias("LastParsedDate"))


@query
def sql_bound_rows(spark, sf_dir):
    """SQL text with its values bound: what each customer of a segment ordered since a day."""
    return tables.run_sql(
        spark, f"""
        select c_custkey, count(*) as n_orders, max(o_orderkey) as last_order
        from parquet.`{sf_dir}/orders.parquet` join parquet.`{sf_dir}/customer.parquet`
          on o_custkey = c_custkey
        where c_mktsegment = :segment and o_orderdate >= :since
        group by c_custkey""",
        segment="BUILDING", since=datetime.date(1995, 1, 1))


@query
def sql_first_row(spark, sf_dir):
    """First row of a bound query: the last order of one status."""
    row = tables.fetch_first(
        spark, f"""
        select o_orderkey, o_custkey, o_orderstatus from parquet.`{sf_dir}/orders.parquet`
        where o_orderstatus = :status order by o_orderdate desc, o_orderkey desc""", status="O")
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string"
    return spark.createDataFrame([] if row is None else [tuple(row)], schema)


@query
def get_or_create_topic(spark, sf_dir):
    topics = views.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("TopicId"), F.col("n_name").alias("TopicName"))
    name = F.when(
        F.col("event_type") == "view",
        F.concat(F.lit("NATION_"), (F.col("user_id") % 30).cast("string"))
    ).otherwise(F.concat_ws("-", "event_type", F.col("user_id").cast("string")))
    requested = views.table(spark, sf_dir, "events").select(name.alias("TopicName"))
    return ledger.get_or_create_topic(topics, requested)


@query
def get_or_create_board(spark, sf_dir):
    boards = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("SubredditId"), F.col("c_name").alias("SubredditName"))
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("event_id").cast("string"), 9, "0"))
    requested = views.table(spark, sf_dir, "events").select(name.alias("SubredditName"))
    return ledger.get_or_create_board(
        boards, views.schedules(spark, sf_dir), requested
    ).withColumn("LastParsedDate", stamp(F.col("LastParsedDate")))


@query
def ledger_job_update(spark, sf_dir):
    jobs = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("SubredditJobId"),
        F.lit(None).cast("bigint").alias("SubredditId"),
        (F.col("o_orderkey") % 2 + 1).cast("int").alias("JobTypeId"),
        F.lit(None).cast("bigint").alias("TopicId"),
        "o_custkey", "o_orderstatus")
    types = views.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("JobTypeId"), F.col("n_name").alias("JobTypeName"))
    return ledger.attach_job(
        jobs, types, F.col("o_orderstatus") == "P", "Nation_7", F.col("o_custkey"),
        F.col("o_custkey") % 10
    ).drop("o_custkey", "o_orderstatus")


@query
def ledger_job_latest(spark, sf_dir):
    status = F.when(F.col("event_type") == "signup", "started").when(
        F.col("event_type") == "error", "fail").otherwise("success")
    events = views.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("SubredditJobId"), F.col("ts").alias("at"),
        status.alias("JobStatus"))
    return ledger.job_latest(events).withColumns({
        "JobStartDate": stamp(F.col("JobStartDate")), "JobEndDate": stamp(F.col("JobEndDate"))})


@query
def ledger_schedule_close(spark, sf_dir):
    rows = views.schedules(spark, sf_dir).withColumn(
        "ended", F.element_at(F.array(F.lit("Success"), F.lit("failed"), F.lit("other")),
                              (F.col("SubredditId") % 3 + 1).cast("int")))
    closed = ledger.close_schedule(
        rows, F.col("ended"), F.col("IsActive"), views.run_time())
    running = ledger.mark_running(closed, ~F.col("IsActive") & (F.col("ended") == "other"))
    return running.select(
        "SubredditScheduleId", "LastCheckStatus",
        stamp(F.col("LastParsedDate")).alias("LastParsedDate"))


@query
def ledger_jobs_by_type(spark, sf_dir):
    jobs = views.table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "click", 2).cast("int").alias("JobTypeId"))
    types = ledger.seed_job_types(spark).select("JobTypeId", "JobTypeName")
    counts = ledger.with_job_defaults(jobs).groupBy("JobTypeId").agg(F.count("*").alias("n_jobs"))
    return counts.join(types, "JobTypeId")


def _run_plan(spark, sf_dir):
    last = views.schedules(spark, sf_dir).filter("IsActive").groupBy("SubredditId").agg(
        F.max("LastParsedDate").alias("LastParsedDate"))
    runs = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("SubredditId"),
        (F.col("c_nationkey") == 0).alias("take_all"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey")).alias("count_limit"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(3600.0)).alias("period"))
    return runs.join(last, "SubredditId", "left")


@query
def incremental_period(spark, sf_dir):
    return ledger.incremental_period(_run_plan(spark, sf_dir), views.run_time()).select(
        "SubredditId", "period")


@query
def resolve_mode(spark, sf_dir):
    return ledger.resolve_mode(_run_plan(spark, sf_dir), views.run_time()).select(
        "SubredditId", "mode", "period")


# --- documents -------------------------------------------------------------------------------

_DOC = {"lang": "en", "source": "src3"}
_CHANGE = {"lang": "xx", "source": "archive"}


def _documents(spark, sf_dir):
    return views.table(spark, sf_dir, "documents")


@query
def doc_find(spark, sf_dir):
    return documents.find(_documents(spark, sf_dir), _DOC).select(
        "doc_id", "lang", "source", "n_chars", F.md5("text").alias("digest"))


@query
def doc_insert(spark, sf_dir):
    new = views.table(spark, sf_dir, "benchmark").select(
        (F.col("item_id") + 1_000_000_000_000).alias("doc_id"), "text",
        F.length("text").cast("bigint").alias("n_chars"))
    return documents.insert(_documents(spark, sf_dir), new).select(
        "doc_id", "lang", "source", "n_chars", F.md5("text").alias("digest"))


@query
def doc_update_one(spark, sf_dir):
    return documents.update_first(_documents(spark, sf_dir), _DOC, _CHANGE, "doc_id").select(
        "doc_id", "lang", "source", "n_chars")


@query
def doc_update_counts(spark, sf_dir):
    return documents.update_counts(_documents(spark, sf_dir), _DOC, _CHANGE, "doc_id")


@query
def doc_delete_many(spark, sf_dir):
    return documents.delete_matching(_documents(spark, sf_dir), _DOC).select(
        "doc_id", "lang", "source", "n_chars")


@query
def doc_rewrite(spark, sf_dir):
    """The stored collection after one update and one delete, which rewrite few of its files."""
    root = f"{ensure_checkpoint_dir(spark)}/collection-{uuid.uuid4().hex}"
    stored = Collection(spark, root, ("doc_id", "lang", "source"))
    stored.insert(_documents(spark, sf_dir).repartitionByRange(8, "source"))
    stored.update_first(_DOC, _CHANGE, "doc_id")
    stored.delete({"source": "src3", "lang": "en"})
    return stored.read().select("doc_id", "lang", "source", "n_chars")


@query
def doc_delete_counts(spark, sf_dir):
    return documents.delete_count(_documents(spark, sf_dir), _DOC)


# --- pages -----------------------------------------------------------------------------------

@query
def page_title(spark, sf_dir):
    return extract.page_title(views.table(spark, sf_dir, "pages")).select(
        "page_id", "url", "title")


@query
def listing_extract(spark, sf_dir):
    pages = views.listing_page_html(views.listing(spark, sf_dir))
    return extract.extract_listing(pages).select(
        "board", "page_no", F.col("pos").cast("bigint").alias("nth"), "fullname", "created_ms",
        "permalink", "promoted")


@query
def listing_page_cursor(spark, sf_dir):
    """Size, cursor and end flag straight from a page's own elements, without a shuffle."""
    pages = views.listing_page_html(views.listing(spark, sf_dir))
    return extract.extract_listing_pages(pages).select(
        "board", "page_no", "n_elements", "cursor",
        (F.col("n_elements") < fx.PAGE_SIZE).alias("is_last"))


@query
def thread_extract(spark, sf_dir):
    pages = views.thread_page_html(views.envelope(spark, sf_dir))
    records = extract.combine_parts(
        extract.extract_thread(pages, ("url", "part")), ("url",), "part")
    return flat(records.drop("part", "pos"))


@query
def publish_threads(spark, sf_dir):
    """Listing pages and thread pages of the conversations, to messages, to typed records."""
    records = views.envelope(spark, sf_dir)
    heads = records.filter(F.col("Type") == "Post")
    conv = F.split_part("Id", F.lit("_"), F.lit(2)).cast("bigint")
    listed = heads.select(
        (conv % 5).cast("string").alias("board"),
        F.floor(conv / views.LISTING_SPAN).alias("page_no"),
        (conv % views.LISTING_SPAN).cast("int").alias("pos"),
        F.col("Id").alias("fullname"),
        F.col("CreatedAt").cast("bigint").alias("created_ms"),
        F.concat(F.lit("/comments/"), F.col("Id"), F.lit("/")).alias("permalink"),
        F.when(conv % 7 == 0, "true").otherwise("false").alias("promoted"))
    ranking = F.when(F.col("board") == "2", "topall").otherwise("new")
    plan = _board_plan(listed).withColumns({
        "path": fx.board_path(F.concat(F.lit("r/b"), F.col("board")), ranking),
        "ranking": ranking})
    published = publish.publish_records(
        views.listing_page_html(listed), views.thread_page_html(records), plan,
        views.NOW_MS, views.BASE_URL, views.run_time(), part="part")
    return flat(parse.parse_envelope(parse.encode_json(published)))
