"""The driver tables seen as this engine's data: messages, listings, pages, ledger tables.

Used by the registered queries, the benchmark and the tests. Every view is derived from the whole
table by column expressions; the rendered pages group by keys that bound a group's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NOW_MS = 1_706_659_200_000  # 2024-01-31 00:00:00 UTC, the fixed run time of the queries
NOW_TEXT = "2024-01-31 00:00:00"
PERIOD = 150_000  # seconds
BASE_URL = "https://forum.example"
FIRST_POST_MS = 1_704_067_200_000
LISTING_SPAN = 125  # events per listing page number, about 25 for each of the five boards
COMMENTS_PER_PAGE = 200  # a longer thread is rendered as several parts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_time() -> Column:
    return F.lit(NOW_TEXT).cast("timestamp_ntz")


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as thread records: turn 0 is the post, each later turn answers the one
    before it. `pos` is the turn."""
    conv, turn = F.col("conv_id"), F.col("turn")
    is_post = turn == 0
    post_id = _text("t3_", conv, "_0")
    own_id = F.when(is_post, post_id).otherwise(_text("t1_", conv, "_", turn))
    return table(spark, sf_dir, "conversations").select(
        turn.alias("pos"),
        F.when(is_post, "Post").otherwise("Comment").alias("Type"),
        own_id.alias("Id"),
        _text("t2_", F.col("role")).alias("AuthorId"),
        F.col("role").alias("AuthorName"),
        F.lit("new").alias("SubredditRankingType"),
        _text("/r/b", conv % 5, "/comments/", own_id, "/").alias("Permalink"),
        F.col("text").alias("Comment"),
        _text(FIRST_POST_MS + conv * 3_600_000 + turn * 60_000).alias("CreatedAt"),
        F.when(turn > 1, _text("t1_", conv, "_", turn - 1)).alias("ParentCommentId"),
        F.when(turn > 0, post_id).alias("ParentPostId"),
        _text("/r/b", conv % 5, "/new/").alias("SubredditName"),
        F.lit(None).cast("map<string,array<string>>").alias("RelatedCommentId"),
        F.lit(True).alias("IsActive"),
        F.lit(NOW_TEXT).alias("ParsedTime"),
    )


def listing(spark: SparkSession, sf_dir: str, n_boards: int = 5) -> DataFrame:
    """Events as listing rows in event order; age comes from `value`, so it does not follow the
    order. Flags are 'true', 'false', empty or missing. With more boards pages get shorter, and
    some are blank."""
    event, kind = F.col("event_id"), F.col("event_type")
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % n_boards).cast("string").alias("board"),
        F.expr(f"event_id div {LISTING_SPAN}").alias("page_no"),
        (event % LISTING_SPAN).cast("int").alias("pos"),
        _text("t3_", event).alias("fullname"),
        (NOW_MS - F.floor(F.col("value") * 1000).cast("bigint") * 1000).alias("created_ms"),
        _text("/r/b/comments/", event, "/").alias("permalink"),
        F.when(kind == "error", "true").when(kind == "signup", F.lit(None))
        .when(kind == "click", "").otherwise("false").alias("promoted"),
    )


def escape(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def _attribute(name: str, value: Column) -> Column:
    """` name="value"`, nothing for null."""
    return F.coalesce(_text(f' {name}="', escape(value.cast("string")), '"'), F.lit(""))


def _joined(order: str, markup: str) -> Column:
    parts = F.array_sort(F.collect_list(F.struct(order, markup)))
    return F.array_join(F.transform(parts, lambda part: part[markup]), "")


def listing_page_html(rows: DataFrame) -> DataFrame:
    """Listing rows rendered as pages (board, page_no, html)."""
    element = _text(
        '<div class="spacer"><br></div><div class="thing link"',
        _attribute("data-fullname", F.col("fullname")),
        _attribute("data-timestamp", F.col("created_ms")),
        _attribute("data-permalink", F.col("permalink")),
        _attribute("data-promoted", F.col("promoted")),
        '><p class="title"><a href="#">', F.col("fullname"), "</a></p></div>")
    return (
        rows.select("board", "page_no", "pos", element.alias("_html"))
        .groupBy("board", "page_no").agg(_joined("pos", "_html").alias("_html"))
        .select("board", "page_no",
                _text("<html><body>", F.col("_html"), "</body></html>").alias("html"))
    )


def thread_page_html(records: DataFrame) -> DataFrame:
    """Thread records rendered as pages (url, part, html).

    A reply is nested in the comment it answers. After COMMENTS_PER_PAGE comments a thread goes on
    in a further part, which repeats the post's id and, as context, the comment that is answered.
    """
    body = _text('<div class="md"><p>', escape(F.col("Comment")), "</p></div>")
    heading = _text(
        '<div class="thing link"',
        _attribute("data-fullname", F.col("Id")),
        _attribute("data-timestamp", F.col("CreatedAt")),
        _attribute("data-author", F.col("AuthorName")),
        _attribute("data-author-fullname", F.col("AuthorId")),
        '><p class="title"><a href="', F.col("Permalink"), '">link</a></p>', body,
        '</div><div class="commentarea">')
    iso = F.date_format(
        F.timestamp_millis(F.col("CreatedAt").cast("bigint")), "yyyy-MM-dd'T'HH:mm:ssXXX")
    comment = _text(
        '<div class="thing comment" data-type="comment"',
        _attribute("data-fullname", F.col("Id")),
        _attribute("data-author", F.col("AuthorName")),
        _attribute("data-author-fullname", F.col("AuthorId")),
        _attribute("data-permalink", F.col("Permalink")),
        '><p class="tagline"><time class="live-timestamp" datetime="', iso, '"></time></p>',
        body, '<div class="child">')
    part = F.when(F.col("pos") == 0, 0).otherwise(
        F.floor((F.col("pos") - 1) / COMMENTS_PER_PAGE)).cast("int")
    is_post = F.col("Type") == "Post"
    goes_on = (F.col("pos") > 1) & (F.col("pos") % COMMENTS_PER_PAGE == 1) & F.col(
        "ParentCommentId").isNotNull()
    context = _text(
        '<div class="thing comment" data-type="comment" data-context="1"',
        _attribute("data-fullname", F.col("ParentCommentId")), '><div class="child">')
    thread = F.coalesce("ParentPostId", "Id")
    bare_heading = _text(
        '<div class="thing link"', _attribute("data-fullname", F.col("_thread")),
        '></div><div class="commentarea">')
    return (
        records.select(
            thread.alias("_thread"), part.alias("part"), "pos",
            F.when(is_post, heading).when(goes_on, F.concat(context, comment)).otherwise(
                comment).alias("_html"),
            F.when(is_post, 0).when(goes_on, 2).otherwise(1).alias("_nested"))
        .groupBy("_thread", "part")
        .agg(_joined("pos", "_html").alias("_html"), F.sum("_nested").cast("int").alias("_depth"))
        .select(
            _text(BASE_URL, "/comments/", F.col("_thread"), "/").alias("url"),
            "part",
            _text("<html><body>", F.when(F.col("part") > 0, bare_heading).otherwise(F.lit("")),
                  F.col("_html"), F.repeat(F.lit("</div></div>"), F.col("_depth")),
                  "</div></body></html>").alias("html"))
    )


def boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as boards. Many boards share a name."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("SubredditId"),
        _text("r/", F.col("c_mktsegment"), F.col("c_nationkey")).alias("SubredditName"),
    )


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as schedules of boards; those of status O are active."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("SubredditScheduleId"),
        F.col("o_custkey").alias("SubredditId"),
        F.col("o_orderdate").alias("LastParsedDate"),
        F.col("o_orderpriority").alias("LastCheckStatus"),
        (F.col("o_orderstatus") == "O").alias("IsActive"),
    )
