"""Selection from board listings.

A listing row is one element of one listing page: board, page_no, pos, fullname, created_ms,
permalink, promoted. Listing order is (page_no, pos). Nothing here sorts or gathers a whole board:
where the order matters, the cut-off of each board is found by aggregates, and rows are compared
with it. Cut-offs are the same on every reading, so none is stored.
"""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.scalars import DEFAULT_PERIOD, PAGE_SIZE, in_period, in_period_by
from threadloom.operators.joins import (
    MAX_BROADCAST_BYTES,
    bounded_join,
    lookup_join,
    measured_bytes,
)

# Pages are counted in blocks of this many, so that no task orders all pages of a board.
_BLOCK = 4096
_PLACES = 1 << 31  # of a page: every int


def listing_rank(page_no: Column | str = "page_no", pos: Column | str = "pos") -> Column:
    """Listing order as one number, wide enough for any page and place; no place is the last one.

    A decimal, unlike a struct, is aggregated by hash without sorting.
    """
    page_no = F.col(page_no) if isinstance(page_no, str) else page_no
    pos = F.col(pos) if isinstance(pos, str) else pos
    place = F.coalesce(pos.cast("bigint"), F.lit(_PLACES - 1)).cast("decimal(11,0)")
    first = page_no.cast("decimal(20,0)") * F.lit(Decimal(_PLACES))
    return (first + place).cast("decimal(38,0)")


def organic(listing: DataFrame) -> DataFrame:
    """Rows that are not promoted; an unknown flag counts as not promoted."""
    return listing.filter(~F.col("promoted").eqNullSafe(F.lit("true"))).drop("promoted")


def recent(listing: DataFrame, now: datetime | int, period: float | None) -> DataFrame:
    """Plain age filter, without regard to order."""
    return listing.filter(in_period("created_ms", now, period))


def before_stop(rows: DataFrame, stops: DataFrame) -> DataFrame:
    """Rows ahead of their board's stop rank; boards without a stop are kept whole."""
    kept = lookup_join(rows, stops, "board", "left")
    return kept.filter(
        F.col("_stop").isNull() | (listing_rank() < F.col("_stop"))).drop("_stop")


def _stops(failing: DataFrame) -> DataFrame:
    return failing.groupBy("board").agg(F.min(listing_rank()).alias("_stop"))


def take_while(rows: DataFrame, keep: Column) -> DataFrame:
    """Rows of each board up to, and without, the first that fails `keep`."""
    return before_stop(rows, _stops(rows.filter(~keep)))


def take_while_recent(listing: DataFrame, now: datetime | int, period: float | None) -> DataFrame:
    """Non-promoted rows until the first one out of period, though later ones may qualify.

    A row without a time does not stop its board.
    """
    return take_while(organic(listing), in_period("created_ms", now, period or DEFAULT_PERIOD))


def count_stops(pages: DataFrame) -> DataFrame:
    """Where each board has `_limit` rows: all pages before `_page`, and `_nth` rows of that one.

    `pages` has board, page_no, `_n` rows and `_limit`. Blocks of pages are counted first, then
    the pages of the one block that reaches the limit. Boards of fewer rows have no stop.
    """
    def reaching(counts: DataFrame, *order: str) -> DataFrame:
        before = Window.partitionBy("board").orderBy(*order).rowsBetween(
            Window.unboundedPreceding, -1)
        seen = F.col("_seen") + F.coalesce(F.sum("_n").over(before), F.lit(0))
        return counts.withColumn("_seen", seen).filter(
            (F.col("_seen") < F.col("_limit")) & (F.col("_seen") + F.col("_n") >= F.col("_limit")))

    block = F.floor(F.col("page_no") / _BLOCK)
    pages = pages.withColumn("_block", block)
    blocks = pages.groupBy("board", "_block").agg(
        F.sum("_n").alias("_n"), F.max("_limit").alias("_limit")).withColumn("_seen", F.lit(0))
    within = pages.join(
        reaching(blocks, "_block").select("board", "_block", "_seen"), ["board", "_block"])
    return reaching(within, "page_no").select(
        "board", F.col("page_no").alias("_page"), (F.col("_limit") - F.col("_seen")).alias("_nth"))


def up_to_count(rows: DataFrame) -> DataFrame:
    """Rows up to their board's `_page` and `_nth`; all where these are null.

    Only rows of the one page in which a board ends are ordered.
    """
    before = rows.filter(F.col("_page").isNull() | (F.col("page_no") < F.col("_page")))
    order = Window.partitionBy("board").orderBy(listing_rank())
    ending = rows.filter(F.col("page_no") == F.col("_page")).withColumn(
        "_at", F.row_number().over(order)).filter(F.col("_at") <= F.col("_nth")).drop("_at")
    return before.unionByName(ending).drop("_page", "_nth")


def _page_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("board", "page_no").agg(F.count("*").alias("_n"))


def first_n_organic(rows: DataFrame, n: int) -> DataFrame:
    """First n rows of each board."""
    stops = count_stops(_page_counts(rows).withColumn("_limit", F.lit(n)))
    return up_to_count(lookup_join(rows, stops, "board", "left"))


def first_n(listing: DataFrame, n: int) -> DataFrame:
    """First n non-promoted rows of each board."""
    return first_n_organic(organic(listing), n)


def select_listing(
    listing: DataFrame,
    now: datetime | int,
    take_all: bool = False,
    count_limit: int | None = None,
    period: float | None = None,
    page_size: int | None = PAGE_SIZE,
) -> DataFrame:
    """Rows one run takes: all if asked, else the first `count_limit`, else take-while by age.

    In every mode a board ends with its first page of fewer than `page_size` elements, or where a
    page is missing; None goes on regardless.
    """
    if page_size is not None:
        listing = reached_listing(listing, page_size)
    if take_all:
        return organic(listing)
    if count_limit:
        return first_n(listing, count_limit)
    return take_while_recent(listing, now, period)


def select_by_plan(
    listing: DataFrame, plan: DataFrame, now: datetime | int, page_size: int | None = PAGE_SIZE
) -> DataFrame:
    """As select_listing for many boards at once, each with its own mode.

    `plan` has one row per board: board, mode ('all', 'count' or 'period'), count_limit, period.
    Boards without a plan are not taken. What is looked up has a row per board of the plan, so the
    plan alone is measured.
    """
    plan = plan.select("board", "mode", "count_limit", "period")
    is_small = measured_bytes(plan) <= MAX_BROADCAST_BYTES
    rows = organic(listing)
    by_age = plan.filter(F.col("mode") == "period").select(
        "board", F.coalesce(F.nullif("period", F.lit(0)), F.lit(DEFAULT_PERIOD)).alias("period"))
    old = bounded_join(rows, by_age, "board", "inner", is_small).filter(
        ~in_period_by("created_ms", now, F.col("period")))
    by_count = plan.filter(F.col("mode") == "count").select(
        "board", F.col("count_limit").alias("_limit"))
    counted = count_stops(_page_counts(rows).join(by_count, "board"))

    ends = plan.select("board").join(_stops(old), "board", "left").join(counted, "board", "left")
    if page_size is not None:
        ends = ends.join(crawl_ends(listing, page_size), "board", "left")
        end = listing_rank(F.col("_last_page") + 1, F.lit(0))
        ends = ends.withColumn("_stop", F.least("_stop", end)).drop("_last_page")
    chosen = bounded_join(rows, ends, "board", "inner", is_small).filter(
        F.col("_stop").isNull() | (listing_rank() < F.col("_stop"))).drop("_stop")
    return up_to_count(chosen)


def listing_counts(selected: DataFrame) -> DataFrame:
    return selected.groupBy("board").agg(F.count("*").alias("n_posts"))


def page_stats(listing: DataFrame) -> DataFrame:
    """Elements and cursor (id of the last element) per page; promoted elements count."""
    return listing.groupBy("board", "page_no").agg(
        F.count("*").alias("n_elements"), F.max_by("fullname", "pos").alias("cursor"))


def _followed(pages: DataFrame) -> DataFrame:
    """Pages with `_next`, whether the board's next page is present."""
    marks = F.array(
        F.struct(F.col("page_no"), F.col("n_elements"), F.lit(False).alias("_next")),
        F.struct((F.col("page_no") - 1).alias("page_no"),
                 F.lit(None).cast("bigint").alias("n_elements"), F.lit(True).alias("_next")))
    return pages.select("board", F.inline(marks)).groupBy("board", "page_no").agg(
        F.max("n_elements").alias("n_elements"), F.max("_next").alias("_next")
    ).filter(F.col("n_elements").isNotNull())


def crawl_ends(listing: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """The last page of each board that a page-by-page crawl gets to, as `_last_page`.

    That is the first page that is not full, or after which one is missing; -1 without page 0.
    """
    pages = _followed(listing.groupBy("board", "page_no").agg(F.count("*").alias("n_elements")))
    is_end = (F.col("n_elements") < page_size) | ~F.col("_next")
    return pages.groupBy("board").agg(
        F.min("page_no").alias("_first"),
        F.min(F.when(is_end, F.col("page_no"))).alias("_last")
    ).select("board", F.when(F.col("_first") > 0, -1).otherwise(F.col("_last")).alias("_last_page"))


def listing_pages(listing: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Per page that is there: size, cursor, whether it is not full, whether a crawl gets to it."""
    pages = lookup_join(page_stats(listing), crawl_ends(listing, page_size), "board", "left")
    return pages.withColumns({
        "is_last": F.col("n_elements") < page_size,
        "is_reached": F.col("page_no") <= F.col("_last_page"),
    }).drop("_last_page")


def reached_listing(listing: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Rows a page-by-page crawl sees: up to the last page it gets to."""
    ends = crawl_ends(listing, page_size)
    return lookup_join(listing, ends, "board").filter(
        F.col("page_no") <= F.col("_last_page")).drop("_last_page")
