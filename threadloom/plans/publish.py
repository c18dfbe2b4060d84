"""Fetched pages to messages, for many boards in one job."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.scalars import PAGE_SIZE, absolute_url
from threadloom.operators.extract import combine_parts, extract_listing, extract_thread
from threadloom.operators.joins import (
    MAX_BROADCAST_BYTES,
    lookup_join,
    measured_bytes,
    spread_join,
)
from threadloom.operators.listing import select_by_plan
from threadloom.operators.parse import encode_json, enrich
from threadloom.session import materialize

# Bits by which unwanted pages are told apart before they are read: 16 MB in all.
URL_BITS = 1 << 27


def selected_threads(
    listing: DataFrame, plan: DataFrame, now: datetime | int, base_url: str,
    page_size: int | None = PAGE_SIZE,
) -> DataFrame:
    """(url, path, ranking) of every post the plan takes.

    `listing` is a table of listing pages (with html) or of rows extracted from them. Cut-offs and
    selection each go over the rows, so pages are read once and their rows stored.
    """
    rows = materialize(extract_listing(listing)) if "html" in listing.columns else listing
    chosen = select_by_plan(rows, plan, now, page_size)
    runs = lookup_join(chosen, plan.select("board", "path", "ranking"), "board")
    return runs.select(absolute_url(base_url, "permalink").alias("url"), "path", "ranking")


def wanted_pages(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """Pages whose url may be wanted: all that are, and few others.

    Urls are hashed into a bitmap of fixed size, so what is broadcast does not grow with them. At
    27 bits a hundred million wanted urls still keep about half of the others out.
    """
    place = F.pmod(F.xxhash64("url"), F.lit(URL_BITS))
    bits = wanted.select(place.alias("_place")).groupBy(
        F.bitmap_bucket_number("_place").alias("_bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    at = F.bitmap_bit_position("_place").cast("int")
    byte = F.conv(F.hex(F.col("_bits").substr(F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.call_function("shiftright", byte.cast("int"), at % 8).bitwiseAND(F.lit(1)) == 1
    return (
        pages.withColumn("_place", place)
        .withColumn("_bucket", F.bitmap_bucket_number("_place"))
        .join(F.broadcast(bits), "_bucket").filter(is_set).drop("_place", "_bucket", "_bits")
    )


def publish_records(
    listing: DataFrame,
    thread_pages: DataFrame,
    plan: DataFrame,
    now: datetime | int,
    base_url: str,
    run_time: Column | None = None,
    part: str | None = None,
    page_size: int | None = PAGE_SIZE,
    max_broadcast: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Post and comment records of the threads the plan takes, with the run's data.

    `plan` has one row per board: board, path, ranking and the columns of select_by_plan. Only
    wanted pages are read, and markup, which is many times larger than records, is never shuffled:
    the wanted urls are measured and broadcast, or a bitmap of them keeps unwanted pages from the
    reader and the records are joined. `part` names the column that orders the pages of a thread,
    if it may have several.
    """
    wanted = materialize(selected_threads(listing, plan, now, base_url, page_size))
    keys = ("url", *([part] if part else []))
    if measured_bytes(wanted) <= max_broadcast:
        pages = thread_pages.join(F.broadcast(wanted), "url")
        records = extract_thread(pages, (*keys, "path", "ranking"))
    else:
        pages = wanted_pages(thread_pages, wanted)
        records = spread_join(extract_thread(pages, keys), wanted, "url")
    if part:
        records = combine_parts(records, ("url", "path", "ranking"), part)
    return enrich(records, F.col("path"), F.col("ranking"), run_time).drop("path", "ranking")


def publish_messages(*args, **kwargs) -> DataFrame:
    """As publish_records, as JSON messages in `value`."""
    return encode_json(publish_records(*args, **kwargs))
