"""Page extraction: tables of fetched pages to listing rows and thread records.

The pages table keeps its own partitioning. Listing pages are read by column expressions. Thread
pages need their nesting, so each task reads them in Arrow batches, which Spark bounds in bytes.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from threadloom.functions import html
from threadloom.functions.html import ThreadReader
from threadloom.functions.markup import (
    attribute_value,
    bound,
    given_attributes,
    tags_with,
    with_attributes,
)
from threadloom.functions.scalars import iso_to_millis
from threadloom.operators.threads import related_map
from threadloom.session import materialize

# The readers travel inside the task closure, so executors need no copy of this package.
for _module in (html, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

_THREAD = StructType([
    StructField("pos", IntegerType()),
    StructField("Type", StringType()),
    StructField("Id", StringType()),
    StructField("AuthorId", StringType()),
    StructField("AuthorName", StringType()),
    StructField("Author", StringType()),
    StructField("Permalink", StringType()),
    StructField("Comment", StringType()),
    StructField("_time", StringType()),
    StructField("ParentCommentId", StringType()),
    StructField("ParentPostId", StringType()),
    StructField("_related", ArrayType(StringType())),
])


def _per_page(
    pages: DataFrame, keys: tuple[str, ...], rows: StructType, read: Callable[[str], list[tuple]]
) -> DataFrame:
    """Pages with `rows`, the array of what `read` finds in each one's html."""
    key_fields = [pages.schema[key] for key in keys]
    out = StructType([*key_fields, StructField("rows", ArrayType(rows))])
    rows_type = to_arrow_schema(out).field("rows").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = list(rows_type.value_type)
        for batch in batches:
            found: list[tuple] = []
            ends = [0]
            for page in batch.column("html").to_pylist():
                found += read(page or "")
                ends.append(len(found))
            values = list(zip(*found)) if found else [()] * len(fields)
            flat = pa.StructArray.from_arrays(
                [pa.array(column, field.type) for column, field in zip(values, fields)],
                fields=fields)
            arrays = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, type=rows_type)
            columns = [batch.column(key) for key in keys]
            yield pa.RecordBatch.from_arrays([*columns, arrays], [*keys, "rows"])

    return pages.select(*keys, "html").mapInArrow(run, out)


_ELEMENT = ("fullname", "timestamp", "permalink", "promoted")


def _element_tags() -> Column:
    return tags_with("div", "data-fullname", F.coalesce("html", F.lit("")))


def extract_listing_pages(
    pages: DataFrame, keys: tuple[str, ...] = ("board", "page_no")
) -> DataFrame:
    """One row per listing page: keys, n_elements, cursor and the element array `rows`.

    An element is a div with the attribute `data-fullname`; empty attributes are null.
    """
    def element(attributes: Column, pos: Column) -> Column:
        return bound(given_attributes(attributes), lambda given: F.struct(
            pos.cast("int").alias("pos"),
            *[attribute_value(given, f"data-{name}").alias(name) for name in _ELEMENT]))

    tags = pages.select(*keys, _element_tags().alias("_tags"))
    last = F.try_element_at("_tags", F.lit(-1))
    return tags.select(
        *keys, F.transform("_tags", element).alias("rows"),
        F.size("_tags").cast("bigint").alias("n_elements"),
        attribute_value(given_attributes(last), "data-fullname").alias("cursor"))


def _with_time(rows: DataFrame) -> DataFrame:
    return rows.withColumn("created_ms", F.col("timestamp").try_cast("bigint"))


def listing_rows(listing_pages: DataFrame, keys: tuple[str, ...] = ("board", "page_no")) -> DataFrame:
    """One row per listing element, with its time as a number."""
    return _with_time(listing_pages.select(*keys, F.inline("rows")))


def extract_listing(pages: DataFrame, keys: tuple[str, ...] = ("board", "page_no")) -> DataFrame:
    """As listing_rows of the pages; elements become rows before their attributes are read."""
    tags = pages.select(*keys, F.posexplode(_element_tags()).alias("pos", "_tag"))
    return _with_time(with_attributes(
        tags, "_tag", {name: f"data-{name}" for name in _ELEMENT}))


def _text(texts: list[str] | None) -> str | None:
    return None if texts is None else "".join(texts)


def _thread_records(page: str, own_text_only: bool) -> list[tuple]:
    """Values of _THREAD for the heading and each comment of a thread page."""
    reader = ThreadReader(own_text_only).read(page)
    if reader.heading is None:
        return []
    get = reader.heading.get
    post_id = get("data-fullname")
    ids = [comment["values"].get("data-fullname") for comment in reader.comments]
    records = [(
        0, "Post", post_id, get("data-author-fullname"), get("data-author"), None,
        reader.heading_link, _text(reader.heading_texts), get("data-timestamp"), None, None, ids,
    )]
    for pos, comment in enumerate(reader.comments, start=1):
        get = comment["values"].get
        records.append((
            pos, "Comment", ids[pos - 1], get("data-author-fullname"), None, get("data-author"),
            get("data-permalink"), _text(comment.get("texts")), comment.get("time"),
            comment["parent"], post_id, None,
        ))
    return records


def extract_thread(
    pages: DataFrame, keys: tuple[str, ...] = ("url",), own_text_only: bool = False
) -> DataFrame:
    """One row per post and comment of each thread page, with `pos` in document order.

    A post's CreatedAt is its text as found, a comment's is epoch milliseconds of its ISO time.
    A comment's author is in `Author`, a post's in `AuthorName`. A post has the ids of the comments
    on its page as RelatedCommentId, so assembling a thread from its page takes no shuffle.
    """
    found = _per_page(pages, keys, _THREAD, lambda page: _thread_records(page, own_text_only))
    created = F.when(F.col("Type") == "Post", F.col("_time")).otherwise(
        iso_to_millis("_time").cast("string"))
    related = F.when(F.col("Type") == "Post", related_map(F.col("_related")))
    return found.select(*keys, F.inline("rows")).withColumns({
        "CreatedAt": created, "RelatedCommentId": related}).drop("_time", "_related")


def combine_parts(records: DataFrame, thread: tuple[str, ...], part: str) -> DataFrame:
    """Records of threads whose pages come in several parts: one post for each thread.

    The post has the fields of its first part and the ids of all parts in their order. Comments
    are not shuffled. Posts and comments are two readings of `records`, so these, which are small
    beside the pages, are stored once in the shared checkpoint folder.
    """
    records = materialize(records)
    posts = records.filter(F.col("Type") == "Post")
    of_part = F.struct(part, F.col("RelatedCommentId")["id"].alias("ids"))
    ids = F.flatten(F.transform(
        F.array_sort(F.collect_list(of_part)), lambda item: item["ids"]))
    fields = [c for c in posts.columns if c != "RelatedCommentId" and c not in thread]
    whole = posts.groupBy(*thread).agg(
        F.min_by(F.struct(*fields), part).alias("_post"), ids.alias("_ids"))
    return whole.select(
        *thread, "_post.*", related_map(F.col("_ids")).alias("RelatedCommentId")
    ).unionByName(records.filter(F.col("Type") != "Post"))


def page_title(pages: DataFrame) -> DataFrame:
    """Pages with their title text as found, null if there is none."""
    title = F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)
    return pages.withColumn("title", F.nullif(title, F.lit("")))
