"""Thread assembly: parent links, related ids, order.

Thread records carry `pos`: 0 for the post, then 1, 2, ... for comments in document order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.operators.joins import spread_join

# Comments of a thread are first put in order in blocks of this many places.
BLOCK = 10_000


def thread_union(headings: DataFrame, comments: DataFrame) -> DataFrame:
    """Posts and comments as one bag of records; keys one side lacks are null."""
    return headings.unionByName(comments, allowMissingColumns=True)


def related_ids(comments: DataFrame) -> DataFrame:
    """The flat relation, for analysis: ParentPostId, pos, Id. No thread meets in one row."""
    return comments.select("ParentPostId", "pos", "Id")


def _ids(comments: DataFrame, block: int) -> DataFrame:
    """Comment ids of each post in document order: by blocks of places, then the blocks in order.

    Comments without a place come last, in the order of their ids.
    """
    number = F.coalesce(F.floor(F.col("pos") / block), F.lit(1 << 62)).cast("bigint")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "Id")))
    blocks = comments.groupBy("ParentPostId", number.alias("_block")).agg(
        F.transform(ordered, lambda item: item["Id"]).alias("_ids"))
    merged = F.array_sort(F.collect_list(F.struct("_block", "_ids")))
    return blocks.groupBy(F.col("ParentPostId").alias("Id")).agg(
        F.flatten(F.transform(merged, lambda item: item["_ids"])).alias("_ids"))


def related_map(ids: Column) -> Column:
    return F.create_map(F.lit("id"), ids)


def attach_related_ids(posts: DataFrame, comments: DataFrame, block: int = BLOCK) -> DataFrame:
    """Posts with RelatedCommentId = {"id": [comment ids]}, an empty list if there are none.

    One row per post with all its ids, because that row is the message to send; texts never meet
    in it. `related_ids` is the form without such rows.
    """
    ids = _ids(related_ids(comments), block)
    no_ids = F.array().cast("array<string>")
    return posts.drop("RelatedCommentId").join(ids, "Id", "left").withColumn(
        "RelatedCommentId", related_map(F.coalesce(F.col("_ids"), no_ids))).drop("_ids")


def comment_with_post(comments: DataFrame, posts: DataFrame) -> DataFrame:
    """Each comment with its post's author and link; comments of unknown posts are left out."""
    heading = posts.select(
        F.col("Id").alias("ParentPostId"),
        F.col("AuthorName").alias("PostAuthorName"),
        F.col("Permalink").alias("PostPermalink"),
    )
    return spread_join(comments, heading, "ParentPostId")


def comment_with_parent(comments: DataFrame) -> DataFrame:
    """Each reply with the author and time of the comment it answers."""
    parent = comments.select(
        F.col("Id").alias("ParentCommentId"),
        F.col("AuthorName").alias("ParentAuthorName"),
        F.col("CreatedAt").alias("ParentCreatedAt"),
    )
    replies = comments.filter(F.col("ParentCommentId").isNotNull())
    return spread_join(replies, parent, "ParentCommentId")


def thread_order(records: DataFrame) -> DataFrame:
    """Records thread by thread, the post first. A range sort: a long thread spans many tasks."""
    return (
        records.withColumn("ThreadId", F.coalesce("ParentPostId", "Id"))
        .orderBy("ThreadId", "pos")
    )
