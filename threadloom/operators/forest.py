"""Whole comment forests: root, depth and size of the subtree of every comment.

Pointers are doubled: after k rounds every comment knows its ancestor 2**k above, so a thread of depth
d takes log2(d) rounds, each an aggregate and a join by id, and no thread meets in one task. What is
below a comment is added up on the way: the comments exactly 2**k below it pass on what they have
counted so far. Each round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators.joins import spread_join
from threadloom.session import materialize

ROOT, LOST, CYCLE, BELOW = "root", "lost parent", "cycle", "reply"


def forest(comments: DataFrame, id_column: str = "Id", parent_column: str = "ParentCommentId"
           ) -> DataFrame:
    """Per distinct id: RootId, depth (0 for a root), n_below (comments under it), and kind.

    A comment whose parent is not in `comments` is a root of kind 'lost parent'. Comments on a cycle
    or below one have no root: their RootId, depth and n_below are null and their kind is 'cycle'. Of
    rows that repeat an id that of the least parent counts; rows without an id are left out. A
    comment that names itself is a cycle.
    """
    pairs = comments.where(F.col(id_column).isNotNull()).groupBy(
        F.col(id_column).alias("id")).agg(F.min(parent_column).alias("parent"))
    pairs = materialize(pairs)
    known = pairs.select(F.col("id").alias("parent"), F.lit(True).alias("there"))
    top = F.col("there").isNull()
    nodes = materialize(spread_join(pairs, known, "parent", "left").select(
        "id", F.when(top, F.col("id")).otherwise(F.col("parent")).alias("up"),
        F.when(top, 0).otherwise(1).cast("bigint").alias("dist"), top.alias("done"),
        F.lit(1).cast("bigint").alias("size"),
        F.when(~top, BELOW).when(F.col("parent").isNull(), ROOT).otherwise(LOST).alias("kind")))
    most, step = nodes.count(), 1
    while nodes.where("not done").take(1) and step <= 2 * most:
        below = nodes.where(F.col("dist") == step).groupBy(F.col("up").alias("id")).agg(
            F.sum("size").alias("more"))
        above = nodes.select(F.col("id").alias("up"), F.col("up").alias("_up"),
                             F.col("dist").alias("_dist"), F.col("done").alias("_done"))
        grown = nodes.join(below, "id", "left").withColumn(
            "size", F.col("size") + F.coalesce("more", F.lit(0))).drop("more")
        nodes = materialize(spread_join(grown, above, "up").select(
            "id", F.col("_up").alias("up"), (F.col("dist") + F.col("_dist")).alias("dist"),
            (F.col("done") | F.col("_done")).alias("done"), "size", "kind"))
        step *= 2
    # one more sum: what stands exactly `step` below its root has not been passed on yet
    below = nodes.where(F.col("done") & (F.col("dist") == step)).groupBy(
        F.col("up").alias("id")).agg(F.sum("size").alias("more"))
    nodes = nodes.join(below, "id", "left")
    return nodes.select(
        F.col("id").alias(id_column), F.when(F.col("done"), F.col("up")).alias("RootId"),
        F.when(F.col("done"), F.col("dist")).alias("depth"),
        F.when(F.col("done"), F.col("size") + F.coalesce("more", F.lit(0)) - 1).alias("n_below"),
        F.when(F.col("done"), F.col("kind")).otherwise(CYCLE).alias("kind"))
