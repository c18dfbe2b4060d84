"""Helpers of this subpackage: tables, checkpoints, a shared folder, exact global ranks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.session import ensure_checkpoint_dir, materialize

# Keys of eight bytes that may be broadcast: some 24 MB as a hash table.
MAX_BROADCAST_KEYS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Compute once, into the shared checkpoint folder; later reads survive lost executors."""
    return materialize(df)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name beside the checkpoints, on storage that all executors see."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def unused_name(docs: DataFrame) -> str:
    name = "row_"
    while name in docs.columns:
        name += "_"
    return name


def without(rows: DataFrame, keys: DataFrame, key: str,
            max_broadcast: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """Rows whose `key` is not among `keys`; rows with a null key stay.

    The keys are counted; up to the bound they are broadcast and the rows stay where they are.
    """
    keys = cut(keys.where(F.col(key).isNotNull()).distinct())
    if keys.count() <= max_broadcast:
        keys = F.broadcast(keys)
    return rows.join(keys, key, "left_anti")


def global_rank(df: DataFrame, *keys: str) -> DataFrame:
    """`df` once, with `rank` (from 0, gapless, in the order of `keys`) and `total`.

    Rows go to sorted ranges and are numbered in each; only one count per range meets in one
    task. Equal keys are spread by their place of reading, so repeated rows cannot fill one range.
    """
    placed = df.withColumn("_tie", F.monotonically_increasing_id())
    ordered = cut(
        placed.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie")
        .drop("_tie").withColumn("_at", F.monotonically_increasing_id()))
    parts = ordered.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = parts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(everything).alias("total"))
    # One row per range: as many as there were tasks, so safe to broadcast.
    return (
        ordered.withColumn("_part", F.shiftright("_at", 33))
        .join(F.broadcast(starts), "_part")
        .withColumn("rank", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_at", "_part", "_start"))
