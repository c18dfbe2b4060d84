"""Counts that merge: one sketch row per run and board, so no total is counted from rows again.

Distinct values are theta-free HyperLogLog sketches, quantiles KLL sketches. Both are of a fixed
size, whatever they have seen, and merging them gives what one sketch of all rows gives, within the
same error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_SIZE = 12  # of the distinct counter: 4,096 registers
# Three standard errors of a HyperLogLog sketch of that size.
DISTINCT_ERROR = 3 * 1.04 / (1 << LOG_SIZE) ** 0.5


def sketches(rows: DataFrame, keys: list[str], distinct: Column) -> DataFrame:
    """Per `keys`: number of rows and a sketch of the distinct non-null values of `distinct`."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.hll_sketch_agg(distinct, LOG_SIZE).alias("distinct_sketch"))


def merged(stored: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of several runs as one row per `keys`; merging again changes no estimate."""
    return stored.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"))


def estimates(stored: DataFrame) -> DataFrame:
    """Sketches read: `n_distinct` is right within DISTINCT_ERROR of itself."""
    return stored.withColumn(
        "n_distinct", F.hll_sketch_estimate("distinct_sketch")).drop("distinct_sketch")
