"""Equi-joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType

from threadloom.session import materialize

SALTS = 32
# A lookup side is broadcast only up to this many bytes, as `measured_bytes` counts them.
MAX_BROADCAST_BYTES = 32 << 20
# What a value and a row of a hashed table take beside the length of texts.
_VALUE_BYTES, _ROW_BYTES = 8, 64


def splits_skew(spark: SparkSession) -> bool:
    """True if adaptive execution will split a hot join partition at run time."""
    return all(
        spark.conf.get(key) == "true"
        for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    )


def salted_join(big: DataFrame, small: DataFrame, on: str, how: str, salts: int = SALTS) -> DataFrame:
    """Join in which every key of `big` is spread over `salts` sub-keys.

    The salt is a hash of the row, so a re-run task puts each row where it was before.
    """
    hashable = [f.name for f in big.schema.fields if not isinstance(f.dataType, MapType)]
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [on, "_salt"], how).drop("_salt")


def spread_join(big: DataFrame, unique: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join `big`, whose keys may be hot, with `unique`, which has few rows per key.

    Adaptive execution splits hot partitions by measured size, with no extra pass; if the session
    has that off, keys are salted instead.
    """
    if splits_skew(big.sparkSession):
        return big.join(unique, on, how)
    return salted_join(big, unique, on, how)


def measured_bytes(df: DataFrame) -> int:
    """Size of `df` as a broadcast table: one job that counts its rows and the bytes of its texts.

    Only flat columns are measured; any other type counts as its text.
    """
    texts = [
        F.octet_length(F.col(f.name) if isinstance(f.dataType, StringType) else F.to_json(
            F.struct(f.name)))
        for f in df.schema.fields
        if isinstance(f.dataType, StringType) or f.dataType.typeName() in ("array", "map", "struct")]
    length = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0).cast("bigint"))
    size = df.agg(F.count("*").alias("n"), F.sum(length).alias("bytes")).first()
    return size["n"] * (_ROW_BYTES + _VALUE_BYTES * len(df.columns)) + (size["bytes"] or 0)


def lookup_join(
    big: DataFrame, small: DataFrame, on: str, how: str = "inner",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join `big` with a lookup that is usually, but not provably, small.

    The lookup is worked out once, into the shared checkpoint folder, and its stored rows are
    measured. If it is broadcast, `big` is not shuffled; else hot keys are spread.
    """
    small = materialize(small)
    return bounded_join(big, small, on, how, measured_bytes(small) <= max_bytes)


def bounded_join(
    big: DataFrame, small: DataFrame, on: str, how: str, is_small: bool
) -> DataFrame:
    """As lookup_join, with a lookup whose size is known from what it was made of."""
    if is_small:
        return big.join(F.broadcast(small), on, how)
    return spread_join(big, small, on, how)
