"""Dense serial ids for new keys, numbered in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the digest that pick a bucket: 16**3 = 4096 buckets, which bounds `offsets`.
_BUCKET_DIGITS = 3


def assign_serials(
    keys: DataFrame, key: str, serials: dict[str, Column], where: dict[str, Column] | None = None
) -> DataFrame:
    """Number distinct non-null `key` values in the order of md5(key), key.

    `serials` maps each id column to the number before its first id. With `where`, an id column is
    numbered on the rows of its condition only and keeps its value elsewhere. Digests are uniform,
    so buckets by digest prefix are even whatever the keys look like; each is numbered on its own
    and shifted by the count of the buckets before it. `keys` is read twice and must give the same
    rows both times; where the tables behind it are appended to meanwhile, store it first.
    """
    where = where or {}
    takes = {into: where.get(into, F.lit(True)) for into in serials}
    tagged = keys.withColumn("_digest", F.md5(F.col(key))).withColumns({
        "_bucket": F.substring("_digest", 1, _BUCKET_DIGITS),
        **{f"_takes_{into}": taken.cast("int") for into, taken in takes.items()},
    })
    counts = tagged.groupBy("_bucket").agg(
        *[F.sum(f"_takes_{into}").alias(f"_n_{into}") for into in serials])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", *[
        F.coalesce(F.sum(f"_n_{into}").over(before), F.lit(0)).alias(f"_offset_{into}")
        for into in serials
    ])
    within = Window.partitionBy("_bucket").orderBy("_digest", key)
    numbered = tagged.join(F.broadcast(offsets), "_bucket").withColumns(
        {f"_nth_{into}": F.sum(f"_takes_{into}").over(within) for into in serials})

    def number(into: str, start: Column) -> Column:
        serial = (start + F.col(f"_offset_{into}") + F.col(f"_nth_{into}")).cast("bigint")
        if into not in keys.columns:
            return serial
        return F.when(F.col(f"_takes_{into}") == 1, serial).otherwise(F.col(into))

    kept = [F.col(name) for name in keys.columns if name not in serials]
    return numbered.select(
        *kept, *[number(into, start).alias(into) for into, start in serials.items()])
