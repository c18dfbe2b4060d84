"""Sharding along a Hilbert curve over quantised metadata, with DataFrame functions only.

Each dimension is cut at its own quantiles (statistics over all rows) into `2**bits` steps. The
cell's place on the Hilbert curve orders the rows; runs of equal length are the shards, so a shard
covers a compact region and its least and greatest values prune files in every dimension at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.llm.shared import cut, global_rank

LAW = "rows"


def _trailing_ones(i: int) -> int:
    return (~i & (i + 1)).bit_length() - 1


def curve_steps(dims: int) -> tuple[list[int], list[int], list[int]]:
    """Tables of the curve by (direction, cell): digit; by (direction, digit): entry, direction."""
    mask = (1 << dims) - 1

    def turn(x: int, by: int) -> int:
        by %= dims
        return ((x << by) | (x >> (dims - by))) & mask

    def from_gray(g: int) -> int:
        digit = 0
        while g:
            digit ^= g
            g >>= 1
        return digit

    digits, entries, directions = [], [], []
    for d in range(dims):
        for x in range(1 << dims):
            digits.append(from_gray(turn(x, -(d + 1))))
            start = 0 if x == 0 else 2 * ((x - 1) // 2)
            entries.append(turn(start ^ (start >> 1), d + 1))
            inner = 0 if x == 0 else _trailing_ones(x if x % 2 else x - 1) % dims
            directions.append((d + inner + 1) % dims)
    return digits, entries, directions


def hilbert_index(steps: list[Column], bits: int) -> Column:
    """Place on the curve of the cell with these whole coordinates from 0 to `2**bits - 1`."""
    dims = len(steps)
    if dims * bits > 62:
        raise ValueError("dimensions times bits must be at most 62")
    digits, entries, directions = (F.lit(t) for t in curve_steps(dims))
    axes = F.array(*[s.cast("int") for s in steps])

    def bit(axis: int, level: Column) -> Column:
        value = F.call_function("shiftright", F.get(axes, F.lit(axis)), level)
        return F.shiftleft(value.bitwiseAND(F.lit(1)), axis)

    def level(state: Column, i: Column) -> Column:
        cell = state["e"].bitwiseXOR(sum((bit(a, i) for a in range(1, dims)), bit(0, i)))
        base = state["d"] * F.lit(1 << dims)
        digit = F.get(digits, base + cell)
        return F.get(F.transform(F.array(digit), lambda w: F.struct(
            (F.shiftleft(state["h"], dims) + w.cast("bigint")).alias("h"),
            state["e"].bitwiseXOR(F.get(entries, base + w)).alias("e"),
            F.get(directions, base + w).alias("d"))), F.lit(0))

    start = F.struct(F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return F.aggregate(F.lit(list(range(bits - 1, -1, -1))), start, level, lambda s: s["h"])


def text_cuts(df: DataFrame, column: str, at: list[float]) -> list[str]:
    """Values at these shares of the rows in the order of a text column; whole texts compared.

    Distinct values with their counts go to sorted ranges; only one sum per range meets in one task.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("n"))
    ordered = cut(counts.repartitionByRange("value").sortWithinPartitions("value").withColumn(
        "_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.groupBy("_part").agg(F.sum("n").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_part").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    total = ordered.agg(F.sum("n")).first()[0]
    if not total:
        return []
    upto = ordered.withColumn("_upto", F.sum("n").over(within)).join(
        F.broadcast(starts), "_part").withColumn("_upto", F.col("_upto") + F.col("_start"))
    # the first value that reaches a share; those of equal value repeat, as other quantiles do
    wanted = F.filter(F.lit([a * total for a in at]), lambda a: (
        a <= F.col("_upto")) & (a > F.col("_upto") - F.col("n")))
    found = upto.select("value", F.size(wanted).alias("times")).where("times > 0").collect()
    return sorted((r["value"] for r in found for _ in range(r["times"])),
                  key=lambda v: v.encode())


def quantise(df: DataFrame, dims: list[str], bits: int) -> list[Column]:
    """Step of each dimension between its quantiles; nulls are step 0."""
    dtypes = dict(df.dtypes)
    at = [i / (1 << bits) for i in range(1, 1 << bits)]
    values = {
        d: F.col(d) if dtypes[d] == "string"
        else F.col(d).cast("double" if dtypes[d] in ("float", "double") else "bigint")
        for d in dims}
    numbers = [d for d in dims if dtypes[d] != "string"]
    cuts = {d: text_cuts(df, d, at) for d in dims if dtypes[d] == "string"}
    if numbers:
        cuts |= df.agg(*[F.percentile_approx(values[d], at, 10_000).alias(d) for d in numbers]
                       ).first().asDict()
    return [steps_below(values[d], cuts[d]) if cuts[d] else F.lit(0) for d in dims]


def steps_below(value: Column, cuts: list) -> Column:
    """How many of `cuts` are at most `value`; 0 for null."""
    return F.size(F.filter(F.lit(cuts), lambda c: c <= value))


def shard_rows(df: DataFrame, dims: list[str], ties: list[str], shards: int = 16,
               bits: int = 5) -> DataFrame:
    """`df` with `curve`, `shard` and `slot`: runs of the curve whose counts differ by one at most.

    `ties` orders the rows of a cell; rows equal in all of them stand in any order. Nulls of a
    dimension count as its least step. An empty table gives no rows. All columns of `df` are
    carried through one shuffle, so select what is needed first.
    """
    curve = hilbert_index(quantise(df, dims, bits), bits)
    ranked = global_rank(df.withColumn("curve", curve), "curve", *ties)
    n = F.lit(shards)
    return (
        ranked.withColumn("shard", F.expr(f"cast(rank * {shards} div total as int)"))
        .withColumn("slot", F.col("rank") - F.ceil(F.col("shard") * F.col("total") / n))
        .drop("rank", "total"))


def shard_bounds(sharded: DataFrame, dims: list[str]) -> DataFrame:
    """Least and greatest value per shard and dimension, for pruning; rows of `shards` at most."""
    ends = [f(d).alias(f"{name}_{d}") for d in dims for name, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count("*").alias("n_rows"), *ends)


def write_shards(sharded: DataFrame, folder: str) -> None:
    """Parquet, a folder per shard, in slot order over any number of tasks."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(folder))


def document_shards(docs: DataFrame) -> DataFrame:
    """Shards 0 to 15 of documents by size, language and source; see `shard_rows`.

    A null text has no bytes and no checksum of its own (the checksum of the empty text). Rows
    of null or repeated doc_id are placed like any other. Texts are read once, for what is known
    of them; the quantiles and the order go over that.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = cut(docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.col("lang"), F.col("source")))
    sharded = shard_rows(narrow, ["size", "lang", "source"], ["text_crc32", "doc_id"])
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "curve")
