"""Near-duplicate documents by SimHash, found with multi-index hashing.

A fingerprint is cut into two halves. If two fingerprints differ in at most three bits, one half
differs in at most one, so it lies in the other's Hamming ball of radius 1. Each distinct
fingerprint is put under its two halves (the tables) and asks under every half of that ball in which
a zero bit is set: of two halves that differ in one bit, exactly one has the zero there, so a pair
is met once. Whole distances are verified. A half that many fingerprints share is divided by the
other half in the same way, into keys under which at most 2**16 fingerprints can stand.

Links stay in Spark; components come from rounds of hooking every node to its least neighbour.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.memory import keep_only
from threadloom.llm.shared import cut, unused_name, without

BITS, HALF, QUARTER = 64, 32, 16
# Words of a shingle, and bits in which linked fingerprints may differ.
WORDS, RADIUS = 3, 3
SEED = 42
# Up to so many fingerprints under a key are compared by a join; more are divided further, and at
# last compared in tiles of TILE, each giving the links of a spanning forest instead of all pairs.
HOT, TILE = 64, 2048
MAX_ROUNDS = 60


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every run of `words` words, repeats included; of fewer words, one run."""
    tokens = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space count
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - words + 1)
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(
            starts[:n].tolist(), ends[min(words, len(tokens)) - 1:].tolist(), strict=True)),
        np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes; signed, as Spark's long."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, keys: tuple[str, ...] = ("doc_id",)
                 ) -> DataFrame:
    """`keys` and `fp` of every row with a `text`; a text without words has fingerprint 0."""
    def run(batches):
        keep_only("fingerprints")
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                *(batch.column(key) for key in keys),
                pa.array([fingerprint(shingle_hashes(t.as_py(), words))
                          for t in batch.column("text")], pa.int64())], [*keys, "fp"])

    fields = docs.select(*keys).schema.fields
    return docs.select(*keys, "text").mapInArrow(
        run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", fp bigint")


def part_of(fp: Column, at: int, width: int) -> Column:
    """`width` bits of a long from bit `at` on, as a number from 0."""
    return F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1))


def ball(value: Column, width: int, both: bool = False) -> Column:
    """The value and those with one more bit set (with `both`, one bit changed either way)."""
    flips = F.transform(F.lit([1 << i for i in range(width)]), lambda b: value.bitwiseXOR(b))
    if not both:
        flips = F.filter(flips, lambda v: v > value)
    return F.concat(F.array(value), flips)


def tagged(values: Column, tag: int, width: int) -> Column:
    """Numbers of `width` bits, told apart from those of other tables by the bits above."""
    return F.transform(values, lambda v: v.bitwiseOR(F.lit(tag << width)))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(nodes: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """Pairs `a`, `b` of `fp` in `nodes` (distinct) that connect what differs in `radius` bits.

    Every two fingerprints within the radius are connected; those under a key of more than `hot`
    may be so by a path of links, each of them within the radius.
    """
    if not 0 <= radius <= 3:
        raise ValueError("two halves and balls of radius 1 hold for a radius of at most 3")
    halves = [part_of(F.col("fp"), at, HALF) for at in (0, HALF)]
    stored = nodes.select("fp", F.explode(F.array(
        *[h.bitwiseOR(F.lit(i << HALF)) for i, h in enumerate(halves)])).alias("key"))
    asked = nodes.select("fp", F.explode(F.concat(
        *[tagged(ball(h, HALF), i, HALF) for i, h in enumerate(halves)])).alias("key"))
    counts = stored.groupBy("key").agg(F.count("*").alias("n"))
    few = stored.join(counts.where(F.col("n") <= hot), "key").drop("n")
    near = _verified(few, asked, radius)

    crowded = cut(counts.where(F.col("n") > hot).select("key"))
    if not crowded.take(1):
        return near
    stored2 = _divide(stored.join(crowded, "key", "left_semi"), False)
    asked2 = _divide(asked.join(crowded, "key", "left_semi"), True)
    counts2 = stored2.groupBy("key", "sub").agg(F.count("*").alias("n"))
    near2 = _verified(
        stored2.join(counts2.where(F.col("n") <= hot), ["key", "sub"]).drop("n"), asked2, radius,
        ["key", "sub"])
    dense = counts2.where(F.col("n") > hot)
    return near.unionByName(near2).unionByName(_forests(
        stored2.join(dense, ["key", "sub"]), asked2.join(dense, ["key", "sub"]), radius))


def _verified(stored: DataFrame, asked: DataFrame, radius: int, key=("key",)) -> DataFrame:
    """Pairs under one key within the radius; at most as many per asking row as a key holds."""
    key = list(key)
    return (
        stored.withColumnRenamed("fp", "a").join(asked.withColumnRenamed("fp", "b"), key)
        .where((F.col("a") != F.col("b")) & (distance(F.col("a"), F.col("b")) <= radius))
        .select("a", "b"))


def _divide(rows: DataFrame, ask: bool) -> DataFrame:
    """Rows of crowded keys under `sub`, the quarters of the half that the key does not name."""
    other = F.when(F.shiftrightunsigned("key", HALF) == 0, part_of(F.col("fp"), HALF, HALF)
                   ).otherwise(part_of(F.col("fp"), 0, HALF))
    subs = []
    for i, at in enumerate((0, QUARTER)):
        value = part_of(other, at, QUARTER)
        subs.append(tagged(ball(value, QUARTER, both=True) if ask else F.array(value),
                             i, QUARTER))
    return rows.select("key", "fp", F.explode(F.concat(*subs)).alias("sub"))


def _forests(stored: DataFrame, asked: DataFrame, radius: int) -> DataFrame:
    """Links that connect, under each dense key, what is within the radius, tile by tile."""
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    home = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    table = stored.select("key", "sub", home.alias("tile"), "fp", F.lit(True).alias("stored"))
    query = asked.select(
        "key", "sub", F.explode(F.sequence(F.lit(0), tiles - 1)).alias("tile"), "fp",
        F.lit(False).alias("stored"))

    def forest(rows: pd.DataFrame) -> pd.DataFrame:
        a = np.unique(rows["fp"][rows["stored"]].to_numpy())
        root = np.arange(len(a))
        found = []

        def top(i):
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for b in np.unique(rows["fp"][~rows["stored"]].to_numpy()):
            near = np.flatnonzero(np.bitwise_count((a ^ b).view(np.uint64)) <= radius)
            heads = [top(i) for i in near.tolist() if a[i] == b]
            for i in near.tolist():
                if (t := top(i)) not in heads:
                    heads.append(t)
                    found.append((a[i], b))
            # all that b touches is connected through b from now on
            for t in heads[1:]:
                root[t] = heads[0]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return table.unionByName(query).groupBy("key", "sub", "tile").applyInPandas(
        forest, "a bigint, b bigint")


def components(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    """`node` and `root`, the least node it is connected to, for every node of `edges` (a, b).

    Alternating large-star and small-star rounds; only a node's minimum is gathered, so a node of
    any degree is aggregated in parts. Each round is written to the checkpoint folder, by `tasks`
    tasks at most where that is given.
    """
    def kept(rows: DataFrame) -> DataFrame:
        return cut(rows.coalesce(tasks) if tasks else rows)

    edges = kept(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        # large star: neighbours above a node are hooked to the least of it and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: neighbours below a node, and the node, are hooked to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = kept(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def groups(nodes: DataFrame, radius: int) -> DataFrame:
    """`fp` and `root`, its group, of every row of `nodes` (distinct fingerprints)."""
    roots = components(links(nodes.select("fp"), radius))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").drop("node").withColumn(
        "root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """Per row of `docs`: doc_id, fp and component_id, the least doc_id connected to it.

    Documents are connected if their fingerprints differ in at most `radius` bits. Equal
    fingerprints meet in one node before anything is compared. A null doc_id keeps its row and
    never names a component that has another id. An empty table gives no rows.
    """
    prints = cut(fingerprints(docs.select(F.col("doc_id").cast("bigint"), "text"), words))
    named = groups(cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least"))), radius)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    member = cut(named.join(least, "root").select("fp", "component_id"))
    return prints.join(member, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """`docs` without near duplicates: the row of the least doc_id of each group stays.

    Rows are told apart by all their columns, so of rows that repeat a doc_id, or have none, one
    stays as well; a row without doc_id stays only where no row of its group has one.
    """
    key = unused_name(docs)
    # two digests: rows of one key are taken as equal, and one digest of 64 bits is not enough
    row = F.struct(F.xxhash64(*docs.columns).alias("a"),
                   F.xxhash64(F.lit(SEED), *docs.columns).alias("b"))
    prints = cut(fingerprints(
        docs.select("doc_id", F.col("text"), row["a"].alias("a"), row["b"].alias("b")),
        words, ("doc_id", "a", "b")))
    # the least of a struct takes null first, so whether there is a doc_id comes before it
    named = groups(cut(prints.groupBy("fp").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "a", "b")).alias("best"))), radius)
    best = named.join(named.groupBy("root").agg(F.min("best").alias("first")), "root").select(
        "fp", F.struct("first.a", "first.b").alias("stays"))
    found = prints.join(best, "fp").select(F.struct("a", "b").alias(key), "stays")
    kept = without(docs.withColumn(key, row), found.where(F.col(key) != F.col("stays")).select(key),
                   key)
    # equal rows: only those are shuffled
    again = cut(prints.groupBy(F.struct("a", "b").alias(key)).agg(F.count("*").alias("n")).where(
        "n > 1").select(key))
    if again.take(1):
        kept = without(kept, again, key).unionByName(
            kept.join(again, key, "left_semi").dropDuplicates([key]))
    return kept.select(*docs.columns)
