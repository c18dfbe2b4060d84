"""Approximate nearest neighbours by learned partitions.

On a bounded sample: the graph of each vector's nearest neighbours is divided into parts of bounded
size that cut few edges, and a small network learns in which parts a vector's neighbours lie. The
network then puts every vector of the table into its most probable part, and sends each query to
its most probable parts, whose vectors are compared exactly. How many parts are asked is set on
held-out vectors of the sample, as the least number that finds the wanted share of true neighbours.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SAMPLE, HELD_OUT = 4096, 512  # bounds of what the index is fitted on
PARTS, CAPACITY = 32, 1.1  # a part holds at most so many times its share of the sample
GRAPH_DEGREE, HIDDEN, EPOCHS = 15, 128, 40
RECALL = 0.95  # wanted on the held-out vectors
K = 10
# A task compares at most so many vectors with so many queries; larger parts are several tasks.
ROW_BLOCK, QUERY_BLOCK = 1024, 2048
FOUND_SCHEMA = "query_id bigint, vec_id bigint, score double"


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of `a` to all rows of `b`, up to rounding."""
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)


def nearest(x: np.ndarray, k: int) -> np.ndarray:
    """Places of the k nearest other rows of each row."""
    d = squares(x, x)
    np.fill_diagonal(d, np.inf)
    return np.argpartition(d, k - 1, axis=1)[:, :k]


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int) -> np.ndarray:
    """Part of each row: median splits of the vectors, then moves along the graph's edges.

    A row moves to the part of most of its neighbours while that part has room.
    """
    rng = np.random.default_rng(seed)
    n, k = graph.shape
    part = np.zeros(n, np.int64)
    made = 1
    while made < parts:
        part *= 2
        for p in range(made):
            here = np.flatnonzero(part == 2 * p)
            if len(here) < 2:
                continue
            centred = x[here] - x[here].mean(0)
            axis = np.linalg.svd(centred[:500], full_matrices=False)[2][0]
            order = np.argsort(centred @ axis, kind="stable")
            part[here[order[len(here) // 2:]]] += 1
        made *= 2
    one = np.repeat(np.arange(n), k)
    other = graph.ravel()
    ends, others = np.concatenate([one, other]), np.concatenate([other, one])
    room = int(np.ceil(CAPACITY * n / made))
    for _ in range(20):
        votes = np.zeros((n, made))
        np.add.at(votes, (ends, part[others]), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        size, moved = np.bincount(part, minlength=made), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            # not all at once, lest neighbours change places for ever
            if size[best[i]] < room and rng.random() < 0.7:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A network with one hidden layer, from a vector to the scores of the parts."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    probes: int = 1

    def scores(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2

    def parts(self, x: np.ndarray, most: int) -> np.ndarray:
        """The `most` most probable parts of each row, best first."""
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :most]


def learn(x: np.ndarray, targets: np.ndarray, seed: int) -> Router:
    """Train on soft targets, the shares of a row's neighbours in each part, by Adam."""
    rng = np.random.default_rng(seed)
    n, width = x.shape
    parts = targets.shape[1]
    router = Router(x.mean(0), x.std(0) + 1e-6, [
        rng.normal(0, np.sqrt(2 / width), (width, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)])
    scaled = (x - router.mean) / router.scale
    first = [np.zeros_like(w) for w in router.weights]
    second = [np.zeros_like(w) for w in router.weights]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, 256):
            rows = order[at:at + 256]
            w1, b1, w2, b2 = router.weights
            hidden = np.maximum(scaled[rows] @ w1 + b1, 0)
            out = hidden @ w2 + b2
            out = np.exp(out - out.max(1, keepdims=True))
            error = (out / out.sum(1, keepdims=True) - targets[rows]) / len(rows)
            back = (error @ w2.T) * (hidden > 0)
            slopes = [scaled[rows].T @ back, back.sum(0), hidden.T @ error, error.sum(0)]
            step += 1
            for i, w in enumerate(router.weights):
                slope = slopes[i] + 1e-4 * w
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                w -= 2e-3 * (first[i] / (1 - 0.9**step)) / (
                    np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return router


def fit(sample: np.ndarray, parts: int = PARTS, recall: float = RECALL, seed: int = 0) -> Router:
    """A router fitted on `sample`; a sample too small to divide gives one part."""
    held = min(HELD_OUT, len(sample) // 8)
    queries, x = sample[:held], sample[held:]
    parts = 1 << max(0, min(parts.bit_length() - 1, int(np.log2(max(len(x), 1) / 32 + 1e-9))))
    if held < 8 or parts < 2:
        width = sample.shape[1]
        return Router(np.zeros(width), np.ones(width), [
            np.zeros((width, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)])
    graph = nearest(x, min(GRAPH_DEGREE, len(x) - 1))
    part = balanced_parts(x, graph, parts, seed)
    targets = np.zeros((len(x), parts))
    np.add.at(targets, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph.ravel()]), 1.0)
    targets[np.arange(len(x)), part] += 1
    router = learn(x, targets / targets.sum(1, keepdims=True), seed)

    true = np.argpartition(squares(queries, x), K - 1, axis=1)[:, :K]
    home = router.parts(x, 1)[:, 0]
    asked = router.parts(queries, parts)
    rank = np.argsort(asked, axis=1)  # place of each part in a query's order
    places = np.take_along_axis(rank, home[true], axis=1)
    found = [(places < m).mean() for m in range(1, parts + 1)]
    router.probes = next((m for m, r in enumerate(found, 1) if r >= recall), parts)
    return router


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows that take part: finite whole vectors that are not zero, of the commonest dimension.

    Of equally common dimensions the greatest holds.
    """
    v = F.col(vector)
    rows = rows.where(
        v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0))
    width = rows.groupBy(F.size(v).alias("width")).count().orderBy(
        F.desc("count"), F.desc("width")).first()
    return rows.where(F.size(v) == (width["width"] if width else 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(
        len(column), -1)


def sample_of(rows: DataFrame, size: int = SAMPLE) -> np.ndarray:
    """At most `size` vectors of (vec_id, vector), those of the least hashes of their ids."""
    top = rows.select(F.xxhash64("vec_id").alias("h"), "vec_id", "vector").orderBy(
        "h", "vec_id").limit(size).collect()
    return np.array([r["vector"] for r in top], np.float64)


def route(rows: DataFrame, router: Router, most: int) -> DataFrame:
    """(vec_id, vector, part) of (vec_id, vector), a row for each of the `most` best parts."""
    shared = rows.sparkSession.sparkContext.broadcast(router)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                parts = shared.value.parts(matrix(batch.column("vector")), most)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(parts.tolist(), pa.list_(pa.int32()))],
                    [*batch.schema.names, "parts"])

    return rows.mapInArrow(run, f"{fields}, parts array<int>").select(
        *rows.columns, F.explode("parts").alias("part"))


def best_of(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray,
            k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per query: its id repeated, ids and exact distances of its k nearest rows, ties by id."""
    out = []
    near = squares(queries, rows)
    slack = 1e-9 * (1 + (queries * queries).sum(1) + (rows * rows).sum(1).max(initial=0))
    for i, query in enumerate(query_ids):
        may = np.flatnonzero(ids != query)
        if len(may) > k:
            edge = np.partition(near[i, may], k - 1)[k - 1] + slack[i]
            may = may[near[i, may] <= edge]
        score = np.sqrt(((queries[i] - rows[may]) ** 2).sum(axis=1))
        order = np.lexsort((ids[may], score))[:k]
        out.append((np.full(len(order), query), ids[may][order], score[order]))
    return out


def compare(left: pa.Table, right: pa.Table) -> pa.Table:
    """The K nearest of a block of vectors for each of a block of queries."""
    found = []
    if left.num_rows and right.num_rows:
        found = best_of(left["vec_id"].to_numpy(), matrix(left["vector"]),
                        right["vec_id"].to_numpy(), matrix(right["vector"]), K)
    columns = [np.concatenate(c) if c else [] for c in (zip(*found, strict=True) if found
                                                        else ([], [], []))]
    return pa.table([pa.array(c, t) for c, t in zip(
        columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)],
        names=["query_id", "vec_id", "score"])


def search(rows: DataFrame, queries: DataFrame, router: Router) -> DataFrame:
    """The K nearest rows found for each query, over (vec_id, vector) tables.

    Every row is indexed. A part's vectors and queries are divided into blocks by hash, so neither
    a large part nor many queries land in one task.
    """
    stored = route(rows, router, 1)
    asked = route(queries, router, router.probes)
    counts = F.broadcast(  # a row per part
        stored.groupBy("part").agg(F.ceil(F.count("*") / ROW_BLOCK).cast("int").alias("row_blocks"))
        .join(asked.groupBy("part").agg(
            F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks")), "part"))

    def blocked(df: DataFrame, own: str, other: str) -> DataFrame:
        return df.join(counts, "part").select(
            "part", F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other), "vec_id", "vector")

    keys = ["part", "row_blocks", "query_blocks"]
    found = blocked(asked, "query_blocks", "row_blocks").groupBy(*keys).cogroup(
        blocked(stored, "row_blocks", "query_blocks").groupBy(*keys)).applyInArrow(
        compare, FOUND_SCHEMA)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K).select(
        "query_id", "rank", "vec_id", "score")


def neighbours(table: DataFrame, every: int = 100, parts: int = PARTS) -> DataFrame:
    """Queries are the rows of (vec_id, embedding) whose vec_id is divisible by `every`.

    Rows without vec_id or with an unusable vector take no part. A vec_id that repeats is one query,
    with its least vector; its rows are never its own neighbours, but each of them may be another
    query's. An empty table gives no rows.
    """
    rows = usable(table.where("vec_id is not null"), "embedding").select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("vector"))
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(
        F.min("vector").alias("vector"))
    sample = sample_of(rows)
    if not len(sample):
        return rows.sparkSession.createDataFrame(
            [], "query_id bigint, rank int, vec_id bigint, score double")
    return search(rows, queries, fit(sample, parts))
