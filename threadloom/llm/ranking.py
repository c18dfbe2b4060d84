"""Ranked lexical search by the Best Position Algorithm over impact lists.

Every document keeps how often it holds each of the asked terms; the corpus statistics follow from
that by aggregation. With them each task turns its documents, a block at a time, into impact lists:
per term the documents by falling impact, and the place of every document in that order. An item
reads its terms' lists from the top. Each document met is looked up in all of them (direct access),
which gives its whole score and its place in each list. A list's best position ends the run of places
seen from its top on, whether read or met by a look-up, so the sum of the impacts there bounds every
unseen document at least as tightly as the last read places do. Reading stops once that bound is
strictly below the k-th score found, so ties at the k-th place are never lost.

A block gives at most k documents per item; the best of all blocks are kept by rank. The items are a
stated query set: they go to the tasks in blocks of at most `BLOCK_TERMS` terms.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.llm.decontam import words
from threadloom.llm.memory import keep_only
from threadloom.llm.shared import cut

TOP = 50
# Terms of the items that go to the tasks at a time, documents of a block, first reads of a list.
BLOCK_TERMS, BLOCK_DOCS, FIRST_READS = 200_000, 1 << 15, 16
COUNTS = "doc_id bigint, n bigint, terms binary, tfs binary"
FOUND = "item bigint, doc_id bigint, score bigint"


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, tfs: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int
            ) -> np.ndarray:
    """Score of a term in a document; whole numbers throughout."""
    m = 50 + 50 * lengths * n_docs // max(1, n_terms)
    return weights * (1_000_000_000 * tfs // (1000 * tfs + 20 * m))


class Lists:
    """Impact lists of one block of documents, numbered from 0."""

    def __init__(self, docs: np.ndarray, terms: np.ndarray, scores: np.ndarray, n_terms: int):
        order = np.lexsort((-scores, terms))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.sorted_docs, self.sorted_scores = docs[order], scores[order]
        ends = np.cumsum(np.bincount(terms, minlength=n_terms))
        self.starts, self.ends = np.concatenate(([0], ends[:-1])), ends
        by_doc = np.lexsort((docs, terms))
        self.docs, self.scores, self.places = docs[by_doc], scores[by_doc], place[by_doc]

    def best(self, terms: np.ndarray, k: int, first: int = FIRST_READS
             ) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores that hold the k best of the block, ties included; places read."""
        starts, ends = self.starts[terms], self.ends[terms]
        seen = [np.zeros(e - s + 1, bool) for s, e in zip(starts, ends, strict=True)]
        best = np.zeros(len(terms), np.int64)  # places seen from the top of each list on
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, first
        while True:
            found = np.unique(np.concatenate([
                self.sorted_docs[min(s + at, e):min(s + at + step, e)]
                for s, e in zip(starts, ends, strict=True)]))
            found = found[~np.isin(found, docs, assume_unique=True)]
            total = np.zeros(len(found), np.int64)
            bound = 0
            for i, (s, e) in enumerate(zip(starts, ends, strict=True)):
                held = self.docs[s:e]
                where = np.searchsorted(held, found)
                hit = np.flatnonzero(held[np.minimum(where, len(held) - 1)] == found
                                     ) if len(held) else where[:0]
                where = where[hit] + s
                total[hit] += self.scores[where]
                seen[i][self.places[where] - s] = True
                best[i] += int(np.argmin(seen[i][best[i]:]))  # the last mark stays unset
                if s + best[i] < e:
                    bound += int(self.sorted_scores[s + best[i]])
            docs, scores = np.concatenate([docs, found]), np.concatenate([scores, total])
            at += step
            if bound == 0 or (len(scores) >= k and bound < np.partition(scores, -k)[-k]):
                break
            step *= 2
        kept = scores > 0
        if kept.sum() > k:
            kept &= scores >= np.partition(scores, -k)[-k]
        return docs[kept], scores[kept], at


def item_blocks(items: DataFrame, block_terms: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Numbered items with their distinct terms, through a bounded buffer."""
    block, held = [], 0
    for item, text in items.select("item", "text").toLocalIterator():
        terms = sorted(set(words(text)))
        if not terms:
            continue
        block.append((item, terms))
        held += len(terms)
        if held >= block_terms:
            yield block
            block, held = [], 0
    if block:
        yield block


def term_counts(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Per (doc_id, text): number of terms, and the asked ones with their occurrences, packed."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches):
        keep_only("asked terms")
        asked = shared.value
        for batch in batches:
            n, terms, tfs = [], [], []
            for text in batch.column("text"):
                tokens = words(text.as_py())
                held = [(asked[w], c) for w, c in Counter(tokens).items() if w in asked]
                n.append(len(tokens))
                terms.append(np.array([t for t, _ in held], "<i4").tobytes())
                tfs.append(np.array([c for _, c in held], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.binary()),
                 pa.array(tfs, pa.binary())], ["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, COUNTS)


def document_frequencies(counts: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each asked term, added up per task before they are shuffled."""
    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for terms in batch.column("terms"):
                total[np.frombuffer(terms.as_py(), "<i4")] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for term, df in counts.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy(
            "term").agg(F.sum("df")).collect():  # at most a row per asked term
        out[term] = df
    return out


def block_results(counts: DataFrame, items: list[tuple[int, np.ndarray]], df: np.ndarray,
                  n_docs: int, n_terms: int, k: int, block_docs: int) -> DataFrame:
    """The best k, with ties, of every block of documents for every item."""
    weights = np.array([weight(n_docs, d) for d in df.tolist()], np.int64)
    shared = counts.sparkSession.sparkContext.broadcast((items, weights))

    def answers(rows: list[tuple]) -> pa.RecordBatch:
        items, weights = shared.value
        ids = np.array([r[0] if r[0] is not None else 0 for r in rows], np.int64)
        none = np.array([r[0] is None for r in rows], bool)
        sizes = np.fromiter((len(r[2]) // 4 for r in rows), np.int64, len(rows))
        docs = np.repeat(np.arange(len(rows)), sizes)
        terms = np.frombuffer(b"".join(r[2] for r in rows), "<i4").astype(np.int64)
        tfs = np.frombuffer(b"".join(r[3] for r in rows), "<i4").astype(np.int64)
        lengths = np.repeat(np.fromiter((r[1] for r in rows), np.int64, len(rows)), sizes)
        lists = Lists(docs, terms, impacts(weights[terms], tfs, lengths, n_docs, n_terms),
                      len(weights))
        out = [(item, *lists.best(asked, k)[:2]) for item, asked in items]
        found = np.concatenate([d for _, d, _ in out] or [docs[:0]])
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat([i for i, _, _ in out], [len(d) for _, d, _ in out]), pa.int64()),
            pa.array(ids[found], pa.int64(), mask=none[found]),
            pa.array(np.concatenate([s for *_, s in out] or [docs[:0]]), pa.int64())],
            ["item", "doc_id", "score"])

    def run(batches):
        keep_only("impact lists")
        rows: list[tuple] = []
        for batch in batches:
            rows += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            while len(rows) >= block_docs:
                yield answers(rows[:block_docs])
                rows = rows[block_docs:]
        if rows:
            yield answers(rows)

    return counts.where("n > 0").mapInArrow(run, FOUND)


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS,
           block_docs: int = BLOCK_DOCS) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents (score above 0) of each item.

    `docs` has doc_id and text, `items` item_id and text. Rows of `items` are answered one by one;
    rows equal in both are one. Every row of `docs` is a document of its own; equal scores go by
    doc_id, those without one last. Items and documents without terms, text or an item_id give
    nothing.
    """
    asked = cut(items.where("item_id is not null").select("item_id", "text").distinct().withColumn(
        "item", F.monotonically_increasing_id()))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = None
    for block in item_blocks(asked, block_terms):
        numbers: dict[bytes, int] = {}
        own = [(item, np.array([numbers.setdefault(t, len(numbers)) for t in terms]))
               for item, terms in block]
        counts = cut(term_counts(docs, numbers))
        size = counts.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        part = block_results(counts, own, document_frequencies(counts, len(numbers)), size[0] or 0,
                             size[1] or 0, k, block_docs)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], FOUND)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select(
        "item_id", "rank", "doc_id", "score")
