"""Benchmark passages in training documents, by a positional index split by document.

`build_index` stores, per document, the places of the words that benchmark items use. It is a table
of one row per document, so any number of tasks hold it, and no document's postings are divided.
`find` looks windows up in it: in each document the posting lists of a window's words, shifted by
their places in the window, are intersected from the word that is rarest over all documents, so
most windows end at their first word. Windows are matched exactly, or with `slop` further words
between theirs (proximity).

The benchmark is a stated query set. Its windows reach the tasks in blocks of at most
`BLOCK_WORDS` words, a bounded broadcast each; more windows take further passes over the index.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.shared import cut

WINDOW = 10
BLOCK_WORDS = 2_000_000
INDEX_SCHEMA = (
    "doc_id bigint, n_words bigint, terms array<int>, starts array<int>, positions array<int>")
HIT_SCHEMA = "doc_id bigint, n_words bigint, positions array<int>, items array<string>"
# ASCII that is no part of a word is blanked, A-Z lower-cased, the rest kept.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A
    else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else 0x20
    for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


def spans(present: np.ndarray, length: int, slop: int) -> np.ndarray:
    """Places that can be part of a match: some `length + slop` words hold `length` present ones."""
    n, width = len(present), length + slop
    if n <= width:
        return present if int(present.sum()) >= length else np.zeros(n, bool)
    before = np.concatenate(([0], np.cumsum(present)))
    dense = before[width:] - before[:-width] >= length
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, np.flatnonzero(dense), 1)
    np.add.at(mark, np.flatnonzero(dense) + width, -1)
    return present & (np.cumsum(mark)[:n] > 0)


class Windows:
    """Distinct windows of one block, as tuples of term numbers, with the items that hold them."""

    def __init__(self, rows, window: int):
        self.terms: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[str]] = {}
        for item, text in rows:
            ids = [self.terms.setdefault(w, len(self.terms)) for w in words(text)]
            for at in range(max(1, len(ids) - window + 1)) if ids else ():
                self.items.setdefault(tuple(ids[at:at + window]), []).append(item)
        self.shortest = min(map(len, self.items), default=0)

    def by_rarest(self, seen: dict[int, int]) -> dict[int, list]:
        """Per rarest term: window, its places from the rarest word on, items."""
        out: dict[int, list] = {}
        for window, items in self.items.items():
            order = sorted(range(len(window)), key=lambda i: (seen.get(window[i], 0), i))
            out.setdefault(window[order[0]], []).append((window, order, sorted(set(items))))
        return out


def item_blocks(benchmark: DataFrame, window: int, block_words: int = BLOCK_WORDS):
    """Blocks of the benchmark, read through a bounded buffer; items without words are left out."""
    rows, n = [], 0
    for item, text in benchmark.where("item_id is not null and text is not null").select(
            F.col("item_id").cast("string"), "text").toLocalIterator():
        if not words(text):
            continue
        rows.append((item, text))
        n += len(words(text))
        if n >= block_words:
            yield Windows(rows, window)
            rows, n = [], 0
    if rows:
        yield Windows(rows, window)


def build_index(docs: DataFrame, windows: Windows, slop: int = 0) -> DataFrame:
    """Postings of the block's words in (doc_id, text): distinct terms, their positions in a row.

    `positions[starts[i]:starts[i + 1]]` are the ascending places of `terms[i]`. Only places that
    can take part in a match with this `slop` are stored. A null text has no words.
    """
    shared = docs.sparkSession.sparkContext.broadcast((windows.terms, windows.shortest))

    def postings(text):
        terms, shortest = shared.value
        tokens = words(text)
        ids = np.fromiter(map(terms.get, tokens, repeat(-1)), np.int32, len(tokens))
        kept = np.flatnonzero(spans(ids >= 0, shortest, slop)) if terms else np.zeros(0, int)
        ids = ids[kept]
        order = np.argsort(ids, kind="stable")
        found, starts = np.unique(ids[order], return_index=True)
        return len(tokens), found, np.append(starts, len(order)), kept[order]

    def run(batches):
        for batch in batches:
            rows = [postings(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()),
                pa.array([r[0] for r in rows], pa.int64()),
                *[pa.array([r[i].astype(np.int32) for r in rows], pa.list_(pa.int32()))
                  for i in (1, 2, 3)]], ["doc_id", "n_words", "terms", "starts", "positions"])

    return docs.select("doc_id", "text").mapInArrow(run, INDEX_SCHEMA)


def exact_starts(lists: list[np.ndarray], places: list[int]) -> np.ndarray:
    """Starts of the phrase whose word `places[i]` has positions `lists[i]`; rarest word first."""
    starts = lists[0] - places[0]
    for positions, place in zip(lists[1:], places[1:], strict=True):
        if not len(starts):
            break
        starts = np.intersect1d(starts, positions - place, assume_unique=True)
    return starts


def near_hits(lists: list[np.ndarray], slop: int) -> np.ndarray:
    """Positions of in-order matches with at most `slop` other words in all between the words.

    `lists` are in window order. From every start the earliest next word is taken, which gives the
    shortest match that begins there.
    """
    at = lists[0]
    paths = [at]
    for positions in lists[1:]:
        nxt = np.searchsorted(positions, at, side="right")
        ok = nxt < len(positions)
        paths = [p[ok] for p in paths]
        at = positions[nxt[ok]]
        paths.append(at)
    short = paths[-1] - paths[0] < len(lists) + slop
    return np.unique(np.concatenate([p[short] for p in paths])) if paths else at


def find(index: DataFrame, windows: Windows, slop: int = 0) -> DataFrame:
    """Per document of the index: hit positions and the items with a match, both ascending."""
    seen = {
        r["term"]: r["n"]  # at most one row per term of the block
        for r in index.select(F.explode("terms").alias("term")).groupBy("term").agg(
            F.count("*").alias("n")).collect()}
    shared = index.sparkSession.sparkContext.broadcast(windows.by_rarest(seen))

    def matches(terms, starts, positions):
        lists = {t: positions[a:b] for t, a, b in zip(terms, starts, starts[1:], strict=False)}
        hits, items = [], set()
        for term in terms:
            for window, order, names in shared.value.get(term, ()):
                if any(t not in lists for t in window):
                    continue
                if slop:
                    hit = near_hits([lists[t] for t in window], slop)
                else:
                    begin = exact_starts([lists[window[i]] for i in order], order)
                    hit = (begin[:, None] + np.arange(len(window))).ravel()
                if len(hit):
                    hits.append(hit)
                    items.update(names)
        return (np.unique(np.concatenate(hits)) if hits else np.zeros(0, int)), sorted(items)

    def run(batches):
        for batch in batches:
            rows = [
                matches(t, s, np.asarray(p, np.int64))
                for t, s, p in zip(*(batch.column(c).to_pylist()
                                     for c in ("terms", "starts", "positions")), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("n_words"),
                pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                pa.array([r[1] for r in rows], pa.list_(pa.string()))],
                ["doc_id", "n_words", "positions", "items"])

    return index.mapInArrow(run, HIT_SCHEMA)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  slop: int = 0) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, the positions hit and the items found.

    Items of fewer than `window` words are one window. Items without words, text or item_id take no
    part; items and windows may repeat. With an empty benchmark no word is hit. Every row of `docs`
    gives one row, also where doc_id is null or repeated, however many blocks the benchmark needs.
    """
    blocks = item_blocks(benchmark, window)
    first = next(blocks, None) or Windows([], window)
    second = next(blocks, None)
    if second is None:
        index = build_index(docs, first, slop)
        return find(cut(index) if first.items else index, first, slop)
    # rows are told apart by id and text: those equal in both have equal hits
    row = F.xxhash64("doc_id", "text")
    keyed = docs.select(row.alias("doc_id"), "text")
    found = [
        find(cut(build_index(keyed, windows, slop)), windows, slop)
        for windows in chain((first, second), blocks)
    ]
    merged = reduce(DataFrame.unionByName, found).groupBy(F.col("doc_id").alias("row_")).agg(
        F.max("n_words").alias("n_words"),
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)
          for c in ("positions", "items")])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row.alias("row_")).join(
        merged, "row_").select("doc_id", "n_words", "positions", "items")


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", F.size("positions").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("positions") > 0).alias("contaminated"))

