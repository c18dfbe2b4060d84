"""Tokens of two tokenizers matched by the bytes they cover, over a whole corpus.

Texts are shuffled by their full content, so each distinct text is tokenised and aligned once, and
its pair counts are weighted by its number of copies. Pairs of a text are kept as packed arrays.
Counts over the corpus are added up per task and then by hash bucket of the pair; the counted pairs,
of which there are at most as many as the product of the vocabularies, meet the texts' pairs again by
bucket, and the measures of a text are joined to its documents by a digest of 128 bits.

Both tokenizers begin a new token at a single space between two other characters, so such texts are
cut there and each distinct word of a slice of texts is aligned once, in runs of many words; any other
text goes to the libraries whole.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.memory import keep_only
from threadloom.llm.pieces import BYTE, SPACE, PieceCodec, fields
from threadloom.llm.shared import cut

# Texts are worked on in slices of about so many bytes. The tokenizers see so many of a slice's
# distinct words at once, and in a call so many of such runs.
SLICE, RUN, CALL = 4 << 20, 256, 16
# Aligned texts that are handed on at a time.
OUT_TEXTS = 1000
# Hash buckets of the pair counts; counted pairs that are looked up at a time, and texts of a task.
BUCKETS, PART, TASK_TEXTS = 64, 2_000_000, 100_000
SEED = 42
# White space beside a blank, after which a word would not begin at the blank.
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNEVEN, EDGED = rf"^ | $| {_WHITE}|{_WHITE} ", rf"^{_WHITE}|{_WHITE}$"
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = ("r bigint, s bigint, copies bigint, n_a bigint, n_b bigint, n_groups bigint, "
           "n_links bigint, groups_sha256 string, pairs binary, counts binary")


def byte_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary.

    Printable Latin-1 characters stand for their own byte, the other bytes follow from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def packed(ends: np.ndarray, data: pa.Buffer) -> pa.LargeBinaryArray:
    """Bytes cut at `ends`."""
    offsets = np.append(0, ends).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), data])


@dataclass
class Table:
    """Aligned words: tokens of each side, groups and links; the groups as text; packed pairs."""

    numbers: np.ndarray
    groups: pa.LargeBinaryArray
    pairs: pa.LargeBinaryArray

    def row(self, own: np.ndarray) -> tuple:
        """Those of the words `own`, one after the other."""
        index = pa.array(own)
        return (*self.numbers[own].sum(axis=0).tolist(),
                *(bytes(column.take(index).buffers()[2] or b"")
                  for column in (self.groups, self.pairs)))


class Side:
    """Bytes of a tokenizer's tokens, their lengths, and the ids as they stand in a group's text."""

    def __init__(self, entries: list[bytes], closing: bytes):
        self.entries = entries
        self.sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        self.names = [b"%d%s" % (i, mark) for i in range(len(entries)) for mark in (b",", closing)]

    def spell(self, ids) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))


class Aligner:
    """Aligns texts by a byte-level tokenizer file (A) and a SentencePiece model (B)."""

    def __init__(self, a_path: str, b_path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        entries = [b""] * self.a.get_vocab_size()
        for entry, number in self.a.get_vocab().items():
            entries[number] = (bytes(map(alphabet.__getitem__, entry))
                               if all(c in alphabet for c in entry) else entry.encode())
        self.a_side = Side(entries, b"|")
        codec = PieceCodec(b_path)
        self.b, self.by_word = codec.model, codec.by_chunk
        entries = []
        for number, value in fields(self.b.serialized_model_proto()):
            if number == 1:
                piece = dict(fields(value))
                text = piece.get(1, b"").decode()
                entries.append(bytes([int(text[3:5], 16)]) if piece.get(3, 1) == BYTE
                               else text.replace(SPACE, " ").encode())
        self.b_side = Side(entries, b";")
        self.sides = self.a_side, self.b_side
        self.names = pa.array(self.a_side.names + self.b_side.names, pa.large_binary())

    def _words(self, texts: list[str]) -> list[tuple | None]:
        """Per text: A and B tokens, groups, links, groups as text (each with a
        semicolon after it), pairs; None if bytes differ."""
        place, table = self._apart(texts)
        return [table.row(np.array([i])) if i >= 0 else None for i in place.tolist()]

    def _ids(self, wholes: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """A and B ids of texts, given with the space before them; None if either's tokens do not
        spell the text."""
        for at in range(0, len(wholes), CALL):
            some = wholes[at:at + CALL]
            a_ids = [c.ids for c in self.a.encode_batch_fast(some, add_special_tokens=False)]
            b_ids = self.b.encode([w[1:] for w in some], num_threads=1)
            for whole, *ids in zip(some, a_ids, b_ids, strict=True):
                spelt = all(map(whole.encode().__eq__, map(Side.spell, self.sides, ids)))
                yield tuple(np.array(x, np.int32) for x in ids) if spelt else None

    def _apart(self, texts: list[str]) -> tuple[np.ndarray, Table]:
        """Row of each text, -1 for one that is not spelt, and the table of those that are."""
        return self._placed(len(texts), [
            ([i], ids) for i, ids in enumerate(self._ids([" " + t for t in texts])) if ids],
            np.array([len(t.encode()) + 1 for t in texts], np.int64))

    def _in_runs(self, words: pa.Array) -> tuple[np.ndarray, Table]:
        """As `_apart`, for words that both tokenizers tell from those around them.

        They see many words at once. A run that is not spelt, or in which a token goes over a word's
        end, is done word by word, as are words with white space at an end.
        """
        sizes = pc.binary_length(words).to_numpy().astype(np.int64) + 1
        edged = pc.match_substring_regex(words, EDGED).to_numpy(zero_copy_only=False)
        texts = words.to_pylist()
        inner, alone, done = np.flatnonzero(~edged).tolist(), np.flatnonzero(edged).tolist(), []
        runs = [inner[at:at + RUN] for at in range(0, len(inner), RUN)]
        joined = [" " + " ".join(map(texts.__getitem__, run)) for run in runs]
        for run, ids in zip(runs, self._ids(joined), strict=True):
            if ids and all(np.isin(np.cumsum(sizes[run]), np.cumsum(side.sizes[own])).all()
                           for side, own in zip(self.sides, ids, strict=True)):
                done.append((run, ids))
            else:
                alone += run
        done += [([i], ids) for i, ids in zip(
            alone, self._ids([" " + texts[i] for i in alone]), strict=True) if ids]
        return self._placed(len(texts), done, sizes)

    def _placed(self, n: int, done: list, sizes: np.ndarray) -> tuple[np.ndarray, Table]:
        places = np.fromiter(chain.from_iterable(run for run, _ in done), np.int64)
        a, b = (np.concatenate([np.zeros(0, np.int64), *(ids[k] for _, ids in done)])
                for k in (0, 1))
        place = np.full(n, -1, np.int64)
        place[places] = np.arange(len(places))
        return place, self._aligned(a, b, np.cumsum(sizes[places]))

    def _aligned(self, a: np.ndarray, b: np.ndarray, text_ends: np.ndarray) -> Table:
        """Texts laid out as one run of bytes, in which tokens and groups are told by where they end."""
        a_ends, b_ends = np.cumsum(self.a_side.sizes[a]), np.cumsum(self.b_side.sizes[b])
        total = int(text_ends[-1]) + 1 if len(text_ends) else 1
        ends_a, ends_b = np.zeros(total, bool), np.zeros(total, bool)
        ends_a[a_ends], ends_b[b_ends] = True, True
        cuts = np.flatnonzero(ends_a | ends_b)
        at_a, at_b = ends_a[cuts], ends_b[cuts]
        pairs = (a[np.cumsum(at_a) - at_a] * len(self.b_side.sizes)
                 + b[np.cumsum(at_b) - at_b]).astype(np.uint32)
        # in a group's text A's tokens come first, then B's; the group's last of each closes its side
        a_closes, b_closes = ends_b[a_ends], ends_a[b_ends]
        a_group, b_group = np.cumsum(a_closes) - a_closes, np.cumsum(b_closes) - b_closes
        a_until, b_until = np.flatnonzero(a_closes) + 1, np.flatnonzero(b_closes) + 1
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.append(0, b_until)[a_group]] = 2 * a + a_closes
        order[np.arange(len(b)) + a_until[b_group]] = 2 * b + b_closes + len(self.a_side.names)
        names = self.names.take(pa.array(order))
        a_last, b_last = (np.searchsorted(e, text_ends, "right") for e in (a_ends, b_ends))
        links_last = np.searchsorted(cuts, text_ends, "right")
        groups_last = a_group[a_last - 1] + 1
        name_ends = np.frombuffer(names.buffers()[1], np.int64)[a_last + b_last]
        return Table(
            np.diff(np.stack([a_last, b_last, groups_last, links_last], axis=1), axis=0, prepend=0),
            packed(name_ends, names.buffers()[2]),
            packed(4 * links_last, pa.py_buffer(pairs)))

    def align_all(self, texts: pa.Array) -> Iterator[tuple[int, tuple | None]]:
        """Place and alignment of every text, none of which is null or empty, in any order."""
        uneven = pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False)
        if not self.by_word:
            uneven[:] = True
        for i in np.flatnonzero(uneven).tolist():
            yield i, self._words([texts[i].as_py()])[0]
        rest = np.flatnonzero(~uneven)
        ends = np.cumsum(pc.binary_length(texts).to_numpy()[rest])
        at = 0
        while at < len(rest):
            done = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + SLICE, side="right")))
            yield from zip(rest[at:stop].tolist(),
                           self._by_word(texts.take(pa.array(rest[at:stop]))), strict=True)
            at = stop

    def _by_word(self, texts: pa.Array) -> Iterator[tuple | None]:
        words = pc.split_pattern(texts, " ")
        named = words.flatten().dictionary_encode()
        place, table = self._in_runs(named.dictionary)
        codes = place[named.indices.to_numpy()]
        borders = words.offsets.to_numpy() - words.offsets[0].as_py()
        for x, y in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            own = codes[x:y]
            yield table.row(own) if own.min() >= 0 else None


def aligner(a_path: str, b_path: str) -> Aligner:
    return keep_only(("aligner", a_path, b_path), lambda: Aligner(a_path, b_path))


def small_counts(counts: np.ndarray) -> bytes:
    """Counts of a text's pairs, in one byte each if they fit, else in four."""
    return counts.astype("u1" if counts.max(initial=0) < 256 else "<u4").tobytes()


def read_pairs(pairs: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(pairs, np.uint32)
    return found, np.frombuffer(counts, "u1" if len(counts) == len(found) else "<u4")


def aligned_texts(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Alignment of each (r, s, copies, text); one whose bytes differ has null measures."""
    names = [f.split()[0] for f in ALIGNED.split(", ")]

    def row(found):
        if found is None:
            return (None,) * 7
        *numbers, groups, pairs = found
        distinct, counts = np.unique(np.frombuffer(pairs, np.uint32), return_counts=True)
        return (*numbers, hashlib.sha256(groups[:-1]).hexdigest(), distinct.tobytes(),
                small_counts(counts))

    def batch_of(batch, places, rows):
        own = batch.select(names[:3]).take(pa.array(places, pa.int64()))
        types = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]
        columns = zip(*rows, strict=True) if rows else [()] * 7
        return pa.RecordBatch.from_arrays(
            own.columns + [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def run(batches):
        code = aligner(a_path, b_path)
        for batch in batches:
            places, rows = [], []
            for i, found in code.align_all(batch.column("text").cast(pa.string())):
                places.append(i)
                rows.append(row(found))
                if len(rows) == OUT_TEXTS:
                    yield batch_of(batch, places, rows)
                    places, rows = [], []
            yield batch_of(batch, places, rows)

    return texts.mapInArrow(run, ALIGNED)


def _merged(numbers: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(np.concatenate(numbers), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, place, np.concatenate(counts))
    return distinct, total


def _by_bucket(numbers: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    for bucket in range(BUCKETS):
        own = numbers % BUCKETS == bucket
        if own.any():
            yield bucket, numbers[own].tobytes(), counts[own].tobytes()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Per hash bucket: all id pairs, ascending, and their links over the corpus, packed."""
    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(
                zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)],
            ["bucket", "pairs", "counts"])

    def per_task(batches):
        numbers, counts, held = [], [], 0
        for batch in batches:
            for pairs, own, copies in zip(*(batch.column(c).to_pylist()
                                            for c in ("pairs", "counts", "copies")), strict=True):
                distinct, n = read_pairs(pairs, own)
                numbers.append(distinct)
                counts.append(n * np.int64(copies))
                held += len(distinct)
            if held > 4 * PART:
                one = _merged(numbers, counts)
                numbers, counts, held = [one[0]], [one[1]], 0
                if len(one[0]) > PART:
                    yield batch_of(list(_by_bucket(*one)))
                    numbers, counts = [], []
        if numbers:
            yield batch_of(list(_by_bucket(*_merged(numbers, counts))))

    def per_bucket(batches):
        now, numbers, counts = None, [], []
        for batch in batches:
            for bucket, pairs, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now:
                    if now is not None:
                        one = _merged(numbers, counts)
                        yield batch_of([(now, one[0].tobytes(), one[1].tobytes())])
                    now, numbers, counts = bucket, [], []
                numbers.append(np.frombuffer(pairs, np.uint32))
                counts.append(np.frombuffer(n, np.int64))
                if sum(map(len, numbers)) > 4 * max(PART, len(numbers[0])):
                    numbers, counts = ([x] for x in _merged(numbers, counts))
        if now is not None:
            one = _merged(numbers, counts)
            yield batch_of([(now, one[0].tobytes(), one[1].tobytes())])

    schema = "bucket int, pairs binary, counts binary"
    return aligned.where("pairs is not null").select("pairs", "counts", "copies").mapInArrow(
        per_task, schema).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        per_bucket, schema)


def best_counts(counted: DataFrame, b_size: int) -> DataFrame:
    """The greatest count of every B id: at most a row per entry of its vocabulary."""
    def run(batches):
        for batch in batches:
            for pairs, counts in zip(batch.column("pairs"), batch.column("counts"), strict=True):
                best = np.zeros(b_size, np.int64)
                np.maximum.at(best, np.frombuffer(pairs.as_py(), np.uint32) % b_size,
                              np.frombuffer(counts.as_py(), np.int64))
                ids = np.flatnonzero(best)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(best[ids])],
                                                 ["b", "best"])

    return counted.mapInArrow(run, "b bigint, best bigint").groupBy("b").agg(
        F.max("best").alias("best"))


def corpus_measures(aligned: DataFrame, counted: DataFrame, b_size: int, parts: int,
                    tasks: int) -> DataFrame:
    """Per text (r, s): n_best and count_sum.

    Buckets are joined into `parts`, a divisor of their number, and texts are dealt to `tasks`, to
    each of which a part's counts are sent. A task holds the counts of one part.
    """
    best = np.zeros(b_size, np.int64)
    for b, n in best_counts(counted, b_size).collect():  # bounded by the vocabulary
        best[b] = n
    shared = aligned.sparkSession.sparkContext.broadcast(best)

    def split(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("r", "s", "task", "pairs", "counts")]
            rows = []
            for r, s, task, pairs, own in zip(*columns, strict=True):
                numbers, n = read_pairs(pairs, own)
                for part in range(parts):
                    here = numbers % parts == part if parts > 1 else slice(None)
                    rows.append((part, task, 1, r, s, numbers[here].tobytes(),
                                 small_counts(n[here])))
            yield _rows(rows)

    def _rows(rows):
        types = [pa.int32()] * 3 + [pa.int64()] * 2 + [pa.binary()] * 2
        columns = zip(*rows, strict=True) if rows else [()] * 7
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            ["part", "task", "kind", "r", "s", "pairs", "counts"])

    def measure(batches):
        keep_only("pair counts")
        now, lists, known, total = None, [], None, None
        for batch in batches:
            out = []
            for part, task, kind, r, s, pairs, counts in zip(
                    *(c.to_pylist() for c in batch.columns), strict=True):
                if (part, task) != now:
                    now, lists, known = (part, task), [], None
                if kind == 0:
                    lists.append((np.frombuffer(pairs, np.uint32), np.frombuffer(counts, np.int64)))
                    continue
                if known is None:
                    known = np.concatenate([p for p, _ in lists])
                    order = np.argsort(known)
                    known, total = known[order], np.concatenate([c for _, c in lists])[order]
                    lists = []
                numbers, n = read_pairs(pairs, counts)
                all_links = total[np.searchsorted(known, numbers)]
                is_best = all_links == shared.value[numbers % b_size]
                out.append((r, s, int(n[is_best].sum(dtype=np.int64)),
                            int((n * all_links).sum(dtype=np.int64))))
            columns = zip(*out, strict=True) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["r", "s", "n_best", "count_sum"])

    schema = "part int, task int, kind int, r bigint, s bigint, pairs binary, counts binary"
    asked = aligned.where("pairs is not null").select(
        "r", "s", F.pmod("r", F.lit(tasks)).cast("int").alias("task"), "pairs", "counts"
    ).mapInArrow(split, schema)
    known = counted.select(
        (F.col("bucket") % parts).alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), F.lit(0).alias("kind"),
        F.lit(0).cast("bigint").alias("r"), F.lit(0).cast("bigint").alias("s"), "pairs", "counts")
    return known.unionByName(asked).repartition(parts * tasks, "part", "task").sortWithinPartitions(
        "part", "task", "kind").mapInArrow(
        measure, "r bigint, s bigint, n_best bigint, count_sum bigint").groupBy("r", "s").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def document_alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row of (doc_id, text): numbers of tokens, groups and links, and the groups' digest.

    n_best counts links whose id pair is linked as often over all rows as any pair of its B id;
    count_sum adds up the links' counts. A text that is null, empty, or not what a tokenizer's tokens
    spell, has zeros and the digest ''. Every row gives one row, also where ids repeat or are null.
    """
    key = [F.xxhash64("text").alias("r"), F.xxhash64(F.lit(SEED), "text").alias("s")]
    texts = docs.where("text <> ''").groupBy("text").agg(F.count("*").alias("copies")).select(
        *key, "copies", "text")
    aligned = cut(aligned_texts(texts, a_path, b_path))
    counted = cut(pair_counts(aligned))
    b_size = PieceCodec(b_path).model.get_piece_size()
    n_pairs = counted.agg(F.sum(F.octet_length("pairs"))).first()[0] or 0
    parts = 1
    while parts < BUCKETS and parts * PART * 4 < n_pairs:
        parts *= 2
    tasks = 1 + aligned.count() // TASK_TEXTS
    measures = corpus_measures(aligned, counted, b_size, parts, tasks)
    whole = aligned.select("r", "s", *MEASURES, "groups_sha256").join(measures, ["r", "s"], "left")
    of_row = docs.select("doc_id", F.when(F.col("text") != "", F.xxhash64("text")).alias("r"),
                         F.xxhash64(F.lit(SEED), "text").alias("s"))
    found = of_row.where("r is not null").join(whole, ["r", "s"]).unionByName(
        of_row.where("r is null"), allowMissingColumns=True)
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
          for c in (*MEASURES, "n_best", "count_sum")],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
