"""Token ids of a corpus as Arrow files of equal-length sequences.

Documents are put in doc_id order, encoded, closed by an end id and written one after the other as
rows of a fixed-size list: `ids` and a `mask` that is false on the padding of a file's last row.
Every row has the same length, so row r, token t lies at a computed place of a memory-mapped file.
`doc_ids` and `doc_lengths` list the documents that begin in a row, so document borders are read
from the file, too. A file is one task's range of documents and is renamed into place when it is
complete, so a task that is run again leaves one whole file.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.llm.memory import Memory, keep_only
from threadloom.llm.shared import cut

SEQUENCE = 2048
ROWS_PER_BATCH = 256
END_ID = 1
MANIFEST_SCHEMA = "part int, file string, n_docs bigint, n_tokens bigint"
DOC_SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
# Words whose ids a worker remembers, twice over, and the longest such word: about 220 MB. Texts
# are worked on in slices of about so many bytes.
CACHE_WORDS, CACHE_CHARS, SLICE = 600_000, 32, 4 << 20
# Steps of a tokenizer file that never look across ASCII white space, which is dropped.
APART_RULES = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase"}
APART_BLANKS = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
APART_CUTS = {"Whitespace", "WhitespaceSplit", "BertPreTokenizer"}
APART_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def words_apart(tokenizer: str) -> bool:
    """Whether a tokenizer, as its JSON says, gives a text the ids of its words one by one."""
    def steps(part: dict | None, key: str) -> list[dict]:
        return [] if part is None else part[key] if part["type"] == "Sequence" else [part]

    spec = json.loads(tokenizer)
    first, *_ = steps(spec["pre_tokenizer"], "pretokenizers") or [{"type": None}]
    cuts = first["type"] in APART_CUTS or (
        first["type"] == "Split" and first["invert"] and first["behavior"] == "Removed"
        and first["pattern"] == {"Regex": APART_WORDS})
    return cuts and spec["post_processor"] is None and all(
        rule["type"] in APART_RULES or rule == APART_BLANKS
        for rule in steps(spec["normalizer"], "normalizers")) and not any(
        token["content"].split() != [token["content"]] for token in spec["added_tokens"])


class WordEncoder:
    """Ids of whole texts.

    Where the tokenizer never looks across white space, texts are cut there and numbered by
    distinct word, and each distinct word is worked out once. Texts are cut at ASCII white space
    only; other white space stays inside what the library gets. Other tokenizers get whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known = Memory(self._encode, CACHE_WORDS, CACHE_CHARS)
        self.apart = words_apart(self.tokenizer.to_str())

    def _encode(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, self.dtype).tobytes() for c in coded]

    def encode(self, text: str | None) -> np.ndarray:
        return next(self.encode_all(pa.array([text], pa.string())))

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text; a null one is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            done = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + SLICE, side="right")))
            yield from (self._by_word if self.apart else self._whole)(texts.slice(at, stop - at))
            at = stop

    def _whole(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for ids in self._encode(texts.to_pylist()):
            yield np.frombuffer(ids, self.dtype)

    def _by_word(self, texts: pa.Array) -> Iterator[np.ndarray]:
        words = pc.ascii_split_whitespace(texts)
        named = words.flatten().dictionary_encode()
        distinct = named.dictionary.to_pylist()
        known = self.known.of(set(distinct))
        coded = list(map(known.__getitem__, distinct))
        ids = np.frombuffer(b"".join(coded), self.dtype)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        codes = named.indices.to_numpy()
        n = sizes[codes]
        ends = np.concatenate(([0], np.cumsum(n)))
        flat = ids[np.repeat(starts[codes] - ends[:-1], n) + np.arange(ends[-1])]
        borders = ends[words.offsets.to_numpy() - words.offsets[0].as_py()]
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            yield flat[a:b]


def encoder(path: str) -> WordEncoder:
    """One encoder, and its remembered words, per worker process."""
    return keep_only(("words", path), lambda: WordEncoder(path))


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that all executors see."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parts.path)
    return pafs.FileSystem.from_uri(uri)


def file_schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([
        ("ids", pa.list_(pa.from_numpy_dtype(dtype), length)),
        ("mask", pa.list_(pa.bool_(), length)),
        ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int64()))])


class SequenceWriter:
    """Cuts a run of documents into rows; holds one batch of rows and one document at most."""

    def __init__(self, sink, dtype: np.dtype, length: int):
        self.schema, self.length, self.dtype = file_schema(dtype, length), length, dtype
        self.out = pa.ipc.new_file(sink, self.schema)
        self.ids, self.held, self.docs = [], 0, []
        self.n_docs = self.n_tokens = self.written = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((self.n_tokens, doc_id, len(ids)))
        self.ids.append(ids)
        self.held += len(ids)
        self.n_docs += 1
        self.n_tokens += len(ids)
        if self.held >= ROWS_PER_BATCH * self.length:
            self.flush(self.held // self.length)

    def flush(self, rows: int, last: bool = False) -> None:
        held = np.concatenate(self.ids) if self.ids else np.zeros(0, self.dtype)
        full = rows * self.length
        values, rest = held[:full], held[full:]
        pad = full - len(values)
        mask = np.ones(full, bool)
        if pad:
            values = np.concatenate([values, np.zeros(pad, self.dtype)])
            mask[full - pad:] = False
        begins = [(at - self.written) // self.length for at, _, _ in self.docs]
        if last:  # an empty document may begin at the very end
            begins = [min(row, rows - 1) for row in begins]
        here = int(np.searchsorted(begins, rows))
        offsets = pa.array(np.searchsorted(begins[:here], np.arange(rows + 1)), pa.int32())

        def listed(i: int) -> pa.Array:
            return pa.ListArray.from_arrays(
                offsets, pa.array([d[i] for d in self.docs[:here]], pa.int64()))

        self.out.write_batch(pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
            listed(1), listed(2)], schema=self.schema))
        self.ids, self.held, self.docs = [rest], len(rest), self.docs[here:]
        self.written += full

    def close(self) -> None:
        if self.docs or self.held:
            self.flush(max(1, -(-self.held // self.length)), last=True)
        self.out.close()


def write_sequences(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID,
                    length: int = SEQUENCE) -> DataFrame:
    """Write (doc_id, text) to Arrow files in `folder`; returns the manifest, a row per file.

    A null text is empty and gives the end id alone. Rows of one doc_id follow each other in the
    order of their texts; a null doc_id comes first. An empty table gives an empty manifest.
    """
    def run(batches):
        code, writer = encoder(tokenizer), None
        end = np.array([end_id], code.dtype)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}.arrow"
        fs, path = store(folder)
        draft = f"{path}/_{name}.{context.taskAttemptId()}"
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(),
                                   code.encode_all(batch.column("text")), strict=True):
                if writer is None:
                    fs.create_dir(path, recursive=True)
                    sink = fs.open_output_stream(draft)
                    writer = SequenceWriter(sink, code.dtype, length)
                writer.add(doc_id, np.concatenate([ids, end]))
        if writer is not None:
            writer.close()
            sink.close()
            fs.move(draft, f"{path}/{name}")
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([context.partitionId()], pa.int32()),
                "file": [f"{folder}/{name}"],
                "n_docs": pa.array([writer.n_docs], pa.int64()),
                "n_tokens": pa.array([writer.n_tokens], pa.int64())})

    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn(
        "_tie", F.xxhash64("text")).repartitionByRange("doc_id", "_tie").sortWithinPartitions(
        "doc_id", "_tie").drop("_tie")
    return cut(ordered.mapInArrow(run, MANIFEST_SCHEMA))


def read_rows(file: str):
    """Batches of a file; from local storage they are memory-mapped, not copied."""
    fs, path = store(file)
    source = (pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem)
              else fs.open_input_file(path))
    with source, pa.ipc.open_file(source) as reader:
        for i in range(reader.num_record_batches):
            yield reader.get_batch(i)


def read_documents(file: str):
    """Pairs of doc_id and ids, in file order; one document and one batch are held at a time."""
    waiting: list[tuple[int | None, int]] = []
    tail = None
    for batch in read_rows(file):
        ids = batch.column("ids").flatten().to_numpy()
        mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
        tail = ids[mask] if tail is None else np.concatenate([tail, ids[mask]])
        waiting += zip(batch.column("doc_ids").flatten().to_pylist(),
                       batch.column("doc_lengths").flatten().to_pylist(), strict=True)
        at = done = 0
        for doc_id, n in waiting:
            if at + n > len(tail):
                break
            yield doc_id, tail[at:at + n]
            at, done = at + n, done + 1
        waiting, tail = waiting[done:], tail[at:]


def document_digests(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: its start in the whole stream, its ids' number and crc32."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn(  # a row per file
        "base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    files = max(1, manifest.count())

    def run(batches):
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(),
                                  batch.column("base").to_pylist(), strict=True):
                rows, at = [], base
                for doc_id, ids in read_documents(file):
                    rows.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.repartition(files, "part").select("file", "base").mapInArrow(run, DOC_SCHEMA)
