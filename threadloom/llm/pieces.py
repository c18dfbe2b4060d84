"""SentencePiece encoding that keeps, for every piece, the bytes of the text it came from.

The text is normalised as the model says: at each place the longest entry of the compiled character
map is replaced, else one character is kept; the source place of every normalised byte is recorded
on the way. The library's ids say how many normalised bytes a piece covers, so the pieces' borders
are carried back through that record to byte spans of the text.
"""

from __future__ import annotations

import hashlib
import re
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threadloom.llm.memory import Memory, keep_only

SPACE = "▁"  # fixed value: the library's visible blank
# Piece kinds of the model format.
UNKNOWN, CONTROL, USER_DEFINED, BYTE = 2, 3, 4, 6
# Chunks whose ids a worker remembers, twice over, and the longest such chunk: about 50 MB.
CACHE_CHUNKS, CACHE_CHARS = 120_000, 32
DIGEST_SCHEMA = (
    "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, span_bytes bigint")
PIECE_SCHEMA = "doc_id bigint, ids array<int>, begins array<int>, ends array<int>"


def fields(message: bytes):
    """Number and value of each field of a protocol-buffer message."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(message):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = message[at:at + size], at + size
        else:
            size = {1: 8, 5: 4}[kind]
            value, at = message[at:at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8, then the replacements."""

    def __init__(self, blob: bytes):
        if not blob:
            self.units, self.texts = (), b""
            return
        (size,) = struct.unpack_from("<I", blob)
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
        self.texts = blob[4 + size:]

    @staticmethod
    def _jump(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest entry at `at`, and its replacement."""
        if not self.units:
            return None
        best, node = None, self._jump(self.units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._jump(unit)
            if unit >> 8 & 1:
                best = i - at + 1, self.units[node] & 0x7FFFFFFF
        if best is None:
            return None
        return best[0], self.texts[best[1]:self.texts.index(b"\0", best[1])]


@dataclass
class Normaliser:
    """Text rules of a model."""

    charmap: CharacterMap
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    symbols: tuple[bytes, ...] = ()  # user-defined pieces, kept as they are

    @classmethod
    def of(cls, spec: bytes, symbols: tuple[bytes, ...] = ()) -> Normaliser:
        values = dict(fields(spec))
        return cls(CharacterMap(values.get(2, b"")), bool(values.get(3, 1)),
                   bool(values.get(4, 1)), bool(values.get(5, 1)),
                   tuple(sorted(symbols, key=len, reverse=True)))

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them and the end the place in the text's bytes."""
        data = text.encode()
        if not data:
            return b"", np.zeros(1, np.int64)
        if not self.charmap.units and not self.squeeze and not self.symbols and self.escape:
            return self._plain(data)
        return self._mapped(data)

    def _plain(self, data: bytes) -> tuple[bytes, np.ndarray]:
        blank = SPACE.encode()
        widths = np.where(np.frombuffer(data, np.uint8) == 32, len(blank), 1)
        places = np.repeat(np.arange(len(data)), widths)
        prefix = blank if self.dummy_prefix else b""
        return (prefix + data.replace(b" ", blank),
                np.concatenate([np.zeros(len(prefix), np.int64), places, [len(data)]]))

    def _step(self, data: bytes, at: int) -> tuple[int, bytes]:
        for symbol in self.symbols:
            if data.startswith(symbol, at):
                return len(symbol), symbol
        hit = self.charmap.longest(data, at)
        if hit:
            return hit
        lead = data[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return n, data[at:at + n]

    def _mapped(self, data: bytes) -> tuple[bytes, np.ndarray]:
        blank = SPACE.encode() if self.escape else b" "
        out, places, at, end = bytearray(), [], 0, len(data)
        if self.squeeze:
            while at < end:
                n, made = self._step(data, at)
                if made.strip(b" "):
                    break
                at += n
            if at == end:
                return b"", np.full(1, at)
        if self.dummy_prefix:
            out += blank
            places += [at] * len(blank)
        after_blank = self.squeeze
        while at < end:
            n, made = self._step(data, at)
            if after_blank:
                made = made.lstrip(b" ")
            if made:
                after_blank = self.squeeze and made.endswith(b" ")
                if self.escape:
                    made = made.replace(b" ", blank)
                out += made
                places += [at] * len(made)
            at += n
        if self.squeeze:
            while out.endswith(blank):
                at = places[len(out) - len(blank)]
                del out[-len(blank):], places[-len(blank):]
        return bytes(out), np.array([*places, at])


class PieceCodec:
    """Ids and spans of whole texts by a model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        kinds, sizes, texts, spec, trainer = [], [], [], b"", b""
        for number, value in fields(self.model.serialized_model_proto()):
            if number == 1:
                piece = dict(fields(value))
                kinds.append(piece.get(3, 1))
                texts.append(piece.get(1, b""))
                sizes.append({BYTE: 1, CONTROL: 0, UNKNOWN: 0}.get(kinds[-1], len(texts[-1])))
            elif number == 2:
                trainer = value
            elif number == 3:
                spec = value
        self.sizes = np.array(sizes)
        symbols = tuple(t for t, k in zip(texts, kinds, strict=True) if k == USER_DEFINED)
        self.rules = Normaliser.of(spec, symbols)
        self.ends = self.model.bos_id(), self.model.eos_id()
        self.known = Memory(self._encode_chunks, CACHE_CHUNKS, CACHE_CHARS)
        self.blank = self.model.piece_to_id(SPACE)
        # Chunks can be encoded apart if no piece goes on after its blanks with another blank,
        # nothing is unknown, and the library sees a chunk as it sees it within a text.
        mark = SPACE.encode()
        self.by_chunk = (
            BYTE in kinds and not symbols and self.rules.dummy_prefix and self.rules.escape
            and not self.rules.squeeze and not self.rules.charmap.units
            and dict(fields(trainer)).get(24, 0) == 0 and self.blank != self.model.unk_id()
            and not any(mark in re.sub(b"^(" + mark + b")+", b"", t) for t in texts))

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        coded = self.model.encode([c[1:].replace(SPACE, " ") for c in chunks], num_threads=1)
        # the library gives nothing for an empty text
        return [np.array(ids if chunk != SPACE else [self.blank], "<u4").tobytes()
                for chunk, ids in zip(chunks, coded, strict=True)]

    def ids(self, normal: str) -> np.ndarray:
        """Ids of a normalised text, whose blanks are visible, each chunk worked out once."""
        chunks = re.findall(f"{SPACE}+[^{SPACE}]*", normal)
        known = self.known.of(set(chunks))
        return np.frombuffer(b"".join(map(known.__getitem__, chunks)), "<u4")

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids with begin and end id; first byte and byte after the last of each, in the text.

        A byte piece spans its byte. Begin and end ids, and an unknown piece between known ones,
        span what the pieces around them leave.
        """
        text = text or ""
        normal, places = self.rules.normalise(text)
        body = (self.ids(normal.decode()) if self.by_chunk
                else np.array(self.model.encode(text), "<u4"))
        ids = np.concatenate([[self.ends[0]], body, [self.ends[1]]]).astype("<u4")
        sizes = self.sizes[ids]
        unknown = ids == self.model.unk_id()
        if unknown.any():
            sizes[unknown] = self._unknown_sizes(ids, unknown, normal)
        after = np.minimum(np.cumsum(sizes), len(normal))
        return ids, places[after - sizes], places[after]

    def _unknown_sizes(self, ids: np.ndarray, unknown: np.ndarray, normal: bytes) -> list[int]:
        """Bytes of each run of unknown characters: up to where the next known pieces begin."""
        at, out = 0, []
        for i, number in enumerate(ids.tolist()):
            if not unknown[i]:
                at += int(self.sizes[number])
                continue
            known = b""
            for following in ids[i + 1:].tolist():
                if following == self.model.unk_id():
                    break
                known += self.model.id_to_piece(following).encode() if self.sizes[following] else b""
            stop = normal.index(known, at + 1) if known else len(normal)
            out.append(stop - at)
            at = stop
        return out


def codec(path: str) -> PieceCodec:
    """One codec, and its remembered chunks, per worker process."""
    return keep_only(("pieces", path), lambda: PieceCodec(path))


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """Ids and byte spans of every (doc_id, text); a null text is empty."""
    def run(batches):
        for batch in batches:
            rows = [codec(model).encode(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()),
                *[pa.array([r[i].astype(np.int32) for r in rows], pa.list_(pa.int32()))
                  for i in range(3)]], ["doc_id", "ids", "begins", "ends"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECE_SCHEMA)


def document_digests(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """Per (doc_id, text): number and digest of the ids, digest of the decoded text, bytes spanned.

    Rows of null or repeated doc_id are treated like any other; a null text is empty and has its
    begin and end id alone. `with_ids` adds the ids themselves.
    """
    def digest(text):
        ids, begins, ends = codec(model).encode(text)
        decoded = codec(model).model.decode(ids.tolist())
        row = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
               hashlib.sha256(decoded.encode()).hexdigest(), int((ends - begins).sum()))
        return (*row, ids.astype(np.int32)) if with_ids else row

    fields = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string(),
              "span_bytes": pa.int64()} | ({"ids": pa.list_(pa.int32())} if with_ids else {})

    def run(batches):
        for batch in batches:
            rows = [digest(t.as_py()) for t in batch.column("text")]
            columns = zip(*rows, strict=True) if rows else [()] * len(fields)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()),
                *[pa.array(c, t) for c, t in zip(columns, fields.values(), strict=True)]],
                ["doc_id", *fields])

    schema = DIGEST_SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)
