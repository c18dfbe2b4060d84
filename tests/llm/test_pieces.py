import hashlib
import random
from collections import Counter

import __spark_entry__ as driver
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import DATA
from edge import edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from threadloom.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = [
    "", " ", "  ", "a", " a  b ", "trailing ", "▁", "▁▁ x▁y", "\t\n\r\n x", "漢字 かな é ß",
    "\U0001f600\U0001f469‍\U0001f680", "<s> </s> <unk> <0x41>", "x" * 3000, "a " * 2000,
    "   é", "ﬁ ① ｱ", "\x00 \x7f", "1234567890 !!! ... ", "ÀÉÎ  õü",
]


def expected(text):
    ids = MODEL.encode(text or "", add_bos=True, add_eos=True)
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(MODEL.decode(ids).encode()).hexdigest())


def rows(df):
    return Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect())


def test_registered_query_matches_the_library(spark):
    sf = f"{DATA}/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert rows(driver.queries()["op10_sentencepiece_spans"](spark, sf)) == Counter(
        (r.doc_id, *expected(r.text)) for r in docs)


def test_edge_rows(edge_docs, no_docs):
    docs = edge_docs.withColumns({"ids": F.lit("x"), "n_tokens": F.lit(0)})
    assert rows(pieces.document_digests(docs, PATH)) == Counter(
        (r.doc_id, *expected(r.text)) for r in edge_docs.collect())
    assert pieces.document_digests(no_docs, PATH, with_ids=True).collect() == []
    whole = pieces.document_digests(docs, PATH, with_ids=True).collect()
    assert all(len(r.ids) == r.n_tokens for r in whole)
    for r in pieces.encode_documents(docs, PATH).collect():
        assert len(r.ids) == len(r.begins) == len(r.ends)


@pytest.mark.parametrize("text", TEXTS)
def test_ids_and_spans(text):
    ids, begins, ends = pieces.codec(PATH).encode(text)
    assert ids.tolist() == MODEL.encode(text, add_bos=True, add_eos=True)
    data = text.encode()
    assert begins[0] == 0 and ends[-1] == len(data)
    assert begins[1:].tolist() == ends[:-1].tolist()  # spans follow each other
    for number, a, b in list(zip(ids.tolist(), begins, ends, strict=True))[1:-1]:
        piece = MODEL.id_to_piece(number)
        if MODEL.is_byte(number):
            assert data[a:b] == bytes([int(piece[3:5], 16)])
        else:
            got = data[a:b].decode().replace(" ", "▁")
            assert got == piece or (a == 0 and "▁" + got == piece)


def test_random_texts_match_the_library():
    rng = random.Random(1)
    alphabet = ["a", "the", " ", "  ", "▁", "é", "漢", "\n", "7", "Ж", "\U0001f600", "ing"]
    codec = pieces.PieceCodec(PATH)
    assert codec.by_chunk
    for _ in range(500):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 40)))
        assert codec.encode(text)[0].tolist() == MODEL.encode(text, add_bos=True, add_eos=True)


def test_remembered_chunks_may_overflow(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_CHUNKS", 4)
    codec = pieces.PieceCodec(PATH)
    for text in (*TEXTS, "one two three four five six seven"):
        assert codec.encode(text)[0].tolist() == MODEL.encode(text, add_bos=True, add_eos=True)


def charmap(entries):
    """A compiled map of the model format: trie units, then replacements ended by a zero byte."""
    texts, at = b"", {}
    for key, value in entries.items():
        at[key.encode()] = len(texts)
        texts += value.encode() + b"\0"
    units, used, free = {0: 0}, {0}, [256]

    def place(node, keys):
        by = {}
        for key in keys:
            by.setdefault(key[0] if key else None, []).append(key[1:] if key else key)
        base = free[0]
        free[0] += 256
        jump = node ^ base
        units[node] |= (jump << 10) if jump < 1 << 21 else ((jump >> 8) << 10) | 0x200
        if None in by:
            units[node] |= 1 << 8
        return base, by

    def build(node, prefix, keys):
        base, by = place(node, keys)
        if None in by:
            units[base] = at[prefix] | 1 << 31
            used.add(base)
        for byte, rest in by.items():
            if byte is not None:
                units[base ^ byte] = byte
                used.add(base ^ byte)
        for byte, rest in by.items():
            if byte is not None:
                build(base ^ byte, prefix + bytes([byte]), rest)

    build(0, b"", sorted(at))
    size = (max(used) // 256 + 2) * 256
    blob = np.array([units.get(i, 0) for i in range(size)], "<u4").tobytes()
    return len(blob).to_bytes(4, "little") + blob + texts


MAP = {"ﬁ": "fi", "①": "1", " ": " ", "\t": " ", "é": "é", "e": "e", "ab": "x",
       "abc": "y", "​": ""}


def brute(text, squeeze):
    """Longest-prefix replacement by plain text, with the places of the sources."""
    out, i = [], 0
    while i < len(text):
        key = max((k for k in MAP if text.startswith(k, i)), key=len, default=text[i])
        out += [(c, len(text[:i].encode())) for c in MAP.get(key, key)]
        i += len(key)
    if squeeze:
        while out and out[0][0] == " ":
            del out[0]
        while out and out[-1][0] == " ":
            del out[-1]
        out = [c for n, c in enumerate(out) if c[0] != " " or out[n - 1][0] != " "]
    return out


@pytest.mark.parametrize("squeeze", [False, True])
def test_longest_prefixes_are_replaced_and_keep_their_places(squeeze):
    rules = pieces.Normaliser(pieces.CharacterMap(charmap(MAP)), True, squeeze, True)
    for text in ("ﬁx ① ée", "abcab abd", " a \t b  ", "​", "x​ y", "", "  "):
        normal, places = rules.normalise(text)
        want = brute(text, squeeze)
        if not text or (squeeze and not want):
            assert normal == b""
            continue
        assert normal.decode() == "▁" + "".join(c for c, _ in want).replace(" ", "▁")
        assert len(places) == len(normal) + 1
        sources = [p for c, p in want for _ in ("▁" if c == " " else c).encode()]
        assert places[3:-1].tolist() == sources


def test_changed_rules_match_the_library():
    """The same pieces under another map: the library normalises as this module does."""
    proto = MODEL.serialized_model_proto()

    def field(number, value):
        if isinstance(value, int):
            return bytes([number << 3, value])
        size, out = len(value), b""
        while size > 127:
            out, size = out + bytes([size & 127 | 128]), size >> 7
        return bytes([number << 3 | 2]) + out + bytes([size]) + value

    for squeeze in (0, 1):
        spec = field(2, charmap(MAP)) + field(3, 1) + field(4, squeeze) + field(5, 1)
        at = proto.rindex(b"\n\x08identity") - 2  # the normaliser's own field is the last one
        changed = proto[:at] + field(3, spec)
        library = sentencepiece.SentencePieceProcessor(model_proto=changed)
        rules = pieces.Normaliser.of(spec)
        for text in ("ﬁx ① ée abcd", " a \tb  c ", "plain text", "x​y abz"):
            normal, _ = rules.normalise(text)
            found = "".join(library.encode(text, out_type=str))
            assert found.encode() == normal or "<0x" in found
