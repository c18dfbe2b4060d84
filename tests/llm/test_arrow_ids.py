import io
import zlib
from collections import Counter

import __spark_entry__ as driver
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import DATA
from edge import edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadloom.llm import arrow_ids

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


def digests(texts):
    tokenizer, at, out = Tokenizer.from_file(PATH), 0, []
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_registered_query_matches_the_library(spark):
    sf = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").select(
        "doc_id", "text").collect()
    assert rows(driver.queries()["op9_arrow_token_ids"](spark, sf)) == digests(docs)


def test_edge_rows(spark, edge_docs, no_docs, tmp_path):
    docs = edge_docs.withColumns({"start": F.lit("x"), "part": F.lit(0)})
    manifest = arrow_ids.write_sequences(docs, PATH, str(tmp_path / "a"), length=16)
    got = rows(arrow_ids.document_digests(spark, manifest))
    order = sorted(edge_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert got == digests([(r.doc_id, r.text) for r in order])
    empty = arrow_ids.write_sequences(no_docs, PATH, str(tmp_path / "b"))
    assert arrow_ids.document_digests(spark, empty).collect() == []


def test_files_are_equal_sequences_with_masks(spark, small, tmp_path):
    docs = small([(i, f"token number {i} " * i) for i in range(40)], "doc_id bigint, text string")
    manifest = arrow_ids.write_sequences(docs, PATH, str(tmp_path), length=8).collect()
    stream = []
    for m in sorted(manifest, key=lambda m: m.part):
        kept = 0
        for batch in arrow_ids.read_rows(m.file):
            assert batch.schema.field("ids").type == pa.list_(pa.uint16(), 8)
            assert batch.schema.field("mask").type == pa.list_(pa.bool_(), 8)
            ids, mask = (np.array(batch.column(c).to_pylist()) for c in ("ids", "mask"))
            stream += ids[mask].tolist()
            kept += int(mask.sum())
        assert kept == m.n_tokens and not any(p.name.startswith("_") for p in tmp_path.iterdir())
    assert stream == [t for i in range(40) for t in whole(f"token number {i} " * i)]


@pytest.mark.parametrize("length", [1, 3, 1000])
def test_writer_and_reader_agree_for_any_lengths(tmp_path, monkeypatch, length):
    monkeypatch.setattr(arrow_ids, "ROWS_PER_BATCH", 4)
    rng = np.random.default_rng(length)
    docs = [(i, rng.integers(0, 60_000, n).astype("<u2"))
            for i, n in enumerate([0, 1, 12, 3, 0, 0, 50, 4, 8, 0, 100, 2, 0])]
    file = tmp_path / "x.arrow"
    with file.open("wb") as sink:
        writer = arrow_ids.SequenceWriter(sink, np.dtype("<u2"), length)
        for doc, ids in docs:
            writer.add(doc, ids)
        writer.close()
    back = list(arrow_ids.read_documents(str(file)))
    assert [(d, i.tolist()) for d, i in back] == [(d, i.tolist()) for d, i in docs]


def test_a_row_is_at_a_computed_place(tmp_path):
    sink = io.BytesIO()
    writer = arrow_ids.SequenceWriter(sink, np.dtype("<u2"), 4)
    writer.add(0, np.arange(20, dtype="<u2"))
    writer.close()
    batch = pa.ipc.open_file(pa.BufferReader(sink.getvalue())).get_batch(0)
    view = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
    assert view[3 * 4:4 * 4].tolist() == [12, 13, 14, 15]


@pytest.mark.parametrize("text", [
    "a b c\x1cd\u0085e", "İSTANBUL ΣΑΣ ẞ", "é ́x", "<|endoftext|>x <|start",
    "don't  DON'T 'S 's 12ab34", "漢字かな \U0001f600\U0001f600", "﻿​ \x00 \x7f", "K Å"])
def test_words_apart_are_the_text_whole(text):
    assert [*arrow_ids.encoder(PATH).encode(text).tolist(), 1] == whole(text)


def test_remembered_words_may_overflow(monkeypatch):
    monkeypatch.setattr(arrow_ids, "CACHE_WORDS", 5)
    code = arrow_ids.WordEncoder(PATH)
    for text in ("a b c d", "a b x y z", "one two three four five six seven", "a " + "q" * 200):
        assert [*code.encode(text).tolist(), 1] == whole(text)


def test_a_tokenizer_that_sees_blanks_gets_whole_texts(spark, edge_docs, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    code, library = arrow_ids.WordEncoder(path), Tokenizer.from_file(path)
    assert not code.apart and arrow_ids.WordEncoder(PATH).apart
    for text in ("two  blanks\n and", "", None, " a"):
        assert code.encode(text).tolist() == library.encode(
            text or "", add_special_tokens=False).ids
    manifest = arrow_ids.write_sequences(edge_docs, path, str(tmp_path), length=64)
    got = Counter(ids for _, _, ids, _ in rows(arrow_ids.document_digests(spark, manifest)))
    assert got == Counter(
        1 + len(library.encode(r.text or "", add_special_tokens=False).ids)
        for r in edge_docs.collect())


def test_slices_of_a_batch_do_not_change_ids(monkeypatch):
    texts = ["one two", None, "", "  three\t\x0bfour ", "one" * 50, "two\u00a0three", "é\u0301 x"] * 9
    want = [whole(t)[:-1] for t in texts]
    for size in (1, 20, 1 << 20):
        monkeypatch.setattr(arrow_ids, "SLICE", size)
        code = arrow_ids.WordEncoder(PATH)
        for part in (pa.array(texts), pa.array(["x", *texts, "y"]).slice(1, len(texts))):
            assert [i.tolist() for i in code.encode_all(part)] == want
