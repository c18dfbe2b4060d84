import hashlib
from collections import Counter

import __spark_entry__ as driver
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import DATA
from edge import edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadloom.llm import aligning

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def spans(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(rows):
    """The result by whole texts and all overlapping pairs."""
    a_code, b_code = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_code.encode_special_tokens = True
    byte_of = {c: b for c, b in aligning.byte_alphabet().items()}
    done = []
    for _, text in rows:
        found = None
        if text:
            a = a_code.encode(" " + text, add_special_tokens=False)
            b = b_code.encode(text)
            ids = a.ids  # a new list at each call
            a_parts = [bytes(byte_of[c] for c in t) for t in a.tokens]
            b_parts = [bytes([int(p[3:5], 16)]) if b_code.is_byte(i) else
                       p.replace("▁", " ").encode()
                       for i, p in zip(b, map(b_code.id_to_piece, b), strict=True)]
            if b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
                x, y = spans(a_parts), spans(b_parts)
                links, j = [], 0
                for i, (s, e) in enumerate(x):
                    while y[j][1] <= s:
                        j += 1
                    k = j
                    while k < len(y) and y[k][0] < e:
                        links.append((ids[i], b[k]))
                        k += 1
                ends = {e for _, e in x} & {e for _, e in y}

                def cut(ids, tokens, ends=ends):
                    out = [[]]
                    for i, (_, e) in zip(ids, tokens, strict=True):
                        out[-1].append(str(i))
                        if e in ends:
                            out.append([])
                    return [",".join(g) for g in out[:-1]]

                groups = list(map("{}|{}".format, cut(ids, x), cut(b, y)))
                found = len(ids), len(b), len(groups), links, ";".join(groups)
        done.append(found)
    count = Counter(link for f in done if f for link in f[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    out = Counter()
    for (doc, _), f in zip(rows, done, strict=True):
        out[(doc, 0, 0, 0, 0, 0, 0, "") if f is None else (
            doc, *f[:3], len(f[3]), sum(count[p] == best[p[1]] for p in f[3]),
            sum(count[p] for p in f[3]),
            hashlib.sha256(f[4].encode()).hexdigest())] += 1
    return out


def got(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_registered_query_matches_brute_force(spark):
    sf = f"{DATA}/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", "text").collect()]
    assert got(driver.queries()["op13_tokenizer_alignment"](spark, sf)) == brute(rows)


def test_edge_rows(edge_docs, no_docs):
    docs = edge_docs.withColumns({c: F.lit("x") for c in ("r", "s", "pairs", "n_a", "copies")})
    assert got(aligning.document_alignment(docs, A, B)) == brute(
        [(r.doc_id, r.text) for r in edge_docs.collect()])
    assert aligning.document_alignment(no_docs, A, B).collect() == []


@pytest.mark.parametrize("limits", [(1, 10, 12), (1 << 20, 1 << 20, 1 << 20)])
def test_blanks_bytes_and_copies(spark, small, monkeypatch, limits):
    for name, limit in zip(("SLICE", "PART", "TASK_TEXTS"), limits, strict=True):
        monkeypatch.setattr(aligning, name, limit)
    texts = ["two  blanks", " leading", "trailing ", "tab\there", "a \n b", "a b c", "x 　y",
             "don't we'll", "\x00null", "é漢字 \U0001f600 ok", "under▁bar", "<|endoftext|> <s> <0x41>",
             "line\nline two", "42 1234567 3.14", " ", "\n", "plain words here", "plain words here",
             "plain words too", None, "", "﻿bom x"]
    rows = list(enumerate(texts)) + [(None, "plain words here"), (3, "tab\there")]
    assert got(aligning.document_alignment(small(rows, "doc_id bigint, text string"), A, B)) == brute(
        rows)


def test_words_give_what_whole_texts_give():
    code = aligning.Aligner(A, B)
    texts = ["the quick brown fox's tail", "Ünïcode wörds, and (punctuation)!?", "a\nb c\td e", "x"]
    by_word = dict(code.align_all(pa.array(texts)))
    assert [by_word[i] for i in range(len(texts))] == code._words(texts)


def test_libraries_see_many_words_at_once():
    code, seen = aligning.Aligner(A, B), []

    class Counting:
        def __init__(self, model, call):
            self.call = getattr(model, call)

        def encode(self, texts, **options):
            seen.append(len(texts))
            return self.call(texts, **options)

        encode_batch_fast = encode

    code.a, code.b = Counting(code.a, "encode_batch_fast"), Counting(code.b, "encode")
    texts = [" ".join(f"word{i}x{j}, Other{i * j}." for j in range(50)) for i in range(40)]
    found = dict(code.align_all(pa.array(texts)))
    assert sum(seen) <= 40  # for more than 2,000 distinct words
    fresh = aligning.Aligner(A, B)
    assert [found[i] for i in range(len(texts))] == fresh._words(texts)


@pytest.mark.parametrize("run", [1, 3, 256])
def test_runs_with_words_that_are_not_spelt_or_hold_white_space(monkeypatch, run):
    monkeypatch.setattr(aligning, "RUN", run)
    code = aligning.Aligner(A, B)
    words = ["plain", "under▁bar", "\x00null", "x\ny", "\tled", "ends\n\n", "　wide", "é漢字", "<s>",
             "<|endoftext|>", "don't", "12.5", "\U0001f600", "more", "words"]
    texts = [f"{a} {b}" for a in words for b in words] + ["▁", "▁ ▁", "\n", "one"]
    even = [t for t in texts if not pa.compute.match_substring_regex(
        pa.array([t]), aligning.UNEVEN)[0].as_py()]
    for some in (texts, even, ["under▁bar"], []):
        found = dict(code.align_all(pa.array(some, pa.string())))
        assert [found[i] for i in range(len(some))] == code._words(some)
    assert code._words(["a▁b"]) == [None]


def test_texts_handed_on_in_parts_keep_their_keys(monkeypatch):
    class Run:  # in place of a table: gives back what a task does
        def mapInArrow(self, run, schema):
            return run

    texts = [f"word {i} more" for i in range(7)] + ["a\tb  c", "under▁bar"]
    n = list(range(len(texts)))
    batch = pa.RecordBatch.from_pydict({"r": n, "s": n, "copies": n, "text": texts})
    task = aligning.aligned_texts(Run(), A, B)
    whole = [row for b in task([batch]) for row in b.to_pylist()]
    monkeypatch.setattr(aligning, "OUT_TEXTS", 2)
    parts = list(task([batch]))
    assert max(b.num_rows for b in parts) <= 2
    assert [row for b in parts for row in b.to_pylist()] == whole
    assert sorted(row["r"] for row in whole) == n
    for row in whole:
        assert row["n_a"] == (aligning.Aligner(A, B)._words([texts[row["r"]]])[0] or [None])[0]
