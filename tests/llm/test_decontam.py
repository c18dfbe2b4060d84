import hashlib
import random
import re

import __spark_entry__ as driver
import numpy as np
import pytest
from check import duck, duck_bag, spark_bag
from conftest import DATA
from edge import edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from threadloom.llm import decontam

ITEMS = "item_id bigint, text string"
PAIR = "doc_id bigint, text string"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def brute(docs, items, window=10):
    out = {}
    for doc, text in docs:
        tokens, hit, names = words(text), set(), set()
        for item, passage in items:
            p = words(passage)
            for at in range(max(1, len(p) - window + 1)) if p else ():
                w = p[at:at + window]
                for i in range(len(tokens) - len(w) + 1):
                    if tokens[i:i + len(w)] == w:
                        hit.update(range(i, i + len(w)))
                        names.add(str(item))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out[doc] = (len(tokens), len(hit), len(names), digest, bool(hit))
    return out


def result(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
            for r in decontam.digest(df).collect()}


def test_registered_query_matches_sql(spark):
    sf = f"{DATA}/sf0.01"
    name = "op7_benchmark_index"
    got = spark_bag(driver.queries()[name](spark, sf))
    assert got == duck_bag(duck(sf), driver.oracle_sql()[name])
    assert sum(n for row, n in got[1].items() if row[got[0].index("contaminated")]) > 5


def random_case(rng):
    vocabulary = [f"w{i}" for i in range(6)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice((0, 1, 2, 5, 10, 11, 14)))))
             for i in range(12)]
    docs = []
    for i in range(60):
        text = rng.choices([*vocabulary, "other", "Ünique"], k=rng.randint(0, 30))
        if rng.random() < 0.6:
            text[3:3] = rng.choice(items)[1].upper().split()
        docs.append((i, rng.choice((" ", ", ", "\n-")).join(text)))
    return docs, items


@pytest.mark.parametrize("window", [3, 10])
def test_random_texts_match_brute_force(small, window):
    docs, items = random_case(random.Random(window))
    got = result(decontam.contamination(small(docs, PAIR), small(items, ITEMS), window))
    assert got == brute(docs, items, window)


def test_several_blocks_give_the_same(small, monkeypatch):
    docs, items = random_case(random.Random(5))
    monkeypatch.setattr(decontam.item_blocks, "__defaults__", (20,))
    got = result(decontam.contamination(small(docs, PAIR), small(items, ITEMS), 3))
    assert got == brute(docs, items, 3)


def test_edge_rows(small, edge_docs, no_docs):
    items = [(1, "quick BROWN fox"), (1, "quick BROWN fox"), (2, None), (3, ""), (4, "..."),
             (5, "wort " * 30), (10, "the quick")]
    docs = edge_docs.withColumns({"positions": F.lit(0), "items": F.lit("x")})
    found = decontam.contamination(docs, small([*items, (None, "no id")], ITEMS))
    assert found.count() == edge_docs.count()
    got = result(found)
    assert got == brute([(r.doc_id, r.text) for r in edge_docs.collect()], items)
    assert got[5][1] == 40_000
    assert decontam.contamination(no_docs, small(items, ITEMS)).collect() == []
    clean = decontam.contamination(edge_docs, small([], ITEMS))
    assert clean.count() == edge_docs.count() and not clean.where("size(items) > 0").count()


def test_proximity_matches(small):
    docs = [(1, "alpha x beta y gamma"), (2, "alpha x x x beta gamma"), (3, "gamma beta alpha"),
            (4, "alpha alpha beta gamma")]
    items = small([(7, "alpha beta gamma")], ITEMS)
    found = {r.doc_id: r.positions for r in decontam.contamination(
        small(docs, PAIR), items, slop=2).collect()}
    assert found == {1: [0, 2, 4], 2: [], 3: [], 4: [0, 1, 2, 3]}
    exact = decontam.contamination(small(docs, PAIR), items)
    assert {r.doc_id: r.positions for r in exact.collect()}[4] == [1, 2, 3]


def test_rarest_word_leads():
    windows = decontam.Windows([("a", "x y z")], 10)
    (found,) = windows.by_rarest({0: 50, 1: 2, 2: 9}).items()
    assert found[0] == 1 and found[1][0][1] == [1, 2, 0]


def test_index_keeps_what_can_match():
    present = np.array([1, 1, 0, 1, 1, 1, 0, 0, 1, 1], bool)
    assert decontam.spans(present, 3, 0).tolist() == [False] * 3 + [True] * 3 + [False] * 4
    assert decontam.spans(present, 4, 1).tolist() == [True, True, False, True, True, True] + [
        False] * 4


def test_several_blocks_keep_rows_of_one_or_no_id(small, monkeypatch):
    docs = small([(1, "a b c"), (1, "x d e f"), (1, "a b c"), (None, "d e f"), (None, "none"),
                  (2, None)], PAIR)
    items = small([(1, "a b c"), (2, "d e f")], ITEMS)
    one = decontam.contamination(docs, items).collect()
    monkeypatch.setattr(decontam.item_blocks, "__defaults__", (2,))
    several = decontam.contamination(docs, items).collect()
    assert len(several) == 6
    assert sorted(map(str, several)) == sorted(map(str, one))
