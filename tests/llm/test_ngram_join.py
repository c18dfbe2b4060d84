import random
from collections import Counter

import __spark_entry__ as driver
import pytest
from conftest import DATA
from edge import edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from threadloom.llm import ngram_join


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs of distinct sets."""
    sets = [frozenset(shingles(t)) for _, t in rows]
    distinct = sorted(set(sets) - {frozenset()}, key=lambda s: (len(s), sorted(s)))
    root = {s: s for s in distinct}

    def top(s):
        while root[s] is not s:
            s = root[s]
        return s

    holders = {}
    for s in distinct:
        for w in s:
            holders.setdefault(w, []).append(s)
    for s in distinct:
        both = Counter(id(t) for w in s for t in holders[w])
        near = {id(t): t for w in s for t in holders[w]}
        for k, t in near.items():
            if 100 * both[k] >= 80 * (len(s) + len(t) - both[k]):
                root[top(s)] = top(t)
    least = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if s and i is not None:
            least[top(s)] = min(i, least.get(top(s), i))
    return Counter((i, len(s), least.get(top(s)) if s else i)
                   for (i, _), s in zip(rows, sets, strict=True))


def got(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered_query_matches_brute_force(spark, sf):
    rows = spark.read.parquet(f"{DATA}/{sf}/documents.parquet").select("doc_id", "text").collect()
    want = brute([tuple(r) for r in rows])
    assert got(driver.queries()["op11_ngram_jaccard_join"](spark, f"{DATA}/{sf}")) == want


def test_edge_rows(edge_docs, no_docs):
    docs = edge_docs.withColumns({c: F.lit("x") for c in ("a", "b", "r", "node", "key", "n")})
    assert got(ngram_join.similar_documents(docs)) == brute(
        [(r.doc_id, r.text) for r in edge_docs.collect()])
    assert ngram_join.similar_documents(no_docs).collect() == []


def variants(seed, n, size, edits):
    """A family of near copies, some of which link only through others."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(size)] = f"v{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("thin, rounds, pairs, few", [(1, 0, 0, 2), (3, 3, 0, 8)])
def test_families_of_near_copies_and_common_passages(spark, small, thin, rounds, pairs, few,
                                                  monkeypatch):
    monkeypatch.setattr(ngram_join.set_components, "__defaults__", (rounds, pairs, few))
    rng = random.Random(thin)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [t for k in range(4) for t in variants(k, 40, rng.choice((30, 80, 200)), 12)]
    texts += [f"{passage} {i} {i + 1}" for i in range(30)]  # a passage in prefixes, few links
    texts += [f"{' '.join(f'x{i}_{j}' for j in range(30))} {passage}" for i in range(20)]
    texts += ["one two three", "ONE  two\nthree", "one two three four", "a " * 50, "a " * 9, None, ""]
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, "no id"), (3, texts[3]), (3, texts[3])]
    rng.shuffle(rows)
    docs = small(rows, "doc_id bigint, text string")
    want = brute(rows)
    assert got(ngram_join.similar_documents(docs, thin=thin, part=4000)) == want
    assert len({c for *_, c in want}) > 40


def test_leaders_spare_most_pairs_of_a_family(spark, small):
    rows = list(enumerate(variants(1, 300, 100, 4)))
    docs = small(rows, "doc_id bigint, text string")
    seen = []
    links = ngram_join._links

    def counting(pairs, sets):
        seen.append(pairs.count())
        return links(pairs, sets)

    ngram_join._links = counting
    try:
        assert got(ngram_join.similar_documents(docs)) == brute(rows)
    finally:
        ngram_join._links = links
    assert sum(seen) < 10 * 300  # of 44,850 pairs
