import random
import re
from collections import Counter, defaultdict

import __spark_entry__ as driver
import numpy as np
import pytest
from check import duck, duck_bag, spark_bag
from conftest import DATA
from edge import edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from threadloom.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=50):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = Counter()
    for item, text in {(i, t) for i, t in items if i is not None}:
        scores = []
        for doc, c in held:
            m = 50 + 50 * c.total() * n_docs // n_terms
            s = sum(ranking.weight(n_docs, df[t]) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                scores.append((-s, doc is None, doc))
        for rank, (s, _, doc) in enumerate(sorted(scores, key=lambda r: (r[:2], r[2] or 0))[:k], 1):
            out[item, rank, doc, -s] += 1
    return out


def got(df):
    return Counter((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect())


def test_registered_query_matches_sql(spark):
    sf = f"{DATA}/sf0.01"
    name = "op12_best_position_search"
    assert spark_bag(driver.queries()[name](spark, sf)) == duck_bag(
        duck(sf), driver.oracle_sql()[name])


def test_edge_rows(spark, small, edge_docs, no_docs):
    docs = edge_docs.withColumns({c: F.lit("x") for c in ("item", "rank", "n", "terms", "score")})
    items = [("a", "Quick wort, quick id"), ("a", "fox"), ("b", None), (None, "fox"), ("c", ""),
             ("d", "fox"), ("d", "fox"), ("e", "nowhere"), ("f", "漢字 1234 X")]
    asked = small(items, "item_id string, text string").withColumn("item", F.lit(0))
    assert got(ranking.ranked(docs, asked)) == brute(
        [(r.doc_id, r.text) for r in edge_docs.collect()], items)
    assert ranking.ranked(no_docs, asked).collect() == []
    assert ranking.ranked(docs, asked.limit(0)).collect() == []


@pytest.mark.parametrize("block_terms, block_docs", [(40, 70), (1 << 20, 1 << 15)])
def test_ties_common_terms_and_blocks(spark, small, block_terms, block_docs):
    rng = random.Random(block_docs)
    pool = [f"t{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choices(pool, [1 / (j + 1) for j in range(30)], k=rng.choice((5, 5, 9)))))
            for i in range(300)]
    docs += [(None, docs[0][1]), (7, docs[0][1]), (1000, "t29 t29 t29")]
    items = [(i, " ".join(rng.sample(pool, rng.randint(1, 12)))) for i in range(12)]
    for k in (1, 5, 50):
        assert got(ranking.ranked(
            small(docs, "doc_id bigint, text string"), small(items, "item_id bigint, text string"), k,
            block_terms, block_docs)) == brute(docs, items, k)


def test_best_positions_stop_before_the_lists_end():
    rng = np.random.default_rng(1)
    n, lists = 5000, 4
    docs, terms_, scores = [], [], []
    for t in range(lists):
        order = rng.permutation(n)
        docs.append(order)
        terms_.append(np.full(n, t))
        scores.append(np.sort(rng.pareto(1.5, n) * 1000).astype(np.int64)[::-1])
    built = ranking.Lists(np.concatenate(docs), np.concatenate(terms_), np.concatenate(scores), lists)
    found, score, read = built.best(np.arange(lists), 10)
    total = defaultdict(int)
    for d, s in zip(np.concatenate(docs).tolist(), np.concatenate(scores).tolist(), strict=True):
        total[d] += s
    kth = sorted(total.values())[-10]
    assert dict(zip(found.tolist(), score.tolist(), strict=True)) == {
        d: s for d, s in total.items() if s >= kth}
    assert read < n / 4
