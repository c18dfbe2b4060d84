import random
from collections import Counter

import __spark_entry__ as driver
import numpy as np
import pytest
import xxhash
from conftest import DATA
from edge import edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F

from threadloom.llm import simhash


def brute_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42)
              for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes):
    """Least id reachable, of (id, fingerprint) rows."""
    fps = sorted({f for _, f in nodes})
    a = np.array(fps, np.uint64)
    root = dict(zip(fps, fps, strict=True))

    def top(f):
        while root[f] != f:
            f = root[f]
        return f

    for f in fps:
        for g in a[np.bitwise_count(a ^ np.uint64(f)) <= 3].tolist():
            x, y = top(f), top(g)
            root[max(x, y)] = min(x, y)
    least = {}
    for i, f in nodes:
        if i is not None:
            least[top(f)] = min(i, least.get(top(f), i))
    return Counter((i, f, least.get(top(f))) for i, f in nodes)


def signed(f):
    return f - (1 << 64) if f >> 63 else f


def test_registered_query_matches_brute_force(spark):
    sf = f"{DATA}/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = brute_components([(r.doc_id, brute_fingerprint(r.text, 3)) for r in docs])
    got = driver.queries()["op5_simhash_components"](spark, sf).collect()
    assert Counter((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got) == want
    assert all(len(r.fingerprint) == 16 and r.fingerprint.islower() or r.fingerprint.isdigit()
               for r in got)
    assert len({r.component_id for r in got}) < len(got)


def test_hash_is_that_of_spark(spark, small):
    rows = small([("a b c",), ("é ß 漢",)], "s string").select("s", F.xxhash64("s").alias("h"))
    for r in rows.collect():
        assert signed(int(simhash.shingle_hashes(r.s, 3)[0])) == r.h


def test_edge_rows(edge_docs, no_docs):
    docs = edge_docs.withColumns({"fp": F.lit("x"), "component_id": F.lit(0)})
    got = Counter((r.doc_id, r.fp % (1 << 64), r.component_id)
                  for r in simhash.near_duplicates(docs, words=3).collect())
    assert got == brute_components(
        [(r.doc_id, brute_fingerprint(r.text, 3)) for r in edge_docs.collect()])
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.keep_one(no_docs).collect() == []


def flipped(base, rng, bits):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


@pytest.mark.parametrize("hot", [simhash.HOT, 4, 1])
def test_links_connect_every_pair_within_the_radius(spark, hot):
    rng = random.Random(hot)
    fps = {0, (1 << 64) - 1}
    for _ in range(30):
        base = rng.getrandbits(64)
        fps |= {flipped(base, rng, rng.randint(0, 5)) for _ in range(12)}
    base = rng.getrandbits(64)  # many under one half, and under one half and quarter
    fps |= {base ^ rng.getrandbits(32) for _ in range(60)}
    fps |= {base ^ rng.getrandbits(9) for _ in range(120)}
    nodes = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    edges = simhash.links(nodes, hot=hot)
    pairs = edges.collect()
    assert all((r.a ^ r.b) % (1 << 64) and ((r.a ^ r.b) % (1 << 64)).bit_count() <= 3
               for r in pairs)
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    want = {}
    for (i, _, least), _n in brute_components([(signed(f), f) for f in fps]).items():
        want.setdefault(least, set()).add(i)
    groups = {}
    for f in fps:
        groups.setdefault(got.get(signed(f), signed(f)), set()).add(signed(f))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_dense_keys_give_forests_not_all_pairs(spark):
    n = 1 << 9
    nodes = spark.range(n).select(F.col("id").alias("fp"))
    edges = simhash.links(nodes, hot=8)
    assert edges.count() < 200 * n  # of 130,816 pairs with up to nine differing bits
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    loops = [(5000, 5000), (5001, 5002), (5002, 5001)]
    edges = spark.createDataFrame(chain + star + loops, "a bigint, b bigint")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert all(got[i] == 0 for i in range(1, 201))
    assert all(got[1000 + i] == 1000 for i in range(1, 300))
    assert got[5002] == 5001 and 5000 not in got


def test_one_document_of_each_group_stays(small):
    text = " ".join(f"word{i}" for i in range(400))
    rows = [(5, text), (3, text), (9, text + " end"), (7, "another text altogether"), (4, None),
            (8, "")]
    kept = simhash.keep_one(small(rows, "doc_id bigint, text string")).collect()
    assert sorted(r.doc_id for r in kept) == [3, 4, 7]
