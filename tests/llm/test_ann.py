import __spark_entry__ as driver
import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from threadloom.llm import ann

ROWS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every=100, k=10):
    """Per query id: the k nearest (score, id), by plain numpy."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    ids = np.array([i for i, _ in good])
    x = np.stack([v for _, v in good])
    out = {}
    for q in sorted({i for i in ids.tolist() if i % every == 0}):
        at = min(np.flatnonzero(ids == q), key=lambda j: tuple(x[j]))
        d = np.sqrt(((x - x[at]) ** 2).sum(1))
        near = sorted((d[j], ids[j]) for j in range(len(ids)) if ids[j] != q)
        out[q] = near[:k]
    return out


def check(rows, got, recall):
    want = brute(rows)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == {q for q, near in want.items() if near}
    vectors = {}
    for i, v in rows:
        vectors.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    hits = total = 0
    for q, near in want.items():
        found = sorted(by.get(q, []), key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, len(near) + 1))
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        own = min(vectors[q], key=tuple)
        for r in found:
            assert r.vec_id != q
            assert r.score in {float(np.sqrt(((own - v) ** 2).sum())) for v in vectors[r.vec_id]}
        hits += len({i for _, i in near} & {r.vec_id for r in found})
        total += len({i for _, i in near})
    assert hits >= recall * total


def test_registered_query_finds_nine_of_ten(spark):
    sf = f"{DATA}/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(
        f"{sf}/embeddings.parquet").collect()]
    check(rows, driver.queries()["op2_learned_partitions"](spark, sf).collect(), 0.9)


def vectors(n, width, seed):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(size=width).astype(np.float32).tolist()) for i in range(n)]


def test_few_rows_are_searched_whole(small):
    rows = vectors(12, 4, 0) + [(100, [0.5] * 4), (200, [0.5] * 4), (300, [0.5] * 4)]
    got = ann.neighbours(small([(i, v, 0) for i, v in rows], ROWS)).collect()
    check(rows, got, 1.0)


def test_rows_that_take_no_part_and_repeats(small):
    nan, inf = float("nan"), float("inf")
    bad = [(100, None), (200, [0.0, 0.0, 0.0]), (7, [nan, 1.0, 1.0]), (8, [1.0, inf, 1.0]),
           (9, []), (10, [1.0, 2.0]), (11, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]),
           (300, [-inf, 0.0, 0.0])]
    good = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]), (1, [1.0, 0.0, 0.0]),
            (400, [0.0, 1.0, 0.0]), (400, [0.0, 0.5, 0.0]), (3, [0.0, 0.0, 2.0])]
    table = small([(i, v, 0) for i, v in bad + good], ROWS).withColumns(
        {"vector": F.lit(1), "part": F.lit("x")})
    check(good, ann.neighbours(table).collect(), 1.0)
    assert ann.neighbours(small([], ROWS)).collect() == []
    assert ann.neighbours(small([(0, [1.0], 0)], ROWS)).collect() == []


def test_a_large_part_is_compared_in_blocks(small, monkeypatch):
    monkeypatch.setattr(ann, "ROW_BLOCK", 16)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 1)
    rows = vectors(150, 3, 1) + [(1000 + i, [0.25, 0.5, 0.75]) for i in range(60)]
    got = ann.neighbours(small([(i, v, 0) for i, v in rows], ROWS)).collect()
    check(rows, got, 0.9)


def test_parts_are_balanced_and_cut_fewer_edges_than_chance():
    rng = np.random.default_rng(3)
    x = (rng.normal(size=(8, 16)) * 4)[rng.integers(0, 8, 800)] + rng.normal(size=(800, 16))
    graph = ann.nearest(x, 10)
    part = ann.balanced_parts(x, graph, 8, 0)
    assert np.bincount(part, minlength=8).max() <= np.ceil(ann.CAPACITY * 100)
    cut = (part[:, None] != part[graph]).mean()
    assert cut < 0.5  # 7/8 by chance


def test_clustered_vectors_need_few_parts():
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(16, 16)) * 6)[rng.integers(0, 16, 3000)] + rng.normal(size=(3000, 16))
    router = ann.fit(x, 16)
    assert router.probes <= 6


@pytest.mark.parametrize("n", [1, 7, 63, 70])
def test_small_samples_can_be_fitted(n):
    x = np.random.default_rng(n).normal(size=(n, 5))
    router = ann.fit(x)
    assert router.parts(x, router.probes).shape == (n, router.probes)
