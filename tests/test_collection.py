"""Documents that are changed by rewriting only the files a change can touch."""

import pytest
from check import duck, duck_bag, spark_bag
from conftest import DATA
from pyspark.sql import functions as F

from threadloom.operators import documents
from threadloom.plans.oracle import ORACLE
from threadloom.plans.queries import QUERIES
from threadloom.sources.collection import Collection

SF = f"{DATA}/sf0.01"


@pytest.fixture
def stored(spark, tmp_path):
    """The documents in eight files by source, and the same rows as a frame."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "lang", "source", "n_chars")
    collection = Collection(spark, str(tmp_path / "docs"), ("doc_id", "lang", "source"))
    assert collection.version() == 0
    collection.insert(rows.repartitionByRange(8, "source"))
    return collection, rows


def same(a, b):
    return spark_bag(a) == spark_bag(b)


def test_registered_query_matches_sql(spark):
    assert spark_bag(QUERIES["doc_rewrite"](spark, SF)) == duck_bag(duck(SF), ORACLE["doc_rewrite"])


def test_only_files_that_match_are_rewritten(stored):
    collection, rows = stored
    n = collection.files().count()
    assert n > 4
    before = {r._file for r in collection.files().collect()}
    found = collection.update_first({"source": "src3"}, {"lang": "xx"}, "doc_id")
    assert (found["matched"], found["modified"], found["rewritten"]) == (1, 1, 1)
    want = documents.update_first(rows, {"source": "src3"}, {"lang": "xx"}, "doc_id")
    assert same(collection.read(), want)
    after = {r._file for r in collection.files().collect()}
    assert len(before & after) == n - 1 and len(after) == n
    gone = collection.delete({"source": "src3", "lang": "en"})
    assert gone["deleted"] == want.where("source = 'src3' and lang = 'en'").count() > 0
    assert gone["rewritten"] <= 2
    assert same(collection.read(), documents.delete_matching(want, {"source": "src3", "lang": "en"}))
    assert same(collection.read(1), rows)  # an older version still reads the same


def test_statistics_leave_out_files_and_never_a_match(stored):
    collection, rows = stored
    for condition in ({"source": "src7"}, {"doc_id": 500}, {"doc_id": 500, "source": "src1"},
                      {"lang": None}, {"n_chars": 10}, {}, {"source": "nowhere"}):
        assert same(collection.find(condition), documents.find(rows, condition))
    n = collection.files().count()
    assert 1 <= collection.candidates({"doc_id": 500}).count() < n / 2  # by the Bloom filter
    assert collection.candidates({"doc_id": 10**9}).isEmpty()
    assert collection.candidates({"n_chars": 10}).count() == n  # not indexed


def test_changes_without_a_match_write_nothing(stored):
    collection, rows = stored
    assert collection.update_first({"source": "x"}, {"lang": "xx"}, "doc_id")["matched"] == 0
    assert collection.delete({"source": "src3", "lang": "zz"})["deleted"] == 0
    first = rows.where("source = 'src3'").agg(F.min(F.struct("doc_id", "lang")).alias("m")).first().m
    same_value = collection.update_first({"source": "src3"}, {"lang": first.lang}, "doc_id")
    assert (same_value["matched"], same_value["modified"]) == (1, 0)
    assert collection.version() == 1


def test_a_second_writer_fails_and_loses_nothing(spark, stored):
    collection, rows = stored
    more = rows.limit(3).withColumn("doc_id", F.col("doc_id") + 10**6)
    collection.insert(more)
    with pytest.raises(RuntimeError, match="another writer"):
        collection._publish(1, collection.files(1), more)
    assert same(collection.read(), rows.unionByName(more))


def test_null_columns_and_an_emptied_collection(spark, small, tmp_path):
    rows = small([(1, None), (2, None), (None, "a")], "id bigint, tag string")
    collection = Collection(spark, str(tmp_path / "c"), ("id", "tag"))
    collection.insert(rows)
    assert collection.delete({"tag": None})["deleted"] == 2
    assert [tuple(r) for r in collection.read().collect()] == [(None, "a")]
    assert collection.delete({})["deleted"] == 1
    assert collection.find({"tag": "a"}).count() == 0
    with pytest.raises(ValueError):
        Collection(spark, str(tmp_path / "none"), ()).read()
