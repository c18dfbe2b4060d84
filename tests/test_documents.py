import pytest
from pyspark.sql import functions as F

from threadloom.operators import documents as docs
from threadloom.sources import sinks, tables
from threadloom.schema import LEDGER

ROWS = [(1, "en", "a"), (2, "en", "b"), (3, None, "a"), (4, "en", "a")]


@pytest.fixture
def collection(small):
    return small(ROWS, "id bigint, lang string, source string").repartition(3)


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("condition, want", [
    ({}, [1, 2, 3, 4]), ({"lang": "en"}, [1, 2, 4]), ({"lang": None}, [3]),
    ({"lang": "en", "source": "a"}, [1, 4]), ({"lang": "xx"}, []),
])
def test_find_and_delete(collection, condition, want):
    assert ids(docs.find(collection, condition)) == want
    rest = sorted({1, 2, 3, 4} - set(want))
    assert ids(docs.delete_matching(collection, condition)) == rest
    assert docs.delete_count(collection, condition).first().deleted == len(want)


def test_update_first(collection):
    match, change = {"lang": "en", "source": "a"}, {"lang": "de", "seen": True}
    out = docs.update_first(collection, match, change, "id").orderBy("id").collect()
    assert [r.lang for r in out] == ["de", "en", None, "en"]
    assert [r.seen for r in out] == [True, None, None, None]


@pytest.mark.parametrize("match, change, want", [
    ({"source": "a"}, {"lang": "de"}, (1, 1)),
    ({"source": "a"}, {"lang": "en"}, (1, 0)),   # first match is so already
    ({"source": "z"}, {"lang": "de"}, (0, 0)),
])
def test_update_counts(collection, match, change, want):
    assert tuple(docs.update_counts(collection, match, change, "id").first()) == want
    if want == (0, 0):
        assert sorted(map(tuple, docs.update_first(collection, match, change, "id").collect()),
                      key=lambda r: r[0]) == ROWS


def test_insert_gives_ids(small, collection):
    new = small([("k1", "fr"), (None, "fr")], "id string, lang string")
    out = docs.insert(collection.withColumn("id", F.col("id").cast("string")), new, "id")
    got = [r.id for r in out.filter("lang = 'fr'").collect()]
    assert "k1" in got and len(set(got)) == 2 and None not in got
    assert out.count() == 6


def test_collections_on_disk(spark, collection, tmp_path):
    path = str(tmp_path / "c")
    sinks.append(collection, "parquet", path=path)
    sinks.append(collection.limit(1), "parquet", path=path)
    assert tables.read_collection(spark, "parquet", None, path=path).count() == 5
    found = tables.read_collection(spark, "parquet", {"lang": "en"}, path=path)
    assert "EqualTo(lang,en)" in found._jdf.queryExecution().toString()
    assert tables.read_collection(spark, "parquet", {"lang": "zz"}, path=path).count() == 0


def test_json_files(spark, collection, tmp_path):
    path = str(tmp_path / "j")
    sinks.write_json(collection, path)
    assert spark.read.json(path).count() == 4
    assert '"lang":null' in "".join(r.value for r in spark.read.text(path).collect())


def test_sql(spark, collection, tmp_path):
    collection.createOrReplaceTempView("docs_view")
    query = "SELECT id FROM docs_view WHERE source = :s ORDER BY id"
    assert [r.id for r in tables.fetch_rows(spark, query, s="a")] == [1, 3, 4]
    assert tables.fetch_first(spark, query, s="a").id == 1
    assert tables.fetch_first(spark, query, s="x' OR '1'='1") is None
    file = tmp_path / "q.sql"
    file.write_text(query + "\n")
    assert tables.run_sql(spark, str(file), s="b").count() == 1


def test_ensure_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS made")
    for _ in range(2):
        sinks.ensure_table(spark, "made.topics", LEDGER["KafkaTopic"])
    assert [(f.name, f.dataType) for f in spark.table("made.topics").schema] == [
        (f.name, f.dataType) for f in LEDGER["KafkaTopic"]]
