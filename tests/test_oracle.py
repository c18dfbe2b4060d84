"""Every registered query against its SQL check on the driver tables."""

import os

import pytest
from check import duck, duck_bag, spark_bag
from conftest import DATA

import __spark_entry__ as driver
from threadloom.plans.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", f"{DATA}/sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = spark_bag(driver.queries()[name](spark, SF_DIR))
    want = duck_bag(con, driver.oracle_sql()[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert sum(got[1].values()) > 0


@pytest.fixture(scope="module")
def long_threads(spark, tmp_path_factory):
    """Conversations of 1, 2, 450 and 12,001 turns."""
    folder = str(tmp_path_factory.mktemp("long"))
    turns = spark.createDataFrame(
        [(i, n) for i, n in enumerate([1, 2, 450, 12_001, 401])], "conv_id bigint, n int")
    rows = turns.selectExpr("conv_id", "explode(sequence(0, n - 1)) as turn").selectExpr(
        "conv_id", "turn", "if(turn % 2 = 0, 'user', 'assistant') as role",
        "concat(' turn <', turn, '> & more ') as text")
    rows.coalesce(1).write.parquet(f"{folder}/out")
    (part,) = (p for p in os.listdir(f"{folder}/out") if p.endswith(".parquet"))
    os.link(f"{folder}/out/{part}", f"{folder}/conversations.parquet")
    return folder


@pytest.mark.parametrize(
    "name", ["thread_related_ids", "thread_messages", "thread_extract", "publish_threads"])
def test_long_threads_are_whole(spark, long_threads, name):
    got = spark_bag(driver.queries()[name](spark, long_threads))
    want = duck_bag(duck(long_threads), driver.oracle_sql()[name])
    assert got[0] == want[0] and got[1] == want[1] and sum(got[1].values()) > 3


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0
    assert "related_ids" in df.columns
