"""Joins and numbering with one key that owns a third of the rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from threadloom.operators import joins
from threadloom.operators.serial import assign_serials
from threadloom.session import ensure_checkpoint_dir, materialize

ROWS = 30_000


@pytest.fixture(scope="module")
def big(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 100)
    return spark.range(ROWS).select(
        "id", key.alias("k"), F.create_map(F.lit("m"), F.col("id")).alias("m"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(90).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))


def answer(df):
    return sorted((r.id, r.k, r["v"]) for r in df.select("id", "k", "v").collect())


@pytest.fixture(scope="module", params=["inner", "left"])
def case(request, big, lookup):
    return request.param, answer(big.join(lookup, "k", request.param))


def test_salted_join(case, big, lookup):
    how, want = case
    assert answer(joins.salted_join(big, lookup, "k", how, salts=7)) == want


def test_spread_join_without_adaptive_execution(case, big, lookup, conf):
    how, want = case
    conf(spark__sql__adaptive__skewJoin__enabled="false")
    joined = joins.spread_join(big, lookup, "k", how)
    assert "_salt" in joined._jdf.queryExecution().toString()
    assert answer(joined) == want


def test_lookup_join_on_both_sides_of_its_bound(case, big, lookup):
    how, want = case
    broadcast = joins.lookup_join(big, lookup, "k", how)
    assert "BroadcastHashJoin" in broadcast._jdf.queryExecution().executedPlan().toString()
    assert answer(broadcast) == want
    shuffled = joins.lookup_join(big, lookup, "k", how, max_bytes=10)
    assert answer(shuffled) == want


def test_lookups_are_measured_by_their_texts(spark):
    rows = spark.range(10).select("id", F.repeat(F.lit("é"), 1000).alias("t"))
    assert 20_000 <= joins.measured_bytes(rows) <= 22_000
    assert joins.measured_bytes(rows.limit(0)) == 0


def test_adaptive_execution_splits_the_hot_key(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="32",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20000",
    )
    big = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.md5(F.col("id").cast("string")).alias("text"))
    unique = spark.range(200_000).select(F.col("id").alias("k"))
    joined = joins.spread_join(big, unique, "k")
    assert len(joined.collect()) == 200_000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan or "isSkew" in plan or "skewed" in plan


def test_assign_serials(spark):
    names = [f"name {i}" for i in range(500)] + ["", "é"]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    got = {r.name: r.no for r in assign_serials(df, "name", {"no": F.lit(40)}).collect()}
    ordered = sorted(names, key=lambda n: (hashlib.md5(n.encode()).hexdigest(), n))
    assert got == {name: 41 + i for i, name in enumerate(ordered)}


def test_assign_serials_where(spark):
    names = [f"n{i}" for i in range(300)]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, a int")
    even = F.col("a") % 2 == 0
    out = assign_serials(
        df, "name", {"a": F.lit(1000), "b": F.lit(0)}, {"a": even}).collect()
    ordered = sorted(names, key=lambda n: hashlib.md5(n.encode()).hexdigest())
    evens = [n for n in ordered if int(n[1:]) % 2 == 0]
    assert {r.name: r.b for r in out} == {n: 1 + i for i, n in enumerate(ordered)}
    assert {r.name: r.a for r in out} == {
        n: 1001 + evens.index(n) if n in evens else int(n[1:]) for n in names}


def test_materialize_uses_the_named_folder(spark):
    folder = ensure_checkpoint_dir(spark)
    df = materialize(spark.range(10))
    assert df.count() == 10
    assert spark.sparkContext.getCheckpointDir() == folder
    assert "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
