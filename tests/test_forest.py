"""Whole comment forests against SQL and a walk from comment to comment."""

import random

from check import duck, duck_bag, spark_bag
from conftest import DATA
from pyspark.sql import functions as F

from threadloom.operators.forest import forest
from threadloom.plans.oracle import ORACLE
from threadloom.plans.queries import QUERIES


def walked(parents):
    """Result rows by following parents."""
    found, below = {}, dict.fromkeys(parents, 0)
    for i in parents:
        path = [i]
        while (up := parents[path[-1]]) in parents and len(path) <= len(parents):
            path.append(up)
        if len(path) > len(parents):
            found[i] = (None, None, "cycle")
            continue
        kind = "reply" if len(path) > 1 else "root" if parents[i] is None else "lost parent"
        found[i] = (path[-1], len(path) - 1, kind)
        for above in path[1:]:
            below[above] += 1
    return {(i, root, depth, None if root is None else below[i], kind)
            for i, (root, depth, kind) in found.items()}


def got(df):
    return {(r.Id, r.RootId, r.depth, r.n_below, r.kind) for r in df.collect()}


def test_registered_query_matches_sql(spark):
    sf = f"{DATA}/sf0.01"
    assert spark_bag(QUERIES["comment_depths"](spark, sf)) == duck_bag(
        duck(sf), ORACLE["comment_depths"])


def test_trees_cycles_lost_parents_and_repeats(small):
    rng = random.Random(3)
    parents = {f"c{i}": rng.choice([None, f"c{rng.randrange(60)}", f"c{rng.randrange(i + 1)}", "gone"])
               for i in range(60)} | {"self": "self", "a": "b", "b": "a", "under": "a"}
    rows = [*parents.items(), *list(parents.items())[:5], (None, "c1"), (None, None)]
    out = forest(small(rows, "Id string, ParentCommentId string").withColumn("size", F.lit("x")))
    assert got(out) == walked(parents) and out.count() == len(parents)
    assert forest(small([], "Id string, ParentCommentId string")).collect() == []


def test_a_thread_of_100_000(spark):
    n = 100_000
    chain = spark.range(n).select(  # one chain of a third, the rest answers the first comment
        F.col("id").cast("string").alias("Id"),
        F.when(F.col("id") == 0, F.lit(None)).when(F.col("id") < n // 3, F.col("id") - 1)
        .otherwise(0).cast("string").alias("ParentCommentId"))
    out = forest(chain)
    deep = out.orderBy(F.desc("depth")).first()
    assert (deep.Id, deep.depth, deep.n_below) == (str(n // 3 - 1), n // 3 - 1, 0)
    top = out.where("depth = 0").collect()
    assert [(r.Id, r.RootId, r.n_below, r.kind) for r in top] == [("0", "0", n - 1, "root")]
    assert out.where("RootId = '0'").count() == n
