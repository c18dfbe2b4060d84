"""The state in force at an event's time, against SQL and a search per event."""

import random
from collections import Counter

from check import duck, duck_bag, spark_bag
from conftest import DATA
from pyspark.sql import functions as F

from threadloom.operators.asof import asof_join
from threadloom.plans.oracle import ORACLE
from threadloom.plans.queries import QUERIES


def test_registered_query_matches_sql(spark):
    sf = f"{DATA}/sf0.01"
    assert spark_bag(QUERIES["event_schedule_asof"](spark, sf)) == duck_bag(
        duck(sf), ORACLE["event_schedule_asof"])


def test_spans_ties_nulls_and_a_hot_key(small):
    rng = random.Random(1)

    def key():
        return rng.choice(["hot", "hot", "a", "b", "c", "only events", None])

    events = [(i, key(), rng.choice([None, *range(-20, 200)])) for i in range(400)]
    states = [(key(), rng.choice([None, *range(0, 200, 7)]), i) for i in range(60)]
    states = [(k, t, i) for k, t, i in states if k != "only events"]
    out = asof_join(
        small(events, "id int, k string, t bigint").withColumn("state_", F.lit(1)),
        small(states, "k string, t bigint, v int"), "k", "t", "v", width=16)
    want = Counter()
    for i, k, t in events:
        at = [(s, v) for sk, s, v in states if None not in (k, t, s) and sk == k and s <= t]
        want[i, k, t, max(at) if at else None] += 1
    assert Counter((r.id, r.k, r.t, r.state and tuple(r.state)) for r in out.collect()) == want
    assert out.columns == ["id", "k", "t", "state_", "state"]
