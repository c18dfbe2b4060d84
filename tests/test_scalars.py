import math
from datetime import datetime
from urllib.parse import urlencode

import pytest
from pyspark.sql import functions as F

from threadloom.functions import scalars as fx


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


@pytest.mark.parametrize("name, ranking, want", [
    ("r/GRE/", "new", "/r/GRE/new/"),
    ("/r/GRE", "new", "/r/GRE/new/"),
    ("//r/GRE//", "new", "/r/GRE/new/"),
    ("r/news", "new", "/r/news/"),
    ("r/friday", "day", "/r/friday/"),
    ("r/a", "hot", "/r/a//"),
    ("r/a", "rising", "/r/a//rising/"),
    ("r/a", "topall", "/r/a/top/?sort=top&t=all"),
    ("r/a", "bogus", "/r/a/"),
])
def test_board_path(spark, name, ranking, want):
    assert one(spark, fx.board_path(F.lit(name), F.lit(ranking))) == (want,)


@pytest.mark.parametrize("seconds, want", [
    (0.0, "00:00:00"), (59.9, "00:00:59"), (3661.0, "01:01:01"), (360000.0, "100:00:00"),
    (-1.0, "-1:59:59"), (86399.999, "23:59:59"),
])
def test_hms(spark, seconds, want):
    assert one(spark, fx.hms(F.lit(seconds))) == (want,)


@pytest.mark.parametrize("cursor", ["t3_x", "a b&c=d/é", "~*-._"])
def test_next_page_suffix(spark, cursor):
    query = urlencode({"count": 25, "after": cursor})
    got = one(
        spark,
        fx.next_page_suffix(F.lit("/r/a/new/"), F.lit(cursor)),
        fx.next_page_suffix(F.lit("/r/a/top/?sort=top&t=all"), F.lit(cursor)))
    assert got == ("/?" + query, "&" + query)


def test_next_page_suffix_without_cursor(spark):
    assert one(spark, fx.next_page_suffix(F.lit("/r/a/"), F.lit(None).cast("string"))) == (
        "/?count=25&after=None",)


NOW = 1_700_000_000_000


@pytest.mark.parametrize("created, period, want", [
    (NOW - 10_000, 10, True),       # exactly the period
    (NOW - 10_001, 10, False),
    (NOW + 5_000, 10, True),        # in the future
    (0, None, True),                # no period
    (0, 0, True),
    (NOW - 100, 0.1, True),
    (NOW - 101, 0.1, False),
    (NOW + 5_000, -5, True),
    (NOW + 4_999, -5, False),
])
def test_in_period(spark, created, period, want):
    column = F.lit(period).cast("double")
    assert one(
        spark,
        fx.in_period(F.lit(created), NOW, period),
        fx.in_period_by(F.lit(created), NOW, column)) == (want, want)


def test_in_period_accepts_datetime(spark):
    now = datetime(2024, 1, 31)
    assert fx.epoch_ms(now) == 1_706_659_200_000
    assert one(spark, fx.in_period(F.lit(fx.epoch_ms(now) - 1000), now, 1)) == (True,)


def test_in_period_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).withColumnRenamed("id", "created_ms").write.parquet(path)
    plan = spark.read.parquet(path).filter(fx.in_period("created_ms", 8, 0.003))
    text = plan._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(created_ms,5)" in text
    assert plan.count() == 5


def test_times(spark):
    got = one(
        spark,
        fx.iso_to_millis(F.lit("2023-11-14T22:13:20+00:00")),
        fx.iso_to_millis(F.lit("2023-11-15T02:13:20.500+04:00")),
        fx.iso_to_millis(F.lit("some day")),
        *[fx.iso_to_millis(F.lit(t)) for t in ("12:30", "T12:30", "2024", "2024-01", "")],
        F.unix_millis(fx.created_ts(F.lit("1700000000001"))),
        fx.created_ts(F.lit("soon")),
        fx.parsed_time(F.lit("2024-01-31 01:02:03").cast("timestamp")))
    assert got == (NOW, NOW + 500, *[None] * 6, NOW + 1, None, "2024-01-31 01:02:03")


def test_seconds_between(spark):
    late, early = F.lit("2024-01-01 00:00:10.5"), F.lit("2024-01-01 00:00:00")
    got = one(spark, fx.seconds_between(late.cast("timestamp"), early.cast("timestamp")))[0]
    assert math.isclose(got, 10.5)


def test_empty_to_null_and_lookup(spark):
    got = one(
        spark, fx.empty_to_null(F.lit("")), fx.empty_to_null(F.lit("x")),
        fx.map_lookup({"a": "1"}, F.lit("a"), "z"), fx.map_lookup({"a": "1"}, F.lit("b"), "z"),
        fx.absolute_url("https://s", F.lit("/p")))
    assert got == (None, "x", "1", "z", "https://s/p")
