"""Listing selection against a plain loop over pages, the way a crawl goes through them."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import listing

NOW = 1_700_000_000_000
SCHEMA = ("board string, page_no bigint, pos int, fullname string, created_ms bigint, "
          "promoted string")


def make(seed, boards=4, pages=6, size=3):
    """Boards with pages of up to `size` elements, some blank."""
    rng = random.Random(seed)
    rows = []
    for board in range(boards):
        for page in range(pages):
            for pos in range(rng.choice([size, size, size, rng.randint(0, size)])):
                rows.append((
                    f"b{board}", page, pos, f"t3_{board}_{page}_{pos}",
                    NOW - rng.choice([1, 5, 9, 20]) * 1000 - board * 500,
                    rng.choice(["true", "false", None])))
    return rows


def reached(rows, board, size):
    """Pages a crawl of one board gets to."""
    pages, page = set(), 0
    while True:
        found = [r for r in rows if r[0] == board and r[1] == page]
        if not found:
            return pages
        pages.add(page)
        if len(found) < size:
            return pages
        page += 1


def crawl(rows, board, take_all=False, limit=None, period=None, size=None):
    """Rows a loop over one board's elements in order would take."""
    taken = []
    pages = size and reached(rows, board, size)
    for row in sorted(r for r in ((x[0], x[1], x[2], *x[3:5], x[5] or "") for x in rows)
                      if r[0] == board and (size is None or r[1] in pages)):
        if row[5] == "true":
            continue
        if not take_all:
            if limit:
                if len(taken) >= limit:
                    break
            elif (NOW - row[4]) / 1000 > period:
                break
        taken.append(row[3])
    return set(taken)


def names(df):
    got = [r.fullname for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def want(rows, **mode):
    boards = {row[0] for row in rows}
    return set().union(*[crawl(rows, board, **mode) for board in boards])


@pytest.mark.parametrize("seed", range(3))
def test_modes(small, seed):
    rows = make(seed)
    df = small(rows, SCHEMA).repartition(4, F.xxhash64("fullname"))
    for size in (None, 3):
        def select(**mode):
            return names(listing.select_listing(df, NOW, page_size=size, **mode))

        assert select(take_all=True, count_limit=1, period=1) == want(
            rows, take_all=True, size=size)
        assert select(count_limit=4, period=1) == want(rows, limit=4, size=size)
        assert select(period=10) == want(rows, period=10, size=size)
        assert select() == want(rows, period=86_400, size=size)
    assert names(listing.first_n_organic(listing.organic(df), 2000)) == want(rows, take_all=True)


def test_a_short_first_page_ends_the_listing(small):
    rows = [("b", 0, 0, "a", NOW, None), ("b", 1, 0, "c", NOW, None)]
    rows += [("d", 1, 0, "e", NOW, None)]  # page 0 is missing
    assert names(listing.select_listing(small(rows, SCHEMA), NOW, take_all=True)) == {"a"}


@pytest.mark.parametrize("n", [1, 2, 9, 30])
def test_first_n_over_blocks_of_pages(small, monkeypatch, n):
    rows = make(7, pages=12)
    monkeypatch.setattr(listing, "_BLOCK", 2)
    df = small(rows, SCHEMA).repartition(4)
    assert names(listing.first_n(df, n)) == want(rows, limit=n)


def test_places_beyond_twenty_bits_and_without_number(small):
    far = 1 << 20
    rows = [("b", 0, far + 5, "a", NOW, None), ("b", 0, 2**31 - 2, "c", NOW, None),
            ("b", 0, None, "last", NOW, None), ("b", 1, 0, "d", NOW - 20_000, None),
            ("b", 1 << 40, 0, "e", NOW, None)]
    df = small(rows, SCHEMA)
    assert names(listing.first_n_organic(df, 2)) == {"a", "c"}
    assert names(listing.first_n_organic(df, 3)) == {"a", "c", "last"}
    assert names(listing.take_while_recent(df, NOW, 10)) == {"a", "c", "last"}
    ranks = [r.rank for r in df.select(listing.listing_rank().alias("rank")).collect()]
    assert ranks == sorted(ranks) and len(set(ranks)) == 5


@pytest.mark.parametrize("size", [None, 3])
@pytest.mark.parametrize("seed", range(3))
def test_modes_per_board(small, monkeypatch, seed, size):
    rows = make(seed)
    plan = small([
        ("b0", "all", None, None), ("b1", "count", 4, 1.0), ("b2", "period", None, 10.0),
        ("b9", "all", None, None)],
        "board string, mode string, count_limit int, period double")
    expected = (crawl(rows, "b0", take_all=True, size=size) | crawl(rows, "b1", limit=4, size=size)
                | crawl(rows, "b2", period=10, size=size))
    df = small(rows, SCHEMA)
    assert names(listing.select_by_plan(df, plan, NOW, size)) == expected
    no_count = plan.filter("mode <> 'count'")
    assert names(listing.select_by_plan(df, no_count, NOW, size)) == (
        expected - crawl(rows, "b1", take_all=True))
    if seed == 0:
        monkeypatch.setattr(listing, "MAX_BROADCAST_BYTES", 0)
        assert names(listing.select_by_plan(df, plan, NOW, size)) == expected


def test_take_while_stops_at_the_first_old_row(small):
    rows = [("b", 0, 0, "new", NOW, "false"), ("b", 0, 1, "ad", 0, "true"),
            ("b", 0, 2, "old", NOW - 20_000, "false"), ("b", 1, 0, "newer", NOW, "false")]
    df = small(rows, SCHEMA)
    assert names(listing.take_while_recent(df, NOW, 10)) == {"new"}
    assert names(listing.recent(df, NOW, 10)) == {"new", "newer"}


def test_promoted(small):
    rows = [("b", 0, i, str(i), NOW, flag) for i, flag in enumerate(["true", "false", "", None])]
    out = listing.organic(small(rows, SCHEMA))
    assert names(out) == {"1", "2", "3"}
    assert "promoted" not in out.columns


@pytest.mark.parametrize("seed", range(4))
def test_reached_pages(small, seed):
    rows = make(seed, pages=5)
    expected, pages_seen = set(), set()
    for board in {r[0] for r in rows}:
        page = 0
        while True:
            found = [r[3] for r in rows if r[0] == board and r[1] == page]
            expected |= set(found)
            if found:
                pages_seen.add((board, page))
            if len(found) < 3:
                break
            page += 1
    df = small(rows, SCHEMA)
    assert names(listing.reached_listing(df, page_size=3)) == expected
    pages = listing.listing_pages(df, page_size=3).collect()
    assert {(p.board, p.page_no) for p in pages if p.is_reached} == pages_seen
    assert {(p.board, p.page_no) for p in pages} == {(r[0], r[1]) for r in rows}


def test_page_stats(small):
    rows = [("b", 0, pos, f"x{pos}", NOW, "true") for pos in range(25)]
    rows += [("b", 1, pos, f"y{pos}", NOW, None) for pos in range(24)]
    pages = {p.page_no: p for p in listing.listing_pages(small(rows, SCHEMA)).collect()}
    assert (pages[0].n_elements, pages[0].cursor, pages[0].is_last) == (25, "x24", False)
    assert (pages[1].n_elements, pages[1].cursor, pages[1].is_last) == (24, "y23", True)
    assert set(pages) == {0, 1} and pages[1].is_reached


def test_counts(small):
    rows = make(1)
    counts = listing.listing_counts(listing.organic(small(rows, SCHEMA))).collect()
    assert {c.board: c.n_posts for c in counts} == {
        b: len(crawl(rows, b, take_all=True)) for b in {r[0] for r in rows}}
