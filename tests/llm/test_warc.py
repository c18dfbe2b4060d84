import hashlib
from collections import Counter

import __spark_entry__ as driver
from check import duck, duck_bag, spark_bag
from conftest import DATA
from pyspark.sql import functions as F

from threadloom.llm import warc

PAGES = "page_id bigint, url string, html string"
BIG = "é" * 600
ROWS = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, BIG), (3, None, BIG),
    (None, "http://a/n", BIG), (4, "http://a/4", "small"), (5, "http://a/5", "small"),
    (6, "http://a/6", None), (7, "", ""), (8, "x\r\ny", "a\r\n\r\nb\r\n\r\n" * 200),
    (9, "http://a/9", "WARC/1.1\r\nContent-Length: 7\r\n\r\n" * 50), (10, "http://a/z", "z" * 500_000),
]


def want(rows):
    full = [(i, (h or "").encode()) for i, _, h in rows]
    last = {}
    for i, h in full:
        if i is not None:
            last[h] = max(i, last.get(h, i))
    out = Counter()
    for i, h in full:
        again = len(h) >= 1000 and last.get(h, i) != i
        out[i, len(h), hashlib.sha1(h).hexdigest(), "revisit" if again else "response",
            last[h] if again else None] += 1
    return out


def got(df):
    return Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in df.collect())


def archived(spark, pages, folder, **options):
    warc.write_archives(pages, folder, **options)
    return warc.resolve_revisits(warc.read_archives(spark, folder))


def test_registered_query_matches_sql(spark):
    sf, name = f"{DATA}/sf0.01", "op8_warc_revisits"
    assert spark_bag(driver.queries()[name](spark, sf)) == duck_bag(
        duck(sf), driver.oracle_sql()[name])


def test_edge_rows(spark, small, tmp_path):
    pages = small(ROWS, PAGES).withColumns({"payload": F.lit(1), "original": F.lit("x")})
    assert got(archived(spark, pages, str(tmp_path / "a"))) == want(ROWS)
    assert got(archived(spark, small([], PAGES), str(tmp_path / "b"))) == Counter()


def test_payloads_come_back_whole_and_once(spark, small, tmp_path):
    pages = small(ROWS, PAGES)
    warc.write_archives(pages, str(tmp_path / "a"), records_per_file=2)
    records = warc.read_archives(spark, str(tmp_path / "a")).collect()
    full = Counter(bytes(r.payload) for r in records if r.record_type == "response")
    assert full[BIG.encode()] == 2  # the page of the greatest id is there twice
    assert set(full) == {(h or "").encode() for _, _, h in ROWS}
    ids = {r.record_id for r in records}
    assert all(r.refers_to_id in ids for r in records if r.record_type == "revisit")
    assert {r.url for r in records if r.page_id == 8} == {"x%0D%0Ay"}


def test_files_are_warc(small, tmp_path):
    warc.write_archives(small(ROWS[:3], PAGES).coalesce(1), str(tmp_path / "a"),
                        date=F.lit("2020-01-02 03:04:05").cast("timestamp"))
    (file,) = (tmp_path / "a").glob("part-*")
    data = file.read_bytes()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")
    heads = [h for h, _ in warc.parse(data)]
    assert Counter(h["WARC-Type"] for h in heads) == {"response": 1, "revisit": 2}
    for h in heads:
        assert h["WARC-Date"] == "2020-01-02T03:04:05Z"
        assert ("WARC-Profile" in h) == ("WARC-Refers-To" in h) == (h["WARC-Type"] == "revisit")


def test_many_repeated_payloads_are_joined_by_shuffle(spark, small):
    pages = small(ROWS, PAGES)
    a = warc.resolve(pages, max_broadcast=0)
    b = warc.resolve(pages)
    key = ["page_id", "payload_digest", "original"]
    assert Counter(a.select(key).collect()) == Counter(b.select(key).collect())
    assert "BroadcastExchange" not in a._jdf.queryExecution().sparkPlan().toString()
