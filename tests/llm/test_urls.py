import math
import re
from collections import Counter, defaultdict

import __spark_entry__ as driver
import pytest
from check import duck, duck_bag, spark_bag
from conftest import DATA
from pyspark.sql import functions as F

from threadloom.llm import urls

PAGES = "page_id bigint, url string, html string"


def test_registered_query_matches_sql(spark):
    sf = f"{DATA}/sf0.01"
    name = "op3_url_models"
    assert spark_bag(driver.queries()[name](spark, sf)) == duck_bag(
        duck(sf), driver.oracle_sql()[name])


def split(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest, re.S)[0]
    path = re.match(r"[^?#]*", rest[len(host):], re.S)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    fits = [r for r in urls.RULES if (host == r[1] or host.endswith("." + r[1]))
            and path.startswith(r[2])]
    return max(fits, key=lambda r: len(r[1] + r[2]), default=None)


CASES = [
    (1, "http://A.Example.COM/en/x?y#z", "p"), (2, "https://www.example.com/en/", None),
    (3, "http://example.com/fr/1", ""), (4, "http://xexample.com/en/1", ""),
    (5, "https://a.net/es/1", ""), (6, "https://a.net/fr", ""), (7, "http://net/fr/", ""),
    (8, None, "x"), (9, "", "x"), (10, "no scheme.com/en/", ""), (11, "a://b://c.com/", ""),
    (12, "http://com", ""), (13, "http://ÄÉ.com/\n?x", ""), (14, "x://?q.com/", ""),
    (None, "http://q.org/" + "long/" * 20_000, ""), (2, "https://www.example.com/en/", None),
    (15, "http://a.org#/en/", ""), (16, "http://B.ORG/en", ""),
]


def test_hosts_paths_rules_and_edge_rows(spark, small):
    pages = small(CASES, PAGES).withColumns({"host": F.lit(1), "score": F.lit("x")})
    rows = urls.judge(pages).collect()
    got = Counter((r.page_id, r.url, r.host, r.path, r.rule) for r in rows)
    want = Counter()
    for page, url, _ in CASES:
        host, path = split(url)
        hit = rule(host, path)
        want[page, url, host, path, hit and hit[1] + hit[2]] += 1
    assert got == want
    for r in rows:
        hit = rule(r.host, r.path)
        assert r.verdict == hit[0] if hit else r.verdict in ("allow", "block")
    assert urls.judge(small([], PAGES)).collect() == []


def test_without_labelled_urls_the_threshold_is_zero(small):
    rows = urls.judge(small([(1, "http://a.org/x", ""), (2, None, "")], PAGES)).collect()
    assert {r.verdict for r in rows} == {"allow"} and {r.score for r in rows} == {0.0}


def brute_ratio(counts, gram):
    p = 1 / urls.SYMBOLS
    for n in (1, 2, 3):
        after = {g: c for g, c in counts[n].items() if g[:-1] == gram[3 - n:2]}
        if after:
            total, kinds = sum(after.values()), len(after)
            p = (counts[n].get(gram[3 - n:], 0) + kinds * p) / (total + kinds)
    return math.log(p)


def test_models_match_a_direct_count(small):
    rows = [("http://good.org/a", 3, 3, 0), ("http://bad.org/b", 2, 0, 2), ("zq é", 1, 0, 0)]
    got = {r.gram: r.ratio for r in urls.model(
        small(rows, "url string, n int, acc int, rej int")).collect()}
    counts = {side: defaultdict(Counter) for side in (2, 3)}
    seen = set()
    for row in rows:
        padded = "  " + re.sub("[^!-~]", "~", row[0])
        for i in range(2, len(padded)):
            seen.add(padded[i - 2:i + 1])
            for side in (2, 3):
                if row[side]:
                    for n in (1, 2, 3):
                        counts[side][n][padded[i - n + 1:i + 1]] += row[side]
    assert set(got) == seen
    for gram, ratio in got.items():
        assert ratio == pytest.approx(brute_ratio(counts[2], gram) - brute_ratio(counts[3], gram))


def test_threshold_separates_held_out_urls(small):
    held = small([(s / 10, 1, s >= 5) for s in range(10)], "score double, n int, accepted boolean")
    edge = urls.threshold(held)
    assert 0.4 < edge <= 0.5
    assert urls.threshold(held.where("accepted")) == 0.0


def test_no_python_in_the_plan(spark, small):
    plan = urls.judge(small(CASES, PAGES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
