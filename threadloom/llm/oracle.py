"""DuckDB SQL of the intended results, by query name, where SQL can express them."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _ascii_lower(value: str) -> str:
    return f"translate({value}, '{_UPPER}', '{_LOWER}')"


def _url_models() -> str:
    def sums(source: str, key: str, name: str) -> str:
        return f"SELECT {key} AS {name}, sum(a) AS a, sum(b) AS b FROM {source} GROUP BY 1"

    def contexts(source: str, key: str) -> str:
        return (f"SELECT {key} AS c, sum(a) AS sa, sum(b) AS sb, "
                "sum(CASE WHEN a > 0 THEN 1 ELSE 0 END) AS ka, "
                f"sum(CASE WHEN b > 0 THEN 1 ELSE 0 END) AS kb FROM {source} GROUP BY 1")

    def mixed(side: str) -> str:
        p = "(1.0::DOUBLE / 94)"
        for order, count in (("c1", f"t1.{side}"), ("c2", f"t2.{side}"), ("c3", f"t3.{side}")):
            seen, kinds = f"{order}.s{side}", f"{order}.k{side}"
            p = (f"(CASE WHEN {seen} > 0 THEN ({count}::DOUBLE + {kinds}::DOUBLE * {p}) "
                 f"/ ({seen}::DOUBLE + {kinds}::DOUBLE) ELSE {p} END)")
        return p

    return f"""
WITH u AS (SELECT coalesce(url, '') AS url, count(*) AS n FROM pages GROUP BY 1),
r AS (SELECT url, n, CASE WHEN strpos(url, '://') > 0
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
h AS (SELECT url, n, {_ascii_lower("regexp_extract(rest, '^[^/?#]*')")} AS host,
        regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM r),
rules(verdict, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
        ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
hit AS (SELECT url, arg_max(verdict, length(rh || rp)) AS v,
        arg_max(rh || rp, length(rh || rp)) AS rule
        FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
        GROUP BY 1),
k AS (SELECT h.url, n, host, path, v, rule,
        substr(md5(h.url), 1, 1) IN ('0', '1', '2', '3') AS held
        FROM h LEFT JOIN hit ON h.url = hit.url),
g AS (SELECT url, n, v, held, substr('  ' || clean, i, 3) AS gram FROM (
        SELECT url, n, v, held, regexp_replace(url, '[^!-~]', '~', 'g') AS clean,
        unnest(range(1, length(url) + 1)) AS i FROM k)),
t3 AS (SELECT gram, sum(CASE WHEN v = 'allow' AND NOT held THEN n ELSE 0 END) AS a,
        sum(CASE WHEN v = 'block' AND NOT held THEN n ELSE 0 END) AS b FROM g GROUP BY 1),
t2 AS ({sums("t3", "substr(gram, 2, 2)", "gram")}),
t1 AS ({sums("t2", "substr(gram, 2, 1)", "gram")}),
c3 AS ({contexts("t3", "substr(gram, 1, 2)")}),
c2 AS ({contexts("t2", "substr(gram, 1, 1)")}),
c1 AS ({contexts("t1", "0")}),
ratios AS (SELECT t3.gram, ln({mixed("a")}) - ln({mixed("b")}) AS ratio
        FROM t3 JOIN t2 ON t2.gram = substr(t3.gram, 2, 2)
        JOIN t1 ON t1.gram = substr(t3.gram, 3, 1)
        JOIN c3 ON c3.c = substr(t3.gram, 1, 2) JOIN c2 ON c2.c = substr(t3.gram, 2, 1)
        JOIN c1 ON true),
scores AS (SELECT url, avg(ratio) AS score FROM g JOIN ratios USING (gram) GROUP BY 1),
bins AS (SELECT floor(score * 64)::BIGINT AS bin,
        sum(CASE WHEN v = 'allow' THEN n ELSE 0 END) AS a,
        sum(CASE WHEN v = 'block' THEN n ELSE 0 END) AS b
        FROM k JOIN scores USING (url) WHERE v IS NOT NULL AND held GROUP BY 1),
edges AS (SELECT bin, coalesce(sum(a) OVER below, 0) AS ab, coalesce(sum(b) OVER below, 0) AS bb,
        sum(a) OVER () AS aa, sum(b) OVER () AS ba FROM bins
        WINDOW below AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
edge AS (SELECT coalesce((SELECT bin / 64.0 FROM edges WHERE aa > 0 AND ba > 0
        ORDER BY bb * aa - ab * ba DESC, abs(bin), bin LIMIT 1), 0) AS least)
SELECT page_id, host, path, rule, CASE WHEN v IS NOT NULL THEN v
        WHEN coalesce(score, 0) >= least THEN 'allow' ELSE 'block' END AS verdict
FROM pages JOIN k ON k.url = coalesce(pages.url, '')
LEFT JOIN scores ON scores.url = k.url JOIN edge ON true
"""


_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(
    _ascii_lower("text"))

_BENCHMARK_INDEX = f"""
WITH docs AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
        array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s FROM (
        SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i
        FROM items WHERE len(w) > 0)),
tokens AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
places AS (SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i
        ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS next FROM tokens),
found AS (SELECT doc_id, i, windows.n, item_id
        FROM (SELECT doc_id, i, n, array_to_string(next[1:n], ' ') AS s
              FROM places JOIN (SELECT DISTINCT n FROM windows) ON len(next) >= n) p
        JOIN windows ON windows.n = p.n AND windows.s = p.s),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
        SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
        SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY 1)
SELECT docs.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
        coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
        n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits ON hits.doc_id = docs.doc_id LEFT JOIN named ON named.doc_id = docs.doc_id
"""

_WARC_REVISITS = """
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
        CASE WHEN strlen(h) >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END
        AS record_type,
        CASE WHEN strlen(h) >= 1000 AND last <> page_id THEN last END AS refers_to
FROM (SELECT page_id, h, max(page_id) OVER (PARTITION BY h) AS last
      FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))
"""

_TERMS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format(
    _ascii_lower("text"))

_RANKED_SEARCH = f"""
WITH docs AS (SELECT doc_id, {_TERMS} AS w FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT doc_id, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0),
corpus AS (SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_terms FROM lengths),
tfs AS (SELECT doc_id, term, count(*)::BIGINT AS tf
        FROM (SELECT doc_id, unnest(w) AS term FROM docs) GROUP BY 1, 2),
dfs AS (SELECT term, count(*)::BIGINT AS df FROM tfs GROUP BY 1),
asked AS (SELECT DISTINCT item_id, term FROM (
        SELECT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL)),
scores AS (SELECT item_id, doc_id, sum(
        floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
        * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * all_docs) // all_terms))))
        )::BIGINT AS score
        FROM asked JOIN dfs USING (term) JOIN tfs USING (term) JOIN lengths USING (doc_id), corpus
        GROUP BY 1, 2),
placed AS (SELECT item_id, doc_id, score,
        row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
        FROM scores WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM placed WHERE place <= 50
"""

ORACLE = {
    "op3_url_models": _url_models(),
    "op7_benchmark_index": _BENCHMARK_INDEX,
    "op8_warc_revisits": _WARC_REVISITS,
    "op12_best_position_search": _RANKED_SEARCH,
}
