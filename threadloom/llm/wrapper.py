"""Main text of pages by wrappers induced per host.

Every page's layout tree gives, for each node, its place (the element names on the way to it) and
the digest of its text. Spark counts the pages of a host per place and digest, without a cap; a text
that many of the host's pages share at one place belongs to the template, and all else is content.
Menus, adverts, forms, comments and the like by name, and what is mostly links over the host's pages
outside main content, are no content. Trees are compared by simple tree matching in `matching`.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.dom import Node, Page
from threadloom.llm.shared import cut
from threadloom.llm.urls import url_host

# A text is template if so many pages of a host, and this share of them, have it at one place.
MIN_PAGES, SHARE = 3, 0.25
LINK_SHARE = 0.6
# Counts a task holds before it passes them on, wrappers a worker holds, and bytes of wrappers that
# may be broadcast.
HELD_COUNTS, HELD_HOSTS, MAX_BROADCAST_BYTES = 100_000, 5_000, 64 << 20
# Element names, and words of classes, ids and roles, of parts that are no content.
OUT_NAMES = frozenset(
    "head nav header footer aside form button select menu dialog search fieldset option".split())
OUT_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar footer sidebar aside "
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations "
    "comment comments commentlist disqus reply replies respond responses widget toolbar pagination "
    "pager search complementary contentinfo tooltip hidden".split())
MAIN = frozenset(("article", "main", "r:main", "r:article"))
# Elements that class words never judge; what may stand before an out word in one class or id, and
# what after it tells of a state, not of the part itself.
WHOLE = frozenset(("#", "html", "body", "main", "article"))
BEFORE = frozenset("site page main top bottom global primary secondary post entry".split())
STATES = frozenset(
    "fixed open opened closed on off active enabled disabled visible sticky layout xs sm md lg xl"
    .split())


def word_is_out(word: str, out_words: frozenset | set) -> bool:
    """A class, id or role that is an out word, begins with one, or has one after a usual prefix."""
    parts = [p for p in re.split(r"[-_:]+", word) if p]
    if word in out_words:
        return True
    if len(parts) < 2 or parts[-1] in STATES:
        return False
    return parts[0] in out_words or (
        len(parts) == 2 and parts[0] in BEFORE and parts[1] in out_words)


def name_is_out(label: str, within_main: bool) -> bool:
    name = label.split(" ", 1)[0]
    return name in OUT_NAMES and not (within_main and name == "header")


def label_is_out(label: str, within_main: bool) -> bool:
    if name_is_out(label, within_main):
        return True
    name, *words = label.split(" ")
    if name in WHOLE or MAIN & set(words):
        return False
    words = [w[2:] for w in words]
    if any(part in ("main", "content") for w in words for part in re.split(r"[-_:]+", w)
           ) and not any(w in OUT_WORDS for w in words):
        return False
    out_words = OUT_WORDS - ({"header"} if within_main else set())
    return any(word_is_out(w, out_words) for w in words)


def _label(node) -> str:
    return node.label if isinstance(node, Node) else node[0]


def _kids(node) -> list:
    return node.kids if isinstance(node, Node) else node[5]


def matching(a, b) -> int:
    """Simple tree matching: the greatest number of node pairs, roots and order kept."""
    if _label(a) != _label(b):
        return 0
    return 1 + _best(_kids(a), _kids(b))[-1][-1]


def _best(left: list, right: list) -> list[list[int]]:
    """Best number of pairs for every two beginnings of the lists of children."""
    rows = [[0] * (len(right) + 1)]
    for a in left:
        above, row = rows[-1], [0]
        for j, b in enumerate(right):
            pair = above[j] + matching(a, b) if _label(a) == _label(b) else 0
            row.append(max(above[j + 1], row[j], pair))
        rows.append(row)
    return rows


def align(left: list, right: list) -> list[tuple[int | None, int | None]]:
    """Children of two like nodes paired by the best matching, in order; the rest stand alone."""
    names = [_label(k) for k in left]
    if names == [_label(k) for k in right] and len(set(names)) == len(names):
        return [(i, i) for i in range(len(names))]  # what the matching would find
    rows = _best(left, right)
    i, j, pairs = len(left), len(right), []
    while i and j:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
            pairs.append((i, None))
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
            pairs.append((None, j))
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    pairs += [(k, None) for k in range(i - 1, -1, -1)]
    pairs += [(None, k) for k in range(j - 1, -1, -1)]
    return pairs[::-1]


# --- places ----------------------------------------------------------------------------------

class Part:
    """A node of a page with what its host is asked about it."""

    __slots__ = ("node", "up", "text_place", "link_place", "digest", "main", "is_main", "heading")

    def __init__(self, node: Node, up: Part | None, nth: int):
        name, *words = node.label.split(" ")
        self.node, self.up = node, up
        self.is_main = name in MAIN or bool(MAIN & set(words))
        self.main = self.is_main or (up is not None and up.main)
        self.heading = re.fullmatch(r"h\d", name) is not None
        # classes of pages as a whole often name the page
        alike = name if name in WHOLE else node.label
        self.text_place = xxhash.xxh64_hexdigest(f"{up.text_place if up else ''}/{name}")
        self.link_place = xxhash.xxh64_hexdigest(f"{up.link_place if up else ''}/{alike} {nth}")
        self.digest = (hashlib.md5("\n".join(node.texts).encode()).hexdigest()[:16]
                       if node.texts else None)


def parts_of(page: Page) -> list[Part]:
    """All nodes, those above before those below."""
    parts = [Part(page.root, None, 0)]
    for part in parts:
        seen: dict[str, int] = defaultdict(int)
        for kid in part.node.kids:
            parts.append(Part(kid, part, seen[kid.label]))
            seen[kid.label] += 1
    return parts


def wrapper_of(template: list) -> tuple[dict[str, bool], set[tuple[str, str]]]:
    """Places that are menus or not, and (place, digest) of the host's template texts."""
    menus, texts = {}, set()
    for place, _, digest, chars, linked in template[5]:
        if digest:
            texts.add((place, digest))
        else:
            menus[place] = linked >= LINK_SHARE * chars
    return menus, texts


def extract(page: Page, wrapper: tuple | None) -> str:
    """The page's content blocks, one a line; main content alone if there is any.

    If a page's main content, titles aside, is all template, the page is a copy and keeps it; a page
    that would end up empty is judged by element names alone.
    """
    menus, texts = wrapper or ({}, set())
    parts = parts_of(page)
    # nodes above all main content
    above: dict[int, int] = defaultdict(int)
    mains = 0
    for part in parts:
        if part.is_main and not (part.up and part.up.main):
            mains += 1
            up = part.up
            while up is not None:
                above[id(up.node)] += 1
                up = up.up
    outs: dict[int, bool] = {}
    named: dict[int, bool] = {}
    by_node: dict[int, Part] = {}
    for part in parts:
        node, up = part.node, part.up
        key, within = id(node), up is not None and up.main
        by_node[key] = part
        named[key] = (up is not None and named[id(up.node)]) or name_is_out(node.label, within)
        holds_all = mains > 0 and above.get(key, 0) == mains
        outs[key] = (up is not None and outs[id(up.node)]) or (
            name_is_out(node.label, within) if holds_all else label_is_out(node.label, within))

    def is_menu(part: Part) -> bool:
        node = part.node
        if part.main or part.heading or not node.chars:
            return False
        own = node.linked >= LINK_SHARE * node.chars
        return own and menus.get(part.link_place, own)

    def is_template(part: Part) -> bool:
        return (part.text_place, part.digest) in texts

    content = [p for p in parts if p.digest and not outs[id(p.node)] and not is_menu(p)]
    for some in ([p for p in content if p.main], content):
        # a title of main content stays in any case
        titles = [p for p in some if p.heading and p.main]
        own = [p for p in some if not is_template(p)]
        if all(p.heading and p.main for p in own):
            own = some
        chosen = {id(p.node) for p in (*own, *titles)}
        if chosen:
            return "\n".join(t for t, node in page.blocks if id(node) in chosen)
    return "\n".join(t for t, node in page.blocks if not named[id(node)])


# --- Spark ------------------------------------------------------------------------------------

COUNT_SCHEMA = "host string, place string, digest string, pages bigint, chars bigint, linked bigint"


def _batch(held: dict[tuple, list[int]]) -> pa.RecordBatch:
    rows = [(*key, *sums) for key, sums in held.items()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    types = [pa.string()] * 3 + [pa.int64()] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
        ["host", "place", "digest", "pages", "chars", "linked"])


def place_counts(pages: DataFrame) -> DataFrame:
    """Pages of (host, html) per host, place and digest; digest "" holds the sums of links.

    Place "" counts the host's pages.
    """
    def run(batches):
        held: dict[tuple, list[int]] = defaultdict(lambda: [0, 0, 0])
        for batch in batches:
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html"),
                                  strict=True):
                found = {(host, "", ""): (0, 0)}
                for part in parts_of(Page(html.as_py())):
                    if part.digest:
                        found[host, part.text_place, part.digest] = (0, 0)
                        if not part.main:
                            found[host, part.link_place, ""] = (part.node.chars, part.node.linked)
                for key, (chars, linked) in found.items():
                    sums = held[key]
                    sums[0] += 1
                    sums[1] += chars
                    sums[2] += linked
                if len(held) > HELD_COUNTS:
                    yield _batch(held)
                    held.clear()
        yield _batch(held)

    return pages.select("host", "html").mapInArrow(run, COUNT_SCHEMA).groupBy(
        "host", "place", "digest").agg(
        *[F.sum(c).alias(c) for c in ("pages", "chars", "linked")])


def host_templates(pages: DataFrame) -> DataFrame:
    """(host, template) of (host, html), every page counted.

    A template is ["#", pages, "", 0, 0, places], a place [place, pages, digest, chars, linked]. As
    each is on a share of the host's pages, there are not many more of them than a page has nodes.
    """
    counts = cut(place_counts(pages).where(
        (F.col("place") == "") | (F.col("pages") >= F.when(F.col("digest") == "", 2)
                                  .otherwise(MIN_PAGES))))
    total = counts.where("place = ''").select("host", F.col("pages").alias("total"))
    places = counts.where("place <> ''").join(total, "host").where(
        F.col("pages") >= SHARE * F.col("total"))
    entry = F.concat(
        F.lit('["'), "place", F.lit('",'), F.col("pages").cast("string"), F.lit(',"'), "digest",
        F.lit('",'), F.col("chars").cast("string"), F.lit(","), F.col("linked").cast("string"),
        F.lit("]"))
    return places.groupBy("host").agg(
        F.first("total").alias("total"),
        F.array_join(F.array_sort(F.collect_list(entry)), ",").alias("places")).select(
        "host", F.concat(F.lit('["#",'), F.col("total").cast("string"), F.lit(',"",0,0,['),
                         "places", F.lit("]]")).alias("template"))


def main_text(pages: DataFrame, max_broadcast: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """`pages` (url, html, any others) with `text` and `n_chars`, its code points.

    A null or empty page, and one without content, gives an empty text. Pages with a null or
    host-less url share the host "". Columns named host, text or n_chars are replaced.
    """
    kept = [c for c in pages.columns if c not in ("host", "text", "n_chars", "template", "html")]
    hosted = pages.select(
        *kept, "html", F.coalesce(url_host(F.col("url")), F.lit("")).alias("host"))
    templates = cut(host_templates(hosted))
    size = templates.agg(F.sum(F.octet_length("template") + F.octet_length("host") + 64)).first()[0]
    if (size or 0) <= max_broadcast:
        templates = F.broadcast(templates)

    def run(batches):
        wrappers: dict[str, tuple | None] = {}
        for batch in batches:
            out = []
            for host, html, template in zip(
                    batch.column("host").to_pylist(), batch.column("html"),
                    batch.column("template"), strict=True):
                if host not in wrappers:
                    if len(wrappers) > HELD_HOSTS:
                        wrappers.clear()
                    known = template.as_py()
                    wrappers[host] = wrapper_of(json.loads(known)) if known else None
                out.append(extract(Page(html.as_py()), wrappers[host]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(out, pa.string()),
                 pa.array([len(t) for t in out], pa.int64())], [*kept, "text", "n_chars"])

    fields = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields if f.name in kept)
    return hosted.join(templates, "host", "left").select(
        *kept, "host", "html", "template").mapInArrow(run, f"{fields}, text string, n_chars bigint")
