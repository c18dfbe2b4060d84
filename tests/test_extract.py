"""Page extraction on hand-made pages and on generated thread trees."""

import random
import re
from html import unescape as html_unescape
from html.entities import html5
from html.parser import HTMLParser

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadloom.functions.html import ThreadReader
from threadloom.functions.markup import unescape
from threadloom.operators import extract

HEADING = (
    '<div class="thing link" data-fullname="t3_p" data-timestamp="1700000000000" '
    'data-author="ann" data-author-fullname="t2_a"><p class="title"><a href="{link}">T</a></p>'
    "{body}</div>")


def comment(name, body='<div class="md"><p>text {n}</p></div>', inside="", author="bob",
            time='<time class="live-timestamp" datetime="2023-11-14T22:13:20+00:00">x</time>'):
    who = f' data-author="{author}" data-author-fullname="t2_{author}"' if author else ""
    return (f'<div class="thing comment" data-type="comment" data-fullname="{name}"{who} '
            f'data-permalink="/c/{name}">{time}{body.replace("{n}", name)}'
            f'<div class="child">{inside}</div></div>')


def page(*parts, link="/r/x/p", body='<div class="md"><p>post</p></div>'):
    return ("<html><body>" + HEADING.format(link=link, body=body) + '<div class="commentarea">'
            + "".join(parts) + "</div></body></html>")


def read(spark, html, **options):
    pages = spark.createDataFrame([("u", html)], "url string, html string")
    return [r.asDict() for r in extract.extract_thread(pages, **options).orderBy("pos").collect()]


def test_heading_and_comments(spark):
    post, c1, c2, c3 = read(spark, page(
        comment("t1_a", inside=comment("t1_b")), comment("t1_c", author=None)))
    assert post == {
        "url": "u", "pos": 0, "Type": "Post", "Id": "t3_p", "AuthorId": "t2_a", "AuthorName": "ann",
        "Author": None, "Permalink": "/r/x/p", "Comment": "post", "ParentCommentId": None,
        "ParentPostId": None, "CreatedAt": "1700000000000",
        "RelatedCommentId": {"id": ["t1_a", "t1_b", "t1_c"]}}
    assert (c1["Id"], c1["Author"], c1["AuthorId"], c1["Comment"], c1["CreatedAt"]) == (
        "t1_a", "bob", "t2_bob", "text t1_a", "1700000000000")
    assert [c["ParentCommentId"] for c in (c1, c2, c3)] == [None, "t1_a", None]
    assert {c["ParentPostId"] for c in (c1, c2, c3)} == {"t3_p"}
    assert (c3["Author"], c3["AuthorId"], c3["RelatedCommentId"]) == (None, None, None)


def test_no_comments_and_outside_link(spark):
    [post] = read(spark, page(link="https://else.where/?a=1&amp;b=2"))
    assert post["Permalink"] == "https://else.where/?a=1&b=2"
    assert post["RelatedCommentId"] == {"id": []}


def test_missing_bodies_take_the_next_one_inside(spark):
    html = page(
        comment("t1_a", body="", time="", inside=comment("t1_b", body="", inside=comment("t1_c"))),
        body="")
    assert [r["Comment"] for r in read(spark, html)] == ["text t1_c"] * 4
    assert [r["CreatedAt"] for r in read(spark, html)][1:] == ["1700000000000"] * 3
    own = read(spark, html, own_text_only=True)
    assert [r["Comment"] for r in own] == [None, None, None, "text t1_c"]
    assert [r["CreatedAt"] for r in own][1] is None


def test_post_takes_first_comment_text_only_when_nested_in_a_thing(spark):
    """The first `.md` inside any `.thing` counts, and comments are things too."""
    html = page(comment("t1_a"), body="").replace('<div class="commentarea">', "<div>")
    assert read(spark, html)[0]["Comment"] == "text t1_a"


def test_text_nodes_are_stripped_and_joined(spark):
    body = ('<div class="md"> <p>one <b>two</b> <!-- note -->three<br>four &amp; five<img src=x>'
            "<script>var a;</script><style>p{}</style></p>\n<p> six </p></div>")
    assert read(spark, page(body=body))[0]["Comment"] == "onetwothreefour & fivesix"


def test_unclosed_and_stray_tags(spark):
    html = page(comment("t1_a", body='<div class="md"><p>a<p>b</i></div>'), comment("t1_b"))
    assert [(r["Id"], r["Comment"], r["ParentCommentId"]) for r in read(spark, html)[1:]] == [
        ("t1_a", "ab", None), ("t1_b", "text t1_b", None)]


def test_page_without_thread(spark):
    assert read(spark, "<html><p>nothing here</p></html>") == []
    assert read(spark, None) == []
    assert read(spark, "") == []


LISTING = """<html><body><div class="menu"><div data-other="x"></div></div>
<div class="thing" data-fullname="t3_1" data-timestamp="1700000000000" data-permalink="/p/1"
  data-promoted="false"><p>&lt;div data-fullname="no"&gt;</p></div>
<!-- <div data-fullname="t3_hidden"></div> -->
<div data-fullname="t3_2" data-timestamp="" data-permalink='/p/2?a=1&amp;b' data-promoted=true>
<div data-fullname="" data-promoted></div></div>
<span data-fullname="t3_span"></span>
<script>var x = '<div data-fullname="t3_script">';</script></body></html>"""


def test_listing(spark):
    pages = spark.createDataFrame(
        [("b", 0, LISTING), ("b", 1, "<html>blank</html>"), ("b", 2, None)],
        "board string, page_no bigint, html string")
    found = extract.extract_listing_pages(pages).orderBy("page_no").collect()
    assert [(p.n_elements, p.cursor) for p in found] == [(3, None), (0, None), (0, None)]
    rows = extract.extract_listing(pages).orderBy("pos").collect()
    assert [(r.board, r.page_no, r.pos, r.fullname, r.created_ms, r.permalink, r.promoted)
            for r in rows] == [
        ("b", 0, 0, "t3_1", 1700000000000, "/p/1", "false"),
        ("b", 0, 1, "t3_2", None, "/p/2?a=1&b", "true"),
        ("b", 0, 2, None, None, None, None)]


def test_listing_is_read_without_python(spark):
    pages = spark.createDataFrame([("b", 0, LISTING)], "board string, page_no bigint, html string")
    plan = extract.extract_listing(pages)._jdf.queryExecution().executedPlan().toString()
    # by name of the operators, as a literal may hold a text such as "LeftArrow;"
    assert not re.search(r"MapIn(Arrow|Pandas)|(Arrow|Batch)EvalPython|[pP]ythonUDF", plan)


def test_references_are_decoded(spark):
    texts = ["a", "&amp;&lt;&gt;&quot;&eacute;", "&#233;&#xE9;&#x1F600;", "&nope; & &", "&amp;amp;",
             "&#0;&#xD800;&#x110000;&#99999999999;", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.u for r in df.select("i", unescape(F.col("t")).alias("u")).orderBy("i").collect()]
    assert got == ["a", "&<>\"é", "éé\U0001f600", "&nope; & &", "&amp;", "\ufffd" * 4, "", None]


def test_references_are_decoded_as_by_the_standard_reader(spark):
    rng = random.Random(5)
    pieces = ["&", "#", "x", ";", "amp", "apos", "nbsp", "notin", "not", "copy", "CounterClockwise",
              "146", "0", "128", "159", "1F600", "12", "fffe", "d", " ", "lt", "gt", "Aacute", "é",
              *rng.sample(sorted(html5), 60)]
    texts = ["&apos;", "&nbsp", "&#146;", "&notit;", "&ampx", "&#xfdd0;&#11;&#127;&#13;", "&#", "&#x;",
             "&#00000000000065;", *["&" + "".join(rng.choices(pieces, k=rng.randint(1, 5)))
                                    for _ in range(600)]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.u for r in df.select("i", unescape(F.col("t")).alias("u")).collect()}
    assert got == {i: html_unescape(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("n", [600, 5_000, 60_000])
def test_tags_of_many_attributes_give_their_row(spark, n):
    many = " ".join(f'a{i}="{i}>"' for i in range(n))
    tags = [f"<div {many} data-fullname=x{i}>" for i in range(2)]
    pages = spark.createDataFrame([("b", 0, "".join(tags))], "board string, page_no bigint, html string")
    assert [(r.pos, r.fullname) for r in extract.extract_listing(pages).orderBy("pos").collect()] == [
        (0, "x0"), (1, "x1")]


def test_parts_are_combined_in_one_reading_of_the_pages(spark):
    pages = spark.createDataFrame([("u", 0, page()), ("u", 1, page())],
                                  "url string, part int, html string")
    records = extract.combine_parts(extract.extract_thread(pages, ("url", "part")), ("url",), "part")
    assert "MapInArrow" not in records._jdf.queryExecution().executedPlan().toString()
    assert [r.Type for r in records.filter("Type = 'Post'").collect()] == ["Post"]


def test_broken_markup_does_not_exhaust_the_stack(spark):
    texts = ["<div " + "=" * 50_000, "<div " + "a=b " * 5_000 + ">", "<" * 20_000,
             "<div data-fullname='" + "x" * 100_000 + "'>", "<!--" * 5_000]
    pages = spark.createDataFrame([("b", i, t) for i, t in enumerate(texts)],
                                  "board string, page_no bigint, html string")
    rows = extract.extract_listing(pages).collect()
    assert [(r.page_no, len(r.fullname)) for r in rows] == [(3, 100_000)]


def test_only_needed_columns_reach_python(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([("u", "<p>", "x")], "url string, html string, junk string").write.parquet(path)
    plan = extract.extract_thread(spark.read.parquet(path))._jdf.queryExecution().toString()
    assert "ReadSchema: struct<url:string,html:string>" in plan


def test_title(spark):
    pages = spark.createDataFrame(
        [("<TITLE lang=x>a\nb</TITLE><title>c</title>",), ("<p>",)], "html string")
    assert [r.title for r in extract.page_title(pages).collect()] == ["a\nb", None]


# --- generated threads: each comment is (has body, has time, children) -----------------------

trees = st.recursive(
    st.builds(lambda body, time: (body, time, []), st.booleans(), st.booleans()),
    lambda kids: st.builds(
        lambda body, time, children: (body, time, children),
        st.booleans(), st.booleans(), st.lists(kids, max_size=3)),
    max_leaves=12)


def render(tree, name):
    body, time, children = tree
    return comment(
        name,
        body='<div class="md"><p>text {n}</p></div>' if body else "",
        time=f'<time class="live-timestamp" datetime="at {name}"></time>' if time else "",
        inside="".join(render(child, f"{name}.{i}") for i, child in enumerate(children)))


def expected(tree, name, parent):
    """Records in document order, and the first text and time at or below the node."""
    body, time, children = tree
    text = f"text {name}" if body else None
    at = f"at {name}" if time else None
    below = []
    for i, child in enumerate(children):
        records, child_text, child_at = expected(child, f"{name}.{i}", name)
        below += records
        text, at = text or child_text, at or child_at
    return [(name, parent, text, at), *below], text, at


@given(st.lists(trees, max_size=4), st.booleans())
@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
def test_generated_threads(forest, post_body):
    html = page(*[render(t, str(i)) for i, t in enumerate(forest)],
                body='<div class="md">post</div>' if post_body else "")
    reader = ThreadReader().read(html)
    records, first_text = [], None
    for i, tree in enumerate(forest):
        found, text, _ = expected(tree, str(i), None)
        records += found
        first_text = first_text or text
    got = [(c["values"]["data-fullname"], c["parent"],
            "".join(c["texts"]) if "texts" in c else None, c.get("time")) for c in reader.comments]
    assert got == records
    text = "".join(reader.heading_texts) if reader.heading_texts is not None else None
    assert text == ("post" if post_body else first_text)


class StandardReader(HTMLParser):
    """Listing elements by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "div":
            values = {name: value or None for name, value in reversed(attrs)}
            if "data-fullname" in values:
                self.found.append(values)


names = st.sampled_from(["data-fullname", "Data-Promoted", "class", "x-1", "data-timestamp"])
plain = st.text(alphabet="abc19/:_-.", min_size=1, max_size=6)
quoted = st.text(alphabet="ab <>/='&;", max_size=8)
attributes = st.one_of(
    names,
    st.builds("{}={}".format, names, plain.filter(lambda v: not v.endswith("/"))),
    st.builds('{} = "{}"'.format, names, quoted),
    st.builds("{}='{}'".format, names, quoted.map(lambda v: v.replace("'", "&quot;"))),
)
tags = st.builds(
    lambda tag, parts, end: f"<{' '.join([tag, *parts])}{end}>",
    st.sampled_from(["div", "DIV", "p", "divider", "a"]), st.lists(attributes, max_size=4),
    st.sampled_from(["", " ", " /"]))
markup = st.lists(st.one_of(
    tags, st.sampled_from([
        "</div>", "</p >", "text & more", "a < b", "<!-- <div data-fullname=c> -->", "<!doctype x>",
        "<script>'<div data-fullname=s>'</script>", "<STYLE a='>'><div data-fullname=t></style>"]),
), max_size=8).map("".join)


@given(st.lists(markup, min_size=30, max_size=60))
@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
def test_tags_are_read_as_the_standard_parser_does(spark, texts):
    pages = spark.createDataFrame([("b", i, t) for i, t in enumerate(texts)],
                                  "board string, page_no bigint, html string")
    rows = {r.page_no: r.rows for r in extract.extract_listing_pages(pages).collect()}
    for i, text in enumerate(texts):
        standard = StandardReader()
        standard.feed(text)
        standard.close()
        names = ("data-fullname", "data-timestamp", "data-promoted")
        assert [(e.fullname, e.timestamp, e.promoted) for e in rows[i]] == [
            tuple(found.get(n) for n in names) for found in standard.found], text


@given(st.text(alphabet="<>/!-=&\"' adivmthng[]?;#x0", max_size=60))
@settings(max_examples=400, deadline=None)
def test_any_text_can_be_read(text):
    ThreadReader().read(text)
    ThreadReader().read(page() + text)
