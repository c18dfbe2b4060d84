import pytest

from threadloom.operators import threads

RECORD = "Type string, Id string, ParentPostId string, ParentCommentId string, pos int"


def posts_and_comments(small, sizes):
    posts = small([(f"p{i}",) for i in range(len(sizes))], "Id string")
    rows = [(f"p{i}", pos, f"c{i}_{pos}") for i, n in enumerate(sizes) for pos in range(n, 0, -1)]
    return posts, small(rows, "ParentPostId string, pos int, Id string")


def related(df):
    rows = df.collect()
    got = {r.Id: r.RelatedCommentId["id"] for r in rows}
    assert len(got) == len(rows)
    return got


def test_related_ids_in_document_order(small):
    posts, comments = posts_and_comments(small, [3, 0, 12])
    got = related(threads.attach_related_ids(posts, comments))
    assert got == {
        "p0": ["c0_1", "c0_2", "c0_3"],
        "p1": [],
        "p2": [f"c2_{n}" for n in range(1, 13)],
    }


@pytest.mark.parametrize("block", [1, 4, threads.BLOCK])
def test_a_giant_thread_is_one_row(small, block):
    posts, comments = posts_and_comments(small, [3, 4, 450])
    got = related(threads.attach_related_ids(posts, comments, block))
    assert got["p2"] == [f"c2_{n}" for n in range(1, 451)]
    assert threads.related_ids(comments).count() == 457


def test_comments_without_a_place_come_last(small):
    comments = small(
        [("p", None, "x"), ("p", 20, "b"), ("p", None, "w"), ("p", 1, "a"), ("p", 1, "c")],
        "ParentPostId string, pos int, Id string")
    got = related(threads.attach_related_ids(small([("p",)], "Id string"), comments, 10))
    assert got == {"p": ["a", "c", "b", "w", "x"]}


def test_comments_of_unknown_posts_are_left_out(small):
    posts, comments = posts_and_comments(small, [2, 9])
    got = related(threads.attach_related_ids(posts.filter("Id = 'p0'"), comments, 4))
    assert list(got) == ["p0"]


def test_union_fills_missing_keys(small):
    headings = small([("Post", "a", "u")], "Type string, Id string, AuthorName string")
    replies = small([("Comment", "b", "a")], "Type string, Id string, ParentPostId string")
    rows = threads.thread_union(headings, replies.unionAll(replies)).collect()
    assert sorted(tuple(r) for r in rows)[-1] == ("Post", "a", "u", None)
    assert len(rows) == 3


def test_thread_order(small):
    rows = small([
        ("Comment", "c2", "p", "c1", 2), ("Post", "q", None, None, 0), ("Post", "p", None, None, 0),
        ("Comment", "c1", "p", None, 1)], RECORD)
    assert [r.Id for r in threads.thread_order(rows).collect()] == ["p", "c1", "c2", "q"]


def test_parent_links(small):
    schema = RECORD + ", AuthorName string, CreatedAt string, Permalink string"
    rows = small([
        ("Post", "p", None, None, 0, "ann", "1", "/p"),
        ("Comment", "c1", "p", None, 1, "bob", "2", "/c1"),
        ("Comment", "c2", "p", "c1", 2, "cy", "3", "/c2"),
        ("Comment", "c3", "gone", "lost", 1, "di", "4", "/c3")], schema)
    comments = rows.filter("Type = 'Comment'")
    with_post = threads.comment_with_post(comments, rows.filter("Type = 'Post'"))
    assert {(r.Id, r.PostAuthorName) for r in with_post.collect()} == {("c1", "ann"), ("c2", "ann")}
    with_parent = threads.comment_with_parent(comments)
    assert [(r.Id, r.ParentAuthorName) for r in with_parent.collect()] == [("c2", "bob")]


def test_grouping_combines_before_the_shuffle(small):
    posts, comments = posts_and_comments(small, [3])
    plan = threads.attach_related_ids(posts, comments)._jdf.queryExecution().toString()
    assert "partial_collect_list" in plan
