import json

import pytest
from pyspark.sql import functions as F

from threadloom.operators import parse, route
from threadloom.schema import COMMENT_COLUMNS, ENVELOPE, POST_COLUMNS

POST = {
    "Type": "Post", "Id": "t3_a", "AuthorId": "t2_u", "AuthorName": "u", "Permalink": "/p",
    "Comment": "body", "CreatedAt": "1700000000000", "RelatedCommentId": {"id": ["t1_a"]},
    "SubredditName": "/r/x/new/", "SubredditRankingType": "new",
    "ParsedTime": "2024-01-31 00:00:00", "IsActive": True,
}
COMMENT = {
    "Type": "Comment", "Id": "t1_a", "AuthorId": "t2_v", "Author": "v", "Permalink": "/c",
    "Comment": "re", "ParentCommentId": None, "ParentPostId": "t3_a", "CreatedAt": 1700000000001,
    "SubredditName": "/r/x/new/", "SubredditRankingType": "new",
    "ParsedTime": "2024-01-31 00:00:00", "IsActive": True,
}

# value, fields expected to differ from null, status
CASES = [
    (json.dumps(POST), {**POST, "RelatedCommentId": {"id": ["t1_a"]}}, "ok"),
    (json.dumps(COMMENT),
     {k: v for k, v in {**COMMENT, "CreatedAt": "1700000000001"}.items() if k != "Author"}, "ok"),
    ("{}", {}, "no_type"),
    ("not json", {}, "malformed"),
    (None, {}, "empty"),
    ("", {}, "empty"),
    ("  ", {}, "empty"),
    (json.dumps([POST, POST]), {}, "malformed"),
    ('{"Type":"Post","IsActive":"yes"}', {"Type": "Post"}, "partial"),
    ('{"Type":"post"}', {"Type": "post"}, "unknown_type"),
    ('{"Type":"Post","Id":{"x":1},"CreatedAt":1.50,"RelatedCommentId":{"id":[]}}',
     {"Type": "Post", "Id": '{"x":1}', "CreatedAt": "1.5", "RelatedCommentId": {"id": []}}, "ok"),
    ('{"Type":"Post","Id":"a","Id":"b"}', {"Type": "Post", "Id": "b"}, "ok"),
    ('{"Type":"Post","Id":"a"', {}, "malformed"),
    ('{"type":"Post"}', {}, "no_type"),
    ('{"Type":"Post","RelatedCommentId":["x"]}', {"Type": "Post"}, "partial"),
    ('{"Type":"Post","Id":"\\u00e9"}', {"Type": "Post", "Id": "é"}, "ok"),
]


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame([(value,) for value, _, _ in CASES], "value string")


def test_parse_envelope(messages):
    got = [row.asDict() for row in parse.parse_envelope(messages).collect()]
    want = [{**dict.fromkeys(ENVELOPE.names), **fields} for _, fields, _ in CASES]
    assert got == want


def test_parse_keeps_the_schema(messages):
    assert [(f.name, f.dataType) for f in parse.parse_envelope(messages).schema] == [
        (f.name, f.dataType) for f in ENVELOPE]
    assert parse.parse_envelope(messages, author_alias=True).columns == ENVELOPE.names


def test_author_alias(messages):
    rows = parse.parse_envelope(messages, author_alias=True).filter("Type = 'Comment'").collect()
    assert [row.AuthorName for row in rows] == ["v"]


def test_status(messages):
    assert [row.status for row in parse.message_status(messages).collect()] == [
        status for _, _, status in CASES]
    counts = {row.status: row.n for row in parse.bad_record_counts(messages).collect()}
    assert counts == {"ok": 5, "partial": 2, "unknown_type": 1, "no_type": 2, "malformed": 3,
                      "empty": 3}


def test_split(messages):
    split = route.split(parse.parse_envelope(messages))
    assert split["Post"].columns == POST_COLUMNS
    assert split["Comment"].columns == COMMENT_COLUMNS
    assert split["Post"].count() == 6
    assert split["Comment"].count() == 1


def test_route_target(small):
    kinds = small([("Post",), ("Comment",), ("post",), (None,)], "k string")
    got = [row[0] for row in kinds.select(route.route_target("k")).collect()]
    assert got == ["Posts", "Comments", "Unknown", "Unknown"]
    other = kinds.select(route.route_target("k", {"post": "P"})).collect()
    assert [row[0] for row in other] == ["Unknown", "Unknown", "P", "Unknown"]


def test_encode_matches_published_keys(spark, messages):
    records = parse.parse_envelope(messages, author_alias=True).filter(
        "SubredditName = '/r/x/new/'")
    got = [json.loads(row.value) for row in parse.encode_json(records).collect()]
    assert got == [POST, COMMENT]
    assert [list(m) for m in got] == [list(POST), list(COMMENT)]


def test_decode_value(spark):
    raw = spark.createDataFrame([(bytearray("é".encode()), 7)], "value binary, offset int")
    assert parse.decode_value(raw).collect() == [("é",)]


def test_enrich(spark):
    got = parse.enrich(
        spark.range(1), F.lit("/r/x/"), F.lit("new"), F.lit("2024-01-31 10:00:00").cast("timestamp")
    ).first()
    assert tuple(got) == (0, "/r/x/", "new", "2024-01-31 10:00:00", True)


def test_filter_reaches_the_parse(messages):
    """Only the fields a query uses are parsed out of the message."""
    plan = parse.parse_envelope(messages).filter("Type = 'Post'").select("Id")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Permalink" not in text.split("LogicalRDD")[0]
