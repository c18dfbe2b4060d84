"""Record layouts. Names, types and order are fixed values: they are the wire and table format."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


_RELATED = MapType(StringType(), ArrayType(StringType()))

# The 14 fields of a message.
ENVELOPE = _struct(
    ("Type", StringType()),
    ("Id", StringType()),
    ("AuthorId", StringType()),
    ("AuthorName", StringType()),
    ("SubredditRankingType", StringType()),
    ("Permalink", StringType()),
    ("Comment", StringType()),
    ("CreatedAt", StringType()),
    ("ParentCommentId", StringType()),
    ("ParentPostId", StringType()),
    ("SubredditName", StringType()),
    ("RelatedCommentId", _RELATED),
    ("IsActive", BooleanType()),
    ("ParsedTime", StringType()),
)

# Columns of the two target tables.
_SHARED_COLUMNS = [
    "Id", "AuthorId", "AuthorName", "Permalink", "Comment", "CreatedAt",
    "SubredditName", "SubredditRankingType",
]
POST_COLUMNS = [*_SHARED_COLUMNS, "RelatedCommentId", "IsActive", "ParsedTime"]
COMMENT_COLUMNS = [*_SHARED_COLUMNS, "ParentPostId", "ParentCommentId", "IsActive", "ParsedTime"]

# Record type -> target table, and the target of any other type.
TARGETS = {"Post": "Posts", "Comment": "Comments"}
DEFAULT_TARGET = "Unknown"

# Keys of a published message, by record type. A comment's author goes out under
# `Author`, which the envelope does not have (see parse_envelope's author_alias).
_RUN_KEYS = ["SubredditName", "SubredditRankingType", "ParsedTime", "IsActive"]
POST_MESSAGE_KEYS = [
    "Type", "Id", "AuthorId", "AuthorName", "Permalink", "Comment", "CreatedAt",
    "RelatedCommentId", *_RUN_KEYS,
]
COMMENT_MESSAGE_KEYS = [
    "Type", "Id", "AuthorId", "Author", "Permalink", "Comment", "ParentCommentId",
    "ParentPostId", "CreatedAt", *_RUN_KEYS,
]

# The ledger's five tables.
_AUDIT = (
    ("LastModifiedDate", TimestampType()),
    ("IsActive", BooleanType()),
    ("AddedDate", TimestampNTZType()),
    ("DeletedDate", TimestampNTZType()),
)
LEDGER = {
    "Subreddit": _struct(
        ("SubredditId", LongType()), ("SubredditName", StringType()), *_AUDIT),
    "SubredditSchedule": _struct(
        ("SubredditScheduleId", LongType()), ("SubredditId", LongType()),
        ("LastParsedDate", TimestampType()), ("LastCheckStatus", StringType()), *_AUDIT),
    "SubredditJob": _struct(
        ("SubredditJobId", LongType()), ("SubredditId", LongType()), ("JobTypeId", IntegerType()),
        ("JobStartDate", TimestampNTZType()), ("JobEndDate", TimestampNTZType()),
        ("JobStatus", StringType()), ("TopicId", LongType())),
    "KafkaTopic": _struct(
        ("TopicId", LongType()), ("TopicName", StringType()), *_AUDIT),
    "JobType": _struct(
        ("JobTypeId", IntegerType()), ("JobTypeName", StringType()), *_AUDIT),
}
# The seeded job types; a job is of type 1 until told otherwise.
JOB_TYPES = [(1, "scheduled"), (2, "manual")]
DEFAULT_JOB_TYPE = 1
# Status words. A closed schedule says `failed`, a closed job `fail`.
JOB_STATUSES = ["started", "success", "fail"]
SCHEDULE_STATUSES = ["success", "failed"]
SCHEDULE_RUNNING = "running"
