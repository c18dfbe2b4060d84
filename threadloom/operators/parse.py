"""JSON messages to typed records, and records to JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from threadloom.functions.scalars import parsed_time
from threadloom.schema import COMMENT_MESSAGE_KEYS, ENVELOPE, POST_MESSAGE_KEYS, TARGETS

_CORRUPT = "_corrupt_record"


def decode_value(raw: DataFrame) -> DataFrame:
    """Keep only the message body, as text."""
    return raw.select(F.col("value").cast("string").alias("value"))


def parse_envelope(
    messages: DataFrame, schema: StructType = ENVELOPE, author_alias: bool = False
) -> DataFrame:
    """One typed row per message; works on batch and streaming frames.

    A message that is not a JSON object becomes a row of nulls, a bad field becomes null. With
    `author_alias`, a comment's `Author` fills the AuthorName that it lacks.
    """
    if not author_alias:
        return messages.select(F.from_json("value", schema).alias("data")).select("data.*")
    wide = StructType([*schema.fields, StructField("Author", StringType(), True)])
    return (
        messages.select(F.from_json("value", wide).alias("data")).select("data.*")
        .withColumn("AuthorName", F.coalesce("AuthorName", "Author"))
        .drop("Author")
    )


def message_status(messages: DataFrame) -> DataFrame:
    """Messages with a `status` telling what routing makes of them.

    empty: null or blank value; malformed: not one complete JSON object; no_type, unknown_type:
    parsed but routed nowhere; partial: routed with some field nulled; ok: routed whole.
    """
    schema = StructType([*ENVELOPE.fields, StructField(_CORRUPT, StringType(), True)])
    data = F.from_json("value", schema, {"columnNameOfCorruptRecord": _CORRUPT})
    kind, corrupt = F.col("_data.Type"), F.col(f"_data.{_CORRUPT}")
    status = (
        F.when(F.col("value").isNull() | (F.trim("value") == ""), "empty")
        .when(kind.isNull() & corrupt.isNotNull(), "malformed")
        .when(kind.isNull(), "no_type")
        .when(~kind.isin(*TARGETS), "unknown_type")
        .when(corrupt.isNotNull(), "partial")
        .otherwise("ok")
    )
    return messages.withColumn("_data", data).withColumn("status", status).drop("_data")


def parse_with_status(messages: DataFrame, author_alias: bool = False) -> DataFrame:
    """As parse_envelope, with the `status` and the `value` of each message."""
    marked = message_status(messages)
    parsed = F.from_json("value", StructType(
        [*ENVELOPE.fields, StructField("Author", StringType(), True)]))
    records = marked.select(parsed.alias("data"), "status", "value").select(
        "data.*", "status", "value")
    if author_alias:
        records = records.withColumn("AuthorName", F.coalesce("AuthorName", "Author"))
    return records.drop("Author")


def bad_record_counts(messages: DataFrame) -> DataFrame:
    """Messages per status, so that nothing is dropped without a trace."""
    return message_status(messages).groupBy("status").agg(F.count("*").alias("n"))


def enrich(
    records: DataFrame, board: Column, ranking: Column, run_time: Column | None = None
) -> DataFrame:
    """Stamp the run's board path, listing order and time on every record."""
    return records.withColumns({
        "SubredditName": board,
        "SubredditRankingType": ranking,
        "ParsedTime": parsed_time(run_time),
        "IsActive": F.lit(True),
    })


def encode_json(records: DataFrame, *keep: str) -> DataFrame:
    """Records as JSON messages in `value`, with the keys each record type publishes.

    Null fields are written out; a comment's time is a number, a post's is text. A record of any
    other type has no message: its `value` is null, which message_status counts as empty.
    """
    present = set(records.columns)

    def field(name: str) -> Column:
        if name == "Author":
            return F.col("Author" if "Author" in present else "AuthorName").alias("Author")
        return F.col(name)

    def message(keys: list[str], **override: Column) -> Column:
        fields = [override[k].alias(k) if k in override else field(k) for k in keys]
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    comment = message(COMMENT_MESSAGE_KEYS, CreatedAt=F.col("CreatedAt").try_cast("bigint"))
    value = F.when(F.col("Type") == "Post", message(POST_MESSAGE_KEYS)).when(
        F.col("Type") == "Comment", comment)
    return records.select(*keep, value.alias("value"))
