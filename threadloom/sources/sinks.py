"""Batch sinks: append, JSON files, message topics, table creation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def append(df: DataFrame, fmt: str, **options: str) -> None:
    df.write.format(fmt).mode("append").options(**options).save()


def write_json(df: DataFrame, path: str) -> None:
    """Records as line-delimited JSON files, nulls written out."""
    df.write.option("ignoreNullFields", "false").json(path)


def push_messages(messages: DataFrame, topic: str, fmt: str = "kafka", **options: str) -> None:
    """Append JSON messages (one `value` column, no key) to a topic.

    With fmt="text" they are appended as lines to the folder `topic`. The kafka format needs its
    connector on the classpath.
    """
    target = {"topic": topic} if fmt == "kafka" else {"path": topic}
    append(messages.select("value"), fmt, **target, **options)


def ensure_table(spark: SparkSession, name: str, schema: StructType, fmt: str = "parquet") -> None:
    """Create a table unless there is one."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt}")
