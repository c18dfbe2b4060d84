"""Streaming job: one message stream split into one table per record type."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from threadloom.operators.parse import parse_envelope, parse_with_status
from threadloom.operators.route import split
from threadloom.schema import DEFAULT_TARGET, TARGETS
from threadloom.sources.messages import read_messages
from threadloom.streaming.committed import CommittedWriter

# Local property under which Spark tells the running streaming query's id, which is kept in the
# checkpoint: the same after a restart, another one for a new checkpoint.
_QUERY_ID = "sql.streaming.queryId"

TableWriter = Callable[[DataFrame, str, int], None]


@dataclass(frozen=True)
class StreamOptions:
    """Parameters of the job."""

    name: str
    topic: str
    checkpoint: str
    source_format: str = "kafka"
    servers: str | None = None
    starting_offsets: str = "latest"
    max_per_trigger: int | None = None
    source_options: dict[str, str] = field(default_factory=dict)
    sink_format: str = "mongodb"
    sink_options: dict[str, str] = field(default_factory=dict)
    # Option that names the table: spark.mongodb.collection, or a folder's `path`.
    table_option: str = "spark.mongodb.collection"
    table_prefix: str = ""
    targets: dict[str, str] = field(default_factory=lambda: dict(TARGETS))
    trigger: dict = field(default_factory=dict)
    author_alias: bool = False
    fresh_checkpoint: bool = False
    preview: bool = False
    print_schema: bool = False
    audit: bool = False
    # Each Id once, if its repeats' times (CreatedAt) are within so much of each other.
    once_within: str | None = None
    # Table for the messages that no target takes, with their status; None leaves them out.
    unrouted_table: str | None = None


def mongo_sink(url: str, database: str) -> dict[str, str]:
    """Sink options of a document database (its connector must be on the classpath)."""
    return {"spark.mongodb.connection.uri": url, "spark.mongodb.database": database}


def _run_id(rows: DataFrame) -> str:
    run_id = rows.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
    if not run_id:
        raise RuntimeError("no streaming query is running this batch")
    return run_id


def append_writer(options: StreamOptions) -> TableWriter:
    """Plain appends: at least once, a retried batch may repeat rows.

    With `audit`, rows carry the run and batch that wrote them.
    """

    def write(rows: DataFrame, table: str, batch_id: int) -> None:
        if options.audit:
            rows = rows.withColumns({
                "run_id": F.lit(_run_id(rows)), "batch_id": F.lit(batch_id).cast("bigint")})
        (
            rows.write.format(options.sink_format).mode("append")
            .options(**options.sink_options)
            .option(options.table_option, options.table_prefix + table)
            .save()
        )

    return write


def batch_folder_writer(root: str, fmt: str = "parquet") -> TableWriter:
    """Files under root/table/run_id=.../batch_id=...; a retried batch replaces its own folder.

    Batch ids restart at 0 with a new checkpoint, so the run id is part of the folder: a new run
    never replaces rows of an older one.
    """

    def write(rows: DataFrame, table: str, batch_id: int) -> None:
        path = f"{root}/{table}/run_id={_run_id(rows)}/batch_id={batch_id}"
        rows.write.format(fmt).mode("overwrite").save(path)

    return write


def committed_writer(root: str, fmt: str = "parquet") -> CommittedWriter:
    """Files of any format whose batches appear in all tables at once, and once."""
    return CommittedWriter(root, _run_id, fmt)


def route_batch(
    write: TableWriter, targets: dict[str, str] | None = None, preview: bool = False,
    unrouted_table: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """foreachBatch callback: each record type to its table.

    With `unrouted_table` the batch has `status` and `value` (see parse_with_status), and every
    message that no record type takes is written there, so the tables add up to the input.
    The parsed batch is kept for the writes, so the source is read and parsed once per batch. It
    may spill to disk, and is rebuilt from the batch's offsets if an executor is lost.
    A CommittedWriter is told when all tables are written.
    """
    committed = write if isinstance(write, CommittedWriter) else None
    tables = TARGETS if targets is None else targets

    def run(batch: DataFrame, batch_id: int) -> None:
        if committed and not committed.begin(batch, batch_id):
            return
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for kind, rows in split(batch).items():
                write(rows, tables.get(kind, DEFAULT_TARGET), batch_id)
            if unrouted_table:
                taken = F.coalesce(F.col("Type").isin(*split(batch)), F.lit(False))
                write(batch.filter(~taken).select("status", "value"), unrouted_table, batch_id)
            if committed:
                committed.commit(batch, batch_id)
            if preview:
                batch.show()
        finally:
            batch.unpersist()

    return run


def once(records: DataFrame, within: str) -> DataFrame:
    """Streaming records without repeats of an Id; those without an Id or a time pass through.

    The state holds the Ids of the time span `within`, by CreatedAt in milliseconds, and no more. A
    record later than that behind the newest one is dropped and counted by `late_records`.
    """
    at = F.timestamp_millis(F.col("CreatedAt").try_cast("bigint"))
    named = F.col("Id").isNotNull() & F.col("CreatedAt").try_cast("bigint").isNotNull()
    first = records.filter(named).withColumn("_at", at).withWatermark(
        "_at", within).dropDuplicatesWithinWatermark(["Id"]).drop("_at")
    return first.unionByName(records.filter(~named))


def late_records(query: StreamingQuery) -> int:
    """Records that the query dropped as too late, over the batches that it still remembers."""
    return sum(state["numRowsDroppedByWatermark"]
               for progress in query.recentProgress for state in progress["stateOperators"])


def checkpoint_path(options: StreamOptions) -> str:
    """The checkpoint to use. A fresh one is a new folder below it; nothing is deleted."""
    if options.fresh_checkpoint:
        return f"{options.checkpoint}/{uuid.uuid4().hex}"
    return options.checkpoint


def start_routing(
    records: DataFrame, options: StreamOptions, write: TableWriter | None = None
) -> StreamingQuery:
    """Start the split of typed streaming records; the caller awaits the query."""
    if options.print_schema:
        records.printSchema()
    callback = route_batch(
        write or append_writer(options), options.targets, options.preview, options.unrouted_table)
    stream = (
        records.writeStream.queryName(options.name)
        .foreachBatch(callback)
        .outputMode("append")
        .option("checkpointLocation", checkpoint_path(options))
    )
    if options.trigger:
        stream = stream.trigger(**options.trigger)
    return stream.start()


def start_job(
    spark: SparkSession, options: StreamOptions, write: TableWriter | None = None
) -> StreamingQuery:
    """Messages of a topic, parsed and split into tables."""
    messages = read_messages(
        spark, options.topic, options.source_format, options.servers,
        options.starting_offsets, options.max_per_trigger, **options.source_options)
    parse = parse_with_status if options.unrouted_table else parse_envelope
    records = parse(messages, author_alias=options.author_alias)
    if options.once_within:
        records = once(records, options.once_within)
    return start_routing(records, options, write)
