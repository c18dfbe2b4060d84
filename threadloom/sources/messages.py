"""Message stream source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadloom.operators.parse import decode_value


def read_messages(
    spark: SparkSession,
    topic: str,
    fmt: str = "kafka",
    servers: str | None = None,
    starting_offsets: str = "latest",
    max_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Unbounded frame of message bodies, one `value` text column.

    `starting_offsets` counts on the first start only, later ones go on from the checkpoint. The
    kafka format needs its connector on the classpath; fmt="text" reads lines of files that
    arrive in the folder `topic`. `max_per_trigger` bounds a micro-batch: offsets for kafka, files
    for text.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        reader = (
            reader.option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
        )
        limit, source = "maxOffsetsPerTrigger", None
    else:
        limit, source = "maxFilesPerTrigger", topic
    if max_per_trigger:
        reader = reader.option(limit, max_per_trigger)
    return decode_value(reader.load(source) if source else reader.load())
