"""spark-submit job: messages of a topic to one table per record type, until stopped."""

from __future__ import annotations

import argparse

from threadloom.session import build_session
from threadloom.streaming.router import (
    StreamOptions,
    TableWriter,
    batch_folder_writer,
    committed_writer,
    mongo_sink,
    start_job,
)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("-n", "--name", default="threadloom", help="application name")
    parser.add_argument("-kt", "--kafka_topic", required=True, help="topic, or folder of text files")
    parser.add_argument("-ks", "--kafka_server", help="required for kafka")
    parser.add_argument("-sf", "--source_format", default="kafka", choices=["kafka", "text"])
    parser.add_argument("-so", "--starting_offsets", default="latest")
    parser.add_argument("-mx", "--max_per_trigger", type=int, help="offsets or files per batch")
    parser.add_argument("-mu", "--mongo_url", help="write to a document database at this url")
    parser.add_argument("-md", "--mongo_database", help="its database")
    parser.add_argument("-od", "--output_dir", help="write retry-safe files below this folder")
    parser.add_argument("-cb", "--committed", action="store_true",
                        help="with --output_dir: batches appear whole, by a manifest written last")
    parser.add_argument("-ow", "--once_within",
                        help='drop repeats of an Id within this time, such as "10 minutes"')
    parser.add_argument("-of", "--output_format", default="parquet")
    parser.add_argument("-cp", "--checkpoint_path", required=True)
    parser.add_argument("-fcp", "--fresh_checkpoint", action="store_true",
                        help="start from a fresh checkpoint below the path; nothing is deleted")
    parser.add_argument("-aa", "--author_alias", action="store_true",
                        help="take a comment's author from its `Author` key")
    parser.add_argument("-on", "--once", action="store_true", help="stop when caught up")
    parser.add_argument("-v", "--preview", action="store_true", help="print rows of each batch")
    parser.add_argument("-ps", "--print_schema", action="store_true", help="print the record schema")
    parser.add_argument("-ut", "--unrouted_table",
                        help="table for messages that no table takes, with their status")
    args = parser.parse_args(argv)
    if args.source_format == "kafka" and not args.kafka_server:
        parser.error("--kafka_server is required for kafka")
    if bool(args.mongo_url) == bool(args.output_dir):
        parser.error("give either --mongo_url or --output_dir")
    if args.committed and not args.output_dir:
        parser.error("--committed needs --output_dir")
    return args


def to_options(args: argparse.Namespace) -> StreamOptions:
    return StreamOptions(
        name=args.name,
        topic=args.kafka_topic,
        checkpoint=args.checkpoint_path,
        source_format=args.source_format,
        servers=args.kafka_server,
        starting_offsets=args.starting_offsets,
        max_per_trigger=args.max_per_trigger,
        sink_options=mongo_sink(args.mongo_url, args.mongo_database) if args.mongo_url else {},
        trigger={"availableNow": True} if args.once else {},
        author_alias=args.author_alias,
        fresh_checkpoint=args.fresh_checkpoint,
        preview=args.preview,
        print_schema=args.print_schema,
        unrouted_table=args.unrouted_table,
        once_within=args.once_within,
    )


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = build_session(args.name)
    writer: TableWriter | None = None
    if args.output_dir:
        make = committed_writer if args.committed else batch_folder_writer
        writer = make(args.output_dir, args.output_format)
    start_job(spark, to_options(args), writer).awaitTermination()


if __name__ == "__main__":
    main()
