"""spark-submit job: fetched listing and thread pages to messages, recorded in the ledger.

Listing pages have board (name), page_no, html; thread pages have url, html. Boards are those of
the listing pages.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.scalars import RANKING_PATHS, board_path
from threadloom.operators.extract import extract_listing
from threadloom.operators.ledger import resolve_mode
from threadloom.plans.publish import publish_messages
from threadloom.plans.runs import Ledger, run_logged
from threadloom.session import build_session
from threadloom.sources.sinks import push_messages
from threadloom.sources.tables import read_pages


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("-lp", "--listing_pages", required=True)
    parser.add_argument("-tp", "--thread_pages", required=True)
    parser.add_argument("-bu", "--base_url", required=True, help="site that links are relative to")
    parser.add_argument("-db", "--ledger", default="ledger", help="database of the ledger tables")
    parser.add_argument("-t", "--type", default="new", choices=list(RANKING_PATHS))
    parser.add_argument("-a", "--all", action="store_true", help="take whole boards")
    parser.add_argument("-l", "--limit", type=int, help="first posts to take per board")
    parser.add_argument("-p", "--period", type=float,
                        help="seconds to look back; default: since the last run")
    parser.add_argument("-dn", "--direct_name", action="store_true",
                        help="board names are full paths already")
    parser.add_argument("-et", "--execution_type", default="manual")
    parser.add_argument("-kt", "--kafka_topic", required=True, help="topic, or folder for text")
    parser.add_argument("-ks", "--kafka_server", help="required for kafka")
    parser.add_argument("-kf", "--sink_format", default="kafka", choices=["kafka", "text"])
    parser.add_argument("-ld", "--listing_rows", help="folder to store the extracted listing in, "
                        "so that its pages are read once; a run makes a new folder below it")
    parser.add_argument("-wm", "--watermark", default="end", choices=["start", "end"],
                        help="date a successful run leaves behind; with start, posts made during "
                        "the run are left to the next one")
    args = parser.parse_args(argv)
    if args.sink_format == "kafka" and not args.kafka_server:
        parser.error("--kafka_server is required for kafka")
    return args


def run_plan(runs: DataFrame, args: argparse.Namespace) -> DataFrame:
    """One row per board: how much to take and under which path."""
    name = F.col("SubredditName")
    path = name if args.direct_name else board_path(name, F.lit(args.type))
    plan = runs.select(
        name.alias("board"),
        path.alias("path"),
        F.lit(args.type).alias("ranking"),
        F.lit(args.all).alias("take_all"),
        F.lit(args.limit).cast("int").alias("count_limit"),
        F.lit(args.period).cast("double").alias("period"),
        "LastParsedDate",
    )
    return resolve_mode(plan, F.current_timestamp())


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = build_session("publish_pages")
    listing = read_pages(spark, args.listing_pages)
    threads = read_pages(spark, args.thread_pages)
    store = Ledger(spark, args.ledger)
    store.deploy()

    def work(runs: DataFrame) -> None:
        now = spark.sql("SELECT unix_millis(current_timestamp())").first()[0]
        rows = listing
        if args.listing_rows:
            folder = f"{args.listing_rows}/{uuid.uuid4().hex}"
            extract_listing(listing).write.parquet(folder)
            rows = spark.read.parquet(folder)
        messages = publish_messages(rows, threads, run_plan(runs, args), now, args.base_url)
        options = {"kafka.bootstrap.servers": args.kafka_server} if args.sink_format == "kafka" else {}
        push_messages(messages, args.kafka_topic, args.sink_format, **options)

    names = listing.select(F.col("board").alias("SubredditName"))
    run_logged(store, names, args.kafka_topic, work, args.execution_type, args.watermark)


if __name__ == "__main__":
    main()
