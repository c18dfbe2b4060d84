"""Throughput of the main paths; prints one JSON line per measurement.

Environment: BENCH_SF_DIR, BENCH_CPUS, MESSAGES (messages made by repeating the conversations).
Input and output go to a new scratch folder under the system's temporary one.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from threadloom.operators import extract, parse, route  # noqa: E402
from threadloom.plans import views  # noqa: E402
from threadloom.session import build_session  # noqa: E402
from threadloom.streaming import router  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MESSAGES = int(os.environ.get("MESSAGES", "1000000"))
FILES = 64


def report(what: str, rows: int, start: float, **more) -> None:
    spent = time.perf_counter() - start
    print(json.dumps({"what": what, "rows": rows, "sec": round(spent, 2),
                      "rows_per_sec": round(rows / spent), **more}), flush=True)


def write_messages(spark, path: str) -> int:
    """Conversations as message lines, repeated, in FILES text files."""
    records = views.envelope(spark, SF_DIR)
    times = max(1, MESSAGES // records.count())
    many = records.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("_copy")
    parse.encode_json(many).repartition(FILES).write.text(path)
    return records.count() * times


def batch_split(spark, source: str, out: str, persist: bool) -> None:
    records = parse.parse_envelope(spark.read.text(source))
    if persist:
        records = records.persist()
    for kind, rows in route.split(records).items():
        rows.write.parquet(f"{out}/{kind}")
    if persist:
        records.unpersist()


def stream_split(spark, source: str, out: str, files: int) -> None:
    options = router.StreamOptions(
        name=f"files{files}", topic=source, checkpoint=f"{out}/checkpoint", source_format="text",
        max_per_trigger=files, trigger={"availableNow": True})
    router.start_job(spark, options, router.batch_folder_writer(f"{out}/tables")).awaitTermination()


def main() -> None:
    spark = build_session(
        "measure", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="12g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="measure-")
    source = f"{scratch}/messages"
    start = time.perf_counter()
    rows = write_messages(spark, source)
    report("encode messages", rows, start)
    batch_split(spark, source, f"{scratch}/warmup", True)

    for persist in (True, False):
        start = time.perf_counter()
        batch_split(spark, source, f"{scratch}/batch-{persist}", persist)
        report("parse and split, batch", rows, start, persist=persist)
    for files in (4, 16, FILES):
        start = time.perf_counter()
        stream_split(spark, source, f"{scratch}/stream-{files}", files)
        report("parse and split, stream", rows, start, files_per_batch=files, files=FILES)

    pages = f"{scratch}/pages"
    views.thread_page_html(views.envelope(spark, SF_DIR)).repartition(64).write.parquet(pages)
    pages = spark.read.parquet(pages)
    many = pages.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).repartition(64)
    n, chars = many.select(F.count("*"), F.sum(F.length("html"))).first()
    for size in ("1000", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        start = time.perf_counter()
        extract.extract_thread(many, ("url", "part")).write.format("noop").mode("overwrite").save()
        report("extract threads", n, start, arrow_rows=int(size), megabytes=round(chars / 1e6))
    spark.stop()


if __name__ == "__main__":
    main()
