"""Tables whose batches appear whole or not at all, for any file format.

A batch writes its rows for every table below `_data`, in folders that only this attempt uses. Its
manifest, the list of those folders, is written last: to a draft that is then renamed into place. A
reader goes by the manifests, so files of an attempt that died, and tables of a batch whose other
tables are not there yet, are never seen. A retried batch whose manifest is there writes nothing.

The rename must be atomic and must not replace a file, as in HDFS and local folders. Object stores
need a committer of their own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "run_id string, batch_id bigint, table string, path string, schema string"


def hadoop_files(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


class CommittedWriter:
    """Writes tables of a batch below `root`; `commit` makes all of them visible at once.

    `run_id` tells the streams that write to one root apart: it comes from the running stream.
    """

    def __init__(self, root: str, run_id: Callable[[DataFrame], str], fmt: str = "parquet"):
        self.root, self.fmt, self.run_id = root.rstrip("/"), fmt, run_id
        self._written: list[dict] = []

    def _manifest(self, run_id: str, batch_id: int) -> str:
        return f"{self.root}/_commits/{run_id}-{batch_id}.json"

    def begin(self, batch: DataFrame, batch_id: int) -> bool:
        """False if the batch is committed already and must not be written again."""
        self._written = []
        place, files = hadoop_files(batch.sparkSession, self._manifest(self.run_id(batch), batch_id))
        return not files.exists(place)

    def __call__(self, rows: DataFrame, table: str, batch_id: int) -> None:
        run_id = self.run_id(rows)
        path = f"{self.root}/_data/{table}/{run_id}-{batch_id}-{uuid.uuid4().hex}"
        rows.write.format(self.fmt).save(path)
        self._written.append({"run_id": run_id, "batch_id": batch_id, "table": table, "path": path,
                              "schema": rows.schema.json()})

    def commit(self, batch: DataFrame, batch_id: int) -> None:
        """Rename the manifest into place; an attempt that finds one there gives way to it."""
        target = self._manifest(self.run_id(batch), batch_id)
        place, files = hadoop_files(batch.sparkSession, target)
        draft, _ = hadoop_files(batch.sparkSession, f"{self.root}/_drafts/{uuid.uuid4().hex}")
        files.mkdirs(place.getParent())
        out = files.create(draft, False)
        try:
            out.write(bytearray("\n".join(map(json.dumps, self._written)).encode()))
        finally:
            out.close()
        if not files.exists(place) and not files.rename(draft, place) and not files.exists(place):
            raise OSError(f"{target} could not be written")
        self._written = []


def committed_batches(spark: SparkSession, root: str) -> DataFrame:
    """A row per committed batch and table, with the folder of its rows."""
    place, files = hadoop_files(spark, f"{root.rstrip('/')}/_commits")
    if not files.exists(place):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(place.toString())


def read_committed(spark: SparkSession, root: str, table: str, fmt: str = "parquet",
                   since: int | None = None) -> DataFrame:
    """Rows of the committed batches of a table, with the run and batch that wrote them.

    `since` leaves out batches up to that one, for a reader that goes on where it stopped. A table
    without a committed batch has no rows and no columns but those two.
    """
    batches = committed_batches(spark, root).where(F.col("table") == table)
    if since is not None:
        batches = batches.where(F.col("batch_id") > since)
    found = batches.select("path", "schema").collect()  # a row per batch, not per file or row
    empty = spark.createDataFrame([], "run_id string, batch_id bigint")
    if not found:
        return empty
    schema = StructType.fromJson(json.loads(found[0]["schema"]))
    rows = spark.read.format(fmt).schema(schema).load([r["path"] for r in found])
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    run = r"^(.*)-([0-9]+)-[0-9a-f]{32}$"
    return rows.select(
        *schema.names, F.regexp_extract(name, run, 1).alias("run_id"),
        F.regexp_extract(name, run, 2).cast("bigint").alias("batch_id"))
