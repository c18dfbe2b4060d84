"""A stored collection of documents that is changed by rewriting the files a change can touch.

Rows stand in Parquet files. A version is a small table with a row per file: its path, its rows, and
for each indexed column the least and the greatest value and a Bloom filter of the values (one bit
of 32,768 each). Conditions are tested against these first, so an update or delete reads only files
that can match, writes only those that do, and takes the others over as they are. A version becomes
the current one by an atomic rename that never replaces another, so of two writers one fails and
nothing is lost. Old files and versions stay for their readers.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from threadloom.operators.documents import find, matches
from threadloom.streaming.committed import hadoop_files

BLOOM_BITS = 32_768  # what Spark's bitmap aggregate holds
_PATH = "_file"


def _bit(value: Column) -> Column:
    return F.pmod(F.xxhash64(value.cast("string")), F.lit(BLOOM_BITS))


class Collection:
    """Documents below `root`, with statistics of the columns `indexed`."""

    def __init__(self, spark: SparkSession, root: str, indexed: tuple[str, ...]):
        self.spark, self.root, self.indexed = spark, root.rstrip("/"), indexed

    # --- versions ---------------------------------------------------------------------------

    def version(self) -> int:
        """The current version; 0 before anything was written."""
        place, files = hadoop_files(self.spark, f"{self.root}/_versions")
        if not files.exists(place):
            return 0
        return max((int(s.getPath().getName()) for s in files.listStatus(place)), default=0)

    def files(self, version: int | None = None) -> DataFrame:
        """A row per file of a version: path, rows, and the statistics of indexed columns."""
        number = self.version() if version is None else version
        if not number:
            raise ValueError(f"nothing is stored in {self.root}")
        return self.spark.read.parquet(f"{self.root}/_versions/{number}")

    def _statistics(self, folder: str, schema: StructType) -> DataFrame:
        # without rows no file is written, and there is no schema to be found
        rows = self.spark.read.schema(schema).parquet(folder).withColumn(_PATH, F.col("_metadata.file_path"))
        per_file = rows.groupBy(_PATH).agg(
            F.count("*").alias("rows"),
            *[f(c).alias(f"{name}_{c}") for c in self.indexed
              for name, f in (("least", F.min), ("greatest", F.max))],
            *[F.bitmap_construct_agg(_bit(F.col(c))).alias(f"bloom_{c}") for c in self.indexed],
            *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in self.indexed])
        return per_file

    def _publish(self, version: int, kept: DataFrame | None, rows: DataFrame) -> int:
        """Make `version` + 1 of files taken over and new ones with `rows`."""
        table = self._statistics(self._write(rows), rows.schema)
        if kept is not None:
            table = kept.unionByName(table)
        draft = f"{self.root}/_drafts/{uuid.uuid4().hex}"
        table.coalesce(1).write.parquet(draft)
        source, files = hadoop_files(self.spark, draft)
        target, _ = hadoop_files(self.spark, f"{self.root}/_versions/{version + 1}")
        files.mkdirs(target.getParent())
        # a rename onto a folder that is there moves into it, which changes nothing of the version
        inside, _ = hadoop_files(self.spark, f"{target.toString()}/{source.getName()}")
        if files.exists(target) or not files.rename(source, target) or files.exists(inside):
            raise RuntimeError(f"version {version + 1} was written by another writer; try again")
        return version + 1

    # --- reading ----------------------------------------------------------------------------

    def _read(self, files: DataFrame) -> DataFrame:
        paths = [r[0] for r in files.select(_PATH).collect()]  # a row per file
        if not paths:  # all rows are gone; the first version's files tell the columns
            return self._read(self.files(1)).limit(0)
        return self.spark.read.parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.files(version))

    def candidates(self, condition: dict[str, Any], version: int | None = None) -> DataFrame:
        """The files that can hold a matching document; all others certainly hold none."""
        found = self.files(version)
        for column, value in condition.items():
            if column not in self.indexed:
                continue
            if value is None:
                found = found.where(F.col(f"nulls_{column}") > 0)
                continue
            value = F.lit(value)
            at = _bit(value).cast("int")
            byte = F.conv(F.hex(F.col(f"bloom_{column}").substr(
                F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            is_set = F.call_function("shiftright", byte, at % 8).bitwiseAND(F.lit(1)) == 1
            found = found.where(value.between(
                F.col(f"least_{column}"), F.col(f"greatest_{column}")) & is_set)
        return found

    def find(self, condition: dict[str, Any]) -> DataFrame:
        """Matching documents, from the files that can hold them."""
        candidates = self.candidates(condition)
        if candidates.isEmpty():
            return self.read().limit(0)
        return find(self._read(candidates), condition)

    # --- writing ----------------------------------------------------------------------------

    def _write(self, rows: DataFrame) -> str:
        folder = f"{self.root}/_data/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return folder

    def insert(self, rows: DataFrame) -> int:
        """Add documents as new files; returns the new version."""
        version = self.version()
        return self._publish(version, self.files(version) if version else None, rows)

    def _rewrite(self, version: int, touched: DataFrame, change) -> dict[str, int]:
        """New version in which `change` went over the rows of the files `touched`."""
        paths = [r[0] for r in touched.select(_PATH).distinct().collect()]
        if paths:
            kept = self.files(version).where(~F.col(_PATH).isin(paths))
            # one file again for each: they were of a size that suits the collection
            rows = change(self.spark.read.parquet(*paths)).repartition(len(paths))
            self._publish(version, kept, rows)
        return {"rewritten": len(paths), "files": self.files(version).count()}

    def _matching(self, condition: dict[str, Any], version: int) -> DataFrame | None:
        candidates = self.candidates(condition, version)
        if candidates.isEmpty():
            return None
        return find(self._read(candidates).withColumn(_PATH, F.col("_metadata.file_path")), condition)

    def update_first(self, condition: dict[str, Any], changes: dict[str, Any], order: str
                     ) -> dict[str, int]:
        """Set `changes` on the first match by the unique column `order`.

        Returns how many documents matched and were modified, each 0 or 1, and how many of the
        files were rewritten.
        """
        version = self.version()
        rows = self._matching(condition, version)
        first = None if rows is None else rows.where(F.col(order).isNotNull()).orderBy(order).select(
            _PATH, order, *[c for c in changes if c in rows.columns and c != order]).first()
        if first is None:
            return {"matched": 0, "modified": 0, "rewritten": 0, "files": self.files(version).count()}
        if all(c in first and first[c] == v for c, v in changes.items()):
            return {"matched": 1, "modified": 0, "rewritten": 0, "files": self.files(version).count()}
        chosen = F.col(order) == F.lit(first[order])

        def change(found: DataFrame) -> DataFrame:
            return found.withColumns({c: F.when(chosen, F.lit(v)).otherwise(F.col(c))
                                      for c, v in changes.items()})

        touched = self.files(version).where(F.col(_PATH) == first[_PATH])
        return {"matched": 1, "modified": 1, **self._rewrite(version, touched, change)}

    def delete(self, condition: dict[str, Any]) -> dict[str, int]:
        """Remove matching documents; returns how many, and how many files were rewritten."""
        version = self.version()
        rows = self._matching(condition, version)
        hits = None if rows is None else rows.groupBy(_PATH).agg(F.count("*").alias("n"))
        counts = hits.collect() if hits is not None else []  # at most a row per file
        if not counts:
            return {"deleted": 0, "rewritten": 0, "files": self.files(version).count()}
        touched = self.files(version).where(F.col(_PATH).isin([r[_PATH] for r in counts]))
        return {"deleted": sum(r["n"] for r in counts), **self._rewrite(
            version, touched, lambda found: found.where(~matches(condition)))}
