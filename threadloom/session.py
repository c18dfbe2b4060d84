"""Session helpers: settings, and reliable checkpoints for small reused results."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job of this package is written for.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with this package's settings; `conf` overrides them.

    Keyword names use `__` for the dots of a Spark key:
    `build_session("a", spark__sql__shuffle__partitions="8")`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in {**RUNTIME_CONF, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a private one only in local mode.

    On a cluster `spark.checkpoint.dir` must name storage that all executors see, because a
    checkpoint has to outlive the executor that wrote it.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="threadloom-checkpoint-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute `df` once and cut its lineage with a reliable checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
