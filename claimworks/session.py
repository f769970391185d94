"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE does the run-time work the jobs rely on: it broadcasts a join side only
# after measuring it, splits skewed join partitions and merges small ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the next step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # The JVM only interprets methods beyond 8000 bytes. Wide cleaning steps
    # fuse into such methods; past the limit Spark splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
HASH_BELOW = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def _with_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def freed_shuffles(spark: SparkSession):
    """Statements run inside leave no shuffle files: a chain holds those of one step, not of all."""
    return _with_conf(spark, FREE_SHUFFLES, "true")


def small_scans(spark: SparkSession):
    """Statements run inside read 32 MB a task: one that deals its rows holds them all until it is done."""
    return _with_conf(spark, "spark.sql.files.maxPartitionBytes", "32MB")


def hashed_joins(spark: SparkSession):
    """Statements run inside join by hash, not by sorting, where AQE has measured every part of a side at 64 MB or less."""
    return _with_conf(spark, HASH_BELOW, "64MB")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, under ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local folder: on a cluster
    the executors would not see it.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="claimworks-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
