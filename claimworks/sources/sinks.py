"""Batch and streaming writes."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import freed_shuffles
from .files import table_exists

EVERY_MINUTE = "60 seconds"


def _start(writer, trigger: str | None, checkpoint: str):
    """``trigger`` None: take what is there, then stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: str | None = EVERY_MINUTE,
    name: str | None = None,
) -> StreamingQuery:
    """Append to a table. New columns are admitted: Delta merges them on write,
    parquet readers merge them with the ``mergeSchema`` option."""
    writer = stream.writeStream.format(fmt).outputMode("append")
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    if name:
        writer = writer.queryName(name)
    return _start(writer, trigger, checkpoint).start(path)


def running_id(spark: SparkSession) -> str | None:
    """The identity of the query whose batch this is: the same after a restart, another in a new checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The same identity from outside the query: its checkpoint holds it."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def each_batch(
    stream: DataFrame,
    apply: Callable[[DataFrame, int, str], None],
    checkpoint: str,
    trigger: str | None = EVERY_MINUTE,
    name: str | None = None,
) -> StreamingQuery:
    """``apply`` gets each batch with its number and the stream's identity."""
    known: list[str] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(running_id(batch.sparkSession) or stream_id(batch.sparkSession, checkpoint))
        with freed_shuffles(batch.sparkSession):
            apply(batch, batch_id, known[0])

    writer = stream.writeStream.outputMode("update").foreachBatch(run)
    if name:
        writer = writer.queryName(name)
    return _start(writer, trigger, checkpoint).start()


def overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").save(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.format(fmt).mode("append")
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    writer.save(path)


def create_if_absent(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> None:
    if not table_exists(spark, path, fmt):
        overwrite(spark.createDataFrame([], schema), path, fmt)


def write_topic(
    messages: DataFrame, *, topic: str | None = None, servers: str | None = None,
    folder: str | None = None,
) -> None:
    """(key, value) rows to a broker topic, or appended to a folder without one."""
    if folder is not None:
        messages.write.mode("append").parquet(folder)
        return
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    )
