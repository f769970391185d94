"""Streams that land the sources in bronze tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.messages import keyed_texts, parse_envelopes, parse_telematics, route, sorted_messages
from ..operators.changelog import expand, net_changes, resolve
from ..schemas import CAPTURED, IMAGE_METADATA
from ..sources.readers import csv_stream, image_stream, topic_stream
from ..sources.sinks import EVERY_MINUTE, append_stream, each_batch
from .follow import kept
from .tables import BUCKETS, AppendedTable, Before, open_table

ORDER = ["ts_ms", "offset"]


def table_log(changes: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """One table's part of the keyed changes: (keys, op, ts_ms, offset, image text)."""
    return route(changes, name).select(
        *[F.col("key_values")[i].alias(k) for i, k in enumerate(keys)], "op", *ORDER, "image"
    )


def apply_changes(
    batch: DataFrame, batch_id: int, bronze: str, fmt: str = "parquet", tables=CAPTURED, stream: str = "only",
    buckets: int = BUCKETS,
) -> None:
    """One micro-batch of the shared change log into every captured table.

    The batch is parsed once, as far as its keys, and kept in the shared folder while
    the tables take their parts side by side; a row's text is parsed only if it survives
    the reduction to one change per key. The tables are known beforehand, so
    nothing is collected to find them.
    """
    with kept(keyed_texts(batch, tables)) as keyed:
        _apply_keyed(keyed, batch_id, bronze, fmt, tables, stream, buckets)


def apply_messages(
    batch: DataFrame, batch_id: int, bronze: str, quarantine: str, fmt: str = "parquet", tables=CAPTURED,
    stream: str = "only", buckets: int = BUCKETS,
) -> None:
    """The same from the topic's messages; those that cannot be applied are kept with their reason.

    They go to ``<quarantine>/messages``, and the batch's counts to
    ``<quarantine>/counts``, as deliveries of the same stream and batch: a replay
    adds nothing, and kept and quarantined messages are all there are.
    """
    spark = batch.sparkSession
    with kept(sorted_messages(batch, tables)) as messages:
        refused = F.col("reason").isNotNull()
        AppendedTable(spark, f"{quarantine}/messages").add(
            batch_id, messages.where(refused).select("reason", "key", "value", "offset"), stream)
        AppendedTable(spark, f"{quarantine}/counts").add(
            batch_id, messages.agg(F.count("*").alias("messages"), F.count_if(~refused).alias("kept")), stream)
        _apply_keyed(messages.where(~refused), batch_id, bronze, fmt, tables, stream, buckets)


def _apply_keyed(keyed: DataFrame, batch_id: int, bronze: str, fmt: str, tables, stream: str, buckets: int) -> None:
    spark = keyed.sparkSession

    def apply(name: str) -> None:
        schema, keys = tables[name]
        target = open_table(spark, f"{bronze}/{name}", keys, fmt, buckets=buckets)
        net = net_changes(table_log(keyed, name, keys), keys, ORDER)
        # In a table that is not there yet nothing is looked up, and the changes are read once.
        with kept(net) if target.exists() else nullcontext(net) as changes:

            def rows(before: Before) -> DataFrame:
                # Only the buckets of the batch's keys are read, and of them only keys.
                current = before(touching=changes, columns=keys)
                now = changes.select(*keys).limit(0) if current is None else current  # an empty side is planned away
                parsed = resolve(changes, now, keys).withColumn("image", F.from_json("image", schema))
                return expand(parsed, keys, schema.names)

            target.write(batch_id, rows, stream)

    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(apply), name) for name in tables]
    for job in jobs:
        job.result()


def ingest_changes(
    spark: SparkSession, source: dict, bronze: str, checkpoint: str,
    fmt: str = "parquet", trigger: str | None = EVERY_MINUTE, tables=CAPTURED, buckets: int = BUCKETS,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Change log of all captured tables, e.g. source={'pattern': ..., 'servers': ...}.

    ``buckets`` counts for tables that are not there yet: so many that one fits a
    task. Messages that cannot be applied drop out, or go to ``quarantine``.
    """
    topic = topic_stream(spark, **source)
    if quarantine is None:
        return each_batch(
            parse_envelopes(topic), lambda df, n, stream: apply_changes(df, n, bronze, fmt, tables, stream, buckets),
            checkpoint, trigger, "changes")
    return each_batch(
        topic, lambda df, n, stream: apply_messages(df, n, bronze, quarantine, fmt, tables, stream, buckets),
        checkpoint, trigger, "changes")


def ingest_telematics(
    spark: SparkSession, source: dict, bronze: str, checkpoint: str,
    fmt: str = "parquet", trigger: str | None = EVERY_MINUTE,
) -> StreamingQuery:
    rows = parse_telematics(topic_stream(spark, **source))
    return append_stream(rows, f"{bronze}/telematics", checkpoint, fmt, trigger, "telematics")


def ingest_images(
    spark: SparkSession, folder: str, target: str, checkpoint: str, name: str,
    fmt: str = "parquet", trigger: str | None = EVERY_MINUTE, recursive: bool = False,
) -> StreamingQuery:
    """Claim photos and training photos alike."""
    return append_stream(
        image_stream(spark, folder, recursive), target, checkpoint, fmt, trigger, name
    )


def ingest_image_metadata(
    spark: SparkSession, folder: str, target: str, checkpoint: str,
    fmt: str = "parquet", trigger: str | None = EVERY_MINUTE,
) -> StreamingQuery:
    rows = csv_stream(spark, folder, IMAGE_METADATA)
    return append_stream(rows, target, checkpoint, fmt, trigger, "image_metadata")


def ingest_objects(
    spark: SparkSession, landing: str, bronze: str, checkpoints: str,
    fmt: str = "parquet", trigger: str | None = EVERY_MINUTE,
) -> list[StreamingQuery]:
    """The three object streams of one session."""
    return [
        ingest_images(spark, f"{landing}/claims/images", f"{bronze}/claim_images",
                      f"{checkpoints}/claim_images", "claim_images", fmt, trigger),
        ingest_image_metadata(spark, f"{landing}/claims/metadata", f"{bronze}/image_metadata",
                              f"{checkpoints}/image_metadata", fmt, trigger),
        ingest_images(spark, f"{landing}/training_imgs", f"{bronze}/training_images",
                      f"{checkpoints}/training_images", "training_images", fmt, trigger),
    ]

