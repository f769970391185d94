"""Streams that clean bronze rows and upsert them into silver tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import casts
from ..operators.changelog import DELETE, UPSERT
from ..operators.dedupe import keep_one
from ..plans import silver
from ..schemas import BINARY_FILE, CAPTURED, IMAGE_METADATA, TELEMATICS
from ..sources.readers import table_stream
from ..sources.sinks import EVERY_MINUTE, each_batch
from .sums import RunningSums
from .tables import Before, open_table

# (batch, the table before it, its running sums if it keeps any)
Rule = Callable[[DataFrame, Before, RunningSums | None], DataFrame]


@dataclass(frozen=True)
class SilverTable:
    """What one silver stream reads, how it cleans it and the key it upserts by."""

    name: str
    keys: Sequence[str]
    schema: T.StructType
    rule: Rule
    from_changes: bool = False  # source is a change-fed bronze table
    layout: dict = field(default_factory=dict)  # what rows are partitioned by
    averaged: tuple[Sequence[str], Sequence[str]] | None = None  # (by, columns) of the running sums
    copies: bool = False  # whether its source sends rows again


def _plain(rule: Callable[[DataFrame], DataFrame]) -> Rule:
    return lambda batch, before, sums: rule(batch)


def _telematics(batch: DataFrame, before: Before, sums: RunningSums | None) -> DataFrame:
    if sums is None:
        return silver.clean_telematics(batch, before())
    return silver.clean_telematics(batch, means=sums.averages)


SILVER_TABLES = (
    SilverTable("policy", ["policy_no"], CAPTURED["policy"][0], _plain(silver.clean_policy), True),
    SilverTable("claim", ["claim_no"], CAPTURED["claim"][0], _plain(silver.clean_claim), True),
    SilverTable("customer", ["customer_id"], CAPTURED["customer"][0],
                _plain(silver.clean_customer), True),
    SilverTable("claim_images", ["path"], BINARY_FILE, _plain(silver.clean_claim_images)),
    SilverTable("image_metadata", ["image_name"], IMAGE_METADATA,
                _plain(silver.clean_image_metadata)),
    SilverTable("training_images", ["path"], BINARY_FILE, _plain(silver.clean_training_images)),
    # Readings come in about the order of their time: a batch touches a few days.
    SilverTable("telematics", ["chassis_no", "event_timestamp"], TELEMATICS, _telematics,
                layout={"day": "event_timestamp"}, averaged=(["chassis_no"], ["speed", "latitude", "longitude"]), copies=True),
)


def silver_rows(
    table: SilverTable, batch: DataFrame, before: Before, propagate_deletes: bool = False,
    sums: RunningSums | None = None,
) -> DataFrame:
    """A micro-batch as (op, silver row).

    A batch may hold several bronze batches, so a change-fed table first keeps
    the last change of each key. Deletes stay in bronze unless asked for.
    """
    if not table.from_changes:
        return table.rule(batch, before, sums).select(F.lit(UPSERT).alias("op"), "*")
    if not propagate_deletes:
        batch = batch.filter(F.col("op") == UPSERT)
    last = keep_one(batch.drop("bucket"), table.keys, ["batch"], last=True).drop("batch")
    sets = table.rule(last.filter(F.col("op") == UPSERT).drop("op"), before, sums)
    rows = sets.select(F.lit(UPSERT).alias("op"), "*")
    if not propagate_deletes:
        return rows
    gone = last.filter(F.col("op") == DELETE)
    cast = {T.IntegerType(): casts.lenient_int}
    typed = [cast.get(sets.schema[k].dataType, F.col)(k).alias(k) for k in table.keys]
    return rows.unionByName(gone.select("op", *typed), allowMissingColumns=True)


def upsert_batch(
    batch: DataFrame, batch_id: int, table: SilverTable, silver_root: str,
    fmt: str = "parquet", propagate_deletes: bool = False, stream: str = "only",
) -> None:
    target = open_silver(batch.sparkSession, table, silver_root, fmt)
    sums = sums_of(batch.sparkSession, table, silver_root, fmt)
    if sums is not None:
        sums.follow()  # nothing to do, unless the last batch broke off between the two
    target.write(batch_id, lambda before: silver_rows(table, batch, before, propagate_deletes, sums), stream)
    if sums is not None:
        sums.follow()


def open_silver(spark: SparkSession, table: SilverTable, silver_root: str, fmt: str = "parquet"):
    return open_table(spark, f"{silver_root}/{table.name}", table.keys, fmt, **table.layout)


def sums_of(spark: SparkSession, table: SilverTable, silver_root: str, fmt: str = "parquet") -> RunningSums | None:
    """The table's running sums; on Delta none, as a merged table no longer shows what it held before."""
    if table.averaged is None or fmt == "delta":
        return None
    return RunningSums(open_silver(spark, table, silver_root, fmt), f"{silver_root}/{table.name}_sums", *table.averaged)


def bronze_stream(
    spark: SparkSession, table: SilverTable, bronze: str, fmt: str = "parquet", **options
) -> DataFrame:
    path = f"{bronze}/{table.name}"
    if table.from_changes:
        # A change-fed table is rewritten when compacted; its changes only grow.
        schema = T.StructType(
            [T.StructField("op", T.StringType()), *table.schema.fields,
             T.StructField("batch", T.IntegerType()), T.StructField("bucket", T.IntegerType())]
        )
        changes = open_table(spark, path, table.keys, fmt).changes_path
        return table_stream(spark, changes, schema, "parquet", **options)
    return table_stream(spark, path, None if fmt == "delta" else table.schema, fmt, **options)


def start_silver(
    spark: SparkSession, bronze: str, silver_root: str, checkpoints: str,
    fmt: str = "parquet", trigger: str | None = EVERY_MINUTE,
    tables: Sequence[SilverTable] = SILVER_TABLES, propagate_deletes: bool = False,
    source_options: dict | None = None, copies_within: str | None = None,
) -> list[StreamingQuery]:
    """One query per table in this session; wait with ``spark.streams.awaitAnyTermination()``.

    ``copies_within``, a duration, leaves out readings that come again within that
    time (see ``without_copies``).
    """

    def handler(table: SilverTable):
        def upsert(df: DataFrame, n: int, stream: str) -> None:
            rows = df.persist() if copies_within and table.copies else df  # state is to be worked out once a batch
            try:
                upsert_batch(rows, n, table, silver_root, fmt, propagate_deletes, stream)
            finally:
                rows.unpersist()

        return upsert

    def source(table: SilverTable) -> DataFrame:
        rows = bronze_stream(spark, table, bronze, fmt, **(source_options or {}))
        return without_copies(rows, copies_within) if copies_within and table.copies else rows

    return [
        each_batch(source(table), handler(table), f"{checkpoints}/{table.name}", trigger, f"silver_{table.name}")
        for table in tables
    ]


def without_copies(stream: DataFrame, within: str) -> DataFrame:
    """The stream's rows, but for copies of a row that came within that time before.

    The watermark runs on the time of arrival: a reading that is late by its own
    time is not lost, and the state holds what arrived within the duration only. A
    copy that comes later than that is upserted as before, to the same effect.
    """
    arrived = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    return arrived.dropDuplicatesWithinWatermark(stream.columns).drop("_arrived")
