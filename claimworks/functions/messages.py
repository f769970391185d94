"""JSON messages: change envelopes, row images, telematics maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CAPTURED, ENVELOPE, TELEMATICS, strings

STRING_MAP = T.MapType(T.StringType(), T.StringType())


def parse_envelopes(topic: DataFrame) -> DataFrame:
    """Change messages to (table_name, op, before_str, after_str, ts_ms, offset).

    Tombstones and unreadable messages name no table and drop out; ``observe``
    counts them without a further pass.
    """
    parsed = topic.select(
        F.from_json(F.col("value").cast("string"), ENVELOPE).alias("e"), "offset"
    ).observe(
        "envelopes",
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("e.source.table").isNull()).alias("without_table"),
    )
    return parsed.select(
        F.col("e.source.table").alias("table_name"),
        F.col("e.op").alias("op"),
        F.col("e.before").alias("before_str"),
        F.col("e.after").alias("after_str"),
        F.col("e.ts_ms").alias("ts_ms"),
        "offset",
    ).filter(F.col("table_name").isNotNull())


def known_tables(changes: DataFrame, tables=CAPTURED) -> DataFrame:
    return changes.filter(F.col("table_name").isin(*tables))


def route(changes: DataFrame, table: str) -> DataFrame:
    return changes.filter(F.col("table_name") == table)


def row_text() -> Column:
    """A delete carries the old row, every other change the new one."""
    return F.when(F.col("op") == "d", F.col("before_str")).otherwise(F.col("after_str"))


def row_image(schema: T.StructType) -> Column:
    return F.from_json(row_text(), schema)


def keyed_texts(changes: DataFrame, tables=CAPTURED) -> DataFrame:
    """Changes of the known tables with their key values read, their rows unparsed."""
    text, key_values = row_text(), F.lit(None).cast("array<string>")
    for name, (_, keys) in tables.items():
        found = F.from_json(text, strings(*keys))
        key_values = F.when(
            F.col("table_name") == name, F.array(*[found[k] for k in keys])
        ).otherwise(key_values)
    return known_tables(changes, tables).select(
        "table_name", "op", "ts_ms", "offset", key_values.alias("key_values"), text.alias("image")
    )


OPS = ("c", "r", "u", "d")


def sorted_messages(topic: DataFrame, tables=CAPTURED) -> DataFrame:
    """Every message of the topic: ``keyed_texts`` where it can be applied, else ``reason`` says why not.

    The message's own key, value and offset stay beside what was read of it.
    """
    parsed = topic.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "offset"
    ).withColumn("e", F.from_json("value", ENVELOPE)).select(
        "key", "value", "offset", F.col("e.source.table").alias("table_name"), F.col("e.op").alias("op"),
        F.col("e.before").alias("before_str"), F.col("e.after").alias("after_str"), F.col("e.ts_ms").alias("ts_ms"))
    text, key_values = row_text(), F.lit(None).cast("array<string>")
    for name, (_, keys) in tables.items():
        found = F.from_json(text, strings(*keys))
        key_values = F.when(F.col("table_name") == name, F.array(*[found[k] for k in keys])).otherwise(key_values)
    read = parsed.select("key", "value", "offset", "table_name", "op", "ts_ms", key_values.alias("key_values"), text.alias("image"))
    reason = (
        F.when(F.col("value").isNull(), "tombstone")
        .when(F.col("table_name").isNull(), "unreadable")
        .when(~F.col("table_name").isin(*tables), "table not captured")
        .when(~F.coalesce(F.col("op").isin(*OPS), F.lit(False)), "unknown op")
        .when(F.exists("key_values", lambda k: k.isNull()), "no key")
    )
    return read.withColumn("reason", reason)


def row_images(changes: DataFrame, schema: T.StructType) -> DataFrame:
    return changes.select("op", "ts_ms", "offset", row_image(schema).alias("image"))


def expand_images(images: DataFrame) -> DataFrame:
    return images.select("op", "image.*")


def parse_telematics(topic: DataFrame) -> DataFrame:
    """Telematics messages to five text columns; an absent key gives null."""
    data = topic.select(F.from_json(F.col("value").cast("string"), STRING_MAP).alias("m"))
    return data.observe(
        "telematics",
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("m").isNull()).alias("unreadable"),
    ).select(*[F.try_element_at("m", F.lit(n)).alias(n) for n in TELEMATICS.names])


def encode_messages(df: DataFrame, key: str, default_key: str = "default") -> DataFrame:
    """Rows to (key, value): every column as text in one JSON object."""
    texts = df.select([F.col(c).cast("string") for c in df.columns])
    return texts.select(
        F.coalesce(F.col(key), F.lit(default_key)).alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )
