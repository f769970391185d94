"""Batch and streaming sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import NULL_TOKENS, is_image_path, null_if_token
from ..schemas import BINARY_FILE, TOPIC

# Admits jpg, jpeg and png in any case; keeps other files from being opened.
IMAGE_GLOB = "*.[jJpP][pPnN]*"
# A file stream takes files however old they are (Spark's own limit is a week behind the newest):
# copies that keep their times, and back-fills, arrive late.
ANY_AGE = {"maxFileAge": "36500d"}
SURPLUS = "_surplus"
PLACE = ("_file", "_record")


def topic_stream(
    spark: SparkSession,
    *,
    topic: str | None = None,
    pattern: str | None = None,
    servers: str | None = None,
    folder: str | None = None,
    **options: str,
) -> DataFrame:
    """A broker topic (by name or pattern) from its earliest offset.

    ``folder`` reads parquet files of (key, value, offset) instead, for use
    without a broker; everything downstream is the same.
    """
    if folder is not None:
        return spark.readStream.schema(TOPIC).options(**{**ANY_AGE, **options}).parquet(folder)
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    if pattern is not None:
        reader = reader.option("subscribePattern", pattern)
    else:
        reader = reader.option("subscribe", topic)
    return reader.option("startingOffsets", "earliest").options(**options).load()


def image_stream(spark: SparkSession, folder: str, recursive: bool = False, **options) -> DataFrame:
    """Image files as (path, modificationTime, length, content)."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("pathGlobFilter", IMAGE_GLOB)
        .options(**{**ANY_AGE, **options})
    )
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(folder).filter(is_image_path("path"))


def csv_stream(spark: SparkSession, folder: str, schema: T.StructType, **options) -> DataFrame:
    """Headed CSV files; quoted fields may hold line breaks."""
    options = {**ANY_AGE, "header": "true", "multiLine": "true", "escape": '"', **options}
    return spark.readStream.schema(schema).options(**options).csv(folder)


def table_stream(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet", **options
) -> DataFrame:
    """A table's appended rows; file formats need the schema, Delta knows it."""
    reader = spark.readStream.format(fmt).options(**{**({} if fmt == "delta" else ANY_AGE), **options})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def scan(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Headed CSV, every column as text, and ``SURPLUS``: the first field beyond the header's, if any.

    Quoted fields may hold line breaks, so one task reads a file; extracts come in several.
    """
    reader = spark.read.option("header", "true").option("quote", '"').option("escape", '"').option("multiLine", "true")
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, SURPLUS)])
    return reader.schema(schema).csv(path)


def scan_csv(
    spark: SparkSession, path: str, null_tokens: Iterable[str] = NULL_TOKENS, rejects: bool = False,
    place: bool = False,
) -> DataFrame:
    """Headed CSV as text (leading zeros survive), null tokens nulled; missing last fields are null.

    A record with more fields than the header fails the read, or is left out where
    the caller takes ``csv_rejects`` as well. With ``place`` the columns ``PLACE``
    give a record's file and its order in it.
    """
    raw = csv_records(spark, path)
    at = [F.col("_metadata.file_path").alias(PLACE[0]), F.monotonically_increasing_id().alias(PLACE[1])] if place else []
    whole = F.col(SURPLUS).isNull()
    loud = F.when(whole, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit(f"{path}: more fields than the header, from: "), F.col(SURPLUS))).cast("boolean"))
    tokens = tuple(null_tokens)
    return raw.filter(whole if rejects else loud).select(
        *[null_if_token(F.col(f"`{c}`"), tokens).alias(c) for c in raw.columns if c != SURPLUS], *at)


def csv_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The records with more fields than the header: (record, reason)."""
    raw = csv_records(spark, path).filter(F.col(SURPLUS).isNotNull())
    return raw.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in raw.columns])).alias("record"),
                      F.lit("surplus fields").alias("reason"))


def image_folder(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """Images decoded by the JVM: (path, height, width, channels, pixels).

    Pixels are rows of blue-green-red bytes, null where a file does not decode.
    """
    reader = spark.read.format("image").option("dropInvalid", "false").option(
        "pathGlobFilter", IMAGE_GLOB
    )
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(folder).select(
        F.col("image.origin").alias("path"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.when(F.col("image.height") > 0, F.col("image.data")).alias("pixels"),
    )
