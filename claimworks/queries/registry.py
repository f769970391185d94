"""Named queries over the test tables, each with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals and floats as doubles: types that
    compare the same in every client."""
    def plain(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return c.cast("double").alias(field.name)
        return c

    return df.select(*[plain(f) for f in df.schema.fields])


def portable_sql(inner: str, text: str = "", double: str = "") -> str:
    """The same for SQL: ``text`` and ``double`` name the columns to cast."""
    casts = [f"cast({c} as varchar) as {c}" for c in text.split()]
    casts += [f"cast({c} as double) as {c}" for c in double.split()]
    return f"select * replace ({', '.join(casts)}) from ({inner})"


def single(df: DataFrame, *columns: str) -> DataFrame:
    """Averages to single precision: summation order shows in a double's last bits."""
    return df.withColumns({c: F.col(c).cast("float").cast("double") for c in columns})


def single_sql(expr: str) -> str:
    return f"cast(cast({expr} as float) as double)"
