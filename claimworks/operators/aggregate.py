"""Averages per key and the imputation built on them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import lookup_join


def averages(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """{output: column} averages per key; partial sums form before the shuffle."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(out) for out, c in columns.items()])


def fill_missing(
    batch: DataFrame, keys: Sequence[str], column: str, means: Callable[[DataFrame], DataFrame | None]
) -> DataFrame:
    """Missing values of ``column`` from ``means``, which gets the keys that lack one and gives (keys, column).

    Keys without a mean stay null.
    """
    missing = batch.filter(F.col(column).isNull())
    found = means(missing.select(*keys).distinct())
    if found is None:
        return batch
    filled = lookup_join(missing, found.select(*keys, F.col(column).alias("_mean")), keys, "left").withColumn(
        column, F.col("_mean").cast(batch.schema[column].dataType)
    )
    complete = batch.filter(F.col(column).isNotNull())
    return complete.unionByName(filled.select(*batch.columns))


def impute_from_history(
    batch: DataFrame, history: DataFrame, keys: Sequence[str], column: str
) -> DataFrame:
    """Fill missing values with the key's average in ``history``.

    Only the history of keys with a missing value is averaged: the batch's few
    keys are a semi-join before anything else is read of it. Keys without
    history stay null. A stream keeps running sums instead (``streaming.sums``).
    """
    def means(wanted: DataFrame) -> DataFrame:
        return averages(history.select(*keys, column).join(wanted, list(keys), "left_semi"), keys, {column: column})

    return fill_missing(batch, keys, column, means)
