"""Keyed merges between a target and a source, as plain joins.

Keys match by ``=``, so rows with a null key never match: they stay in the
target and are inserted from the source. Sources hold at most one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedupe import keep_one

Clause = tuple[Column, Mapping[str, Column]]


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys]
    )


def merge_frames(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update: Clause | None = None,
    delete: Column | None = None,
    insert: Clause | None = None,
) -> DataFrame:
    """MERGE as one full outer join.

    ``update`` and ``insert`` are (condition, {column: value}); conditions and
    values name columns as ``target.c`` and ``source.c``. Columns a clause does
    not set keep the target's value (update) or become null (insert).
    """
    never = F.lit(False)
    on_update, updates = update or (never, {})
    on_insert, inserts = insert or (never, {})
    joined = (
        target.withColumn("_in_target", F.lit(True)).alias("target")
        .join(
            source.withColumn("_in_source", F.lit(True)).alias("source"),
            same_keys("target", "source", keys),
            "full_outer",
        )
    )
    in_target = F.col("target._in_target").isNotNull()
    in_source = F.col("source._in_source").isNotNull()
    updated = in_target & in_source & F.coalesce(on_update, never)
    deleted = in_target & in_source & ~updated
    deleted = deleted & (F.coalesce(delete, never) if delete is not None else never)
    inserted = ~in_target & F.coalesce(on_insert, never)

    def value(c: str) -> Column:
        kept = F.col(f"target.{c}")
        return (
            F.when(updated, updates.get(c, kept))
            .when(inserted, inserts.get(c, F.lit(None)))
            .otherwise(kept)
            .alias(c)
        )

    return joined.filter((in_target & ~deleted) | inserted).select(
        *[value(c) for c in target.columns]
    )


def apply_single_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One change per key: u updates, d deletes, c and r insert if absent."""
    values = {c: F.col(f"source.{c}") for c in target.columns}
    op = F.col("source.op")
    return merge_frames(
        target, changes, keys,
        update=(op == "u", values), delete=op == "d", insert=(op.isin("c", "r"), values),
    )


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace or join the target's: source plus the unmatched target."""
    kept = target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return source.select(*target.columns).unionByName(kept)


def absent_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Source rows whose key the target lacks, the first by ``order`` per key."""
    first = keep_one(source, keys, order)
    return first.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)


def insert_if_absent(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    return target.unionByName(
        absent_rows(target, source, keys, order).select(*target.columns)
    )
