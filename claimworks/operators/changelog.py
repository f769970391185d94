"""Reduce an ordered change log to one net change per key, and apply it.

The rules for one change: ``u`` updates a present row, ``d`` deletes it, ``c``
and ``r`` insert an absent one; anything else does nothing. A key's whole log
is a function of "was the row present before?", which the net change holds as

* ``on_present``  the row image a present row ends with (null: left alone)
* ``on_absent``   the row image an absent row ends with (null: stays absent)
* ``removes``     a present row ends deleted

so the result does not depend on how the log is cut into batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import merge_frames

UPSERT, DELETE = "s", "d"


def all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def net_changes(
    log: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    image: str = "image",
    salts: int = 32,
) -> DataFrame:
    """Log rows (keys, op, order columns, image) to net changes.

    The image may be a struct or, better for wide rows, still unparsed text.
    Everything is min/max per key, combined before the shuffle, so a key that
    holds a third of the log is no hot spot. Only keys created both before and
    after their last delete need a second look at their creations; that join is
    salted, the small side being repeated once per salt.
    """
    log = log.filter(all_present(keys))
    op = F.col("op")
    seq = F.struct(*order)
    event = F.struct(seq.alias("seq"), F.col(image).alias("image"))
    creates = op.isin("c", "r")

    per_key = log.groupBy(*keys).agg(
        F.max(F.when(op == "d", seq)).alias("_last_d"),
        F.max(F.when(op == "u", event)).alias("_last_u"),
        F.min(F.when(creates, event)).alias("_first_c"),
    )

    spans = (
        log.filter(creates | (op == "d"))
        .groupBy(*keys)
        .agg(
            F.max(F.when(op == "d", seq)).alias("_last_d"),
            F.min(F.when(creates, seq)).alias("_c_from"),
            F.max(F.when(creates, seq)).alias("_c_to"),
        )
        .filter("_c_from < _last_d and _c_to > _last_d")
        .select(*keys, "_last_d", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    )
    reborn = (
        log.filter(creates)
        .withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
        .join(spans, [*keys, "_salt"])
        .filter(seq > F.col("_last_d"))
        .groupBy(*keys)
        .agg(F.min(event).alias("_next_c"))
    )

    joined = per_key.join(reborn, list(keys), "left")
    deleted = F.col("_last_d").isNotNull()
    first_is_live = ~deleted | (F.col("_first_c.seq") > F.col("_last_d"))
    create = F.when(first_is_live, F.col("_first_c")).otherwise(F.col("_next_c"))
    return (
        joined.withColumn("_create", create)
        .withColumn(
            "on_absent",
            F.when(F.col("_last_u.seq") > F.col("_create.seq"), F.col("_last_u.image"))
            .otherwise(F.col("_create.image")),
        )
        .select(
            *keys,
            F.when(deleted, F.col("on_absent")).otherwise(F.col("_last_u.image"))
            .alias("on_present"),
            "on_absent",
            (deleted & F.col("_create").isNull()).alias("removes"),
        )
        .filter("removes or on_present is not null or on_absent is not null")
    )


def apply_net(target: DataFrame, net: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after its net changes: one full outer join, one row per key each side."""
    present, absent = F.col("source.on_present"), F.col("source.on_absent")
    return merge_frames(
        target, net, keys,
        update=(present.isNotNull(), {c: F.col(f"source.on_present.{c}") for c in target.columns}),
        delete=F.col("source.removes"),
        insert=(absent.isNotNull(), {c: F.col(f"source.on_absent.{c}") for c in target.columns}),
    )


def resolve(net: DataFrame, current_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Net changes against the keys present now: (op, keys, image), s = set, d = delete.

    Only key columns of the current table are read. The batch is the side that
    can be broadcast, so AQE can spare the table its shuffle.
    """
    found = (
        current_keys.select(*keys)
        .join(net.select(*keys), list(keys), "left_semi")
        .withColumn("_found", F.lit(True))
    )
    present = F.col("_found").isNotNull()
    image = F.when(present, F.col("on_present")).otherwise(F.col("on_absent"))
    return (
        net.join(found, list(keys), "left")
        .withColumn("image", image)
        .withColumn(
            "op",
            F.when(F.col("image").isNotNull(), F.lit(UPSERT))
            .when(present & F.col("removes"), F.lit(DELETE)),
        )
        .filter(F.col("op").isNotNull())
        .select("op", *keys, "image")
    )


def expand(resolved: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Struct images to columns; a delete has no image and keeps only its key."""
    return resolved.select(
        "op", *[F.col(c) if c in keys else F.col(f"image.{c}") for c in columns]
    )
