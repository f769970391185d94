"""One row per key, chosen by a stated order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_one(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), last: bool = False
) -> DataFrame:
    """The first (or last) row per key by ``order``, then the one with most values, then by all other columns.

    A row with fewer nulls is preferred: an unreadable value never displaces a
    readable one. min/max over a struct combines before the shuffle, so a key or a group of
    copies holding most of the rows leaves each task as a single row; a
    row_number() window would send the whole group to one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct().select(*df.columns)
    missing = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in rest])
    ranked = [*order, (-missing if last else missing).alias("_missing"), *[c for c in rest if c not in order]]
    pick = F.max if last else F.min
    best = df.groupBy(*keys).agg(pick(F.struct(*ranked)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_best.{c}") for c in df.columns])


def keep_one_of_few(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), last: bool = False) -> DataFrame:
    """``keep_one`` for tables where few keys repeat: only their rows are ranked, the others stay where they are.

    A first pass over the keys alone finds those that repeat; the planner
    broadcasts them where their measured size allows. A table that comes out of
    this is not dealt by its key, so that a later join on it can split a hot part.
    """
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(
        *[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)])
    once = df.join(repeated, same, "left_anti")
    return once.unionByName(keep_one(df.join(repeated, same, "left_semi"), keys, order, last))
