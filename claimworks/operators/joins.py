"""Equi-join of a large side to a small look-up side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    large: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on shared key names; output is large's columns, then lookup's others.

    A plain join: the planner broadcasts the look-up where its measured size
    allows and AQE splits a hot key's part of the large side where not.
    """
    return large.join(lookup, list(keys), how).select(
        *[large[c] for c in large.columns], *[lookup[c] for c in lookup.columns if c not in keys])


def salted_join(
    large: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = 32
) -> DataFrame:
    """The same for a key known to be hot where the planner cannot split it.

    Every key's large rows spread over ``salts`` parts and the look-up rows are
    repeated once per part, so this costs ``salts`` look-ups. A row's part comes
    from its place in its partition, so copies of one row spread too.
    """
    part = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    spread = large.withColumn("_part", part)
    repeated = lookup.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = spread.join(repeated, [*keys, "_part"], how)
    return joined.select(*large.columns, *[c for c in lookup.columns if c not in keys])
