"""Table checks for declared constraints. Each returns (check_name, violations)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import Declared


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; null keys are the not-null check's matter."""
    return (
        df.dropna(subset=list(keys)).groupBy(*keys).count()
        .agg(F.count_if(F.col("count") > 1).alias("violations"))
        .select(F.lit(f"unique({','.join(keys)})").alias("check_name"), "violations")
    )


def _counted(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One pass for all rules, one output row per rule."""
    counts = df.agg(
        *[F.count_if(broken).alias(f"_{i}") for i, broken in enumerate(rules.values())]
    )
    rows = F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(f"_{i}").alias("violations"))
        for i, name in enumerate(rules)
    ])
    return counts.select(F.inline(rows))


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _counted(df, {f"not_null({c})": F.col(c).isNull() for c in columns})


def check_domain(
    df: DataFrame,
    max_length: Mapping[str, int] | None = None,
    max_digits: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Text length limits and decimal(precision, scale) ranges."""
    return _counted(df, _domain_rules(max_length or {}, max_digits or {}))


def _domain_rules(
    max_length: Mapping[str, int], max_digits: Mapping[str, tuple[int, int]]
) -> dict[str, Column]:
    rules = {f"length({c})<={n}": F.length(c) > n for c, n in max_length.items()}
    for c, (precision, scale) in max_digits.items():
        rules[f"numeric({c},{precision},{scale})"] = F.col(c).isNotNull() & F.col(c).try_cast(
            f"decimal({precision},{scale})"
        ).isNull()
    return rules


def check_declared(df: DataFrame, declared: Declared) -> DataFrame:
    """All declared constraints of a table: one pass for the columns, one aggregate for the key."""
    rules = {f"not_null({c})": F.col(c).isNull() for c in declared.not_null}
    return (
        _counted(df, {**rules, **_domain_rules(declared.lengths, declared.digits)})
        .unionByName(check_unique(df, [declared.key]))
    )


def check_foreign_key(
    child: DataFrame, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Distinct child values without a parent, and the child rows holding them.

    Both sides are reduced to one row per value before the join, so a value
    shared by most rows joins as one row.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(
        F.col(column).alias("_value")
    ).agg(F.count(F.lit(1)).alias("_rows"))
    orphans = values.join(
        parent.select(F.col(parent_key).alias("_value")).distinct(), "_value", "left_anti"
    )
    return orphans.agg(
        F.count(F.lit(1)).alias("violations"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"),
    ).select(
        F.lit(f"foreign_key({column})").alias("check_name"), "violations", "orphan_rows"
    )
