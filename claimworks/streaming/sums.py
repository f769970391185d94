"""Counts and sums per key of a keyed table, kept up by its deliveries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.changelog import DELETE, UPSERT
from .follow import pending, rows_replaced, rows_set, stored
from .tables import FolderTable

# Sums are fixed-point: what a row adds, its retraction takes off again exactly.
FIXED = "decimal(38,12)"


class RunningSums:
    """Per value of ``by``: ``rows``, and ``<c>_n`` and ``<c>_sum`` of each column's values.

    A delivery of ``source`` changes them by the rows it sets, less the rows they
    replace and those it deletes; the latter are read from the buckets it touches.
    Each delivery is a delivery of the sums too, under its own number, so a replay
    changes nothing and what was missed is made up for. Values that are null, not
    finite or beyond 26 digits are not counted.
    """

    def __init__(self, source: FolderTable, path: str, by: Sequence[str], columns: Sequence[str], buckets: int | None = None):
        self.source, self.by, self.columns = source, list(by), list(columns)
        self.table = FolderTable(source.spark, path, by, **({"buckets": buckets} if buckets else {}))

    def follow(self) -> None:
        """Take up all finished deliveries of the source that are not yet in the sums; first of all the whole table once."""
        numbers, whole = pending(self.table, "source", self.source)
        for number in numbers:
            self.table.write(number, lambda before, s=(number, whole): self._change(*s, before), "source")

    def _signed(self, df: DataFrame, sign: int) -> DataFrame:
        """One row per row of ``df``: what it adds."""
        out: list[Column] = [F.lit(sign).cast("long").alias("rows")]
        for c in self.columns:
            value = F.col(c).try_cast(FIXED)
            added = value if sign > 0 else -value
            out += [F.when(value.isNotNull(), F.lit(sign)).otherwise(0).cast("long").alias(f"{c}_n"),
                    F.coalesce(added, F.lit(0).cast(FIXED)).cast(FIXED).alias(f"{c}_sum")]
        return df.select(*self.by, *out)

    @property
    def _totals(self) -> list[str]:
        return ["rows", *[f"{c}_{kind}" for c in self.columns for kind in ("n", "sum")]]

    def _added(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.by).agg(*[
            F.sum(c).cast(FIXED if c.endswith("_sum") else "long").alias(c) for c in self._totals])

    def _change(self, number: int, whole: bool, before) -> DataFrame:
        wanted = [*self.by, *self.columns]
        gains = self._signed(rows_set(self.source, number, whole, wanted), 1)
        old = rows_replaced(self.source, number, whole, wanted)
        if old is not None:
            gains = gains.union(self._signed(old, -1))
        change = stored(self._added(gains))
        now = before(touching=change, columns=self._totals)
        if now is not None:
            kept = now.join(change.select(*self.by), self.by, "left_semi").select(*self.by, *self._totals)
            change = self._added(change.union(kept))
        op = F.when(F.col("rows") > 0, F.lit(UPSERT)).otherwise(F.lit(DELETE))
        return change.select(op.alias("op"), *self.by, *self._totals)

    def exists(self) -> bool:
        return self.table.exists()

    def averages(self, of: DataFrame | None = None) -> DataFrame | None:
        """(by, <column>...): the averages now, of all keys or of those in ``of``; None before the first delivery."""
        sums = self.table.read(touching=of, columns=self._totals)
        if sums is None:
            return None
        if of is not None:
            sums = sums.join(of.select(*self.by), self.by, "left_semi")
        mean = lambda c: F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_sum").cast("double") / F.col(f"{c}_n")).alias(c)
        return sums.select(*self.by, *map(mean, self.columns))

    def compact(self) -> None:
        self.table.compact()
