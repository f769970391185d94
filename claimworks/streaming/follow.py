"""Tables kept up by the deliveries of others: what a batch changes costs a batch, not the tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.changelog import DELETE, UPSERT
from ..session import scratch_dir
from ..sources.files import numbered_folders, remove_folder
from .tables import FolderTable


def pending(table: FolderTable, side: str, source: FolderTable) -> tuple[list[int], bool]:
    """(deliveries of ``source`` that ``table`` is to take up as stream ``side``, whether the first means the whole table).

    The last one taken up is among them: it may not have been finished.
    """
    known = numbered_folders(table.spark, f"{table.path}/deliveries/{side}", "")
    if known:
        return source.deliveries(known[-1] - 1), False
    return source.deliveries()[-1:], True


def rows_set(source: FolderTable, number: int, whole: bool, columns: Sequence[str]) -> DataFrame:
    """Rows that delivery ``number`` set, or all there are after it."""
    if whole:
        return source.read(before=number + 1, columns=columns)
    names = [*source.keys, *[c for c in columns if c not in source.keys]]
    return source.delivered(number).where(F.col("op") == UPSERT).select(*names)


def rows_replaced(source: FolderTable, number: int, whole: bool, columns: Sequence[str]) -> DataFrame | None:
    """Rows as they were before delivery ``number`` set or deleted them; only buckets it touches are read."""
    if whole:
        return None
    delivery = source.delivered(number)
    return source.read(number, touching=delivery, columns=columns, only=delivery.select(*source.keys))


def stored(rows: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder: several steps that follow read them."""
    path = scratch_dir(rows.sparkSession, "follow")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@contextmanager
def kept(rows: DataFrame) -> Iterator[DataFrame]:
    """The rows, written once to the shared folder for the statements inside, then removed.

    Cached rows would fill the executors' heap with a batch's texts while its tasks
    run, and would be lost with an executor.
    """
    path = scratch_dir(rows.sparkSession, "kept")
    try:
        rows.write.option("compression", "zstd").parquet(path)
        yield rows.sparkSession.read.schema(rows.schema).parquet(path)
    finally:
        remove_folder(rows.sparkSession, path)


class References:
    """A declared reference: rows of ``child`` per value of ``column``, and whether ``parent`` has that key.

    ``<path>/values`` holds the counts per value, ``<path>/totals`` one row: how
    many values lack their parent, and in how many child rows. Inserts,
    replacements and deletes on either side change both by what they touch. Null
    values refer to nothing. Child values are compared as the parent's key type.
    """

    def __init__(self, child: FolderTable, column: str, parent: FolderTable, path: str):
        self.child, self.column, self.parent = child, column, parent
        self.values = FolderTable(child.spark, f"{path}/values", ["value"], buckets=child.buckets)
        self.totals = FolderTable(child.spark, f"{path}/totals", ["check_name"], buckets=1)

    def follow(self) -> None:
        for side, source, column in (("parent", self.parent, self.parent.keys[0]), ("child", self.child, self.column)):
            numbers, whole = pending(self.values, side, source)
            for number in numbers:
                state = self.values.write(
                    number, lambda before, s=(side, source, column, number, whole): self._counts(*s, before), side)
                self.totals.write(state, lambda before, n=state: self._sums(n, before), "values")
                whole = False

    def _counts(self, side: str, source: FolderTable, column: str, number: int, whole: bool, before) -> DataFrame:
        def signed(rows: DataFrame, sign: int) -> DataFrame:
            n, none = F.lit(sign).cast("long"), F.lit(0).cast("long")
            parents, children = (n, none) if side == "parent" else (none, n)
            return rows.where(F.col(column).isNotNull()).select(
                F.col(column).cast("string").alias("value"), parents.alias("parents"), children.alias("children"))

        def added(rows: DataFrame) -> DataFrame:
            return rows.groupBy("value").agg(F.sum("parents").alias("parents"), F.sum("children").alias("children"))

        change = signed(rows_set(source, number, whole, [column]), 1)
        old = rows_replaced(source, number, whole, [column])
        if old is not None:
            change = change.union(signed(old, -1))
        change = stored(added(change))
        now = before(touching=change, columns=["parents", "children"])
        if now is not None:
            change = added(change.union(now.join(change.select("value"), "value", "left_semi").select(*change.columns)))
        op = F.when((F.col("parents") > 0) | (F.col("children") > 0), F.lit(UPSERT)).otherwise(F.lit(DELETE))
        return change.select(op.alias("op"), "value", "parents", "children")

    def _sums(self, number: int, before) -> DataFrame:
        """The totals after a delivery of the values: what they were, and the difference it makes."""
        def orphans(rows: DataFrame, sign: int) -> DataFrame:
            lost = rows.where((F.col("parents") <= 0) & (F.col("children") > 0))
            return lost.select(F.lit(sign).cast("long").alias("violations"), (F.col("children") * sign).alias("orphan_rows"))

        delivery = self.values.delivered(number)
        parts = orphans(delivery.where(F.col("op") == UPSERT), 1)
        old = self.values.read(number, touching=delivery, columns=["parents", "children"])
        if old is not None:
            parts = parts.union(orphans(old.join(delivery.select("value"), "value", "left_semi"), -1))
        now = before()
        if now is not None:
            parts = parts.union(now.select("violations", "orphan_rows"))
        sums = parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("violations", "orphan_rows")])
        return sums.select(F.lit(UPSERT).alias("op"), F.lit(f"foreign_key({self.column})").alias("check_name"), "violations", "orphan_rows")

    def check(self) -> DataFrame | None:
        """(check_name, violations, orphan_rows): one stored row; None before the first delivery."""
        return self.totals.read()

    def orphans(self) -> DataFrame:
        """The values without a parent and their child rows."""
        held = self.values.read(columns=["parents", "children"])
        return held.where((F.col("parents") <= 0) & (F.col("children") > 0)).select("value", "children")
