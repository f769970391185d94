"""Keyed tables that micro-batches change, on plain folders or on Delta.

A folder table holds
    <path>/layout.json                 columns, and what rows are partitioned by
    <path>/changes/batch=K/bucket=B    rows delivery K set or deleted, at most one per key
    <path>/deliveries/<stream>/<N>/K=  batch N of that stream is delivery K
    <path>/numbers/batch=K             taken numbers; a delivery gets to its place whole, by a rename
    <path>/base/upto=K/bucket=B        the table after delivery K, where ``compact`` wrote it
and its state is the newest base with the later deliveries on top. A row's bucket
follows from its key (a hash, or the day of a time that is part of it), so a batch
that asks for the rows its own keys may replace reads only the buckets it touches.
A delivery is known by its stream's identity and the batch's number: a replayed
batch finds its own folder committed and leaves it alone, while a new checkpoint is
another stream, all of whose batches are new. One writer per table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changelog import UPSERT
from ..operators.merge import same_keys
from ..sources.files import (
    create_text,
    is_committed,
    make_folder,
    numbered_folders,
    publish_folder,
    read_text,
    table_exists,
)

BUCKETS = 8
_DAY_US = 86_400_000_000

# (touching=None, columns=None): the table as a batch found it, see ``FolderTable.read``.
Before = Callable[..., DataFrame | None]


def bucket_of(df: DataFrame, keys: Sequence[str], buckets: int, day: str | None = None) -> Column:
    """The bucket of a row's key: the day of ``day``, or a hash modulo ``buckets``, alike in every session.

    Null key parts count as empty text, a null time as the first day there is.
    """
    def instant(c: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp"))

    if day is not None:
        return F.coalesce(F.floor(instant(day) / _DAY_US).cast("int"), F.lit(-719_529))
    times = {f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    parts = [F.coalesce((instant(k) if k in times else F.col(k)).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws("\x01", *parts).cast("binary"))
    if 16 % buckets == 0:  # the last of the eight digits tells, at half the cost
        return F.pmod(F.instr(F.lit("0123456789abcdef"), F.substring(digest, 8, 1)) - 1, F.lit(buckets)).cast("int")
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


class FolderTable:
    """What rows are partitioned by is fixed by the first delivery; later ones keep what it chose.

    ``by`` are the key columns that are hashed (all of them, unless said), ``day``
    a key column whose day is the bucket instead.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet",
                 buckets: int = BUCKETS, day: str | None = None, by: Sequence[str] | None = None):
        self.spark, self.path, self.keys, self.fmt = spark, path.rstrip("/"), list(keys), fmt
        self.buckets, self.day, self.by = buckets, day, list(by or keys)

    @property
    def changes_path(self) -> str:
        return f"{self.path}/changes"

    def exists(self) -> bool:
        return self._newest_base() is not None or bool(self._batches())

    def _layout(self, frame: DataFrame | None = None) -> dict:
        """What the table was laid out by; written with the first delivery, whose frame is (op, row)."""
        path = f"{self.path}/layout.json"
        text = read_text(self.spark, path)
        if text is None:
            rows = T.StructType([f for f in frame.schema if f.name != "op"])
            text = json.dumps({"buckets": self.buckets, "day": self.day, "by": self.by, "rows": rows.jsonValue()})
            create_text(self.spark, path, text)
        return json.loads(text)

    def _bucket(self, frame: DataFrame, layout: dict) -> Column:
        return bucket_of(frame, layout["by"], layout["buckets"], layout["day"])

    def _save(self, frame: DataFrame, layout: dict, target: str) -> None:
        """Rows by bucket, dealt so that a bucket is one file, or several if it is large."""
        dealt = frame.withColumn("bucket", self._bucket(frame, layout)).hint("rebalance", "bucket")
        dealt.write.format(self.fmt).partitionBy("bucket").mode("overwrite").save(target)

    def _newest_base(self, before: int | None = None) -> int | None:
        for n in reversed(numbered_folders(self.spark, f"{self.path}/base", "upto=")):
            if (before is None or n < before) and is_committed(self.spark, f"{self.path}/base/upto={n}"):
                return n
        return None

    def _batches(self, after: int | None = None, before: int | None = None) -> list[int]:
        """Finished batches between the two; older ones are not looked at."""
        return [
            n for n in numbered_folders(self.spark, self.changes_path, "batch=")
            if (after is None or n > after) and (before is None or n < before)
            and is_committed(self.spark, f"{self.changes_path}/batch={n}")
        ]

    def _load(self, fields: list[T.StructField], root: str, folders: list[str], touched: DataFrame | None) -> DataFrame:
        """The folders' rows, without the buckets that were not touched."""
        number = T.StructField(folders[0].rpartition("/")[2].partition("=")[0], T.IntegerType())
        schema = T.StructType([*fields, number, T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.format(self.fmt).schema(schema).option("basePath", root).load(folders)
        # The other side is one whole number per bucket; its broadcast prunes the scan's partitions.
        return rows if touched is None else rows.join(F.broadcast(touched), "bucket", "left_semi")

    def read(
        self, before: int | None = None, touching: DataFrame | None = None, columns: Sequence[str] | None = None,
        only: DataFrame | None = None,
    ) -> DataFrame | None:
        """The table after all batches, or as batch ``before`` found it; None if there is none.

        ``touching`` (rows with the columns that rows are partitioned by) leaves out
        buckets in which none of its keys can lie: other rows may or may not be there. ``columns``
        narrows the rows; few and small ones are reduced before they are dealt. ``only`` (some of the
        key columns) leaves just the rows that match it, before anything is reduced.
        """
        base, changes, batches, rows = self._log(before, touching, only)
        if base is None and changes is None:
            return None
        if columns is not None:
            return self._narrow(base, changes, [*self.keys, *[c for c in columns if c not in self.keys]])
        if changes is None:
            return base.select(*rows.names)
        return self._fold(base, changes, batches).select(*rows.names)

    def ever(self, values: DataFrame) -> DataFrame:
        """The keys of all rows that hold, or since the newest base once held, one of the values (a frame of the
        columns that rows are partitioned by). Nothing is reduced, so a value that many rows hold is no hot key."""
        base, changes, _, _ = self._log(None, values, values.distinct())
        parts = [] if base is None else [base.select(*self.keys)]
        parts += [] if changes is None else [changes.where(F.col("op") == UPSERT).select(*self.keys)]
        return reduce(DataFrame.union, parts)

    def _log(
        self, before: int | None, touching: DataFrame | None, only: DataFrame | None
    ) -> tuple[DataFrame | None, DataFrame | None, list[int], T.StructType]:
        """(newest base, later changes, their numbers, columns) that ``read`` puts together."""
        newest = self._newest_base(before)
        batches = self._batches(newest, before)
        if newest is None and not batches:
            return None, None, [], T.StructType([])
        layout = self._layout()
        rows = T.StructType.fromJson(layout["rows"])
        touched = None
        if touching is not None:
            wanted = [layout["day"]] if layout["day"] else layout["by"]
            keyed = touching.select(*[F.col(k).cast(rows[k].dataType).alias(k) for k in wanted])
            # A comparison, true of every row, marks the filter as selective, so that the planner prunes by it.
            touched = keyed.where(F.hash(*wanted) >= -2_147_483_648).select(self._bucket(keyed, layout).alias("bucket")).distinct()
        base = changes = None
        if newest is not None:
            base = self._load(rows.fields, f"{self.path}/base", [f"{self.path}/base/upto={newest}"], touched)
        if batches:
            fields = [T.StructField("op", T.StringType()), *rows.fields]
            folders = [f"{self.changes_path}/batch={n}" for n in batches]
            changes = self._load(fields, self.changes_path, folders, touched)
        if only is not None:
            wanted = only.select(*[F.col(k).cast(rows[k].dataType).alias(k) for k in only.columns])
            base, changes = (part and part.join(wanted, only.columns, "left_semi") for part in (base, changes))
        return base, changes, batches, rows

    def _narrow(self, base: DataFrame | None, changes: DataFrame | None, columns: list[str]) -> DataFrame:
        """The last row of each key, by an aggregate that combines before the shuffle."""
        log = []
        if base is not None:
            log.append(base.select(*columns, F.lit(UPSERT).alias("_op"), F.lit(-1).alias("_at")))
        if changes is not None:
            log.append(changes.select(*columns, F.col("op").alias("_op"), F.col("batch").alias("_at")))
        rest = [c for c in columns if c not in self.keys]
        last = log[0] if len(log) == 1 else log[0].union(log[1])
        last = last.groupBy(*self.keys).agg(F.max(F.struct("_at", "_op", *rest)).alias("_last"))
        return last.where(F.col("_last._op") == UPSERT).select(*self.keys, *[F.col(f"_last.{c}").alias(c) for c in rest])

    def _fold(self, base: DataFrame | None, changes: DataFrame, batches: list[int]) -> DataFrame:
        # Whole rows (image contents among them) move only if the key sets they
        # are checked against are too big for AQE to broadcast.
        newer = changes
        if base is None:  # what the first batch holds replaces nothing, and it may be most of the table
            newer = changes.filter(F.col("batch") > batches[0])
        touched = newer.groupBy(*self.keys).agg(F.max("batch").alias("_last"))
        latest = changes
        if len(batches) > 1:
            latest = changes.alias("l").join(
                touched.alias("r"),
                same_keys("l", "r", self.keys) & (F.col("l.batch") < F.col("r._last")),
                "left_anti",
            )
        rows = latest.filter(F.col("op") == UPSERT).drop("op", "batch")
        if base is None:
            return rows
        untouched = base.join(touched.select(*self.keys), self.keys, "left_anti")
        return untouched.select(*rows.columns).unionByName(rows)

    def _delivery(self, stream: str, batch_id: int) -> int:
        """The number of a batch among all deliveries; reserved before anything is written."""
        folder = f"{self.path}/deliveries/{stream}/{batch_id}"
        known = numbered_folders(self.spark, folder, "K=")
        if known:
            return known[0]
        taken = [n for at in (self.changes_path, f"{self.path}/numbers") for n in numbered_folders(self.spark, at, "batch=")]
        number = max(taken, default=-1) + 1
        make_folder(self.spark, f"{self.path}/numbers/batch={number}")
        make_folder(self.spark, f"{folder}/K={number}")
        return number

    def _deliver(self, frame: DataFrame, number: int) -> None:
        """Write a delivery aside and move it to its place whole: streams list that place file by file."""
        aside = f"{self.path}/_tries/{number}-{uuid.uuid4().hex}"
        self._save(frame, self._layout(frame), aside)
        publish_folder(self.spark, aside, f"{self.changes_path}/batch={number}")

    def took(self, stream: str, batch_id: int) -> bool:
        """Whether that stream's batch is a finished delivery."""
        known = numbered_folders(self.spark, f"{self.path}/deliveries/{stream}/{batch_id}", "K=")
        return bool(known) and is_committed(self.spark, f"{self.changes_path}/batch={known[0]}")

    def delivered(self, number: int) -> DataFrame | None:
        """The (op, row) frame of a finished delivery; None where it is not there."""
        if not is_committed(self.spark, f"{self.changes_path}/batch={number}"):
            return None
        fields = [T.StructField("op", T.StringType()), *T.StructType.fromJson(self._layout()["rows"]).fields]
        folder = f"{self.changes_path}/batch={number}"
        return self._load(fields, self.changes_path, [folder], None).drop("batch", "bucket")

    def deliveries(self, after: int | None = None) -> list[int]:
        """Numbers of the finished deliveries after that one."""
        return self._batches(after)

    def write(self, batch_id: int, rows: Callable[[Before], DataFrame], stream: str = "only") -> int:
        """Commit the (op, row) frame ``rows`` gives, once per stream and batch; the delivery's number.

        ``rows`` gets a function that reads the table as it was before the
        batch; most tables never call it and so never list their files.
        """
        number = self._delivery(stream, batch_id)
        target = f"{self.changes_path}/batch={number}"
        if not is_committed(self.spark, target):
            self._deliver(rows(lambda touching=None, columns=None: self.read(number, touching, columns)), number)
        return number

    def compact(self) -> None:
        """Write the table after its last finished delivery as a new base. A job of its own, run as often
        as reading many deliveries costs more than one rewrite."""
        done = self._batches()
        if done and not is_committed(self.spark, f"{self.path}/base/upto={done[-1]}"):
            self._save(self.read(before=done[-1] + 1), self._layout(), f"{self.path}/base/upto={done[-1]}")


class AppendedTable(FolderTable):
    """Rows that batches add: each batch's once, whatever is replayed."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        super().__init__(spark, path, [], fmt, buckets=1)

    def add(self, batch_id: int, rows: DataFrame, stream: str = "only") -> int:
        return self.write(batch_id, lambda before: rows.select(F.lit(UPSERT).alias("op"), "*"), stream)

    def read(self, before: int | None = None, touching: DataFrame | None = None, columns: Sequence[str] | None = None,
             only: DataFrame | None = None):
        """All rows of finished deliveries; keys play no part."""
        done = self._batches(before=before)
        if not done:
            return None
        rows = T.StructType.fromJson(self._layout()["rows"])
        folders = [f"{self.changes_path}/batch={n}" for n in done]
        return self._load(rows.fields, self.changes_path, folders, None).select(*(columns or rows.names))


class DeltaTable(FolderTable):
    """The same changes, merged into a Delta table at ``path``.

    The change folders stay parquet: they make replays repeatable and feed the
    next layer. Needs the Delta library on the classpath.
    """

    def __init__(self, spark, path, keys, fmt="delta", **layout):
        super().__init__(spark, path, keys, "parquet", **layout)

    @property
    def changes_path(self) -> str:
        return f"{self.path}_changes"

    def exists(self) -> bool:
        return table_exists(self.spark, self.path, "delta")

    def read(
        self, before: int | None = None, touching: DataFrame | None = None, columns: Sequence[str] | None = None,
        only: DataFrame | None = None,
    ) -> DataFrame | None:
        """The table as it is now: a batch is merged once, after its rows are written, and the merge prunes by file."""
        if not self.exists():
            return None
        rows = self.spark.read.format("delta").load(self.path)
        return rows if only is None else rows.join(only, only.columns, "left_semi")

    def write(self, batch_id: int, rows: Callable[[Before], DataFrame], stream: str = "only") -> int:
        from delta.tables import DeltaTable as Target

        number = self._delivery(stream, batch_id)
        folder = f"{self.changes_path}/batch={number}"
        if not is_committed(self.spark, folder):
            self._deliver(rows(lambda touching=None, columns=None: self.read()), number)
        changes = self.delivered(number)
        columns = [c for c in changes.columns if c != "op"]
        if not self.exists():
            self.spark.createDataFrame([], changes.select(columns).schema).write.format(
                "delta").save(self.path)
        values = {c: f"s.{c}" for c in columns}
        (
            Target.forPath(self.spark, self.path).alias("t")
            .merge(changes.alias("s"), " AND ".join(f"t.{k} = s.{k}" for k in self.keys))
            .whenMatchedDelete(condition="s.op = 'd'")
            .whenMatchedUpdate(set=values)
            .whenNotMatchedInsert(condition="s.op = 's'", values=values)
            .execute()
        )
        return number


def open_table(spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet", **layout):
    return (DeltaTable if fmt == "delta" else FolderTable)(spark, path, keys, fmt, **layout)

