"""Sorted arrays keyed by 64-bit hashes: gathered by Spark, kept in the shared folder, memory-mapped by workers.

Workers pack what a run of rows yields into one blob per shard (a range of
hashes), after combining equal keys. One task per shard merges the blobs and
writes the arrays. Shards are as many as the input's size asks for, so a merge
needs about the same memory at any size, and a hot key adds one entry per blob.
"""

from __future__ import annotations

import io
import os
import pickle
import tempfile
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.session import scratch_dir

SHARD_BYTES = 32 << 20  # text bytes behind one shard
ENTRIES = 1_500_000  # entries a worker combines at a time

Columns = tuple[np.ndarray, ...]


def shards_for(docs: DataFrame, text_col: str = "text") -> int:
    """Shards for the texts of ``docs``: one per SHARD_BYTES."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(4, -(-size // SHARD_BYTES))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def small(x: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the narrowest type that holds them."""
    return x.astype(np.min_scalar_type(int(x.max()))) if len(x) else x.astype(np.uint8)


def blobs(shard: np.ndarray, columns: Columns, shards: int, *more) -> Iterator[tuple[int, bytes]]:
    """(shard, blob) for columns in the order of their shards; ``more`` goes into each blob, first."""
    ends = np.searchsorted(shard, np.arange(shards + 1))
    for i in np.flatnonzero(np.diff(ends)):
        yield int(i), pickle.dumps((*more, *(c[ends[i]:ends[i + 1]] for c in columns)), protocol=5)


def length(shard: int, n: int) -> pd.DataFrame:
    return pd.DataFrame([(shard, int(n))], columns=["shard", "n"])


def frame(rows: list[tuple[int, bytes]]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["shard", "data"])


BLOBS = "shard int, data binary"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh shared folder, named with its file system: what Spark takes a bare path for, workers do too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark, name))
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.makeQualified(path).toString()


def _open(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a folder's scheme, and the folder's path there."""
    scheme, colon, path = folder.partition(":")
    if not colon or "/" in scheme:
        raise ValueError(f"{folder} names no file system; see shared_folder")
    if scheme == "file":
        return arrow_fs.LocalFileSystem(), "/" + path.lstrip("/")
    if scheme in ("s3a", "s3n"):  # Hadoop's names for it
        scheme = "s3"
    return arrow_fs.FileSystem.from_uri(f"{scheme}:{path}")


def write(folder: str, name: str, array: np.ndarray) -> None:
    """Write one array; a repeated or second attempt replaces it by the same."""
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    buffer = io.BytesIO()
    np.save(buffer, array)
    with system.open_output_stream(part) as out:
        out.write(buffer.getbuffer())
    system.move(part, f"{path}/{name}.npy")


MAPPED = 20_000  # arrays a worker keeps mapped: under a third of the mappings Linux allows a process
_mapped: OrderedDict[str, np.ndarray] = OrderedDict()


def _map(path: str) -> np.ndarray:
    """A saved array, mapped. The mapping outlives its file handle, which is closed at once."""
    with pa.memory_map(path) as file:
        data = file.read_buffer()
    head = io.BytesIO(data[:256])
    read = np.lib.format.read_array_header_1_0 if np.lib.format.read_magic(head) == (1, 0) else np.lib.format.read_array_header_2_0
    shape, _, kind = read(head)
    return np.frombuffer(data, kind, shape[0], head.tell())


def mapped(folder: str, name: str) -> np.ndarray:
    """One array, memory-mapped; from a store without local paths over an unnamed local copy.

    The latest ``MAPPED`` are kept; one that no caller holds any longer is unmapped.
    """
    key = f"{folder}/{name}"
    if key in _mapped:
        _mapped.move_to_end(key)
        return _mapped[key]
    system, path = _open(folder)
    if isinstance(system, arrow_fs.LocalFileSystem):
        array = _map(f"{path}/{name}.npy")
    else:
        handle, local = tempfile.mkstemp(suffix=".npy")
        with os.fdopen(handle, "wb") as out, system.open_input_stream(f"{path}/{name}.npy") as data:
            while chunk := data.read(1 << 24):
                out.write(chunk)
        array = _map(local)
        os.unlink(local)
    _mapped[key] = array
    while len(_mapped) > MAPPED:
        _mapped.popitem(last=False)
    return array


def merged(parts: DataFrame, merge: Callable[[int, list[Columns]], pd.DataFrame], shards: int,
           schema: str = "shard int, n long") -> DataFrame:
    """``merge(shard, columns of its blobs)`` once per shard; it writes arrays and returns rows about them.

    There are three times as many tasks as shards, so that few get two of them, at any size of the input.
    """

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return merge(int(key[0]), [pickle.loads(d) for d in part.data])

    return parts.repartition(3 * shards, "shard").groupBy("shard").applyInPandas(run, schema)


class Lookup:
    """Sorted ``key`` arrays of all shards with further columns beside them."""

    def __init__(self, folder: str, shards: int, lengths: dict[int, int]):
        self.folder, self.shards = folder, shards
        self.present = np.array(sorted(s for s, n in lengths.items() if n), np.int64)
        ends = np.cumsum(np.array([lengths[s] for s in self.present], np.int64))
        self.starts = np.append(np.int64(0), ends)
        self.size = int(self.starts[-1])

    def find(self, keys: np.ndarray, *columns: str, skip: int = 0) -> tuple[np.ndarray, ...]:
        """For sorted keys: place in the whole table or -1, then the columns' values there (0 elsewhere).

        Where a key stands several times, ``skip`` tells which of its places is
        asked for. Only shards in which a key may lie are opened.
        """
        place = np.full(len(keys), -1, np.int64)
        values = [np.zeros(len(keys), np.int64) for _ in columns]
        shard = shard_of(keys, self.shards).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(keys)]]) if len(keys) else np.zeros(1, int)
        for a, b in zip(cuts[:-1], cuts[1:]):
            s = int(shard[a])
            i = np.searchsorted(self.present, s)
            if i < len(self.present) and self.present[i] == s:
                table = mapped(self.folder, f"key-{s}")
                there = np.searchsorted(table, keys[a:b]) + skip
                at = np.minimum(there, len(table) - 1)
                hit = np.flatnonzero((table[at] == keys[a:b]) & (there < len(table)))
                place[a + hit] = self.starts[i] + at[hit]
                for value, name in zip(values, columns):
                    value[a + hit] = mapped(self.folder, f"{name}-{s}")[at[hit]]
        return place, *values
