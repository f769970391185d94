"""Words, hashes and keys shared by the text operators."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.session import scratch_dir

LOWER_ASCII = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text: str | None, lower: bool = False) -> list[bytes]:
    """Maximal runs without ASCII white space, as UTF-8; null has none."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.translate(LOWER_ASCII) if lower else data).split()


def hashes(tokens: list[bytes] | list[str]) -> np.ndarray:
    """XXH64 of each token's bytes (of text: its UTF-8)."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter(map(digest, tokens), np.uint64, len(tokens))


def mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """Hash of the ordered pair (a, b) of 64-bit hashes."""
    x = (a ^ (a >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive hashes, by doubling: a run of n is two of n/2."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    n, run, done, out = 1, h, 0, None
    while True:
        if width & n:
            part = run[done:]
            out = part if out is None else mix(out[: len(part)], part[: len(out)])
            done += n
        if done == width:
            return out[: len(h) - width + 1]
        run, n = mix(run[:-n], run[n:]), 2 * n


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; a null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds).cast("int")


def unit(*columns: Column) -> Column:
    """A repeatable number in (0, 1) from the columns' values."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` in the shared checkpoint folder; a lost executor costs nothing."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
