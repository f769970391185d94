"""SimHash near-duplicates: segment popcounts, a grid join, an exact check."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .text import checkpointed, table, words

SEED = 42
GROUPS = 8  # bytes of the packed embedding, four 2-bit segments each


def fingerprint(text: str | None, width: int) -> int:
    """Majority bits over the XXH64 of all ``width``-word shingles, repeats included.

    Fewer words make one shingle of them all; no word gives zero.
    """
    tokens = words(text, lower=True)
    if not tokens:
        return 0
    joined, span = b" ".join(tokens), min(width, len(tokens))
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(tokens) - span + 1].tolist()
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(starts)
    ends = ends[span - 1:].tolist()
    for i in range(0, n, 65536):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[i:i + 65536], ends[i:i + 65536])], ">u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def with_fingerprints(text: Column, width: int) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([fingerprint(t, width) for t in part], dtype="int64")

    return run(text)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _embedding(fp: Column) -> Column:
    """Popcounts (0 to 2) of the 32 segments of two bits, packed two bits each."""
    odd, high = F.lit(0x5555555555555555), F.shiftrightunsigned(fp, 1)
    two = F.shiftleft(fp.bitwiseAND(high).bitwiseAND(odd), 1)
    return two.bitwiseOR(fp.bitwiseXOR(high).bitwiseAND(odd))


def links(classes: DataFrame, max_bits: int) -> DataFrame:
    """(a, b) for all pairs of different fingerprints at ``max_bits`` or fewer differing bits.

    The popcount vectors' Manhattan distance never exceeds the bit distance, so a
    linked pair differs in at most ``max_bits`` of the eight groups of segments.
    A grid cell is a choice of the other groups with their counts; linked
    fingerprints share at least one. Only the first shared cell, in the order of
    the groups, reports a pair, and it checks the bits themselves.
    """
    keep = GROUPS - max_bits
    if keep < 1:
        raise ValueError(f"at most {GROUPS - 1} differing bits")
    cells = []
    for groups in combinations(range(GROUPS), keep):
        mask = _signed(sum(255 << (8 * g) for g in groups))
        cells.append(F.struct(F.lit(sum(1 << g for g in groups)).cast("short").alias("groups"),
                              F.col("e").bitwiseAND(F.lit(mask)).alias("counts")))
    rows = (classes.select("fp", _embedding(F.col("fp")).alias("e"))
            .select("fp", F.explode(F.array(*cells)).alias("cell")).select("fp", "cell.*"))
    left, right = rows.alias("l"), rows.alias("r")
    far = _embedding(F.col("l.fp")).bitwiseXOR(_embedding(F.col("r.fp")))
    same = sum((F.when(far.bitwiseAND(F.lit(_signed(255 << (8 * g)))) == 0, 1 << g).otherwise(0)
                for g in range(GROUPS)), F.lit(0))
    # The first ``keep`` equal groups are this cell's: no equal group below its top is left out.
    below = F.expr("CAST(pow(2, floor(log2(l.groups)) + 1) AS INT) - 1")
    return left.join(right, (F.col("l.groups") == F.col("r.groups")) & (F.col("l.counts") == F.col("r.counts"))
                     & (F.col("l.fp") < F.col("r.fp"))
                     & (F.bit_count(F.col("l.fp").bitwiseXOR(F.col("r.fp"))) <= max_bits)
                     & (same.bitwiseAND(below) == F.col("l.groups"))
                     ).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4,
                max_bits: int = 4) -> DataFrame:
    """One row (doc_id, row_key, fp, component_id, first_key) per row of ``docs``.

    ``component_id`` is the smallest id among all rows reachable over links,
    null where none has an id. ``row_key`` hashes id and text; ``first_key`` is
    the key of the component's first row by id (nulls last), then key. Equal
    fingerprints form one class; only classes are linked, whatever their size.
    """
    rows = checkpointed(docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(id_col, text_col).alias("row_key"),
        with_fingerprints(F.col(text_col), width).alias("fp")))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    classes = checkpointed(rows.groupBy("fp").agg(F.min(order).alias("first")))
    roots = components(links(classes, max_bits))
    rooted = (classes.join(roots, classes.fp == roots.node, "left")
              .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = rooted.join(firsts, "root").select("fp", "least")
    return rows.join(named, "fp").select(
        "doc_id", "row_key", "fp", F.col("least.doc_id").alias("component_id"),
        F.col("least.row_key").alias("first_key"))


def drop_near_copies(docs: DataFrame, width: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of every component of ``docs``: the first by id (nulls last).

    Rows that repeat id and text count as one.
    """
    survivors = (near_groups(docs, width=width, max_bits=max_bits)
                 .where("row_key = first_key").select(F.col("row_key").alias("_kept")).distinct())
    key = F.xxhash64("doc_id", "text")
    kept = docs.select(F.struct(*docs.columns).alias("row"), key.alias("_key")).join(
        survivors, F.col("_key") == F.col("_kept"), "left_semi")
    return kept.dropDuplicates(["_key"]).select("row.*")


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
