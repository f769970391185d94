"""Order-independent document fingerprints: sums of wide vectors hashed from paragraphs."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import hashes, mix, table

EXACT = 16  # lanes modulo 2**64 that decide equality
LIKE = 256  # lanes modulo 2**16 that measure likeness
SHINGLE = 3


def paragraphs(text: str | None) -> list[str]:
    """Lines that hold more than white space."""
    return [p for p in (text or "").split("\n") if p.strip()]


class Fingerprint:
    """Sum of the vectors of a multiset of paragraphs; ``add`` with -1 takes paragraphs out again.

    A paragraph's vector has ``EXACT`` lanes from a digest of its text and
    ``LIKE`` lanes that count the paragraph's three-word runs, each with a sign
    in one lane (shorter paragraphs are one run). Sums do not depend on order.
    """

    def __init__(self, exact: np.ndarray | None = None, like: np.ndarray | None = None):
        self.exact = np.zeros(EXACT, np.uint64) if exact is None else exact
        self.like = np.zeros(LIKE, np.int16) if like is None else like

    def add(self, parts: Iterable[str], times: int = 1) -> Fingerprint:
        data = [p.encode("utf-8", "surrogatepass") for p in parts]
        if not data:
            return self
        digests = b"".join(hashlib.shake_128(d).digest(8 * EXACT) for d in data)
        exact = np.frombuffer(digests, "<u8").reshape(-1, EXACT).sum(0, dtype=np.uint64)
        tokens = [d.split() or [d] for d in data]
        h = hashes([w for ws in tokens for w in ws])
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        owner = np.repeat(np.arange(len(tokens)), sizes)
        runs = [mix(mix(h[:-2], h[1:-1]), h[2:])[owner[:-2] == owner[2:]]] if len(h) >= SHINGLE else []
        firsts, short = np.cumsum(sizes) - sizes, sizes < SHINGLE
        last = firsts[short] + sizes[short] - 1
        runs = np.concatenate([*runs, mix(h[firsts[short]], h[last]) + np.uint64(1)])
        signs = 1 - 2 * (runs >> np.uint64(63)).astype(np.int64)
        like = np.bincount((runs % np.uint64(LIKE)).astype(np.int64), signs, LIKE).astype(np.int64)
        exact = exact if times == 1 else exact * np.uint64(times % 2**64)
        return Fingerprint(self.exact + exact, (self.like + times * like).astype(np.int16))

    def edited(self, old: str | None, new: str | None) -> Fingerprint:
        """The fingerprint after ``old`` became ``new``: only changed paragraphs are hashed."""
        before, after = Counter(paragraphs(old)), Counter(paragraphs(new))
        return self.add((before - after).elements(), -1).add((after - before).elements())

    def text(self) -> str:
        return self.exact.astype("<u8").tobytes().hex() + self.like.astype("<i2").tobytes().hex()

    @staticmethod
    def parse(text: str) -> Fingerprint:
        data = bytes.fromhex(text)
        return Fingerprint(np.frombuffer(data[:8 * EXACT], "<u8"), np.frombuffer(data[8 * EXACT:], "<i2"))

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints; else about the share of three-word runs in common, 0 to 1."""
        if np.array_equal(self.exact, other.exact):
            return 1.0
        a, b = self.like.astype(np.int64), other.like.astype(np.int64)
        apart, size = int(((a - b) ** 2).sum()), int((a * a).sum() + (b * b).sum())
        return min(1.0, max(0.0, 1.0 - apart / size)) if size else 0.0


def of(text: str | None) -> Fingerprint:
    return Fingerprint().add(paragraphs(text))


def fingerprinted(text: Column) -> Column:
    """A text column's fingerprints as hex text; null counts as empty."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([of(t).text() for t in part], dtype=object)

    return run(text)


def next_documents(docs: DataFrame, spark: SparkSession) -> DataFrame:
    """Rows (doc_id, text, bucket, ahead) that hold every document and, last in its bucket, the one that follows.

    Documents stand in descending order of id (nulls last, ties by the text's
    hash) and are cut into buckets at quantiles of the ids. The first document of
    a bucket also goes, as ``ahead``, to the bucket before it, the very first to
    the last bucket. Each text moves once. Only bucket borders reach the driver.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / (4 * parts) for i in range(1, 4 * parts)], 20 * parts)).first()[0]
    borders = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(len(borders) - np.searchsorted(borders, ids.to_numpy(np.int64), "right")).astype("int32")

    rows = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), len(borders) + 1)
                           .otherwise(bucket(F.coalesce("doc_id", F.lit(0)))))
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", (-F.col("h").cast("decimal(20)")).alias("h"))
    heads = sorted(rows.groupBy("bucket").agg(F.max(order).alias("head")).collect())
    if not heads:
        return rows.withColumn("ahead", F.lit(False)).drop("h")
    first = [(heads[i - 1].bucket, h.head.doc_id, int(-h.head.h)) for i, h in enumerate(heads)]
    ahead = spark.createDataFrame(first, "to int, id long, hh long")
    found = rows.join(F.broadcast(ahead), rows.doc_id.eqNullSafe(ahead.id) & (rows.h == ahead.hh), "left")
    own, after = (F.struct(F.col(c).alias("bucket"), F.lit(flag).alias("ahead")) for c, flag in (("bucket", False), ("to", True)))
    copies = F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, after))
    return (found.select("doc_id", "text", "h", F.explode(copies).alias("at")).select("doc_id", "text", "h", "at.*")
            .repartition(parts, "bucket")
            .sortWithinPartitions("bucket", "ahead", F.col("doc_id").desc_nulls_last(), "h").drop("h"))


_COLUMNS = ("doc_id string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")


def _edit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replace the last half of each text by the start of the next row's, in a stream of ordered rows."""
    out, last = [], None
    for part in parts:
        for doc_id, text, bucket, ahead in zip(part.doc_id, part.text, part.bucket, part.ahead):
            here = of(text)
            if last is not None and last[2] == bucket and not last[4]:
                out.append(_compared(*last[:2], last[3], text, here))
            last = (doc_id, text, bucket, here, ahead)
            if len(out) >= 500:
                yield _frame(out)
                out = []
    yield _frame(out)


def _compared(doc_id, text: str, here: Fingerprint, after: str, following: Fingerprint) -> tuple:
    half = len(text) // 2
    changed = text[:len(text) - half] + after[:half]
    fp = here.edited(text, changed)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return (doc_id, len(text), digest, here.text(), fp.text(),
            here.likeness(fp), here.likeness(following))


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _COLUMNS.split(", ")]).astype({"n_chars": "int64"})


def edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that to the next document.

    Null texts count as empty. Empty texts have equal fingerprints (all lanes 0).
    Rows with equal ids follow each other by their texts' hashes; null ids come
    last; a lone document is its own next.
    """
    rows = next_documents(docs, docs.sparkSession)
    # Ids travel as text: pandas would turn long ids beside nulls into floats.
    found = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(_edit, _COLUMNS)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def op5_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
