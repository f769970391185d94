"""Mixing sources to target weights by Efraimidis-Spirakis keys."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import checkpointed, table, unit

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in order, repeating
MAX_EPOCHS = 3
SMALL_PLAN = 100_000  # sources whose one row each is broadcast; more are joined by shuffle


_PLAIN = bytes(i for i in range(256) if i >= 128 or chr(i).isalpha() or chr(i).isspace())


def measured(text: Column) -> Column:
    """(size, quality) of a text: its words, and its weight in the draw.

    The weight is the share of bytes that are letters, beyond ASCII or white
    space, squared, and 0.05 at least. Null texts count as empty.
    """

    @F.pandas_udf("size long, quality double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            data = [(t or "").encode("utf-8", "surrogatepass") for t in part]
            signs = [len(d.translate(None, _PLAIN)) for d in data]
            yield pd.DataFrame({"size": [len(d.split()) for d in data],
                                "quality": [max(0.05, (1 - n / len(d)) ** 2) if d else 0.05 for n, d in zip(signs, data)]})

    return run(text)


def _ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``rank`` from 0 in the given order; one count per partition reaches the driver."""
    dealt = checkpointed(rows.repartitionByRange(*order).sortWithinPartitions(*order))
    dealt = dealt.withColumn("part", F.spark_partition_id())
    before, starts = 0, []
    for part, n in sorted(dealt.groupBy("part").count().collect()):
        starts += [F.lit(part), F.lit(before)]
        before += n
    if not starts:
        return dealt.withColumn("rank", F.lit(0)).drop("part")
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return dealt.withColumn("rank", F.create_map(*starts)[F.col("part")] + inside).drop("part")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = MAX_EPOCHS) -> DataFrame:
    """(source, n, source_size, target) from one row (source, n, source_size) per source.

    Sources by code point, nulls last, take the weights in turn and share the sum
    of all sizes; a target stops at ``cap`` times its source's size and the excess
    is shared again by weight among the others until none is above. All targets
    then are min(cap * size, level * weight) for one level.
    """
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = checkpointed(_ranked(sizes, F.col("source").asc_nulls_last()).withColumn("weight", turn))
    most = F.lit(float(cap)) * F.col("source_size")
    level, state = 0.0, None
    while True:
        full = F.lit(level) * F.col("weight") > most
        got = rows.agg(F.sum("source_size").cast("double"), F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight"))),
                       F.count(F.when(full, 1))).first()
        if not got[0] or not got[2] or state == got[3]:
            break
        level, state = (got[0] - (got[1] or 0.0)) / got[2], got[3] if level else None
    return rows.select("source", "n", "source_size", F.least(most, F.lit(level) * F.col("weight")).alias("target"))


def _cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, cut, left, ties): below the key ``cut`` a document gets its fractional words whole.

    ``left`` words remain for the ``ties`` documents at the cut. Keys are put into
    sqrt(n) buckets per source; sums per bucket find the one that holds the cut,
    and only its documents are ordered.
    """
    wanted = plan.where("rest > 0").select("source", "n", "rest")
    keyed = rows.join(wanted, rows.source.eqNullSafe(wanted.source)).select(
        rows.source, "key", "size", "rest",
        F.floor((1 - F.exp(-F.col("key"))) * F.ceil(F.sqrt("n"))).alias("bucket"))
    sums = keyed.groupBy("source", "bucket", "rest").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    hit = (sums.withColumn("upto", upto).where("upto >= rest AND upto - words < rest")
           .select(F.col("source").alias("s"), F.col("bucket").alias("b"), (F.col("upto") - F.col("words")).alias("before")))
    near = keyed.join(hit, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    at = near.groupBy("source", "key", "rest", "before").agg(F.sum("size").alias("words"), F.count("*").alias("ties"))
    run = F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("key"))
    return (at.withColumn("run", run).where("run >= rest AND run - words < rest")
            .select("source", F.col("key").alias("cut"), (F.col("rest") - F.col("run") + F.col("words")).alias("left"), "ties"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, seed: int = 7, whole_rows: bool = True) -> DataFrame:
    """One row (doc_id, row, size, source_size, target, taken) per row of ``docs``; ``row`` holds its columns.

    Without ``whole_rows`` there is no ``row`` and the texts are read once.

    A source takes floor(target / size) complete epochs. The rest of its target
    goes to documents in the order of their keys -ln(u) / quality until it is
    used up; the document at the cut gives the words still missing, and rows
    equal in id and text share them. ``u`` hashes id and text, so reruns agree.
    Null or empty texts have size 0; without words every target is 0.
    """
    key = -F.log(unit(F.lit(seed), F.col(id_col), F.col(text_col))) / F.col("m.quality")
    every = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col),
                        F.struct(*docs.columns).alias("row"), measured(F.col(text_col)).alias("m"))
    every = every.select("doc_id", "source", "row", F.col("m.size").alias("size"), key.alias("key"))
    rows = checkpointed(every.drop("row"))
    if not whole_rows:
        every = rows
    plan = targets(rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size")), weights)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("epochs", epochs).withColumn(
        "rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")))
    cuts = _cuts(rows, plan).withColumnRenamed("source", "s")
    plan = checkpointed(plan.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "n", "rest")
                        .withColumnRenamed("source", "of"))
    if plan.count() <= SMALL_PLAN:
        plan = F.broadcast(plan)
    more = (F.when(F.col("key") < F.col("cut"), F.col("size"))
            .when(F.col("key") == F.col("cut"), F.least(F.col("size"), F.floor(F.col("left") / F.col("ties"))))
            .otherwise(0))
    return every.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", *["row"] * whole_rows, "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + more).cast("long").alias("taken"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), whole_rows=False)
