"""Seeded stratified split with exact per-class counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 65_536


def stratified_split(
    df: DataFrame, label: str, key: str, fraction: str = "0.2", seed: int = 42
) -> DataFrame:
    """Mark ``ceil(fraction * n)`` rows of each class as held out, in ``is_held_out``.

    Rows rank by the digest of (key, seed), then by the key. Ranking a class in
    one window would put a class holding most of the rows into one task; instead
    digests are dealt to ``SLOTS`` slots, a histogram per class says which slot
    holds the cut, and only that slot is ranked row by row. The cuts, one row a
    class, go to the rows: a join on the label would deal a class to one task.
    """
    digest = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    share = F.conv(F.substring("_digest", 1, 12), 16, 10).cast("double") / float(16**12)
    spread = df.withColumn("_digest", digest).withColumn("_slot", F.floor(share * SLOTS))

    of_class = Window.partitionBy(label)
    histogram = spread.groupBy(label, "_slot").agg(F.count(F.lit(1)).alias("_n")).withColumns({
        "_total": F.sum("_n").over(of_class), "_upto": F.sum("_n").over(of_class.orderBy("_slot"))}).withColumn(
        "_wanted", F.ceil(F.col("_total").cast("decimal(18,0)") * F.lit(fraction).cast("decimal(9,6)"))
    )
    cuts = histogram.filter(
        (F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_n") < F.col("_wanted"))
    ).select(
        F.col(label).alias("_label"), F.col("_slot").alias("_cut"),
        (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_left"),
    )

    placed = spread.join(F.broadcast(cuts), spread[label].eqNullSafe(cuts["_label"]), "left").drop("_label")
    clear = placed.filter(~F.col("_slot").eqNullSafe(F.col("_cut"))).withColumn(
        "is_held_out", F.coalesce(F.col("_slot") < F.col("_cut"), F.lit(False))
    )
    rank = F.row_number().over(of_class.orderBy("_digest", key))
    at_cut = placed.filter(F.col("_slot") == F.col("_cut")).withColumn(
        "is_held_out", rank <= F.col("_left")
    )
    columns = [*df.columns, "is_held_out"]
    return clear.select(*columns).unionByName(at_cut.select(*columns))
