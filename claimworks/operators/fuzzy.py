"""Join of texts that differ by a few edits: what both become by leaving characters out finds the pairs, the edit distance decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _shortened(text: Column, edits: int) -> Column:
    """Hashes of all texts that leaving out up to ``edits`` characters gives, the text itself among them."""
    def one_less(t: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1)))  # an empty text stays one
        return F.transform(places, lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))

    levels = [F.array(text)]
    for _ in range(edits):
        levels.append(F.array_distinct(F.flatten(F.transform(levels[-1], one_less))))
    return F.array_distinct(F.transform(F.concat(*levels), lambda t: F.xxhash64(t)))


def near_texts(left: DataFrame, right: DataFrame, edits: int = 2) -> DataFrame:
    """Rows (a, b, distance): every distinct ``a`` of ``left`` and ``b`` of ``right`` (one column each) within ``edits`` edits.

    Texts within k edits become the same text if up to k fitting characters are
    left out of each, so they share a token; nothing else is compared. A token
    names nearly the whole text, so however common a beginning or an n-gram is,
    those that meet are near each other. A text of n characters has some n**k / k!
    tokens. Nulls match nothing. All pairs within the distance are found. The join
    is hinted: the planner knows a side's size only from before it is exploded, and
    would broadcast all tokens of a side that was small as texts.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # texts are few bytes, their tokens many
    sides = []
    for frame, name in ((left, "a"), (right, "b")):
        text = F.col(frame.columns[0])
        texts = frame.select(text.alias(name)).where(text.isNotNull()).distinct().repartition(tasks)
        sides.append(texts.select(name, F.explode(_shortened(F.col(name), edits)).alias("token")))
    near = F.abs(F.length("a") - F.length("b")) <= edits
    pairs = sides[0].join(sides[1].hint("merge"), "token").where(near).select("a", "b", F.levenshtein("a", "b", edits).alias("distance"))
    return pairs.where("distance >= 0").distinct()
