"""Filter interaction audit: one table of failing ids per filter, joined against every set of filters run before."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.session import scratch_dir

from .text import checkpointed, table

KEY = ["id", "has_id", "digest"]
COUNTS = ["n", "good", "toxic"]
WORDS_APART = r"[\x20\x09-\x0D]+"


def row_keys(docs: DataFrame, predicates: Mapping[str, Column], id_col: str, text_col: str, part: Column) -> DataFrame:
    """Narrow rows (key, part, n, one boolean per predicate): rows equal in id and text are one row that counts n.

    The key is the id, whether there is one, and the text's SHA-256, so rows that
    repeat an id with another text stay apart. A null text counts as empty. The
    predicates may use the columns ``words`` (array), ``text`` and those of ``docs``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.withColumn("text", text).withColumn("words", F.array_remove(F.split("text", WORDS_APART), ""))
    narrow = read.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.col(id_col).isNotNull().alias("has_id"),
        F.unhex(F.sha2("text", 256)).alias("digest"), part.alias("part"),
        *[F.coalesce(p, F.lit(False)).alias(f) for f, p in predicates.items()])
    return narrow.groupBy(*narrow.columns).agg(F.count("*").alias("n"))


def later_copies(rows: DataFrame) -> DataFrame:
    """Keys of rows whose text stands under a smaller id too; rows without an id are neither found nor count as smaller.

    The first id of each text is reduced before the shuffle, and rows meet it by
    text *and* id, so a text in a third of all rows is no hot key.
    """
    known = rows.where("has_id")
    firsts = known.groupBy("digest").agg(F.min("id").alias("id"))
    return known.join(firsts, ["digest", "id"], "left_anti").select(*KEY).distinct()


def with_labels(rows: DataFrame, labels: DataFrame, id_col: str, good: Column, toxic: Column) -> DataFrame:
    """``rows`` with ``good`` and ``toxic``: n where any label of the id says so, else 0. Null labels say nothing."""
    flags = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
                 F.max(F.coalesce(good, F.lit(False))).alias("good"), F.max(F.coalesce(toxic, F.lit(False))).alias("toxic")))
    counted = lambda c: F.when(F.col(c), F.col("n")).otherwise(F.lit(0).cast("long")).alias(c)
    known = rows.where("has_id").join(flags, "id", "left").select(*KEY, "part", "n", counted("good"), counted("toxic"))
    none = F.lit(0).cast("long")
    return known.union(rows.where("not has_id").select(*KEY, "part", "n", none.alias("good"), none.alias("toxic")))


def written(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables, each written to a folder of its own in the shared folder and read back."""
    folder, out = scratch_dir(next(iter(tables.values())).sparkSession, "filter-audit"), {}
    for name, frame in tables.items():
        frame.write.parquet(f"{folder}/{name}")
        out[name] = frame.sparkSession.read.parquet(f"{folder}/{name}")
    return out


def audit(rows: DataFrame, failing: Mapping[str, DataFrame]) -> DataFrame:
    """What each filter does after each set of others: per part, order and step.

    ``rows`` holds (key, part, counts), ``failing`` each filter's keys. Rows are
    paired with every set of filters that may have run before (a bit mask; 2^k of k
    filters, so k is to be small): a left-anti join with the failing tables of the
    set leaves its survivors. Of the rows that a left-semi join with one filter's
    table finds failing, a left-anti join with the tables of a set leaves those that
    this filter then removes, a left-semi join those that are gone already. All
    joins are on the key, so rows are dealt once and no key is hot. Parts, orders
    and steps without any such row hold zeros.
    """
    names = list(failing)
    bit = {name: 1 << i for i, name in enumerate(names)}
    whole = (1 << len(names)) - 1
    union = reduce(DataFrame.union, [failing[f].select(*KEY, F.lit(b).alias("bit")) for f, b in bit.items()])

    def against(states: DataFrame, mask: str, how: str) -> DataFrame:
        meets = [F.col(f"s.{k}") == F.col(f"f.{k}") for k in KEY] + [F.col(f"s.{mask}").bitwiseAND(F.col("f.bit")) != 0]
        return states.alias("s").join(union.alias("f"), meets, how)

    def counted(states: DataFrame, kind: str) -> DataFrame:
        return states.groupBy("part", "before", "next").agg(*[F.sum(c).alias(c) for c in COUNTS]).withColumn("kind", F.lit(kind))

    masks = lambda of: F.explode(F.array(*map(F.lit, of)))
    states = rows.withColumn("next", F.lit(0)).withColumn("before", masks(range(whole + 1)))
    fails = against(rows.withColumn("next", masks(bit.values())), "next", "left_semi")
    ahead = fails.withColumn("before", masks(range(whole + 1))).where(F.col("before").bitwiseAND(F.col("next")) == 0)
    parts = [counted(against(states, "before", "left_anti"), "kept"), counted(against(ahead, "before", "left_anti"), "removed"),
             counted(against(ahead, "before", "left_semi"), "redundant")]
    return _by_order(rows.select("part").distinct(), checkpointed(reduce(DataFrame.union, parts)), names, bit)


def _by_order(parts: DataFrame, counted: DataFrame, names: list[str], bit: Mapping[str, int]) -> DataFrame:
    """The counts by part, set and next filter, laid out by order and step; all of it is a few hundred rows a part."""
    k, whole, steps = len(names), (1 << len(names)) - 1, []
    for order in permutations(names):
        before = 0
        for step, name in enumerate(order, 1):
            steps.append(("".join(order), step, before, bit[name]))
            before |= bit[name]
    # Orders that put just the set ``before`` ahead of a filter.
    weight = F.element_at(F.array(*[F.lit(math.factorial(i) * math.factorial(k - 1 - i)) for i in range(k)]), F.bit_count("before") + 1)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    table_of = lambda kind: counted.where(F.col("kind") == kind)
    removed = table_of("removed").select("part", "before", "next", F.col("n").alias("removed"), F.col("good").alias("good_lost"),
                                         F.col("toxic").alias("toxic_lost"))
    redundant = table_of("redundant").select("part", "before", "next", F.col("n").alias("redundant"))
    kept = table_of("kept").select("part", F.col("before").alias("after"), F.col("n").alias("left"))
    per_filter = removed.groupBy("part", "next").agg(
        F.sum(F.col("removed") * weight).alias("shapley"),
        F.sum(F.when(F.col("before").bitwiseOR(F.col("next")) == whole, F.col("removed"))).alias("unique_fails"))
    columns = ("filter_order", "step", "before", "next")
    cells = F.from_json(F.lit(json.dumps([dict(zip(columns, s)) for s in steps])),
                        "array<struct<filter_order:string,step:int,before:int,next:int>>")
    laid = parts.select("part", F.explode(cells).alias("cell")).select("part", "cell.*")
    laid = laid.withColumn("after", F.col("before").bitwiseOR(F.col("next")))
    for more, on in ((removed, ["part", "before", "next"]), (redundant, ["part", "before", "next"]), (per_filter, ["part", "next"]),
                     (kept, ["part", "after"])):
        laid = laid.join(more, on, "left")
    return laid.select("part", "filter_order", "step", zero("left").alias("kept"),
                       *[zero(c).alias(c) for c in ("removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")])


def text_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> tuple[DataFrame, dict[str, DataFrame]]:
    """(rows, failing) for the five text filters: short, repetitive, capitals, signs, later copy.

    Rows are written to the shared folder once, so texts are read once. Null texts
    are empty texts, a null part is an empty one; other columns of any name are not looked at.
    """
    text, n_words, n_chars = F.col("text"), F.size("words").cast("long"), F.length("text").cast("long")
    capitals = n_chars - F.length(F.regexp_replace(text, "[A-Z]++", ""))
    predicates = {
        "A": n_words < 200,
        "B": 100 * F.size(F.array_distinct("words")).cast("long") < 50 * n_words,
        "C": 100 * capitals > 2 * n_chars,
        "D": text.rlike("[#$%&*|]"),
    }
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"), part.alias("part"))
    rows = written({"measured": row_keys(narrow, predicates, "id", "body", F.col("part"))})["measured"]
    failing = {f: rows.where(F.col(f)).select(*KEY) for f in predicates}
    failing["E"] = later_copies(rows)
    marked = with_labels(rows.drop(*predicates), labels, id_col, F.col("quality") == 1, F.col("toxic") == 1)
    stored = written({**failing, "rows": marked})
    return stored.pop("rows"), stored


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five filters in all 120 orders over whole ``documents``, by source."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return audit(*text_filters(docs.select("doc_id", "text", "source"), labels.select("doc_id", "quality", "toxic")))


OP11_SQL = r"""
with letters as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(f, b)),
read as (
  select doc_id, coalesce(text, '') as body, coalesce(source, '') as part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
firsts as (select body, min(doc_id) as first_id from read group by 1),
flags as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
          from labels where doc_id is not null group by 1),
masks as (
  select r.part, coalesce(l.good, 0) as good, coalesce(l.toxic, 0) as toxic,
         case when len(words) < 200 then 1 else 0 end
         + case when 100 * len(list_distinct(words)) < 50 * len(words) then 2 else 0 end
         + case when 100 * (length(r.body) - length(regexp_replace(r.body, '[A-Z]', '', 'g'))) > 2 * length(r.body) then 4 else 0 end
         + case when regexp_matches(r.body, '[#$%&*|]') then 8 else 0 end
         + case when f.first_id < r.doc_id then 16 else 0 end as mask
  from read r join firsts f on f.body = r.body left join flags l on l.doc_id = r.doc_id),
counts as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from masks group by 1, 2),
orders as (
  select a.f || b.f || c.f || d.f || e.f as filter_order, [a.b, b.b, c.b, d.b, e.b] as bits
  from letters a, letters b, letters c, letters d, letters e where a.b + b.b + c.b + d.b + e.b = 31
    and a.b <> b.b and a.b <> c.b and a.b <> d.b and a.b <> e.b and b.b <> c.b and b.b <> d.b and b.b <> e.b
    and c.b <> d.b and c.b <> e.b and d.b <> e.b),
steps as (
  select filter_order, s.step, bits[s.step] as bit, cast(list_sum(bits[:s.step]) as bigint) - bits[s.step] as before
  from orders, (select unnest([1, 2, 3, 4, 5]) as step) s),
cells as (
  select c.part, s.filter_order, s.step, s.bit,
         sum(case when (c.mask & (s.before | s.bit)) = 0 then c.n else 0 end) as kept,
         sum(case when (c.mask & s.bit) <> 0 and (c.mask & s.before) = 0 then c.n else 0 end) as removed,
         sum(case when (c.mask & s.bit) <> 0 and (c.mask & s.before) <> 0 then c.n else 0 end) as redundant,
         sum(case when c.mask = s.bit then c.n else 0 end) as unique_fails,
         sum(case when (c.mask & s.bit) <> 0 and (c.mask & s.before) = 0 then c.good else 0 end) as good_lost,
         sum(case when (c.mask & s.bit) <> 0 and (c.mask & s.before) = 0 then c.toxic else 0 end) as toxic_lost
  from counts c, steps s group by 1, 2, 3, 4)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
       cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, bit) as bigint) as shapley
from cells
"""
