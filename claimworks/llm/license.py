"""License scan: an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import table

# Names of licenses and the wordings of their notices and headers.
TEMPLATES = {
    "agpl": ("GNU Affero General Public License",),
    "apache": ("Licensed under the Apache License, Version 2.0",),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted",),
    "cc-by": ("Creative Commons Attribution license",),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0",),
    "gpl": ("GNU General Public License",),
    "lgpl": ("GNU Lesser General Public License",),
    "mit": ("Released under the MIT License",),
    "mit-grant": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software",),
    "mpl": ("Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0"),
    "reserved": ("All rights reserved",),
    "spdx": ("SPDX-License-Identifier",),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
}
# Fixed values of the base scan: phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
THRESHOLD = 0.85

# A word is a run of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII.
_OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_IN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _in_order(template: str) -> list[str]:
    return re.findall(_IN + "+", template.translate(str.maketrans(_UPPER, _LOWER)))


def tokens_of(template: str) -> list[str]:
    return sorted(set(_in_order(template)))


def wordings(templates: dict[str, tuple[str, ...]]) -> list[tuple[str, list[str], int]]:
    """(label, distinct words, width of a block) of every wording; a block is as many words as the wording has."""
    return [(label, tokens_of(t), len(_in_order(t))) for label, texts in templates.items() for t in texts]


def _any_of(tokens: list[str]) -> str:
    """Pattern for one whole word of ``tokens``, in either case."""
    return f"(?i)(?<!{_IN})(?:{'|'.join(map(re.escape, tokens))})(?!{_IN})"


def token_order(docs: DataFrame, vocabulary: list[str], text_col: str = "text") -> list[str]:
    """The template tokens, rarest first: by the number of texts that hold them, then by code point.

    The counts cover all texts; one row per template token reaches the driver.
    """
    found = F.regexp_extract_all(F.col(text_col), F.lit(_any_of(vocabulary)), F.lit(0))
    lowered = F.array_distinct(F.transform(found, lambda w: F.translate(w, _UPPER, _LOWER)))
    counts = dict(docs.select(F.explode(lowered).alias("token")).groupBy("token").count().collect())
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def block_matches(text: Column, templates: dict[str, tuple[str, ...]], order: list[str], threshold: float) -> Column:
    """Array of (block, label, containment): blocks that hold ``threshold`` of a wording's distinct words.

    A block is a window as wide as the wording, over line ends too, and starts (by
    its place among the text's words) at a word of it: one that starts before holds
    no more. With n distinct words, k = ceil(threshold * n) must be in the block. It
    can only match if it holds one of the n - k + 1 rarest (prefix), if k words of the
    wording stand near it (length), and if k of these do not come before it in the
    global order (position). What is left is counted exactly, from the rarest word.
    """
    rank = {w: i for i, w in enumerate(order)}
    every = []
    for label, words, width in wordings(templates):
        ranks, k = sorted(map(rank.get, words)), math.ceil(threshold * len(words) - 1e-9)
        every.append((label, ranks, k, ranks[:len(ranks) - k + 1], width))
    rare = sorted({r for *_, prefix, _ in every for r in prefix})
    reach = max(width for *_, width in every)
    pattern = _any_of([order[r] for r in rare])
    found = F.transform(F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(_IN + "+"), F.lit(0)),
                        lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    ordered = F.array(*map(F.lit, order))
    hits = F.transform(F.filter(found, lambda h: h.w.isin(order)), lambda h: F.struct(
        h.i.alias("i"), (F.array_position(ordered, h.w) - 1).cast("int").alias("r")))
    nothing = F.expr("CAST(array() AS ARRAY<STRUCT<block: INT, label: STRING, containment: DOUBLE>>)")

    def of_wording(near: Column, h: Column, label: str, ranks: list[int], k: int, prefix: list[int], width: int) -> Column:
        own = F.filter(near, lambda x: x.r.isin(ranks) & (x.i > h.i - width) & (x.i < h.i + width))

        def blocks(own: Column) -> Column:
            def block(s: Column) -> Column:
                held = F.array_distinct(F.transform(F.filter(own, lambda x: (x.i >= s.i) & (x.i < s.i + width)), lambda x: x.r))
                return F.struct(s.i.cast("int").alias("block"), held.alias("held"))

            starts = F.transform(F.filter(own, lambda s: (s.i <= h.i) & (s.i > h.i - width)), block)
            # A block is found from its rarest word, so once, but for repetitions of that word.
            whole = F.filter(starts, lambda b: (F.size(b.held) >= k) & (F.array_min(b.held) == h.r))
            return F.transform(whole, lambda b: F.struct(
                b.block.alias("block"), F.lit(label).alias("label"), (F.size(b.held) / F.lit(float(len(ranks)))).alias("containment")))

        def checked(own: Column) -> Column:
            left = F.size(F.array_distinct(F.transform(F.filter(own, lambda x: x.r >= h.r), lambda x: x.r)))
            return F.when((F.size(own) >= k) & (left >= k), blocks(own)).otherwise(nothing)

        return F.when(h.r.isin(prefix), F.transform(F.array(own), checked)[0]).otherwise(nothing)

    def of_text(hits: Column) -> Column:
        placed = F.filter(F.transform(hits, lambda h, j: F.struct(h.alias("h"), j.alias("j"))), lambda x: x.h.r.isin(rare))

        def of_anchor(x: Column) -> Column:
            first = F.greatest(x.j + 2 - reach, F.lit(1))
            near = F.slice(hits, first, x.j + reach + 1 - first)
            return F.flatten(F.transform(F.array(near), lambda near: F.concat(*[of_wording(near, x.h, *w) for w in every])))

        return F.array_sort(F.array_distinct(F.flatten(F.transform(placed, of_anchor))))

    return F.when(text.rlike(pattern), F.transform(F.array(hits), of_text)[0]).otherwise(nothing)


def scan(docs: DataFrame, text_col: str = "text", templates: dict[str, tuple[str, ...]] = TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``license_matches``, an array of (block, label, containment); null texts have none.

    A block is a window of a wording's length, named by its first word's place in
    the text. A column of that name is replaced; other columns and repeated rows stay.
    """
    order = token_order(docs, sorted({w for _, words, _ in wordings(templates) for w in words}), text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn("license_matches", block_matches(text, templates, order, threshold))


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(_IN + "+")).cast("long")


def _phrase(phrase: str) -> str:
    return f"(?i)(?<!{_IN}){f'{_OTHER}+'.join(phrase.split())}(?!{_IN})"


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text, n_words = F.col("text"), F.col("n_words")
    rows = scan(docs).withColumn("n_words", _words(text))
    firsts, lasts, counts, labels = [], [], [], []
    for phrase, label in PHRASES.items():
        pattern, rest = _phrase(phrase), F.split(text, _phrase(phrase), -1)
        holds = text.rlike("(?i)license") & text.rlike(pattern)
        counts.append(F.when(holds, F.regexp_count(text, F.lit(pattern))).otherwise(0))
        firsts.append(F.when(holds, _words(F.element_at(rest, 1))))
        lasts.append(F.when(holds, n_words - _words(F.element_at(rest, -1)) - len(phrase.split())))
        labels.append(F.when(holds, F.lit(label)))
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))
    matches = F.col("license_matches")
    every = F.array_sort(F.array_distinct(F.concat(base, F.transform(matches, lambda m: m.label))))
    best = F.coalesce(F.array_max(F.transform(matches, lambda m: m.containment)), F.lit(0.0))
    return rows.select("doc_id", "n_words", sum(counts, F.lit(0)).cast("long").alias("n_base"),
                       F.least(*firsts).alias("first_word"), F.greatest(*lasts).alias("last_word"),
                       F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
                       F.when(F.size(base) > 0, F.lit(1.0)).otherwise(best).alias("score"))


def _sql() -> str:
    words = "regexp_extract_all(translate({}, '" + _UPPER + "', '" + _LOWER + "'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    places = ["list_transform(list_filter(range(1, len(w) + 1), lambda i: "
              + " and ".join(f"w[i + {k}] = '{part}'" for k, part in enumerate(phrase.split()))
              + f"), lambda i: {{'at': i - 1, 'label': '{label}'}})" for phrase, label in PHRASES.items()]
    shared = [f"list_transform(list_filter(range(1, len(w) + 1), lambda i: list_contains({words_!r}, w[i])), "
              f"lambda i: {{'label': '{label}', 'share': len(list_intersect(w[i:i + {width - 1}], {words_!r}))::double / {len(words_)}}})"
              for label, words_, width in wordings(TEMPLATES)]
    return f"""
    with docs as (
      select doc_id, {words.format("coalesce(text, '')")} as w from documents),
    found as (
      select doc_id, len(w) as n_words, {' || '.join(places)} as p,
        list_filter({' || '.join(shared)}, lambda m: m.share >= {THRESHOLD} - 1e-9) as m from docs)
    select doc_id, n_words, len(p)::bigint as n_base,
      list_min(list_transform(p, lambda x: x.at))::bigint as first_word,
      list_max(list_transform(p, lambda x: x.at))::bigint as last_word,
      coalesce(array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label))), ','), '') as base_labels,
      coalesce(array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label)
        || list_transform(m, lambda x: x.label))), ','), '') as labels,
      case when len(p) > 0 then 1.0::double else coalesce(list_max(list_transform(m, lambda x: x.share)), 0.0)::double end as score
    from found"""


OP6_SQL = _sql()
