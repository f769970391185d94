"""Small document tables with every awkward case, for the text operators."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, size string, score string, h string, fp string, _key string, rank string")
ODD = [
    (9001, None), (9002, ""), (9003, " \t\n\x0b\x0c\r "), (9004, "one"), (9005, "... !!! 123 \U0001F600"),
    (None, "a row without an id"), (None, "a row without an id"), (9006, "the same row twice"), (9006, "the same row twice"),
    (9006, "the same id but another text"), (9007, "naïve \U0001D54F café x"),
]


def sentence(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}x" for _ in range(n))


def rows(extra: list[tuple] = (), n: int = 60, seed: int = 1) -> list[tuple]:
    """(id, text, lang, source, ...) with copies, a long text, odd rows and clashing extra columns."""
    rng = random.Random(seed)
    texts = [(i, "\n".join(sentence(rng, rng.randrange(5, 60)) for _ in range(rng.randrange(1, 5)))) for i in range(n)]
    texts += [(n + i, texts[i % 7][1]) for i in range(20)]  # copies
    texts += [(n + 20, sentence(rng, 30_000, 20_000)), (n + 21, "again " * 500), (n + 22, "x" * 100_000)]
    texts += [*ODD, *extra]
    return [(i, t, ("en", "fr", None)[k % 3], (None, "b", "a", "é")[k % 4], None, *["junk"] * 7)
            for k, (i, t) in enumerate(texts)]


def table(spark, extra: list[tuple] = (), **more):
    return spark.createDataFrame(rows(extra, **more), SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
