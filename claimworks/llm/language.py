"""Language identification: the family first, then one-versus-one SVMs inside it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import fold_of, table, unit

# Language families by ISO 639-1 code. Any other code is its own family.
FAMILIES = {
    "germanic": "af da de en fy is lb nl no nb nn sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "indic": "bn gu hi mr ne pa si ur",
    "turkic": "az kk ky tr tt uz",
    "uralic": "et fi hu",
    "semitic": "am ar he mt",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
UNKNOWN = "und"
SLOTS = 4096
PER_LANGUAGE = 200  # bound on the different texts a language is learned from
LANGUAGES = 200  # bound on the languages that are learned: those with most different texts, then by code
VECTORS = 12_000  # bound on the vectors of all of them, three a text; more languages get fewer texts each
SNIPPET_BYTES = (40, 160)  # pieces of each training text that are learned too

_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def features(data: bytes) -> np.ndarray:
    """Hashed letter trigrams of a text: square roots of their shares, so of length one."""
    x = _FOLD[np.frombuffer(b" " + data + b" ", np.uint8)]
    x = x[np.concatenate([[True], (x[1:] != 32) | (x[:-1] != 32)])]
    if len(x) < 3:
        return np.zeros(SLOTS, np.float32)
    h = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(20)
    return np.sqrt(np.bincount(h, minlength=SLOTS) / len(h)).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, strength: float = 50.0, rounds: int = 100) -> np.ndarray:
    """Weights and bias of a linear SVM with squared hinge loss, by accelerated full gradients.

    Both classes weigh the same, however many examples they have.
    """
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = before = np.zeros(x.shape[1], np.float32)
    step = 1.0 / (1.0 + 4.0 * strength)
    for k in range(rounds):
        v = w + (k / (k + 3.0)) * (w - before)
        gap = np.maximum(0, 1 - y * (x @ v))
        before, w = w, v - step * (v - 2 * strength * (x.T @ (share * y * gap)))
    return w.astype(np.float32)


class Model:
    """Learned languages; ``family`` holds one SVM per family, ``pairs`` one per two languages of a family."""

    def __init__(self, x: np.ndarray, labels: list[str]):
        self.languages = sorted(set(labels))
        groups: dict[str, list[str]] = {}
        for code in self.languages:
            groups.setdefault(FAMILY.get(code, "=" + code), []).append(code)
        self.groups = sorted(groups.items())
        named = np.array(labels, object)
        of = np.array([FAMILY.get(code, "=" + code) for code in labels], object)
        self.family = np.array([svm(x, np.where(of == name, 1, -1).astype(np.float32)) for name, _ in self.groups]
                               if len(self.groups) > 1 else np.zeros((len(self.groups), SLOTS + 1)), np.float32)
        self.pairs = {}
        for _, codes in self.groups:
            for a, b in combinations(codes, 2):
                rows = (named == a) | (named == b)
                self.pairs[a, b] = svm(x[rows], np.where(named[rows] == a, 1, -1).astype(np.float32))

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        x = features(text.encode("utf-8", "surrogatepass"))
        sides = self.family[:, :-1] @ x + self.family[:, -1]
        best = int(np.argmax(sides))
        others = np.delete(sides, best)
        score = _sigmoid(3.0 * float(sides[best] - others.max())) if len(others) else 1.0
        codes = self.groups[best][1]
        margin = {code: [] for code in codes}
        for a, b in combinations(codes, 2):
            w = self.pairs[a, b]
            side = float(w[:-1] @ x + w[-1])
            margin[a].append(side)
            margin[b].append(-side)
        lang = max(codes, key=lambda c: (sum(m > 0 for m in margin[c]), sum(margin[c]), c))
        return lang, score * (_sigmoid(3.0 * min(margin[lang])) if margin[lang] else 1.0)


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + float(np.exp(-np.clip(x, -30, 30))))


def _pieces(data: bytes, key: int) -> list[bytes]:
    """The text and two pieces of it, cut at white space, at places its key chooses."""
    out = [data]
    for i, length in enumerate(SNIPPET_BYTES):
        if len(data) > 2 * length:
            start = (key // (i + 1)) % (len(data) - length)
            out.append(b" ".join(data[start:start + length].split()[1:-1]))
    return [p for p in out if p]


def fit(rows: DataFrame, lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Learn from at most about ``per_language`` different texts of each language, chosen by a hash.

    The driver gets at most about ``VECTORS`` vectors of ``SLOTS`` numbers, whatever
    the number of languages; of more than ``LANGUAGES`` the rest are not learned.
    Copies of a text count once, so a language that is mostly copies of few texts
    is learned from all of these.
    """
    rows = rows.select("text", F.col(lang_col).alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    different = rows.select("lang", F.xxhash64("text").alias("h")).distinct()
    counts = {r.lang: r["count"] for r in different.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()}
    if not counts:
        return Model(np.zeros((0, SLOTS), np.float32), [])
    per_language = min(per_language, max(1, VECTORS // (3 * len(counts))))
    share = F.create_map(*[F.lit(v) for code, n in counts.items() for v in (code, per_language / n)])
    some = rows.withColumn("u", unit(F.lit(4), "text")).where(F.col("u") < share[F.col("lang")])

    def featured(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            got = [(u, i, lang, features(piece).tobytes()) for text, lang, u in zip(part.text, part.lang, part.u)
                   for i, piece in enumerate(_pieces(text.encode("utf-8", "surrogatepass"), int(u * 2**52)))]
            yield pd.DataFrame(got, columns=["u", "piece", "lang", "x"])

    got = (some.mapInPandas(featured, "u double, piece int, lang string, x binary")
           .dropDuplicates(["u", "piece", "lang"]).limit(9 * per_language * len(counts)).collect())
    got.sort(key=lambda r: (r.lang, r.u, r.piece))
    x = np.array([np.frombuffer(r.x, np.float32) for r in got]).reshape(len(got), SLOTS)
    return Model(x, [r.lang for r in got])


def predicted(text: Column, model: Model) -> Column:
    """A struct (lang_pred, score) for a text column."""

    @F.pandas_udf("lang_pred string, score double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame([model.predict(t) for t in part], columns=["lang_pred", "score"])

    return run(text)


def identify(docs: DataFrame, id_col: str = "doc_id", folds: int = 3, held: int = 1) -> DataFrame:
    """One row (doc_id, row, held_out, lang_pred, score) per row of ``docs``; ``row`` holds its columns.

    Learned from text and lang of the rows whose id's crc32 modulo ``folds`` is
    not ``held``. Null texts and texts without a letter are ``und`` with score 0,
    and so is every text if no language could be learned.
    """
    held_out = fold_of(F.col(id_col), folds) == held
    model = fit(docs.where(~held_out).select("text", "lang"))
    got = docs.select(F.col(id_col).alias("doc_id"), F.struct(*docs.columns).alias("row"), held_out.alias("held_out"),
                      predicted(F.col("text"), model).alias("got"))
    return got.select("doc_id", "row", "held_out", "got.lang_pred", "got.score")


def keep_known(docs: DataFrame, min_score: float = 0.3) -> DataFrame:
    """The rows whose language is known with at least ``min_score``."""
    return identify(docs).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("row.*")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("row")
