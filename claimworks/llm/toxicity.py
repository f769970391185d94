"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import LOWER_ASCII, fold_of, table, unit

POSITIVES = 2000  # bound on the confirmed examples that are learned from
UNLABELLED = 4000  # bound on the unlabelled texts
LEAST_TEXTS = 4  # confirmed texts of the sample a feature must stand in
LEAST_Z = 3.0  # and by how many standard errors its share must exceed that among the unlabelled
PREFIX = 4  # bytes of the word beginnings that are features too
DEFAULT_PRIOR = 0.05

_SEPARATED = bytes.maketrans(bytes(i for i in range(128) if not chr(i).isalnum()), b" " * 66)


def features(text: str | None) -> set[bytes]:
    """Lower-cased (A-Z) words between ASCII signs and the beginnings of longer ones, each once."""
    data = (text or "").encode("utf-8", "surrogatepass")
    found = set(data.translate(LOWER_ASCII).translate(_SEPARATED).split())
    return found | {w[:PREFIX] + b"*" for w in found if len(w) > PREFIX}


def telling(rows: list[np.ndarray], positive: np.ndarray, size: int) -> np.ndarray:
    """Features that stand in confirmed texts clearly more often than in unlabelled ones."""
    p, u = (np.bincount(np.concatenate([np.zeros(0, np.int64), *(r for r, k in zip(rows, positive) if k == kind)]),
                        minlength=size) for kind in (True, False))
    n, m = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    share = (p + u + 1) / (n + m + 2)
    z = (p / n - u / m) / np.sqrt(share * (1 - share) * (1 / n + 1 / m))
    return np.flatnonzero((p >= LEAST_TEXTS) & (z >= LEAST_Z))


def nnpu(rows: list[np.ndarray], positive: np.ndarray, size: int, prior: float, rounds: int = 400,
         rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk of a linear classifier with logistic loss.

    The risk on negatives is what the unlabelled texts show less ``prior`` times
    what the positives show; where that estimate falls below zero the step undoes
    it instead of following it. Texts are sets of features (``rows``).
    """
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    owner, index = np.repeat(np.arange(len(rows)), lengths), np.concatenate(rows)
    p, u = positive.astype(float) / max(1, positive.sum()), (~positive).astype(float) / max(1, (~positive).sum())
    theta = np.zeros(size + 1)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    theta[-1] = np.log(prior / (1 - prior))
    for k in range(1, rounds + 1):
        z = np.bincount(owner, theta[index], len(rows)) + theta[-1]
        s = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
        negative = (u - prior * p) @ np.logaddexp(0, z)
        slope = (u - prior * p) * s
        slope = prior * p * (s - 1) + slope if negative >= 0 else -slope
        g = np.bincount(index, slope[owner], size)
        g = np.append(g + decay * theta[:-1], slope.sum())
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta -= rate * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
    return theta[:-1], float(theta[-1])


class Model:
    """Word weights and a bias; a text's score is a probability."""

    def __init__(self, weights: dict[bytes, float], bias: float):
        self.weights, self.bias = weights, bias

    def score(self, text: str | None) -> float:
        z = self.bias + sum(sorted(map(self.weights.__getitem__, features(text) & self.weights.keys())))
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None, positives: int = POSITIVES,
        unlabelled: int = UNLABELLED) -> Model:
    """Learn from (doc_id, text) and (doc_id, toxic).

    Confirmed examples are documents all of whose labels are 1; the unlabelled
    texts are drawn from all documents. Both samples are bounded, by hashes of
    the ids. Without ``prior`` it is the share of confirmed among labelled ids.
    Without a confirmed example every score is the prior.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    n, n_toxic = marked.agg(F.count("*"), F.count(F.when(F.col("toxic") == 1, 1))).first()
    prior = min(0.9, max(0.001, prior if prior is not None else n_toxic / n if n else DEFAULT_PRIOR))
    if not n_toxic:
        return Model({}, float(np.log(prior / (1 - prior))))
    u = unit(F.lit(3), "doc_id")
    confirmed = marked.where("toxic = 1").where(u < positives / n_toxic).select("doc_id").limit(2 * positives)
    total = docs.count()
    some = docs.select("doc_id", "text", u.alias("u"))
    drawn = (some.join(F.broadcast(confirmed), "doc_id").select(F.lit(True).alias("positive"), _joined("text")).limit(2 * positives)
             .unionByName(some.where(F.coalesce("u", F.lit(0.5)) < unlabelled / max(1, total))
                          .select(F.lit(False).alias("positive"), _joined("text")).limit(2 * unlabelled)))
    texts = sorted(drawn.distinct().collect())  # copies count once; sorted, so reruns agree
    names: dict[bytes, int] = {}
    rows = [np.array([names.setdefault(w, len(names)) for w in bytes(r.features).split()], np.int64) for r in texts]
    positive = np.array([r.positive for r in texts])
    chosen = telling(rows, positive, len(names))
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    weights, bias = nnpu([p[p >= 0] for p in (place[r] for r in rows)], positive, len(chosen), prior)
    words = list(names)
    return Model({words[i]: float(w) for i, w in zip(chosen, weights)}, bias)


def _joined(text: str) -> Column:
    """A text's features in order, joined by spaces."""

    @F.pandas_udf("binary")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([b" ".join(sorted(features(t))) for t in part], dtype=object)

    return run(text).alias("features")


def scored(text: Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([model.score(t) for t in part], dtype="float64")

    return run(text)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """One row (doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text).

    Labels of ids whose crc32 modulo ``folds`` is ``held`` are not learned from,
    nor are those documents' texts. A null or empty text scores as a text without
    known words.
    """
    held_out = fold_of(F.col("doc_id"), folds) == held
    model = fit(docs.where(~held_out), labels.where(~held_out))
    score = scored(F.col("text"), model)
    return (docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents").select("doc_id", "text"),
                    table(spark, sf_dir, "labels").select("doc_id", "toxic"))
