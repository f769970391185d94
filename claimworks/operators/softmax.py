"""Softmax classifier on fixed features, fitted by mini-batch Adam; gradients are summed on the cluster."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.util import Identifiable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

# Fixed values of the optimiser.
FIRST, SECOND, TINY = 0.9, 0.999, 1e-8


@dataclass(frozen=True)
class Head:
    """Weights, one row per class with the bias last, and the optimiser's state."""

    weights: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    steps: int = 0

    @classmethod
    def start(cls, classes: int, features: int, seed: int | None) -> Head:
        """Even weights within 1 / sqrt(features); zeros without a seed."""
        shape = (classes, features + 1)
        bound = 1 / np.sqrt(max(1, features))
        weights = np.zeros(shape) if seed is None else np.random.default_rng(seed).uniform(-bound, bound, shape)
        return cls(weights, np.zeros(shape), np.zeros(shape))

    def step(self, gradient: np.ndarray, rate: float) -> Head:
        """The weights after one step of Adam."""
        k = self.steps + 1
        mean = FIRST * self.mean + (1 - FIRST) * gradient
        square = SECOND * self.square + (1 - SECOND) * gradient**2
        move = rate * (mean / (1 - FIRST**k)) / (np.sqrt(square / (1 - SECOND**k)) + TINY)
        return replace(self, weights=self.weights - move, mean=mean, square=square, steps=k)


def loss_and_gradient(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed cross-entropy of the rows and its gradient."""
    z = x @ weights[:, :-1].T + weights[:, -1]
    z -= z.max(1, keepdims=True)
    log_sum = np.log(np.exp(z).sum(1))
    rows = np.arange(len(y))
    p = np.exp(z - log_sum[:, None])
    loss = float((log_sum - z[rows, y]).sum())
    p[rows, y] -= 1
    return loss, np.hstack([p.T @ x, p.sum(0)[:, None]])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("features"))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(batch), -1)


def _labels(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("label_id")).to_numpy(zero_copy_only=False).astype(np.int64)


def batch_sums(rows: DataFrame, weights: np.ndarray) -> tuple[int, float, np.ndarray]:
    """(rows, summed loss, summed gradient) of one batch: one vector per task, added up by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, loss, gradient = 0, 0.0, np.zeros(weights.shape)
        for batch in batches:
            if len(batch):
                more, slope = loss_and_gradient(_matrix(batch), _labels(batch), weights)
                n, loss, gradient = n + len(batch), loss + more, gradient + slope
        if n:
            yield pa.RecordBatch.from_pydict({"sums": pa.array([[n, loss, *gradient.ravel()]], pa.list_(pa.float64()))})

    parts = rows.select("features", "label_id").mapInArrow(run, "sums array<double>")
    cells = parts.select(F.posexplode("sums").alias("place", "value")).groupBy("place").agg(F.sum("value").alias("total"))
    totals = cells.toArrow().sort_by("place").column("total").to_numpy()
    if not len(totals):
        return 0, 0.0, np.zeros(weights.shape)
    return int(totals[0]), float(totals[1]), totals[2:].reshape(weights.shape)


def deal(rows: DataFrame, key: str, batch_size: int, seed: int) -> tuple[DataFrame, int]:
    """Rows with ``step``, the batch they belong to by a hash of (key, seed), written by batch, and the number of batches.

    Batches hold about ``batch_size`` rows. A step reads the files of its batch only.
    """
    steps = max(1, -(-rows.count() // batch_size))
    place = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(steps)).cast("int")
    folder = scratch_dir(rows.sparkSession, "batches")
    dealt = rows.select("features", F.col("label_id").cast("int").alias("label_id"), place.alias("step"))
    dealt.hint("rebalance", "step").write.partitionBy("step").parquet(folder)
    return rows.sparkSession.read.parquet(folder), steps


def fit(
    rows: DataFrame, key: str, classes: int, epochs: int, rate: float, batch_size: int, seed: int,
    random_start: bool = False, reg: float = 0.0,
) -> list[tuple[Head, float]]:
    """(head, mean of the batches' mean losses) after each epoch over rows of (key, features, label_id).

    The driver holds the weights; the gradient of a batch is summed on the
    cluster. Each epoch takes the batches in another order, drawn from the seed.
    ``reg`` is the weight of half the squared weights, biases left out.
    """
    dealt, steps = deal(rows, key, batch_size, seed)
    width = dealt.select(F.size("features").alias("n")).first()
    head = Head.start(classes, width.n if width else 0, seed if random_start else None)
    order, out = np.random.default_rng(seed), []
    for _ in range(epochs):
        losses = []
        for step in order.permutation(steps):
            n, loss, gradient = batch_sums(dealt.where(F.col("step") == int(step)), head.weights)
            if n:
                penalty = np.hstack([reg * head.weights[:, :-1], np.zeros((classes, 1))])
                head = head.step(gradient / n + penalty, rate)
                losses.append(loss / n)
        out.append((head, float(np.mean(losses)) if losses else 0.0))
    return out


def predictions(rows: DataFrame, key: str, heads: Sequence[Head]) -> DataFrame:
    """(key, label_id, epoch, prediction) of every row under the head of each epoch, in one pass over the rows."""
    weights = [h.weights for h in heads]
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch) if len(batch) else np.zeros((0, 1))
            found = [np.argmax(x @ w[:, :-1].T + w[:, -1], 1) for w in weights] if len(batch) else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_labels(batch), pa.int32()),
                 pa.array([list(p) for p in zip(*found)], pa.list_(pa.int32()))], ["key", "label_id", "found"])

    scored = rows.select(F.col(key).alias("key"), "features", F.col("label_id").cast("int").alias("label_id")).mapInArrow(
        run, f"key {kind}, label_id int, found array<int>")
    return scored.select(F.col("key").alias(key), "label_id", F.posexplode("found").alias("place", "prediction")).select(
        key, "label_id", (F.col("place") + 1).cast("int").alias("epoch"), "prediction")


def confusion(scored: DataFrame) -> DataFrame:
    """(epoch, label_id, prediction, n): one row per pair of classes that occurs."""
    return scored.groupBy("epoch", "label_id", "prediction").agg(F.count("*").alias("n"))


def spark_model(spark: SparkSession, head: Head, features: str = "vector", label: str = "label_id") -> LogisticRegressionModel:
    """The head as a Spark model that can be saved, loaded and put into a pipeline."""
    context, (classes, width) = spark.sparkContext, head.weights.shape
    matrix = DenseMatrix(classes, width - 1, head.weights[:, :-1].ravel(order="F"))
    made = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"softmax_{Identifiable().uid}", _py2java(context, matrix), _py2java(context, DenseVector(head.weights[:, -1])), classes, True)
    model = LogisticRegressionModel(made)
    model.setFeaturesCol(features)
    return model
