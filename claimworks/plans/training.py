"""Classifier on labelled images: features, split, fit, scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import training_label
from ..operators import softmax
from ..operators.labels import label_indexer
from ..operators.split import stratified_split
from ..session import scratch_dir
from ..sources.readers import image_folder, scan
from ..sources.sinks import append, overwrite

# Channel means and deviations (red, green, blue).
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)


def _shares(length: int, size: int) -> np.ndarray:
    """(size, length) weights: how much of each pixel lies under each output pixel, rows summing to 1.

    Shrinking averages the covered area, so every pixel counts; enlarging interpolates linearly.
    """
    if size >= length:
        at = np.clip((np.arange(size) + 0.5) * length / size - 0.5, 0, length - 1)
        return np.maximum(0, 1 - abs(at[:, None] - np.arange(length)))
    edges = np.arange(size + 1) * length / size
    under = np.minimum(edges[1:, None], np.arange(length) + 1) - np.maximum(edges[:-1, None], np.arange(length))
    return np.maximum(0, under) * size / length


def _resize(image: np.ndarray, size: int) -> np.ndarray:
    """(height, width, channels) to (size, size, channels)."""
    rows = np.tensordot(_shares(image.shape[0], size), image, 1)
    return np.tensordot(_shares(image.shape[1], size), rows, (1, 1)).transpose(1, 0, 2)


def pixel_features(size: int):
    """UDF (height, width, channels, pixels) to 3*size*size normalised floats.

    Pixels are interleaved rows, blue-green-red with optional alpha, or grey.
    """
    mean, std = np.array(CHANNEL_MEAN), np.array(CHANNEL_STD)

    def one(height: int, width: int, channels: int, pixels: bytes) -> np.ndarray | None:
        if pixels is None or height <= 0 or width <= 0:
            return None
        raster = np.frombuffer(pixels, dtype=np.uint8).reshape(height, width, channels)
        rgb = np.repeat(raster, 3, axis=2) if channels == 1 else raster[:, :, 2::-1]
        scaled = (_resize(rgb.astype("float64"), size) / 255.0 - mean) / std
        return scaled.astype("float32").ravel()

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def features(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.Series]:
        for parts in batches:
            yield pd.Series([one(*row) for row in zip(*parts)], dtype=object)

    return features


def features_of(images: DataFrame, size: int) -> DataFrame:
    """(path, label, height, width, channels, pixels) to (path, label, features).

    Images without a label or that did not decode are left out; ``undecoded`` lists the latter.
    """
    features = pixel_features(size)("height", "width", "channels", "pixels")
    return (
        images.filter((F.col("label") != "") & F.col("pixels").isNotNull())
        .select("path", "label", features.alias("features"))
    )


def folder_images(spark: SparkSession, folder: str) -> DataFrame:
    """``<n>-<label>[ (<k>)].png`` files, decoded in the JVM; files that do not decode have null pixels."""
    return image_folder(spark, folder).withColumn("label", training_label("path"))


def table_images(images: DataFrame, folder: str) -> DataFrame:
    """Labelled rows of the silver training table, decoded in the JVM from the files at their paths.

    Every labelled row stays: one whose file is gone, was moved or does not decode
    has null pixels and is listed by ``undecoded``.
    """
    labelled = images.filter(F.col("label") != "").select(
        F.col("path").alias("_path"), without_scheme(F.col("path")).alias("_name"), "label")
    decoded = image_folder(images.sparkSession, folder, recursive=True)
    # The image source writes a path as a URI; the table holds it as it is.
    plain = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    found = labelled.join(decoded.withColumn("_name", without_scheme(plain)), "_name", "left")
    return found.withColumn("path", F.coalesce("path", "_path")).drop("_name", "_path")


def without_scheme(path: Column) -> Column:
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")


@dataclass(frozen=True)
class Params:
    epochs: int = 5
    lr: float = 0.001
    batch_size: int = 32
    reg: float = 0.0
    fraction: str = "0.2"
    seed: int = 42
    img_size: int = 224
    random_start: bool = False  # the loss is convex: zeros start as well


@dataclass(frozen=True)
class Run:
    model: PipelineModel    # of the last epoch
    metrics: DataFrame      # (epoch, train_loss, val_accuracy)
    params: DataFrame       # (name, value)
    labels: DataFrame       # (label_id, label)
    confusion: DataFrame    # (epoch, label_id, prediction, n) of the held-out rows
    predictions: DataFrame  # (key, label_id, epoch, prediction) of the held-out rows


def train(df: DataFrame, key: str, params: Params = Params()) -> Run:
    """Fit on (key, label, features) with a stratified hold-out, scored after every epoch.

    Features stay distributed; the driver sees the class list, the weights, the
    loss per epoch and one count per epoch and pair of classes.
    """
    spark = df.sparkSession
    df = df.select(key, "label", F.col("features").cast("array<double>").alias("features"))
    indexer = label_indexer(df)
    if not indexer.labels:
        raise ValueError("there is no labelled row to train on")
    folder = scratch_dir(spark, "training")
    split = stratified_split(indexer.transform(df), "label", key, params.fraction, params.seed)
    overwrite(split, f"{folder}/split")
    split = scan(spark, f"{folder}/split")
    fitted = softmax.fit(
        split.filter("not is_held_out"), key, len(indexer.labels), params.epochs, params.lr, params.batch_size,
        params.seed, params.random_start, params.reg)
    overwrite(softmax.predictions(split.filter("is_held_out"), key, [head for head, _ in fitted]), f"{folder}/predictions")
    scored = scan(spark, f"{folder}/predictions")
    pairs = softmax.confusion(scored).collect()
    metrics = []
    for epoch, (_, loss) in enumerate(fitted, start=1):
        counts = [(r["n"], r["label_id"] == r["prediction"]) for r in pairs if r["epoch"] == epoch]
        total = sum(n for n, _ in counts)
        metrics.append((epoch, loss, 100.0 * sum(n for n, right in counts if right) / total if total else None))
    model = softmax.spark_model(spark, fitted[-1][0])
    return Run(
        PipelineModel([indexer, model]),
        spark.createDataFrame(metrics, "epoch int, train_loss double, val_accuracy double"),
        spark.createDataFrame(
            [(k, str(v)) for k, v in asdict(params).items()], "name string, value string"),
        spark.createDataFrame(
            list(enumerate(indexer.labels)), "label_id int, label string"),
        spark.createDataFrame(pairs, "epoch int, label_id int, prediction int, n long"),
        scored,
    )


def with_vectors(df: DataFrame) -> DataFrame:
    """Rows with ``vector``, the column the model reads, from their ``features``."""
    return df.withColumn("vector", array_to_vector(F.col("features").cast("array<double>")))


def signature(model: PipelineModel, example: DataFrame) -> T.StructType:
    """What the model gives for rows like the example's, without running it."""
    return model.transform(example.limit(0)).schema


def train_images(
    images: DataFrame, run_path: str, run_id: str, params: Params = Params()
) -> Run:
    """Train on labelled images and record the run.

    Images are decoded once: the split and the fit read the written features.
    """
    spark, features = images.sparkSession, f"{run_path}/features/{run_id}"
    overwrite(features_of(images, params.img_size), features)
    overwrite(images.filter(F.col("pixels").isNull()).select("path"), f"{run_path}/undecoded/{run_id}")
    run = train(scan(spark, features), "path", params)
    record(run, run_path, run_id)
    return run


def record(run: Run, path: str, run_id: str) -> None:
    for name in ("params", "metrics", "labels", "confusion"):
        append(getattr(run, name).withColumn("run_id", F.lit(run_id)), f"{path}/{name}")
    run.model.write().overwrite().save(f"{path}/models/{run_id}")
