"""Class labels and scores."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_indexer(df: DataFrame, label: str = "label", out: str = "label_id") -> StringIndexerModel:
    """Labels to dense ids in alphabetical order; the class list is the model's."""
    return StringIndexer(
        inputCol=label, outputCol=out, stringOrderType="alphabetAsc", handleInvalid="error"
    ).fit(df)


def accuracy_pct(prediction: Column, truth: Column) -> Column:
    """Share of right predictions, in percent."""
    return F.avg((prediction == truth).cast("double")) * 100
