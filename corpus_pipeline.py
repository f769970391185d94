"""Corpus pipeline: language, near copies, leaks, personal data, mixture.

Each stage takes (spark, docs, sf_dir); its result is written and read again as
the next stage's documents. Stages that filter keep every other row as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.llm.decontaminate import drop_leaks
from claimworks.llm.language import keep_known
from claimworks.llm.mixing import mix
from claimworks.llm.pii import redact
from claimworks.llm.simhash import drop_near_copies
from claimworks.session import scratch_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts without a letter and doubtful ones go."""
    return keep_known(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group linked by 4-word SimHash at 4 or fewer bits."""
    return drop_near_copies(docs, width=4, max_bits=4)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, verbatim or with other numbers, names and units."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; n_chars follows where the text changed.

    Other columns stay as they are, whatever their names.
    """
    done = redact(docs.select(F.struct(*docs.columns).alias("row"), "text"))
    same = F.col("text").eqNullSafe(F.col("row.text"))
    n_chars = F.when(same, F.col("row.n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    new = {"text": F.col("text"), "n_chars": n_chars}
    return done.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents it takes words of, with size, source_size, target and taken, which replace columns of these names."""
    own = ("size", "source_size", "target", "taken")
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in own]
    return mix(docs).where("taken > 0").select(*kept, *own)


STAGES = [("language", language), ("near_copies", near_copies), ("leaks", leaks), ("personal_data", personal_data),
          ("mixture", mixture)]

# The learned models and bit distances have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
