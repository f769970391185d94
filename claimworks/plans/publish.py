"""Publish a table as topic messages."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.messages import encode_messages
from ..sources.readers import scan
from ..sources.sinks import write_topic

log = logging.getLogger(__name__)


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count rows while they pass, instead of in a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def publish_telematics(spark: SparkSession, source: str, **target) -> int | None:
    """All readings of a parquet table to a topic; the number sent.

    An unreadable source is logged and ends the job without output (None).
    """
    try:
        readings = scan(spark, source)
    except AnalysisException as e:
        log.error("cannot read %s: %s", source, e)
        return None
    messages, seen = counted(encode_messages(readings, "chassis_no"))
    write_topic(messages, **target)
    return seen.get["rows"]
