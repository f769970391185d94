"""Cleaning rules from bronze text rows to typed silver rows, one per table.

Each rule takes the micro-batch and, where it needs one, the silver table as
it stood before the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import casts, ranges, text
from ..operators.aggregate import fill_missing, impute_from_history
from ..operators.dedupe import keep_one
from ..session import freed_shuffles, scratch_dir
from ..sources.sinks import overwrite


MOST_ROWS = 75_000_000


def cleaned_in_parts(
    rule: Callable[[DataFrame], DataFrame], rows: DataFrame, keys: Sequence[str], most: int | None = None
) -> DataFrame:
    """``rule(rows)``; of more than ``most`` rows as a table in the scratch folder, written part by part.

    A part is what a hash of ``keys`` says, so a rule that reduces rows by these
    columns gives the same rows; on disk lie the shuffle files of one part, not of
    all. Each part scans ``rows`` again, and makes only its own ready.
    """
    parts = -(-rows.count() // (most or MOST_ROWS))
    if parts <= 1:
        return rule(rows)
    spark, part = rows.sparkSession, F.pmod(F.xxhash64(*keys), F.lit(parts))
    folder = scratch_dir(spark, "cleaned")
    paths = [f"{folder}/part={n}" for n in range(parts)]
    with freed_shuffles(spark):
        for n, path in enumerate(paths):
            overwrite(rule(rows.where(part == n)), path)
    return spark.read.schema(rule(rows).schema).parquet(*paths)


def clean_policy(df: DataFrame, precision: int = 10, scale: int = 2) -> DataFrame:
    one = keep_one(df.dropna(subset=["policy_no", "cust_id"]), ["policy_no"])
    return one.withColumns({
        "cust_id": casts.lenient_int("cust_id"),
        "pol_issue_date": casts.date_from_epoch_days("pol_issue_date"),
        "pol_eff_date": casts.date_from_epoch_days("pol_eff_date"),
        "pol_expiry_date": casts.date_from_epoch_days("pol_expiry_date"),
        "model_year": ranges.null_below(casts.lenient_int("model_year"), 1980),
        "sum_insured": casts.decimal_or_null("sum_insured", precision, scale),
        "premium": F.abs(casts.decimal_or_null("premium", precision, scale)),
        "deductable": casts.lenient_int("deductable"),
    })


def clean_claim(df: DataFrame) -> DataFrame:
    one = keep_one(df.dropna(subset=["claim_no"]), ["claim_no"])
    dates = ["claim_date", "license_issue_date", "incident_date"]
    amounts = ["injury", "property", "vehicle", "total"]
    counts = ["months_as_customer", "number_of_vehicles_involved", "driver_age",
              "number_of_witnesses"]
    return one.withColumns({
        **{c: casts.date_from_epoch_days(c) for c in dates},
        **{c: casts.lenient_long(c) for c in amounts},
        **{c: casts.lenient_int(c) for c in counts},
        "suspicious_activity": casts.boolean_or_null("suspicious_activity"),
        "incident_hour": casts.lenient_int("incident_hour"),
    }).withColumn("incident_hour", ranges.clamp("incident_hour", 0, 23))


def clean_customer(df: DataFrame) -> DataFrame:
    """Keys are typed before rows are reduced: '1' and '1.0' are one customer, an unreadable key is none."""
    typed = df.withColumn("customer_id", casts.lenient_int("customer_id"))
    one = keep_one(typed.dropna(subset=["customer_id"]), ["customer_id"])
    return one.withColumns({
        "date_of_birth": casts.date_from_epoch_days("date_of_birth"),
        "firstname": text.name_part("name", 0),
        "lastname": text.name_part("name", 1),
        "address": text.join_address("borough", "zip_code"),
    }).drop("name", "borough", "zip_code")


def _newest(images: DataFrame) -> DataFrame:
    """One row per path, the last modified; without a path there is nothing to upsert by."""
    order = [c for c in ("modificationTime",) if c in images.columns]
    return keep_one(images.dropna(subset=["path"]), ["path"], order, last=True)


def clean_claim_images(df: DataFrame, strict: bool = False) -> DataFrame:
    return _newest(df).withColumn("image_name", text.image_name("path", strict))


def clean_image_metadata(df: DataFrame) -> DataFrame:
    return keep_one(df.dropna(subset=["chassis_no", "claim_no"]), ["image_name"])


def clean_training_images(df: DataFrame) -> DataFrame:
    return _newest(df).withColumn("label", text.training_label("path"))


def clean_telematics(df: DataFrame, silver: DataFrame | None = None, means: Callable | None = None) -> DataFrame:
    """Typed readings; a missing speed takes the vehicle's average in ``silver``, or what ``means`` says it is.

    Times are parsed before the de-duplication, so a reading whose time does
    not parse is dropped instead of being inserted again by every batch.
    """
    typed = df.withColumns({
        "event_timestamp": casts.parse_timestamp("event_timestamp"),
        "latitude": casts.double_or_null("latitude"),
        "longitude": casts.double_or_null("longitude"),
        "speed": casts.double_or_null("speed"),
    }).withColumns({
        "latitude": ranges.clamp("latitude", -90.0, 90.0),
        "longitude": ranges.clamp("longitude", -180.0, 180.0),
    })
    keys = ["chassis_no", "event_timestamp"]
    one = keep_one(typed.dropna(subset=keys), keys)
    if means is not None:
        return fill_missing(one, ["chassis_no"], "speed", means)
    return one if silver is None else impute_from_history(one, silver, ["chassis_no"], "speed")
