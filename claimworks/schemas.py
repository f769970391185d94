"""Schemas of the captured tables, topics and object folders.

The column lists are fixed values: they are the interface to the source
systems and stay in the order the sources define.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


POLICY = strings(
    "policy_no", "cust_id", "policytype", "pol_issue_date", "pol_eff_date",
    "pol_expiry_date", "make", "model", "model_year", "chassis_no",
    "use_of_vehicle", "product", "sum_insured", "premium", "deductable",
)
CLAIM = strings(
    "claim_no", "policy_no", "claim_date", "months_as_customer", "injury",
    "property", "vehicle", "total", "collision_type",
    "number_of_vehicles_involved", "driver_age", "insured_relationship",
    "license_issue_date", "incident_date", "incident_hour", "incident_type",
    "incident_severity", "number_of_witnesses", "suspicious_activity",
)
CUSTOMER = strings(
    "customer_id", "date_of_birth", "borough", "neighborhood", "zip_code", "name",
)
TELEMATICS = strings("chassis_no", "latitude", "longitude", "event_timestamp", "speed")
IMAGE_METADATA = strings("image_name", "image_id", "claim_no", "chassis_no")

BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])

# Envelope of one row change; the row images stay raw JSON until routed.
ENVELOPE = T.StructType([
    T.StructField("before", T.StringType()),
    T.StructField("after", T.StringType()),
    T.StructField("source", strings("table")),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
])

# Topic rows as the file stand-in stores them; a broker adds further columns.
TOPIC = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("offset", T.LongType()),
])

# Captured table -> (row schema, key columns).
CAPTURED = {
    "policy": (POLICY, ["policy_no"]),
    "claim": (CLAIM, ["claim_no"]),
    "customer": (CUSTOMER, ["customer_id"]),
}


@dataclass(frozen=True)
class Declared:
    """What the source database declares about a table."""

    key: str
    not_null: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    digits: dict[str, tuple[int, int]] = field(default_factory=dict)


# Keys, obligatory columns, text lengths and decimal ranges of the source tables.
DECLARED = {
    "policy": Declared(
        "policy_no", ("policy_no", "cust_id"),
        {**dict.fromkeys(("policy_no", "cust_id", "policytype", "make", "model", "chassis_no"), 50),
         "use_of_vehicle": 100, "product": 100},
        {"sum_insured": (15, 2), "premium": (15, 2)}),
    "claim": Declared(
        "claim_no", ("claim_no", "policy_no"),
        dict.fromkeys(("claim_no", "policy_no", "collision_type", "insured_relationship", "incident_type",
                       "incident_severity"), 50)),
    "customer": Declared(
        "customer_id", ("customer_id",),
        {"borough": 100, "neighborhood": 150, "zip_code": 10, "name": 255}),
}

# Which captured table's column names a row of which other: (child, column, parent).
REFERENCES = (("claim", "policy_no", "policy"), ("policy", "cust_id", "customer"))
