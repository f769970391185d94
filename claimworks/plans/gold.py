"""Gold tables: vehicle averages, the claim star join, the enriched claim."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import hashed_lat_long
from ..operators.aggregate import averages
from ..operators.joins import lookup_join
from ..session import freed_shuffles
from ..sources.readers import scan
from ..sources.sinks import overwrite
from ..streaming.sums import RunningSums
from ..streaming.tables import open_table


VEHICLE_AVERAGES = {"avg_speed": "speed", "avg_latitude": "latitude", "avg_longitude": "longitude"}


def vehicle_averages(telematics: DataFrame) -> DataFrame:
    return averages(telematics, ["chassis_no"], VEHICLE_AVERAGES)


def claims_with_policies(claim: DataFrame, policy: DataFrame) -> DataFrame:
    return claim.join(policy, "policy_no", "inner")


def policies_with_customers(policies: DataFrame, customer: DataFrame) -> DataFrame:
    return policies.join(
        customer, policies["cust_id"] == customer["customer_id"], "inner"
    ).drop(customer["customer_id"])


def policies_of_vehicles(policies: DataFrame, vehicle: DataFrame) -> DataFrame:
    """Policies whose vehicle is known: no other can be in the enriched table, so claims of no other need to be moved twice."""
    return policies.join(vehicle.select("chassis_no"), "chassis_no", "left_semi").select(*policies.columns)


def customer_claim_policy(claim: DataFrame, policy: DataFrame, customer: DataFrame) -> DataFrame:
    """Claims with their policy and customer.

    Policies meet their customers first, so the claims, most of the rows, move once.
    No hints: AQE broadcasts a table once it has measured it and splits skewed
    partitions of the claims where it has not.
    """
    return claims_with_policies(claim, policies_with_customers(policy, customer))


def enrich(
    core: DataFrame,
    vehicle: DataFrame,
    locate: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Claims with coordinates and vehicle averages.

    Joins first, so only claims that stay are located. ``locate`` adds the
    ``lat_long`` column (see functions.geo); the default stays in the JVM.
    """
    joined = lookup_join(core, vehicle, ["chassis_no"])
    if locate is not None:
        located = locate(joined)
    else:
        located = joined.withColumn("lat_long", hashed_lat_long("address"))
    averaged = [c for c in vehicle.columns if c != "chassis_no"]
    front = [c for c in core.columns if c != "chassis_no"]
    return located.select("chassis_no", *front, "lat_long", *averaged)


SILVER_KEYS = {
    "policy": ["policy_no"], "claim": ["claim_no"], "customer": ["customer_id"],
    "telematics": ["chassis_no", "event_timestamp"],
}


def build_gold(
    spark: SparkSession, silver: str, gold: str, fmt: str = "parquet",
    locate: Callable[[DataFrame], DataFrame] | None = None, core: DataFrame | None = None,
) -> None:
    """The daily job: three tables, each overwritten, in order.

    Vehicle averages come from the sums that silver keeps, a row a vehicle; only
    where there are none are all readings averaged. ``core`` takes the place of the
    join of claims, policies and customers where that is kept (``streaming.star``).
    """

    with freed_shuffles(spark):
        _build(spark, silver, gold, fmt, locate, core)


def _build(spark: SparkSession, silver: str, gold: str, fmt: str, locate, core: DataFrame | None) -> None:
    def table(name: str) -> DataFrame:
        return open_table(spark, f"{silver}/{name}", SILVER_KEYS[name], fmt).read()

    sums = RunningSums(open_table(spark, f"{silver}/telematics", SILVER_KEYS["telematics"]), f"{silver}/telematics_sums",
                       ["chassis_no"], list(VEHICLE_AVERAGES.values()))
    if fmt != "delta" and sums.exists():
        sums.follow()
        kept = sums.averages()
        vehicles = kept.select("chassis_no", *[F.col(c).alias(out) for out, c in VEHICLE_AVERAGES.items()])
    else:
        vehicles = vehicle_averages(table("telematics"))
    overwrite(vehicles, f"{gold}/aggregated_telematics", fmt)
    if core is None:
        core = customer_claim_policy(table("claim"), table("policy"), table("customer"))
    overwrite(core, f"{gold}/customer_claim_policy", fmt)
    overwrite(
        enrich(
            scan(spark, f"{gold}/customer_claim_policy", fmt),
            scan(spark, f"{gold}/aggregated_telematics", fmt), locate,
        ),
        f"{gold}/customer_claim_policy_telematics", fmt,
    )
