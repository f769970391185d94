"""Claims-shaped inputs made from the test tables.

Every column is an SQL expression both Spark and DuckDB take, so the two sides
of a comparison start from the same rows. ``{days(x)}`` style differences
between the engines go through the two small helpers at the top. Nulls, bad
text and copies are worked into the values; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .registry import table


def _days(engine: str, ts: str) -> str:
    if engine == "spark":
        return f"unix_date(cast({ts} as date))"
    return f"(cast({ts} as date) - date '1970-01-01')"


def _text2(number: str) -> str:
    return f"cast(cast({number} as decimal(18,2)) as string)"


def telematics_columns(engine: str) -> dict[str, str]:
    return {
        "chassis_no": "case when event_id % 97 = 0 then null else cast(user_id as string) end",
        "latitude": "case when event_id % 31 = 0 then 'nan' when event_id % 37 = 0 then 'bad' else "
                    + _text2("value - 100") + " end",
        "longitude": _text2("2 * value - 200"),
        "event_timestamp": "case when event_id % 89 = 0 then cast(ts as string) else "
                           "substr(cast(ts as string), 1, 16) || ':00' end",
        "speed": "case when event_id % 10 = 0 then null when event_id % 41 = 0 then 'nan' else "
                 + _text2("value") + " end",
    }


def policy_columns(engine: str, copy: int = 0) -> dict[str, str]:
    return {
        "policy_no": "cast(o_orderkey as string)",
        "cust_id": "case when o_orderkey % 101 = 0 then null when o_orderkey % 103 = 0 then 'bad' "
                   "else cast(o_custkey as string) end",
        "policytype": "o_orderpriority",
        "pol_issue_date": f"case when o_orderkey % 53 = 0 then 'x' else cast({_days(engine, 'o_orderdate')} as string) end",
        "pol_eff_date": f"cast({_days(engine, 'o_orderdate')} + 1 as string)",
        "pol_expiry_date": f"cast({_days(engine, 'o_orderdate')} + 366 as string)",
        "make": "o_orderstatus",
        "model": "substr(o_orderpriority, 3)",
        "model_year": "case when o_orderkey % 7 = 0 then cast(1970 + o_orderkey % 30 as string) || '.5' "
                      "when o_orderkey % 11 = 0 then '' else cast(1970 + o_orderkey % 50 as string) end",
        "chassis_no": "cast(o_custkey as string)",
        "use_of_vehicle": f"'use{copy}'",
        "product": "case when o_orderkey % 13 = 0 then null else o_orderstatus || '-product' end",
        "sum_insured": f"case when o_orderkey % 17 = 0 then '123456789012.34' else {_text2('o_totalprice')} end",
        "premium": f"'-' || cast(cast(o_totalprice as decimal(18,2)) + {copy} as string)",
        "deductable": "cast(o_orderkey % 1000 as string)",
    }


def claim_columns(engine: str) -> dict[str, str]:
    return {
        "claim_no": "cast(l_orderkey as string) || '-' || cast(l_linenumber as string)",
        "policy_no": "cast(l_orderkey as string)",
        "claim_date": f"cast({_days(engine, 'l_shipdate')} as string)",
        "months_as_customer": "cast(l_partkey % 400 as string)",
        "injury": _text2("l_extendedprice"),
        "property": "cast(l_partkey * 1000000 as string)",
        "vehicle": "case when l_suppkey % 7 = 0 then 'n/a' else cast(l_suppkey as string) end",
        "total": "cast(l_orderkey * 100000 as string)",
        "collision_type": "case when l_partkey % 9 = 0 then null else l_returnflag end",
        "number_of_vehicles_involved": "cast(cast(l_quantity as bigint) % 4 as string)",
        "driver_age": "cast(18 + l_partkey % 60 as string)",
        "insured_relationship": "l_linestatus",
        "license_issue_date": f"cast({_days(engine, 'l_shipdate')} - 8000 as string)",
        "incident_date": f"cast({_days(engine, 'l_shipdate')} - 3 as string)",
        "incident_hour": "cast(cast(l_quantity as bigint) - 10 as string)",
        "incident_type": "l_returnflag || l_linestatus",
        "incident_severity": "case when l_discount > 0.05 then 'Major' else 'Minor' end",
        "number_of_witnesses": "cast(l_linenumber as string)",
        "suspicious_activity": "case when l_partkey % 5 = 0 then 'true' when l_partkey % 5 = 1 then 'false' "
                               "when l_partkey % 5 = 2 then 't' when l_partkey % 5 = 3 then 'maybe' else null end",
    }


def customer_columns(engine: str) -> dict[str, str]:
    return {
        "customer_id": "cast(c_custkey as string)",
        "date_of_birth": "case when c_custkey % 19 = 0 then null else cast(c_custkey - 5000 as string) end",
        "borough": "case when c_custkey % 6 = 0 then null else c_mktsegment end",
        "neighborhood": "c_mktsegment",
        "zip_code": "case when c_custkey % 4 = 0 then null else '0' || cast(10000 + c_nationkey as string) end",
        "name": "case when c_custkey % 8 = 0 then c_name when c_custkey % 23 = 0 then null "
                "else c_mktsegment || ' ' || c_name || ' Jr' end",
    }


def path_columns(engine: str) -> dict[str, str]:
    return {
        "path": "'s3://landing/training/' || cast(page_id as string) || '-dent' || "
                "case when page_id % 2 = 0 then ' (2)' else '' end || "
                "case when page_id % 5 = 0 then '.jpg' when page_id % 5 = 1 then '.JPG' "
                "when page_id % 5 = 2 then '.jpeg' when page_id % 5 = 3 then '.png' else '.txt' end",
        "length": "cast(length(html) as bigint)",
    }


def metadata_columns(engine: str) -> dict[str, str]:
    return {
        "image_name": "cast(l_orderkey as string) || '.jpg'",
        "image_id": "cast(l_partkey as string)",
        "claim_no": "case when l_partkey % 29 = 0 then null else "
                    "cast(l_orderkey as string) || '-' || cast(l_linenumber as string) end",
        "chassis_no": "cast(l_suppkey as string)",
    }


SOURCES = {
    "telematics": ("events", telematics_columns),
    "policy": ("orders", policy_columns),
    "claim": ("lineitem", claim_columns),
    "customer": ("customer", customer_columns),
    "path": ("pages", path_columns),
    "metadata": ("lineitem", metadata_columns),
}


def select_list(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} as {name}" for name, expr in columns.items())


def frame(spark: SparkSession, sf_dir: str, name: str, **kw) -> DataFrame:
    source, columns = SOURCES[name]
    return table(spark, sf_dir, source).selectExpr(
        *[f"{e} as {n}" for n, e in columns("spark", **kw).items()]
    )


def sql(name: str, **kw) -> str:
    """The stand-in as a DuckDB subquery."""
    source, columns = SOURCES[name]
    return f"(select {select_list(columns('duckdb', **kw))} from {source})"


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every policy twice, the copies differing in premium and use."""
    return frame(spark, sf_dir, "policy").unionByName(frame(spark, sf_dir, "policy", copy=1))


POLICIES_SQL = f"({sql('policy')} union all {sql('policy', copy=1)})"
