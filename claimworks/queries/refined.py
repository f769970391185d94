"""Silver rules, joins and gold tables on claims-shaped stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geo import geocode, geocode_from_table, geocode_nearest, geocode_udf, hash_geocoder
from ..operators.aggregate import impute_from_history
from ..operators.dedupe import keep_one
from ..plans import gold, silver
from . import standins
from .registry import portable, portable_sql, query, single, single_sql, table

LENIENT = "case when regexp_full_match({0}, '\\s*[+-]?[0-9]+([.][0-9]*)?\\s*') " \
          "then try_cast(split_part(trim({0}), '.', 1) as {1}) end"


def lenient(c: str, kind: str = "integer") -> str:
    return LENIENT.format(c, kind)


def day(c: str) -> str:
    return f"date '1970-01-01' + {lenient(c)}"


def first_row(source: str, keys: list[str], columns: list[str]) -> str:
    """One row per key: the one with fewest nulls, then the least by all other columns."""
    others = [c for c in columns if c not in keys]
    fewest = " + ".join(f"({c} is null)::int" for c in others)
    rest = ", ".join([fewest, *(f"{c} nulls first" for c in others)])
    return (f"(select * from {source} qualify row_number() over "
            f"(partition by {', '.join(keys)} order by {rest}) = 1)")


POLICY_NAMES = list(standins.policy_columns("duckdb"))
CLAIM_NAMES = list(standins.claim_columns("duckdb"))
CUSTOMER_NAMES = list(standins.customer_columns("duckdb"))
METADATA_NAMES = list(standins.metadata_columns("duckdb"))

POLICY_SQL = f"""
    select policy_no, {lenient('cust_id')} as cust_id, policytype,
      {day('pol_issue_date')} as pol_issue_date, {day('pol_eff_date')} as pol_eff_date,
      {day('pol_expiry_date')} as pol_expiry_date, make, model,
      case when {lenient('model_year')} >= 1980 then {lenient('model_year')} end as model_year,
      chassis_no, use_of_vehicle, product, try_cast(sum_insured as decimal(10,2)) as sum_insured,
      abs(try_cast(premium as decimal(10,2))) as premium, {lenient('deductable')} as deductable
    from {first_row(f"(select * from {standins.POLICIES_SQL} where policy_no is not null and cust_id is not null)",
                    ['policy_no'], POLICY_NAMES)}"""

CLAIM_SQL = f"""
    select claim_no, policy_no, {day('claim_date')} as claim_date,
      {lenient('months_as_customer')} as months_as_customer, {lenient('injury', 'bigint')} as injury,
      {lenient('property', 'bigint')} as property, {lenient('vehicle', 'bigint')} as vehicle,
      {lenient('total', 'bigint')} as total, collision_type,
      {lenient('number_of_vehicles_involved')} as number_of_vehicles_involved,
      {lenient('driver_age')} as driver_age, insured_relationship,
      {day('license_issue_date')} as license_issue_date, {day('incident_date')} as incident_date,
      case when {lenient('incident_hour')} < 0 then 0 when {lenient('incident_hour')} > 23 then 23
           else {lenient('incident_hour')} end as incident_hour,
      incident_type, incident_severity, {lenient('number_of_witnesses')} as number_of_witnesses,
      case suspicious_activity when 'true' then true when 't' then true when 'false' then false end
        as suspicious_activity
    from {first_row(standins.sql('claim'), ['claim_no'], CLAIM_NAMES)}"""

CUSTOMER_SQL = f"""
    select customer_id, {day('date_of_birth')} as date_of_birth, neighborhood,
      string_split(name, ' ')[1] as firstname, string_split(name, ' ')[2] as lastname,
      concat_ws(', ', borough, zip_code) as address
    from {first_row(f"(select * replace ({lenient('customer_id')} as customer_id) from {standins.sql('customer')})",
                    ['customer_id'], CUSTOMER_NAMES)} where customer_id is not null"""

TELEMATICS_TYPED = f"""
    select chassis_no, case when latitude < -90 then -90 when latitude > 90 then 90 else latitude end as latitude,
      case when longitude < -180 then -180 when longitude > 180 then 180 else longitude end as longitude,
      event_timestamp, speed
    from (select chassis_no, try_cast(nullif(latitude, 'nan') as double) as latitude,
        try_cast(longitude as double) as longitude,
        try_strptime(event_timestamp, '%Y-%m-%d %H:%M:%S') as event_timestamp,
        try_cast(nullif(speed, 'nan') as double) as speed
      from {standins.sql('telematics')})
    where chassis_no is not null and event_timestamp is not null"""

TELEMATICS_SQL = "select * from " + first_row(
    f"({TELEMATICS_TYPED})", ["chassis_no", "event_timestamp"],
    ["latitude", "longitude", "speed"])


def silver_frames(spark, sf):
    return (silver.clean_claim(standins.frame(spark, sf, "claim")),
            silver.clean_policy(standins.policies(spark, sf)),
            silver.clean_customer(standins.frame(spark, sf, "customer")))


def silver_tables(spark, sf):
    """The same for joins of whole rows: large tables are cleaned part by part."""
    return (silver.cleaned_in_parts(silver.clean_claim, standins.frame(spark, sf, "claim"), ["claim_no"]),
            silver.cleaned_in_parts(silver.clean_policy, standins.policies(spark, sf), ["policy_no"]),
            silver.clean_customer(standins.frame(spark, sf, "customer")))


@query("silver_policy", portable_sql(
    POLICY_SQL, "pol_issue_date pol_eff_date pol_expiry_date", "sum_insured premium"))
def silver_policy(spark, sf):
    return portable(silver.clean_policy(standins.policies(spark, sf)))


@query("silver_claim", portable_sql(CLAIM_SQL, "claim_date license_issue_date incident_date"))
def silver_claim(spark, sf):
    return portable(silver.clean_claim(standins.frame(spark, sf, "claim")))


@query("silver_customer", portable_sql(CUSTOMER_SQL, "date_of_birth"))
def silver_customer(spark, sf):
    return portable(silver.clean_customer(standins.frame(spark, sf, "customer")))


@query("silver_images", f"""select path, length, regexp_extract(path, '.*/(.*?.jpg)', 1) as image_name
    from {standins.sql('path')}""")
def silver_images(spark, sf):
    return silver.clean_claim_images(standins.frame(spark, sf, "path"))


@query("silver_training", rf"""select path, length,
      regexp_extract(path, '/(\d+)-([a-zA-Z]+)(?: \(\d+\))?\.png$', 2) as label
    from {standins.sql('path')}""")
def silver_training(spark, sf):
    return silver.clean_training_images(standins.frame(spark, sf, "path"))


@query("silver_metadata", "select * from " + first_row(
    f"(select * from {standins.sql('metadata')} where chassis_no is not null and claim_no is not null)",
    ["image_name"], METADATA_NAMES))
def silver_metadata(spark, sf):
    return silver.clean_image_metadata(standins.frame(spark, sf, "metadata"))


@query("silver_telematics", portable_sql(TELEMATICS_SQL, "event_timestamp"))
def silver_telematics(spark, sf):
    return portable(silver.clean_telematics(standins.frame(spark, sf, "telematics")))


CUTOFF = "timestamp '2024-01-15 00:00:00'"


@query("silver_speed_impute", f"""
    with typed as ({TELEMATICS_SQL}),
      old as (select chassis_no, avg(speed) as mean from typed where event_timestamp < {CUTOFF} group by chassis_no)
    select chassis_no, latitude, longitude, cast(event_timestamp as varchar) as event_timestamp,
      {single_sql('coalesce(speed, mean)')} as speed
    from typed left join old using (chassis_no) where event_timestamp >= {CUTOFF}""")
def silver_speed_impute(spark, sf):
    """The first readings are the silver table, the later ones the batch."""
    raw = standins.frame(spark, sf, "telematics")
    cutoff = F.expr(CUTOFF)
    history = silver.clean_telematics(raw).filter(F.col("event_timestamp") < cutoff)
    later = raw.filter(F.try_to_timestamp("event_timestamp", F.lit("yyyy-MM-dd HH:mm:ss")) >= cutoff)
    batch = silver.clean_telematics(later, history)
    return single(portable(batch), "speed")


@query("dedupe_key", "select * replace (cast(l_shipdate as varchar) as l_shipdate) from " + first_row(
    "lineitem", ["l_orderkey"],  # without nulls the number of values decides nothing
    ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
     "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]))
def dedupe_key(spark, sf):
    return portable(keep_one(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_linenumber"]))


@query("dedupe_composite", "select * replace (cast(l_shipdate as varchar) as l_shipdate) from " + first_row(
    "lineitem", ["l_orderkey", "l_linenumber"],
    ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
     "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]))
def dedupe_composite(spark, sf):
    return portable(keep_one(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]))


@query("join_inner_using", f"""select claim_no, policy_no, cust_id, chassis_no, cast(premium as double) as premium
    from ({CLAIM_SQL}) join ({POLICY_SQL}) using (policy_no)""")
def join_inner_using(spark, sf):
    claim, policy, _ = silver_frames(spark, sf)
    return portable(gold.claims_with_policies(claim, policy).select(
        "claim_no", "policy_no", "cust_id", "chassis_no", "premium"))


@query("join_inner_on", f"""select policy_no, cust_id, firstname, lastname, address, cast(premium as double) as premium
    from ({POLICY_SQL}) join ({CUSTOMER_SQL}) on cust_id = customer_id""")
def join_inner_on(spark, sf):
    _, policy, customer = silver_frames(spark, sf)
    return portable(gold.policies_with_customers(policy, customer).select(
        "policy_no", "cust_id", "firstname", "lastname", "address", "premium"))


CORE_SQL = f"""select * exclude (customer_id)
    from ({CLAIM_SQL}) join ({POLICY_SQL}) using (policy_no) join ({CUSTOMER_SQL}) on cust_id = customer_id"""
DATES = ("claim_date license_issue_date incident_date pol_issue_date pol_eff_date pol_expiry_date "
         "date_of_birth")


@query("gold_star_join", portable_sql(CORE_SQL, DATES, "sum_insured premium"))
def gold_star_join(spark, sf):
    return portable(gold.customer_claim_policy(*silver_tables(spark, sf)))


def md5_part(c: str, start: int) -> str:
    return f"cast(('0x' || substr(md5({c}), {start}, 8))::bigint as double) / 4294967295.0"


def flat_place(df):
    """The coordinate struct as two double columns."""
    return df.withColumns({
        "latitude": F.col("lat_long.latitude").cast("double"),
        "longitude": F.col("lat_long.longitude").cast("double"),
    }).drop("lat_long")


def place_sql(c: str) -> str:
    return (f"cast(cast({md5_part(c, 1)} * 180 - 90 as float) as double) as latitude, "
            f"cast(cast({md5_part(c, 9)} * 360 - 180 as float) as double) as longitude")


AVERAGES_SQL = f"""select chassis_no, {single_sql('avg(speed)')} as avg_speed,
      {single_sql('avg(latitude)')} as avg_latitude, {single_sql('avg(longitude)')} as avg_longitude from ({TELEMATICS_SQL}) group by chassis_no"""
ENRICHED_SQL = f"""select *, {place_sql('address')}
    from ({CORE_SQL}) join ({AVERAGES_SQL}) using (chassis_no)"""


@query("gold_enriched", portable_sql(ENRICHED_SQL, DATES, "sum_insured premium"))
def gold_enriched(spark, sf):
    """Flagship: bronze text to the enriched gold table, in one plan unless the tables are large."""
    claim, policy, customer = silver_tables(spark, sf)
    vehicle, known = (gold.vehicle_averages(
        silver.clean_telematics(standins.frame(spark, sf, "telematics"))) for _ in range(2))
    core = gold.customer_claim_policy(claim, gold.policies_of_vehicles(policy, known), customer)
    enriched = portable(flat_place(gold.enrich(core, vehicle)))
    return single(enriched, "avg_speed", "avg_latitude", "avg_longitude")


@query("geocode_udf", f"select customer_id, address, {place_sql('address')} from ({CUSTOMER_SQL})")
def geocode_with_udf(spark, sf):
    customer = silver.clean_customer(standins.frame(spark, sf, "customer"))
    located = geocode(customer, "address", geocode_udf(hash_geocoder))
    return flat_place(located.select("customer_id", "address", "lat_long"))


PLACE_NAME = "case when n_regionkey = 2 then 'ELSEWHERE_' else 'NATION_' end || cast(n_nationkey as string)"


@query("geocode_table", f"""
    with places as (select {PLACE_NAME} as place, cast(n_nationkey * 3.5 - 60 as float) as la,
        cast(n_nationkey * 7.25 - 100 as float) as lo from nation)
    select c_custkey, cast(la as double) as latitude, cast(lo as double) as longitude
    from customer left join places on place = 'NATION_' || c_nationkey""")
def geocode_table(spark, sf):
    """Look-up in a table of places; the nations of one region are known by another name."""
    places = table(spark, sf, "nation").selectExpr(
        f"{PLACE_NAME} as address", "n_nationkey * 3.5 - 60 as latitude",
        "n_nationkey * 7.25 - 100 as longitude")
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("address"))
    return flat_place(geocode_from_table(customers, "address", places)).drop("address")


# Addresses with a letter put in, left out or changed, and some that are far off.
TYPED = """case c_custkey % 7 when 0 then c_name when 1 then substr(c_name, 1, 4) || 'x' || substr(c_name, 5)
    when 2 then substr(c_name, 1, 2) || substr(c_name, 4) when 3 then 'C' || substr(c_name, 3) || 'y'
    when 4 then substr(c_name, 16) when 5 then null else 'nowhere ' || c_custkey end"""


@query("geocode_nearest", f"""
    with typed as (select c_custkey, {TYPED} as address from customer),
      places as (select c_name as address, cast(c_custkey % 180 - 90 as float) as la, cast(c_custkey % 360 - 180 as float) as lo
        from customer where c_custkey % 3 = 0 union all select substr(c_name, 17), 1, 2 from customer where c_custkey % 5 = 0),
      one as (select address, min(struct_pack(la := la, lo := lo)) as place from places group by address),
      near as (select t.address, min(struct_pack(d := levenshtein(t.address, p.address), b := p.address)) as best
        from (select distinct address from typed) t join one p on levenshtein(t.address, p.address) <= 2 group by t.address)
    select c_custkey, cast(place.la as double) as latitude, cast(place.lo as double) as longitude
    from typed left join near using (address) left join one on one.address = best.b""")
def geocode_nearest_place(spark, sf):
    """Addresses within two edits of a place's; equally near places, short texts and repeated places among them."""
    customer = table(spark, sf, "customer")
    typed = customer.selectExpr("c_custkey", f"{TYPED} as address")
    places = customer.where("c_custkey % 3 = 0").selectExpr(
        "c_name as address", "c_custkey % 180 - 90 as latitude", "c_custkey % 360 - 180 as longitude").union(
        customer.where("c_custkey % 5 = 0").selectExpr("substr(c_name, 17)", "1", "2"))
    return flat_place(geocode_nearest(typed, "address", places)).drop("address")


@query("impute_history", f"""
    with old as (select user_id, avg(value) as mean from events where ts < timestamp '2024-01-15' group by user_id)
    select event_id, user_id, {single_sql('case when event_id % 4 = 0 then mean else value end')} as value
    from events left join old using (user_id)""")
def impute_history(spark, sf):
    """The bare operator: every fourth value of the whole table is taken away and imputed."""
    events = table(spark, sf, "events").select("event_id", "user_id", "value", "ts")
    history = events.filter(F.col("ts") < F.expr("timestamp_ntz '2024-01-15'"))
    holes = events.drop("ts").withColumn("value", F.when(F.col("event_id") % 4 != 0, F.col("value")))
    return single(impute_from_history(holes, history, ["user_id"], "value"), "value")
