"""One query per cleaning function, on texts made from whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import casts, ranges, text
from ..functions.messages import encode_messages
from ..plans.gold import vehicle_averages
from . import standins
from .registry import portable, query, single, single_sql, table

NUMBER_TEXT = (
    "case event_id % 10 when 0 then 'abc' when 1 then ' -3 ' when 2 then '12.7' when 3 then '' "
    "when 4 then null when 5 then '99999999999' when 6 then '1e3' "
    "when 7 then cast(event_id as string) || '.' when 8 then cast(user_id as string) || '.0' "
    "else cast(event_id as string) end"
)
WHOLE = "regexp_full_match(raw, '\\s*[+-]?[0-9]+([.][0-9]*)?\\s*')"


def _texts(spark, sf, source, key, expr):
    return table(spark, sf, source).selectExpr(key, f"{expr} as raw")


def _sql(source, key, expr, result):
    return f"select {key}, {result} as result from (select {key}, {expr} as raw from {source})"


@query("cast_lenient_int", _sql(
    "events", "event_id", NUMBER_TEXT,
    f"case when {WHOLE} then try_cast(split_part(trim(raw), '.', 1) as integer) end"))
def cast_lenient_int(spark, sf):
    return _texts(spark, sf, "events", "event_id", NUMBER_TEXT).select(
        "event_id", casts.lenient_int("raw").alias("result"))


@query("cast_lenient_long", _sql(
    "events", "event_id", NUMBER_TEXT,
    f"case when {WHOLE} then try_cast(split_part(trim(raw), '.', 1) as bigint) end"))
def cast_lenient_long(spark, sf):
    return _texts(spark, sf, "events", "event_id", NUMBER_TEXT).select(
        "event_id", casts.lenient_long("raw").alias("result"))


DECIMAL_TEXT = (
    "case o_orderkey % 7 when 0 then 'abc' when 1 then '123456789012.34' when 2 then "
    "cast(cast(o_totalprice as decimal(18,2)) as string) || '5' when 3 then null "
    "when 4 then '-' || cast(cast(o_totalprice as decimal(18,2)) as string) || '4' "
    "else cast(cast(o_totalprice as decimal(18,2)) as string) end"
)


@query("cast_decimal", _sql("orders", "o_orderkey", DECIMAL_TEXT,
                            "cast(try_cast(raw as decimal(10,2)) as double)"))
def cast_decimal(spark, sf):
    return portable(_texts(spark, sf, "orders", "o_orderkey", DECIMAL_TEXT).select(
        "o_orderkey", casts.decimal_or_null("raw").alias("result")))


@query("abs_decimal", _sql("orders", "o_orderkey", DECIMAL_TEXT,
                           "cast(abs(try_cast(raw as decimal(10,2))) as double)"))
def abs_decimal(spark, sf):
    return portable(_texts(spark, sf, "orders", "o_orderkey", DECIMAL_TEXT).select(
        "o_orderkey", F.abs(casts.decimal_or_null("raw")).alias("result")))


BOOLEAN_TEXT = (
    "case event_id % 11 when 0 then 'true' when 1 then 'FALSE' when 2 then 't' when 3 then '1' "
    "when 4 then '0' when 5 then 'maybe' when 6 then null when 7 then 'yes' when 8 then 'n' "
    "when 9 then '' else event_type end"
)


@query("cast_boolean", _sql(
    "events", "event_id", BOOLEAN_TEXT,
    "case when lower(raw) in ('true', 't', '1', 'yes', 'y') then true "
    "when lower(raw) in ('false', 'f', '0', 'no', 'n') then false end"))
def cast_boolean(spark, sf):
    return _texts(spark, sf, "events", "event_id", BOOLEAN_TEXT).select(
        "event_id", casts.boolean_or_null("raw").alias("result"))


@query("map_boolean", _sql(
    "events", "event_id", BOOLEAN_TEXT,
    "case lower(raw) when 'true' then true when 'false' then false end"))
def map_boolean(spark, sf):
    return _texts(spark, sf, "events", "event_id", BOOLEAN_TEXT).select(
        "event_id", casts.boolean_from_words("raw").alias("result"))


DOUBLE_TEXT = (
    "case event_id % 8 when 0 then 'nan' when 1 then 'bad' when 2 then null when 3 then '' "
    "when 4 then '1e2' else cast(cast(value as decimal(18,2)) as string) end"
)


@query("cast_double", _sql(
    "events", "event_id", DOUBLE_TEXT,
    "case when isnan(try_cast(raw as double)) then null else try_cast(raw as double) end"))
def cast_double(spark, sf):
    return _texts(spark, sf, "events", "event_id", DOUBLE_TEXT).select(
        "event_id", casts.double_or_null("raw").alias("result"))


@query("coerce_numeric", f"""
    select event_id, cast(n as bigint) as whole, cast(cast(n as bigint) as varchar) as key_text
    from (select event_id, case when d = floor(d) then d end as n from (
        select event_id, try_cast(trim({NUMBER_TEXT}) as double) as d from events))""")
def coerce_numeric(spark, sf):
    whole = casts.whole_number("raw")
    return _texts(spark, sf, "events", "event_id", NUMBER_TEXT).select(
        "event_id", whole.alias("whole"), whole.cast("string").alias("key_text"))


DAY_TEXT = (
    "case o_orderkey % 9 when 0 then 'x' when 1 then null when 2 then '-1' "
    "else cast(o_orderkey % 30000 as string) end"
)


@query("epoch_days_to_date", _sql(
    "orders", "o_orderkey", DAY_TEXT,
    "cast(date '1970-01-01' + try_cast(raw as integer) as varchar)"))
def epoch_days_to_date(spark, sf):
    return portable(_texts(spark, sf, "orders", "o_orderkey", DAY_TEXT).select(
        "o_orderkey", casts.date_from_epoch_days("raw").alias("result")))


TIME_TEXT = (
    "case event_id % 5 when 0 then cast(ts as string) when 1 then substr(cast(ts as string), 1, 10) "
    "when 2 then null else substr(cast(ts as string), 1, 19) end"
)


@query("parse_timestamp", _sql(
    "events", "event_id", TIME_TEXT,
    "cast(try_strptime(raw, '%Y-%m-%d %H:%M:%S') as varchar)"))
def parse_timestamp(spark, sf):
    return portable(_texts(spark, sf, "events", "event_id", TIME_TEXT).select(
        "event_id", casts.parse_timestamp("raw").alias("result")))


DMY_TEXT = (
    "case o_orderkey % 5 when 0 then substr(cast(o_orderdate as string), 1, 10) when 1 then '31-02-2020' "
    "when 2 then null else substr(cast(o_orderdate as string), 9, 2) || '-' || "
    "substr(cast(o_orderdate as string), 6, 2) || '-' || substr(cast(o_orderdate as string), 1, 4) end"
)


@query("coerce_date_dmy", f"""
    select o_orderkey, cast(cast(try_strptime(raw, '%d-%m-%Y') as date) as varchar) as day_first,
           cast(cast(try_strptime(raw, '%Y-%m-%d') as date) as varchar) as iso
    from (select o_orderkey, {DMY_TEXT} as raw from orders)""")
def coerce_date_dmy(spark, sf):
    return portable(_texts(spark, sf, "orders", "o_orderkey", DMY_TEXT).select(
        "o_orderkey", casts.parse_date("raw", "d-M-yyyy").alias("day_first"),
        casts.parse_date("raw").alias("iso")))


@query("clamp_range", """
    select event_id, case when value - 100 < -90 then -90.0::double when value - 100 > 90 then 90.0::double
             else value - 100 end as latitude,
           case when 2 * value - 200 < -180 then -180.0::double
                when 2 * value - 200 > 180 then 180.0::double else 2 * value - 200 end as longitude,
           case when h < 0 then 0 when h > 23 then 23 else h end as hour_of_day
    from (select *, case when event_id % 9 = 0 then null else cast(event_id % 40 - 8 as integer) end as h
          from events)""")
def clamp_range(spark, sf):
    df = table(spark, sf, "events")
    hour = F.when(F.col("event_id") % 9 != 0, (F.col("event_id") % 40 - 8).cast("int"))
    return df.select(
        "event_id",
        ranges.clamp(F.col("value") - 100, -90.0, 90.0).alias("latitude"),
        ranges.clamp(2 * F.col("value") - 200, -180.0, 180.0).alias("longitude"),
        ranges.clamp(hour, 0, 23).alias("hour_of_day"))


@query("null_below", "select p_partkey, case when p_size >= 25 then p_size end as p_size from part")
def null_below(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", ranges.null_below("p_size", 25).alias("p_size"))


@query("dropna_subset", f"""select chassis_no, event_timestamp, speed from {standins.sql('telematics')}
    where chassis_no is not null and speed is not null""")
def dropna_subset(spark, sf):
    return standins.frame(spark, sf, "telematics").dropna(
        subset=["chassis_no", "speed"]).select("chassis_no", "event_timestamp", "speed")


@query("regex_image_name", f"""
    select path, regexp_extract(path, '.*/(.*?.jpg)', 1) as loose,
      case when lower(path) like '%.jpg' or lower(path) like '%.jpeg' or lower(path) like '%.png'
           then split_part(path, '/', -1) end as strict
    from {standins.sql('path')}""")
def regex_image_name(spark, sf):
    return standins.frame(spark, sf, "path").select(
        "path", text.image_name("path").alias("loose"),
        text.image_name("path", strict=True).alias("strict"))


@query("regex_label", rf"""
    select path, regexp_extract(path, '/(\d+)-([a-zA-Z]+)(?: \(\d+\))?\.png$', 2) as label
    from {standins.sql('path')}""")
def regex_label(spark, sf):
    return standins.frame(spark, sf, "path").select(
        "path", text.training_label("path").alias("label"))


@query("filter_image_ext", f"""
    select path from {standins.sql('path')}
    where lower(path) like '%.jpg' or lower(path) like '%.jpeg' or lower(path) like '%.png'""")
def filter_image_ext(spark, sf):
    return standins.frame(spark, sf, "path").filter(text.is_image_path("path")).select("path")


PART_NAME = "case p_partkey % 7 when 0 then p_brand when 1 then '' when 2 then null else p_name end"


@query("split_name", f"""
    select p_partkey, string_split(raw, ' ')[1] as firstname, string_split(raw, ' ')[2] as lastname
    from (select p_partkey, {PART_NAME} as raw from part)""")
def split_name(spark, sf):
    return _texts(spark, sf, "part", "p_partkey", PART_NAME).select(
        "p_partkey", text.name_part("raw", 0).alias("firstname"),
        text.name_part("raw", 1).alias("lastname"))


@query("concat_address", f"""select customer_id, concat_ws(', ', borough, zip_code) as address
    from {standins.sql('customer')}""")
def concat_address(spark, sf):
    return standins.frame(spark, sf, "customer").select(
        "customer_id", text.join_address("borough", "zip_code").alias("address"))


QUOTED_NAME = (
    "case c_custkey % 5 when 0 then ' \"\"' || c_name || ', Jo\" ' when 1 then null "
    "when 2 then '\"' || c_mktsegment || '\"' else c_mktsegment || ',' || c_name end"
)


@query("clean_name", _sql(
    "customer", "c_custkey", QUOTED_NAME, "replace(trim(trim(raw), '\"'), ',', '')"))
def clean_name(spark, sf):
    return _texts(spark, sf, "customer", "c_custkey", QUOTED_NAME).select(
        "c_custkey", text.clean_name("raw").alias("result"))


@query("json_map_project", f"""select chassis_no, latitude, longitude, event_timestamp, speed
    from {standins.sql('telematics')}""")
def json_map_project(spark, sf):
    from ..functions.messages import parse_telematics

    return parse_telematics(encode_messages(standins.frame(spark, sf, "telematics"), "chassis_no"))


@query("topic_encode_json", f"""
    select coalesce(chassis_no, 'default') as key,
      '{{' || concat_ws(',', '"chassis_no":"' || chassis_no || '"', '"latitude":"' || latitude || '"',
        '"longitude":"' || longitude || '"', '"event_timestamp":"' || event_timestamp || '"',
        '"speed":"' || speed || '"') || '}}' as value
    from {standins.sql('telematics')}""")
def topic_encode_json(spark, sf):
    return encode_messages(standins.frame(spark, sf, "telematics"), "chassis_no")


LATITUDE_SQL = "least(greatest(value - 100, -90), 90)"
LONGITUDE_SQL = "least(greatest(2 * value - 200, -180), 180)"


@query("gold_telematics_avg", f"""
    select cast(user_id as varchar) as chassis_no, {single_sql('avg(value)')} as avg_speed,
      {single_sql(f'avg({LATITUDE_SQL})')} as avg_latitude,
      {single_sql(f'avg({LONGITUDE_SQL})')} as avg_longitude
    from events group by user_id""")
def gold_telematics_avg(spark, sf):
    readings = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("chassis_no"), F.col("value").alias("speed"),
        ranges.clamp(F.col("value") - 100, -90.0, 90.0).alias("latitude"),
        ranges.clamp(2 * F.col("value") - 200, -180.0, 180.0).alias("longitude"))
    return single(vehicle_averages(readings), "avg_speed", "avg_latitude", "avg_longitude")
