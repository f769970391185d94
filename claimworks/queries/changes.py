"""Change-log parsing, net changes, merges and inserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.messages import expand_images, known_tables, parse_envelopes, route, row_images
from ..operators.changelog import apply_net, net_changes
from ..operators.dedupe import keep_one
from ..operators.merge import apply_single_changes, insert_if_absent, upsert
from ..schemas import CAPTURED, strings
from .registry import query, table

# Events read as changes of the customer they name.
OP = ("case event_type when 'signup' then 'c' when 'view' then 'r' when 'error' then 'd' else 'u' end")
IMAGE = strings("customer_id", "kind", "amount")
LOG_COLUMNS = {
    "customer_id": "cast(user_id as string)",
    "kind": "event_type",
    "amount": "cast(cast(value as decimal(18,2)) as string)",
}
TABLE_NAME = "case event_id % 4 when 0 then 'policy' when 1 then 'claim' when 2 then 'customer' else 'users' end"


def envelopes(spark, sf, table_name: str = "'customer'"):
    """Events as change messages: (key, value JSON, offset).

    One in 43 is a tombstone, one in 47 is cut short, one in 53 lacks its row.
    """
    events = table(spark, sf, "events").selectExpr(
        "event_id", "unix_millis(cast(ts as timestamp)) as ts_ms", f"{OP} as op",
        f"{table_name} as tab", *[f"{e} as {n}" for n, e in LOG_COLUMNS.items()])
    row = F.when(F.col("event_id") % 53 != 0, F.struct(*LOG_COLUMNS))
    text = F.to_json(F.struct(
        F.when(F.col("op") == "d", row).alias("before"),
        F.when(F.col("op") != "d", row).alias("after"),
        F.struct(F.col("tab").alias("table")).alias("source"), "op", "ts_ms"))
    value = (
        F.when(F.col("event_id") % 43 == 0, F.lit(None))
        .when(F.col("event_id") % 47 == 0, F.substring(text, 1, 20))
        .otherwise(text)
    )
    return events.select(
        F.col("customer_id").alias("key"), value.alias("value"), F.col("event_id").alias("offset"))


def image_json(condition: str) -> str:
    return (f"case when ({condition}) and event_id % 53 <> 0 then "
            + "'{' || " + " || ',' || ".join(f"'\"{n}\":\"' || {e} || '\"'" for n, e in LOG_COLUMNS.items())
            + " || '}' end")


READABLE = "event_id % 43 <> 0 and event_id % 47 <> 0"


@query("cdc_parse_envelope", f"""
    select 'customer' as table_name, op, {image_json("op = 'd'")} as before_str,
      {image_json("op <> 'd'")} as after_str, epoch_us(ts) // 1000 as ts_ms, event_id as "offset"
    from (select *, {OP} as op from events) where {READABLE}""")
def cdc_parse_envelope(spark, sf):
    return parse_envelopes(envelopes(spark, sf))


@query("cdc_row_image", f"""
    select {OP} as op, {', '.join(f"case when event_id % 53 <> 0 then {e} end as {n}" for n, e in LOG_COLUMNS.items())}
    from events where {READABLE}""")
def cdc_row_image(spark, sf):
    return expand_images(row_images(parse_envelopes(envelopes(spark, sf)), IMAGE))


@query("cdc_route_tables", f"""
    select table_name, count(*) as changes, min(event_id) as first_offset, max(event_id) as last_offset
    from (select {TABLE_NAME} as table_name, event_id from events where {READABLE})
    where table_name <> 'users' group by table_name""")
def cdc_route_tables(spark, sf):
    """The shared log cut into its known tables; the unknown one is skipped."""
    parsed = known_tables(parse_envelopes(envelopes(spark, sf, TABLE_NAME)))
    parts = [route(parsed, name).select("table_name", "offset") for name in CAPTURED]
    return reduce(DataFrame.unionByName, parts).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("changes"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"))


def change_log(spark, sf):
    """Events as an ordered log: (customer_id, op, ts, offset, image)."""
    return table(spark, sf, "events").selectExpr(
        "cast(user_id as string) as customer_id", f"{OP} as op", "ts", "event_id as offset",
        f"struct({', '.join(f'{e} as {n}' for n, e in LOG_COLUMNS.items())}) as image")


def customers(spark, sf):
    """Every customer whose key is even is in the target before the log starts."""
    return table(spark, sf, "customer").selectExpr(
        "cast(case when c_custkey % 2 = 0 then c_custkey else c_custkey + 1000000 end as string) as customer_id",
        "c_mktsegment as kind", "cast(cast(c_acctbal as decimal(18,2)) as string) as amount")


CUSTOMERS_SQL = """(select cast(case when c_custkey % 2 = 0 then c_custkey else c_custkey + 1000000 end as varchar)
    as customer_id, c_mktsegment as kind, cast(cast(c_acctbal as decimal(18,2)) as varchar) as amount from customer)"""

LOG_SQL = f"""(select cast(user_id as varchar) as customer_id, {OP} as op, ts, event_id, event_type as kind,
    cast(cast(value as decimal(18,2)) as varchar) as amount from events)"""

# The log position by position: the span after the last delete, its first
# creation, its last update.
NET_SQL = f"""
    log as (select *, row_number() over (partition by customer_id order by ts, event_id) as seq from {LOG_SQL}),
    cut as (select *, coalesce(max(case when op = 'd' then seq end) over (partition by customer_id), 0) as last_d
            from log),
    tail as (select * from cut where seq >= last_d),
    marks as (select customer_id, max(last_d) as last_d,
        min(case when op in ('c', 'r') then seq end) as first_c,
        max(case when op = 'u' then seq end) as last_u from tail group by customer_id),
    net as (select customer_id, last_d > 0 and first_c is null as removes,
        case when first_c is null then null when last_u > first_c then last_u else first_c end as absent_at,
        case when last_d = 0 then last_u when first_c is null then null
             when last_u > first_c then last_u else first_c end as present_at from marks)"""


@query("cdc_net_changes", f"""
    with {NET_SQL}
    select net.customer_id, removes, p.kind as present_kind, p.amount as present_amount,
      a.kind as absent_kind, a.amount as absent_amount
    from net left join log p on p.customer_id = net.customer_id and p.seq = present_at
      left join log a on a.customer_id = net.customer_id and a.seq = absent_at
    where removes or present_at is not null or absent_at is not null""")
def cdc_net_changes(spark, sf):
    net = net_changes(change_log(spark, sf), ["customer_id"], ["ts", "offset"])
    return net.select(
        "customer_id", "removes", F.col("on_present.kind").alias("present_kind"),
        F.col("on_present.amount").alias("present_amount"),
        F.col("on_absent.kind").alias("absent_kind"), F.col("on_absent.amount").alias("absent_amount"))


APPLIED_SQL = f"""
    with {NET_SQL}, target as {CUSTOMERS_SQL}
    select coalesce(t.customer_id, net.customer_id) as customer_id,
      case when i.customer_id is not null then i.kind else t.kind end as kind,
      case when i.customer_id is not null then i.amount else t.amount end as amount
    from target t full outer join net on net.customer_id = t.customer_id
      left join log i on i.customer_id = net.customer_id
        and i.seq = case when t.customer_id is null then absent_at else present_at end
    where (t.customer_id is not null and not coalesce(removes, false)) or i.customer_id is not null"""


@query("cdc_apply_log", APPLIED_SQL)
def cdc_apply_log(spark, sf):
    net = net_changes(change_log(spark, sf), ["customer_id"], ["ts", "offset"])
    return apply_net(customers(spark, sf), net, ["customer_id"])


@query("cdc_merge_ops", f"""
    with src as (select * from {LOG_SQL} qualify row_number() over (
            partition by customer_id order by ts desc, event_id desc) = 1),
      target as {CUSTOMERS_SQL}
    select coalesce(t.customer_id, s.customer_id) as customer_id,
      case when t.customer_id is null or s.op = 'u' then s.kind else t.kind end as kind,
      case when t.customer_id is null or s.op = 'u' then s.amount else t.amount end as amount
    from target t full outer join src s on s.customer_id = t.customer_id
    where (t.customer_id is not null and coalesce(s.op, '') <> 'd')
       or (t.customer_id is null and s.op in ('c', 'r'))""")
def cdc_merge_ops(spark, sf):
    """The single-change MERGE, on each customer's last event."""
    last = keep_one(change_log(spark, sf), ["customer_id"], ["ts", "offset"], last=True)
    changes = last.select("op", "image.*")
    return apply_single_changes(customers(spark, sf), changes, ["customer_id"])


@query("silver_upsert", f"""
    with src as (select customer_id, kind, amount from {LOG_SQL} qualify row_number() over (
            partition by customer_id order by ts desc, event_id desc) = 1)
    select * from src union all
    select * from {CUSTOMERS_SQL} where customer_id not in (select customer_id from src)""")
def silver_upsert(spark, sf):
    last = keep_one(change_log(spark, sf), ["customer_id"], ["ts", "offset"], last=True)
    return upsert(customers(spark, sf), last.select("image.*"), ["customer_id"])


@query("upsert_composite", """
    with src as (select l_orderkey, l_linenumber, l_quantity, l_shipdate from lineitem where l_shipdate >= timestamp '1998-01-01'
        qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_quantity desc) = 1),
      dst as (select l_orderkey, l_linenumber, l_quantity, l_shipdate from lineitem where l_shipdate < timestamp '1998-01-01'
        qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_quantity desc) = 1)
    select l_orderkey, l_linenumber, l_quantity, cast(l_shipdate as varchar) as l_shipdate from (
      select * from src union all
      select dst.* from dst left join src using (l_orderkey, l_linenumber) where src.l_quantity is null)""")
def upsert_composite(spark, sf):
    """Two-column key: lines shipped later replace or join the earlier ones."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    later = F.col("l_shipdate") >= F.expr("timestamp_ntz '1998-01-01'")
    keys = ["l_orderkey", "l_linenumber"]

    def newest(df):
        return keep_one(df, keys, ["l_shipdate", "l_quantity"], last=True)

    merged = upsert(newest(lines.filter(~later)), newest(lines.filter(later)), keys)
    return merged.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@query("insert_if_absent", f"""
    with src as (select cast(o_custkey + 900 as varchar) as customer_id, o_orderpriority as kind,
        cast(cast(o_totalprice as decimal(18,2)) as varchar) as amount, o_orderkey from orders)
    select * from {CUSTOMERS_SQL} union all
    select customer_id, kind, amount from (select * from src qualify row_number() over (
        partition by customer_id order by o_orderkey) = 1)
    where customer_id not in (select customer_id from {CUSTOMERS_SQL})""")
def insert_missing(spark, sf):
    source = table(spark, sf, "orders").selectExpr(
        "cast(o_custkey + 900 as string) as customer_id", "o_orderpriority as kind",
        "cast(cast(o_totalprice as decimal(18,2)) as string) as amount", "o_orderkey")
    return insert_if_absent(customers(spark, sf), source, ["customer_id"], ["o_orderkey"])
