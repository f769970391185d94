"""Streams run to the end of their input, then read back as tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.messages import encode_messages
from ..plans import gold
from ..schemas import CAPTURED, IMAGE_METADATA
from ..session import scratch_dir
from ..sources.metrics import rows_scanned
from ..sources.readers import scan
from ..sources.sinks import append, stream_id, write_topic
from ..streaming.ingest import (
    apply_messages,
    ingest_changes,
    ingest_image_metadata,
    ingest_images,
    ingest_telematics,
)
from ..streaming.follow import References
from ..streaming.refine import SILVER_TABLES, open_silver, start_silver, sums_of
from ..streaming.star import StarJoin
from ..streaming.tables import AppendedTable, open_table
from . import standins
from .changes import IMAGE, LOG_SQL, READABLE, envelopes
from .refined import (
    CLAIM_NAMES,
    CUSTOMER_SQL,
    TELEMATICS_SQL,
    day,
    flat_place,
    lenient,
    place_sql,
)
from .registry import ORACLES, portable, query, single, single_sql, table

CUTS = ("2024-01-11", "2024-01-21")


def finish(*streams) -> None:
    for stream in streams:
        stream.awaitTermination()


def slices(df: DataFrame, column: str = "ts") -> list[DataFrame]:
    """The rows cut at fixed dates, in order; together the whole frame."""
    cuts = [F.expr(f"timestamp_ntz '{c}'") for c in CUTS]
    at = F.col(column).cast("timestamp_ntz")
    return [df.filter(at < cuts[0]), df.filter((at >= cuts[0]) & (at < cuts[1])),
            df.filter(at >= cuts[1])]


@query("stream_json_map_append", f"""select chassis_no, latitude, longitude, event_timestamp, speed
    from {standins.sql('telematics')}""")
def stream_json_map_append(spark, sf):
    """Readings through the topic, in two runs on one checkpoint."""
    root = scratch_dir(spark, "telematics")
    readings = standins.frame(spark, sf, "telematics")
    late = F.coalesce(F.col("chassis_no").cast("bigint") >= 50, F.lit(False))
    for part in (readings.filter(~late), readings.filter(late)):
        write_topic(encode_messages(part, "chassis_no"), folder=f"{root}/topic")
        finish(ingest_telematics(
            spark, {"folder": f"{root}/topic"}, f"{root}/bronze", f"{root}/checkpoint", trigger=None))
    return scan(spark, f"{root}/bronze/telematics")


def write_files(df: DataFrame, folder: str) -> None:
    """One file per (name, content) row, written by the tasks."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        system.create_dir(base, recursive=True)
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                with system.open_output_stream(f"{base}/{name}") as out:
                    out.write(content)
            yield batch[["name"]]

    df.select("name", "content").mapInPandas(write, "name string").write.format("noop").mode(
        "overwrite").save()


@query("stream_binary_append", f"""
    select split_part(path, '/', -1) as name, octet_length(encode(html)) as length, md5(html) as digest
    from (select html, {standins.select_list(standins.path_columns('duckdb'))} from pages)
    where lower(path) like '%.jpg' or lower(path) like '%.jpeg' or lower(path) like '%.png'""")
def stream_binary_append(spark, sf):
    root = scratch_dir(spark, "objects")
    files = table(spark, sf, "pages").selectExpr(
        f"substring_index({standins.path_columns('spark')['path']}, '/', -1) as name",
        "cast(html as binary) as content")
    write_files(files, f"{root}/landing")
    finish(ingest_images(
        spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", "objects", trigger=None))
    return scan(spark, f"{root}/bronze").select(
        F.substring_index(F.regexp_replace("path", "%20", " "), "/", -1).alias("name"), "length",
        F.md5("content").alias("digest"))


@query("stream_csv_append", f"select * from {standins.sql('metadata')}")
def stream_csv_append(spark, sf):
    root = scratch_dir(spark, "metadata")
    rows = standins.frame(spark, sf, "metadata").select(*IMAGE_METADATA.names)
    rows.write.option("header", "true").csv(f"{root}/landing")
    finish(ingest_image_metadata(
        spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", trigger=None))
    return scan(spark, f"{root}/bronze")


TABLE_OF_KEY = "case user_id % 4 when 0 then 'policy' when 1 then 'claim' when 2 then 'customer' else 'users' end"


@query("stream_cdc_apply", f"""
    with log as (select *, row_number() over (partition by customer_id order by epoch_us(ts) // 1000, event_id) as seq
        from (select l.*, {TABLE_OF_KEY} as table_name from {LOG_SQL} l join events using (event_id)
              where {READABLE} and event_id % 53 <> 0)),
    tail as (select * from (select *, coalesce(max(case when op = 'd' then seq end)
        over (partition by customer_id), 0) as last_d from log) where seq >= last_d),
    marks as (select customer_id, min(case when op in ('c', 'r') then seq end) as first_c,
        max(case when op = 'u' then seq end) as last_u from tail group by customer_id)
    select table_name, customer_id, kind, amount from marks join log using (customer_id)
    where table_name <> 'users' and seq = case when last_u > first_c then last_u else first_c end""")
def stream_cdc_apply(spark, sf):
    """The event log in three deliveries into three tables, compacting on the way."""
    root = scratch_dir(spark, "changes")
    messages = envelopes(spark, sf, TABLE_OF_KEY).join(
        table(spark, sf, "events").select(F.col("event_id").alias("offset"), "ts"), "offset")
    tables = {name: (IMAGE, ["customer_id"]) for name in CAPTURED}
    for part in slices(messages):
        write_topic(part.select("key", "value", "offset"), folder=f"{root}/topic")
        finish(ingest_changes(
            spark, {"folder": f"{root}/topic"}, f"{root}/bronze", f"{root}/checkpoint",
            trigger=None, tables=tables))
        for name, (_, keys) in list(tables.items())[:2]:
            open_table(spark, f"{root}/bronze/{name}", keys).compact()
    return reduce(DataFrame.unionByName, [
        open_table(spark, f"{root}/bronze/{name}", keys).read().select(
            F.lit(name).alias("table_name"), *IMAGE.names)
        for name, (_, keys) in tables.items()])


@query("stream_fresh_checkpoint", ORACLES["stream_cdc_apply"])
def stream_fresh_checkpoint(spark, sf):
    """The same log, each delivery under a new checkpoint, as after a lost one: nothing may go missing."""
    root = scratch_dir(spark, "fresh")
    messages = envelopes(spark, sf, TABLE_OF_KEY).join(
        table(spark, sf, "events").select(F.col("event_id").alias("offset"), "ts"), "offset")
    tables = {name: (IMAGE, ["customer_id"]) for name in CAPTURED}
    for n, part in enumerate(slices(messages)):
        write_topic(part.select("key", "value", "offset"), folder=f"{root}/topic-{n}")
        for _ in range(2):  # the second run finds nothing new
            finish(ingest_changes(spark, {"folder": f"{root}/topic-{n}"}, f"{root}/bronze",
                                  f"{root}/checkpoint-{n}", trigger=None, tables=tables))
    return reduce(DataFrame.unionByName, [
        open_table(spark, f"{root}/bronze/{name}", keys).read().select(
            F.lit(name).alias("table_name"), *IMAGE.names)
        for name, (_, keys) in tables.items()])


TOUCHED = "c_custkey % 500 = 7"
KEY_BUCKET = "('0x' || substr(md5(cast(c_custkey as varchar)), 1, 8))::bigint % 64"


@query("cdc_touched_rows", f"""
    with held as (select c_custkey, c_custkey % 3 as part, {KEY_BUCKET} as bucket from customer)
    select n as delivery, count(*) filter (part < n and bucket in (select bucket from held where {TOUCHED})) as rows_read,
      count(*) filter (part < n and {TOUCHED}) as found, count(*) filter (part < n) as rows_held
    from held, (select unnest([0, 1, 2, 3]) as n) where n > 0 group by n""")
def cdc_touched_rows(spark, sf):
    """What a batch reads of its table to find the rows of its own keys: no more than the buckets these lie in."""
    customers = table(spark, sf, "customer").select(F.lit("s").alias("op"), "c_custkey", "c_name")
    state = open_table(spark, f"{scratch_dir(spark, 'touched')}/customer", ["c_custkey"], buckets=64)
    batch, rows = customers.where(TOUCHED).drop("op"), []
    for n in range(3):
        state.write(n, lambda before, n=n: customers.where(F.col("c_custkey") % 3 == n))
        if n == 1:
            state.compact()
        present = state.read(touching=batch, columns=["c_custkey"])
        found = present.join(batch, "c_custkey", "left_semi").count()
        rows.append((n + 1, rows_scanned(present, state.path), found, state.read().count()))
    return spark.createDataFrame(rows, "delivery int, rows_read long, found long, rows_held long")


@query("stream_quarantine", f"""
    select reason, sum(n)::bigint as messages, sum(v)::bigint as offsets from (
      select case when event_id % 43 = 0 then 'tombstone' when event_id % 47 = 0 then 'unreadable'
        when {TABLE_OF_KEY} = 'users' then 'table not captured' when event_id % 53 = 0 then 'no key' else 'kept' end as reason,
        1 as n, event_id as v from events)
    group by reason""")
def stream_quarantine(spark, sf):
    """The event log in three deliveries, one of them under a checkpoint that is replayed: kept and refused messages are all."""
    root = scratch_dir(spark, "quarantine")
    messages = envelopes(spark, sf, TABLE_OF_KEY).join(
        table(spark, sf, "events").select(F.col("event_id").alias("offset"), "ts"), "offset")
    tables = {name: (IMAGE, ["customer_id"]) for name in CAPTURED}
    for part in slices(messages):
        write_topic(part.select("key", "value", "offset"), folder=f"{root}/topic")
        finish(ingest_changes(spark, {"folder": f"{root}/topic"}, f"{root}/bronze", f"{root}/checkpoint",
                              trigger=None, tables=tables, quarantine=f"{root}/refused"))
    last = part.select("key", "value", "offset")
    apply_messages(last, 2, f"{root}/bronze", f"{root}/refused", tables=tables, stream=stream_id(spark, f"{root}/checkpoint"))
    refused = AppendedTable(spark, f"{root}/refused/messages").read()
    counts = AppendedTable(spark, f"{root}/refused/counts").read()
    by_reason = refused.groupBy("reason").agg(F.count("*").alias("messages"), F.sum("offset").alias("offsets"))
    # What was kept is what was not refused: of the topic's offsets, and in the counts.
    topic = scan(spark, f"{root}/topic").agg(F.sum("offset").alias("all"))
    kept = counts.agg(F.sum("kept").alias("messages")).join(topic).join(refused.agg(F.sum("offset").alias("gone")))  # one row each
    return by_reason.unionByName(kept.select(F.lit("kept").alias("reason"), "messages", (F.col("all") - F.col("gone")).alias("offsets")))


@query("check_references_kept", """
    with parents as (select c_custkey from customer where c_custkey % 7 <> 0 or c_custkey % 21 = 0),
      children as (select case when o_orderkey % 5 = 0 then o_custkey + 1000000 else o_custkey end as o_custkey from orders
        where o_orderkey % 11 <> 0 and o_orderkey % 13 <> 0),
      lost as (select o_custkey, count(*) as n from children where o_custkey not in (select c_custkey from parents) group by 1)
    select 'foreign_key(o_custkey)' as check_name, count(*) as violations, coalesce(sum(n), 0)::bigint as orphan_rows,
      sum(o_custkey)::bigint as lost_values from lost""")
def check_references_kept(spark, sf):
    """A foreign key's violations, kept up through inserts, replacements and deletes on both sides."""
    root = scratch_dir(spark, "references")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    parent, child = (open_table(spark, f"{root}/{name}", [key]) for name, key in (("customer", "c_custkey"), ("orders", "o_orderkey")))
    kept = References(child, "o_custkey", parent, f"{root}/kept")
    deliver = lambda target, n, op, rows: target.write(n, lambda before: rows.select(F.lit(op).alias("op"), "*"))
    deliver(parent, 0, "s", customers)
    deliver(child, 0, "s", orders.where("o_orderkey % 13 <> 0"))
    kept.follow()
    deliver(parent, 1, "d", customers.where("c_custkey % 7 = 0"))
    deliver(child, 1, "s", orders.where("o_orderkey % 5 = 0 and o_orderkey % 13 <> 0").withColumn("o_custkey", F.col("o_custkey") + 1_000_000))
    kept.follow()
    kept.follow()  # nothing new
    deliver(child, 2, "d", orders.where("o_orderkey % 11 = 0"))
    deliver(parent, 2, "s", customers.where("c_custkey % 21 = 0"))
    kept.follow()
    lost = kept.orphans().agg(F.sum(F.col("value").cast("long")).alias("lost_values"))
    return kept.check().join(lost)  # one row each


@query("gold_star_kept", """
    with claims as (select l_orderkey * 10 + l_linenumber as claim_no,
        case when (l_orderkey * 10 + l_linenumber) % 23 = 0 then 2 when l_orderkey % 3 = 0 then 1 else l_orderkey end as policy_no,
        l_shipmode from (select distinct l_orderkey, l_linenumber, l_returnflag as l_shipmode from lineitem
          qualify row_number() over (partition by l_orderkey, l_linenumber order by l_returnflag) = 1)
      where (l_orderkey * 10 + l_linenumber) % 19 <> 0),
      policies as (select o_orderkey as policy_no, o_custkey as cust_id,
        case when o_orderkey % 10 = 1 then -1.0 else o_totalprice end as premium from orders where o_orderkey % 17 <> 0),
      people as (select c_custkey as customer_id, case when c_custkey % 27 = 0 then 'back' else c_name end as name
        from customer where c_custkey % 9 <> 0 or c_custkey % 27 = 0)
    select claim_no, policy_no, cust_id, l_shipmode as flag, premium, name
    from claims join policies using (policy_no) join people on cust_id = customer_id""")
def gold_star_kept(spark, sf):
    """The claim star join kept up through changes on each side; one policy holds a third of the claims."""
    root = scratch_dir(spark, "star")
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_returnflag").alias("flag"))
    claims = lines.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("claim_no"), F.when(
        F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_orderkey")).alias("policy_no"), "flag")
    policies = table(spark, sf, "orders").selectExpr("o_orderkey as policy_no", "o_custkey as cust_id", "o_totalprice as premium")
    people = table(spark, sf, "customer").selectExpr("c_custkey as customer_id", "c_name as name")
    claim, policy, customer = (open_table(spark, f"{root}/{name}", [key], buckets=8) for name, key in (
        ("claim", "claim_no"), ("policy", "policy_no"), ("customer", "customer_id")))
    star = StarJoin(claim, policy, customer, f"{root}/gold", buckets=8)
    deliver = lambda target, n, *parts: target.write(n, lambda before: reduce(
        DataFrame.unionByName, [rows.select(F.lit(op).alias("op"), "*") for op, rows in parts]))
    deliver(claim, 0, ("s", claims))
    deliver(policy, 0, ("s", policies))
    deliver(customer, 0, ("s", people))
    star.follow()
    deliver(policy, 1, ("s", policies.where("policy_no % 10 = 1").withColumn("premium", F.lit(-1.0))), ("d", policies.where("policy_no % 17 = 0 and policy_no % 10 <> 1")))
    deliver(policy, 2, ("d", policies.where("policy_no % 17 = 0")))
    deliver(customer, 1, ("d", people.where("customer_id % 9 = 0")))
    deliver(claim, 1, ("d", claims.where("claim_no % 19 = 0")),
            ("s", claims.where("claim_no % 23 = 0 and claim_no % 19 <> 0").withColumn("policy_no", F.lit(2).cast("long"))))
    star.follow()
    deliver(customer, 2, ("s", people.where("customer_id % 27 = 0").withColumn("name", F.lit("back"))))
    star.follow()
    star.follow()  # nothing new
    return star.table.read().select("claim_no", "policy_no", "cust_id", "flag", "premium", "name")


def set_age(spark, folder: str, days: int) -> None:
    """Date the files of a folder back, as a copy that keeps times would."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for status in system.listStatus(path):
        system.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


@query("stream_late_file", f"""select chassis_no, latitude, longitude, event_timestamp, speed
    from {standins.sql('telematics')}""")
def stream_late_file(spark, sf):
    """New files first, then files a month older: the second run must take them."""
    root = scratch_dir(spark, "late")
    readings = standins.frame(spark, sf, "telematics")
    late = F.coalesce(F.col("chassis_no").cast("bigint") % 2 == 0, F.lit(True))
    for part, days in ((readings.filter(~late), 0), (readings.filter(late), 30)):
        write_topic(encode_messages(part, "chassis_no"), folder=f"{root}/topic-{days}")
        set_age(spark, f"{root}/topic-{days}", days)
        finish(ingest_telematics(spark, {"folder": f"{root}/topic-*"}, f"{root}/bronze", f"{root}/checkpoint", trigger=None))
    return scan(spark, f"{root}/bronze/telematics")


CUT = "timestamp '2024-01-15 00:00:00'"


@query("stream_silver_upsert", f"""
    with typed as ({TELEMATICS_SQL}),
      s1 as (select * from typed where event_timestamp < {CUT}),
      m1 as (select chassis_no, avg(speed) as mean from s1 group by chassis_no),
      s2 as (select t.* replace (coalesce(speed, mean) as speed) from typed t left join m1 using (chassis_no)
             where event_timestamp >= {CUT}),
      m2 as (select chassis_no, avg(speed) as mean from (select * from s1 union all select * from s2) group by chassis_no),
      s3 as (select s1.* replace (coalesce(speed, mean) as speed) from s1 left join m2 using (chassis_no))
    select chassis_no, latitude, longitude, cast(event_timestamp as varchar) as event_timestamp,
      {single_sql('speed')} as speed
    from (select * from s3 union all select * from s2)""")
def stream_silver_upsert(spark, sf):
    """Early readings, late readings, then the early ones again: the second and
    third delivery impute from the silver table, the third replaces rows."""
    root = scratch_dir(spark, "silver")
    readings = standins.frame(spark, sf, "telematics")
    early = F.coalesce(F.col("event_timestamp") < F.lit("2024-01-15"), F.lit(True))
    telematics = [t for t in SILVER_TABLES if t.name == "telematics"]
    for part in (readings.filter(early), readings.filter(~early), readings.filter(early)):
        append(part, f"{root}/bronze/telematics")
        finish(*start_silver(
            spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoints", trigger=None,
            tables=telematics))
    silver = open_table(spark, f"{root}/silver/telematics", telematics[0].keys).read()
    return single(portable(silver), "speed")


@query("telematics_running_sums", f"""
    select chassis_no, count(*) as readings, {', '.join(f"{single_sql(f'avg({c})')} as {c}" for c in ('speed', 'latitude', 'longitude'))}
    from ({ORACLES['stream_silver_upsert']}) group by chassis_no""")
def telematics_running_sums(spark, sf):
    """Averages per vehicle kept up by the deliveries of ``stream_silver_upsert``, against a recount of the table."""
    root = scratch_dir(spark, "sums")
    readings = standins.frame(spark, sf, "telematics")
    early = F.coalesce(F.col("event_timestamp") < F.lit("2024-01-15"), F.lit(True))
    (telematics,) = [t for t in SILVER_TABLES if t.name == "telematics"]
    for part in (readings.filter(early), readings.filter(~early), readings.filter(early)):
        append(part, f"{root}/bronze/telematics")
        finish(*start_silver(
            spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoints", trigger=None, tables=[telematics]))
        open_silver(spark, telematics, f"{root}/silver").compact()
    sums = sums_of(spark, telematics, f"{root}/silver")
    counts = sums.table.read(columns=["rows"]).withColumnRenamed("rows", "readings")
    return single(counts.join(sums.averages(), "chassis_no"), "speed", "latitude", "longitude")


@query("stream_copies", f"""
    select case when event_timestamp < {CUT} then 0 else 1 end as delivery, count(*) as rows_set from ({TELEMATICS_SQL}) group by 1""")
def stream_copies(spark, sf):
    """Early readings, then the same ones again with the late ones: the copies are not written again."""
    root = scratch_dir(spark, "copies")
    readings = standins.frame(spark, sf, "telematics")
    early = F.coalesce(F.col("event_timestamp") < F.lit("2024-01-15"), F.lit(True))
    (telematics,) = [t for t in SILVER_TABLES if t.name == "telematics"]
    silver, parts, last = open_silver(spark, telematics, f"{root}/silver"), [], None
    for run, part in enumerate((readings.filter(early), readings)):
        append(part, f"{root}/bronze/telematics")
        finish(*start_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoints", trigger=None,
                             tables=[telematics], copies_within="1 hour"))
        numbers = silver.deliveries(last)  # a batch without rows may follow, to advance the watermark
        last = numbers[-1]
        parts += [silver.delivered(n).select(F.lit(run).alias("delivery")) for n in numbers]
    return reduce(DataFrame.unionByName, parts).groupBy("delivery").agg(F.count("*").alias("rows_set"))


def captured_changes(spark, sf):
    """Create messages for every customer, policy and claim, then a second
    change for every policy: one in 97 is deleted, the others are updated."""

    def messages(frame: DataFrame, name: str, op: str, step: int) -> DataFrame:
        image = F.to_json(F.struct(*CAPTURED[name][0].names))
        kind = F.expr(op)
        value = F.to_json(F.struct(
            F.when(kind == "d", image).alias("before"),
            F.when(kind != "d", image).alias("after"),
            F.struct(F.lit(name).alias("table")).alias("source"),
            kind.alias("op"), F.lit(step).cast("bigint").alias("ts_ms")))
        return frame.select(
            F.col(CAPTURED[name][1][0]).alias("key"), value.alias("value"),
            F.lit(0).cast("bigint").alias("offset"))

    deleted_or_updated = "case when cast(policy_no as bigint) % 97 = 0 then 'd' else 'u' end"
    parts = [
        messages(standins.frame(spark, sf, "customer"), "customer", "'c'", 1),
        messages(standins.frame(spark, sf, "policy"), "policy", "'c'", 1),
        messages(standins.frame(spark, sf, "policy", copy=1), "policy", deleted_or_updated, 2),
        messages(standins.frame(spark, sf, "claim"), "claim", "'c'", 1),
    ]
    return reduce(DataFrame.unionByName, parts)


def _first_claims() -> str:
    """Creations of one key at one time: the log takes the least image."""
    names = ", ".join(f"{c} nulls first" for c in CLAIM_NAMES)
    return (f"(select * from {standins.sql('claim')} qualify row_number() over "
            f"(partition by claim_no order by {names}) = 1)")


MEDALLION_CLAIM = f"""
    select claim_no, policy_no, {day('claim_date')} as claim_date, {lenient('total', 'bigint')} as total,
      case when {lenient('incident_hour')} < 0 then 0 when {lenient('incident_hour')} > 23 then 23
           else {lenient('incident_hour')} end as incident_hour
    from {_first_claims()}"""
MEDALLION_POLICY = f"""
    select policy_no, {lenient('cust_id')} as cust_id, chassis_no, use_of_vehicle,
      abs(try_cast(premium as decimal(10,2))) as premium
    from {standins.sql('policy', copy=1)} where cust_id is not null and cast(policy_no as bigint) % 97 <> 0"""


@query("medallion_run", f"""
    select claim_no, policy_no, chassis_no, cust_id, cast(claim_date as varchar) as claim_date, total,
      incident_hour, use_of_vehicle, cast(premium as double) as premium, firstname, address,
      {place_sql('address')}, avg_speed, avg_latitude, avg_longitude
    from ({MEDALLION_CLAIM}) join ({MEDALLION_POLICY}) using (policy_no)
      join ({CUSTOMER_SQL}) on cust_id = customer_id
      join (select chassis_no, {single_sql('avg(speed)')} as avg_speed, {single_sql('avg(latitude)')} as avg_latitude,
              {single_sql('avg(longitude)')} as avg_longitude from ({TELEMATICS_SQL}) group by chassis_no) using (chassis_no)""")
def medallion_run(spark, sf):
    """Topics to bronze to silver to gold: the whole chain."""
    root = scratch_dir(spark, "medallion")
    write_topic(captured_changes(spark, sf), folder=f"{root}/topics/changes")
    write_topic(encode_messages(standins.frame(spark, sf, "telematics"), "chassis_no"),
                folder=f"{root}/topics/telematics")
    finish(
        ingest_changes(spark, {"folder": f"{root}/topics/changes"}, f"{root}/bronze",
                       f"{root}/checkpoints/changes", trigger=None),
        ingest_telematics(spark, {"folder": f"{root}/topics/telematics"}, f"{root}/bronze",
                          f"{root}/checkpoints/telematics", trigger=None),
    )
    wanted = [t for t in SILVER_TABLES if t.name in gold.SILVER_KEYS]
    finish(*start_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoints/silver",
                         trigger=None, tables=wanted))
    gold.build_gold(spark, f"{root}/silver", f"{root}/gold")
    enriched = portable(flat_place(scan(spark, f"{root}/gold/customer_claim_policy_telematics")))
    return single(enriched, "avg_speed", "avg_latitude", "avg_longitude").select(
        "claim_no", "policy_no", "chassis_no", "cust_id", "claim_date", "total", "incident_hour",
        "use_of_vehicle", "premium", "firstname", "address", "latitude", "longitude",
        "avg_speed", "avg_latitude", "avg_longitude")
