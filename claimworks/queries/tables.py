"""Counts, table checks, CSV extracts, labels, split and training."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.messages import encode_messages
from ..operators import checks
from ..operators.checks import check_declared
from ..operators.labels import accuracy_pct, label_indexer
from ..operators.merge import absent_rows
from ..operators.split import stratified_split
from ..plans import load
from ..plans.publish import counted
from ..plans.training import CHANNEL_MEAN, CHANNEL_STD, Params, pixel_features, train
from ..schemas import DECLARED
from ..session import freed_shuffles, scratch_dir, small_scans
from ..sources.readers import scan, scan_csv
from ..sources.sinks import append, create_if_absent, overwrite, write_topic
from . import standins
from .registry import portable, query, single, single_sql, table
from .streams import write_files


@query("count_rows", "select count(*) as messages, count(*) as sent from lineitem")
def count_rows(spark, sf):
    """Rows counted while they are written, against the written folder."""
    folder = scratch_dir(spark, "topic")
    lines = table(spark, sf, "lineitem").withColumn("chassis_no", F.col("l_suppkey").cast("string"))
    messages, seen = counted(encode_messages(lines, "chassis_no"))
    write_topic(messages, folder=folder)
    sent = seen.get["rows"]
    return scan(spark, folder).agg(F.count(F.lit(1)).alias("messages")).withColumn(
        "sent", F.lit(sent).cast("bigint"))


@query("check_unique", """
    select 'unique(l_orderkey,l_linenumber)' as check_name, count(*) as violations
    from (select l_orderkey from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
    union all
    select 'unique(o_orderkey)', count(*) from (select o_orderkey from orders group by 1 having count(*) > 1)""")
def check_unique(spark, sf):
    return checks.check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).unionByName(
        checks.check_unique(table(spark, sf, "orders"), ["o_orderkey"]))


@query("check_not_null", f"""
    select 'not_null(chassis_no)' as check_name, count(*) - count(chassis_no) as violations
    from {standins.sql('telematics')} union all
    select 'not_null(speed)', count(*) - count(speed) from {standins.sql('telematics')}""")
def check_not_null(spark, sf):
    return checks.check_not_null(standins.frame(spark, sf, "telematics"), ["chassis_no", "speed"])


@query("check_foreign_key", """
    select 'foreign_key(c_custkey)' as check_name, count(distinct c_custkey) as violations, count(*) as orphan_rows
    from customer where c_custkey not in (select user_id from events)""")
def check_foreign_key(spark, sf):
    users = table(spark, sf, "events").select("user_id")
    return checks.check_foreign_key(table(spark, sf, "customer"), "c_custkey", users, "user_id")


@query("check_domain", """
    select 'length(o_orderpriority)<=8' as check_name, count(*) filter (length(o_orderpriority) > 8) as violations from orders
    union all select 'length(o_orderstatus)<=1', count(*) filter (length(o_orderstatus) > 1) from orders
    union all select 'numeric(o_totalprice,7,2)', count(*) filter (o_totalprice >= 99999.995) from orders""")
def check_domain(spark, sf):
    return checks.check_domain(
        table(spark, sf, "orders"), {"o_orderpriority": 8, "o_orderstatus": 1},
        {"o_totalprice": (7, 2)})


CSV_CUSTOMER = {
    "customer_id": "case when c_custkey % 17 = 0 then 'x' else cast(c_custkey as string) || '.0' end",
    "date_of_birth": "case when c_custkey % 9 = 0 then '1980-01-02' else "
                     "cast(1 + c_custkey % 28 as string) || '-0' || cast(1 + c_custkey % 9 as string) || '-19' "
                     "|| cast(50 + c_custkey % 50 as string) end",
    "borough": "case when c_custkey % 6 = 0 then 'null' when c_custkey % 5 = 0 then 'NA' else c_mktsegment end",
    "neighborhood": "case when c_custkey % 7 = 0 then null else c_mktsegment || ', north' end",
    "zip_code": "'0' || cast(10000 + c_nationkey as string)",
    "name": "case c_custkey % 4 when 0 then '\"\"' || c_name || ', Jo\"' when 1 then null else c_name end",
}
TOKENS = "('null', 'NA', '', 'nan', 'None')"


def _csv_sql(c: str) -> str:
    return f"case when {c} not in {TOKENS} then {c} end"


def customer_csv(spark, sf):
    folder = scratch_dir(spark, "csv")
    table(spark, sf, "customer").selectExpr(*[f"{e} as {n}" for n, e in CSV_CUSTOMER.items()]).write.option(
        "header", "true").option("escape", '"').csv(folder)
    return scan_csv(spark, folder)


@query("csv_scan_null_tokens", f"""
    select {', '.join(f'{_csv_sql(c)} as {c}' for c in CSV_CUSTOMER)}
    from (select {standins.select_list(CSV_CUSTOMER)} from customer)""")
def csv_scan_null_tokens(spark, sf):
    return customer_csv(spark, sf)


@query("clean_customers", f"""
    select cast(try_cast(customer_id as double) as bigint) as customer_id,
      cast(cast(try_strptime(date_of_birth, '%d-%m-%Y') as date) as varchar) as date_of_birth,
      {_csv_sql('borough')} as borough, {_csv_sql('neighborhood')} as neighborhood, zip_code,
      replace(trim(name, '" '), ',', '') as name
    from (select {standins.select_list(CSV_CUSTOMER)} from customer)
    where try_cast(customer_id as double) is not null""")
def clean_customers(spark, sf):
    return portable(load.load_customers(customer_csv(spark, sf)))


DATE_TEXT = "substr(cast({0} as string), 1, 10)"
CSV_POLICY = {
    "POLICY_NO": "case when o_orderkey % 61 = 0 then null else cast(o_orderkey as string) end",
    "CUST_ID": "case when o_orderkey % 5 = 0 then cast(o_custkey as string) || '.0' "
               "when o_orderkey % 7 = 0 then 'bad' else cast(o_custkey as string) end",
    "POLICYTYPE": "o_orderpriority",
    "POL_ISSUE_DATE": f"case when o_orderkey % 11 = 0 then 'soon' else {DATE_TEXT.format('o_orderdate')} end",
    "POL_EFF_DATE": "cast(o_orderdate as string)",
    "POL_EXPIRY_DATE": "case when o_orderkey % 13 = 0 then null else " + DATE_TEXT.format("o_orderdate") + " end",
    "MAKE": "o_orderstatus", "MODEL": "o_orderpriority",
    "MODEL_YEAR": "case when o_orderkey % 3 = 0 then '2001.0' when o_orderkey % 4 = 0 then '2001.5' else '1999' end",
    "CHASSIS_NO": "cast(o_custkey as string)", "USE_OF_VEHICLE": "'private'", "PRODUCT": "o_orderstatus",
    "SUM_INSURED": "cast(cast(o_totalprice as decimal(18,2)) as string)", "PREMIUM": "'12.50'",
    "DEDUCTABLE": "'500'",
}


def _quoted(columns: dict[str, str]) -> str:
    return ", ".join(f'{expr} as "{name}"' for name, expr in columns.items())


def _whole(c: str) -> str:
    return (f"case when try_cast({c} as double) = floor(try_cast({c} as double)) "
            f"then cast(try_cast({c} as double) as bigint) end")


def _iso(c: str) -> str:
    return (f"cast(cast(coalesce(try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%Y-%m-%d %H:%M:%S')) "
            f"as date) as varchar)")


@query("clean_policies", f"""
    select POLICY_NO as policy_no, cast({_whole('CUST_ID')} as varchar) as cust_id, POLICYTYPE as policytype,
      {_iso('POL_ISSUE_DATE')} as pol_issue_date, {_iso('POL_EFF_DATE')} as pol_eff_date,
      {_iso('POL_EXPIRY_DATE')} as pol_expiry_date, MAKE as make, MODEL as model,
      {_whole('MODEL_YEAR')} as model_year, CHASSIS_NO as chassis_no, USE_OF_VEHICLE as use_of_vehicle,
      PRODUCT as product, SUM_INSURED as sum_insured, PREMIUM as premium, DEDUCTABLE as deductable
    from (select {_quoted(CSV_POLICY)} from orders) where POLICY_NO is not null""")
def clean_policies(spark, sf):
    extract = table(spark, sf, "orders").selectExpr(*[f"{e} as {n}" for n, e in CSV_POLICY.items()])
    return portable(load.load_policies(extract))


@query("csv_rename_map", f"""
    select {', '.join(f'"{a}" as {b}' for a, b in load.POLICY_NAMES.items())}
    from (select {_quoted(CSV_POLICY)} from orders)""")
def csv_rename_map(spark, sf):
    extract = table(spark, sf, "orders").selectExpr(*[f"{e} as {n}" for n, e in CSV_POLICY.items()])
    return load.rename(extract, load.POLICY_NAMES)


CSV_CLAIM = {
    "claim_no": "case when l_partkey % 71 = 0 then null else cast(l_orderkey as string) || '-' || cast(l_linenumber as string) end",
    "policy_no": "cast(l_orderkey as string)",
    "claim_date": DATE_TEXT.format("l_shipdate"),
    "months_as_customer": "case when l_partkey % 6 = 0 then 'many' else cast(l_partkey % 400 as string) end",
    "injury": "cast(l_partkey as string) || '.0'", "property": "cast(l_suppkey as string)",
    "vehicle": "case when l_suppkey % 9 = 0 then '10.5' else cast(l_suppkey as string) end",
    "total": "cast(l_partkey + l_suppkey as string)",
    "collision_type": "case l_partkey % 4 when 0 then 'null' when 1 then ' Front ' when 2 then null else l_returnflag end",
    "number_of_vehicles_involved": "'2'", "age": "cast(20 + l_partkey % 50 as string)",
    "insured_relationship": "l_linestatus",
    "license_issue_date": "'0' || cast(1 + l_linenumber as string) || '-11-2001'",
    "date": DATE_TEXT.format("l_shipdate"), "hour": "cast(l_partkey % 24 as string)",
    "type": "l_returnflag", "severity": "l_linestatus",
    "number_of_witnesses": "cast(l_linenumber as string)",
    "suspicious_activity": "case l_partkey % 4 when 0 then 'TRUE' when 1 then 'false' when 2 then 't' else null end",
}


@query("clean_claims", f"""
    select claim_no, policy_no, {_iso('claim_date')} as claim_date,
      {', '.join(f'{_whole(c)} as {c}' for c in ('months_as_customer', 'injury', 'property', 'vehicle', 'total'))},
      trim(nullif(collision_type, 'null')) as collision_type, {_whole('number_of_vehicles_involved')}
        as number_of_vehicles_involved, {_whole('age')} as driver_age, insured_relationship,
      cast(cast(try_strptime(license_issue_date, '%d-%m-%Y') as date) as varchar) as license_issue_date,
      {_iso('"date"')} as incident_date, {_whole('"hour"')} as incident_hour, "type" as incident_type,
      severity as incident_severity, {_whole('number_of_witnesses')} as number_of_witnesses,
      case lower(suspicious_activity) when 'true' then true when 'false' then false end as suspicious_activity
    from (select {_quoted(CSV_CLAIM)} from lineitem) where claim_no is not null""")
def clean_claims(spark, sf):
    extract = table(spark, sf, "lineitem").selectExpr(*[f"{e} as `{n}`" for n, e in CSV_CLAIM.items()])
    return portable(load.load_claims(extract))


BROKEN_CUSTOMER = {**CSV_CUSTOMER, "neighborhood": "case when c_custkey % 7 = 0 then null else c_mktsegment || chr(10) || 'north, \"1\"' end"}
SURPLUS_ROWS = "c_custkey % 50 = 0"


def some_files(rows: DataFrame) -> int:
    """How many files of some ten thousand records the rows make."""
    return max(1, -(-rows.count() // 20_000))


def customer_files(spark, sf, folder: str, surplus: bool = False) -> str:
    """Customer extracts of a thousand records, some fields with line breaks, some records with a field too many."""
    customer = table(spark, sf, "customer")
    values = F.struct(*[F.expr(e).cast("string").alias(n) for n, e in BROKEN_CUSTOMER.items()])
    line = F.to_csv(values, {"quoteAll": "true", "escape": '"'})
    if surplus:
        line = F.when(F.expr(SURPLUS_ROWS), F.concat(line, F.lit(",more"))).otherwise(line)
    # Text is made and put together behind the shuffle, in tasks of some ten thousand records.
    dealt = customer.withColumn("n", F.floor(F.col("c_custkey") / 1000)).repartition(some_files(customer), "n")
    files = dealt.select("n", line.alias("line")).groupBy("n").agg(F.array_join(F.collect_list("line"), "\n").alias("lines"))
    header = F.lit(",".join(BROKEN_CUSTOMER) + "\n")
    with small_scans(spark):
        write_files(files.select(F.concat(F.lit("part-"), F.col("n").cast("string"), F.lit(".csv")).alias("name"),
                                 F.concat(header, "lines").cast("binary").alias("content")), folder)
    return folder


@query("csv_quoted_breaks", f"""
    select {', '.join(f'{_csv_sql(c)} as {c}' for c in BROKEN_CUSTOMER)}
    from (select {standins.select_list(BROKEN_CUSTOMER)} from customer)""")
def csv_quoted_breaks(spark, sf):
    return scan_csv(spark, customer_files(spark, sf, scratch_dir(spark, "breaks")))


def extracts(spark, sf, surplus: bool = False, copies: int = 1) -> dict[str, str]:
    """The three extracts; with copies, every policy and claim again behind all first records, one column changed."""
    root = scratch_dir(spark, "extracts")

    def written(name: str, source: str, columns: dict[str, str], key: str, changed: str) -> str:
        rows = table(spark, sf, source)
        # Files of some ten thousand records each; all records of a key in one of them, first copies first. The source's
        # rows are dealt, as the wide texts made of them would fill the memory of the tasks that deal; those
        # without a key, which may be many, go anywhere.
        files, number = some_files(rows), F.expr(columns[key])
        anywhere = F.when(number.isNull(), F.xxhash64(*[F.expr(e) for e in columns.values()]))
        copied = reduce(DataFrame.unionByName, [rows.withColumn("copy", F.lit(k)) for k in range(copies)])
        texts = copied.repartition(files, number, anywhere).selectExpr(*[f"{e} as `{n}`" for n, e in columns.items()], "copy")
        texts = texts.withColumn(changed, F.when(F.col("copy") == 0, F.col(f"`{changed}`")).otherwise(
            F.concat(F.lit("copy "), F.col("copy").cast("string"))))
        with small_scans(spark), freed_shuffles(spark):  # packed, the texts take less than half the room
            texts.sortWithinPartitions("copy").drop("copy").write.option("header", "true").option("escape", '"').option(
                "compression", "gzip").option("zlib.compress.level", "BEST_SPEED").csv(f"{root}/{name}")
        return f"{root}/{name}"

    return {"customer": customer_files(spark, sf, f"{root}/customer", surplus),
            "policy": written("policy", "orders", CSV_POLICY, "POLICY_NO", "PRODUCT"),
            "claim": written("claim", "lineitem", CSV_CLAIM, "claim_no", "severity")}


def _rejects_sql() -> str:
    def source(columns: dict[str, str], name: str, where: str = "true") -> str:
        raw = f"(select {_quoted(columns)} from {name} where {where})"
        return "(select " + ", ".join(f'{_csv_sql(chr(34) + c + chr(34))} as "{c}"' for c in columns) + f" from {raw})"

    def date(c: str, pattern: str) -> str:
        return f"try_strptime({c}, '{pattern}')"

    customers = source(BROKEN_CUSTOMER, "customer", f"not ({SURPLUS_ROWS})")
    policies, claims = source(CSV_POLICY, "orders"), source(CSV_CLAIM, "lineitem")
    numbers = ("months_as_customer", "injury", "property", "vehicle", "total", "number_of_vehicles_involved", "age",
               "hour", "number_of_witnesses")
    cases = [("customer", customers, "customer_id", _whole("customer_id"), {"date_of_birth": date("date_of_birth", "%d-%m-%Y")}),
             ("policy", policies, "POLICY_NO", "POLICY_NO", {
                 "CUST_ID": _whole("CUST_ID"), "MODEL_YEAR": _whole("MODEL_YEAR"),
                 **{c: _iso(c) for c in ("POL_ISSUE_DATE", "POL_EFF_DATE", "POL_EXPIRY_DATE")}}),
             ("claim", claims, "claim_no", "claim_no", {
                 **{c: _whole(f'"{c}"') for c in numbers}, "claim_date": _iso("claim_date"), "date": _iso('"date"'),
                 "license_issue_date": date("license_issue_date", "%d-%m-%Y"),
                 "suspicious_activity": "case lower(suspicious_activity) when 'true' then 1 when 'false' then 0 end"})]
    parts = [f"select 'customer' as extract, 'surplus fields' as reason, count(*) as records from customer where {SURPLUS_ROWS}"]
    for name, rows, key, typed, rules in cases:
        names = load.POLICY_NAMES if name == "policy" else load.CLAIM_NAMES if name == "claim" else {}
        parts.append(f"select '{name}', 'no key', count(*) from {rows} where ({typed}) is null")
        parts += [f"""select '{name}', 'unreadable {names.get(c, c)}', count(*) from {rows}
            where ({typed}) is not null and "{c}" is not null and ({rule}) is null""" for c, rule in rules.items()]
    return f"select * from ({' union all '.join(parts)}) where records > 0"


@query("load_rejects", _rejects_sql())
def load_rejects(spark, sf):
    """What a load of the three extracts leaves out, by reason."""
    return load.reject_counts(spark, extracts(spark, sf, surplus=True))


LOADED_SQL = f"""
    select 'customer' as table_name, cast(customer_id as varchar) as key, neighborhood as value
      from (select {_whole('customer_id')} as customer_id, {_csv_sql('neighborhood')} as neighborhood
            from (select {standins.select_list(BROKEN_CUSTOMER)} from customer)) where customer_id is not null
    union all select distinct 'policy', POLICY_NO, 'first' from (select {_quoted(CSV_POLICY)} from orders) where POLICY_NO is not null
    union all select distinct 'claim', claim_no, 'first' from (select {_quoted(CSV_CLAIM)} from lineitem) where claim_no is not null"""


def loaded_keys(spark, root: str, numbered: bool = False) -> DataFrame:
    copy = "case when {} like 'copy %' then 'later' else 'first' end"
    columns = {"customer": ("customer_id", "neighborhood"), "policy": ("policy_no", copy.format("product")),
               "claim": ("claim_no", copy.format("incident_severity"))}
    more = ["load"] if numbered else []
    return reduce(DataFrame.unionByName, [
        load.loaded(spark, root, name, numbered=numbered).select(
            F.lit(name).alias("table_name"), F.col(key).cast("string").alias("key"), F.expr(value).alias("value"), *more)
        for name, (key, value) in columns.items()])


@query("load_extracts_run", LOADED_SQL)
def load_extracts_run(spark, sf):
    """The load run twice over extracts that repeat every policy and claim: the first records stay."""
    root = scratch_dir(spark, "loaded")
    files = extracts(spark, sf, copies=2)
    for attempt in range(2):
        load.load_extracts(spark, files, f"{root}/db", f"{root}/stage-{attempt}")
    return loaded_keys(spark, f"{root}/db")


@query("load_all_or_none", f"""
    select table_name, 0 as load, count(*) as records, case table_name when 'policy' then count(*) else 0 end as not_in_the_ledger
    from ({LOADED_SQL}) group by table_name""")
def load_all_or_none(spark, sf):
    """A load that was killed after its first table, a whole one, and one killed after its second table: only the whole one shows."""
    root = scratch_dir(spark, "ledger")
    db, files = f"{root}/db", extracts(spark, sf)

    def killed(name: str, number: int) -> None:
        (key, clean), = [(key, clean) for n, key, clean in load.LOADS if n == name]
        rows = clean(scan_csv(spark, files[name], place=True))
        overwrite(absent_rows(rows.limit(0), rows, [key], load.PLACE).drop(*load.PLACE), f"{root}/killed-{number}")
        load.add_files(spark, f"{root}/killed-{number}", f"{db}/{name}", number)

    killed("customer", 0)
    number = load.load_extracts(spark, files, db, f"{root}/stage")
    killed("policy", number + 1)
    shown = loaded_keys(spark, db, numbered=True).groupBy("table_name", "load").agg(F.count("*").alias("records"))
    there = reduce(DataFrame.unionByName, [
        scan(spark, f"{db}/{name}").agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, _, _ in load.LOADS])
    return shown.join(there, "table_name").select("table_name", "load", "records", (F.col("rows") - F.col("records")).alias("not_in_the_ledger"))


@query("append_merge_schema", """
    select c_custkey, c_name, null::varchar as c_mktsegment from customer
    union all select c_custkey, c_name, c_mktsegment from customer""")
def append_merge_schema(spark, sf):
    """A later append brings one more column."""
    path = scratch_dir(spark, "evolving")
    customer = table(spark, sf, "customer")
    create_if_absent(spark, path, customer.select("c_custkey", "c_name").schema)
    append(customer.select("c_custkey", "c_name"), path)
    append(customer.select("c_custkey", "c_name", "c_mktsegment"), path)
    return scan(spark, path, mergeSchema="true").select("c_custkey", "c_name", "c_mktsegment")


@query("overwrite_table", "select o_orderkey, o_orderstatus from orders")
def overwrite_table(spark, sf):
    path = scratch_dir(spark, "overwritten")
    overwrite(table(spark, sf, "customer"), path)
    overwrite(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), path)
    return scan(spark, path)


@query("label_index", """
    select 'class ' || label as label, cast(dense_rank() over (order by 'class ' || label) - 1 as double) as label_id,
      count(*) as n from embeddings group by label""")
def label_index(spark, sf):
    labelled = table(spark, sf, "embeddings").select(
        F.concat(F.lit("class "), F.col("label").cast("string")).alias("label"))
    return label_indexer(labelled).transform(labelled).groupBy("label", "label_id").agg(
        F.count(F.lit(1)).alias("n"))


@query("accuracy_pct", f"""
    select label, {single_sql('avg(case when vec_id % 10 = label then 1.0 else 0.0 end) * 100')} as accuracy
    from embeddings group by label""")
def accuracy_by_label(spark, sf):
    scored = table(spark, sf, "embeddings").withColumn("guess", F.col("vec_id") % 10)
    return single(scored.groupBy("label").agg(
        accuracy_pct(F.col("guess"), F.col("label")).alias("accuracy")), "accuracy")


@query("train_split_counts", """
    select label, count(*) filter (rank > cut) as n_train, count(*) filter (rank <= cut) as n_held_out,
      cast(sum(case when rank <= cut then vec_id else 0 end) as bigint) as held_out_ids
    from (select label, vec_id, row_number() over (partition by label order by md5(vec_id || '-42'), vec_id) as rank,
            ceil(0.2 * count(*) over (partition by label)) as cut from embeddings)
    group by label""")
def train_split_counts(spark, sf):
    split = stratified_split(table(spark, sf, "embeddings").select("vec_id", "label"), "label", "vec_id")
    held_out = F.col("is_held_out")
    return split.groupBy("label").agg(
        F.count_if(~held_out).alias("n_train"), F.count_if(held_out).alias("n_held_out"),
        F.sum(F.when(held_out, F.col("vec_id")).otherwise(0)).alias("held_out_ids"))


@query("split_lines", """
    select l_orderkey, l_linenumber, l_returnflag from (select *, row_number() over (
        partition by l_returnflag order by md5(k || '-7'), k) as rank,
        ceil(0.1 * count(*) over (partition by l_returnflag)) as cut
      from (select *, l_orderkey || '/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey || '/'
              || cast(l_shipdate as date) as k from lineitem)) where rank <= cut""")
def split_lines(spark, sf):
    """Held-out lines with three large classes."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.concat_ws(
        "/", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        F.col("l_shipdate").cast("date").cast("string")).alias("k"))
    split = stratified_split(lines, "l_returnflag", "k", "0.1", 7)
    return split.filter("is_held_out").select("l_orderkey", "l_linenumber", "l_returnflag")


def rasters(spark, sf):
    """Embeddings as 8 x 8 grey images: one byte per component."""
    level = "cast(greatest(0, least(255, floor(x * 255 + 128))) as int)"
    return table(spark, sf, "embeddings").selectExpr(
        "vec_id", "label", "8 as height", "8 as width", "1 as channels",
        f"unhex(array_join(transform(embedding, x -> lpad(hex({level}), 2, '0')), '')) as pixels")


@query("image_features", f"""
    with level as (select vec_id, list_transform(embedding, lambda x:
        greatest(0, least(255, floor(cast(x as double) * 255 + 128)))) as v from embeddings),
      small as (select vec_id, list_transform(range(0, 16), lambda k:
        (v[(k // 4) * 16 + (k % 4) * 2 + 1] + v[(k // 4) * 16 + (k % 4) * 2 + 2]
         + v[(k // 4) * 16 + (k % 4) * 2 + 9] + v[(k // 4) * 16 + (k % 4) * 2 + 10]) / 4 / 255) as s from level)
    select vec_id, i as place, {single_sql(f"""(s[i // 3 + 1] - case i % 3 when 0 then {CHANNEL_MEAN[0]}
        when 1 then {CHANNEL_MEAN[1]} else {CHANNEL_MEAN[2]} end) / case i % 3 when 0 then {CHANNEL_STD[0]}
        when 1 then {CHANNEL_STD[1]} else {CHANNEL_STD[2]} end""")} as feature
    from (select vec_id, s, unnest(range(0, 48))::integer as i from small)""")
def image_features(spark, sf):
    """All values of images shrunk from 8 x 8 to 4 x 4, where every pixel counts."""
    features = rasters(spark, sf).select(
        "vec_id", pixel_features(4)("height", "width", "channels", "pixels").alias("f"))
    return features.select("vec_id", F.posexplode("f").alias("place", "feature")).select(
        "vec_id", "place", F.col("feature").cast("double").alias("feature"))


DECLARED_SQL = {
    "policy": ("policy_no", standins.POLICIES_SQL), "claim": ("claim_no", standins.sql("claim")),
    "customer": ("customer_id", standins.sql("customer")),
}


def _declared_sql() -> str:
    parts = []
    for name, (key, source) in DECLARED_SQL.items():
        d = DECLARED[name]
        rules = {f"not_null({c})": f"{c} is null" for c in d.not_null}
        rules |= {f"length({c})<={n}": f"length({c}) > {n}" for c, n in d.lengths.items()}
        rules |= {f"numeric({c},{p},{s})": f"{c} is not null and try_cast({c} as decimal({p},{s})) is null"
                  for c, (p, s) in d.digits.items()}
        parts += [f"select '{name}' as table_name, '{rule}' as check_name, count(*) filter ({cond}) as violations from {source}"
                  for rule, cond in rules.items()]
        parts.append(f"select '{name}', 'unique({key})', count(*) from (select {key} from {source} where {key} is not null "
                     f"group by 1 having count(*) > 1)")
    return " union all ".join(parts)


@query("check_declared", _declared_sql())
def check_declared_tables(spark, sf):
    """Every constraint the source database declares, over the three captured tables."""
    frames = {"policy": standins.policies(spark, sf), "claim": standins.frame(spark, sf, "claim"),
              "customer": standins.frame(spark, sf, "customer")}
    return reduce(DataFrame.unionByName, [
        check_declared(df, DECLARED[name]).select(F.lit(name).alias("table_name"), "check_name", "violations")
        for name, df in frames.items()])


EPOCHS, RATE = 3, 0.01


def _training_sql() -> str:
    """The optimiser's epochs over one batch of all training rows, from zeros, as SQL."""
    parts = ["""
    rows as (select vec_id, 'class ' || label as label, embedding, row_number() over (partition by label order by md5(vec_id || '-42'), vec_id)
        <= ceil(0.2 * count(*) over (partition by label)) as held_out from embeddings),
    classes as (select label, row_number() over (order by label) - 1 as c from (select distinct label from rows)),
    x as (select vec_id, c as y, held_out, 0 as i, 1.0::double as v from rows join classes using (label)
        union all select vec_id, c, held_out, unnest(range(1, len(embedding) + 1)), unnest(embedding)::double from rows join classes using (label)),
    n as (select count(*) as n from rows where not held_out),
    w0 as (select c, i, 0.0::double as w, 0.0::double as m, 0.0::double as s from classes, (select distinct i from x))"""]
    for e in range(EPOCHS + 1):
        parts.append(f"z{e} as (select vec_id, y, held_out, c, sum(v * w) as z from x join w{e} using (i) group by all)")
        if e:
            parts.append(f"""guess{e} as (select vec_id, y, (c = y)::integer as is_right from z{e} where held_out
                qualify row_number() over (partition by vec_id order by z desc, c) = 1)""")
        if e < EPOCHS:
            k = e + 1
            parts.append(f"""top{e} as (select vec_id, max(z) as top from z{e} where not held_out group by 1),
            sum{e} as (select vec_id, any_value(top) + ln(sum(exp(z - top))) as total from z{e} join top{e} using (vec_id) group by 1),
            loss{k} as (select avg(total - z) as train_loss from z{e} join sum{e} using (vec_id) where c = y),
            slope{e} as (select vec_id, c, exp(z - total) - (c = y)::integer as d from z{e} join sum{e} using (vec_id)),
            g{e} as (select c, i, sum(d * v) / any_value(n) as g from slope{e} join x using (vec_id), n group by 1, 2),
            a{e} as (select c, i, w, 0.9 * m + 0.1 * g as m, 0.999 * s + 0.001 * g * g as s from w{e} join g{e} using (c, i)),
            w{k} as (select c, i, w - {RATE} * (m / (1 - pow(0.9, {k}))) / (sqrt(s / (1 - pow(0.999, {k}))) + 1e-8) as w, m, s from a{e})""")
    results = " union all ".join(
        f"select {e} as epoch, label, count(*) as n_held_out, sum(is_right)::bigint as n_right, round((select train_loss from loss{e}), 6) as train_loss, "
        f"round((select 100.0 * sum(is_right) / count(*) from guess{e}), 6) as val_accuracy from guess{e} join classes on c = y group by label"
        for e in range(1, EPOCHS + 1))
    return f"with {', '.join(parts)} {results}"


@query("train_metrics", _training_sql())
def train_metrics(spark, sf):
    """Loss and accuracy of every epoch, and right answers per class recounted from the stored predictions."""
    labelled = table(spark, sf, "embeddings").select(
        "vec_id", F.concat(F.lit("class "), F.col("label").cast("string")).alias("label"),
        F.col("embedding").alias("features"))
    run = train(labelled, "vec_id", Params(epochs=EPOCHS, lr=RATE, batch_size=1 << 40))
    truth = labelled.select("vec_id", "label")
    guessed = run.predictions.select("vec_id", "epoch", "prediction").join(
        run.labels.select(F.col("label_id").alias("prediction"), F.col("label").alias("guess")), "prediction")
    by_class = guessed.join(truth, "vec_id").groupBy("epoch", "label").agg(
        F.count("*").alias("n_held_out"), F.count_if(F.col("guess") == F.col("label")).alias("n_right"))
    metrics = run.metrics.select("epoch", F.round("train_loss", 6).alias("train_loss"), F.round("val_accuracy", 6).alias("val_accuracy"))
    return by_class.join(metrics, "epoch").select("epoch", "label", "n_held_out", "n_right", "train_loss", "val_accuracy")
