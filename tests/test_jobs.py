"""Streams, folder tables, silver rules, extract loads, publishing and training."""

import datetime as dt
import json
import struct
import zlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimworks import session
from claimworks.plans import gold, load, publish, silver, training
from claimworks.schemas import CAPTURED, CLAIM, CUSTOMER, IMAGE_METADATA, POLICY, TELEMATICS, TOPIC
from claimworks.sources import files, readers, sinks
from claimworks.streaming import ingest, refine
from claimworks.streaming.tables import FolderTable, open_table


def row(schema, **values):
    return tuple(values.get(n) for n in schema.names)


def done(*streams):
    for s in streams:
        s.awaitTermination()


def messages(spark, path, changes, offset=0):
    """(table, op, image dict, ts_ms) tuples as topic rows."""
    rows = []
    for i, (name, op, image, ts) in enumerate(changes):
        before, after = (image, None) if op == "d" else (None, image)
        rows.append(("k", json.dumps({"before": before, "after": after, "source": {"table": name},
                                      "op": op, "ts_ms": ts}), offset + i))
    spark.createDataFrame(rows, TOPIC).write.mode("append").parquet(path)


def customer(i, name):
    return {"customer_id": str(i), "date_of_birth": "0", "borough": "Bronx", "neighborhood": "n",
            "zip_code": "10451", "name": name}


def run_changes(spark, root, **kw):
    done(ingest.ingest_changes(spark, {"folder": f"{root}/topic"}, f"{root}/bronze",
                               f"{root}/cp", trigger=None, **kw))


def test_change_stream_to_bronze_and_silver(spark, tmp_path):
    root = str(tmp_path)
    only = [t for t in refine.SILVER_TABLES if t.name == "customer"]

    def refine_now(name, **kw):
        done(*refine.start_silver(spark, f"{root}/bronze", f"{root}/{name}", f"{root}/cp_{name}",
                                  trigger=None, tables=only, **kw))

    messages(spark, f"{root}/topic", [
        ("customer", "c", customer(1, "Ann Lee"), 1), ("customer", "u", customer(1, "Ann Poe"), 2),
        ("customer", "u", customer(2, "No Body"), 1), ("customer", "c", customer(3, "Cy Coe"), 1),
        ("users", "c", {"user_id": 1}, 1), ("customer", "c", None, 1),
        ("policy", "c", {"policy_no": "P1", "cust_id": "1"}, 1)])
    run_changes(spark, root)
    refine_now("silver")
    refine_now("mirror", propagate_deletes=True)
    messages(spark, f"{root}/topic", [
        ("customer", "d", customer(3, "Cy Coe"), 5), ("customer", "c", customer(1, "Other"), 5),
        ("customer", "r", customer(4, "Di"), 5)], offset=10)
    run_changes(spark, root)
    open_table(spark, f"{root}/bronze/customer", ["customer_id"]).compact()
    refine_now("silver")
    refine_now("mirror", propagate_deletes=True)

    bronze = open_table(spark, f"{root}/bronze/customer", ["customer_id"])
    assert sorted((r["customer_id"], r["name"]) for r in bronze.read().collect()) == [
        ("1", "Ann Poe"), ("4", "Di")]
    assert files.numbered_folders(spark, f"{root}/bronze/customer/base", "upto=") == [1]
    assert bronze.read(before=1).count() == 2 and bronze.read(before=0) is None
    assert open_table(spark, f"{root}/bronze/policy", ["policy_no"]).read().count() == 1
    assert open_table(spark, f"{root}/bronze/claim", ["claim_no"]).read().count() == 0

    def names(where):
        table = open_table(spark, f"{root}/{where}/customer", ["customer_id"]).read()
        return sorted((r["customer_id"], r["firstname"], r["lastname"], r["address"]) for r in table.collect())

    kept = [(1, "Ann", "Poe", "Bronx, 10451"), (4, "Di", None, "Bronx, 10451")]
    assert names("mirror") == kept
    assert names("silver") == sorted([*kept, (3, "Cy", "Coe", "Bronx, 10451")])


def test_replayed_batch_changes_nothing(spark, tmp_path):
    schema, keys = CAPTURED["customer"]
    batch = spark.createDataFrame(
        [("customer", "c", None, json.dumps(customer(1, "A")), 1, 0),
         ("customer", "u", None, json.dumps(customer(1, "B")), 2, 1)],
        "table_name string, op string, before_str string, after_str string, ts_ms long, offset long")
    for _ in range(2):
        ingest.apply_changes(batch, 0, str(tmp_path), tables={"customer": (schema, keys)})
    table = open_table(spark, f"{tmp_path}/customer", keys)
    assert [r["name"] for r in table.read().collect()] == ["B"]


def test_folder_table_last_batch_wins(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"), ["k"])
    assert not table.exists() and table.read() is None
    frames = [[("s", 1, "a"), ("s", 2, "b"), ("s", None, "n")], [("s", 2, "x"), ("d", 1, None)],
              [("s", 1, "back"), ("s", None, "m")], [("s", 3, "z")]]
    for n, rows in enumerate(frames):
        table.write(n, lambda before, rows=rows: spark.createDataFrame(rows, "op string, k int, v string"))
        if n == 2:
            table.compact()
    state = sorted((tuple(r) for r in table.read().collect()), key=str)
    assert state == sorted([(1, "back"), (2, "x"), (3, "z"), (None, "n"), (None, "m")], key=str)
    assert files.numbered_folders(spark, f"{table.path}/base", "upto=") == [2]


def test_deliveries_are_known_by_stream_and_batch(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"), ["k"])

    def write(stream, n, k):
        table.write(n, lambda before: spark.createDataFrame([("s", k, stream)], "op string, k int, v string"), stream)

    def state():
        return sorted(tuple(r) for r in table.read().collect())

    write("a", 0, 1)
    write("a", 1, 2)
    write("a", 1, 9)  # a replay
    assert state() == [(1, "a"), (2, "a")]
    table.compact()
    write("b", 0, 3)  # a fresh checkpoint starts at 0 again
    write("b", 0, 9)
    write("a", 2, 2)
    assert state() == [(1, "a"), (2, "a"), (3, "b")]
    table.compact()
    table.compact()
    assert files.numbered_folders(spark, f"{table.path}/base", "upto=") == [1, 3]
    assert state() == [(1, "a"), (2, "a"), (3, "b")]


def test_unfinished_folders_are_not_read(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"), ["k"])
    table.write(0, lambda before: spark.createDataFrame([("s", 1, "a")], "op string, k int, v string"))
    spark.createDataFrame([("s", 9, "q")], "op string, k int, v string").write.parquet(
        f"{table.changes_path}/batch=1")
    (tmp_path / "t" / "changes" / "batch=1" / "_SUCCESS").unlink()
    assert [r["k"] for r in table.read().collect()] == [1]


def test_telematics_stream_and_imputation(spark, tmp_path):
    root = str(tmp_path)

    def send(readings):
        df = spark.createDataFrame([row(TELEMATICS, **r) for r in readings], TELEMATICS)
        df.write.mode("overwrite").parquet(f"{root}/in")
        assert publish.publish_telematics(spark, f"{root}/in", folder=f"{root}/topic") == len(readings)
        done(ingest.ingest_telematics(spark, {"folder": f"{root}/topic"}, f"{root}/bronze",
                                      f"{root}/cp", trigger=None))
        done(*refine.start_silver(
            spark, f"{root}/bronze", f"{root}/silver", f"{root}/cps", trigger=None,
            tables=[t for t in refine.SILVER_TABLES if t.name == "telematics"]))

    at = "2024-01-01 00:00:0{}".format
    send([{"chassis_no": "A", "event_timestamp": at(1), "speed": "10", "latitude": "-91", "longitude": "181"},
          {"chassis_no": "A", "event_timestamp": at(2), "speed": "20", "latitude": "nan"},
          {"chassis_no": "A", "event_timestamp": at(3), "speed": None},
          {"chassis_no": "A", "event_timestamp": "2024/01/01", "speed": "9"},
          {"chassis_no": None, "event_timestamp": at(1), "speed": "9"}])
    send([{"chassis_no": "A", "event_timestamp": at(4), "speed": "nan"},
          {"chassis_no": "B", "event_timestamp": at(4), "speed": None},
          {"chassis_no": "A", "event_timestamp": at(3), "speed": "5"}])
    table = open_table(spark, f"{root}/silver/telematics", ["chassis_no", "event_timestamp"]).read()
    got = sorted((r["chassis_no"], r["event_timestamp"].second, r["speed"]) for r in table.collect())
    assert got == [("A", 1, 10.0), ("A", 2, 20.0), ("A", 3, 5.0), ("A", 4, 15.0), ("B", 4, None)]
    first = table.filter("second(event_timestamp) = 1").first()
    assert (first["latitude"], first["longitude"]) == (-90.0, 180.0)
    assert table.filter("second(event_timestamp) = 2").first()["latitude"] is None


def test_publish_unreadable_source(spark, tmp_path):
    assert publish.publish_telematics(spark, f"{tmp_path}/nowhere", folder=f"{tmp_path}/topic") is None
    assert not files.path_exists(spark, f"{tmp_path}/topic")


def png(path, level, size=6):
    """A grey PNG, made with the standard library."""
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    raster = b"".join(b"\0" + bytes([level]) * 3 * size for _ in range(size))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", size, size, 8, 2, 0, 0, 0))
                     + chunk(b"IDAT", zlib.compress(raster)) + chunk(b"IEND", b""))


def test_object_streams(spark, tmp_path):
    landing = tmp_path / "landing"
    for name in ("a b.jpg", "c.PNG", "d.jpeg", "e.txt", "f.pnx"):
        png(landing / "claims/images" / name, 10)
    png(landing / "training_imgs" / "1-dent.png", 10)
    png(landing / "training_imgs" / "sub" / "2-dent.png", 10)
    (landing / "claims/metadata").mkdir(parents=True)
    (landing / "claims/metadata/m.csv").write_text(
        "image_name,image_id,claim_no,chassis_no\na.jpg,1,C1,X\na.jpg,1,C0,X\nb.jpg,2,,Y\n")
    root = str(tmp_path)
    done(*ingest.ingest_objects(spark, str(landing), f"{root}/bronze", f"{root}/cp", trigger=None))
    bronze = spark.read.parquet(f"{root}/bronze/claim_images")
    assert bronze.columns == ["path", "modificationTime", "length", "content"]
    assert bronze.count() == 3
    assert spark.read.parquet(f"{root}/bronze/training_images").count() == 1
    done(*refine.start_silver(
        spark, f"{root}/bronze", f"{root}/silver", f"{root}/cps", trigger=None,
        tables=[t for t in refine.SILVER_TABLES if "image" in t.name]))
    meta = open_table(spark, f"{root}/silver/image_metadata", ["image_name"]).read()
    assert [(r["image_name"], r["claim_no"]) for r in meta.collect()] == [("a.jpg", "C0")]
    images = open_table(spark, f"{root}/silver/claim_images", ["path"]).read()
    assert sorted(r["image_name"] for r in images.collect())[:2] == ["", ""]
    labels = open_table(spark, f"{root}/silver/training_images", ["path"]).read()
    assert [r["label"] for r in labels.collect()] == ["dent"]
    deep = readers.image_folder(spark, f"{landing}/training_imgs", recursive=True)
    assert deep.count() == 2
    assert IMAGE_METADATA.names == meta.columns


def test_training_on_files(spark, tmp_path):
    for i in range(20):
        png(tmp_path / "imgs" / f"{i}-{'dent' if i % 2 else 'scratch'}.png", 200 if i % 2 else 20, 4 + i % 3)
    png(tmp_path / "imgs" / "nolabel.png", 90)
    (tmp_path / "imgs" / "99-dent.png").write_bytes(b"broken")
    params = training.Params(epochs=3, img_size=2)
    runs = str(tmp_path / "runs")
    run = training.train_images(
        training.folder_images(spark, str(tmp_path / "imgs")), runs, "r1", params)
    metrics = run.metrics.orderBy("epoch").collect()
    assert [m["epoch"] for m in metrics] == [1, 2, 3][: len(metrics)]
    assert metrics[-1]["val_accuracy"] == 100.0
    assert metrics[-1]["train_loss"] < metrics[0]["train_loss"]
    labels = {r["label"]: r["label_id"] for r in spark.read.parquet(f"{tmp_path}/runs/labels").collect()}
    assert labels == {"dent": 0, "scratch": 1}
    assert {r["name"] for r in spark.read.parquet(f"{tmp_path}/runs/params").collect()} >= {"epochs", "seed"}
    assert files.path_exists(spark, f"{tmp_path}/runs/models/r1")
    assert spark.read.parquet(f"{tmp_path}/runs/undecoded/r1").count() == 1
    features = spark.read.parquet(f"{tmp_path}/runs/features/r1").select(
        "label", F.col("features").cast("array<double>").alias("f"))
    expected = (200 / 255 - 0.485) / 0.229
    assert features.filter("label = 'dent'").first()["f"][0] == pytest.approx(expected, abs=1e-6)
    done(ingest.ingest_images(spark, str(tmp_path / "imgs"), f"{tmp_path}/bronze/training_images",
                              f"{tmp_path}/cp", "imgs", trigger=None))
    done(*refine.start_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/cps", trigger=None,
                              tables=[t for t in refine.SILVER_TABLES if t.name == "training_images"]))
    stored = open_table(spark, f"{tmp_path}/silver/training_images", ["path"]).read()
    again = training.train_images(training.table_images(stored, str(tmp_path / "imgs")), runs, "r2", params)
    assert [tuple(m) for m in again.metrics.orderBy("epoch").collect()] == [
        pytest.approx(tuple(m)) for m in metrics]
    example = features.select("label", training.array_to_vector("f").alias("vector"))
    assert {"prediction", "probability"} <= set(training.signature(run.model, example).names)


def test_resize_keeps_gradients(spark):
    import numpy as np

    ramp = np.tile(np.arange(8.0)[None, :, None], (8, 1, 3))
    half = training._resize(ramp, 4)
    assert half.shape == (4, 4, 3) and np.allclose(half[0, :, 0], [0.5, 2.5, 4.5, 6.5])
    assert np.allclose(training._resize(ramp, 8), ramp)
    noise = np.random.default_rng(1).random((37, 61, 3))
    small = training._resize(noise, 5)
    assert small.shape == (5, 5, 3) and np.allclose(small.mean(), noise.mean())  # every pixel counts
    assert np.allclose(training._resize(noise, 1)[0, 0], noise.mean((0, 1)))


def test_silver_policy_and_claim(either_ansi):
    spark = either_ansi
    rows = [row(POLICY, policy_no="P1", cust_id="bad", pol_issue_date="19000", model_year="1979",
                sum_insured="1.005", premium="-12.50", deductable="5.9"),
            row(POLICY, policy_no="P2"), row(POLICY, cust_id="1"),
            row(POLICY, policy_no="P1", cust_id="zzz")]
    out = silver.clean_policy(spark.createDataFrame(rows, POLICY))
    assert out.columns == POLICY.names
    one = out.collect()
    assert len(one) == 1
    assert (one[0]["cust_id"], one[0]["pol_issue_date"], one[0]["model_year"], one[0]["sum_insured"],
            one[0]["premium"], one[0]["deductable"]) == (
        None, dt.date(2022, 1, 8), None, Decimal("1.01"), Decimal("12.50"), 5)
    claims = [row(CLAIM, claim_no="C1", incident_hour="24", total="99999999999", suspicious_activity="t"),
              row(CLAIM, claim_no="C2", incident_hour="-1", suspicious_activity="maybe"), row(CLAIM)]
    got = {r["claim_no"]: (r["incident_hour"], r["total"], r["suspicious_activity"])
           for r in silver.clean_claim(spark.createDataFrame(claims, CLAIM)).collect()}
    assert got == {"C1": (23, 99999999999, True), "C2": (0, None, None)}


def test_gold_columns(spark):
    policy = silver.clean_policy(spark.createDataFrame(
        [row(POLICY, policy_no="P1", cust_id="1", chassis_no="A"), row(POLICY, policy_no="P2", cust_id="7")], POLICY))
    claim = silver.clean_claim(spark.createDataFrame(
        [row(CLAIM, claim_no="C1", policy_no="P1"), row(CLAIM, claim_no="C2", policy_no="P2"),
         row(CLAIM, claim_no="C3", policy_no="P9")], CLAIM))
    person = silver.clean_customer(spark.createDataFrame(
        [row(CUSTOMER, customer_id="1", name="Ann", borough="Bronx")], CUSTOMER))
    core = gold.customer_claim_policy(claim, policy, person)
    assert len(core.columns) == 38 and core.columns[0] == "policy_no" and "customer_id" not in core.columns
    vehicle = gold.vehicle_averages(spark.createDataFrame(
        [("A", 1.0, 2.0, 3.0)], "chassis_no string, latitude double, longitude double, speed double"))
    out = gold.enrich(core, vehicle)
    assert len(out.columns) == 42 and out.columns[0] == "chassis_no"
    assert out.schema["lat_long"].dataType.simpleString() == "struct<latitude:float,longitude:float>"
    assert [(r["claim_no"], r["avg_speed"]) for r in out.collect()] == [("C1", 3.0)]


def write_extracts(folder):
    (folder / "customers.csv").write_text(
        'customer_id,date_of_birth,borough,neighborhood,zip_code,name\n'
        '1,02-03-1980,null,"North, East",01045,"""Doe, Jo"""\nx,02-03-1980,a,b,1,c\n1,02-03-1980,zz,n,1,d\n')
    names = list(load.POLICY_NAMES)
    (folder / "policies.csv").write_text(
        ",".join(names) + "\n" + "P1,1.0,t,2020-01-02,soon,,m,m,2001.0,X,u,p,10.50,3,500\n" + "," * (len(names) - 1) + "\n")
    (folder / "claims.csv").write_text(
        "claim_no,policy_no,claim_date,months_as_customer,injury,property,vehicle,total,collision_type,"
        "number_of_vehicles_involved,age,insured_relationship,license_issue_date,date,hour,type,severity,"
        "number_of_witnesses,suspicious_activity\n"
        "C1,P1,2020-05-06,12,1,2,3,6, null ,1,30,x,07-08-2001,2020-05-01,5,t,s,2,TRUE\n")
    return {"customer": str(folder / "customers.csv"), "policy": str(folder / "policies.csv"),
            "claim": str(folder / "claims.csv")}


def test_load_extracts(spark, tmp_path):
    extracts = write_extracts(tmp_path)
    for attempt in range(2):
        load.load_extracts(spark, extracts, str(tmp_path / "db"), str(tmp_path / f"stage{attempt}"))
    people = spark.read.parquet(f"{tmp_path}/db/customer").collect()
    assert len(people) == 1
    assert people[0].asDict() == {
        "customer_id": 1, "date_of_birth": dt.date(1980, 3, 2), "borough": None,
        "neighborhood": "North, East", "zip_code": "01045", "name": "Doe Jo"}
    policy = spark.read.parquet(f"{tmp_path}/db/policy").collect()
    assert [(p["cust_id"], p["pol_issue_date"], p["pol_eff_date"], p["model_year"]) for p in policy] == [
        ("1", dt.date(2020, 1, 2), None, 2001)]
    claim = spark.read.parquet(f"{tmp_path}/db/claim").first()
    assert (claim["driver_age"], claim["license_issue_date"], claim["suspicious_activity"]) == (
        30, dt.date(2001, 8, 7), True)


def test_extract_records(spark, tmp_path):
    """Quoted line breaks stay, the first record of a key counts, rejects are counted, surplus fields fail."""
    extracts = write_extracts(tmp_path)
    people = "customer_id,date_of_birth,borough,neighborhood,zip_code,name\n"
    (tmp_path / "customers.csv").write_text(
        people + '7,02-03-1980,"two\nlines",n,01,First\n7,02-03-1980,b,n,01,Second\nx,02-03-1980,b,n,01,NoKey\n8,bad,b,n,01,Ann\n')
    load.load_extracts(spark, extracts, f"{tmp_path}/db", f"{tmp_path}/stage")
    got = {r.customer_id: r for r in spark.read.parquet(f"{tmp_path}/db/customer").collect()}
    assert set(got) == {7, 8} and (got[7].borough, got[7].name) == ("two\nlines", "First")
    counts = {(r.extract, r.reason): r.records for r in load.reject_counts(spark, extracts).collect()}
    assert counts["customer", "no key"] == 1 and counts["customer", "unreadable date_of_birth"] == 1
    (tmp_path / "customers.csv").write_text(people + "9,02-03-1980,b,n,01,Doe, Jo\n")
    assert {(r.extract, r.reason) for r in load.reject_counts(spark, extracts).collect()} >= {("customer", "surplus fields")}
    with pytest.raises(Exception, match="more fields"):
        load.load_extracts(spark, extracts, f"{tmp_path}/db2", f"{tmp_path}/stage2")
    assert not files.path_exists(spark, f"{tmp_path}/db2")


def test_extracts_are_dealt_evenly(spark, tmp_path):
    """Records without a key, half of the claims here, fill no file and no task; a key's records stay together."""
    from pyspark.sql import functions as F

    from claimworks.queries import tables

    n = 100_000
    spark.range(n).selectExpr(
        "id div 2 as l_orderkey", "if(id % 4 < 2, 71, 1) as l_partkey", "id as l_suppkey", "1 as l_linenumber", "cast(id as double) as l_quantity",
        "1.0D as l_extendedprice", "0.1D as l_discount", "0.1D as l_tax", "'A' as l_returnflag", "'F' as l_linestatus",
        "timestamp '2024-01-01' as l_shipdate").write.parquet(f"{tmp_path}/sf/lineitem.parquet")
    spark.range(100).selectExpr(
        "id as o_orderkey", "id as o_custkey", "'O' as o_orderstatus", "1.5D as o_totalprice", "timestamp '2024-01-01' as o_orderdate",
        "'1-URGENT' as o_orderpriority").write.parquet(f"{tmp_path}/sf/orders.parquet")
    spark.range(100).selectExpr(
        "id as c_custkey", "concat('N', id) as c_name", "id % 25 as c_nationkey", "1.5D as c_acctbal",
        "'MACHINERY' as c_mktsegment").write.parquet(f"{tmp_path}/sf/customer.parquet")
    folder = tables.extracts(spark, f"{tmp_path}/sf", copies=2)["claim"]
    found = spark.read.option("header", "true").option("escape", '"').csv(folder).withColumn("file", F.col("_metadata.file_name"))
    sizes = [r["count"] for r in found.groupBy("file").count().collect()]
    assert sum(sizes) == 2 * n and max(sizes) < 0.3 * 2 * n
    keyed = found.where("claim_no is not null")
    assert keyed.count() == n and keyed.groupBy("claim_no").agg(F.countDistinct("file").alias("files")).where("files > 1").count() == 0


def test_bad_extract_leaves_tables_alone(spark, tmp_path):
    extracts = write_extracts(tmp_path)
    with pytest.raises(Exception):
        load.load_extracts(spark, {**extracts, "claim": str(tmp_path / "missing.csv")},
                           str(tmp_path / "db"), str(tmp_path / "stage"))
    assert not files.path_exists(spark, f"{tmp_path}/db")


def test_table_helpers(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not files.table_exists(spark, path)
    sinks.create_if_absent(spark, path, CUSTOMER)
    assert files.table_exists(spark, path) and readers.scan(spark, path).count() == 0
    sinks.append(spark.createDataFrame([row(CUSTOMER, name="a")], CUSTOMER), path)
    sinks.create_if_absent(spark, path, CUSTOMER)
    assert readers.scan(spark, path).count() == 1
    assert not files.table_exists(spark, path, "delta")


def test_scratch_follows_the_cluster_setting(tmp_path):
    from types import SimpleNamespace as Stub

    def stub(master, **conf):
        return Stub(sparkContext=Stub(master=master, getConf=lambda: conf))

    shared = stub("spark://host:7077", **{"spark.checkpoint.dir": f"{tmp_path}/"})
    assert session.scratch_dir(shared, "x").startswith(f"{tmp_path}/x-")
    with pytest.raises(RuntimeError):
        session.scratch_dir(stub("spark://host:7077"), "x")
    assert "claimworks-" in session.scratch_dir(stub("local[2]"), "x")


def test_command_line_runs_the_whole_chain(spark, tmp_path):
    from claimworks import jobs

    base = str(tmp_path)
    messages(spark, f"{base}/topics/changes", [
        ("customer", "c", customer(1, "Ann Lee"), 1),
        ("policy", "c", {"policy_no": "P1", "cust_id": "1", "chassis_no": "A"}, 1),
        ("claim", "c", {"claim_no": "C1", "policy_no": "P1"}, 1)])
    readings = [row(TELEMATICS, chassis_no="A", event_timestamp="2024-01-01 00:00:00", speed="7")]
    spark.createDataFrame(readings, TELEMATICS).write.parquet(f"{base}/readings")
    spark.createDataFrame([("Bronx, 10451", 40.5, -73.5)], "address string, latitude double, longitude double").write.parquet(
        f"{base}/places")
    png(tmp_path / "landing/claims/images/a.jpg", 1)
    for i in range(10):
        png(tmp_path / f"landing/training_imgs/{i}-{'dent' if i % 2 else 'scratch'}.png", 250 * (i % 2))
    (tmp_path / "landing/claims/metadata").mkdir(parents=True)
    (tmp_path / "landing/claims/metadata/m.csv").write_text("image_name,image_id,claim_no,chassis_no\na.jpg,1,C1,A\n")
    for line in (
        f"publish --source {base}/readings --folder {base}/topics/telematics",
        f"ingest-changes --once --folder {base}/topics/changes",
        f"ingest-telematics --once --folder {base}/topics/telematics",
        "ingest-objects --once", "silver --once", f"gold --places {base}/places",
        "compact", "check", "train --epochs 2 --img_size 2 --run_id r1",
    ):
        name, *rest = line.split()
        jobs.run(spark, jobs.parser().parse_args([name, "--base", base, *rest]))
    enriched = spark.read.parquet(f"{base}/gold/customer_claim_policy_telematics").collect()
    assert [(r["claim_no"], r["firstname"], r["avg_speed"]) for r in enriched] == [("C1", "Ann", 7.0)]
    assert enriched[0]["lat_long"]["latitude"] == 40.5
    assert files.path_exists(spark, f"{base}/runs/damage/models/r1")


def test_gold_joins_split_hot_keys(spark, tmp_path):
    """A policy with a third of the claims, a customer with a third of the policies."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    frames = {
        "claim": spark.range(0, 300000, 1, 12).selectExpr(
            "cast(id as string) claim_no", "md5(cast(id as string)) note",
            "case when id % 3 = 0 then '7' else cast(id % 20000 as string) end policy_no"),
        "policy": spark.range(0, 20000, 1, 4).selectExpr(
            "cast(id as string) policy_no", "cast(case when id % 3 = 0 then 5 else id % 9000 end as int) cust_id"),
        "customer": spark.range(9000).selectExpr("cast(id as int) customer_id", "cast(id as string) address"),
    }
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}")
    before = {k: spark.conf.get(k) for k in small if spark.conf.get(k, None) is not None}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        joined = gold.customer_claim_policy(
            *[spark.read.parquet(f"{tmp_path}/{n}") for n in ("claim", "policy", "customer")])
        total = joined.agg(F.count("*").alias("n"), F.max("note"), F.max("address"))
        assert total.collect()[0]["n"] == 300000
        assert total._jdf.queryExecution().executedPlan().toString().count("skew=true") >= 1
    finally:
        for k in small:
            spark.conf.unset(k)
            if k in before:
                spark.conf.set(k, before[k])


def test_tables_are_cleaned_in_parts(spark, monkeypatch):
    """Part by part the same rows, repeated and null keys among them, and no part's shuffle files are left for the next."""
    policies = [row(POLICY, policy_no=None if i % 9 == 0 else f"P{i % 40}", cust_id=str(i % 5), premium=str(i), make="m" if i % 2 else None)
                for i in range(120)]
    rows, freed, written = spark.createDataFrame(policies, POLICY), [], []
    overwrite = silver.overwrite

    def watched(df, path):
        freed.append(spark.conf.get(session.FREE_SHUFFLES))
        overwrite(df, path)
        written.append(spark.read.parquet(path).count())

    monkeypatch.setattr(silver, "overwrite", watched)
    whole = silver.cleaned_in_parts(silver.clean_policy, rows, ["policy_no"])
    assert not written and whole.count() == 40
    parts = silver.cleaned_in_parts(silver.clean_policy, rows, ["policy_no"], most=50)
    assert parts.schema == whole.schema and sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
    assert freed == ["true"] * 3 and sum(written) == 40 and max(written) < 30
    assert spark.conf.get(session.FREE_SHUFFLES) != "true"


def test_policies_of_vehicles(spark):
    """Claims of policies whose vehicle sent no readings are not moved; the enriched table is the same."""
    policy = spark.createDataFrame([("P1", "A"), ("P2", "B"), ("P3", None), ("P4", "A")], "policy_no string, chassis_no string")
    vehicle = spark.createDataFrame([("A", 1.0), ("C", 2.0), (None, 3.0)], "chassis_no string, avg_speed double")
    kept = gold.policies_of_vehicles(policy, vehicle)
    assert kept.columns == policy.columns and sorted(r.policy_no for r in kept.collect()) == ["P1", "P4"]


def test_load_cleans_what_stays(spark, tmp_path, monkeypatch):
    """Policies and claims are cleaned when the first record of a key is found, and no step's shuffle files are left."""
    extracts, cleaned, freed = write_extracts(tmp_path), {}, []
    with open(extracts["claim"], "a") as more:
        more.write("C1,P9,2021-05-06,1,1,2,3,6,x,1,30,x,07-08-2001,2020-05-01,5,t,s,2,TRUE\n" + "," * 18 + "\n")
    load_claims, overwrite = load.load_claims, load.overwrite

    def watched(df, *more):
        freed.append(spark.conf.get(session.FREE_SHUFFLES))
        overwrite(df, *more)

    def counted(df):
        cleaned.setdefault("claims", []).append(df.count())
        return load_claims(df)

    monkeypatch.setattr(load, "overwrite", watched)
    monkeypatch.setattr(load, "LOADS", (*load.LOADS[:2], ("claim", "claim_no", counted)))
    for attempt in range(2):
        load.load_extracts(spark, extracts, f"{tmp_path}/db", f"{tmp_path}/stage{attempt}")
    assert cleaned["claims"] == [1, 0] and freed == ["true"] * 6
    assert [(r.claim_no, r.policy_no) for r in spark.read.parquet(f"{tmp_path}/db/claim").collect()] == [("C1", "P1")]
