"""Keyed tables by bucket, running sums, training by batches."""

import random
from collections import defaultdict
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimworks.operators import softmax
from claimworks.plans import training
from claimworks.sources.metrics import rows_scanned
from claimworks.streaming.sums import RunningSums
from claimworks.streaming.tables import FolderTable, bucket_of

SCHEMA = "op string, car string, at timestamp, speed double, note string"


def test_batches_read_touched_buckets_only(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"), ["k"], buckets=16)
    frame = spark.range(2000).select(F.lit("s").alias("op"), F.col("id").cast("string").alias("k"), F.lit("x" * 20).alias("v"))
    table.write(0, lambda before: frame)
    table.compact()
    table.write(1, lambda before: frame.where("k % 2 = 0"))
    batch = frame.where("k in ('5', '8')").select("k")
    buckets = {r.b for r in batch.select(bucket_of(batch, ["k"], 16).alias("b")).collect()}
    held = frame.select("k", bucket_of(frame, ["k"], 16).alias("b")).where(F.col("b").isin(list(buckets)))
    assert 0 < held.count() < 500
    keys = table.read(touching=batch, columns=["k"])
    expected = held.count() + held.where("k % 2 = 0").count()  # the base's rows and the delivery's
    assert rows_scanned(keys, table.path) == expected
    rows = table.read(touching=batch)
    assert rows.columns == ["k", "v"] and rows.join(batch, "k", "left_semi").count() == 2
    assert rows_scanned(rows, table.path) >= expected and rows.count() == held.count()
    assert table.read().count() == 2000


def test_buckets_do_not_depend_on_the_session(spark):
    rows = spark.createDataFrame([("a", None), (None, None), ("b", 1_700_000_000)], "k string, t long").select("k", F.timestamp_seconds("t").alias("t"))
    before, found = spark.conf.get("spark.sql.session.timeZone"), []
    for zone in ("UTC", "Pacific/Auckland"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        found.append(rows.select(bucket_of(rows, ["k", "t"], 7), bucket_of(rows, ["k", "t"], 7, "t")).collect())
    spark.conf.set("spark.sql.session.timeZone", before)
    assert found[0] == found[1] and found[0][2][1] == 1_700_000_000 // 86_400


def recount(rows):
    out = defaultdict(lambda: [0, 0, Decimal(0)])
    for (car, _), speed in rows.items():
        out[car][0] += 1
        if speed is not None and np.isfinite(speed):
            out[car][1] += 1
            out[car][2] += round(Decimal(speed), 12)
    return {k: tuple(v) for k, v in out.items()}


def test_running_sums_equal_a_recount(spark, tmp_path):
    """Random deliveries that insert, replace and delete; replays, a break between table and sums, a new base."""
    rng, state = random.Random(3), {}
    table = FolderTable(spark, str(tmp_path / "readings"), ["car", "at"], day="at")
    sums = RunningSums(table, str(tmp_path / "sums"), ["car"], ["speed"], buckets=4)
    sums.follow()
    assert not sums.exists() and sums.averages() is None

    def deliver(n, follow=True):
        changes = {}
        for _ in range(60):
            key = (rng.choice("ABCDE"), rng.randrange(40))
            gone = rng.random() < (0.8 if n == 6 else 0.2)
            changes[key] = ("d", None) if gone else ("s", rng.choice([None, float("nan"), rng.random() * 100, 1 / 3, 5.0]))
        for key, (op, speed) in changes.items():
            if op == "s":
                state[key] = speed
            else:
                state.pop(key, None)
        frame = spark.createDataFrame([(op, car, at * 40_000, s, "x") for (car, at), (op, s) in changes.items()],
                                      "op string, car string, at long, speed double, note string")
        frame = frame.withColumn("at", F.timestamp_seconds("at"))
        table.write(n, lambda before: frame)
        if follow:
            sums.follow()

    def held():
        return {r.car: (r.rows, r.speed_n, r.speed_sum) for r in sums.table.read().collect()}

    for n in range(8):
        deliver(n, follow=n not in (0, 3, 4))  # 0: the sums start late; 3, 4: they fall behind
        if n == 2:
            table.compact()
            sums.compact()
        if n in (1, 2, 5, 6, 7):
            assert held() == recount(state)
    sums.follow()  # nothing new
    assert held() == recount(state)
    wanted = spark.createDataFrame([("A",), ("Z",)], "car string")
    (one,) = sums.averages(of=wanted).collect()
    count, total = recount(state)["A"][1:]
    assert one.car == "A" and one.speed == pytest.approx(float(total) / count)


def test_epochs_equal_a_run_on_one_machine(spark, tmp_path):
    """Loss and weights after each epoch, on the same batches, and the confusion of each epoch's own head."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(3, 6))
    y = rng.integers(0, 3, 300)
    x = centres[y] + rng.normal(size=(300, 6)) * 0.7
    rows = spark.createDataFrame([(i, list(map(float, v)), int(c)) for i, (v, c) in enumerate(zip(x, y))],
                                 "id long, features array<double>, label_id int").repartition(5)
    fitted = softmax.fit(rows, "id", 3, epochs=3, rate=0.05, batch_size=64, seed=7, random_start=True, reg=0.01)
    dealt, steps = softmax.deal(rows, "id", 64, 7)
    assert steps == 5
    batches = [[(np.array(r.features), r.label_id) for r in dealt.where(F.col("step") == s).collect()] for s in range(steps)]
    assert sum(map(len, batches)) == 300
    head, order = softmax.Head.start(3, 6, 7), np.random.default_rng(7)
    w, m, v, k = head.weights.copy(), 0.0, 0.0, 0
    for head, loss in fitted:
        losses = []
        for s in order.permutation(steps):
            a = np.array([b[0] for b in batches[s]])
            c = np.array([b[1] for b in batches[s]])
            z = a @ w[:, :-1].T + w[:, -1]
            p = np.exp(z) / np.exp(z).sum(1, keepdims=True)
            losses.append(-np.log(p[np.arange(len(c)), c]).mean())
            d = (p - np.eye(3)[c]) / len(c)
            g = np.hstack([d.T @ a + 0.01 * w[:, :-1], d.sum(0)[:, None]])
            k += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - 0.05 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        assert loss == pytest.approx(np.mean(losses), rel=1e-9) and np.allclose(head.weights, w)
    assert fitted[-1][1] < fitted[0][1]
    counts = {(r.epoch, r.label_id, r.prediction): r.n for r in softmax.confusion(
        softmax.predictions(rows, "id", [h for h, _ in fitted])).collect()}
    expected = defaultdict(int)
    for e, (head, _) in enumerate(fitted, 1):
        for c, guess in zip(y, np.argmax(x @ head.weights[:, :-1].T + head.weights[:, -1], 1)):
            expected[e, int(c), int(guess)] += 1
    assert counts == expected
    model = softmax.spark_model(spark, fitted[-1][0])
    model.write().save(str(tmp_path / "model"))
    again = type(model).load(str(tmp_path / "model")).transform(training.with_vectors(rows))
    assert {r.id: int(r.prediction) for r in again.collect()} == {
        i: int(g) for i, g in enumerate(np.argmax(x @ w[:, :-1].T + w[:, -1], 1))}


def test_run_records_every_epoch(spark):
    rows = spark.createDataFrame([(i, "ab"[i % 2], [float(i % 2), 1.0]) for i in range(40)], "id long, label string, features array<float>")
    run = training.train(rows, "id", training.Params(epochs=4, lr=0.1, batch_size=8))
    metrics = run.metrics.orderBy("epoch").collect()
    assert [m.epoch for m in metrics] == [1, 2, 3, 4] and metrics[-1].val_accuracy == 100.0
    assert all(a.train_loss > b.train_loss for a, b in zip(metrics, metrics[1:]))
    assert {r.epoch: r.total for r in run.confusion.groupBy("epoch").agg(F.sum("n").alias("total")).collect()} == dict.fromkeys(range(1, 5), 8)
    assert run.predictions.count() == 32


def test_training_images_lose_none(spark, tmp_path):
    """Odd folder names, a file that is gone and one that does not decode: a feature or listed."""
    from test_jobs import done, png
    from claimworks.streaming import ingest

    names = ("plain", "a b", "x#y", "p%q", "q%41", "a+b", "daemagé", "gone")
    for n in names:
        (tmp_path / "imgs" / n).mkdir(parents=True)
        png(tmp_path / "imgs" / n / "1-dent.png", 90)
    (tmp_path / "imgs" / "plain" / "2-dent.png").write_bytes(b"broken")
    done(ingest.ingest_images(spark, str(tmp_path / "imgs"), f"{tmp_path}/b", f"{tmp_path}/cp", "i", trigger=None, recursive=True))
    (tmp_path / "imgs" / "gone" / "1-dent.png").unlink()
    stored = spark.read.parquet(f"{tmp_path}/b").withColumn("label", F.lit("dent"))
    images = training.table_images(stored, str(tmp_path / "imgs")).collect()
    assert len(images) == 9
    assert sorted(r.path.rsplit("/", 2)[1] for r in images if r.pixels is None) == ["gone", "plain"]


def test_load_shows_all_or_none(spark, tmp_path, monkeypatch):
    """A failure after each of the moves, and one that also keeps the run from cleaning up: the tables stay as they were."""
    from test_jobs import write_extracts
    from claimworks.plans import load

    files, db = write_extracts(tmp_path), str(tmp_path / "db")
    state = lambda: {n: (lambda df: None if df is None else sorted(map(str, df.collect())))(load.loaded(spark, db, n)) for n, _, _ in load.LOADS}
    attempt, moved, add_files, undo = iter(range(100)), [], load.add_files, load.undo_unfinished

    def run(extracts=files):
        return load.load_extracts(spark, extracts, db, str(tmp_path / f"stage{next(attempt)}"))

    def breaking(at):
        def add(*args):
            add_files(*args)
            moved.append(args)
            if len(moved) == at:
                raise OSError("broken")
        moved.clear()
        monkeypatch.setattr(load, "add_files", add)

    for at in (1, 2, 3):
        breaking(at)
        with pytest.raises(OSError):
            run()
        assert state() == {"customer": None, "policy": None, "claim": None}
    monkeypatch.setattr(load, "add_files", add_files)
    assert run() == 0
    first = state()
    assert [len(v) for v in first.values()] == [1, 1, 1]
    more = tmp_path / "more"
    more.mkdir()
    (more / "customers.csv").write_text((tmp_path / "customers.csv").read_text() + "2,02-03-1980,a,b,1,new\n")
    (more / "claims.csv").write_text((tmp_path / "claims.csv").read_text().replace("C1,", "C2,"))
    extracts = {**files, "customer": str(more / "customers.csv"), "claim": str(more / "claims.csv")}
    breaking(2)
    with pytest.raises(OSError):
        run(extracts)
    assert state() == first and spark.read.parquet(f"{db}/customer").count() == 1  # taken out again
    breaking(2)
    monkeypatch.setattr(load, "undo_unfinished", lambda spark, root: None)  # as if the run was killed
    with pytest.raises(OSError):
        run(extracts)
    assert state() == first and spark.read.parquet(f"{db}/customer").count() == 2
    monkeypatch.setattr(load, "undo_unfinished", undo)
    monkeypatch.setattr(load, "add_files", add_files)
    assert run(extracts) == 1 and run(extracts) == 2
    assert [len(v) for v in state().values()] == [2, 1, 2] and spark.read.parquet(f"{db}/claim").count() == 2
    assert sorted(r.load for r in load.loaded(spark, db, "customer", numbered=True).collect()) == [0, 1]


def delivery(spark, rows, schema):
    return lambda before: spark.createDataFrame(rows, "op string, " + schema)


def test_references_equal_the_full_check(spark, tmp_path):
    """Random inserts, replacements and deletes of parents and children, null values among them."""
    from claimworks.operators.checks import check_foreign_key
    from claimworks.streaming.follow import References

    rng, parents, children = random.Random(9), {}, {}
    parent = FolderTable(spark, str(tmp_path / "p"), ["k"], buckets=4)
    child = FolderTable(spark, str(tmp_path / "c"), ["id"], buckets=4)
    kept = References(child, "k", parent, str(tmp_path / "refs"))
    kept.follow()
    assert kept.check() is None
    for n in range(5):
        changes = {k: rng.choice("ssd") for k in rng.sample(range(30), 12)}
        parent.write(n, delivery(spark, [(op, k, "x") for k, op in changes.items()], "k int, note string"))
        parents = {k for k in {*parents, *changes} if changes.get(k, "s") == "s"}
        rows = {i: (rng.choice("ssd"), rng.choice([None, *map(str, range(40))])) for i in rng.sample(range(60), 25)}
        child.write(n, delivery(spark, [(op, i, k) for i, (op, k) in rows.items()], "id int, k string"))
        children = {i: v for i, v in {**children, **{i: k if op == "s" else False for i, (op, k) in rows.items()}}.items() if v is not False}
        if n == 1:
            child.compact()
        if n != 2:  # fall behind once
            kept.follow()
            full = check_foreign_key(child.read(), "k", parent.read(), "k").first()
            lost = [v for v in children.values() if v is not None and int(v) not in parents]
            assert tuple(kept.check().first()) == tuple(full) == ("foreign_key(k)", len(set(lost)), len(lost))


def test_kept_star_join_equals_the_join(spark, tmp_path):
    from claimworks.plans.gold import customer_claim_policy
    from claimworks.streaming.star import StarJoin

    rng = random.Random(12)
    claim, policy, customer = (FolderTable(spark, str(tmp_path / n), [k], buckets=4) for n, k in (
        ("claim", "claim_no"), ("policy", "policy_no"), ("customer", "customer_id")))
    star = StarJoin(claim, policy, customer, str(tmp_path / "gold"), buckets=4)
    star.follow()
    assert star.table.read() is None
    for n in range(3):
        def some(size, share=0.8, n=n):
            return rng.sample(range(size), int(size * (1 if n == 0 else 0.2)))
        claim.write(n, delivery(spark, [(rng.choice("sssd"), i, rng.choice([0, 0, None, *range(12)]), n) for i in some(60)],
                                "claim_no int, policy_no int, total int"))
        policy.write(n, delivery(spark, [(rng.choice("sssd"), i, rng.choice([None, *range(9)]), n) for i in some(12)],
                                 "policy_no int, cust_id int, premium int"))
        customer.write(n, delivery(spark, [(rng.choice("sssd"), i, f"{n}") for i in some(9)], "customer_id int, name string"))
        star.follow()
        if n == 1:
            star.table.compact()
        full = customer_claim_policy(claim.read(), policy.read(), customer.read())
        got = star.table.read()
        assert sorted(map(str, got.select(*full.columns).collect())) == sorted(map(str, full.collect()))


def test_star_join_takes_up_what_waits_at_once(spark, tmp_path, monkeypatch):
    """Deliveries of all sides are one change of the joined table; a run that breaks off loses none."""
    from claimworks.plans.gold import customer_claim_policy
    from claimworks.streaming.star import StarJoin

    claim, policy, customer = (FolderTable(spark, str(tmp_path / n), [k], buckets=4) for n, k in (
        ("claim", "claim_no"), ("policy", "policy_no"), ("customer", "customer_id")))
    star = StarJoin(claim, policy, customer, str(tmp_path / "gold"), buckets=4)
    types = {claim: "claim_no int, policy_no int", policy: "policy_no int, cust_id int, premium int", customer: "customer_id int, name string"}
    deliver = lambda side, n, rows: side.write(n, delivery(spark, rows, types[side]))
    deliver(claim, 0, [("s", i, i % 5) for i in range(20)])
    deliver(policy, 0, [("s", i, i % 3, 0) for i in range(5)])
    deliver(customer, 0, [("s", i, "a") for i in range(3)])
    star.follow()
    deliver(policy, 1, [("s", 1, 1, 7)])
    deliver(policy, 2, [("d", 2, None, None)])
    deliver(claim, 1, [("s", 3, 1), ("d", 4, None)])
    deliver(customer, 1, [("s", 0, "b")])
    last = star.table.deliveries()[-1]
    with monkeypatch.context() as broken:
        broken.setattr(star.table, "_deliver", lambda frame, number: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            star.follow()
    star.follow()
    full = customer_claim_policy(claim.read(), policy.read(), customer.read())
    assert sorted(map(str, star.table.read().select(*full.columns).collect())) == sorted(map(str, full.collect()))
    assert [star.table.delivered(n).count() > 0 for n in star.table.deliveries(last)] == [True, False, False, False]


@pytest.mark.parametrize("buckets", [1, 4, 7, 8, 16, 64])
def test_buckets_stay_where_they_were(spark, buckets):
    import hashlib

    from claimworks.streaming.tables import bucket_of

    rows = spark.createDataFrame([(str(n) if n else None,) for n in range(200)], "k string")
    for r in rows.select("k", bucket_of(rows, ["k"], buckets).alias("bucket")).collect():
        assert r.bucket == int(hashlib.md5((r.k or "").encode()).hexdigest()[:8], 16) % buckets


def test_refused_messages_are_kept_once(spark, tmp_path):
    import json

    from claimworks.streaming.ingest import apply_messages
    from claimworks.streaming.tables import AppendedTable, open_table

    def message(table, op, row):
        return json.dumps({"before": None, "after": json.dumps(row), "source": {"table": table}, "op": op, "ts_ms": 1})

    values = [message("customer", "c", {"customer_id": "1", "name": "A"}), None, "{broken", message("users", "c", {}),
              message("customer", "t", {"customer_id": "2"}), message("policy", "c", {"cust_id": "1"}), message("policy", None, {"policy_no": "1"})]
    batch = spark.createDataFrame([("k", v, n) for n, v in enumerate(values)], "key string, value string, offset long")
    for stream, n in (("a", 0), ("a", 0), ("b", 0)):  # a replay, then another stream
        apply_messages(batch, n, f"{tmp_path}/bronze", f"{tmp_path}/refused", stream=stream)
    refused = AppendedTable(spark, f"{tmp_path}/refused/messages").read()
    reasons = {1: "tombstone", 2: "unreadable", 3: "table not captured", 4: "unknown op", 5: "no key", 6: "unknown op"}
    assert sorted((r.offset, r.reason, r.value) for r in refused.collect()) == sorted(
        (n, why, values[n]) for n, why in reasons.items() for _ in range(2)) or refused.count() == 12
    assert [tuple(r) for r in AppendedTable(spark, f"{tmp_path}/refused/counts").read().collect()] == [(7, 1)] * 2
    assert open_table(spark, f"{tmp_path}/bronze/customer", ["customer_id"]).read().count() == 1


def test_copies_write_nothing_and_state_is_bounded(spark, tmp_path):
    import time

    from test_jobs import done
    from claimworks.schemas import TELEMATICS
    from claimworks.streaming import refine

    rows = [(f"c{i}", "1", "2", f"2024-01-01 00:00:{i:02d}", "5") for i in range(20)]
    bronze, (table,) = f"{tmp_path}/bronze/telematics", [t for t in refine.SILVER_TABLES if t.name == "telematics"]

    def run(part, within):
        spark.createDataFrame(part, TELEMATICS).write.mode("append").parquet(bronze)
        (stream,) = refine.start_silver(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/cp", trigger=None,
                                        tables=[table], copies_within=within)
        done(stream)
        return [p.stateOperators[0].numRowsTotal for p in stream.recentProgress if p.numInputRows]

    silver = refine.open_silver(spark, table, f"{tmp_path}/silver")
    run(rows[:10] * 2, "1 second")
    first = silver.deliveries()
    time.sleep(2)
    run(rows[10:15], "1 second")
    time.sleep(2)
    assert run([*rows[15:], *rows[15:]], "1 second") == [10]  # the first ten are forgotten
    sizes = [silver.delivered(n).count() for n in silver.deliveries()]
    assert sizes[0] == 10 and sum(sizes) == 20 and silver.read().count() == 20 and len(first) >= 1


def test_near_texts_find_every_pair(spark):
    from claimworks.operators.fuzzy import near_texts

    rng = random.Random(6)
    words = lambda n: "".join(rng.choice("abc ") for _ in range(n))
    left = [words(rng.randrange(0, 12)) for _ in range(120)] + [None, "", "a", "aaaaaaaa", "é\U0001F600x"]
    right = [words(rng.randrange(0, 12)) for _ in range(120)] + [None, "", "b", "aaaaaaaaa", "éx"]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    frames = [spark.createDataFrame([(x,) for x in side], f"{name} string") for side, name in ((left, "l"), (right, "r"))]
    for edits in (0, 1, 2, 3):
        found = {(r.a, r.b): r.distance for r in near_texts(*frames, edits).collect()}
        expected = {(a, b): d for a in set(left) - {None} for b in set(right) - {None} if (d := distance(a, b)) <= edits}
        assert found == expected


def test_tokens_of_few_texts_are_not_broadcast(spark):
    from claimworks.operators.fuzzy import near_texts

    texts = spark.range(50).selectExpr("'Customer#' || lpad(id, 9, '0') as t")
    pairs = near_texts(texts, texts, 1)
    assert pairs.count() == 700
    assert "BroadcastHashJoin" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_few_repeated_keys(spark):
    from claimworks.operators.dedupe import keep_one, keep_one_of_few

    rng = random.Random(2)
    rows = [(rng.choice([None, *range(30)]), rng.choice([None, "x"]), rng.choice([None, 1, 2]), i % 5) for i in range(60)] + [(99, "a", 1, 1)]
    df = spark.createDataFrame(rows, "k int, a string, b int, c int")
    for order, last in (([], False), (["c"], True), (["b", "a"], False)):
        for keys in (["k"], ["k", "a"]):
            both = [sorted(map(str, f(df, keys, [o for o in order if o not in keys], last).collect())) for f in (keep_one, keep_one_of_few)]
            assert both[0] == both[1]


def test_a_batch_knows_its_query(spark, tmp_path):
    from test_jobs import done
    from claimworks.sources import sinks

    seen = []
    spark.range(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
    done(sinks.each_batch(stream, lambda df, n, name: seen.append((name, sinks.running_id(df.sparkSession))), f"{tmp_path}/cp", None))
    assert seen == [(sinks.stream_id(spark, f"{tmp_path}/cp"),) * 2]


def test_batches_free_their_shuffle_files(spark, tmp_path):
    from test_jobs import done
    from claimworks import session
    from claimworks.sources import sinks

    seen, before = [], spark.conf.get(session.FREE_SHUFFLES)
    spark.range(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
    done(sinks.each_batch(stream, lambda df, n, name: seen.append(df.sparkSession.conf.get(session.FREE_SHUFFLES)), f"{tmp_path}/cp", None))
    assert seen == ["true"] and spark.conf.get(session.FREE_SHUFFLES) == before


def test_half_written_deliveries_are_never_listed(spark, tmp_path, monkeypatch):
    """A delivery whose write breaks off shows no file where streams look; its replay takes the same number."""
    table = FolderTable(spark, str(tmp_path / "t"), ["k"], buckets=2)
    table.write(0, delivery(spark, [("s", 1, "a")], "k int, v string"))
    save = FolderTable._save

    def breaking(self, frame, layout, target):
        save(self, frame, layout, target)
        raise OSError("broken")

    monkeypatch.setattr(FolderTable, "_save", breaking)
    with pytest.raises(OSError):
        table.write(1, delivery(spark, [("s", 2, "b")], "k int, v string"))
    assert sorted(p.name for p in (tmp_path / "t" / "changes").iterdir() if p.is_dir()) == ["batch=0"]
    monkeypatch.setattr(FolderTable, "_save", save)
    assert table.write(0, delivery(spark, [("s", 7, "other")], "k int, v string"), "other") == 2
    assert table.write(1, delivery(spark, [("s", 2, "b")], "k int, v string")) == 1
    assert sorted(r.k for r in table.read().collect()) == [1, 2, 7]


def test_gold_job_on_a_kept_join(spark, tmp_path):
    """The gold job gives the same tables from the join that is kept up and from the full one, after changes too."""
    from test_jobs import row
    from claimworks import jobs
    from claimworks.plans import gold, silver
    from claimworks.schemas import CLAIM, CUSTOMER, POLICY, TELEMATICS
    from claimworks.streaming.tables import open_table

    base = str(tmp_path)

    def put(name, n, frame, op="s"):
        table = open_table(spark, f"{base}/silver/{name}", gold.SILVER_KEYS[name])
        table.write(n, lambda before: frame.select(F.lit(op).alias("op"), "*"))

    claims = [row(CLAIM, claim_no=f"C{i}", policy_no=f"P{i % 3}", total=str(i)) for i in range(9)]
    policies = [row(POLICY, policy_no=f"P{i}", cust_id=str(i), chassis_no="A", premium="5") for i in range(3)]
    people = [row(CUSTOMER, customer_id=str(i), name=f"N{i}", borough="Bronx") for i in range(3)]
    put("claim", 0, silver.clean_claim(spark.createDataFrame(claims, CLAIM)))
    put("policy", 0, silver.clean_policy(spark.createDataFrame(policies, POLICY)))
    put("customer", 0, silver.clean_customer(spark.createDataFrame(people, CUSTOMER)))
    put("telematics", 0, silver.clean_telematics(spark.createDataFrame(
        [row(TELEMATICS, chassis_no="A", event_timestamp="2024-01-01 00:00:01", speed="7")], TELEMATICS)))

    def built(*more):
        jobs.run(spark, jobs.parser().parse_args(["gold", "--base", base, *more]))
        rows = spark.read.parquet(f"{base}/gold/customer_claim_policy_telematics")
        return sorted(str(r.asDict()) for r in rows.select(*sorted(rows.columns)).collect())

    assert built() == built("--keep-join") and len(built("--keep-join")) == 9
    put("policy", 1, silver.clean_policy(spark.createDataFrame([row(POLICY, policy_no="P1", cust_id="2", chassis_no="A", premium="9")], POLICY)))
    put("customer", 1, silver.clean_customer(spark.createDataFrame([row(CUSTOMER, customer_id="0")], CUSTOMER)), "d")
    kept = built("--keep-join")
    assert kept == built() and len(kept) == 6


def test_batches_are_not_held_in_memory(spark, tmp_path, monkeypatch):
    """A batch's texts lie in the shared folder while its tables take their parts, and are gone afterwards."""
    import json

    from test_jobs import customer
    from claimworks import session
    from claimworks.sources import files
    from claimworks.streaming import follow, ingest

    def batch(*changes):
        return spark.createDataFrame(
            [("customer", op, None, json.dumps(customer(i, name)), ts, ts) for op, i, name, ts in changes],
            "table_name string, op string, before_str string, after_str string, ts_ms long, offset long")

    cached, folders = [], []
    deliver = FolderTable._deliver

    def watched(table, frame, number):
        cached.append(not spark._jsparkSession.sharedState().cacheManager().isEmpty())
        deliver(table, frame, number)

    def noted(session_, name):
        folders.append(session.scratch_dir(session_, name))
        return folders[-1]

    monkeypatch.setattr(FolderTable, "_deliver", watched)
    monkeypatch.setattr(follow, "scratch_dir", noted)
    ingest.apply_changes(batch(("c", 1, "A", 1), ("c", 2, "B", 1)), 0, str(tmp_path))
    ingest.apply_changes(batch(("u", 1, "C", 2), ("c", 3, "D", 2)), 1, str(tmp_path))
    assert len(cached) == 6 and not any(cached)
    assert len(folders) == 1 + 1 + 3 and not any(files.path_exists(spark, f) for f in folders)
    table = FolderTable(spark, f"{tmp_path}/customer", ["customer_id"])
    assert sorted(r["name"] for r in table.read().collect()) == ["B", "C", "D"]
