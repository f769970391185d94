"""Merges, net changes, de-duplication, imputation, checks and the split."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from claimworks.operators import checks
from claimworks.operators.aggregate import averages, impute_from_history
from claimworks.operators.changelog import apply_net, expand, net_changes, resolve
from claimworks.operators.dedupe import keep_one
from claimworks.operators.joins import salted_join
from claimworks.operators.labels import accuracy_pct, label_indexer
from claimworks.operators.merge import (
    apply_single_changes,
    insert_if_absent,
    merge_frames,
    upsert,
)
from claimworks.operators.split import stratified_split

KV = "k int, v string"
LOG = "k int, op string, ts long, off long, image struct<k:int,v:string>"


def pairs(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "t")], KV)
    source = spark.createDataFrame([(2, "x"), (3, "y"), (None, "s")], KV)
    assert pairs(upsert(target, source, ["k"])) == pairs(spark.createDataFrame(
        [(1, "a"), (2, "x"), (3, "y"), (None, "t"), (None, "s")], KV))
    again = upsert(upsert(target.dropna(), source.dropna(), ["k"]), source.dropna(), ["k"])
    assert pairs(again) == [(1, "a"), (2, "x"), (3, "y")]


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "a")], KV)
    source = spark.createDataFrame([(1, "b"), (2, "c"), (2, "d")], KV)
    assert pairs(insert_if_absent(target, source, ["k"])) == [(1, "a"), (2, "c")]


def test_merge_frames_clauses(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], KV)
    source = spark.createDataFrame([(1, "A"), (2, None), (3, "C"), (4, None)], KV)
    merged = merge_frames(
        target, source, ["k"],
        update=(F.col("source.v").isNotNull(), {"v": F.col("source.v")}),
        delete=F.col("source.v").isNull(),
        insert=(F.col("source.v").isNotNull(), {"k": F.col("source.k")}))
    assert pairs(merged) == pairs(spark.createDataFrame([(1, "A"), (3, None), (None, "n")], KV))


@pytest.mark.parametrize("before,op,after", [
    (None, "c", "1"), (None, "r", "1"), (None, "u", None), (None, "d", None),
    ("0", "c", "0"), ("0", "r", "0"), ("0", "u", "1"), ("0", "d", None), ("0", "t", "0")])
def test_single_change(spark, before, op, after):
    target = spark.createDataFrame([(1, before)] if before else [], KV)
    changes = spark.createDataFrame([(op, 1, "1")], "op string, k int, v string")
    assert pairs(apply_single_changes(target, changes, ["k"])) == ([(1, after)] if after else [])


def one_by_one(state, ops):
    """A key's value after its changes, applied singly."""
    for op, v in ops:
        if op == "u":
            state = v if state is not None else None
        elif op == "d":
            state = None
        elif op in ("c", "r"):
            state = v if state is None else state
    return state


def log_frame(spark, logs, base=0):
    rows = [
        (k, op, base + i // 2, i % 2, (k, v))
        for k, ops in logs.items() for i, (op, v) in enumerate(ops)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, LOG).repartition(4)


def all_logs(ops, length):
    logs = itertools.chain.from_iterable(itertools.product(ops, repeat=n) for n in range(1, length + 1))
    return {k: [(op, str(i)) for i, op in enumerate(log)] for k, log in enumerate(logs)}


@pytest.mark.parametrize("start", [None, "old"])
def test_net_changes_equal_single_application(spark, start):
    logs = all_logs("cudt", 5)  # 1,364 logs
    target = spark.createDataFrame([(k, start) for k in logs] if start else [], KV)
    net = net_changes(log_frame(spark, logs), ["k"], ["ts", "off"], salts=3)
    expected = {k: one_by_one(start, ops) for k, ops in logs.items()}
    expected = sorted((k, v) for k, v in expected.items() if v is not None)
    assert sorted(tuple(r) for r in apply_net(target, net, ["k"]).collect()) == expected

    rows = expand(resolve(net, target, ["k"]), ["k"], ["k", "v"]).collect()
    state = {k: start for k in logs}
    for r in rows:
        state[r["k"]] = r["v"] if r["op"] == "s" else None
    assert sorted((k, v) for k, v in state.items() if v is not None) == expected


def test_batch_cuts_do_not_matter(spark):
    logs = all_logs("crud", 4)
    whole = spark.createDataFrame([], KV)
    parts = [{k: ops[:cut] for k, ops in logs.items()} for cut in (2,)]
    rest = {k: ops[2:] for k, ops in logs.items()}
    for part in (*parts, rest):
        net = net_changes(log_frame(spark, part), ["k"], ["ts", "off"])
        whole = apply_net(whole, net, ["k"])
    expected = {k: one_by_one(None, ops) for k, ops in logs.items()}
    assert sorted(tuple(r) for r in whole.collect()) == sorted(
        (k, v) for k, v in expected.items() if v is not None)


def test_null_keys_and_null_columns_in_the_log(spark):
    rows = [(None, "c", 1, 1, (None, "x")), (1, "c", 1, 2, (1, "a")), (1, "u", 2, 3, (1, None))]
    net = net_changes(spark.createDataFrame(rows, LOG), ["k"], ["ts", "off"])
    assert pairs(apply_net(spark.createDataFrame([], KV), net, ["k"])) == [(1, None)]


def test_hot_key_leaves_each_task_as_one_row(spark):
    """A key with a third of the log is combined before the shuffle."""
    hot = [(0, "c" if i % 3 == 0 else "u" if i % 3 == 1 else "d", i, 0, (0, str(i))) for i in range(3000)]
    cold = [(i, "c", i, 0, (i, "x")) for i in range(1, 6001)]
    log = spark.createDataFrame(hot + cold, LOG).repartition(4)
    net = net_changes(log, ["k"], ["ts", "off"])
    assert net.count() == 6001
    final = {k: one_by_one(None, [(r[1], r[4][1]) for r in hot]) for k in (0,)}
    after = apply_net(spark.createDataFrame([], KV), net, ["k"]).filter("k = 0").collect()
    assert [r["v"] for r in after] == ([final[0]] if final[0] is not None else [])
    plan = net._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_keep_one(spark):
    df = spark.createDataFrame(
        [(1, 2, "b"), (1, 1, "z"), (1, 1, None), (2, 5, "q")], "k int, o int, v string")
    assert pairs(keep_one(df, ["k"], ["o"])) == [(1, 1, "z"), (2, 5, "q")]  # a value before none
    assert pairs(keep_one(df, ["k"], ["o"], last=True)) == [(1, 2, "b"), (2, 5, "q")]
    assert keep_one(df.select("k"), ["k"]).count() == 2
    assert keep_one(df, ["k"]).columns == ["k", "o", "v"]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    large = spark.range(500).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else cast(id % 40 as string) end as k")
    lookup = spark.range(30).selectExpr("cast(id as string) as k", "id * 2 as v").unionByName(
        spark.createDataFrame([("hot", -1), (None, -2)], "k string, v long"))
    plain = large.join(lookup, "k", how).select("id", "k", "v")
    salted = salted_join(large, lookup, ["k"], how, salts=5)
    assert salted.columns == ["id", "k", "v"] and pairs(salted) == pairs(plain)
    parts = salted.filter("k = 'hot'").count()
    assert parts == large.filter("k = 'hot'").count()


def test_impute(spark):
    history = spark.createDataFrame([("A", 10.0), ("A", 20.0), ("C", None)], "c string, s double")
    batch = spark.createDataFrame([("A", None), ("B", None), ("A", 5.0), ("C", None)], "c string, s double")
    assert pairs(impute_from_history(batch, history, ["c"], "s")) == pairs(spark.createDataFrame(
        [("A", 15.0), ("B", None), ("A", 5.0), ("C", None)], "c string, s double"))
    assert pairs(averages(history, ["c"], {"m": "s"})) == [("A", 15.0), ("C", None)]


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "bbbb"), (2, None), (None, "c"), (None, "d")], KV)
    assert pairs(checks.check_unique(df, ["k"])) == [("unique(k)", 1)]
    assert pairs(checks.check_not_null(df, ["k", "v"])) == [("not_null(k)", 2), ("not_null(v)", 1)]
    assert pairs(checks.check_domain(df, {"v": 3}, {"k": (1, 1)})) == [
        ("length(v)<=3", 1), ("numeric(k,1,1)", 3)]
    parent = spark.createDataFrame([(1,)], "p int")
    assert pairs(checks.check_foreign_key(df, "k", parent, "p")) == [("foreign_key(k)", 1, 1)]
    assert pairs(checks.check_foreign_key(df, "k", df, "k")) == [("foreign_key(k)", 0, 0)]


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(0, 9000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 100 = 1 then 'rare' else cast(id % 7 as string) end as label")
    first = stratified_split(df, "label", "id")
    counts = first.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if("is_held_out").alias("h")).collect()
    assert all(r["h"] == -(-r["n"] // 5) for r in counts)
    assert first.count() == 9000
    ids = {r["id"] for r in first.filter("is_held_out").collect()}
    assert ids == {r["id"] for r in stratified_split(df.repartition(7), "label", "id").filter("is_held_out").collect()}
    assert ids != {r["id"] for r in stratified_split(df, "label", "id", seed=1).filter("is_held_out").collect()}
    nothing = stratified_split(df, "label", "id", "0")
    assert nothing.count() == 9000 and nothing.filter("is_held_out").count() == 0


def test_split_deals_no_class_to_one_task(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too large to be broadcast
    try:
        split = stratified_split(spark.range(100).selectExpr("id", "id % 2 as label"), "label", "id")
        assert split.filter("is_held_out").count() == 20
        assert "SortMergeJoin" not in split._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_labels_and_accuracy(spark):
    df = spark.createDataFrame([("b", 1), ("a", 0), ("b", 0), ("c", 2)], "label string, guess int")
    model = label_indexer(df)
    assert list(model.labels) == ["a", "b", "c"]
    scored = model.transform(df)
    assert scored.select(accuracy_pct(F.col("guess"), F.col("label_id")).alias("a")).first()["a"] == 75.0
