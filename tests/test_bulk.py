"""Bulk fold vs a sequential replay of the same action log."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from docindex.operators.bulk import action_lines, apply_bulk, bulk_actions

CUR_SCHEMA = "_id string, _version bigint, a bigint, b string"
ACT_SCHEMA = "_id string, _op_type string, _o bigint, a bigint, c string"


def replay(current: dict, log: list[dict]):
    """Sequential semantics; returns state or raises ValueError."""
    state = {k: dict(v) for k, v in current.items()}
    for act in sorted(log, key=lambda x: x["_o"]):
        i, op = act["_id"], act["_op_type"]
        src = {"a": act["a"], "c": act["c"]}
        if op == "index":
            ver = state.get(i, {}).get("_version", 0)
            state[i] = {**src, "b": None, "_version": ver + 1}
        elif op == "create":
            if i in state:
                raise ValueError("exists")
            state[i] = {**src, "b": None, "_version": 1 + deleted.get(i, 0)}
        elif op == "update":
            if i not in state:
                raise ValueError("missing")
            state[i] = {**state[i], **src, "_version": state[i]["_version"] + 1}
        elif op == "delete":
            if i not in state:
                raise ValueError("missing")
            deleted[i] = state[i]["_version"] + 1
            del state[i]
    return state


deleted: dict = {}


def valid_log(r: random.Random, current: dict, n: int) -> list[dict]:
    """A random log that replays without error."""
    exists = set(current)
    log = []
    for o in range(n):
        i = str(r.randint(0, 14))
        ops = ["index"] + (["update", "delete"] if i in exists else ["create"])
        op = r.choice(ops)
        exists.add(i) if op != "delete" else exists.discard(i)
        log.append({"_id": i, "_op_type": op, "_o": o * 3 + r.randint(0, 2),
                    "a": r.choice([None, r.randint(0, 99)]), "c": r.choice([None, "x", "y"])})
    return log


def run(spark, current: dict, log: list[dict]):
    cur = spark.createDataFrame([(k, v["_version"], v["a"], v["b"]) for k, v in current.items()],
                                CUR_SCHEMA)
    acts = spark.createDataFrame([(x["_id"], x["_op_type"], x["_o"], x["a"], x["c"]) for x in log],
                                 ACT_SCHEMA)
    out = apply_bulk(cur, bulk_actions(acts), order_col="_o")
    return {r["_id"]: {"a": r["a"], "b": r["b"], "c": r["c"], "_version": r["_version"]}
            for r in out.collect()}


@pytest.mark.parametrize("seed", range(6))
def test_fold_matches_replay(spark, seed):
    r = random.Random(seed)
    current = {str(i): {"a": i, "b": f"b{i}", "_version": 1} for i in range(0, 15, 2)}
    log = valid_log(r, current, 60)
    deleted.clear()
    expected = replay(current, log)
    got = run(spark, current, log)
    assert got.keys() == expected.keys()
    for k in expected:
        e = expected[k]
        g = got[k]
        assert (g["a"], g["c"], g["b"]) == (e.get("a"), e.get("c"), e.get("b")), (k, g, e)
        if k not in deleted:
            assert g["_version"] == e["_version"], (k, g, e)


@pytest.mark.parametrize("log", [
    [{"_id": "1", "_op_type": "create", "_o": 0, "a": 1, "c": None}],            # exists already
    [{"_id": "9", "_op_type": "update", "_o": 0, "a": 1, "c": None}],            # missing
    [{"_id": "9", "_op_type": "delete", "_o": 0, "a": None, "c": None}],         # missing
    [{"_id": "1", "_op_type": "delete", "_o": 0, "a": None, "c": None},
     {"_id": "1", "_op_type": "update", "_o": 1, "a": 1, "c": None}],            # update after delete
    [{"_id": "5", "_op_type": "create", "_o": 0, "a": 1, "c": None},
     {"_id": "5", "_op_type": "create", "_o": 1, "a": 2, "c": None}],            # create twice
])
def test_conflicts_fail_the_job(spark, log):
    current = {"1": {"a": 1, "b": "x", "_version": 1}}
    with pytest.raises(PySparkException):
        run(spark, current, log)


def test_delete_then_create_is_legal(spark):
    current = {"1": {"a": 1, "b": "x", "_version": 1}}
    log = [{"_id": "1", "_op_type": "delete", "_o": 0, "a": None, "c": None},
           {"_id": "1", "_op_type": "create", "_o": 1, "a": 7, "c": "z"}]
    assert run(spark, current, log)["1"]["a"] == 7


def test_update_sets_nulls_and_keeps_absent_columns(spark):
    current = {"1": {"a": 1, "b": "keep", "_version": 1}}
    log = [{"_id": "1", "_op_type": "update", "_o": 0, "a": None, "c": "new"}]
    got = run(spark, current, log)["1"]
    assert got == {"a": None, "b": "keep", "c": "new", "_version": 2}


def test_action_envelopes(spark):
    df = spark.createDataFrame([("1", "index", 1, None), ("2", "update", 2, "u"), ("3", "delete", 3, "d")],
                               "_id string, _op_type string, a bigint, c string")
    lines = {r["_id"]: r for r in action_lines(bulk_actions(df, index="ix")).collect()}
    assert lines["1"]["header"] == '{"index":{"_index":"ix","_id":"1"}}'
    assert lines["1"]["body"] == '{"a":1,"c":null}'
    assert lines["2"]["body"] == '{"doc":{"a":2,"c":"u"}}'
    assert lines["3"]["body"] is None


def test_sink_arguments_override_row_metadata(spark):
    df = spark.createDataFrame([("1", "delete", "rowidx", 5)], "_id string, _op_type string, _index string, v bigint")
    acts = bulk_actions(df, index="argidx", op_type="index", meta_fields=["id", "op_type"])
    row = acts.collect()[0]
    assert (row["_op_type"], row["_index"], row["_id"], row["v"]) == ("index", "argidx", "1", 5)
    with pytest.raises(ValueError):
        bulk_actions(df, op_type="upsert")


def test_hot_key_is_pre_aggregated(spark):
    """Many actions on one id: the fold's aggregate runs partial first."""
    acts = spark.range(0, 20000).select(F.lit("hot").alias("_id"), F.lit("index").alias("_op_type"),
                                        F.col("id").alias("_o"), F.col("id").alias("a"))
    cur = spark.createDataFrame([], "_id string, _version bigint")
    out = apply_bulk(cur, bulk_actions(acts), order_col="_o", validate=False, materialize=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan or "partial_max" in plan
    row = out.collect()[0]
    assert (row["_id"], row["a"], row["_version"]) == ("hot", 19999, 20000)


@pytest.mark.parametrize("width", [1, 2, 3, 1 << 20])
def test_bucketed_validation_finds_pairs_across_edges(spark, width):
    cur = spark.createDataFrame([("1", 1, 1)], "_id string, _version bigint, a bigint")
    ops = ["update", "update", "delete", "update"]  # update after delete at position 3
    acts = spark.createDataFrame([("1", op, i, i) for i, op in enumerate(ops)],
                                 "_id string, _op_type string, _o bigint, a bigint")
    with pytest.raises(PySparkException, match="update: document missing"):
        apply_bulk(cur, bulk_actions(acts), order_col="_o", bucket_width=width).count()
    ok = acts.where("_o < 3")
    assert apply_bulk(cur, bulk_actions(ok), order_col="_o", bucket_width=width).count() == 0


def test_hot_key_validation_is_split_by_bucket(spark):
    acts = spark.range(0, 5000).select(F.lit("hot").alias("_id"), F.lit("index").alias("_op_type"),
                                       F.col("id").alias("_o"), F.col("id").alias("a"))
    cur = spark.createDataFrame([], "_id string, _version bigint")
    out = apply_bulk(cur, bulk_actions(acts), order_col="_o", bucket_width=256, materialize=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_b" in plan                       # window keyed by (key, bucket)
    assert out.collect()[0]["a"] == 4999


def test_update_merges_objects_field_by_field(spark):
    cur = spark.createDataFrame([("1", 1, ("x", 5, ("deep", 1)), [1, 2])],
                                "_id string, _version bigint, obj struct<a:string,b:int,c:struct<d:string,e:int>>, arr array<int>")
    acts = spark.createDataFrame([("1", "update", 0, (None, ("new",)), [9])],
                                 "_id string, _op_type string, _o bigint, obj struct<b:int,c:struct<d:string>>, arr array<int>")
    row = apply_bulk(cur, bulk_actions(acts), order_col="_o").collect()[0]
    # b set (to null), c.d set, c.e and a kept; the array is replaced
    assert row.obj.asDict(recursive=True) == {"a": "x", "b": None, "c": {"d": "new", "e": 1}}
    assert row.arr == [9]
    acts2 = spark.createDataFrame([("1", "update", 0, None)], "_id string, _op_type string, _o bigint, obj struct<b:int>")
    assert apply_bulk(cur, bulk_actions(acts2), order_col="_o").collect()[0].obj is None


@pytest.mark.parametrize("seed", range(4))
def test_narrowed_updates_match_replay(spark, seed):
    r = random.Random(100 + seed)
    current = {str(i): {"a": i, "b": f"b{i}", "c": None, "_version": 1} for i in range(8)}
    state = {k: dict(v) for k, v in current.items()}
    log = []
    for o in range(40):
        i = str(r.randint(0, 7))
        fields = r.choice([["a"], ["c"], ["a", "c"], None])
        a, c = r.choice([None, r.randint(0, 99)]), r.choice([None, "x", "y"])
        log.append((i, "update", o, a, c, fields))
        for name, v in (("a", a), ("c", c)):
            if fields is None or name in fields:
                state[i][name] = v
        state[i]["_version"] += 1
    cur = spark.createDataFrame([(k, v["_version"], v["a"], v["b"]) for k, v in current.items()], CUR_SCHEMA)
    acts = spark.createDataFrame(log, "_id string, _op_type string, _o bigint, a bigint, c string, "
                                      "_fields array<string>")
    got = {x["_id"]: x for x in apply_bulk(cur, bulk_actions(acts), order_col="_o").collect()}
    for k, e in state.items():
        g = got[k]
        assert (g["a"], g["b"], g["c"], g["_version"]) == (e["a"], e["b"], e["c"], e["_version"]), (k, g, e)


def test_small_batch_does_not_shuffle_the_index(spark):
    """AQE broadcasts the folded actions; the index streams past unshuffled."""
    from docindex.plans.tables import index
    cur = index(spark, "/root/testdata/sf0.001", "documents")
    acts = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select(
        F.col("doc_id").cast("string").alias("_id"), "quality")
    out = apply_bulk(cur, bulk_actions(acts, op_type="update"))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert "Exchange hashpartitioning" not in plan


def test_equal_actions_without_id_stay_apart(spark):
    rows = [("x", 1), ("x", 1), ("y", 2)]
    actions = spark.createDataFrame(rows, "name string, o long")
    empty = spark.createDataFrame([], "_id string, name string")
    out = apply_bulk(empty, bulk_actions(actions, op_type="index", source_fields=["name"], order_col="o"), order_col="o")
    assert sorted(r.name for r in out.collect()) == ["x", "x", "y"]
    assert out.select("_id").distinct().count() == 3


def test_ties_follow_the_input(spark):
    """Actions with one order value: the row decides, on any partitioning that
    keeps the input order."""
    rows = [("1", "index", 5, "x"), ("1", "update", 5, "y"), ("1", "delete", 5, None), ("1", "create", 5, "z"), ("2", "index", 5, "p"), ("2", "update", 5, "q")]
    empty = spark.createDataFrame([], "_id string, value string")
    results = []
    for parts in (1, 2, 4):
        acts = spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), "_id string, _op_type string, at long, value string")
        out = apply_bulk(empty, bulk_actions(acts.withColumnRenamed("at", "_at"), order_col="_at"), order_col="_at")
        results.append(sorted((r._id, r._version, r.value) for r in out.collect()))
    assert results[0] == results[1] == results[2] == [("1", 4, "z"), ("2", 2, "q")]


def test_predecessors_are_found_on_every_level(spark):
    """One document with very many actions: over runs, ranges and between them."""
    n = 60
    ok = [("k", "create" if i == 0 else "update", i // 7, i) for i in range(n)]
    empty = spark.createDataFrame([], "_id string, value long")

    def run(rows):
        acts = spark.createDataFrame(spark.sparkContext.parallelize(rows, 5), "_id string, _op_type string, _at long, value long")
        return apply_bulk(empty, bulk_actions(acts, order_col="_at"), order_col="_at", bucket_width=3).collect()
    assert [(r._version, r.value) for r in run(ok)] == [(n, n - 1)]
    for bad in (1, 7, 21, 35, n - 1):
        rows = list(ok)
        rows[bad] = ("k", "create", bad // 7, bad)
        with pytest.raises(Exception, match="create: document already exists: k"):
            run(rows)
