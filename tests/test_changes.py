import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes, deltalog, history
from tidemark.operators.dedup import duplicate_keys, latest_per_key, newest_first
from tidemark.operators.keyed import next_in_key

KV = "k string, v int, ts int"


def frame(spark, data, schema=KV):
    return spark.createDataFrame(data, schema)


def newest():
    return [F.col("ts").desc(), F.col("v").desc_nulls_last()]


def test_latest_per_key_null_key_ties_and_empty(spark, rows):
    df = frame(spark, [("a", 1, 1), ("a", 2, 2), ("a", 3, 2), (None, 4, 1), (None, None, 9), ("a", 3, 2)])
    assert rows(latest_per_key(df, ["k"], newest())) == [(None, None, 9), ("a", 3, 2)]
    assert rows(latest_per_key(df.limit(0), ["k"], newest())) == []
    with pytest.raises(ValueError):
        latest_per_key(df, ["k"], [])


def test_latest_per_key_reduces_before_the_shuffle(spark, plan):
    text = plan(latest_per_key(frame(spark, [("a", 1, 1)]).repartition(3), ["k"], newest()))
    assert text.count("WindowGroupLimit") == 2


def test_latest_per_key_does_not_depend_on_input_order(spark, rows):
    data = [("a", v, 1) for v in range(20)] + [("b", None, 2), ("b", 5, 2)]
    want = None
    for seed in range(4):
        random.Random(seed).shuffle(data)
        got = rows(latest_per_key(frame(spark, data).repartition(4), ["k"], newest_first(["ts"], ["v"])))
        want = want or got
        assert got == want


def test_duplicate_keys(spark, rows):
    df = frame(spark, [("a", 1, 1), ("a", 1, 1), ("b", 1, 1), (None, 1, 1), (None, 2, 2)])
    assert rows(duplicate_keys(df, ["k"])) == [(None, 2), ("a", 2)]


def test_upsert(spark, rows):
    target = frame(spark, [("a", 1, 1), ("b", 2, 1), (None, 0, 0)])
    batch = frame(spark, [("b", 20, 2), ("b", 19, 1), ("c", 3, 1), (None, 7, 7)])
    got = rows(changes.upsert(target, batch, ["k"], newest()))
    assert got == [(None, 0, 0), (None, 7, 7), ("a", 1, 1), ("b", 20, 2), ("c", 3, 1)]
    assert rows(changes.upsert(target, batch.limit(0), ["k"], newest())) == rows(target)
    assert len(rows(changes.upsert(target.limit(0), batch, ["k"], newest()))) == 3


def test_upsert_is_idempotent(spark, rows):
    target = frame(spark, [("a", 1, 1), ("b", 2, 1)])
    batch = frame(spark, [("b", 20, 2), ("c", 3, 1)])
    once = changes.upsert(target, batch, ["k"], newest())
    assert rows(changes.upsert(once, batch, ["k"], newest())) == rows(once)


def test_upsert_of_a_small_batch_does_not_shuffle_the_target(spark, plan, path):
    spark.range(1000).selectExpr("string(id) k", "int(id) v", "1 ts").write.parquet(path + "/t")
    frame(spark, [("1", 1, 1)]).write.parquet(path + "/b")
    target, batch = spark.read.parquet(path + "/t"), spark.read.parquet(path + "/b")
    text = plan(changes.upsert(target, batch, ["k"], newest()))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_upsert_columns(spark, rows):
    target = frame(spark, [("a", 1, 1), ("b", 2, 1), ("d", 4, 4)])
    batch = frame(spark, [("b", None, 2), ("c", 3, 9)])
    got = rows(changes.upsert_columns(target, batch, ["k"], ["v"], newest()))
    assert got == [("a", 1, 1), ("b", None, 1), ("c", 3, 9), ("d", 4, 4)]


def test_upsert_with_delete(spark, rows):
    target = frame(spark, [("a", 1, 1), ("b", 2, 1)])
    batch = spark.createDataFrame(
        [("a", 0, 5, "DELETE"), ("b", 5, 1, "DELETE"), ("b", 6, 2, "UPDATE"), ("x", 1, 1, "DELETE"),
         ("n", 9, 1, None)], KV + ", op string")
    got = rows(changes.upsert_with_delete(target, batch, ["k"], F.col("op") == "DELETE", newest()))
    assert got == [("b", 6, 2), ("n", 9, 1)]
    first = changes.upsert_with_delete(None, batch, ["k"], F.col("op") == "DELETE", newest())
    assert rows(first, "k", "v") == [("b", 6), ("n", 9)]


def test_update_and_delete_where_leave_null_conditions_alone(spark, rows):
    df = frame(spark, [("a", 1, 1), ("b", None, 2), ("c", 9, 3)])
    updated = changes.update_where(df, F.col("v") > 5, {"v": F.col("ts") * 100, "ts": F.col("v")})
    assert rows(updated) == [("a", 1, 1), ("b", None, 2), ("c", 300, 9)]
    assert updated.schema == df.schema
    assert rows(changes.delete_where(df, F.col("v") > 5)) == [("a", 1, 1), ("b", None, 2)]


def test_delete_keys(spark, rows):
    df = frame(spark, [("a", 1, 1), (None, 2, 2), ("b", 3, 3)])
    listed = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(changes.delete_keys(df, listed, ["k"])) == [(None, 2, 2), ("b", 3, 3)]


def test_insert_select_reads_the_state_before(spark, rows):
    df = frame(spark, [("a", 1, 1), ("b", 2, 2)])
    assert rows(changes.insert_select(df, df.orderBy("k").limit(1))) == [("a", 1, 1), ("a", 1, 1), ("b", 2, 2)]


CDC = "k string, v int, seq int, op string"
EVENTS = [("a", 1, 1, "U"), ("a", 2, 5, "U"), ("a", 3, 3, "U"), ("b", 1, 1, "U"), ("b", 0, 4, "D"), ("b", 2, 3, "U"),
          ("c", 0, 2, "D"), ("c", 7, 1, "U"), ("d", 5, 2, "U"), ("d", 6, 2, "U"), (None, 1, 1, "U"), (None, 2, 2, "U")]


def apply_in(spark, order, parts):
    state, events = None, [EVENTS[i] for i in order]
    size = -(-len(events) // parts)
    for i in range(0, len(events), size):
        state = changes.apply_cdc(state, spark.createDataFrame(events[i:i + size], CDC), ["k"], ["seq"],
                                  F.col("op") == "D", drop=["op"])
    return changes.live_rows(state)


def test_cdc_keeps_tombstones_and_ignores_late_rows(spark, rows):
    got = rows(apply_in(spark, range(len(EVENTS)), 1))
    assert [r for r in got if r[0] != "d"] == [(None, 2, 2), ("a", 2, 5)]
    assert [r[0] for r in got] == [None, "a", "d"]


def test_cdc_result_is_the_same_for_every_order_and_batching(spark, rows):
    want = rows(apply_in(spark, range(len(EVENTS)), 1))
    for seed in range(4):
        order = list(range(len(EVENTS)))
        random.Random(seed).shuffle(order)
        assert rows(apply_in(spark, order, 1 + seed)) == want


def test_cdc_replayed_batch_changes_nothing(spark, rows):
    batch = spark.createDataFrame(EVENTS, CDC)
    once = changes.apply_cdc(None, batch, ["k"], ["seq"], F.col("op") == "D")
    assert rows(changes.apply_cdc(once, batch, ["k"], ["seq"], F.col("op") == "D")) == rows(once)


def scd2_in(spark, order, parts):
    state, events = None, [EVENTS[i] for i in order]
    size = -(-len(events) // parts)
    for i in range(0, len(events), size):
        state = history.apply_scd2(state, spark.createDataFrame(events[i:i + size], CDC), ["k"], ["seq"],
                                   F.floor(F.col("__sequence.seq") / 2), F.col("op") == "D", drop=["op"])
    return state


def flat(rows, state):
    return rows(history.versions(state), "k", "v", "__start_at.seq", "__end_at.seq", "__is_current")


def test_scd2_versions(spark, rows):
    got = flat(rows, scd2_in(spark, range(len(EVENTS)), 1))
    assert [r for r in got if r[0] != "d"] == [
        (None, 1, 1, 2, False), (None, 2, 2, None, True),
        ("a", 1, 1, 3, False), ("a", 2, 5, None, True), ("a", 3, 3, 5, False),
        ("b", 1, 1, 3, False), ("b", 2, 3, 4, False),
        ("c", 7, 1, 2, False)]
    assert len([r for r in got if r[0] == "d"]) == 1


def test_scd2_is_safe_for_late_rows(spark, rows):
    want = flat(rows, scd2_in(spark, range(len(EVENTS)), 1))
    for seed in range(3):
        order = list(range(len(EVENTS)))
        random.Random(seed).shuffle(order)
        assert flat(rows, scd2_in(spark, order, 2 + seed)) == want


def test_scd2_current_rows_are_scd1(spark, rows):
    state = scd2_in(spark, range(len(EVENTS)), 3)
    assert rows(history.current_versions(state), "k", "v", "seq") == rows(apply_in(spark, range(len(EVENTS)), 2))


def test_scd2_as_of(spark, rows):
    state = scd2_in(spark, range(len(EVENTS)), 1)
    at3 = history.as_of(state, F.struct(F.lit(3).alias("seq")))
    assert [r for r in rows(at3, "k", "v") if r[0] in ("a", "b", "c")] == [("a", 3), ("b", 2)]


def test_next_in_key_equals_a_plain_lead(spark, rows):
    from pyspark.sql.window import Window

    random.seed(5)
    data = [("hot" if random.random() < .6 else f"k{random.randint(0, 5)}", i, random.randint(0, 10_000))
            for i in range(400)]
    df = frame(spark, data).withColumn("o", F.struct("ts", "v"))
    plain = df.withColumn("n", F.lead("o").over(Window.partitionBy("k").orderBy("o")))
    for width in (1, 50, 100_000):
        got = next_in_key(df, ["k"], "o", F.floor(F.col("ts") / width), "n")
        assert rows(got, "k", "v", "ts", "n") == rows(plain, "k", "v", "ts", "n")


def test_precombine_and_merge_on_read(spark, rows, path):
    base = frame(spark, [("a", 1, 1), ("b", 2, 5)])
    batch = frame(spark, [("a", 10, 2), ("b", 20, 4), ("c", 30, 1)])
    merged = [("a", 10, 2), ("b", 2, 5), ("c", 30, 1)]
    assert rows(deltalog.precombine_upsert(base, batch, ["k"], ["ts"])) == merged
    state = deltalog.keyed_rows(base, ["ts"])
    deltalog.write_base(state, path, 0)
    for _ in range(2):  # a replay overwrites its own folder
        deltalog.append_log(deltalog.keyed_rows(batch, ["ts"]), path, 0)
    stored = deltalog.read_base(spark, path, 0, state.schema)
    log = deltalog.read_log(spark, path, state.schema)
    assert log.count() == 3
    assert rows(changes.live_rows(stored)) == rows(base)
    snapshot = deltalog.snapshot_read(stored, log, ["k"])
    assert rows(changes.live_rows(snapshot)) == merged
    erased = spark.createDataFrame([("a",)], "k string")
    assert rows(changes.live_rows(deltalog.erased_read(snapshot, erased, ["k"]))) == merged[1:]
    assert deltalog.compact(spark, path, 0, state.schema, ["k"], erased) == 1
    assert rows(changes.live_rows(deltalog.read_base(spark, path, 1, state.schema))) == merged[1:]
    assert deltalog.read_log(spark, path, state.schema).count() == 0
    deltalog.append_log(deltalog.keyed_rows(frame(spark, [("d", 4, 4)]), ["ts"]), path, 1)
    assert rows(changes.live_rows(deltalog.read_log(spark, path, state.schema))) == [("d", 4, 4)]
    kept = spark.read.option("recursiveFileLookup", True).schema(state.schema).parquet(path + "/base", path + "/log")
    assert kept.filter("k = 'a'").count() == 0


def test_pull_between_is_half_open(spark, rows):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, _commit_time int")
    assert rows(deltalog.pull_between(df, 10, 30), "id") == [(2,), (3,)]


def test_only_touched_buckets_are_rewritten(spark, rows, path):
    from tidemark.operators import buckets, metadata

    def files():
        return {r.path for r in metadata.file_sizes(spark, path + "/t").collect() if r.path.endswith(".parquet")}

    merge = lambda state, batch: changes.apply_cdc(state, batch, ["k"], ["ts"])
    first = frame(spark, [(c, 1, 1) for c in "abcdefghij"])
    assert len(buckets.apply_batch(spark, path + "/t", first, ["k"], 8, merge)) > 2
    before = files()
    batch = frame(spark, [("b", 20, 2)])
    touched = buckets.apply_batch(spark, path + "/t", batch, ["k"], 8, merge)
    assert len(touched) == 1
    changed = before ^ files()
    assert changed and all(f"/__bucket={touched[0]}/" in f for f in changed)
    state = buckets.read_state(spark, path + "/t", spark.read.parquet(path + "/t").drop("__bucket").schema)
    assert rows(changes.live_rows(state), "k", "v") == sorted([("b", 20), *[(c, 1) for c in "acdefghij"]])
