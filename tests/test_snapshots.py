from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes, snapshots

SCHEMA = "k int, v string"
T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_commit_read_as_of_and_history(spark, rows, path):
    one = spark.createDataFrame([(1, "a")], SCHEMA)
    two = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    assert snapshots.commit(one, path + "/t", "CREATE", timestamp=T0) == 0
    assert snapshots.commit(two, path + "/t", "APPEND", timestamp=T1) == 1
    assert rows(snapshots.read_as_of(spark, path + "/t", 0)) == [(1, "a")]
    assert rows(snapshots.read_as_of(spark, path + "/t")) == [(1, "a"), (2, "b")]
    assert rows(snapshots.read_as_of(spark, path + "/t", timestamp=datetime(2024, 1, 1, 12))) == [(1, "a")]
    with pytest.raises(LookupError):
        snapshots.read_as_of(spark, path + "/t", timestamp=datetime(2023, 1, 1))
    assert rows(snapshots.history(spark, path + "/t"), "version", "operation", "rows") == [
        (0, "CREATE", 1), (1, "APPEND", 2)]


def test_erased_user_is_gone_now_and_present_before(spark, path):
    trips = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u1")], SCHEMA)
    snapshots.commit(trips, path + "/t", "CREATE")
    snapshots.commit(trips.filter("v <> 'u1'"), path + "/t", "DELETE")
    gone = F.col("v") == "u1"
    assert snapshots.read_as_of(spark, path + "/t").filter(gone).count() == 0
    assert snapshots.read_as_of(spark, path + "/t", 0).filter(gone).count() == 2


def test_new_version_may_read_the_one_before(spark, rows, path):
    snapshots.commit(spark.createDataFrame([(1, "a")], SCHEMA), path + "/t", "CREATE")
    now = snapshots.read_as_of(spark, path + "/t")
    snapshots.commit(now.unionByName(now), path + "/t", "INSERT")
    assert rows(snapshots.read_as_of(spark, path + "/t")) == [(1, "a"), (1, "a")]


def test_replayed_batch_is_not_committed_twice(spark, path):
    df = spark.createDataFrame([(1, "a")], SCHEMA)
    assert snapshots.commit(df, path + "/t", "A", batch_id="7") == 0
    assert snapshots.commit(df, path + "/t", "A", batch_id="7") == 0
    assert snapshots.commit(df, path + "/t", "A", batch_id="8") == 1


def test_check_rejects_the_batch_and_null_passes(spark, path):
    good = spark.createDataFrame([(1, "a"), (None, "b")], SCHEMA)
    assert snapshots.commit(good, path + "/t", "A", checks={"positive": "k > 0"}) == 0
    bad = spark.createDataFrame([(0, "a")], SCHEMA)
    with pytest.raises(snapshots.ConstraintViolation, match="positive"):
        snapshots.commit(bad, path + "/t", "A", checks={"positive": "k > 0"})
    with pytest.raises(snapshots.ConstraintViolation, match="key"):
        snapshots.commit(good, path + "/t", "A", checks={"key": "k IS NOT NULL"})
    assert snapshots.history(spark, path + "/t").count() == 1
    assert snapshots.commit(good, path + "/t", "B") == 1


def test_change_feed_and_replay(spark, rows):
    before = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (None, "n")], SCHEMA)
    after = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d"), (None, "n")], SCHEMA)
    feed = snapshots.change_feed(before, after, ["k"], 5, T0)
    assert rows(feed, "_change_type", "k", "v") == [
        ("delete", 3, "c"), ("insert", 4, "d"), ("update_postimage", 2, "x"), ("update_preimage", 2, None)]
    assert {tuple(r) for r in feed.select("_commit_version", "_commit_timestamp").collect()} == {(5, T0)}
    assert rows(snapshots.apply_change_feed(before, feed, ["k"])) == rows(after)
    assert rows(snapshots.changed_rows(before, after, ["k"])) == [(2, "x"), (4, "d")]
    assert snapshots.change_feed(after, after, ["k"], 1, T0).count() == 0


def test_a_repeated_key_is_refused(spark):
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    once = twice.limit(1)
    for before, after in ((twice, once), (once, twice)):
        with pytest.raises(ValueError, match="duplicate key"):
            snapshots.change_feed(before, after, ["k"], 1, T0)
    with pytest.raises(ValueError, match="duplicate key"):
        snapshots.upsert_feed(once, twice, ["k"])


def test_stored_feed_equals_the_compared_one(spark, rows, path, plan):
    v0 = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    batch = spark.createDataFrame([("b", 20), ("c", 3), ("d", 4)], "k string, v int")
    v1 = changes.upsert(v0, batch, ["k"], [F.col("v")])
    feed = snapshots.upsert_feed(v0, batch, ["k"])
    compared = snapshots.change_feed(v0, v1, ["k"], 1, T0).drop("_commit_version", "_commit_timestamp")
    assert rows(feed) == rows(compared.select(*feed.columns))
    snapshots.commit(v0, path + "/t", "CREATE")
    snapshots.commit(v1, path + "/t", "MERGE", feed=feed)
    snapshots.commit(changes.delete_where(v1, F.col("v") == 4), path + "/t", "DELETE",
                     feed=snapshots.delete_feed(v1, F.col("v") == 4))
    found = snapshots.table_changes(spark, path + "/t", ["k"], 1, 2)
    assert "FullOuter" not in plan(found)
    assert rows(found, "_change_type", "k", "v", "_commit_version") == [
        ("delete", "d", 4, 2), ("insert", "d", 4, 1), ("update_postimage", "b", 20, 1), ("update_preimage", "b", 2, 1)]


def test_change_feed_with_a_new_column(spark, rows):
    before = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    after = snapshots.add_column(before, "tip", "double").withColumn(
        "tip", F.when(F.col("k") == 2, 1.5))
    feed = snapshots.change_feed(before, after, ["k"], 1, T0)
    assert rows(feed, "_change_type", "k", "tip") == [("update_postimage", 2, 1.5), ("update_preimage", 2, None)]


def test_table_changes_over_versions(spark, rows, path):
    v0 = spark.createDataFrame([(1, "a")], SCHEMA)
    v1 = spark.createDataFrame([(1, "b"), (2, "c")], SCHEMA)
    v2 = spark.createDataFrame([(2, "c")], SCHEMA)
    for i, df in enumerate((v0, v1, v2)):
        snapshots.commit(df, path + "/t", f"op{i}")
    feed = snapshots.table_changes(spark, path + "/t", ["k"], 0)
    assert rows(feed, "_commit_version", "_change_type", "k", "v") == [
        (0, "insert", 1, "a"), (1, "insert", 2, "c"), (1, "update_postimage", 1, "b"),
        (1, "update_preimage", 1, "a"), (2, "delete", 1, "b")]


def test_require_unique(spark):
    snapshots.require_unique(spark.createDataFrame([(1, "a"), (2, "a")], SCHEMA), ["k"])
    with pytest.raises(ValueError):
        snapshots.require_unique(spark.createDataFrame([(1, "a"), (1, "b")], SCHEMA), ["k"])


def test_copy_and_fingerprint(spark, path):
    df = spark.createDataFrame([(1, "a"), (2, None)], SCHEMA)
    snapshots.commit(df, path + "/s", "CREATE")
    snapshots.copy_table(spark, path + "/s", path + "/d")
    same = snapshots.fingerprint(snapshots.read_as_of(spark, path + "/d")).first()
    assert same == snapshots.fingerprint(df.select("v", "k")).first()
    assert same != snapshots.fingerprint(df.limit(1)).first()


def test_partitioned_commit_prunes(spark, path, plan):
    snapshots.commit(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), path + "/t", "CREATE", partition_by=["v"])
    text = plan(snapshots.read_as_of(spark, path + "/t").filter("v = 'a'"))
    assert "PartitionFilters: [isnotnull(v" in text
