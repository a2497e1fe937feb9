"""Plans under a key that holds a third of all rows, with every table treated as large."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes
from tidemark.operators.keyed import next_in_key

LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def large(spark):
    before = {k: spark.conf.get(k, None) for k in LARGE}
    for k, v in LARGE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def hot(large, path):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    large.range(0, 600_000, 1, 8).select(key.alias("k"), F.col("id"), F.concat(
        F.lit("pad"), F.xxhash64("id")).alias("pad")).write.parquet(path + "/hot")
    large.range(0, 5000, 2).select(F.col("id").alias("k")).write.parquet(path + "/keys")
    return large.read.parquet(path + "/hot"), large.read.parquet(path + "/keys")


def run(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_deletion_list_join_splits_the_hot_partition(hot):
    rows, plan = run(changes.delete_keys(*hot, ["k"]).agg(F.count("*"), F.max("pad")))
    assert "skew=true" in plan
    left = [i for i in range(600_000) if (7 if i % 3 == 0 else i % 5000) % 2]
    assert rows[0][0] == len(left)


def test_join_below_an_aggregate_on_the_same_key_splits_too(hot):
    facts, keys = hot
    odd = keys.select((F.col("k") + 1).alias("k"), F.lit("n").alias("name"))
    rows, plan = run(facts.join(odd, "k").groupBy("k", "name").agg(F.max("pad")))
    assert "skew=true" in plan
    assert len(rows) == 2500


def test_successor_of_a_hot_key_is_spread_over_buckets(large, plan):
    df = large.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"),
                                    F.struct("id").alias("o"))
    found = next_in_key(df, ["k"], "o", F.floor(F.col("o.id") / 100), "n")
    windows = [line for line in plan(found).splitlines() if "lead(" in line]
    assert windows and all("__bucket" in line for line in windows)
    hot_next = {r.o.id: r.n and r.n.id for r in found.filter("k = 7").collect()}
    ids = sorted(i for i in range(30_000) if i % 3 == 0 or i % 50 == 7)
    assert hot_next == dict(zip(ids, ids[1:] + [None]))


def test_touched_partitions_are_pruned_at_run_time(spark, path):
    spark.range(1000).withColumn("p", F.col("id") % 10).write.partitionBy("p").parquet(path + "/t")
    table = spark.read.parquet(path + "/t")
    rows, plan = run(table.join(table.filter("id IN (3, 14)").select("p").distinct(), "p", "left_semi"))
    assert len(rows) == 200 and "dynamicpruning" in plan
