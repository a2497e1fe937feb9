import os
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators import changes, deltalog, history, snapshots
from tidemark.sources import incremental
from tidemark.streaming import runs, sinks, transforms

EVENTS = "id int, k string, ts timestamp, v double"


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def land(spark, data, path, schema=EVENTS):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, schema=EVENTS):
    return incremental.table_stream(spark, path, schema)


def test_resume_processes_only_new_rows(spark, path):
    for first, n in ((0, 50), (50, 10)):
        land(spark, [(i, "a", at(1), 1.0) for i in range(first, first + n)], path + "/s")
        done = runs.run_available(stream(spark, path + "/s"), path + "/t", path + "/c")
        assert sum(p.numInputRows for p in done.recentProgress) == n
    assert spark.read.parquet(path + "/t").count() == 60


def daily(df):
    return transforms.tumbling(df, "ts", "1 day", "1 day", ["k"], n=F.count("*"), total=F.sum("v"))


def test_window_is_emitted_after_the_watermark_and_late_rows_are_dropped(spark, rows, path):
    def step(data):
        land(spark, data, path + "/s")
        runs.run_available(daily(stream(spark, path + "/s")), path + "/t", path + "/c")
        return rows(spark.read.parquet(path + "/t"), "window_start", "k", "n", "total")

    assert step([(1, "a", at(1, 5), 1.0), (2, "a", at(1, 6), 2.0)]) == []
    # Within the delay: day 1 is still open and takes the late row.
    assert step([(3, "a", at(2, 1), 4.0), (4, "a", at(1, 7), 8.0)]) == []
    assert step([(5, "a", at(3, 1), 16.0)]) == [(at(1), "a", 3, 11.0)]
    # Day 1 is closed: this row is dropped.
    assert step([(6, "a", at(1, 8), 32.0), (7, "a", at(4, 2), 64.0)]) == [(at(1), "a", 3, 11.0), (at(2), "a", 1, 4.0)]


def test_batch_twin_gives_all_windows(spark, rows, path):
    land(spark, [(1, "a", at(1, 5), 1.0), (2, "a", at(2, 6), 2.0)], path + "/s")
    assert rows(daily(spark.read.parquet(path + "/s")), "window_start", "n") == [(at(1), 1), (at(2), 1)]


def test_event_time_accepts_zone_less_times(spark, path):
    spark.sql("SELECT timestamp_ntz'2024-01-01' AS ts").write.parquet(path + "/s")
    source = stream(spark, path + "/s", "ts timestamp_ntz")
    with pytest.raises(AnalysisException):
        source.withWatermark("ts", "1 day").dropDuplicatesWithinWatermark(["ts"]).writeStream.format("noop").option(
            "checkpointLocation", path + "/c0").start()
    once = transforms.deduplicate(transforms.event_time(source), ["ts"], "ts", "1 day")
    runs.run_available(once, path + "/t", path + "/c")
    assert spark.read.parquet(path + "/t").count() == 1


def test_stream_dedup_across_batches(spark, path):
    for _ in range(2):
        land(spark, [(1, "a", at(1), 1.0), (1, "a", at(1), 1.0), (2, "a", at(1), 1.0)], path + "/s")
        once = transforms.deduplicate(stream(spark, path + "/s"), ["id"], "ts", "1 day")
        runs.run_available(once, path + "/t", path + "/c")
    assert spark.read.parquet(path + "/t").count() == 2


def test_static_side_is_read_for_each_run(spark, rows, path):
    land(spark, [(1, "a", at(1), 1.0)], path + "/s")
    spark.createDataFrame([("a", "old")], "k string, name string").write.parquet(path + "/d")

    def step():
        static = spark.read.schema("k string, name string").parquet(path + "/d")
        runs.run_available(transforms.enrich(stream(spark, path + "/s"), static, "k").select("id", "name"),
                           path + "/t", path + "/c")
        return rows(spark.read.parquet(path + "/t"))

    assert step() == [(1, "old")]
    spark.createDataFrame([("a", "new")], "k string, name string").write.mode("overwrite").parquet(path + "/d")
    land(spark, [(2, "a", at(1), 1.0), (3, "zz", at(1), 1.0)], path + "/s")
    assert step() == [(1, "old"), (2, "new")]


def test_complete_sink_is_the_whole_result_and_keeps_versions(spark, rows, path):
    for day in (1, 2):
        land(spark, [(day, "a", at(day), 1.0), (day, f"k{day}", at(day), 1.0)], path + "/s")
        totals = stream(spark, path + "/s").groupBy("k").agg(F.count("*").alias("n"))
        sinks.complete_sink(totals, path + "/t", path + "/c")
    assert rows(snapshots.read_as_of(spark, path + "/t")) == [("a", 2), ("k1", 1), ("k2", 1)]
    assert rows(snapshots.read_as_of(spark, path + "/t", 0)) == [("a", 1), ("k1", 1)]


def test_a_new_query_is_not_mistaken_for_a_replay(spark, rows, path):
    for run, keys in enumerate(("a", "bc")):
        land(spark, [(1, k, at(1), 1.0) for k in keys], f"{path}/s{run}")
        totals = stream(spark, f"{path}/s{run}").groupBy("k").agg(F.count("*").alias("n"))
        sinks.complete_sink(totals, path + "/t", f"{path}/c{run}")
    assert rows(snapshots.read_as_of(spark, path + "/t")) == [("b", 1), ("c", 1)]
    keys = [r.batch_id for r in snapshots.history(spark, path + "/t").collect()]
    assert len(set(keys)) == 2 and not any(k.startswith("None") for k in keys)


def test_complete_mode_into_files_is_refused(spark, path):
    land(spark, [(1, "a", at(1), 1.0)], path + "/s")
    with pytest.raises(AnalysisException):
        runs.start(stream(spark, path + "/s").groupBy("k").count(), path + "/c", path=path + "/t", mode="complete")


def test_sort_is_refused_on_a_plain_stream_and_allowed_on_complete_aggregates(spark, path):
    land(spark, [(1, "b", at(1), 1.0), (2, "a", at(1), 1.0)], path + "/s")
    with pytest.raises(AnalysisException):
        runs.start(stream(spark, path + "/s").orderBy("k"), path + "/c", path=path + "/t")
    query = runs.start(stream(spark, path + "/s").groupBy("k").count().orderBy("k"), path + "/c2", fmt="memory",
                       mode="complete", name="sorted_counts")
    query.awaitTermination()
    assert [r.k for r in spark.table("sorted_counts").collect()] == ["a", "b"]


def test_update_sink_writes_changed_groups_only(spark, rows, path):
    schema = "k string, n bigint, __sequence struct<generation bigint, batch bigint>, __deleted boolean"
    for day, keys in ((1, "ab"), (2, "b")):
        land(spark, [(day, k, at(day), 1.0) for k in keys], path + "/s")
        totals = stream(spark, path + "/s").groupBy("k").agg(F.count("*").alias("n"))
        sinks.update_sink(totals, path + "/t", path + "/c")
    log = deltalog.read_log(spark, path + "/t", schema)
    assert log.count() == 3
    assert rows(changes.live_rows(changes.merge_latest(None, log, ["k"]))) == [("a", 1), ("b", 2)]
    land(spark, [(3, "b", at(3), 1.0)], path + "/s")
    totals = stream(spark, path + "/s").groupBy("k").agg(F.count("*").alias("n"))
    sinks.update_sink(totals, path + "/t", path + "/new-checkpoint")  # batch ids start again
    log = deltalog.read_log(spark, path + "/t", schema)
    assert rows(changes.live_rows(changes.merge_latest(None, log, ["k"]))) == [("a", 1), ("b", 3)]


def test_cdc_sink_is_idempotent_and_feeds_both_dimension_types(spark, rows, path):
    schema = "k string, v int, seq int, op string"
    for batch in ([("a", 2, 5, "U"), ("b", 0, 4, "D")], [("a", 1, 1, "U"), ("b", 9, 3, "U"), ("c", 1, 1, "U")]):
        land(spark, batch, path + "/s", schema)
        sinks.cdc_sink(stream(spark, path + "/s", schema), path + "/t", path + "/c", ["seq"], F.col("op") == "D", drop=["op"])
    state = "k string, v int, seq int, __sequence struct<seq int>, __deleted boolean"
    log = deltalog.read_log(spark, path + "/t", state)
    assert rows(changes.live_rows(changes.merge_latest(None, log, ["k"])), "k", "v") == [("a", 2), ("c", 1)]
    first = next(n for n in os.listdir(path + "/t/log") if n.endswith("-0"))
    replay = deltalog.read_log(spark, path + "/t", state).filter("seq >= 4").collect()
    deltalog.append_log(spark.createDataFrame(replay, state), path + "/t", first.removeprefix("batch="))
    log = deltalog.read_log(spark, path + "/t", state)
    assert log.count() == 5
    versions = history.apply_scd2(None, log.drop("__sequence"), ["k"], ["seq"], F.col("__sequence.seq"),
                                  F.col("__deleted"))
    assert rows(history.current_versions(versions), "k", "v") == [("a", 2), ("c", 1)]


def test_progress_names_and_stop(spark, rows, path):
    land(spark, [(1, "a", at(1), 1.0)], path + "/s")
    query = runs.start(stream(spark, path + "/s"), path + "/c", path=path + "/t", name="n1", trigger="1 second")
    assert "n1" in [r.name for r in runs.active(spark).collect()]
    query.processAllAvailable()
    assert rows(runs.progress(spark, [query]).filter("input_rows > 0"), "name", "input_rows") == [("n1", 1)]
    assert runs.stop_all(spark) == 1
    assert spark.streams.active == []


def test_streaming_view_in_sql(spark, rows, path):
    land(spark, [(1, "a", at(1), 1.0), (2, "a", at(1), 2.0)], path + "/s")
    stream(spark, path + "/s").createOrReplaceTempView("live_events")
    totals = spark.sql("SELECT k, sum(v) AS total FROM live_events GROUP BY k")
    assert totals.isStreaming
    sinks.complete_sink(totals, path + "/t", path + "/c")
    assert rows(snapshots.read_as_of(spark, path + "/t")) == [("a", 3.0)]
