"""Streaming jobs, run to the end of the available data, and incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import amount, sum_cents
from tidemark.operators import changes, deltalog, metadata, snapshots
from tidemark.plans.tables import SCHEMAS, Tables
from tidemark.registry.core import query
from tidemark.session import work_path
from tidemark.sources import files, incremental, messages
from tidemark.streaming import runs, sinks, transforms

MIDDLE = "TIMESTAMP '2024-01-16'"
TOTAL = "CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100"


def event_stream(t: Tables) -> DataFrame:
    """The events table as a stream (the glob lets the path be one file or a folder)."""
    return incremental.file_stream(t.spark, f"{t.root}/event[s].parquet", "parquet", SCHEMAS["events"])


def halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    return t.events.filter(F.col("ts") < middle), t.events.filter(F.col("ts") >= middle)


def land(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def total_value():
    return amount(sum_cents("value"))


def sink_of(t: Tables, stream: DataFrame, name: str, **kwargs) -> DataFrame:
    """Run a stream into a fresh append-only table and read it back."""
    root = work_path(t.spark, name)
    runs.run_available(stream, f"{root}/table", f"{root}/checkpoint", **kwargs)
    return t.spark.read.schema(stream.schema).parquet(f"{root}/table")


@query("stream_stateless", """
SELECT event_id, user_id, event_type, date_trunc('day', ts) AS day FROM events WHERE value > 10""")
def stream_stateless(t: Tables) -> DataFrame:
    kept = event_stream(t).filter("value > 10").select(
        "event_id", "user_id", "event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"))
    return sink_of(t, kept, "stateless")


@query("stream_resume", "SELECT event_id, user_id, value FROM events WHERE value > 10")
def stream_resume(t: Tables) -> DataFrame:
    root = work_path(t.spark, "resume")
    source, table, checkpoint = f"{root}/source", f"{root}/table", f"{root}/checkpoint"
    for half in halves(t):
        land(half, source)
        stream = incremental.table_stream(t.spark, source, SCHEMAS["events"]).filter("value > 10")
        runs.run_available(stream.select("event_id", "user_id", "value"), table, checkpoint)
    return t.spark.read.schema("event_id bigint, user_id bigint, value double").parquet(table)


@query("stream_complete_agg", f"""
SELECT user_id, count(event_id) AS events, {TOTAL} AS total_value,
       ({TOTAL}) / count(*) AS avg_value FROM events GROUP BY 1""")
def stream_complete_agg(t: Tables) -> DataFrame:
    root = work_path(t.spark, "complete")
    for half in halves(t):
        land(half, f"{root}/source")
        stream = incremental.table_stream(t.spark, f"{root}/source", SCHEMAS["events"])
        totals = stream.groupBy("user_id").agg(
            F.count("event_id").alias("events"), total_value().alias("total_value"),
            (total_value() / F.count(F.lit(1))).alias("avg_value"))
        sinks.complete_sink(totals, f"{root}/table", f"{root}/checkpoint")
    return snapshots.read_as_of(t.spark, f"{root}/table")


@query("stream_update_agg", f"""
SELECT event_type, count(event_id) AS events, {TOTAL} AS total_value FROM events GROUP BY 1""")
def stream_update_agg(t: Tables) -> DataFrame:
    """Several batches, and then a new checkpoint that reads everything again."""
    root = work_path(t.spark, "update")
    early, late = halves(t)
    for checkpoint, part in (("first", early), ("first", late), ("second", None)):
        if part is not None:
            land(part, f"{root}/source")
        stream = incremental.table_stream(t.spark, f"{root}/source", SCHEMAS["events"])
        totals = stream.groupBy("event_type").agg(F.count("event_id").alias("events"),
                                                  total_value().alias("total_value"))
        sinks.update_sink(totals, f"{root}/table", f"{root}/{checkpoint}")
    log = deltalog.read_log(t.spark, f"{root}/table", "event_type string, events bigint, total_value double, "
                            "__sequence struct<generation bigint, batch bigint>, __deleted boolean")
    return changes.live_rows(changes.merge_latest(None, log, ["event_type"]))


WINDOWED = """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, user_id,
       count(event_id) AS events_in_window, {total} AS window_total
FROM events {where} GROUP BY 1, 2, 3 {having}"""


def day_windows(df: DataFrame) -> DataFrame:
    return transforms.tumbling(transforms.event_time(df), "ts", "1 day", "1 day", ["user_id"],
                               events_in_window=F.count("event_id"), window_total=total_value())


@query("event_daily_window", WINDOWED.format(total=TOTAL, where="", having=""))
def event_daily_window(t: Tables) -> DataFrame:
    return day_windows(t.events)


@query("stream_daily_window", WINDOWED.format(total=TOTAL, where="", having="""
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY"""))
def stream_daily_window(t: Tables) -> DataFrame:
    return sink_of(t, day_windows(event_stream(t)), "daily")


@query("stream_five_minute_counts", """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS events
FROM events GROUP BY 1, 2, 3
HAVING time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def stream_five_minute_counts(t: Tables) -> DataFrame:
    windows = transforms.tumbling(transforms.event_time(event_stream(t)), "ts", "10 minutes", "5 minutes",
                                  ["event_type"], events=F.count(F.lit(1)))
    return sink_of(t, windows, "five-minutes")


@query("stream_late_data", WINDOWED.format(total=TOTAL, where=f"WHERE ts >= {MIDDLE}", having="""
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY"""))
def stream_late_data(t: Tables) -> DataFrame:
    root = work_path(t.spark, "late")
    early, late = halves(t)
    for half in (late, early):  # the earlier half arrives when its windows are closed
        land(half, f"{root}/source")
        stream = day_windows(incremental.table_stream(t.spark, f"{root}/source", SCHEMAS["events"]))
        runs.run_available(stream, f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.schema(stream.schema).parquet(f"{root}/table")


@query("stream_static_join", """
SELECT event_id, user_id, event_type, value, c_name AS customer_name, c_mktsegment AS tier
FROM events JOIN customer ON user_id = c_custkey""")
def stream_static_join(t: Tables) -> DataFrame:
    static = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("customer_name"),
                               F.col("c_mktsegment").alias("tier"))
    joined = transforms.enrich(event_stream(t), static, "user_id").select(
        "event_id", "user_id", "event_type", "value", "customer_name", "tier")
    return sink_of(t, joined, "enriched")


@query("stream_dedup", "SELECT event_id, user_id, value FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    root = work_path(t.spark, "dedup")
    for _ in range(2):
        land(t.events, f"{root}/source")
    stream = transforms.event_time(incremental.table_stream(t.spark, f"{root}/source", SCHEMAS["events"]))
    once = transforms.deduplicate(stream, ["event_id"], "ts", "1 day").select("event_id", "user_id", "value")
    return sink_of(t, once, "dedup-out")


@query("stream_layers", f"""
SELECT c_mktsegment AS tier, count(*) AS events, {TOTAL} AS total_value
FROM events JOIN customer ON user_id = c_custkey WHERE value > 0 GROUP BY 1""")
def stream_layers(t: Tables) -> DataFrame:
    root = work_path(t.spark, "layers")
    runs.run_available(event_stream(t).filter("value > 0"), f"{root}/bronze", f"{root}/bronze-checkpoint")
    static = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("tier"))
    silver = transforms.enrich(incremental.table_stream(t.spark, f"{root}/bronze", SCHEMAS["events"]), static, "user_id")
    silver = silver.select("event_id", "user_id", "tier", "value")
    runs.run_available(silver, f"{root}/silver", f"{root}/silver-checkpoint")
    gold = incremental.table_stream(t.spark, f"{root}/silver", silver.schema).groupBy("tier").agg(
        F.count(F.lit(1)).alias("events"), total_value().alias("total_value"))
    sinks.complete_sink(gold, f"{root}/gold", f"{root}/gold-checkpoint")
    return snapshots.read_as_of(t.spark, f"{root}/gold")


@query("stream_scd1", """
SELECT * FROM (SELECT event_id, ts, user_id, event_type, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) WHERE event_type <> 'error'""")
def stream_scd1(t: Tables) -> DataFrame:
    root = work_path(t.spark, "scd1")
    early, late = halves(t)
    for half in (late, early):
        land(half, f"{root}/source")
        stream = incremental.table_stream(t.spark, f"{root}/source", SCHEMAS["events"])
        sinks.cdc_sink(stream, f"{root}/table", f"{root}/checkpoint", ["ts", "event_id"],
                       F.col("event_type") == "error", drop=["props"])
    schema = changes.change_events(t.events, ["ts", "event_id"]).drop("props").schema
    log = deltalog.read_log(t.spark, f"{root}/table", schema)
    return changes.live_rows(changes.merge_latest(None, log, ["user_id"]))


#: Files of the queries that take one file per batch: more batches than a query remembers of itself.
MANY_FILES = 104


@query("stream_progress", f"""
SELECT 'bronze' AS name, count(*) AS input_rows, CAST({MANY_FILES} AS BIGINT) AS batches FROM events""")
def stream_progress(t: Tables) -> DataFrame:
    root = work_path(t.spark, "progress")
    t.events.select("event_id").repartitionByRange(MANY_FILES, "event_id").write.parquet(f"{root}/source")
    stream = incremental.file_stream(t.spark, f"{root}/source", "parquet", "event_id bigint", max_files=1)
    done = runs.run_available(stream, f"{root}/table", f"{root}/checkpoint", name="bronze")
    return runs.progress(t.spark, [done]).filter("input_rows > 0").groupBy("name").agg(
        F.sum("input_rows").alias("input_rows"), F.count("*").alias("batches"))


# Incremental loads of files that Spark lands from the events table.

LOADED = ["event_id", "user_id", "event_type"]


@query("autoload_addcols", f"""
SELECT event_id, user_id, event_type, CASE WHEN ts >= {MIDDLE} THEN value END AS value FROM events""")
def autoload_addcols(t: Tables) -> DataFrame:
    root = work_path(t.spark, "addcols")
    early, late = halves(t)
    for part in (early.select(*LOADED), late.select(*LOADED, "value")):
        part.write.mode("append").json(f"{root}/landing")
        stream = incremental.load_files(t.spark, f"{root}/landing", "json", f"{root}/schema", "addNewColumns")
        runs.run_available(stream.drop("_source_file", "_load_time"), f"{root}/table", f"{root}/checkpoint")
    return files.read_merged(t.spark, f"{root}/table", "event_id bigint, user_id bigint, event_type string, value double")


@query("schema_version_counts", f"""
SELECT CASE WHEN ts < {MIDDLE} THEN 'old schema' ELSE 'new schema' END AS schema_version, count(*) AS records
FROM events GROUP BY 1""")
def schema_version_counts(t: Tables) -> DataFrame:
    autoload_addcols(t).createOrReplaceTempView("loaded_events")
    return t.spark.sql("""
        SELECT CASE WHEN value IS NULL THEN 'old schema' ELSE 'new schema' END AS schema_version, count(*) AS records
        FROM loaded_events GROUP BY 1""")


@query("autoload_rescue", f"""
SELECT event_id, CASE WHEN ts < {MIDDLE} THEN user_id END AS user_id, event_type,
       CASE WHEN ts >= {MIDDLE} THEN '{{"value":"' || CAST(value AS VARCHAR) || '","user_id":"u-' || user_id || '"}}' END
       AS _rescued_data FROM events""")
def autoload_rescue(t: Tables) -> DataFrame:
    root = work_path(t.spark, "rescue")
    early, late = halves(t)
    mistyped = late.select("event_id", F.concat(F.lit("u-"), F.col("user_id").cast("string")).alias("user_id"),
                           "event_type", "value")
    for part in (early.select(*LOADED), mistyped):
        part.write.mode("append").json(f"{root}/landing")
        stream = incremental.load_files(t.spark, f"{root}/landing", "json", f"{root}/schema", "rescue")
        stream = stream.select(*LOADED, "_rescued_data")
        runs.run_available(stream, f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.schema(stream.schema).parquet(f"{root}/table")


@query("autoload_backfill", f"""
SELECT event_id, user_id, event_type, CASE WHEN ts >= {MIDDLE} THEN value END AS value FROM events""")
def autoload_backfill(t: Tables) -> DataFrame:
    """Files that land later but keep old modification times, as copies do, still bring their new column."""
    root = work_path(t.spark, "backfill")
    early, late = halves(t)
    for part, old in ((early.select(*LOADED), False), (late.select(*LOADED, "value"), True)):
        part.write.json(f"{root}/aside-{old}")
        move_files(t.spark, f"{root}/aside-{old}", f"{root}/landing", days_old=5 if old else 0)
        stream = incremental.load_files(t.spark, f"{root}/landing", "json", f"{root}/schema", "addNewColumns")
        runs.run_available(stream.drop("_source_file", "_load_time"), f"{root}/table", f"{root}/checkpoint")
    return files.read_merged(t.spark, f"{root}/table", "event_id bigint, user_id bigint, event_type string, value double")


def move_files(spark, source: str, target: str, days_old: int) -> None:
    """Move data files into a landing folder, with modification times of some days ago."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(target))
    for status in system.listStatus(path(source)):
        name = status.getPath().getName()
        if name.startswith("part-"):
            moved = path(f"{target}/{name}")
            system.rename(status.getPath(), moved)
            at = status.getModificationTime() - days_old * 86_400_000
            system.setTimes(moved, at, at)


@query("autoload_mistyped", f"""
SELECT event_id, CASE WHEN ts < {MIDDLE} THEN user_id END AS user_id,
       CASE WHEN ts >= {MIDDLE} THEN '{{"user_id":"u-' || user_id || '"}}' END AS _rescued_data FROM events""")
def autoload_mistyped(t: Tables) -> DataFrame:
    """A later value that does not fit the stored type is rescued while new columns are added."""
    root = work_path(t.spark, "mistyped")
    early, late = halves(t)
    named = F.concat(F.lit("u-"), F.col("user_id").cast("string")).alias("user_id")
    for part in (early.select("event_id", "user_id"), late.select("event_id", named)):
        part.write.mode("append").json(f"{root}/landing")
        stream = incremental.load_files(t.spark, f"{root}/landing", "json", f"{root}/schema", "addNewColumns")
        stream = stream.select("event_id", "user_id", "_rescued_data")
        runs.run_available(stream, f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.schema(stream.schema).parquet(f"{root}/table")


@query("autoload_ignored_columns", "SELECT event_id, user_id, event_type FROM events")
def autoload_ignored_columns(t: Tables) -> DataFrame:
    root = work_path(t.spark, "ignored")
    early, late = halves(t)
    for part in (early.select(*LOADED), late.select(*LOADED, "value")):
        part.write.mode("append").json(f"{root}/landing")
        stream = incremental.load_files(t.spark, f"{root}/landing", "json", f"{root}/schema", "none").select(*LOADED)
        runs.run_available(stream, f"{root}/table", f"{root}/checkpoint")
    return t.spark.read.schema(stream.schema).parquet(f"{root}/table")


@query("autoload_limited", """
SELECT event_type, count(*) AS records, count(*) FILTER (WHERE value > 10) AS large FROM events GROUP BY 1""")
def autoload_limited(t: Tables) -> DataFrame:
    """Nested folders, a name pattern, and one file per batch."""
    root = work_path(t.spark, "limited")
    columns = ["event_type", "value"]
    t.events.select(*columns).write.json(f"{root}/landing/a/b")
    t.events.select(*columns).limit(5).write.option("header", True).csv(f"{root}/landing/a/other")
    stream = incremental.load_files(t.spark, f"{root}/landing", "json", f"{root}/schema", "none", glob="*.json",
                                    recursive=True, max_files=1)
    loaded = sink_of(t, stream.select(*columns), "limited-out")
    return loaded.groupBy("event_type").agg(F.count("*").alias("records"), F.count_if(F.col("value") > 10).alias("large"))


@query("autoload_csv_layouts", """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS c_acctbal FROM customer""")
def autoload_csv_layouts(t: Tables) -> DataFrame:
    """CSV files of two layouts in one folder: one lacks the last column."""
    root = work_path(t.spark, "csv-layouts")
    short, long = t.customer.filter("c_custkey % 2 = 1"), t.customer.filter("c_custkey % 2 = 0")
    for part in (short.select("c_custkey", "c_name"), long.select("c_custkey", "c_name", "c_acctbal")):
        part.write.mode("append").option("header", True).csv(f"{root}/landing")
    stream = incremental.load_files(t.spark, f"{root}/landing", "csv", f"{root}/schema", "addNewColumns")
    stream = stream.select(F.col("c_custkey").cast("bigint"), "c_name", F.col("c_acctbal").cast("double"))
    return sink_of(t, stream, "csv-layouts-out")


@query("copy_into", "SELECT event_id, user_id, value, count(*) OVER () AS reported FROM events")
def copy_into(t: Tables) -> DataFrame:
    """More files than a query remembers batches, one per batch; the reported rows are those of all calls."""
    root = work_path(t.spark, "copy")
    schema, reported = "event_id bigint, user_id bigint, value double", 0
    for half, n in zip(halves(t), (MANY_FILES, 2)):
        half.select("event_id", "user_id", "value").repartitionByRange(n, "event_id").write.mode("append").option(
            "header", True).csv(f"{root}/landing")
        reported += incremental.copy_into(t.spark, f"{root}/landing", "csv", schema, f"{root}/table",
                                          f"{root}/checkpoint", header="true", max_files=1)
    return t.spark.read.schema(schema).parquet(f"{root}/table").withColumn("reported", F.lit(reported).cast("bigint"))


def loaded_files(t: Tables) -> tuple[DataFrame, int]:
    """Events loaded from files that were written in parallel, and the number of those files."""
    root = work_path(t.spark, "source-files")
    for half in halves(t):
        half.select(*LOADED).write.mode("append").json(f"{root}/landing")
    stream = incremental.load_files(t.spark, f"{root}/landing", "json", f"{root}/schema", "none")
    listed = len(incremental.pending_files(t.spark, f"{root}/landing", f"{root}/never"))
    return sink_of(t, stream, "source-files-out"), listed


@query("source_file_totals", "SELECT count(*) AS records, true AS every_file FROM events")
def source_file_totals(t: Tables) -> DataFrame:
    loaded, listed = loaded_files(t)
    return metadata.source_file_totals(loaded, "_source_file").select(
        "records", (F.col("source_files") == listed).alias("every_file"))


@query("source_file_counts", "SELECT count(*) AS records, true AS every_file, true AS all_timed FROM events")
def source_file_counts(t: Tables) -> DataFrame:
    """Rows and first load time per file, held against the listing."""
    loaded, listed = loaded_files(t)
    per_file = metadata.source_file_counts(loaded, "_source_file", "_load_time")
    return per_file.agg(
        F.sum("records").alias("records"), (F.count("*") == listed).alias("every_file"),
        F.bool_and(F.col("first_load").isNotNull()).alias("all_timed"))


@query("csv_permissive", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal >= 0")
def csv_permissive(t: Tables) -> DataFrame:
    """Lines of customers with a negative balance lose their last fields and must be caught as corrupt."""
    path = work_path(t.spark, "permissive")
    name, balance = F.col("c_name"), F.col("c_acctbal").cast("string")
    line = F.when(F.col("c_acctbal") >= 0, F.concat_ws(",", F.col("c_custkey").cast("string"), name, balance)).otherwise(
        F.col("c_custkey").cast("string"))
    t.customer.select(line).write.text(path)
    schema = t.customer.select("c_custkey", "c_name", "c_acctbal").schema
    return files.sound_rows(files.read_csv_permissive(t.spark, path, schema, header=False))


@query("kafka_envelope", """
SELECT CAST(user_id AS VARCHAR) AS kafka_key, event_id, user_id, event_type, value, 'events' AS kafka_topic,
       0 AS kafka_partition, event_id AS kafka_offset, ts AS kafka_timestamp FROM events""")
def kafka_envelope(t: Tables) -> DataFrame:
    root = work_path(t.spark, "envelope")
    packed = messages.to_envelope(t.events, "user_id", ["event_id", "user_id", "event_type", "value"], "events",
                                  F.col("event_id"), F.col("ts"))
    packed.write.parquet(f"{root}/topic")
    topic = incremental.file_stream(t.spark, f"{root}/topic", "parquet", messages.ENVELOPE)
    parsed = messages.parse_envelope(topic, "event_id bigint, user_id bigint, event_type string, value double")
    return sink_of(t, parsed.withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("timestamp_ntz")), "parsed")


@query("event_json_parse", """
SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def event_json_parse(t: Tables) -> DataFrame:
    return messages.flatten(t.events.select("event_id", "user_id", "props"), "props", "k bigint")


@query("method_comparison", """
SELECT 'orders' AS source, 'batch' AS ingestion_method, count(*) AS records FROM orders UNION ALL
SELECT 'events', 'incremental_files', count(*) FROM events UNION ALL
SELECT 'customer', 'batch', count(*) FROM customer""")
def method_comparison(t: Tables) -> DataFrame:
    streamed = sink_of(t, event_stream(t).withColumn("ingestion_method", F.lit("incremental_files")), "methods")
    parts = {"orders": t.orders.withColumn("ingestion_method", F.lit("batch")), "events": streamed,
             "customer": t.customer.withColumn("ingestion_method", F.lit("batch"))}
    counted = [df.groupBy("ingestion_method").agg(F.count(F.lit(1)).alias("records")).select(
        F.lit(name).alias("source"), "ingestion_method", "records") for name, df in parts.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])
