"""Batch files in and out: inferred and given schemas, exports, audit columns, tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import changes, deltalog, policy
from tidemark.plans.tables import SCHEMAS, Tables
from tidemark.registry.core import query
from tidemark.registry.streams import event_stream, halves
from tidemark.session import work_path
from tidemark.sources import files, incremental, messages
from tidemark.streaming import runs, sinks

CUSTOMER_SQL = "SELECT c_custkey, c_name, c_acctbal FROM customer"


def as_customers(df: DataFrame) -> DataFrame:
    return df.select(F.col("c_custkey").cast("bigint"), "c_name", F.col("c_acctbal").cast("double"))


@query("csv_inferred", CUSTOMER_SQL)
def csv_inferred(t: Tables) -> DataFrame:
    path = work_path(t.spark, "csv")
    files.export(t.customer, path, "csv")
    return as_customers(files.read_csv(t.spark, path))


@query("json_lines", CUSTOMER_SQL)
def json_lines(t: Tables) -> DataFrame:
    path = work_path(t.spark, "json")
    files.export(t.customer, path, "json")
    return as_customers(files.read_json(t.spark, path))


@query("json_documents", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def json_documents(t: Tables) -> DataFrame:
    """Files with one document each, spread over several lines: an array of at most a hundred suppliers."""
    path = work_path(t.spark, "documents")
    row = F.struct("s_suppkey", "s_name", "s_acctbal")
    document = F.regexp_replace(F.to_json(F.collect_list(row)), "\\},\\{", "},\n{")
    t.supplier.groupBy(F.floor(F.col("s_suppkey") / 100).alias("block")).agg(document.alias("value")).write.partitionBy(
        "block").text(path)
    schema = "s_suppkey bigint, s_name string, s_acctbal double"
    return files.read_json(t.spark, path, schema, multi_line=True).select("s_suppkey", "s_name", "s_acctbal")


@query("read_files_by_name", "SELECT event_type, count(*) AS records FROM events WHERE event_type < 'p' GROUP BY 1")
def read_files_by_name(t: Tables) -> DataFrame:
    """The general reader with a name pattern over partition folders; the schema is inferred."""
    path = work_path(t.spark, "by-type")
    t.events.select("event_id", "event_type").write.partitionBy("event_type").parquet(path)
    found = files.read_files(t.spark, path, "parquet", pathGlobFilter="*.parquet")
    return found.filter("event_type < 'p'").groupBy("event_type").agg(F.count("*").alias("records"))


@query("single_file_export", """
SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1""")
def single_file_export(t: Tables) -> DataFrame:
    """A small result as one CSV file."""
    path = work_path(t.spark, "single")
    files.export(t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("customers")), path, "csv", single_file=True)
    return files.read_csv(t.spark, path, "c_mktsegment string, customers bigint")


@query("json_sink", "SELECT event_id, event_type, value FROM events WHERE value > 10")
def json_sink(t: Tables) -> DataFrame:
    root = work_path(t.spark, "json-sink")
    stream = event_stream(t).filter("value > 10").select("event_id", "event_type", "value")
    runs.run_available(stream, f"{root}/table", f"{root}/checkpoint", fmt="json")
    return files.read_json(t.spark, f"{root}/table", "event_id bigint, event_type string, value double")


@query("created_table", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def created_table(t: Tables) -> DataFrame:
    """CREATE OR REPLACE TABLE AS SELECT, twice: the second statement replaces the first. The name is this call's own."""
    path = work_path(t.spark, "finished_orders")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    files.create_table(t.orders.select("o_orderkey"), name, location=path)
    files.create_table(t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), name, location=path)
    found = t.spark.sql(f"SELECT o_orderkey, o_totalprice FROM {name}")
    rows = t.spark.read.schema(found.schema).parquet(path)
    t.spark.sql(f"DROP TABLE {name}")  # the table's files are its path's own, and go with the session
    return rows


@query("audited_load", """
SELECT 'nightly' AS method, 'run-7' AS run_id, count(*) AS records, true AS has_file, true AS has_time FROM orders""")
def audited_load(t: Tables) -> DataFrame:
    """Load time, file, method and run on every row."""
    loaded = files.with_audit(files.read_files(t.spark, t.path("orders"), "parquet"), method="nightly", run_id="run-7")
    return loaded.groupBy(F.col("_ingestion_method").alias("method"), F.col("_ingestion_run_id").alias("run_id")).agg(
        F.count("*").alias("records"), F.bool_and(F.col("_source_file").isNotNull()).alias("has_file"),
        F.bool_and(F.col("_ingested_at").isNotNull()).alias("has_time"))


@query("without_audit_columns", "SELECT * FROM supplier")
def without_audit_columns(t: Tables) -> DataFrame:
    return files.without_audit(files.with_audit(t.supplier, method="batch", source_file=False))


@query("change_rows_applied", """
SELECT event_id, ts, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def change_rows_applied(t: Tables) -> DataFrame:
    """Change rows of a database (operation, sequence, payload) through the change sink, in two batches."""
    root = work_path(t.spark, "change-rows")
    payload = ["event_id", "ts", "user_id", "event_type", "value"]
    schema = "operation string, ts timestamp_ntz, event_id bigint, user_id bigint, event_type string, value double"
    for half in halves(t):
        rows = messages.change_rows(half.withColumn("op", F.lit("update")), "op", ["ts", "event_id"], payload)
        rows.write.mode("append").parquet(f"{root}/source")
        stream = incremental.table_stream(t.spark, f"{root}/source", schema)
        sinks.cdc_sink(stream, f"{root}/table", f"{root}/checkpoint", ["ts", "event_id"],
                       F.col("operation") == "DELETE", drop=["operation"])
    state = changes.change_events(t.events.select(*payload), ["ts", "event_id"]).select(
        *[c for c in ("ts", "event_id", "user_id", "event_type", "value")], "__sequence", "__deleted").schema
    log = deltalog.read_log(t.spark, f"{root}/table", state)
    return changes.live_rows(changes.merge_latest(None, log, ["user_id"])).select(*payload)


@query("division_views", """
SELECT r_name AS region, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE') GROUP BY 1""")
def division_views(t: Tables) -> DataFrame:
    views = policy.division_views(t.customers(), "region", ["ASIA", "EUROPE"])
    counts = [df.groupBy("region").agg(F.count("*").alias("customers")) for df in views.values()]
    return counts[0].unionByName(counts[1])
