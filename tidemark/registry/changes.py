"""Upserts, change application, slowly changing dimensions, merge on read, snapshots and change feeds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import amount, cents, share_of
from tidemark.operators import buckets, changes, deltalog, history, snapshots
from tidemark.operators.dedup import latest_per_key
from tidemark.plans.tables import Tables
from tidemark.registry.core import query
from tidemark.session import stored, work_path

ORDER_COLUMNS = ["order_id", "customer_id", "status", "order_date", "order_amount"]

# The table as of the end of 2000, and a batch of everything placed since July 2000, finished and repriced:
# the orders of the second half of 2000 are updates, those of 2001 are inserts.
ORDERS_SQL = """
o AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_orderdate AS order_date,
             CAST(round(o_totalprice * 100) AS BIGINT) AS amount FROM orders),
target AS (SELECT * FROM o WHERE order_date < TIMESTAMP '2001-01-01'),
batch AS (SELECT order_id, customer_id, 'F' AS status, order_date,
                 CAST((amount * 105 * 2 + 100) // 200 AS BIGINT) AS amount, status AS old_status
          FROM o WHERE order_date >= TIMESTAMP '2000-07-01'),
merged AS (
  SELECT order_id, customer_id, status, order_date, amount FROM batch UNION ALL
  SELECT * FROM target WHERE order_id NOT IN (SELECT order_id FROM batch))"""
AS_ROW = "order_id, customer_id, status, order_date, CAST(amount AS DOUBLE) / 100 AS order_amount"


def order_table(t: Tables) -> DataFrame:
    return t.order_headers().select(*ORDER_COLUMNS)


def target_orders(t: Tables) -> DataFrame:
    return order_table(t).filter("order_date < TIMESTAMP_NTZ '2001-01-01'")


def order_batch(t: Tables) -> DataFrame:
    repriced = amount(share_of(cents("order_amount"), F.lit(10_500)))
    return (
        order_table(t).filter("order_date >= TIMESTAMP_NTZ '2000-07-01'")
        .withColumns({"old_status": F.col("status"), "status": F.lit("F"), "order_amount": repriced})
    )


def by_date() -> list:
    return [F.col("order_date").desc(), F.col("order_amount").desc()]


@query("upsert_orders", "WITH" + ORDERS_SQL + f" SELECT {AS_ROW} FROM merged")
def upsert_orders(t: Tables) -> DataFrame:
    return changes.upsert(target_orders(t), order_batch(t), ["order_id"], by_date())


@query("upsert_columns", "WITH" + ORDERS_SQL + """
SELECT t.order_id, t.customer_id, coalesce(b.status, t.status) AS status, t.order_date,
       CAST(t.amount AS DOUBLE) / 100 AS order_amount
FROM target t LEFT JOIN batch b ON t.order_id = b.order_id UNION ALL
SELECT """ + AS_ROW + " FROM batch WHERE order_id NOT IN (SELECT order_id FROM target)")
def upsert_columns(t: Tables) -> DataFrame:
    return changes.upsert_columns(target_orders(t), order_batch(t), ["order_id"], ["status"], by_date())


@query("cdc_apply", "WITH" + ORDERS_SQL + f"""
SELECT {AS_ROW} FROM merged WHERE order_id NOT IN (SELECT order_id FROM batch WHERE old_status = 'P')""")
def cdc_apply(t: Tables) -> DataFrame:
    batch = order_batch(t).withColumn("op", F.when(F.col("old_status") == "P", "DELETE").otherwise("UPDATE"))
    return changes.upsert_with_delete(
        target_orders(t), batch, ["order_id"], F.col("op") == "DELETE", by_date())


@query("update_where", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '2000-01-01' THEN 'F'
       ELSE o_orderstatus END AS o_orderstatus, o_orderdate, o_orderpriority FROM orders""")
def update_where(t: Tables) -> DataFrame:
    late = (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return changes.update_where(t.orders, late, {"o_orderstatus": F.lit("F")}).select(
        "o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority")


@query("delete_where", "SELECT event_id, user_id, event_type, value FROM events WHERE NOT (value < 5)")
def delete_where(t: Tables) -> DataFrame:
    return changes.delete_where(t.events, F.col("value") < 5).select("event_id", "user_id", "event_type", "value")


@query("delete_users", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def delete_users(t: Tables) -> DataFrame:
    leaving = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return changes.delete_keys(t.orders, leaving, ["o_custkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


@query("insert_select", """
SELECT o_orderkey, o_totalprice FROM orders UNION ALL
(SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500)""")
def insert_select(t: Tables) -> DataFrame:
    before = t.orders.select("o_orderkey", "o_totalprice")
    return changes.insert_select(before, before.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(500))


# Events as changes: key user_id, sequence (ts, event_id), an error event deletes the user.
# The later half arrives first, so the earlier half is late and must not overwrite it.


def event_halves(t: Tables) -> list[DataFrame]:
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    return [t.events.filter(F.col("ts") >= middle), t.events.filter(F.col("ts") < middle)]


#: Buckets of the state tables; a batch of all users touches all of them, a small one a few.
BUCKETS = 16


def user_state(t: Tables) -> DataFrame:
    path = work_path(t.spark, "user-state")
    for half in event_halves(t):
        buckets.apply_batch(t.spark, path, half, ["user_id"], BUCKETS, lambda state, batch: changes.apply_cdc(
            state, batch, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error"))
    return buckets.read_state(t.spark, path, t.spark.read.parquet(path).drop(buckets.BUCKET).schema)


def user_history(t: Tables) -> DataFrame:
    path = work_path(t.spark, "user-history")
    for half in event_halves(t):
        buckets.apply_batch(t.spark, path, half.drop("props"), ["user_id"], BUCKETS, lambda rows, batch: history.apply_scd2(
            rows, batch, ["user_id"], ["ts", "event_id"], F.date_trunc("hour", F.col("__sequence.ts")),
            F.col("event_type") == "error"))
    return buckets.read_state(t.spark, path, t.spark.read.parquet(path).drop(buckets.BUCKET).schema)


@query("scd1_state", """
SELECT * FROM (SELECT * FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) WHERE event_type <> 'error'""")
def scd1_state(t: Tables) -> DataFrame:
    return changes.live_rows(user_state(t))


@query("scd2_history", """
SELECT * FROM (
  SELECT event_id, ts, user_id, event_type, value, ts AS start_at,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_at,
         lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
  FROM events) WHERE event_type <> 'error'""")
def scd2_history(t: Tables) -> DataFrame:
    rows = history.versions(user_history(t))
    return rows.select("event_id", "ts", "user_id", "event_type", "value", F.col("__start_at.ts").alias("start_at"),
                       F.col("__end_at.ts").alias("end_at"), F.col("__is_current").alias("is_current"))


@query("scd2_as_of", """
SELECT user_id, event_id, event_type FROM (
  SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_at FROM events)
WHERE event_type <> 'error' AND ts <= TIMESTAMP '2024-01-20' AND (end_at IS NULL OR end_at > TIMESTAMP '2024-01-20')""")
def scd2_as_of(t: Tables) -> DataFrame:
    point = F.struct(F.lit("2024-01-20").cast("timestamp_ntz").alias("ts"), F.lit(2**62).alias("event_id"))
    return history.as_of(user_history(t), point).select("user_id", "event_id", "event_type")


# Latest event per user as a table with a log: base before 11 January, then two batches.

BASE_END, FIRST_BATCH_END = "2024-01-11", "2024-01-21"
LATEST_SQL = "row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


def user_base(t: Tables) -> DataFrame:
    early = t.events.filter(F.col("ts") < F.lit(BASE_END).cast("timestamp_ntz"))
    return changes.merge_latest(None, deltalog.keyed_rows(early, ["ts", "event_id"]), ["user_id"])


def user_batches(t: Tables) -> list[DataFrame]:
    cut, end = (F.lit(d).cast("timestamp_ntz") for d in (BASE_END, FIRST_BATCH_END))
    ts = F.col("ts")
    return [deltalog.keyed_rows(t.events.filter(c), ["ts", "event_id"])
            for c in ((ts >= cut) & (ts < end), ts >= end)]


def logged_table(t: Tables) -> tuple[str, DataFrame, DataFrame]:
    """Write base and log, and open both."""
    table = work_path(t.spark, "user-log")
    base = user_base(t)
    deltalog.write_base(base, table, 0)
    for i, batch in enumerate(user_batches(t)):
        deltalog.append_log(batch, table, i)
    return (table, deltalog.read_base(t.spark, table, 0, base.schema),
            deltalog.read_log(t.spark, table, base.schema))


@query("precombine_upsert", f"SELECT * FROM events QUALIFY {LATEST_SQL}")
def precombine_upsert(t: Tables) -> DataFrame:
    base = changes.live_rows(user_base(t))
    for batch in user_batches(t):
        base = deltalog.precombine_upsert(stored(base, "user-table"), changes.live_rows(batch), ["user_id"],
                                          ["ts", "event_id"])
    return base


@query("mor_snapshot", f"SELECT * FROM events QUALIFY {LATEST_SQL}")
def mor_snapshot(t: Tables) -> DataFrame:
    _, base, log = logged_table(t)
    return changes.live_rows(deltalog.snapshot_read(base, log, ["user_id"]))


@query("mor_read_optimized", f"""
SELECT * FROM (SELECT * FROM events WHERE ts < TIMESTAMP '{BASE_END}') QUALIFY {LATEST_SQL}""")
def mor_read_optimized(t: Tables) -> DataFrame:
    return changes.live_rows(logged_table(t)[1])


@query("mor_compacted", f"SELECT * FROM events QUALIFY {LATEST_SQL}")
def mor_compacted(t: Tables) -> DataFrame:
    table, base, _ = logged_table(t)
    version = deltalog.compact(t.spark, table, 0, base.schema, ["user_id"])
    merged = deltalog.snapshot_read(deltalog.read_base(t.spark, table, version, base.schema),
                                    deltalog.read_log(t.spark, table, base.schema), ["user_id"])
    return changes.live_rows(merged)


ERASED_SQL = f"""
SELECT * FROM (SELECT * FROM events QUALIFY {LATEST_SQL})
WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"""


def leaving_users(t: Tables) -> DataFrame:
    return t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))


@query("mor_erase", ERASED_SQL)
def mor_erase(t: Tables) -> DataFrame:
    _, base, log = logged_table(t)
    merged = deltalog.snapshot_read(base, log, ["user_id"])
    return changes.live_rows(deltalog.erased_read(merged, leaving_users(t), ["user_id"]))


@query("mor_erase_compacted", ERASED_SQL)
def mor_erase_compacted(t: Tables) -> DataFrame:
    """Erasure for good: every file left under base and log is read afterwards, and none holds an erased key."""
    table, base, _ = logged_table(t)
    deltalog.compact(t.spark, table, 0, base.schema, ["user_id"], leaving_users(t))
    left = t.spark.read.schema(base.schema).option("recursiveFileLookup", True).parquet(f"{table}/base", f"{table}/log")
    return changes.live_rows(left)


@query("incremental_pull", """
SELECT event_id, user_id, ts AS _commit_time FROM events
WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'""")
def incremental_pull(t: Tables) -> DataFrame:
    committed = t.events.select("event_id", "user_id", F.col("ts").alias("_commit_time"))
    return deltalog.pull_between(committed, datetime(2024, 1, 10), datetime(2024, 1, 20))


@query("high_water_mark_pull", """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > (
  SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2000-06-15')""")
def high_water_mark_pull(t: Tables) -> DataFrame:
    from tidemark.sources.jdbc import newer_than_mark

    loaded = t.orders.filter("o_orderdate < TIMESTAMP_NTZ '2000-06-15'")
    return newer_than_mark(t.orders, loaded, "o_orderdate").select("o_orderkey", "o_orderdate")


# Versioned table of orders: 0 = end of 2000, 1 = upserted, 2 = pending orders deleted.

COMMIT_TIMES = [datetime(2024, 1, d) for d in (1, 2, 3)]
VERSIONS_SQL = ORDERS_SQL + """,
pruned AS (SELECT * FROM merged WHERE status <> 'P')"""


def order_versions(t: Tables) -> str:
    table = work_path(t.spark, "orders")
    target = target_orders(t)
    snapshots.commit(target, table, "CREATE", timestamp=COMMIT_TIMES[0])
    v0 = snapshots.read_as_of(t.spark, table, 0)
    batch = latest_per_key(order_batch(t), ["order_id"], by_date())
    snapshots.commit(changes.upsert(v0, batch, ["order_id"], by_date()), table, "MERGE",
                     checks={"positive_amount": "order_amount > 0"}, timestamp=COMMIT_TIMES[1],
                     feed=snapshots.upsert_feed(v0, batch, ["order_id"]))
    v1 = snapshots.read_as_of(t.spark, table, 1)
    pending = F.col("status") == "P"
    snapshots.commit(changes.delete_where(v1, pending), table, "DELETE", timestamp=COMMIT_TIMES[2],
                     feed=snapshots.delete_feed(v1, pending))
    return table


@query("as_of_version", "WITH" + VERSIONS_SQL + """
SELECT 'v0' AS label, count(*) AS records FROM target UNION ALL SELECT 'v1', count(*) FROM merged
UNION ALL SELECT 'current', count(*) FROM pruned""")
def as_of_version(t: Tables) -> DataFrame:
    table = order_versions(t)
    labelled = [(label, snapshots.read_as_of(t.spark, table, v)) for label, v in
                (("v0", 0), ("v1", 1), ("current", None))]
    counts = [df.agg(F.count("*").alias("records")).select(F.lit(label).alias("label"), "records")
              for label, df in labelled]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("as_of_timestamp", "WITH" + VERSIONS_SQL + f" SELECT {AS_ROW} FROM merged")
def as_of_timestamp(t: Tables) -> DataFrame:
    return snapshots.read_as_of(t.spark, order_versions(t), timestamp=datetime(2024, 1, 2, 12))


@query("table_history", "WITH" + VERSIONS_SQL + """
SELECT CAST(0 AS BIGINT) AS version, TIMESTAMP '2024-01-01' AS timestamp, 'CREATE' AS operation, count(*) AS rows
FROM target UNION ALL SELECT 1, TIMESTAMP '2024-01-02', 'MERGE', count(*) FROM merged
UNION ALL SELECT 2, TIMESTAMP '2024-01-03', 'DELETE', count(*) FROM pruned""")
def table_history(t: Tables) -> DataFrame:
    return snapshots.history(t.spark, order_versions(t)).select("version", "timestamp", "operation", "rows")


@query("change_feed", "WITH" + VERSIONS_SQL + """,
feed AS (
  SELECT 'update_preimage' AS _change_type, 1 AS v, t.* FROM target t JOIN batch USING (order_id) UNION ALL
  SELECT 'update_postimage', 1, order_id, customer_id, status, order_date, amount FROM batch
  WHERE order_id IN (SELECT order_id FROM target) UNION ALL
  SELECT 'insert', 1, order_id, customer_id, status, order_date, amount FROM batch
  WHERE order_id NOT IN (SELECT order_id FROM target) UNION ALL
  SELECT 'delete', 2, * FROM merged WHERE status = 'P')
SELECT _change_type, """ + AS_ROW + """, CAST(v AS BIGINT) AS _commit_version,
       CASE v WHEN 1 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-03' END AS _commit_timestamp FROM feed""")
def change_feed(t: Tables) -> DataFrame:
    return snapshots.table_changes(t.spark, order_versions(t), ["order_id"], 1, 2)


@query("changed_between_versions", "WITH" + VERSIONS_SQL + f"""
SELECT {AS_ROW} FROM batch""")
def changed_between_versions(t: Tables) -> DataFrame:
    return snapshots.changed_rows(
        target_orders(t), changes.upsert(target_orders(t), order_batch(t), ["order_id"], by_date()), ["order_id"])


@query("added_column", "SELECT o_orderkey, o_totalprice, CAST(NULL AS DOUBLE) AS tip FROM orders")
def added_column(t: Tables) -> DataFrame:
    return snapshots.add_column(t.orders.select("o_orderkey", "o_totalprice"), "tip", "double")


@query("table_copy", "SELECT * FROM orders")
def table_copy(t: Tables) -> DataFrame:
    source, target = work_path(t.spark, "orders"), work_path(t.spark, "orders-copy")
    snapshots.commit(t.orders, source, "CREATE")
    return snapshots.read_as_of(t.spark, target, snapshots.copy_table(t.spark, source, target))
