"""Policies, layout jobs, metadata reports and joins across sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import masks
from tidemark.functions.dates import to_utc
from tidemark.operators import joins, layout, metadata, policy
from tidemark.operators.dedup import latest_per_key
from tidemark.plans.tables import Tables
from tidemark.registry.core import query
from tidemark.session import work_path
from tidemark.sources import files

# Contact data is derived from the customer table: an e-mail address and a social security number per customer.
CONTACTS_SQL = """
contacts AS (
  SELECT c_custkey, replace(lower(c_name), '#', '.') || '@' || lower(c_mktsegment) || '.example' AS email,
         substr(ssn, 1, 3) || '-' || substr(ssn, 4, 2) || '-' || substr(ssn, 6, 4) AS ssn,
         c_acctbal, c_mktsegment, r_name AS region
  FROM (SELECT *, lpad(CAST((c_custkey * 7919 + 12345) % 1000000000 AS VARCHAR), 9, '0') AS ssn FROM customer)
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def contacts(t: Tables) -> DataFrame:
    digits = F.lpad(((F.col("c_custkey") * 7919 + 12345) % 1_000_000_000).cast("string"), 9, "0")
    home = t.stores().select(F.col("store_id").alias("c_nationkey"), F.col("store_region").alias("region"))
    return t.customer.join(home, "c_nationkey").select(
        "c_custkey",
        F.concat(F.regexp_replace(F.lower("c_name"), "#", "."), F.lit("@"), F.lower("c_mktsegment"),
                 F.lit(".example")).alias("email"),
        F.concat_ws("-", F.substring(digits, 1, 3), F.substring(digits, 4, 2), F.substring(digits, 6, 4)).alias("ssn"),
        "c_acctbal", "c_mktsegment", "region")


CONTACT_POLICY = policy.Policy(
    row_group="region",
    masks={"email": masks.mask_email, "ssn": masks.mask_ssn, "c_acctbal": masks.hide},
    row_condition="c_acctbal > -900",
)


@query("masked_customers", "WITH" + CONTACTS_SQL + """
SELECT c_custkey, left(email, 2) || '***@***' AS email, '***-**-' || right(ssn, 4) AS ssn,
       CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment, region FROM contacts""")
def masked_customers(t: Tables) -> DataFrame:
    return policy.apply_policy(contacts(t), policy.Policy(masks=CONTACT_POLICY.masks), ["support"])


@query("masked_email_domains", "WITH" + CONTACTS_SQL + """
SELECT c_custkey, left(email, 2) || '***@' || split_part(email, '@', 2) AS email FROM contacts""")
def masked_email_domains(t: Tables) -> DataFrame:
    return contacts(t).select("c_custkey", masks.mask_email_keep_domain(F.col("email")).alias("email"))


@query("row_filtered_customers", "WITH" + CONTACTS_SQL + """
SELECT c_custkey, email, region FROM contacts WHERE lower(region) IN ('asia', 'europe')""")
def row_filtered_customers(t: Tables) -> DataFrame:
    return policy.visible_rows(contacts(t), "region", ["asia", "europe"]).select("c_custkey", "email", "region")


@query("policy_read", "WITH" + CONTACTS_SQL + """
SELECT c_custkey, left(email, 2) || '***@***' AS email, '***-**-' || right(ssn, 4) AS ssn,
       CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment, region
FROM contacts WHERE c_acctbal > -900 AND lower(region) = 'america'""")
def policy_read(t: Tables) -> DataFrame:
    return policy.apply_policy(contacts(t), CONTACT_POLICY, ["america"])


@query("admin_read", "WITH" + CONTACTS_SQL + " SELECT * FROM contacts WHERE c_acctbal > -900")
def admin_read(t: Tables) -> DataFrame:
    return policy.apply_policy(contacts(t), CONTACT_POLICY, ["admin"])


@query("sql_masked_customers", "WITH" + CONTACTS_SQL + """
SELECT c_custkey, left(email, 2) || '***@***' AS email, '***-**-' || right(ssn, 4) AS ssn,
       CAST(NULL AS DOUBLE) AS balance FROM contacts WHERE lower(region) IN ('africa', 'asia')""")
def sql_masked_customers(t: Tables) -> DataFrame:
    masks.register_sql_functions(t.spark)
    masks.set_groups(t.spark, ["africa", "asia"])
    contacts(t).createOrReplaceTempView("contacts")
    return t.spark.sql("""
        SELECT c_custkey, mask_email(email) AS email, mask_ssn(ssn) AS ssn,
               hide_amount(c_acctbal, in_group('admin', user_groups)) AS balance
        FROM contacts WHERE in_group('admin', user_groups) OR in_group(region, user_groups)""")


# Layout.


@query("zorder_skip_report", """
SELECT count(*) AS covered_rows, count(*) FILTER (WHERE l_shipdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-03-01')
       AS matching_rows, CAST(0 AS BIGINT) AS matching_rows_in_skipped_files, true AS some_files_skipped FROM lineitem""")
def zorder_skip_report(t: Tables) -> DataFrame:
    """What the file ranges of a clustered table let a date filter skip, held against the rows themselves."""
    path = work_path(t.spark, "zorder")
    layout.zorder(t.lineitem, ["l_partkey", "l_shipdate"], files=32).write.parquet(path)
    written = t.spark.read.schema(t.lineitem.schema).parquet(path)
    ranges = layout.file_ranges(written, ["l_partkey", "l_shipdate"])
    low, high = F.lit("1998-01-01").cast("timestamp_ntz"), F.lit("1998-03-01").cast("timestamp_ntz")
    may_match = (F.col("min_l_shipdate") <= high) & (F.col("max_l_shipdate") >= low)
    report = layout.skip_report(ranges, may_match)
    per_file = written.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count("*").alias("n"), F.count_if(F.col("l_shipdate").between(low, high)).alias("hits"))
    checked = per_file.join(ranges.select("file_path", may_match.alias("read")), "file_path").agg(
        F.sum("n").alias("covered_rows"), F.sum("hits").alias("matching_rows"),
        F.sum(F.when(~F.col("read"), F.col("hits")).otherwise(0)).alias("matching_rows_in_skipped_files"))
    skipped = report.select((F.col("files_read") < F.col("files")).alias("some_files_skipped"))
    return checked.join(skipped, F.lit(True))


@query("zorder_rows", "SELECT * FROM lineitem")
def zorder_rows(t: Tables) -> DataFrame:
    return layout.zorder(t.lineitem, ["l_partkey", "l_shipdate"], files=16)


@query("compacted_orders", "SELECT * FROM orders")
def compacted_orders(t: Tables) -> DataFrame:
    source, target = work_path(t.spark, "small-files"), work_path(t.spark, "compacted")
    t.orders.repartition(16).write.parquet(source)
    layout.compact(t.spark, source, target)
    return t.spark.read.schema(t.orders.schema).parquet(target)


RANGE_SQL = """
SELECT event_id, ts, user_id, value FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-21 12:00:00'"""
RANGE = ("2024-01-05", "2024-01-21 12:00:00")
EVENT_COLUMNS = ["event_id", "ts", "user_id", "value"]


@query("hidden_day_partition", RANGE_SQL)
def hidden_day_partition(t: Tables) -> DataFrame:
    path = work_path(t.spark, "by-day")
    layout.write_by_day(t.events.select(*EVENT_COLUMNS), path, "ts")
    return layout.between(t.spark.read.parquet(path), "ts", *RANGE)


@query("mixed_partition_layout", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-15' AND TIMESTAMP '2001-05-09'""")
def mixed_partition_layout(t: Tables) -> DataFrame:
    old, new = work_path(t.spark, "by-month"), work_path(t.spark, "by-year-day")
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    cut = F.lit("2001-01-01").cast("timestamp_ntz")
    layout.write_by_month(orders.filter(F.col("o_orderdate") < cut), old, "o_orderdate")
    layout.write_by_day(orders.filter(F.col("o_orderdate") >= cut), new, "o_orderdate")
    return layout.between_layouts(t.spark.read.parquet(old), t.spark.read.parquet(new), "o_orderdate",
                                  "1997-03-15", "2001-05-09")


@query("partition_rewrite", """
SELECT event_id, ts, user_id, value FROM (
  SELECT * REPLACE (CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS ts) FROM events)
WHERE NOT ((event_type = 'error' AND value > 30) OR ts < TIMESTAMP '2024-01-03')
   OR (ts IS NULL AND NOT (event_type = 'error' AND value > 30))""")
def partition_rewrite(t: Tables) -> DataFrame:
    """Erase rows of some days, all rows of two days, and rows without a time."""
    path = work_path(t.spark, "rewrite")
    events = t.events.withColumn("ts", F.when(F.col("event_id") % 7 != 0, F.col("ts")))
    layout.write_by_day(events.select(*EVENT_COLUMNS, "event_type"), path, "ts")
    early = F.coalesce(F.col("ts") < F.lit("2024-01-03").cast("timestamp_ntz"), F.lit(False))
    erased = ((F.col("event_type") == "error") & (F.col("value") > 30)) | early
    touched = t.spark.read.parquet(path).filter(erased).select("_day")
    layout.rewrite_partitions(t.spark, path, "_day", touched, lambda rows: rows.filter(~erased))
    return t.spark.read.parquet(path).select(*EVENT_COLUMNS)


# Reports over lineage-like edges, audit rows and runs, derived from the tables.

EDGES_SQL = """
edges AS (
  SELECT s_name AS source_table_full_name, p_brand || '.' || p_name AS target_table_full_name,
         p_type AS created_by, max(l_shipdate) AS event_time
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)"""


def edges(t: Tables, source: Column | None = None, target: Column | None = None) -> DataFrame:
    """Supplier feeds part: who would be affected when a supplier stops.

    Conditions on either name cut the lines down before they are aggregated.
    """
    suppliers = t.supplier.select("s_suppkey", F.col("s_name").alias("source_table_full_name"))
    parts = t.part.select("p_partkey", F.concat_ws(".", "p_brand", "p_name").alias("target_table_full_name"),
                          F.col("p_type").alias("created_by"))
    lines = t.lineitem.select("l_suppkey", "l_partkey", "l_shipdate")
    if source is not None:
        suppliers = suppliers.filter(source)
        lines = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
    if target is not None:
        parts = parts.filter(target)
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    pairs = lines.groupBy("l_suppkey", "l_partkey").agg(F.max("l_shipdate").alias("event_time"))
    return pairs.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "source_table_full_name", "target_table_full_name", "created_by", "event_time")


@query("lineage_impact", "WITH" + EDGES_SQL + """
SELECT DISTINCT target_table_full_name AS will_be_affected, created_by AS owned_by FROM edges
WHERE source_table_full_name = 'Supplier#000000007'""")
def lineage_impact(t: Tables) -> DataFrame:
    name = "Supplier#000000007"
    return metadata.impact(edges(t, source=F.col(metadata.SOURCE) == name), name)


@query("lineage_downstream", "WITH" + EDGES_SQL + " SELECT * FROM edges WHERE source_table_full_name LIKE 'Supplier#%3'")
def lineage_downstream(t: Tables) -> DataFrame:
    return metadata.downstream(edges(t, source=F.col(metadata.SOURCE).like("Supplier#%3")), "Supplier#%3")


@query("lineage_upstream", "WITH" + EDGES_SQL + " SELECT * FROM edges WHERE target_table_full_name LIKE 'Brand#1%.%ring'")
def lineage_upstream(t: Tables) -> DataFrame:
    return metadata.upstream(edges(t, target=F.col(metadata.TARGET).like("Brand#1%.%ring")), "Brand#1%.%ring")


@query("audit_recent_errors", """
SELECT event_id, ts AS event_time, user_id, value FROM events
WHERE event_type = 'error' AND value > 10 ORDER BY ts DESC, event_id DESC LIMIT 50""")
def audit_recent_errors(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", F.col("ts").alias("event_time"), "user_id", "event_type", "value")
    return metadata.audit(rows, (F.col("event_type") == "error") & (F.col("value") > 10), 50).drop("event_type")


@query("run_history", """
SELECT o_orderkey AS run_id, o_orderdate AS start_time, max(l_shipdate) AS end_time,
       CAST(date_diff('minute', o_orderdate, max(l_shipdate)) AS BIGINT) AS duration_minutes
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderdate >= TIMESTAMP '2001-07-25'
GROUP BY 1, 2 ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20""")
def run_history(t: Tables) -> DataFrame:
    """An order as a run: it starts when it is placed and ends with its last shipment."""
    since = F.lit("2001-07-25").cast("timestamp_ntz")
    started = t.orders.filter(F.col("o_orderdate") >= since)
    ended = t.lineitem.join(started, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").groupBy(
        "l_orderkey").agg(F.max("l_shipdate").alias("end_time"))
    runs = started.join(ended, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("start_time"), "end_time")
    return metadata.run_history(runs, since, 20)


@query("storage_by_table")
def storage_by_table(t: Tables) -> DataFrame:
    sizes = metadata.file_sizes(t.spark, t.root)
    return metadata.storage_by_table(sizes, F.regexp_extract("path", r"([^/]+)\.parquet", 1))


# Joins across sources, conversions, distinct rows.


@query("federated_join", """
WITH ltv AS (SELECT o_custkey AS customer_id, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100
             AS lifetime_value FROM orders GROUP BY 1),
activity AS (SELECT user_id AS customer_id, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT c_custkey AS customer_id, c_name, lifetime_value, errors, c_acctbal
FROM customer JOIN ltv ON c_custkey = ltv.customer_id JOIN activity ON c_custkey = activity.customer_id
WHERE lifetime_value > 1000 AND errors > 2 ORDER BY errors DESC, c_custkey LIMIT 50""")
def federated_join(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("customer_id"), "c_name", "c_acctbal")
    value = t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("lifetime_value"))
    activity = t.events.filter("event_type = 'error'").groupBy(F.col("user_id").alias("customer_id")).agg(
        F.count("*").alias("errors"))
    return joins.federated_top(
        [customers, value, activity], "customer_id", [F.col("lifetime_value") > 1000, F.col("errors") > 2],
        [F.col("errors").desc(), F.col("customer_id")], 50)


@query("federated_group_sum", """
SELECT c_mktsegment, CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_balance
FROM customer WHERE c_acctbal > 0 GROUP BY 1""")
def federated_group_sum(t: Tables) -> DataFrame:
    remote = t.customer.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    total = joins.grouped_sum(remote, F.col("c_acctbal") > 0, ["c_mktsegment"], "c_acctbal", "total_balance")
    return total.withColumn("total_balance", F.col("total_balance").cast("double"))


# Conversion rates by region.
RATES = [("AFRICA", "1.1000"), ("AMERICA", "1.0000"), ("ASIA", "0.7500"), ("EUROPE", "1.2500")]


@query("converted_balances", """
WITH rates AS (SELECT * FROM (VALUES ('AFRICA', 110), ('AMERICA', 100), ('ASIA', 75), ('EUROPE', 125)) v(name, pct))
SELECT c_custkey, r_name AS region,
       CAST((CAST(round(c_acctbal * 100) AS BIGINT) * pct * 2 + 100) // 200 AS DOUBLE) / 100 AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN rates ON name = r_name WHERE c_acctbal > 0""")
def converted_balances(t: Tables) -> DataFrame:
    rates = files.values_table(t.spark, RATES, "region string, rate string").withColumn(
        "rate", F.col("rate").cast("decimal(6,4)"))
    home = t.stores().select(F.col("store_id").alias("c_nationkey"), F.col("store_region").alias("region"))
    balances = t.customer.filter("c_acctbal > 0").join(home, "c_nationkey").select(
        "c_custkey", "region", F.col("c_acctbal").cast("decimal(18,2)").alias("amount"))
    converted = joins.convert_amounts(balances, rates, "region", "amount", "balance")
    return converted.select("c_custkey", "region", F.col("balance").cast("double"))


@query("events_in_utc", """
SELECT event_id, ts - INTERVAL 5 HOUR - INTERVAL 30 MINUTE AS ts_utc FROM events""")
def events_in_utc(t: Tables) -> DataFrame:
    """Event times read as the wall clock of a zone without daylight saving."""
    return t.events.select("event_id", to_utc(F.col("ts"), "Asia/Kolkata").alias("ts_utc"))


@query("distinct_users_by_type", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_users_by_type(t: Tables) -> DataFrame:
    return t.events.select("user_id", "event_type").distinct()


@query("latest_order_per_customer", """
SELECT o_custkey, o_orderkey, o_orderdate FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_order_per_customer(t: Tables) -> DataFrame:
    newest = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return latest_per_key(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], newest)
