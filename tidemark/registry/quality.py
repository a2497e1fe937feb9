"""Expectations, quarantine, profiles and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.dedup import duplicate_keys
from tidemark.plans import reports, silver
from tidemark.plans.tables import Tables
from tidemark.registry.core import half_up, query

CUSTOMER_RULES = {
    "known_segment": ("c_mktsegment IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY', 'AUTOMOBILE', 'FURNITURE')", "warn"),
    "positive_balance": ("c_acctbal > 0", "drop"),
    "moderate_balance": ("c_acctbal BETWEEN 0 AND 9000", "drop"),
    "has_key": ("c_custkey IS NOT NULL", "fail"),
}

_PASS_SQL = {
    "known_segment": "coalesce(c_mktsegment IN ('BUILDING','HOUSEHOLD','MACHINERY','AUTOMOBILE','FURNITURE'), false)",
    "positive_balance": "coalesce(c_acctbal > 0, false)",
    "moderate_balance": "coalesce(c_acctbal BETWEEN 0 AND 9000, false)",
    "has_key": "coalesce(c_custkey IS NOT NULL, false)",
}


def _metrics_sql() -> str:
    rows = []
    for name, (_, action) in CUSTOMER_RULES.items():
        p = _PASS_SQL[name]
        rows.append(f"SELECT 'customer' AS dataset, '{name}' AS expectation, '{action}' AS action, "
                    f"count(*) FILTER (WHERE {p}) AS passed, count(*) FILTER (WHERE NOT {p}) AS failed, "
                    + half_up(f"count(*) FILTER (WHERE {p})", "count(*)", 2, 100) + " AS passed_pct FROM customer")
    return " UNION ALL ".join(rows)


@query("expectation_metrics", _metrics_sql())
def expectation_metrics(t: Tables) -> DataFrame:
    return quality.expectation_metrics(t.customer, "customer", CUSTOMER_RULES)


@query("expected_rows", "SELECT * FROM customer WHERE c_acctbal > 0 AND c_acctbal BETWEEN 0 AND 9000")
def expected_rows(t: Tables) -> DataFrame:
    return quality.expect(t.customer, CUSTOMER_RULES)


@query("quarantined_customers", """
SELECT c_custkey, c_acctbal, concat_ws(',', CASE WHEN NOT (c_acctbal > 0) THEN 'positive_balance' END,
       CASE WHEN NOT (c_acctbal BETWEEN 0 AND 9000) THEN 'moderate_balance' END) AS failed_rules
FROM customer WHERE NOT (c_acctbal > 0) OR NOT (c_acctbal BETWEEN 0 AND 9000)""")
def quarantined_customers(t: Tables) -> DataFrame:
    return quality.quarantine(t.customer, CUSTOMER_RULES).select(
        "c_custkey", "c_acctbal", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("event_log_metrics", "SELECT dataset, expectation, passed, failed FROM (" + _metrics_sql() + ")")
def event_log_metrics(t: Tables) -> DataFrame:
    metrics = quality.expectation_metrics(t.customer, "customer", CUSTOMER_RULES)
    return quality.read_event_log(quality.event_log_row(metrics))


@query("dirty_row_report", """
SELECT c_custkey, c_name, CASE WHEN c_nationkey IS NULL THEN 'NULL nation'
       WHEN c_acctbal <= 0 THEN 'Invalid balance: ' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR)
       ELSE 'Valid' END AS data_quality_issue
FROM customer WHERE c_nationkey IS NULL OR c_acctbal <= 0 OR c_mktsegment IN ('', 'UNKNOWN')""")
def dirty_row_report(t: Tables) -> DataFrame:
    dirty = t.customer.filter(
        F.col("c_nationkey").isNull() | (F.col("c_acctbal") <= 0) | F.col("c_mktsegment").isin("", "UNKNOWN"))
    balance = F.col("c_acctbal").cast("decimal(18,2)").cast("string")
    return quality.labelled_issue(dirty, [
        (F.col("c_nationkey").isNull(), "NULL nation"),
        (F.col("c_acctbal") <= 0, F.concat(F.lit("Invalid balance: "), balance)),
    ]).select("c_custkey", "c_name", "data_quality_issue")


@query("layer_reconciliation", """
SELECT 'bronze' AS layer, count(*) AS records FROM lineitem UNION ALL
SELECT 'silver', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem
                                WHERE l_orderkey IS NOT NULL AND l_quantity > 0)""")
def layer_reconciliation(t: Tables) -> DataFrame:
    raw = t.raw_lines()
    return quality.layer_counts({"bronze": raw, "silver": silver.valid_lines(raw)})


@query("rows_dropped", """
SELECT *, rows_in - rows_out AS dropped, """ + half_up("rows_in - rows_out", "rows_in", 1, 100) + """ AS dropped_pct
FROM (SELECT count(*) AS rows_in, count(*) FILTER (WHERE c_acctbal > 0 AND c_acctbal BETWEEN 0 AND 9000) AS rows_out
      FROM customer)""")
def rows_dropped(t: Tables) -> DataFrame:
    return quality.rows_dropped(t.customer, CUSTOMER_RULES)


@query("dirty_key_absence", """
SELECT c_custkey, 'FILTERED (correct)' AS status FROM customer WHERE c_acctbal <= 0""")
def dirty_key_absence(t: Tables) -> DataFrame:
    clean = quality.expect(t.customer, CUSTOMER_RULES)
    return quality.absence_check(clean, "c_custkey", t.customer.filter("c_acctbal <= 0"))


@query("null_profile", """
SELECT count(*) AS total_records, count(*) FILTER (WHERE c_custkey IS NULL) AS null_c_custkey,
       count(*) FILTER (WHERE c_nationkey IS NULL) AS null_c_nationkey,
       count(*) FILTER (WHERE c_mktsegment IS NULL) AS null_c_mktsegment,
       count(*) FILTER (WHERE c_acctbal < 0) AS negative_balances FROM customer""")
def null_profile(t: Tables) -> DataFrame:
    return quality.null_profile(t.customer, ["c_custkey", "c_nationkey", "c_mktsegment"],
                                {"negative_balances": F.col("c_acctbal") < 0})


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def repeated_lines(t: Tables) -> DataFrame:
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("customer_ltv_assert", """
SELECT CASE WHEN count(*) > 0 AND count(*) FILTER (WHERE value < 0) = 0 THEN 'PASS' END AS check_result,
       count(*) AS rows, count(*) FILTER (WHERE value < 0) AS violations
FROM (SELECT sum(o_totalprice) AS value FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey)""")
def customer_ltv_assert(t: Tables) -> DataFrame:
    ltv = reports.customer_lifetime_value(t.order_headers(), t.customers())
    return quality.assert_rows(ltv, F.col("lifetime_value") < 0, "customer_ltv is empty", "negative lifetime value")


@query("imputed_events", """
SELECT event_id, coalesce(purchase_value, 0.0) AS purchase_value, coalesce(step, 'other') AS step FROM (
  SELECT event_id, CASE WHEN event_type = 'purchase' THEN value END AS purchase_value,
         CASE WHEN event_type IN ('view', 'click', 'purchase') THEN event_type END AS step FROM events)""")
def imputed_events(t: Tables) -> DataFrame:
    sparse = t.events.select(
        "event_id", F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase_value"),
        F.when(F.col("event_type").isin("view", "click", "purchase"), F.col("event_type")).alias("step"))
    return quality.impute(sparse, {"purchase_value": 0.0, "step": "other"})


@query("standardized_suppliers", """
SELECT s_suppkey, trim('  ' || s_name) AS s_name, upper(trim(n_name || ' ')) AS n_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey IS NOT NULL""")
def standardized_suppliers(t: Tables) -> DataFrame:
    untidy = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.concat(F.lit("  "), "s_name").alias("s_name"), F.concat(F.lower("n_name"), F.lit(" ")).alias("n_name"))
    rules = {"valid_key": ("s_suppkey IS NOT NULL", "drop")}
    return quality.expect(silver.standardize(untidy, trim=["s_name"], upper=["n_name"]), rules)
