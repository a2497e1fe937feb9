"""Silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import gold, silver
from tidemark.plans.tables import Tables
from tidemark.registry.core import cents, half_up, query

# Order statuses that count as revenue.
REVENUE_STATUSES = ["F", "O"]

FACTS_SQL = """
deduped AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
               l_returnflag) AS rn
    FROM lineitem) WHERE rn = 1),
facts AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, o_orderdate AS order_date, o_custkey AS customer_id,
         l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity, p_retailprice AS price,
         CAST(l_quantity AS BIGINT) * CAST(round(p_retailprice * 100) AS BIGINT) AS total_cents
  FROM deduped JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE l_quantity > 0 AND o_custkey IS NOT NULL),
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS city, r_name AS region, c_mktsegment AS tier
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

PRICED_SQL = """
priced AS (
  SELECT l_orderkey AS order_id, o_custkey AS customer_id, r_name AS region, p_type AS category,
         l_returnflag AS channel, CAST(l_quantity AS BIGINT) AS quantity,
         date_trunc('day', o_orderdate) AS order_date, upper(o_orderstatus) AS status,
         CAST(round(l_discount * 100) AS BIGINT) AS pct,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS gross,
         CAST((CAST(round(l_extendedprice * 100) AS BIGINT)
               * (100 - CAST(round(l_discount * 100) AS BIGINT)) * 2 + 100) // 200 AS BIGINT) AS net
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
  WHERE l_extendedprice > 0 AND l_quantity > 0 AND o_custkey IS NOT NULL),
gold AS (
  SELECT order_date, region, category, channel, count(*) AS order_count,
         count(DISTINCT customer_id) AS unique_customers, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
         sum(gross) AS gross, sum(net) AS net,
         """ + half_up("sum(net)", "count(*) * 100") + """ AS avg_order_value,
         """ + half_up("sum(pct)", "count(*)") + """ AS avg_discount_pct,
         """ + half_up("sum(gross) - sum(net)", "sum(gross)", scale=100) + """ AS discount_impact_pct
  FROM priced WHERE status IN ('F', 'O') GROUP BY 1, 2, 3, 4)"""


def sales_facts(t: Tables) -> DataFrame:
    return silver.sales_facts(t.raw_lines(), t.order_headers(), t.products())


def priced_lines(t: Tables) -> DataFrame:
    return silver.priced_lines(t.raw_lines(), t.order_headers(), t.products(), REVENUE_STATUSES)


def store_orders(t: Tables) -> DataFrame:
    """Order headers with the store (nation) of their customer."""
    placed = t.order_headers().join(
        t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("store_id")),
        "customer_id")
    return placed


@query("silver_lineitems", "WITH" + FACTS_SQL + """
SELECT order_id, line_number, order_date, f.customer_id, customer_name, city, tier, product_id,
       p_name AS product_name, p_type AS category, quantity, price, total_cents / 100.0 AS total_amount
FROM facts f JOIN customers c ON f.customer_id = c.customer_id JOIN part ON product_id = p_partkey""")
def silver_lineitems(t: Tables) -> DataFrame:
    return silver.silver_lines(t.raw_lines(), t.order_headers(), t.customers(), t.products())


@query("daily_revenue", "WITH" + FACTS_SQL + """
SELECT date_trunc('day', order_date) AS order_day, city, CAST(sum(total_cents) AS DOUBLE) / 100 AS total_revenue,
       count(order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_items_sold,
       (CAST(sum(total_cents) AS DOUBLE) / 100) / count(order_id) AS avg_order_value,
       count(DISTINCT f.customer_id) AS unique_customers
FROM facts f JOIN customers c ON f.customer_id = c.customer_id GROUP BY 1, 2""")
def daily_revenue(t: Tables) -> DataFrame:
    return gold.daily_revenue(sales_facts(t), t.customers()).orderBy("order_day", "city")


@query("customer_summary", "WITH" + FACTS_SQL + """
SELECT f.customer_id, customer_name, city, tier, count(order_id) AS total_orders,
       CAST(sum(total_cents) AS DOUBLE) / 100 AS lifetime_spend, CAST(sum(quantity) AS BIGINT) AS total_items,
       max(order_date) AS last_order_date, min(order_date) AS first_order_date,
       """ + half_up("sum(total_cents)", "count(order_id) * 100") + """ AS avg_order_value,
       count(DISTINCT product_id) AS unique_products_bought
FROM facts f JOIN customers c ON f.customer_id = c.customer_id GROUP BY 1, 2, 3, 4""")
def customer_summary(t: Tables) -> DataFrame:
    return gold.customer_summary(sales_facts(t), t.customers())


@query("product_performance", "WITH" + FACTS_SQL + """
SELECT product_id, p_name AS product_name, p_type AS category, price, count(order_id) AS times_ordered,
       CAST(sum(quantity) AS BIGINT) AS total_units_sold, CAST(sum(total_cents) AS DOUBLE) / 100 AS total_revenue,
       count(DISTINCT customer_id) AS unique_buyers,
       """ + half_up("sum(quantity)", "count(order_id)") + """ AS avg_units_per_order
FROM facts JOIN part ON product_id = p_partkey GROUP BY 1, 2, 3, 4""")
def product_performance(t: Tables) -> DataFrame:
    return gold.product_performance(sales_facts(t), t.products())


@query("discount_impact", "WITH" + PRICED_SQL + """
SELECT order_date, region, category, channel, order_count, unique_customers, total_units_sold,
       CAST(gross AS DOUBLE) / 100 AS gross_revenue, CAST(net AS DOUBLE) / 100 AS net_revenue,
       avg_order_value, avg_discount_pct, discount_impact_pct FROM gold""")
def discount_impact(t: Tables) -> DataFrame:
    return gold.discount_impact(gold.customer_day_sales(priced_lines(t), t.customers()))


@query("region_rollup", "WITH" + PRICED_SQL + """,
summed AS (
  SELECT region, CAST(sum(gross) AS DOUBLE) / 100 AS total_gross_revenue,
         CAST(sum(net) AS DOUBLE) / 100 AS total_net_revenue, CAST(sum(order_count) AS BIGINT) AS total_orders,
         CAST(sum(unique_customers) AS BIGINT) AS sum_unique_customers,
         """ + half_up(f"sum({cents('avg_order_value')})", "count(*) * 100") + """ AS avg_of_avg_order_value
  FROM gold GROUP BY 1)
SELECT s.*, e.unique_customers, e.avg_order_value FROM summed s JOIN (
  SELECT region, count(DISTINCT customer_id) AS unique_customers,
         """ + half_up("sum(net)", "count(*) * 100") + """ AS avg_order_value
  FROM priced WHERE status IN ('F', 'O') GROUP BY 1) e ON s.region = e.region""")
def region_rollup(t: Tables) -> DataFrame:
    return gold.region_rollup(gold.customer_day_sales(priced_lines(t), t.customers()))


@query("store_day_revenue", """
SELECT c_nationkey AS store_id, date_trunc('day', o_orderdate) AS order_date,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_revenue,
       count(o_orderkey) AS total_orders, avg(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS avg_rating
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def store_day_revenue(t: Tables) -> DataFrame:
    return gold.store_day_revenue(store_orders(t))
