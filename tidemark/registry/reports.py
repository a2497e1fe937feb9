"""Reports over orders, with calendar, stores and order discounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import calendar_of
from tidemark.functions.money import amount, basis_points, cents, share_of
from tidemark.plans import behaviour, reports
from tidemark.plans.tables import Tables
from tidemark.registry.core import half_up, query

FIRST_DAY, RUN_DATE = "1995-01-01", "2002-01-01"

ORDERS_SQL = """
discounts AS (
  SELECT l_orderkey, sum(CAST((CAST(round(l_extendedprice * 100) AS BIGINT)
                               * CAST(round(l_discount * 100) AS BIGINT) * 2 + 100) // 200 AS BIGINT)) AS discount
  FROM lineitem GROUP BY 1),
store_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_orderdate AS order_date,
         CAST(round(o_totalprice * 100) AS BIGINT) AS amount, CAST(coalesce(discount, 0) AS BIGINT) AS discount,
         c_nationkey AS store_id, n_name AS store_name, r_name AS store_region, c_mktsegment AS category
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey LEFT JOIN discounts ON o_orderkey = l_orderkey),
report AS (
  SELECT order_date, store_id, store_name, count(DISTINCT order_id) AS total_orders,
         count(DISTINCT customer_id) AS unique_customers, CAST(sum(amount) AS DOUBLE) / 100 AS gross_revenue,
         CAST(sum(discount) AS DOUBLE) / 100 AS total_discounts,
         CAST(sum(amount - discount) AS DOUBLE) / 100 AS net_revenue,
         (CAST(sum(amount) AS DOUBLE) / 100) / count(*) AS avg_order_value,
         CAST(min(amount) AS DOUBLE) / 100 AS min_order_value, CAST(max(amount) AS DOUBLE) / 100 AS max_order_value
  FROM store_orders WHERE order_date >= TIMESTAMP '1995-01-01' AND order_date < TIMESTAMP '2002-01-01'
  GROUP BY 1, 2, 3),
completed AS (
  SELECT order_date, store_name, count(*) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
         CAST(sum(amount) AS DOUBLE) / 100 AS gross_revenue, CAST(sum(discount) AS DOUBLE) / 100 AS total_discounts,
         CAST(sum(amount - discount) AS DOUBLE) / 100 AS net_revenue,
         """ + half_up("sum(amount)", "count(*) * 100") + """ AS avg_order_value
  FROM store_orders WHERE status = 'F' GROUP BY 1, 2),
statuses AS (
  SELECT o_orderstatus AS status, count(*) AS order_count,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_value
  FROM orders GROUP BY 1)"""

CALENDAR_SQL = """
days AS (
  SELECT CAST(d AS DATE) AS calendar_date FROM (
    SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)),
holidays AS (
  SELECT calendar_date,
         CASE WHEN strftime(calendar_date, '%m-%d') = '01-01' THEN 'New Year''s Day'
              WHEN strftime(calendar_date, '%m-%d') = '07-04' THEN 'Independence Day'
              WHEN strftime(calendar_date, '%m-%d') = '12-25' THEN 'Christmas Day'
              WHEN month(calendar_date) = 11 AND dayofweek(calendar_date) = 4
                   AND day(calendar_date) BETWEEN 22 AND 28 THEN 'Thanksgiving' END AS holiday_name
  FROM days),
calendar AS (
  SELECT calendar_date, CAST(year(calendar_date) AS INTEGER) AS year,
         CAST(quarter(calendar_date) AS INTEGER) AS quarter, CAST(month(calendar_date) AS INTEGER) AS month,
         strftime(calendar_date, '%B') AS month_name, CAST(weekofyear(calendar_date) AS INTEGER) AS week_of_year,
         CAST(day(calendar_date) AS INTEGER) AS day_of_month,
         CAST(dayofweek(calendar_date) + 1 AS INTEGER) AS day_of_week, strftime(calendar_date, '%A') AS day_name,
         CASE WHEN dayofweek(calendar_date) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
         dayofweek(calendar_date) IN (0, 6) AS is_weekend, dayofweek(calendar_date) NOT IN (0, 6) AS is_weekday,
         holiday_name IS NOT NULL AS is_us_holiday, holiday_name
  FROM holidays)"""

FACT_COLUMNS_SQL = """
SELECT order_id, customer_id, status, order_date, CAST(amount AS DOUBLE) / 100 AS order_amount, store_id, store_name,
       store_region, year AS order_year, quarter AS order_quarter, month AS order_month,
       month_name AS order_month_name, week_of_year AS order_week_of_year, day_name AS order_day_name,
       is_weekend AS order_is_weekend, is_weekday AS order_is_weekday, is_us_holiday AS order_is_us_holiday,
       holiday_name AS order_holiday_name
FROM store_orders JOIN calendar ON CAST(order_date AS DATE) = calendar_date"""


def placed_orders(t: Tables) -> DataFrame:
    """Order headers with the store (nation) of their customer."""
    home = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("store_id"),
                             F.col("c_mktsegment").alias("category"))
    return t.order_headers().drop("priority", "customer_rating").join(home, "customer_id")


def discounted_orders(t: Tables, wanted: Column) -> DataFrame:
    """The wanted orders with store attributes and the discount summed over their lines; other lines are left out first."""
    keys = t.order_headers().filter(wanted).select("order_id")
    discount = t.raw_lines().join(keys, "order_id", "left_semi").groupBy("order_id").agg(
        F.sum(share_of(cents("list_amount"), basis_points("discount_pct"))).alias("discount_cents"))
    return (
        placed_orders(t).filter(wanted).join(discount, "order_id", "left")
        .withColumn("discount_amount", amount(F.coalesce("discount_cents", F.lit(0))))
        .join(t.stores(), "store_id")
    )


def in_report_range() -> Column:
    first, last = (F.lit(d).cast("timestamp_ntz") for d in (FIRST_DAY, RUN_DATE))
    return (F.col("order_date") >= first) & (F.col("order_date") < last)


def fact(t: Tables, how: str = "inner") -> DataFrame:
    return reports.fact_orders(placed_orders(t).drop("category"), t.stores(), calendar_of(t.orders, "o_orderdate"), how)


@query("calendar_dim", "WITH" + CALENDAR_SQL + " SELECT * FROM calendar")
def calendar_dim(t: Tables) -> DataFrame:
    return calendar_of(t.orders, "o_orderdate")


@query("fact_orders", "WITH" + ORDERS_SQL + "," + CALENDAR_SQL + FACT_COLUMNS_SQL)
def fact_orders(t: Tables) -> DataFrame:
    return fact(t)


@query("regional_slice", "WITH" + ORDERS_SQL + "," + CALENDAR_SQL + FACT_COLUMNS_SQL
       + " WHERE store_region = 'ASIA'")
def regional_slice(t: Tables) -> DataFrame:
    return reports.regional_slice(fact(t), "ASIA")


@query("region_month", "WITH" + ORDERS_SQL + "," + CALENDAR_SQL + """
SELECT store_region, month_name AS order_month_name, quarter AS order_quarter,
       count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
       CAST(sum(amount) AS DOUBLE) / 100 AS total_revenue,
       (CAST(sum(amount) AS DOUBLE) / 100) / count(*) AS avg_order_value,
       min(order_date) AS first_order_date, max(order_date) AS last_order_date
FROM store_orders LEFT JOIN calendar ON CAST(order_date AS DATE) = calendar_date GROUP BY 1, 2, 3""")
def region_month(t: Tables) -> DataFrame:
    return reports.region_month(fact(t, "left"))


@query("daily_report", "WITH" + ORDERS_SQL + " SELECT * FROM report")
def daily_report(t: Tables) -> DataFrame:
    report = reports.daily_report(discounted_orders(t, in_report_range()), FIRST_DAY, RUN_DATE)
    return report.orderBy(F.col("order_date").desc(), F.col("net_revenue").desc(), "store_id")


@query("daily_report_totals", "WITH" + ORDERS_SQL + """
SELECT order_date, count(DISTINCT store_id) AS stores_with_orders, CAST(sum(total_orders) AS BIGINT) AS total_orders,
       CAST(sum(unique_customers) AS BIGINT) AS sum_unique_customers,
       CAST(sum(CAST(round(net_revenue * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_net_revenue,
       """ + half_up("sum(CAST(round(avg_order_value * 1000000) AS BIGINT))", "count(*) * 1000000")
       + " AS avg_of_avg_order_value FROM report GROUP BY 1")
def daily_report_totals(t: Tables) -> DataFrame:
    return reports.daily_report_totals(reports.daily_report(discounted_orders(t, in_report_range()), FIRST_DAY, RUN_DATE))


@query("completed_revenue", "WITH" + ORDERS_SQL + " SELECT * FROM completed")
def completed_revenue(t: Tables) -> DataFrame:
    return reports.completed_revenue(discounted_orders(t, F.col("status") == "F"), "F")


@query("completed_totals", "WITH" + ORDERS_SQL + """
SELECT CAST(sum(total_orders) AS BIGINT) AS total_completed_orders,
       CAST(sum(unique_customers) AS BIGINT) AS sum_unique_customers,
       CAST(sum(CAST(round(net_revenue * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_net_revenue,
       """ + half_up("sum(CAST(round(avg_order_value * 100) AS BIGINT))", "count(*) * 100")
       + " AS avg_of_avg_order_value FROM completed")
def completed_totals(t: Tables) -> DataFrame:
    return reports.completed_totals(reports.completed_revenue(discounted_orders(t, F.col("status") == "F"), "F"))


@query("order_status_share", "WITH" + ORDERS_SQL + """
SELECT *, """ + half_up("order_count", "sum(order_count) OVER ()", 1, 100) + " AS pct_of_total FROM statuses")
def order_status_share(t: Tables) -> DataFrame:
    return reports.with_share(reports.status_summary(t.order_headers()), "order_count").orderBy(
        F.col("order_count").desc(), "status")


@query("pending_rate_alert", """
SELECT *, CASE WHEN rate_pct > 20 THEN 'WARNING' ELSE 'OK' END AS alert FROM (
  SELECT count(*) AS total_orders, count(*) FILTER (WHERE o_orderstatus = 'P') AS flagged_orders,
         """ + half_up("count(*) FILTER (WHERE o_orderstatus = 'P')", "count(*)", 1, 100) + " AS rate_pct FROM orders)")
def pending_rate_alert(t: Tables) -> DataFrame:
    return reports.threshold_alert(t.order_headers(), F.col("status") == "P", 20.0)


@query("customer_ltv", """
SELECT o_custkey AS customer_id, c_name AS customer_name, count(o_orderkey) AS total_orders,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS lifetime_value
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def customer_ltv(t: Tables) -> DataFrame:
    return reports.customer_lifetime_value(t.order_headers(), t.customers())


@query("top_orders", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date, o_totalprice AS order_amount
FROM orders ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey LIMIT 10""")
def top_orders(t: Tables) -> DataFrame:
    newest = t.order_headers().orderBy(F.col("order_date").desc(), F.col("order_amount").desc(), "order_id").limit(10)
    return newest.select("order_id", "customer_id", "order_date", "order_amount")


@query("orders_in_range", """
SELECT o_orderkey AS order_id, o_orderdate AS order_date, o_orderpriority AS priority FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-01-01' AND year(o_orderdate) >= 1996
  AND o_totalprice > 1000 AND o_orderstatus IN ('F', 'O') AND o_orderpriority LIKE '%-%I%'""")
def orders_in_range(t: Tables) -> DataFrame:
    return (
        t.order_headers()
        .filter(F.col("order_date").between(F.lit("1996-01-01").cast("timestamp_ntz"),
                                            F.lit("1999-01-01").cast("timestamp_ntz")))
        .filter("year(order_date) >= 1996 AND order_amount > 1000")
        .filter(F.col("status").isin("F", "O") & F.col("priority").like("%-%I%"))
        .select("order_id", "order_date", "priority")
    )


@query("weekly_region_revenue", "WITH" + ORDERS_SQL + """
SELECT CAST(date_trunc('week', order_date) AS TIMESTAMP) AS week, store_region,
       CAST(sum(amount) AS DOUBLE) / 100 AS total_revenue, count(*) AS total_orders
FROM store_orders GROUP BY 1, 2""")
def weekly_region_revenue(t: Tables) -> DataFrame:
    return reports.weekly_region_revenue(placed_orders(t), t.stores())


@query("segment_rank_by_nation", "WITH" + ORDERS_SQL + """
SELECT store_name, category, CAST(sum(amount) AS DOUBLE) / 100 AS revenue,
       CAST(rank() OVER (PARTITION BY store_name ORDER BY sum(amount) DESC, category) AS INTEGER) AS category_rank
FROM store_orders GROUP BY 1, 2""")
def segment_rank_by_nation(t: Tables) -> DataFrame:
    return reports.category_rank(placed_orders(t).join(t.stores(), "store_id"))


@query("top_segments_by_nation", "WITH" + ORDERS_SQL + """
SELECT * FROM (
  SELECT store_name, category, CAST(sum(amount) AS DOUBLE) / 100 AS revenue,
         CAST(rank() OVER (PARTITION BY store_name ORDER BY sum(amount) DESC, category) AS INTEGER) AS category_rank
  FROM store_orders GROUP BY 1, 2) WHERE category_rank <= 3""")
def top_segments_by_nation(t: Tables) -> DataFrame:
    return reports.category_rank(placed_orders(t).join(t.stores(), "store_id"), top=3)


@query("event_funnel", """
WITH f AS (
  SELECT user_id, min(ts) FILTER (WHERE event_type = 'view') AS v, min(ts) FILTER (WHERE event_type = 'click') AS c,
         min(ts) FILTER (WHERE event_type = 'purchase') AS p FROM events GROUP BY 1),
n AS (
  SELECT count(*) FILTER (WHERE v IS NOT NULL) AS a, count(*) FILTER (WHERE c >= v) AS b,
         count(*) FILTER (WHERE c >= v AND p >= c) AS d FROM f)
SELECT 1 AS step, 'view' AS event_type, a AS users, a / a AS step_rate, a / a AS overall_rate FROM n
UNION ALL SELECT 2, 'click', b, b / a, b / a FROM n
UNION ALL SELECT 3, 'purchase', d, d / b, d / a FROM n""")
def event_funnel(t: Tables) -> DataFrame:
    return behaviour.funnel(t.events, ["view", "click", "purchase"])


@query("monthly_retention", """
WITH m AS (SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate) AS mon FROM orders),
c AS (SELECT o_custkey, min(mon) AS cohort FROM m GROUP BY 1)
SELECT CAST(cohort AS TIMESTAMP) AS cohort_month, CAST(date_diff('month', cohort, mon) AS INTEGER) AS months_later,
       count(*) AS active_customers
FROM m JOIN c ON m.o_custkey = c.o_custkey GROUP BY 1, 2""")
def monthly_retention(t: Tables) -> DataFrame:
    return behaviour.monthly_retention(t.order_headers())


@query("repeat_purchase", """
SELECT *, """ + half_up("repeat_customers", "customers", 2, 100) + """ AS repeat_pct FROM (
  SELECT count(*) AS customers, count(*) FILTER (WHERE n >= 2) AS repeat_customers
  FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1))""")
def repeat_purchase(t: Tables) -> DataFrame:
    return behaviour.repeat_purchase(t.order_headers())


@query("churn_features", """
SELECT o_custkey AS customer_id,
       CAST(date_diff('day', max(o_orderdate), TIMESTAMP '2002-01-01') AS INTEGER) AS recency_days,
       count(*) AS frequency, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS monetary,
       CAST(date_diff('day', min(o_orderdate), TIMESTAMP '2002-01-01') AS INTEGER) AS tenure_days
FROM orders WHERE o_orderdate < TIMESTAMP '2002-01-01' GROUP BY 1""")
def churn_features(t: Tables) -> DataFrame:
    return behaviour.churn_features(t.order_headers(), RUN_DATE)
