"""Fact tables and reports over order headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.money import amount, cents, mean_cents, ratio, rounded_ratio, sum_cents

_CALENDAR_COLUMNS = ["year", "quarter", "month", "month_name", "week_of_year", "day_name", "is_weekend",
                     "is_weekday", "is_us_holiday", "holiday_name"]


def fact_orders(orders: DataFrame, stores: DataFrame, calendar: DataFrame, how: str = "inner") -> DataFrame:
    """Orders with store and calendar attributes; ``how`` is inner or left."""
    day = calendar.select("calendar_date", *[F.col(c).alias(f"order_{c}") for c in _CALENDAR_COLUMNS])
    return (
        orders.join(stores, "store_id", how)
        .join(day, F.to_date("order_date") == F.col("calendar_date"), how)
        .drop("calendar_date")
    )


def regional_slice(fact: DataFrame, region: str) -> DataFrame:
    """The rows of one region."""
    return fact.filter(F.col("store_region") == region)


def daily_report(orders: DataFrame, first_day: str, run_date: str) -> DataFrame:
    """Per day and store, for days in [first_day, run_date)."""
    in_range = orders.filter(
        (F.col("order_date") >= F.to_timestamp_ntz(F.lit(first_day)))
        & (F.col("order_date") < F.to_timestamp_ntz(F.lit(run_date))))
    per_customer = in_range.groupBy("order_date", "store_id", "store_name", "customer_id").agg(
        F.count("order_id").alias("n"),
        sum_cents("order_amount").alias("gross"),
        sum_cents("discount_amount").alias("discounts"),
        F.min("order_amount").alias("low"),
        F.max("order_amount").alias("high"),
    )
    # order_id is unique in the order headers, so its count is its distinct count.
    return per_customer.groupBy("order_date", "store_id", "store_name").agg(
        F.sum("n").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        amount(F.sum("gross")).alias("gross_revenue"),
        amount(F.sum("discounts")).alias("total_discounts"),
        amount(F.sum("gross") - F.sum("discounts")).alias("net_revenue"),
        ratio(amount(F.sum("gross")), F.sum("n")).alias("avg_order_value"),
        F.min("low").alias("min_order_value"),
        F.max("high").alias("max_order_value"),
    )


def daily_report_totals(report: DataFrame) -> DataFrame:
    """The report rolled up to days; ``sum_unique_customers`` adds up per-store distinct counts."""
    return report.groupBy("order_date").agg(
        F.count("store_id").alias("stores_with_orders"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("unique_customers").alias("sum_unique_customers"),
        amount(sum_cents("net_revenue")).alias("total_net_revenue"),
        rounded_ratio(F.sum(F.col("avg_order_value").cast("decimal(18,6)")), F.count("avg_order_value"))
        .alias("avg_of_avg_order_value"),
    )


def completed_revenue(orders: DataFrame, status: str) -> DataFrame:
    """Daily revenue per store of the orders in one status."""
    per_customer = orders.filter(F.col("status") == status).groupBy(
        "order_date", "store_name", "customer_id").agg(
        F.count("*").alias("n"), sum_cents("order_amount").alias("gross"),
        sum_cents("discount_amount").alias("discounts"))
    return per_customer.groupBy("order_date", "store_name").agg(
        F.sum("n").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        amount(F.sum("gross")).alias("gross_revenue"),
        amount(F.sum("discounts")).alias("total_discounts"),
        amount(F.sum("gross") - F.sum("discounts")).alias("net_revenue"),
        mean_cents(F.sum("gross"), F.sum("n")).alias("avg_order_value"),
    )


def completed_totals(revenue: DataFrame) -> DataFrame:
    """One row over the whole revenue table (sum of distinct counts, average of averages)."""
    average = cents("avg_order_value")
    return revenue.agg(
        F.sum("total_orders").alias("total_completed_orders"),
        F.sum("unique_customers").alias("sum_unique_customers"),
        amount(sum_cents("net_revenue")).alias("total_net_revenue"),
        mean_cents(F.sum(average), F.count(average)).alias("avg_of_avg_order_value"),
    )


def status_summary(orders: DataFrame) -> DataFrame:
    """Orders and value per status."""
    return orders.groupBy("status").agg(
        F.count("*").alias("order_count"), amount(sum_cents("order_amount")).alias("total_value"))


def with_share(summary: DataFrame, count: str, name: str = "pct_of_total", digits: int = 1) -> DataFrame:
    """Add the share of the total. For aggregated rows only: the window has one partition."""
    total = F.sum(count).over(Window.partitionBy())
    return summary.withColumn(name, rounded_ratio(F.col(count), total, digits, scale=100))


def threshold_alert(orders: DataFrame, bad: Column, limit_pct: float) -> DataFrame:
    """One row: rows, bad rows, bad rate in percent, and WARNING when the rate is above the limit."""
    counted = orders.agg(F.count("*").alias("total_orders"), F.count_if(bad).alias("flagged_orders"))
    pct = rounded_ratio(F.col("flagged_orders"), F.col("total_orders"), 1, scale=100)
    return counted.withColumn("rate_pct", F.coalesce(pct, F.lit(0.0))).withColumn(
        "alert", F.when(F.col("rate_pct") > limit_pct, "WARNING").otherwise("OK"))


def region_month(fact: DataFrame) -> DataFrame:
    """Orders, customers and revenue per region, month name and quarter, with first and last date."""
    grain = ("store_region", "order_month_name", "order_quarter")
    per_customer = fact.groupBy(*grain, "customer_id").agg(
        F.count("order_id").alias("n"), sum_cents("order_amount").alias("revenue"),
        F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"))
    return per_customer.groupBy(*grain).agg(
        F.sum("n").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        amount(F.sum("revenue")).alias("total_revenue"),
        ratio(amount(F.sum("revenue")), F.sum("n")).alias("avg_order_value"),
        F.min("first_date").alias("first_order_date"),
        F.max("last_date").alias("last_order_date"),
    )


def customer_lifetime_value(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders and lifetime value per customer; facts are reduced before the join."""
    per_customer = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"), amount(sum_cents("order_amount")).alias("lifetime_value"))
    return per_customer.join(customers.select("customer_id", "customer_name"), "customer_id")


def weekly_region_revenue(orders: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue per ISO week and region; reduced to stores before the join."""
    per_store = orders.groupBy(F.date_trunc("week", "order_date").cast("timestamp_ntz").alias("week"),
                               "store_id").agg(sum_cents("order_amount").alias("revenue"), F.count("*").alias("n"))
    return per_store.join(stores, "store_id").groupBy("week", "store_region").agg(
        amount(F.sum("revenue")).alias("total_revenue"), F.sum("n").alias("total_orders"))


def category_rank(sales: DataFrame, top: int | None = None) -> DataFrame:
    """Rank of each category within its store by revenue (then by name), over aggregated rows."""
    per_category = sales.groupBy("store_name", "category").agg(sum_cents("order_amount").alias("revenue"))
    best = Window.partitionBy("store_name").orderBy(F.col("revenue").desc(), "category")
    ranked = per_category.withColumn("category_rank", F.rank().over(best))
    if top is not None:
        ranked = ranked.filter(F.col("category_rank") <= top)
    return ranked.withColumn("revenue", amount("revenue"))
