"""Gold tables over the silver facts.

Each function aggregates on keys before it joins attributes, and replaces
COUNT(DISTINCT) by a count over a finer grouping where one exists, so the wide
attribute columns never pass through the large shuffle. Hot keys are reduced by
Spark's map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import amount, cents, mean_cents, ratio, rounded_ratio, sum_cents


def daily_revenue(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue, order lines, items, average line value and customers per day and city."""
    per_customer = facts.groupBy(F.date_trunc("day", "order_date").cast("timestamp_ntz").alias("order_day"),
                                 "customer_id").agg(
        F.sum("total_cents").alias("revenue"),
        F.count("order_id").alias("lines"),
        F.sum("quantity").alias("items"),
    )
    # One row per (day, customer) and one city per customer: counting rows counts distinct customers.
    return (
        per_customer.join(customers.select("customer_id", "city"), "customer_id")
        .groupBy("order_day", "city")
        .agg(
            amount(F.sum("revenue")).alias("total_revenue"),
            F.sum("lines").alias("total_orders"),
            F.sum("items").alias("total_items_sold"),
            ratio(amount(F.sum("revenue")), F.sum("lines")).alias("avg_order_value"),
            F.count("customer_id").alias("unique_customers"),
        )
    )


def customer_summary(facts: DataFrame, customers: DataFrame) -> DataFrame:
    """Lifetime purchases of every customer who bought something."""
    per_product = facts.groupBy("customer_id", "product_id").agg(
        F.count("order_id").alias("lines"),
        F.sum("total_cents").alias("spend"),
        F.sum("quantity").alias("items"),
        F.max("order_date").alias("last_date"),
        F.min("order_date").alias("first_date"),
    )
    per_customer = per_product.groupBy("customer_id").agg(
        F.sum("lines").alias("total_orders"),
        F.sum("spend").alias("spend"),
        F.sum("items").alias("total_items"),
        F.max("last_date").alias("last_order_date"),
        F.min("first_date").alias("first_order_date"),
        F.count("*").alias("unique_products_bought"),
    )
    return per_customer.join(customers, "customer_id").select(
        "customer_id", "customer_name", "city", "tier", "total_orders",
        amount("spend").alias("lifetime_spend"),
        "total_items", "last_order_date", "first_order_date",
        mean_cents(F.col("spend"), F.col("total_orders")).alias("avg_order_value"),
        "unique_products_bought",
    )


def product_performance(facts: DataFrame, products: DataFrame) -> DataFrame:
    """Orders, units, revenue and buyers of every product sold."""
    per_buyer = facts.groupBy("product_id", "customer_id").agg(
        F.count("order_id").alias("lines"),
        F.sum("quantity").alias("units"),
        F.sum("total_cents").alias("revenue"),
    )
    per_product = per_buyer.groupBy("product_id").agg(
        F.sum("lines").alias("times_ordered"),
        F.sum("units").alias("total_units_sold"),
        F.sum("revenue").alias("revenue"),
        F.count("customer_id").alias("unique_buyers"),
    )
    return per_product.join(products, "product_id").select(
        "product_id", "product_name", "category", "price",
        "times_ordered", "total_units_sold",
        amount("revenue").alias("total_revenue"),
        "unique_buyers",
        rounded_ratio(F.col("total_units_sold"), F.col("times_ordered")).alias("avg_units_per_order"),
    )


DISCOUNT_GRAIN = ("order_date", "region", "category", "channel")


def customer_day_sales(priced: DataFrame, customers: DataFrame) -> DataFrame:
    """Priced lines reduced to one row per day, category, channel and customer; only then the customer's region joins."""
    reduced = priced.groupBy("order_date", "category", "channel", "customer_id").agg(
        F.count("order_id").alias("lines"),
        F.sum("quantity").alias("units"),
        F.sum("gross_cents").alias("gross"),
        F.sum("net_cents").alias("net"),
        F.sum("discount_points").alias("points"),
    )
    return reduced.join(customers.select("customer_id", "region"), "customer_id")


def discount_impact(sales: DataFrame) -> DataFrame:
    """Revenue and weighted discount per day, region, category and channel, from customer-day sales."""
    gross, net, n = F.sum("gross"), F.sum("net"), F.sum("lines")
    return sales.groupBy(*DISCOUNT_GRAIN).agg(
        n.alias("order_count"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("units").alias("total_units_sold"),
        amount(gross).alias("gross_revenue"),
        amount(net).alias("net_revenue"),
        mean_cents(net, n).alias("avg_order_value"),
        rounded_ratio(F.sum("points"), n * 100).alias("avg_discount_pct"),
        rounded_ratio(gross - net, gross, scale=100).alias("discount_impact_pct"),
    )


def region_rollup(sales: DataFrame) -> DataFrame:
    """Roll customer-day sales up to regions.

    ``sum_unique_customers`` and ``avg_of_avg_order_value`` are the sum of
    distinct counts and the average of averages over the rows of
    ``discount_impact``; ``unique_customers`` and ``avg_order_value`` are the
    correct figures beside them. Both groupings come from one pass.
    """
    by_grain = [F.col(c) for c in DISCOUNT_GRAIN]
    by_customer = [F.col("region"), F.col("customer_id")]
    sets = sales.groupingSets([by_grain, by_customer], *DISCOUNT_GRAIN, "customer_id").agg(
        F.grouping("customer_id").alias("is_grain"),
        F.sum("lines").alias("lines"), F.sum("gross").alias("gross"), F.sum("net").alias("net"),
        F.count(F.lit(1)).alias("customers"),
    )
    of_grain = lambda c: F.when(F.col("is_grain") == 1, c)
    average = of_grain(cents(mean_cents(F.col("net"), F.col("lines"))))
    return sets.groupBy("region").agg(
        amount(F.sum(of_grain(F.col("gross")))).alias("total_gross_revenue"),
        amount(F.sum(of_grain(F.col("net")))).alias("total_net_revenue"),
        F.sum(of_grain(F.col("lines"))).alias("total_orders"),
        F.sum(of_grain(F.col("customers"))).alias("sum_unique_customers"),
        mean_cents(F.sum(average), F.count(average)).alias("avg_of_avg_order_value"),
        F.count_if(F.col("is_grain") == 0).alias("unique_customers"),
        mean_cents(F.sum(of_grain(F.col("net"))), F.sum(of_grain(F.col("lines")))).alias("avg_order_value"),
    )


def store_day_revenue(orders: DataFrame) -> DataFrame:
    """Revenue, orders and average rating per store and day."""
    return orders.groupBy("store_id", F.date_trunc("day", "order_date").cast("timestamp_ntz").alias("order_date")).agg(
        amount(sum_cents("order_amount")).alias("total_revenue"),
        F.count("order_id").alias("total_orders"),
        F.avg("customer_rating").alias("avg_rating"),
    )
