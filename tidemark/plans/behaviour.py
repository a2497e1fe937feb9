"""Funnel, retention, repeat purchase and churn tables.

All of them reduce the events or orders to one small row per user with
map-side partial aggregation before anything else happens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.money import amount, ratio, rounded_ratio, sum_cents


def funnel(events: DataFrame, steps: Sequence[str]) -> DataFrame:
    """Users who reached each step, in order.

    A user reaches a step when the first time of that step is not before the
    first time of the step ahead of it, which the user reached too.
    """
    first = events.filter(F.col("event_type").isin(list(steps))).groupBy("user_id").agg(
        *[F.min(F.when(F.col("event_type") == s, F.col("ts"))).alias(f"t{i}") for i, s in enumerate(steps)])
    reached = [F.col("t0").isNotNull()]
    for i in range(1, len(steps)):
        reached.append(F.coalesce(reached[-1] & (F.col(f"t{i}") >= F.col(f"t{i - 1}")), F.lit(False)))
    counts = first.agg(*[F.count_if(r).alias(f"n{i}") for i, r in enumerate(reached)])
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("step"), F.lit(s).alias("event_type"), F.col(f"n{i}").alias("users"),
                 F.col(f"n{max(i - 1, 0)}").alias("before"), F.col("n0").alias("first"))
        for i, s in enumerate(steps)])
    return counts.select(F.explode(rows).alias("r")).select(
        "r.step", "r.event_type", "r.users",
        ratio(F.col("r.users"), F.col("r.before")).alias("step_rate"),
        ratio(F.col("r.users"), F.col("r.first")).alias("overall_rate"))


def monthly_retention(orders: DataFrame) -> DataFrame:
    """Customers active n months after their first order month, by first month."""
    months = orders.select("customer_id", F.trunc("order_date", "month").alias("month")).distinct()
    # After the distinct a customer has at most one row per calendar month, so this window stays small.
    cohort = F.min("month").over(Window.partitionBy("customer_id"))
    return (
        months.withColumn("cohort", cohort)
        .groupBy(F.col("cohort").cast("timestamp_ntz").alias("cohort_month"),
                 F.months_between("month", "cohort").cast("int").alias("months_later"))
        .agg(F.count("*").alias("active_customers"))
    )


def repeat_purchase(orders: DataFrame) -> DataFrame:
    """One row: customers, customers with two or more orders, and their share in percent."""
    per_customer = orders.groupBy("customer_id").agg(F.count("*").alias("n"))
    counted = per_customer.agg(F.count("*").alias("customers"), F.count_if(F.col("n") >= 2).alias("repeat_customers"))
    return counted.withColumn("repeat_pct", rounded_ratio(F.col("repeat_customers"), F.col("customers"), 2, 100))


def churn_features(orders: DataFrame, run_date: str) -> DataFrame:
    """Recency in days, frequency and monetary value per customer as of ``run_date`` (exclusive)."""
    as_of = F.lit(run_date).cast("date")
    return (
        orders.filter(F.col("order_date") < as_of.cast("timestamp_ntz"))
        .groupBy("customer_id")
        .agg(
            F.datediff(as_of, F.max(F.to_date("order_date"))).alias("recency_days"),
            F.count("*").alias("frequency"),
            amount(sum_cents("order_amount")).alias("monetary"),
            F.datediff(as_of, F.min(F.to_date("order_date"))).alias("tenure_days"),
        )
    )
