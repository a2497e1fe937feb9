"""Synthetic rows for demonstrations and load tests, generated by Spark and fixed by a seed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.messages import padded

@dataclass(frozen=True)
class Vocabulary:
    """What synthetic orders are made of: values by weight, counts of keys, and shares of flawed rows."""

    status: Mapping[str, float] = field(default_factory=lambda: {"open": 1, "done": 3})
    category: Sequence[str] = ("a", "b", "c")
    channel: Sequence[str] = ("x", "y")
    region: Sequence[str] = ("north", "south")
    customers: int = 100_000
    products: int = 10_000
    no_customer: float = 0.05
    negative_price: float = 0.02
    discounted: float = 0.25


def uniform(seed: int, salt: str) -> Column:
    """A number in [0, 1) that depends only on the row id, the seed and the salt."""
    steps = 1 << 30
    return F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(steps)) / steps


def choice(values: Sequence[str], u: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.floor(u * len(values)).cast("int") + 1)


def weighted_choice(weights: Mapping[str, float], u: Column) -> Column:
    """Pick by cumulative share."""
    total, reached, result = sum(weights.values()), 0.0, None
    for value, weight in weights.items():
        reached += weight / total
        result = F.when(u < reached, value) if result is None else result.when(u < reached, value)
    return result.otherwise(list(weights)[-1])


def between(low: float, high: float, u: Column) -> Column:
    return low + u * (high - low)


def sales_orders(spark: SparkSession, n: int, seed: int = 42, start: str = "2024-01-01", days: int = 90,
                 words: Vocabulary = Vocabulary()) -> DataFrame:
    """Orders with shares of missing customers, negative prices and discounts as the vocabulary says."""
    u = lambda salt: uniform(seed, salt)
    number = lambda salt, most: F.floor(u(salt) * most)
    price = F.round(between(1.0, 500.0, u("price")), 2)
    return spark.range(n).select(
        F.concat(F.lit("o"), padded(F.col("id"), 12)).alias("order_id"),
        F.when(u("null") >= words.no_customer, F.concat(F.lit("c"), padded(number("customer", words.customers), 8)))
        .alias("customer_id"),
        F.concat(F.lit("p"), padded(number("product", words.products), 8)).alias("product_id"),
        choice(words.category, u("category")).alias("category"),
        weighted_choice(words.status, u("status")).alias("status"),
        (number("quantity", 9) + 1).cast("int").alias("quantity"),
        F.when(u("negative") < words.negative_price, -price).otherwise(price).alias("unit_price"),
        F.when(u("discounted") < words.discounted, F.round(between(0.0, 0.5, u("discount")), 2)).otherwise(0.0)
        .alias("discount_pct"),
        choice(words.channel, u("channel")).alias("channel"),
        choice(words.region, u("region")).alias("region"),
        F.timestamp_seconds(F.unix_timestamp(F.lit(start), "yyyy-MM-dd") + number("time", days * 86_400))
        .alias("order_ts"))
