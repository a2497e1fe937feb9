"""Joins across sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def federated_top(sources: Sequence[DataFrame], key: str, conditions: Sequence[Column], order: Sequence[Column],
                  limit: int) -> DataFrame:
    """Inner-join several sources on a key, filter, and return the first rows.

    The filters are ordinary DataFrame filters, so each one reaches the source
    that owns its columns, be it a database or files. The final sort keeps only
    ``limit`` rows per task.
    """
    joined = reduce(lambda a, b: a.join(b, key, "inner"), sources)
    for condition in conditions:
        joined = joined.filter(condition)
    return joined.orderBy(*order).limit(limit)


def grouped_sum(source: DataFrame, condition: Column, keys: Sequence[str], amount: str, name: str) -> DataFrame:
    """Filtered, grouped sum of a (remote) table, largest first.

    Through a JDBC catalog Spark pushes the filter, the grouping and the sum to
    the database.
    """
    return source.filter(condition).groupBy(*keys).agg(F.sum(amount).alias(name)).orderBy(F.col(name).desc(), *keys)


def convert_amounts(facts: DataFrame, rates: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """Convert amounts by a rate table (one row per key); rows without a rate give NULL."""
    return facts.join(rates, key, "left").withColumn(
        name, F.round(F.col(amount) * F.col("rate"), 2).cast("decimal(18,2)")).drop("rate")


def standard_units(df: DataFrame, factors: Mapping[str, float], unit: str, amount: str, name: str) -> DataFrame:
    """Convert amounts to one unit by a fixed factor per unit name; unknown units give NULL."""
    pairs = [x for u, f in factors.items() for x in (F.lit(u), F.lit(f))]
    return df.withColumn(name, F.col(amount) * F.try_element_at(F.create_map(*pairs), F.col(unit)))
