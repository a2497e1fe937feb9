"""Null-safe matching by key, and a skew-safe LEAD."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def key_match(keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) if null_safe else F.col(k) == F.col(f"__key_{k}") for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def key_columns(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"__key_{k}") for k in keys])


def with_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """The rows of ``df`` whose key occurs in ``other``."""
    return df.join(key_columns(other, keys), key_match(keys, null_safe), "left_semi")


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """The rows of ``df`` whose key does not occur in ``other``.

    A small ``other`` is broadcast by Spark, which leaves ``df`` unshuffled;
    a large one gives a sort-merge join whose skewed partitions are split.
    """
    return df.join(key_columns(other, keys), key_match(keys, null_safe), "left_anti")


def join_latest(df: DataFrame, other: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Left join to ``other`` (at most one row per key), packed into the struct ``__other``."""
    packed = other.select(*[F.col(k).alias(f"__key_{k}") for k in keys],
                          F.struct(*[F.col(c) for c in other.columns]).alias("__other"))
    return df.join(packed, key_match(keys, null_safe), "left").drop(*[f"__key_{k}" for k in keys])


def next_in_key(df: DataFrame, keys: Sequence[str], order: str, bucket: Column, name: str) -> DataFrame:
    """``LEAD(order)`` within a key, without collecting a key in one task.

    ``bucket`` is a value that never decreases with ``order`` (such as the hour
    of a timestamp). Rows are windowed by (key, bucket), so a hot key is spread
    over its buckets. The first value of the key's next non-empty bucket is sent
    into each bucket as one extra row, which the last row then finds as its
    successor. Only one row per (key, bucket) is ever grouped by the key alone.
    """
    bucketed = df.withColumn("__bucket", bucket)
    heads = bucketed.groupBy(*keys, "__bucket").agg(F.min(order).alias(order))
    in_key = Window.partitionBy(*keys).orderBy("__bucket")
    guests = (
        heads.withColumn("__to", F.lag("__bucket").over(in_key))
        .withColumn("__first", F.row_number().over(in_key) == 1)
        .filter(~F.col("__first"))
        .select(*keys, F.col("__to").alias("__bucket"), order, F.lit(True).alias("__guest"))
    )
    in_bucket = Window.partitionBy(*keys, "__bucket").orderBy(order)
    return (
        bucketed.withColumn("__guest", F.lit(False))
        .unionByName(guests, allowMissingColumns=True)
        .withColumn(name, F.lead(order).over(in_bucket))
        .filter(~F.col("__guest"))
        .drop("__guest", "__bucket")
    )
