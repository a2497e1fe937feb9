"""Keyed state in buckets: a batch of changes rewrites only the buckets that hold one of its keys.

    <path>/__bucket=<n>/...   the state rows whose key hashes to n
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.operators.layout import rebalanced
from tidemark.session import path_exists, stored

BUCKET = "__bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_state(spark: SparkSession, path: str, schema: StructType, only: Sequence[int] | None = None) -> DataFrame:
    """The state, or some of its buckets (folders that are not asked for are not read)."""
    full = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
    rows = spark.read.schema(full).parquet(path)
    return (rows if only is None else rows.filter(F.col(BUCKET).isin(list(only)))).drop(BUCKET)


def apply_batch(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], buckets: int,
                merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> list[int]:
    """Replace the buckets of the batch's keys by ``merge(state rows of these buckets, batch)``; returns their numbers.

    ``merge`` gets None before the first batch and must keep at least one row of every key (a deleted key as a mark).
    The number of buckets is fixed for a table; it bounds what the driver sees.
    """
    touched = sorted(r[0] for r in batch.select(bucket_of(keys, buckets)).distinct().collect())
    before = None
    if path_exists(spark, path):
        schema = spark.read.parquet(path).drop(BUCKET).schema
        before = read_state(spark, path, schema, touched)
    after = stored(merge(before, batch), "buckets")  # a table can't be overwritten while it is read
    rebalanced(after.withColumn(BUCKET, bucket_of(keys, buckets)), BUCKET).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
    return touched
