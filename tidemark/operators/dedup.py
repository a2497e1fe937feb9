"""Key-based deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Keep the first row of every key under ``order_by``, which must be a total order.

    NULL keys form one group. The rank filter lets Spark cut each map task's
    output to one row per key before the shuffle, so a key that holds a large
    share of the rows costs no more than any other.
    """
    if not order_by:
        raise ValueError("order_by must give a total order within a key")
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rank", F.row_number().over(first)).filter("__rank = 1").drop("__rank")


def newest_first(columns: Sequence[str], tie_break: Sequence[str] = ()) -> list[Column]:
    """Descending order on ``columns``, then on a hash of ``tie_break`` and the columns themselves.

    The hash decides between equal sequences with different payload in the same
    way for every input order; the columns after it settle hash collisions.
    """
    order = [F.col(c).desc_nulls_last() for c in columns]
    if tie_break:
        order.append(F.xxhash64(*tie_break).desc())
        order += [F.col(c).desc_nulls_last() for c in tie_break]
    return order


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of occurrences."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")
