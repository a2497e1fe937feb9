"""Point-in-time lookup: for each fact the newest feature row of its key that was known at its time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def as_of_join(facts: DataFrame, features: DataFrame, keys: Sequence[str], at: str, known_at: str, values: Sequence[str],
               bucket: Callable[[Column], Column] = F.to_date, within: str | None = None) -> DataFrame:
    """``facts`` with the ``values`` of the newest row of ``features`` of the same key whose ``known_at`` is not after
    ``at``; NULL where there is none, or none younger than ``within`` (such as ``7 days``).

    Of features with one key and time the largest ``values``, compared in their order, wins. A NULL key is a key like
    any other; a fact without a time finds nothing, a feature without one is never found.

    Both sides are windowed by (key, time bucket; ``bucket`` never decreases with time), so a hot key is spread over its buckets. The last feature of the
    earlier buckets is sent into each bucket as one extra row; only one row per (key, bucket) is ever grouped by the key.
    """
    columns = facts.columns
    names = [f"__k{i}" for i in range(len(keys))]

    def side(df: DataFrame, time: str, *more: Column) -> DataFrame:
        return df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], bucket(F.col(time)).alias("__bucket"),
                         F.col(time).alias("__at"), *more)

    packed = F.struct(F.col(known_at).alias("at"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    fact = F.struct(*[F.col(c) for c in columns])
    left = side(facts, at, fact.alias("__fact")).withColumn("__place", F.lit(2))
    right = side(features, known_at, packed.alias("__feature")).filter("__at IS NOT NULL").withColumn("__place", F.lit(1))

    newest = right.groupBy(*names, "__bucket").agg(F.max("__feature").alias("__feature"))
    slots = newest.unionByName(left.select(*names, "__bucket").distinct(), allowMissingColumns=True).groupBy(
        *names, "__bucket").agg(F.max("__feature").alias("__feature"))
    earlier = Window.partitionBy(*names).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    guests = slots.withColumn("__feature", F.max("__feature").over(earlier)).filter("__feature IS NOT NULL").withColumn(
        "__place", F.lit(0))

    # the guest first, then by time; at one time features come before facts
    in_bucket = Window.partitionBy(*names, "__bucket").orderBy(
        F.col("__place") > 0, "__at", "__place", "__feature").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        left.unionByName(right, allowMissingColumns=True).unionByName(guests, allowMissingColumns=True)
        .withColumn("__found", F.last("__feature", ignorenulls=True).over(in_bucket))
        .filter("__place = 2")
    )
    usable = F.col("__at").isNotNull()
    if within is not None:
        usable = usable & (F.col("__found.at") >= F.col("__at") - F.expr(f"INTERVAL {within}"))
    return found.select(*[F.col(f"__fact.`{c}`").alias(c) for c in columns],
                        *[F.when(usable, F.col(f"__found.v{i}")).alias(v) for i, v in enumerate(values)])
