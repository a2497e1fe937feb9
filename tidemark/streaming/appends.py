"""Following a versioned table by its history: new rows of append commits arrive once, rewrites are passed over.

    <target>/version=<n>/...   the rows that commit n appended
    <checkpoint>/...           one row per commit looked at: version, operation, rows

A rewrite (update, delete, overwrite) brings no new rows, so what it changed is not sent again; what an append added before
it stays as it was sent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import snapshots
from tidemark.session import path_exists

OFFSETS = "version bigint, operation string, rows bigint"


def offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The commits that this checkpoint has looked at; ``rows`` is NULL for those passed over."""
    if not path_exists(spark, checkpoint):
        return spark.createDataFrame([], OFFSETS)
    return spark.read.schema(OFFSETS).parquet(checkpoint)


def follow(spark: SparkSession, table: str, target: str, checkpoint: str, start: int | None = None,
           kinds: tuple[str, ...] = (snapshots.APPEND,)) -> int:
    """Bring the rows of all commits since the last call to ``target``; returns the number of commits sent.

    ``start`` is the first version of a new checkpoint (default: all). A commit is written to a folder of its own before
    its offset: a call that was cut off writes the same folder again, so rows arrive exactly once. Append commits must
    have stored their rows (``snapshots.append``); one without them is refused, as its new rows can't be told apart.
    """
    last = offsets(spark, checkpoint).agg(F.max("version")).first()[0]
    first = last + 1 if last is not None else start or 0
    commits = snapshots.history(spark, table).filter(F.col("version") >= first).orderBy("version").collect()  # one row each
    sent = 0
    for commit in commits:
        rows = None
        if commit.operation in kinds:
            feed = f"{table}/_feed/v={commit.version}"
            if not path_exists(spark, feed):
                raise ValueError(f"commit {commit.version} of {table} did not store its rows")
            new = spark.read.parquet(feed).filter(F.col("_change_type") == "insert").drop("_change_type")
            new.write.mode("overwrite").parquet(f"{target}/version={commit.version}")
            rows = spark.read.schema(new.schema).parquet(f"{target}/version={commit.version}").count()
            sent += 1
        spark.createDataFrame([(commit.version, commit.operation, rows)], OFFSETS).coalesce(1).write.mode("append").parquet(
            checkpoint)
    return sent
