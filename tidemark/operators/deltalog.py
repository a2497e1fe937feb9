"""Base files plus an append-only log of changed rows (merge on read).

    <table>/base/v=<n>     one row per key
    <table>/log/batch=<id> changed rows, as they came
    <table>/merged         the batches that a base holds, by version

A batch writes its own folder, so replaying it replaces the same files. Reads
merge the log into the base; compaction writes the merged rows as a new base,
drops erased keys, and deletes the base and the batches that went into it.
At scale this is the path for frequent small changes, since no batch rewrites
the base.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.changes import DELETED, SEQUENCE, live_rows, merge_latest
from tidemark.operators.keyed import without_keys
from tidemark.session import delete_folder, path_exists, stored


def keyed_rows(df: DataFrame, precombine: Sequence[str]) -> DataFrame:
    """Rows that carry their precombine value as sequence and are not deleted."""
    return df.withColumns({SEQUENCE: F.struct(*precombine), DELETED: F.lit(False)})


def precombine_upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], precombine: Sequence[str]) -> DataFrame:
    """Keyed upsert in which the row with the newest precombine value wins."""
    return live_rows(merge_latest(keyed_rows(target, precombine), keyed_rows(batch, precombine), keys))


def snapshot_read(base: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Base and log merged: the fully current table (state columns included)."""
    return merge_latest(base, log.select(*base.columns), keys)


def pull_between(df: DataFrame, begin, end, commit_column: str = "_commit_time") -> DataFrame:
    """The rows committed in (begin, end]."""
    at = F.col(commit_column)
    return df.filter((at > F.lit(begin)) & (at <= F.lit(end)))


def erased_read(df: DataFrame, erased: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hide the rows of erased keys at read time; ``compact`` drops them for good."""
    return without_keys(df, erased, keys)


def append_log(batch: DataFrame, table: str, batch_id: int | str) -> None:
    """Write one batch of state rows to the log; a replay of the id overwrites its own folder."""
    batch.write.mode("overwrite").parquet(f"{table}/log/batch={batch_id}")


_MERGED = "version bigint, batch string"


def _merged(spark, table: str) -> DataFrame:
    """The batches that compactions took into a base."""
    if not path_exists(spark, f"{table}/merged"):
        return spark.createDataFrame([], _MERGED)
    return spark.read.schema(_MERGED).parquet(f"{table}/merged")


def _batches(spark, table: str, schema) -> DataFrame:
    """The rows of the log that no base holds yet, with their batch."""
    full = StructType([*_struct(schema).fields, StructField("batch", StringType())])
    rows = spark.read.schema(full).option("basePath", f"{table}/log").parquet(f"{table}/log")
    return rows.join(_merged(spark, table).select("batch"), "batch", "left_anti")


def _struct(schema) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def read_log(spark, table: str, schema) -> DataFrame:
    """All rows of the log that no compaction has taken into a base."""
    return _batches(spark, table, schema).drop("batch")


def compact(spark, table: str, version: int, schema, keys: Sequence[str], erased: DataFrame | None = None) -> int:
    """Merge base ``version`` and the log into the next base, without the erased keys; returns its version.

    The batches merged are those in the log when it starts. The new base is written first and its batches are recorded
    next; only then are the old base and the batches deleted, so a run that stops in between can be repeated.
    """
    taken = stored(_batches(spark, table, schema).select("batch").distinct(), "taken")
    log = _batches(spark, table, schema).join(taken, "batch", "left_semi").drop("batch")
    rows = snapshot_read(read_base(spark, table, version, schema), log, keys)
    write_base(rows if erased is None else erased_read(rows, erased, keys), table, version + 1)
    taken.select(F.lit(version + 1).cast("bigint").alias("version"), "batch").coalesce(1).write.mode("append").parquet(
        f"{table}/merged")
    for row in taken.toLocalIterator():  # file system calls only, one per batch
        delete_folder(spark, f"{table}/log/batch={row.batch}")
    delete_folder(spark, f"{table}/base/v={version}")
    return version + 1


def write_base(rows: DataFrame, table: str, version: int) -> None:
    """Write merged rows as a new base version (the last step of a compaction)."""
    rows.write.mode("overwrite").parquet(f"{table}/base/v={version}")


def read_base(spark, table: str, version: int, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{table}/base/v={version}")
