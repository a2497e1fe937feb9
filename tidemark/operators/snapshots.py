"""Versioned tables on plain parquet files.

    <table>/v=<n>/...   the rows of version n
    <table>/_feed/v=<n> the row changes of version n, where the writer knew them
    <table>/_history    one row per committed version

Data is written first and the history row last; readers only see versions that
are in the history. One writer at a time. Each version is a full copy: use it
for dimensions and gold tables, and ``deltalog`` for large tables with frequent
small changes.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.dedup import duplicate_keys
from tidemark.operators.keyed import key_match, with_keys, without_keys
from tidemark.session import path_exists, stored

HISTORY = ("version bigint, timestamp timestamp_ntz, operation string, batch_id string, "
           "rows bigint, schema_json string")


APPEND = "APPEND"


class ConstraintViolation(ValueError):
    """A write broke a CHECK or NOT NULL constraint; nothing was committed."""


def history(spark: SparkSession, table: str) -> DataFrame:
    """Version, time, operation, batch id, row count and schema of every commit."""
    if not path_exists(spark, f"{table}/_history"):
        return spark.createDataFrame([], HISTORY)
    return spark.read.schema(HISTORY).parquet(f"{table}/_history")


def commit(df: DataFrame, table: str, operation: str, batch_id: str | None = None,
           checks: Mapping[str, str] | None = None, partition_by: Sequence[str] = (),
           timestamp: datetime | None = None, feed: DataFrame | None = None) -> int:
    """Write ``df`` as the next version and return its number.

    ``feed`` holds the row changes that lead to it (see ``upsert_feed`` and ``delete_feed``); they are stored with the
    version, and ``table_changes`` then compares no two versions.

    ``checks`` are CHECK predicates by name; as in SQL, NULL passes. They are
    counted by the write itself, and a violation leaves the version uncommitted.
    A ``batch_id`` that was committed before is not written again.
    """
    spark = df.sparkSession
    past = history(spark, table)
    if batch_id is not None:
        done = past.filter(F.col("batch_id") == batch_id).agg(F.max("version")).first()[0]
        if done is not None:
            return done
    last = past.agg(F.max("version")).first()[0]
    version = 0 if last is None else last + 1
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[
        F.count_if(~F.coalesce(F.expr(p), F.lit(True))).alias(f"bad_{i}")
        for i, p in enumerate((checks or {}).values())])
    writer = observed.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{table}/v={version}")
    for i, name in enumerate(checks or {}):
        if seen.get[f"bad_{i}"]:
            raise ConstraintViolation(f"{name}: {seen.get[f'bad_{i}']} rows")
    if feed is not None:
        feed.write.mode("overwrite").parquet(f"{table}/_feed/v={version}")
    at = timestamp or datetime.now(timezone.utc).replace(tzinfo=None)
    row = [(version, at, operation, batch_id, seen.get["rows"], df.schema.json())]
    spark.createDataFrame(row, HISTORY).coalesce(1).write.mode("append").parquet(f"{table}/_history")
    return version


def append(rows: DataFrame, table: str, batch_id: str | None = None, **kwargs) -> int:
    """The next version: the present one and ``rows``, which are stored as its row changes too."""
    spark = rows.sparkSession
    known = path_exists(spark, f"{table}/_history")
    after = read_as_of(spark, table).unionByName(rows, allowMissingColumns=True) if known else rows
    return commit(after, table, APPEND, batch_id, feed=rows.withColumn("_change_type", F.lit("insert")), **kwargs)


def read_as_of(spark: SparkSession, table: str, version: int | None = None,
               timestamp: datetime | None = None) -> DataFrame:
    """The table at a version, at a time (the newest commit not after it), or now."""
    commits = history(spark, table)
    if version is not None:
        commits = commits.filter(F.col("version") == version)
    if timestamp is not None:
        commits = commits.filter(F.col("timestamp") <= F.lit(timestamp).cast("timestamp_ntz"))
    found = commits.orderBy(F.col("version").desc()).first()
    if found is None:
        raise LookupError(f"{table} has no version {version if version is not None else timestamp or ''}")
    return _read(spark, table, found)


def _read(spark: SparkSession, table: str, commit_row) -> DataFrame:
    """The rows of a commit under the schema it was written with, so no footer is read for it."""
    schema = StructType.fromJson(json.loads(commit_row.schema_json))
    return spark.read.schema(schema).parquet(f"{table}/v={commit_row.version}")


def _digest(rows: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two row hashes; NULLs count as values of their own."""
    values = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(F.lit(seed), *values).alias(f"__h{seed}") for seed in (0, 1)]


def differing_keys(before: DataFrame, after: DataFrame, keys: Sequence[str], ranges: int = 4096) -> DataFrame:
    """The keys whose rows differ between two states, written; a key that one state repeats there is refused.

    First digests of ``ranges`` ranges of key hashes are compared: one row per range is shuffled. Then, in the ranges that
    differ, row hashes of 128 bits by key. Whole rows are read, but never moved.
    """
    columns = list(dict.fromkeys([*after.columns, *before.columns]))
    rows = before.withColumn("__side", F.lit(-1)).unionByName(after.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    hashed = rows.select(*keys, "__side", F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int").alias("__range"),
                         *_digest(rows, columns))
    balance = [F.sum(F.col(h).cast("decimal(38,0)") * F.col("__side")) for h in ("__h0", "__h1")]
    sums = hashed.groupBy("__range").agg(F.sum("__side").alias("n"), *[b.alias(f"b{i}") for i, b in enumerate(balance)])
    differ = [r[0] for r in sums.filter("n <> 0 OR b0 <> 0 OR b1 <> 0").select("__range").collect()]  # at most ``ranges``
    if len(differ) < ranges:
        hashed = hashed.filter(F.col("__range").isin(differ))
    sides = {side: F.col("__side") == side for side in (-1, 1)}
    found = hashed.groupBy(*keys).agg(
        *[F.count_if(is_side).alias(f"__n{side}") for side, is_side in sides.items()],
        *[F.max(F.when(is_side, F.struct("__h0", "__h1"))).alias(f"__r{side}") for side, is_side in sides.items()])
    changed = stored(found.filter(~F.col("__r-1").eqNullSafe(F.col("__r1")) | (F.col("__n-1") > 1) | (F.col("__n1") > 1)), "changed")
    repeated = changed.filter((F.col("__n-1") > 1) | (F.col("__n1") > 1)).select(*keys).first()
    if repeated is not None:
        raise ValueError(f"duplicate key {tuple(repeated)}")
    return changed.select(*keys)


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str], version: int,
                timestamp: datetime) -> DataFrame:
    """Row changes between two states with unique keys; a key repeated among the differences is refused.

    Digests and row hashes tell which keys differ; only their rows are joined. A writer that knows its changes stores them
    with ``commit``.
    ``_change_type`` is insert, delete, update_preimage or update_postimage.
    NULLs compare equal to NULLs. Columns that only one side has read as NULL on
    the other.
    """
    changed = differing_keys(before, after, keys)
    before, after = (with_keys(side, changed, keys, null_safe=True) for side in (before, after))
    columns = list(dict.fromkeys([*after.columns, *before.columns]))
    types = {f.name: f.dataType for df in (before, after) for f in df.schema.fields}

    def packed(df: DataFrame, name: str):
        return F.struct(*[F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c)
                          for c in columns]).alias(name)

    old = before.select(*keys, packed(before, "__old"))
    new = after.select(*[F.col(k).alias(f"__key_{k}") for k in keys], packed(after, "__new"))
    both = old.join(new, key_match(keys, null_safe=True), "full_outer").filter(
        ~F.col("__old").eqNullSafe(F.col("__new")))

    def entry(kind: str, side: str):
        return F.struct(F.lit(kind).alias("_change_type"), *[F.col(f"{side}.{c}").alias(c) for c in columns])

    entries = (
        F.when(F.col("__old").isNull(), F.array(entry("insert", "__new")))
        .when(F.col("__new").isNull(), F.array(entry("delete", "__old")))
        .otherwise(F.array(entry("update_preimage", "__old"), entry("update_postimage", "__new")))
    )
    return _stamped(both.select(F.inline(entries)), version, timestamp)


def _stamped(feed: DataFrame, version: int, timestamp: datetime) -> DataFrame:
    return feed.withColumns({
        "_commit_version": F.lit(version).cast("bigint"),
        "_commit_timestamp": F.lit(timestamp).cast("timestamp_ntz")})


def upsert_feed(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changes of an upsert of ``batch`` (one row per key, columns of the target) into ``target`` (unique keys).

    Only keys of the batch are looked at; a batch row that equals its target row is no change.
    """
    require_unique(batch, keys)
    new = batch.select(*[F.col(k).alias(f"__key_{k}") for k in keys], F.struct(*target.columns).alias("__new"))
    old = target.select(*keys, F.struct(*target.columns).alias("__old"))
    met = old.join(new, key_match(keys, null_safe=False)).filter(~F.col("__old").eqNullSafe(F.col("__new"))).select(
        F.inline(F.array(*[F.struct(F.lit(kind).alias("_change_type"), *[F.col(f"{side}.{c}").alias(c) for c in target.columns])
                           for kind, side in (("update_preimage", "__old"), ("update_postimage", "__new"))])))
    known = with_keys(target.select(*keys), batch, keys)
    inserted = without_keys(batch.select(*target.columns), known, keys)
    return met.unionByName(inserted.select(F.lit("insert").alias("_change_type"), *target.columns))


def delete_feed(target: DataFrame, condition: Column) -> DataFrame:
    """The changes of a DELETE WHERE."""
    return target.filter(condition).select(F.lit("delete").alias("_change_type"), *target.columns)


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key occurs twice."""
    found = duplicate_keys(df, keys).limit(1).first()
    if found is not None:
        raise ValueError(f"duplicate key {tuple(found[k] for k in keys)}")


def table_changes(spark: SparkSession, table: str, keys: Sequence[str], start: int, end: int | None = None) -> DataFrame:
    """The change feed of the commits from ``start`` to ``end`` (inclusive)."""
    commits = history(spark, table).filter(F.col("version") >= start - 1)
    if end is not None:
        commits = commits.filter(F.col("version") <= end)
    feed = before = None
    for row in commits.orderBy("version").collect():  # one row per commit
        after = _read(spark, table, row)
        if row.version >= start:
            if path_exists(spark, f"{table}/_feed/v={row.version}"):
                one = _stamped(spark.read.parquet(f"{table}/_feed/v={row.version}"), row.version, row.timestamp)
            else:
                one = change_feed(after.limit(0) if before is None else before, after, keys, row.version, row.timestamp)
            feed = one if feed is None else feed.unionByName(one, allowMissingColumns=True)
        before = after
    if feed is None:
        raise LookupError(f"{table} has no version {start}")
    return feed


def changed_rows(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incremental read: the rows of ``after`` that are new or differ from ``before``."""
    feed = change_feed(before, after, keys, 0, datetime(1970, 1, 1))
    return feed.filter(F.col("_change_type").isin("insert", "update_postimage")).select(*after.columns)


def apply_change_feed(before: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replay the feed of one commit: ``before`` plus the feed gives ``after``."""
    new = feed.filter(F.col("_change_type").isin("insert", "update_postimage")).select(*before.columns)
    return without_keys(before, feed, keys, null_safe=True).unionByName(new)


def add_column(df: DataFrame, name: str, data_type: str) -> DataFrame:
    """Add a column that is NULL in the existing rows."""
    return df.withColumn(name, F.lit(None).cast(data_type))


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: row count and an order-free content hash."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).alias("content_hash"))


def copy_table(spark: SparkSession, source: str, target: str) -> int:
    """Deep copy of the current version; raises when the copy differs."""
    rows = read_as_of(spark, source)
    version = commit(rows, target, f"CLONE {source}")
    copied = read_as_of(spark, target, version)
    if fingerprint(rows).first() != fingerprint(copied).first():
        raise RuntimeError(f"copy of {source} differs")
    return version
