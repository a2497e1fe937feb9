"""File layout: compaction, Z-order clustering, skip reports, derived partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.metadata import file_sizes
from tidemark.session import delete_folder, stored


def files_for(total_bytes: int, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Number of output files of about ``target_bytes``."""
    return max(1, -(-total_bytes // target_bytes))


def compact(spark: SparkSession, source: str, target: str, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Rewrite the many small files of ``source`` as few large ones; returns the number aimed at.

    Small files are packed into the tasks of the scan, so nothing is shuffled.
    """
    total = file_sizes(spark, source).filter(F.col("path").endswith(".parquet")).agg(F.sum("length")).first()[0]
    n = files_for(total or 0, target_bytes)
    spark.read.parquet(source).coalesce(n).write.mode("overwrite").parquet(target)
    return n


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Let adaptive execution even out the write tasks, splitting hot values and merging small ones."""
    return df.hint("rebalance", *columns)


def _as_number(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    if kind == "string":
        raise ValueError(f"{column}: rank or hash text before bucketing it")
    value = F.col(column)
    if kind in ("timestamp", "timestamp_ntz", "date"):
        value = F.unix_micros(value.cast("timestamp"))
    return value.cast("double")


def quantile_buckets(df: DataFrame, columns: Mapping[str, str], buckets: int) -> DataFrame:
    """Add the quantile bucket of each column, under the name given for it.

    Buckets follow the distribution, so skewed values do not crowd into one
    bucket as they would in equal ranges. All bounds come from one pass over the
    columns, and the driver sees only the bounds.
    """
    numbers = {c: f"__number_{i}" for i, c in enumerate(columns)}
    numbered = df.withColumns({n: _as_number(df, c) for c, n in numbers.items()})
    probabilities = [i / buckets for i in range(1, buckets)]
    quantiles = numbered.approxQuantile(list(numbers.values()), probabilities, 1 / (4 * buckets))
    splits = [[float("-inf"), *sorted(set(q)), float("inf")] for q in quantiles]
    bucketizer = Bucketizer(splitsArray=splits, inputCols=list(numbers.values()),
                            outputCols=list(columns.values()), handleInvalid="keep")
    bucketed = bucketizer.transform(numbered).drop(*numbers.values())
    return bucketed.withColumns({name: F.col(name).cast("int") for name in columns.values()})


def interleave(columns: Sequence[Column], bits: int) -> Column:
    """Interleave the low ``bits`` bits of several integer columns (Morton code)."""
    width = len(columns)
    code = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, column in enumerate(columns):
            one = F.shiftright(column, bit).bitwiseAND(F.lit(1)).cast("bigint")
            code = code.bitwiseOR(F.shiftleft(one, bit * width + i))
    return code


def curve_bits(files: int, columns: int) -> int:
    """Bits per column that give the curve at least four cells per file."""
    return max(1, -(-(4 * files - 1).bit_length() // columns))


def zorder(df: DataFrame, columns: Sequence[str], files: int, bits: int | None = None) -> DataFrame:
    """Cluster rows along a Z-order curve over ``columns`` into about ``files`` range partitions.

    The resolution of the curve follows from the number of files unless ``bits`` per column are given.
    """
    bits = bits or curve_bits(files, len(columns))
    names = [f"__z{i}" for i in range(len(columns))]
    bucketed = quantile_buckets(df, dict(zip(columns, names)), 2 ** bits - 1)
    # One code per cell, and the columns themselves to split a crowded cell.
    code = interleave([F.coalesce(F.col(n), F.lit(0)) for n in names], bits)
    return (
        bucketed.withColumn("__z", code).drop(*names)
        .repartitionByRange(files, "__z", *columns)
        .sortWithinPartitions("__z", *columns)
        .drop("__z")
    )


def file_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per file of a file-based frame: rows, and minimum and maximum of each column."""
    stats = [f(c).alias(f"{n}_{c}") for c in columns for f, n in ((F.min, "min"), (F.max, "max"))]
    return df.select("*", F.col("_metadata.file_path").alias("file_path")).groupBy("file_path").agg(
        F.count("*").alias("rows"), *stats)


def skip_report(ranges: DataFrame, may_match: Column) -> DataFrame:
    """One row: files, files that a predicate on the ranges cannot skip, and the skipped percentage."""
    return ranges.agg(F.count("*").alias("files"), F.count_if(may_match).alias("files_read")).withColumn(
        "skipped_pct", F.round((1 - F.col("files_read") / F.col("files")) * 100, 1))


# Partitions derived from a timestamp. Readers filter the timestamp; the helper
# adds the implied bounds on the partition column so that folders are pruned.


def write_by_day(df: DataFrame, path: str, timestamp: str, partition: str = "_day") -> None:
    """Write partitioned by the day of a timestamp, with large days split over several files."""
    by_day = df.withColumn(partition, F.to_date(timestamp))
    rebalanced(by_day, partition).write.mode("overwrite").partitionBy(partition).parquet(path)


def write_by_month(df: DataFrame, path: str, timestamp: str, partition: str = "_month") -> None:
    by_month = df.withColumn(partition, F.to_date(F.trunc(timestamp, "month")))
    rebalanced(by_month, partition).write.mode("overwrite").partitionBy(partition).parquet(path)


def between(df: DataFrame, timestamp: str, start: str, end: str, partition: str = "_day", unit: str = "day") -> DataFrame:
    """Rows with ``timestamp BETWEEN start AND end``, pruned to the partitions of that range."""
    low, high = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    first = F.to_date(F.trunc(low, "month")) if unit == "month" else F.to_date(low)
    last = F.to_date(F.trunc(high, "month")) if unit == "month" else F.to_date(high)
    return df.filter(F.col(partition).between(first, last) & F.col(timestamp).between(low, high)).drop(partition)


def between_layouts(old: DataFrame, new: DataFrame, timestamp: str, start: str, end: str) -> DataFrame:
    """One query over rows laid out by month (old) and by day (new); each side prunes its own partitions."""
    return between(old, timestamp, start, end, "_month", "month").unionByName(
        between(new, timestamp, start, end, "_day"))


def rewrite_partitions(spark: SparkSession, path: str, partition: str, touched: DataFrame, transform) -> None:
    """Apply ``transform`` to the partitions listed in ``touched`` and leave the others alone.

    ``touched`` has one column, the partition value (NULL is a partition too). The listed partitions are read once and
    their new rows written aside; then their folders are replaced (dynamic partition overwrite), and the folders of
    those that lost all rows are deleted.
    """
    table = spark.read.parquet(path)
    listed = stored(touched.select(F.col(touched.columns[0]).alias("__touched")).distinct(), "touched")
    rows = table.join(listed, table[partition].eqNullSafe(listed["__touched"]), "left_semi")
    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]+$", 1)
    folders = stored(table.select(F.col(partition).alias("__touched"), folder.alias("folder")).join(
        listed.withColumnRenamed("__touched", "__listed"), F.col("__touched").eqNullSafe(F.col("__listed")),
        "left_semi").distinct(), "folders")
    after = stored(transform(rows.select(*table.columns)), "rewritten")
    left = after.select(F.col(partition).alias("__left")).distinct()
    emptied = stored(folders.join(left, F.col("__touched").eqNullSafe(F.col("__left")), "left_anti").select("folder"),
                     "emptied")
    rebalanced(after, partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(partition).parquet(path)
    for row in emptied.toLocalIterator():  # file system calls only, one per emptied partition
        delete_folder(spark, row.folder)
