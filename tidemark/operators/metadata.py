"""Reports over lineage edges, audit rows, run history, columns and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import minutes_between

SOURCE, TARGET = "source_table_full_name", "target_table_full_name"


def _latest(edges: DataFrame) -> DataFrame:
    """Each edge once, with its newest time, newest first."""
    others = [c for c in edges.columns if c != "event_time"]
    return edges.groupBy(*others).agg(F.max("event_time").alias("event_time")).orderBy(
        F.col("event_time").desc(), SOURCE, TARGET)


def upstream(edges: DataFrame, pattern: str) -> DataFrame:
    """Edges into the tables whose name matches, newest first."""
    return _latest(edges.filter(F.col(TARGET).like(pattern)))


def downstream(edges: DataFrame, pattern: str) -> DataFrame:
    """Edges out of the tables whose name matches, newest first."""
    return _latest(edges.filter(F.col(SOURCE).like(pattern)))


def column_lineage(edges: DataFrame, source_pattern: str, target_pattern: str) -> DataFrame:
    """Source column to target column of edges that match on either side."""
    return edges.filter(F.col(SOURCE).like(source_pattern) | F.col(TARGET).like(target_pattern)).select(
        SOURCE, "source_column_name", TARGET, "target_column_name")


def impact(edges: DataFrame, source: str) -> DataFrame:
    """The tables fed by ``source`` and their owners, each once."""
    return edges.filter(F.col(SOURCE) == source).select(
        F.col(TARGET).alias("will_be_affected"), F.col("created_by").alias("owned_by")).distinct()


def audit(rows: DataFrame, condition: Column, limit: int, time: str = "event_time", tie_break: str = "event_id"):
    """The newest audit rows that match."""
    return rows.filter(condition).orderBy(F.col(time).desc(), F.col(tie_break).desc()).limit(limit)


def run_history(runs: DataFrame, since: Column, limit: int, tie_break: str = "run_id") -> DataFrame:
    """Runs started since a time, with whole minutes of duration, newest first."""
    return (
        runs.filter(F.col("start_time") >= since)
        .withColumn("duration_minutes", minutes_between(F.col("start_time"), F.col("end_time")))
        .orderBy(F.col("start_time").desc(), F.col(tie_break).desc())
        .limit(limit)
    )


def column_metadata(spark: SparkSession, tables: list[str]) -> DataFrame:
    """Table, column, type and comment of registered tables (one row per column)."""
    rows = [(t, c.name, c.dataType, c.description) for t in tables for c in spark.catalog.listColumns(t)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, comment string")


def tagged_columns(columns: DataFrame, tag: str = "PII") -> DataFrame:
    """Columns whose comment mentions the tag."""
    return columns.filter(F.col("comment").like(f"%{tag}%"))


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of every file below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length")


def storage_by_table(files: DataFrame, table: Column) -> DataFrame:
    """Files and bytes per table, largest first."""
    return files.groupBy(table.alias("table_name")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")).orderBy(F.col("bytes").desc(), "table_name")


def source_file_counts(df: DataFrame, file: str = "source_file", loaded: str | None = None) -> DataFrame:
    """Rows (and first load time) per source file."""
    more = [F.min(loaded).alias("first_load")] if loaded else []
    return df.groupBy(file).agg(F.count("*").alias("records"), *more)


def source_file_totals(df: DataFrame, file: str = "source_file") -> DataFrame:
    """One row: rows and distinct source files."""
    return df.agg(F.count("*").alias("records"), F.countDistinct(file).alias("source_files"))
