"""Streaming transformations; each works on a batch DataFrame too."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Cast a zone-less time to a timestamp, which watermarks need (session zone UTC)."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def tumbling(df: DataFrame, time: str, delay: str, size: str, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Aggregates per tumbling window and key.

    In append mode a window is emitted once the watermark (largest time seen
    minus ``delay``) has passed its end; rows of windows that are closed already
    are dropped. State stays bounded by the delay.
    """
    grouped = df.withWatermark(time, delay).groupBy(F.window(time, size), *keys)
    wide = grouped.agg(*[column.alias(name) for name, column in aggregates.items()])
    return wide.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"), *keys, *aggregates)


def enrich(stream: DataFrame, static: DataFrame, key: str) -> DataFrame:
    """Stream-static inner join; the static side is read again for every micro-batch.

    No broadcast hint: Spark broadcasts the static side when its size allows and
    shuffles both sides otherwise.
    """
    return stream.join(static, key, "inner")


def deduplicate(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Drop repeated keys that arrive within ``delay`` of each other; older keys leave the state."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def sessions(df: DataFrame, time: str, gap: str, keys: Sequence[str], delay: str | None = None, **aggregates: Column) -> DataFrame:
    """Aggregates per session: rows of a key that follow each other within ``gap``, which ends a session after its last.

    A stream needs ``delay``, the time that a row may be late; a late row may still join two sessions into one. In append
    mode a session is emitted once the watermark has passed its end.
    """
    marked = df if delay is None else df.withWatermark(time, delay)
    grouped = marked.groupBy(F.session_window(time, gap), *keys)
    wide = grouped.agg(*[column.alias(name) for name, column in aggregates.items()])
    return wide.select(
        F.col("session_window.start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_window.end").cast("timestamp_ntz").alias("session_end"), *keys, *aggregates)


def join_in_time(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, before: str,
                 delay: str) -> DataFrame:
    """Rows of ``left`` with the rows of ``right`` of the same keys that came at most ``before`` earlier, or at the same time.

    Both may be streams: each side's rows stay in the state until the other's watermark (largest time less ``delay``) rules
    out a partner, so the state is bounded by the time range. Rows later than the watermark are dropped. Except for the
    keys, columns of both sides need different names.
    """
    right = right.select(*[F.col(k).alias(f"__key_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    left = left.withWatermark(left_time, delay)
    right = right.withWatermark(right_time, delay)
    match = (F.col(right_time) <= F.col(left_time)) & (F.col(right_time) >= F.col(left_time) - F.expr(f"INTERVAL {before}"))
    for key in keys:
        match = match & (F.col(key) == F.col(f"__key_{key}"))
    return left.join(right, match, "inner").drop(*[f"__key_{k}" for k in keys])
