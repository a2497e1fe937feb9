"""Slowly changing dimension of type 2.

The history keeps one row per change, deletes included, with ``__start_at``,
``__end_at`` and ``__is_current``. Only the keys of a change batch are rebuilt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import DELETED, SEQUENCE, change_events, newest_version
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.keyed import next_in_key, with_keys, without_keys

START, END, CURRENT = "__start_at", "__end_at", "__is_current"


def apply_scd2(history: DataFrame | None, changes: DataFrame, keys: Sequence[str], sequence_by: Sequence[str],
               bucket: Column, delete_when: Column | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """Apply changes to a history; rows may come in any order and any batch.

    ``bucket`` is an expression over ``__sequence`` that never decreases with it
    and spreads one key's rows, for example the hour of its timestamp. Of two
    changes with the same key and sequence the one with the larger row hash stays.
    """
    events = change_events(changes, sequence_by, delete_when, drop)
    columns = events.columns
    untouched = None
    if history is not None:
        untouched = without_keys(history, events, keys, null_safe=True)
        known = with_keys(history, events, keys, null_safe=True)
        events = known.withColumnRenamed(START, SEQUENCE).select(*columns).unionByName(events)
    distinct = latest_per_key(events, [*keys, SEQUENCE], newest_version(columns))
    rebuilt = next_in_key(distinct, keys, SEQUENCE, bucket, END).withColumnRenamed(SEQUENCE, START)
    rebuilt = rebuilt.withColumn(CURRENT, F.col(END).isNull() & ~F.col(DELETED))
    return rebuilt if untouched is None else untouched.unionByName(rebuilt.select(*untouched.columns))


def versions(history: DataFrame) -> DataFrame:
    """The history a reader wants: one row per version; a delete only closes the version before it."""
    return history.filter(~F.col(DELETED)).drop(DELETED)


def current_versions(history: DataFrame) -> DataFrame:
    """The current row of every key that is not deleted (equals the SCD 1 table)."""
    return history.filter(F.col(CURRENT)).drop(START, END, CURRENT, DELETED)


def as_of(history: DataFrame, sequence: Column) -> DataFrame:
    """The versions valid at a point of the sequence."""
    return versions(history).filter(
        (F.col(START) <= sequence) & (F.col(END).isNull() | (F.col(END) > sequence)))
