"""Row changes as DataFrame operators: upsert, delete, update, change application.

``target`` and ``state`` hold at most one row per key. Change batches are
usually much smaller than the target, so the joins are written with the target
on the streamed side: Spark broadcasts a small batch and does not shuffle the
target at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_per_key, newest_first
from tidemark.operators.keyed import join_latest, with_keys, without_keys

SEQUENCE, DELETED = "__sequence", "__deleted"


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Replace matched rows, insert the others; the first change per key under ``order_by`` applies.

    As in SQL, a NULL key matches nothing: such changes are inserted.
    """
    latest = latest_per_key(changes, keys, order_by)
    return without_keys(target, latest, keys).unionByName(latest.select(*target.columns))


def upsert_columns(target: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   order_by: Sequence[Column]) -> DataFrame:
    """Update only ``columns`` of matched rows; insert unmatched changes whole."""
    latest = latest_per_key(changes, keys, order_by)
    hit = F.col("__other").isNotNull()
    updated = join_latest(target, latest.select(*keys, *columns), keys).select(*[
        F.when(hit, F.col(f"__other.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in target.columns])
    # The keys that exist already, read from the key columns of the target only.
    existing = with_keys(target.select(*keys), latest, keys)
    inserted = without_keys(latest, existing, keys)
    return updated.unionByName(inserted.select(*target.columns))


def upsert_with_delete(target: DataFrame | None, changes: DataFrame, keys: Sequence[str], delete_when: Column,
                       order_by: Sequence[Column]) -> DataFrame:
    """Apply the latest change per key: delete, replace or insert. An unmatched delete does nothing.

    Without a target (the first run) the result is the table to create.
    """
    latest = latest_per_key(changes.withColumn(DELETED, F.coalesce(delete_when, F.lit(False))), keys, order_by)
    kept = latest.filter(~F.col(DELETED)).drop(DELETED)
    if target is None:
        return kept
    kept = kept.select(*target.columns)
    return without_keys(target, latest, keys).unionByName(kept)


def update_where(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE; a NULL condition leaves the row alone. All right sides see the old row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    hit = F.coalesce(condition, F.lit(False))
    return df.select(*[
        F.when(hit, assignments[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
        for c in df.columns])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE ... WHERE; a NULL condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def delete_keys(df: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the rows whose key is in a deletion list."""
    return without_keys(df, listed, keys)


def insert_select(df: DataFrame, selection: DataFrame) -> DataFrame:
    """INSERT INTO ... SELECT from the state before the insert."""
    return df.unionByName(selection)


# Ordered change application (SCD 1). The state keeps the sequence of the last
# change and the tombstones of deleted keys, so late rows cannot undo newer ones.


def change_events(changes: DataFrame, sequence_by: Sequence[str], delete_when: Column | None = None,
                  drop: Sequence[str] = ()) -> DataFrame:
    """Add the sequence struct and the delete flag to change rows, and drop operation columns."""
    deleted = F.coalesce(delete_when, F.lit(False)) if delete_when is not None else F.lit(False)
    return changes.withColumns({SEQUENCE: F.struct(*sequence_by), DELETED: deleted}).drop(*drop)


def newest_version(columns: Sequence[str]) -> list[Column]:
    """Newest sequence first; equal sequences are ordered by the hash of the row."""
    payload = [c for c in columns if c != SEQUENCE]
    return newest_first([SEQUENCE], tie_break=payload)


def _version(prefix: str, columns: Sequence[str]) -> Column:
    """A comparable value that orders versions as ``newest_version`` does."""
    payload = [c for c in columns if c != SEQUENCE]
    at = lambda c: F.col(f"{prefix}{c}")
    return F.struct(at(SEQUENCE).alias("s"), F.xxhash64(*[at(c) for c in payload]).alias("h"),
                    *[at(c).alias(f"c{i}") for i, c in enumerate(payload)])


def merge_latest(state: DataFrame | None, events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key, the newest of the state row and all event rows. The result does not depend on batch order."""
    newest = latest_per_key(events, keys, newest_version(events.columns))
    if state is None:
        return newest
    columns = state.columns
    joined = join_latest(state, newest.select(*columns), keys, null_safe=True)
    takes_new = F.col("__other").isNotNull() & (_version("__other.", columns) > _version("", columns))
    merged = joined.select(*[F.when(takes_new, F.col(f"__other.{c}")).otherwise(F.col(c)).alias(c) for c in columns])
    existing = with_keys(state.select(*keys), newest, keys, null_safe=True)
    return merged.unionByName(without_keys(newest, existing, keys, null_safe=True).select(*columns))


def apply_cdc(state: DataFrame | None, changes: DataFrame, keys: Sequence[str], sequence_by: Sequence[str],
              delete_when: Column | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """Apply a batch of changes to the state; see ``live_rows`` for the table a reader wants."""
    return merge_latest(state, change_events(changes, sequence_by, delete_when, drop), keys)


def live_rows(state: DataFrame) -> DataFrame:
    """The current table: no tombstones, no bookkeeping columns."""
    return state.filter(~F.col(DELETED)).drop(SEQUENCE, DELETED)
