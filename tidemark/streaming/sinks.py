"""foreachBatch sinks that can be replayed: a batch id is applied once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import deltalog, snapshots
from tidemark.operators.changes import DELETED, SEQUENCE, change_events
from tidemark.session import path_exists
from tidemark.streaming.runs import with_trigger


_GENERATIONS = "query string, generation bigint"


def _run(df: DataFrame, mode: str, checkpoint: str, handler, trigger: str | None, name: str | None) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(handler)
    if name:
        writer = writer.queryName(name)
    query = with_trigger(writer, trigger).start()
    if trigger in ("available_now", "once"):
        query.awaitTermination()
    return query


def _batch_key(batch: DataFrame, batch_id: int) -> str:
    """Batch ids start again with a new query, so the query id belongs to the key."""
    return f"{batch.sparkSession.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"


def _generation(batch: DataFrame, table: str) -> int:
    """The number of this query among those that wrote the table; a query keeps its id with its checkpoint."""
    spark, path = batch.sparkSession, f"{table}/generations"
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    known = {r.query: r.generation for r in spark.read.schema(_GENERATIONS).parquet(path).collect()} if path_exists(
        spark, path) else {}
    if query not in known:
        known[query] = max(known.values(), default=-1) + 1
        spark.createDataFrame([(query, known[query])], _GENERATIONS).coalesce(1).write.mode("append").parquet(path)
    return known[query]


def complete_sink(df: DataFrame, table: str, checkpoint: str, trigger: str | None = "available_now",
                  name: str | None = None) -> StreamingQuery:
    """Complete mode into a versioned table: every batch is the whole result and becomes a version."""

    def write(batch: DataFrame, batch_id: int) -> None:
        snapshots.commit(batch, table, "COMPLETE", batch_id=_batch_key(batch, batch_id))

    return _run(df, "complete", checkpoint, write, trigger, name)


def update_sink(df: DataFrame, table: str, checkpoint: str, trigger: str | None = "available_now",
                name: str | None = None) -> StreamingQuery:
    """Update mode into a delta log: only the changed groups of a batch are written.

    Read it with ``deltalog.read_log`` and ``changes.merge_latest``. The sequence is the generation of the checkpoint
    and the batch id: a new checkpoint computes its totals afresh, and they replace those of the one before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        generation = _generation(batch, table)
        rows = batch.withColumns({SEQUENCE: F.struct(F.lit(generation).cast("bigint").alias("generation"),
                                                     F.lit(batch_id).cast("bigint").alias("batch")),
                                  DELETED: F.lit(False)})
        deltalog.append_log(rows, table, _batch_key(batch, batch_id))

    return _run(df, "update", checkpoint, write, trigger, name)


def cdc_sink(changes: DataFrame, table: str, checkpoint: str, sequence_by: Sequence[str], delete_when=None,
             drop: Sequence[str] = (), trigger: str | None = "available_now", name: str | None = None) -> StreamingQuery:
    """Change rows into a delta log.

    A batch is appended as it came, so its cost does not depend on the size of
    the table. Late and repeated changes are settled by sequence when the log is
    merged, and a replayed batch overwrites its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        deltalog.append_log(change_events(batch, sequence_by, delete_when, drop), table, _batch_key(batch, batch_id))

    return _run(changes, "append", checkpoint, write, trigger, name)
