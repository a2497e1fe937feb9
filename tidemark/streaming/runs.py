"""Starting, finishing and observing streaming queries."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

PROGRESS = ("name string, id string, batch_id bigint, timestamp string, input_rows bigint, "
            "input_rows_per_second double, processed_rows_per_second double")


class BatchLog(StreamingQueryListener):
    """Every batch of the running queries and the ``kept`` last ended ones (a query itself remembers only a hundred batches)."""

    def __init__(self, kept: int = 200):
        self.kept = kept
        self.batches: dict[str, list] = {}
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event):
        self.batches.setdefault(str(event.runId), [])
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event):
        self.batches.setdefault(str(event.progress.runId), []).append(_row(event.progress))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.setdefault(str(event.runId), threading.Event()).set()
        for run in [run for run, ended in self.ended.items() if ended.is_set()][:-self.kept]:  # the oldest ended ones
            del self.ended[run]
            self.batches.pop(run, None)

    def of(self, query: StreamingQuery) -> list:
        """The batches of a query so far; of an ended one all, as events come in order."""
        run = str(query.runId)
        if not query.isActive and run in self.ended and not self.ended[run].wait(60):
            raise TimeoutError(f"no end of query {query.name or query.id} was reported")
        found = {batch[0]: batch for batch in self.batches.get(run, [])}
        if query.isActive:  # what it remembers may not have been reported yet
            found = {p.batchId: _row(p) for p in query.recentProgress} | found
        return [found[i] for i in sorted(found)]


def _row(p) -> tuple:
    return p.batchId, p.timestamp, p.numInputRows, float(p.inputRowsPerSecond or 0), float(p.processedRowsPerSecond or 0)


_logs: dict[int, tuple[SparkSession, BatchLog]] = {}


def batch_log(spark: SparkSession) -> BatchLog:
    """The log of a session; queries are logged from the first call on."""
    if id(spark) not in _logs or _logs[id(spark)][0] is not spark:
        log = BatchLog()
        spark.streams.addListener(log)
        _logs[id(spark)] = spark, log
    return _logs[id(spark)][1]


def with_trigger(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``available_now``, ``once``, an interval such as ``10 seconds``, or None for back-to-back batches."""
    if trigger is None:
        return writer
    if trigger in ("available_now", "once"):
        # ``once`` ignores rate limits and is deprecated; the replacement honours them.
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start(df: DataFrame, checkpoint: str, fmt: str = "parquet", path: str | None = None, mode: str = "append",
          name: str | None = None, trigger: str | None = "available_now", partition_by: tuple[str, ...] = (),
          **options) -> StreamingQuery:
    """Start a query into any built-in sink: parquet, json, csv, kafka, console, memory."""
    batch_log(df.sparkSession)
    writer = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint).options(**options)
    if name:
        writer = writer.queryName(name)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return with_trigger(writer, trigger).start()


def run_available(df: DataFrame, path: str, checkpoint: str, name: str | None = None, **kwargs) -> StreamingQuery:
    """Process everything that is available now into an append-only table, and wait for the end."""
    query = start(df, checkpoint, path=path, name=name, **kwargs)
    query.awaitTermination()
    return query


def progress(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """One row per batch of queries begun with ``start``: rows in, and rows per second in and processed."""
    rows = [(q.name, str(q.id), *batch) for q in queries for batch in batch_log(spark).of(q)]
    return spark.createDataFrame(rows, PROGRESS)


def active(spark: SparkSession) -> DataFrame:
    """Name, id, state and message of the running queries."""
    rows = [(q.name, str(q.id), q.isActive, q.status["message"]) for q in spark.streams.active]
    return spark.createDataFrame(rows, "name string, id string, is_active boolean, message string")


def stop_all(spark: SparkSession) -> int:
    """Stop every active query; returns their number."""
    running = spark.streams.active
    for query in running:
        query.stop()
    return len(running)
