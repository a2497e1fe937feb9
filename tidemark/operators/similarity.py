"""Exact nearest neighbours by cosine: blocks of queries against every vector.

A block of queries is multiplied with the vectors as they are scanned; a task keeps the best ``k`` of each query, so what
is shuffled is ``k`` rows per query and task, never one row per pair. Entries are taken in steps of 1 / ``scale`` (2^-20),
which makes the products whole numbers and their sums exact in any order: ties are real ties, and settled by the id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import stored

SCALE = 1 << 20
_ROWS = 1024


def whole_steps(vectors: DataFrame, id_: str, vector: str, scale: int = SCALE) -> DataFrame:
    """id and x: the vectors in whole steps. Left out are NULL vectors, NULL or non-finite entries, and vectors of length
    zero, which have no direction; ids that are NULL as well."""
    c = F.col(vector).cast("array<double>")
    fits = F.coalesce(F.forall(c, lambda e: F.coalesce(F.abs(e) <= 64, F.lit(False))), F.lit(False))
    x = F.when(fits, F.transform(c, lambda e: F.floor(F.when(F.abs(e) <= 64, e) * scale).cast("double")))
    return vectors.select(F.col(id_).cast("bigint").alias("id"), x.alias("x")).filter(
        "id IS NOT NULL AND exists(x, e -> e <> 0)")


class Best:
    """The k best (similarity, id) of each query so far."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.norms = (queries * queries).sum(axis=1)
        self.least = np.full(len(ids), -np.inf)
        self.query, self.similarity, self.found = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        similar = (self.queries @ rows.T) / np.sqrt(self.norms[:, None] * (rows * rows).sum(axis=1)[None, :])
        similar[self.ids[:, None] == ids[None, :]] = -np.inf  # a vector is not its own neighbour
        query, row = np.nonzero((similar >= self.least[:, None]) & (similar > -np.inf))
        query, found = np.concatenate([self.query, query]), np.concatenate([self.found, ids[row]])
        similarity = np.concatenate([self.similarity, similar[query[len(self.query):], row]])
        order = np.lexsort((found, -similarity, query))
        query, similarity, found = query[order], similarity[order], found[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.k
        self.query, self.similarity, self.found = query[keep], similarity[keep], found[keep]
        full = rank == self.k - 1
        self.least[query[full]] = similarity[full]


def _block(vectors: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast((ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries = shared.value
        best = Best(ids, queries, k)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                own = part.column(0).to_numpy()
                flat = part.column(1).flatten().to_numpy()
                lengths = part.column(1).value_lengths().to_numpy()
                same = lengths == queries.shape[1]  # vectors of another length can't be compared
                if same.any():
                    best.add(own[same], flat[np.repeat(same, lengths)].reshape(-1, queries.shape[1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[best.query]), pa.array(best.found), pa.array(best.similarity)], names=["query_id", "id", "similarity"])

    return vectors.mapInArrow(run, "query_id bigint, id bigint, similarity double")


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_: str, vector: str, block: int = 2048) -> DataFrame:
    """query_id, rank (1 is nearest; ties: smaller id first), id and similarity: the ``k`` vectors of largest cosine for
    each query, itself excepted. ``queries`` has the same columns as ``vectors``; repeated ids are one row, that of the
    largest vector. ``block`` queries at a time are on the driver and broadcast; each block is one scan of the vectors.
    """
    known = stored(whole_steps(vectors, id_, vector).groupBy("id").agg(F.max("x").alias("x")), "vectors")
    asked = stored(whole_steps(queries, id_, vector).groupBy("id").agg(F.max("x").alias("x")), "queries")
    # blocks of about equal size by hash, and of one length
    sizes = asked.groupBy(F.size("x").alias("length")).count().collect()
    parts = []
    for length, count in sorted((r.length, r["count"]) for r in sizes):
        blocks = -(-count // block)
        own = asked.filter(F.size("x") == length).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
        for number in range(blocks):
            rows = own.filter(F.col("block") == number).orderBy("id").select("id", "x").toArrow()
            if rows.num_rows:
                matrix = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, length)
                parts.append(_block(known, rows.column("id").to_numpy(), matrix, k))
    if not parts:
        return known.sparkSession.createDataFrame([], "query_id bigint, rank int, id bigint, similarity double")
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "id", "similarity")
