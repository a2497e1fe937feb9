"""Overlapping chunks of texts with exact offsets, and the text put together again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunks(docs: DataFrame, keep: Sequence[str], text: str = "text", size: int = 1000, overlap: int = 200) -> DataFrame:
    """One row per chunk: the ``keep`` columns, chunk (from 0), start and end (code points, end excluded) and chunk_text.

    Chunks begin every ``size - overlap`` code points and reach ``size`` of them; the last one ends with the text and
    brings something new. An empty text is one empty chunk, a NULL text none. All in built-in expressions: rows stay on
    the JVM, and no row is shuffled.
    """
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be shorter than the chunk")
    step, value = size - overlap, F.col(text)
    last = F.greatest(F.ceil((F.length(value) - size) / step), F.lit(0)).cast("int")
    numbered = docs.filter(value.isNotNull()).select(*keep, value.alias("__text"), F.posexplode(
        F.sequence(F.lit(0), last)).alias("chunk", "__n"))
    start = F.col("chunk") * step
    return numbered.select(
        *keep, "chunk", start.alias("start"), F.least(start + size, F.length("__text")).alias("end"),
        F.substring("__text", start + 1, F.lit(size)).alias("chunk_text"))


def joined(parts: DataFrame, key: Sequence[str], name: str = "text") -> DataFrame:
    """The texts of ``chunks``: of each chunk what the one before it did not bring. One text is in one task."""
    ordered = F.array_sort(F.collect_list(F.struct("start", "end", "chunk_text")))
    whole = F.aggregate(ordered, F.lit(""), lambda done, c: F.concat(
        done, F.substring(c["chunk_text"], F.length(done) - c["start"] + 1, F.length(c["chunk_text"]))))
    return parts.groupBy(*key).agg(whole.alias(name))
