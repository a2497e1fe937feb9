"""Mixing of sources to target weights by balanced sampling with the cube method.

*Targets.* Sources in code-point order weigh 5, 2, 1, repeating, and share all words; no target exceeds ``most`` times
the size of its source, the excess is shared again. A document of a source of size s and target t is taken t / s times on
average: the whole part for sure, once more with the fractional part as its inclusion probability.

*Flight.* The probabilities of three documents of a source are moved along a direction in which neither their expected
words nor their expected number changes, until one of them is 0 or 1; it leaves and the next document comes in. Of the two
ends of a direction one is drawn such that expectations stay. A flight works on a stream, in memory for a few documents.

*Rounds.* Documents fly in parallel in buckets of their hash, about ``bucket`` documents each, so a source with a third of
all rows is many tasks' work. A bucket leaves ``LEFT`` documents undecided at most; these fly together in ``fan`` times
fewer buckets, until each source has one bucket.

*Landing.* The last ``LEFT`` documents of a source are decided together: of all outcomes the one that is nearest in words,
in units of their mean size, and in documents.

Draws are hashes of the place and the documents in flight, so reruns agree, whatever the number of tasks. Words and
documents of each source hold exactly up to its landing, which chooses among 16,384 outcomes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, splittable, table

WEIGHTS = (5, 2, 1)
#: Documents that a flight leaves to the next round or to the landing.
LEFT = 14
_CLOSE = 1e-9


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit("[^ \\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """``sizes`` has one row per source (source, source_size). Adds target.

    One level times its weight is the target of each source that this leaves at ``most`` times its size or below, all
    others stop there: a source stops before another one if its bound by weight is lower. The window is over one row per
    source."""
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*map(F.lit, weights)), ((F.row_number().over(in_order) - 1) % len(weights)).cast("int"))
    known = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    climb = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = climb.rowsBetween(Window.unboundedPreceding, -1)
    after = climb.rowsBetween(0, Window.unboundedFollowing)
    rest = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    levels = known.withColumn("level", rest / F.sum("weight").over(after))
    reached = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    # the first level that its own source can take holds for all sources after it
    level = F.first(reached, ignorenulls=True).over(climb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.withColumn("common", level).select("source", "source_size", F.least(
        F.col("common") * F.col("weight"), F.col("cap").cast("double")).alias("target"))


def direction(sizes: list[int]) -> list[float]:
    """A direction for three probabilities in which neither their sum nor the sum of probability times size changes."""
    a, b, c = sizes
    found = [float(c - b), float(a - c), float(b - a)]
    return found if any(found) else [1.0, -1.0, 0.0]


def fly(units: list, draw: float) -> None:
    """Moves the probabilities of three units (lists that end with probability and size) until one is 0 or 1; ``draw``
    (from 0 to 1) chooses the end of the way such that expectations stay."""
    d = direction([u[-1] for u in units])
    ahead, back = (min(((1 - u[-2]) if s * e > 0 else u[-2]) / abs(e) for u, e in zip(units, d) if e) for s in (1, -1))
    step = ahead if draw * (ahead + back) < back else -back
    for unit, e in zip(units, d):
        p = unit[-2] + step * e
        unit[-2] = 0.0 if p < _CLOSE else 1.0 if p > 1 - _CLOSE else p


def _flight(rows: DataFrame) -> DataFrame:
    """``rows`` (source_key, bucket, h, doc_id, p, size), sorted by bucket: the same rows with p moved."""
    def run(batches):
        place, waiting = None, []

        for batch in batches:
            done = []
            for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]):
                unit = list(row)
                if tuple(unit[:2]) != place:
                    done += waiting
                    place, waiting = tuple(unit[:2]), []
                waiting.append(unit)
                while len(waiting) > LEFT:
                    three = waiting[:3]
                    fly(three, xxhash.xxh64_intdigest(f"{place} {[u[3:] for u in three]}") / 2.0 ** 64)
                    done += [u for u in waiting if u[-2] in (0.0, 1.0)]
                    waiting = [u for u in waiting if u[-2] not in (0.0, 1.0)]
            yield _batch(done)
        yield _batch(waiting)

    def _batch(done):
        return pa.RecordBatch.from_arrays(
            [pa.array([u[i] for u in done], t) for i, t in enumerate(types)], names=names)

    names = rows.columns
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
    return rows.mapInArrow(run, rows.schema)


def landing(units: list[tuple[float, int]]) -> list[int]:
    """Decisions (0 or 1) for a few undecided (probability, size)."""
    p, sizes = np.array([u[0] for u in units]), np.array([u[1] for u in units], float)
    outcomes = np.arange(1 << len(units))[:, None] >> np.arange(len(units)) & 1
    off = outcomes - p
    cost = 16 * np.abs(off @ sizes) / max(sizes.mean(), 1) + np.abs(off.sum(axis=1))
    return outcomes[np.argmin(np.round(cost, 6))].tolist()


def _land(rows: DataFrame) -> DataFrame:
    """The undecided rows of each source, ``LEFT`` at most, decided together."""
    def run(pdf):
        pdf = pdf.sort_values(["h", "size"], kind="stable")
        pdf["p"] = [float(x) for x in landing(list(zip(pdf["p"], pdf["size"])))]
        return pdf

    return rows.groupBy("source_key").applyInPandas(run, rows.schema)


def balanced_sample(rows: DataFrame, documents: int, bucket: int = 4096, fan: int = 512) -> DataFrame:
    """``rows`` has source_key, h (a hash), doc_id, p (inclusion probability, 0 < p < 1) and size, all of a source with
    one p; ``documents`` is their number in the largest source. Returns doc_id, size, source_key and p, now 0 or 1."""
    schema = ["source_key", "bucket", "h", "doc_id", "p", "size"]
    buckets = max(1, -(-documents // bucket))
    open_ = rows.withColumn("bucket", F.pmod(F.col("h"), F.lit(buckets)))
    decided = None
    while True:
        # (copies with one doc_id and size are alike: which of them comes first changes nothing)
        flown = cut(_flight(open_.select(*schema).repartition("source_key", "bucket").sortWithinPartitions(
            "source_key", "bucket", "h", "doc_id", "size")))
        sure = flown.where("p = 0 OR p = 1")
        decided = sure if decided is None else decided.union(sure)
        open_ = flown.where("p > 0 AND p < 1")
        if buckets == 1:
            break
        buckets = -(-buckets // fan)
        open_ = open_.withColumn("bucket", F.pmod(F.col("bucket"), F.lit(buckets)))
    return decided.union(_land(open_)).select("source_key", "doc_id", "size", "p")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3, bucket: int = 4096, fan: int = 512) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target and taken (words that the mix takes).

    Null and empty texts have size 0 and are never taken. A null doc_id is an id like any other, a null source a source
    like any other (the last). Repeated rows are documents of their own. A source without words has target 0. Only doc_id,
    source and text are read; no rows give none.
    """
    sized = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                            word_count(F.col("text")).alias("size")))
    sources = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most).withColumn(
        "ratio", F.try_divide("target", "source_size")))
    side = splittable(sources, "source")
    # (a null source has a null key: eqNullSafe, and the same hash on both sides)
    known = sized.join(side, (F.xxhash64(sized["source"]) == F.col("_right_hash")) & sized["source"].eqNullSafe(F.col("_right_key")))
    ratio = F.coalesce("ratio", F.lit(0.0))
    whole = F.floor(ratio + _CLOSE)
    known = cut(known.select(
        "doc_id", "source", "size", "source_size", "target", whole.cast("long").alias("whole"),
        F.when(ratio - whole > _CLOSE, ratio - whole).otherwise(0.0).alias("p"),
        F.xxhash64("source", F.col("source").isNull()).alias("source_key"), F.xxhash64("doc_id", "size").alias("h")))
    drawn = known.where("p > 0 AND size > 0")
    most_docs = drawn.groupBy("source_key").count().agg(F.max("count")).first()[0] or 1
    sampled = balanced_sample(drawn.select("source_key", "h", "doc_id", "p", "size"), most_docs, bucket, fan)
    attributes = splittable(known.groupBy("source_key").agg(F.first("source").alias("source"), F.first(
        "source_size").alias("source_size"), F.first("target").alias("target"), F.first("whole").alias("whole")), "source_key")
    sampled = sampled.join(attributes, (F.xxhash64(sampled["source_key"]) == F.col("_right_hash")) & (
        sampled["source_key"] == F.col("_right_key"))).withColumn("copies", F.col("whole") + F.col("p").cast("long"))
    rest = known.where("NOT (p > 0 AND size > 0)").withColumn("copies", F.col("whole"))
    names = ["doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")]
    return sampled.select(*names).union(rest.select(*names))


def op13_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
