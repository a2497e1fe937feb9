"""SimHash near-duplicates with pigeonring filtering.

*Fingerprint.* Words of the text (ASCII letters in lower case) in shingles of ``shingle`` words, each hashed with XXH64
(seed 42); a bit is set if more than half of the hashes have it. No words: zero.

*Pigeonring.* The 64 bits are a ring of ``segments`` segments. If two fingerprints differ in at most t bits, some
segment starts a chain whose first l segments together differ in at most floor(l * t / segments) bits, for every l.
The leading quotas of zero make the join key: that many consecutive segments are equal. A pair that shares a key goes
on only if the whole chain from there stays in its quotas, then the full Hamming distance decides.

*Hot keys.* Pairs are formed only under keys with at most ``dense`` distinct fingerprints. Fingerprints under a denser
key are linked by their balls instead, which is exact and needs no pairs: each emits itself and its 64 neighbours at one
bit, and all that meet in one value are within two bits of each other; the smallest links to each other one. This is
why ``max_bits`` is fixed at two.

Equal fingerprints are one node from the start, so a group of copies costs one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, doc_key, map_texts, splittable, splittable_on, table
from tidemark.llm.components import component_of

SEED = 42
#: Fingerprints link at this many differing bits or fewer.
MAX_BITS = 2


def shingle_hashes(text: bytes | None, size: int) -> list[int]:
    words = (text or b"").lower().split()
    if not words:
        return []
    joined, hash64 = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return [hash64(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    return [hash64(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:].tolist())]


def fingerprints_of(texts: list, size: int) -> np.ndarray:
    """One signed 64-bit fingerprint per text; bits are counted in slices, so a long text needs no wide array."""
    out = np.zeros(len(texts), np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for i, text in enumerate(texts):
        hashes = np.array(shingle_hashes(text, size), np.uint64)
        if len(hashes):
            ones = np.zeros(64, np.int64)
            for at in range(0, len(hashes), 1 << 14):
                part = hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
                ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[i] = weights[2 * ones > len(hashes)].sum(dtype=np.uint64)
    return out.view(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3, keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: the ``keep`` columns (default doc_id) and fp, the fingerprint as a signed long."""
    return map_texts(docs, lambda texts: {"fp": pa.array(fingerprints_of(texts, shingle))}, "fp long", keep)


def ring(segments: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    bounds = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def _field(value: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(value, start).bitwiseAND(F.lit((1 << width) - 1))


def chain_key(fp: Column, start: int, length: int, segments: int) -> Column:
    """The bits of ``length`` consecutive segments from ``start`` on, around the ring."""
    mask = 0
    for i in range(length):
        first, width = ring(segments)[(start + i) % segments]
        mask |= ((1 << width) - 1) << first
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def within_quotas(difference: Column, start: Column, segments: int, max_bits: int) -> Column:
    """Every chain from ``start`` stays within its proportional budget."""
    parts = ring(segments)
    ok = F.lit(False)
    for first in range(segments):
        used, here = F.lit(0), F.lit(True)
        for length in range(1, segments + 1):
            used = used + F.bit_count(_field(difference, *parts[(first + length - 1) % segments]))
            here = here & (used <= length * max_bits // segments)
        ok = ok | ((start == first) & here)
    return ok


def links(prints: DataFrame, segments: int = 5, dense: int = 64) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (long column fp) that connect all pairs within ``MAX_BITS`` bits."""
    equal = next(n for n in range(1, segments + 2) if n * MAX_BITS // segments) - 1
    if equal < 1:
        raise ValueError("take more segments: no chain of equal segments is sure")
    prints = prints.select("fp").distinct()
    keys = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(s).alias("start"), chain_key(F.col("fp"), s, equal, segments).alias("bits"))
        for s in range(segments)])).alias("k")).select("fp", "k.start", "k.bits")
    crowded = cut(keys.groupBy("start", "bits").count().where(F.col("count") > dense).select("start", "bits"))
    sparse = cut(keys.join(crowded, ["start", "bits"], "left_anti"))
    other = sparse.select("start", "bits", F.col("fp").alias("fp2"))
    difference = F.col("fp").bitwiseXOR(F.col("fp2"))
    pairs = (
        sparse.join(other, ["start", "bits"]).where("fp < fp2")
        .where(within_quotas(difference, F.col("start"), segments, MAX_BITS))
        .where(F.bit_count(difference) <= MAX_BITS)
        .select(F.col("fp").alias("u"), F.col("fp2").alias("v")))
    inside = keys.join(crowded, ["start", "bits"], "left_semi").select("fp").distinct()
    flips = [0, *[1 << b for b in range(63)], -(1 << 63)]
    balls = inside.select("fp", F.explode(F.array(*[F.lit(f).cast("long") for f in flips])).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    least = balls.groupBy("value").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high")
    linked = balls.join(splittable(least.select("value", "low"), "value"), splittable_on(balls, "value")).where(
        "fp > low").select(F.col("low").alias("u"), F.col("fp").alias("v"))
    return pairs.union(linked).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, segments: int = 5, dense: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp and component (the smallest doc_id reachable over links, itself included).

    A null doc_id counts as smallest and gives a null component. Null and empty texts have fingerprint zero and are
    linked like any other; repeated rows share their component. Only doc_id and text are read.
    """
    prints = cut(fingerprints(docs, shingle, {"doc_id": F.col("doc_id").cast("long")}))
    nodes = prints.groupBy("fp").agg(F.min(doc_key()).alias("least_id"))
    parts = component_of(links(nodes, segments, dense))
    named = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("root"), "least_id")
    roots = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.select("fp", "root")
    by_fp = named.join(splittable(roots, "root"), splittable_on(named, "root")).select("fp", "component_id")
    return prints.join(by_fp, "fp").select(
        "doc_id", "fp", F.when(F.col("component_id") > F.lit(-(1 << 63)), F.col("component_id")).alias("component"))


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The documents (all columns) whose doc_id is the smallest of their near-duplicate group.

    Of repeated rows of one doc_id all stay or go together.
    """
    groups = near_duplicates(docs, **options)
    keep = groups.where(F.col("doc_id").eqNullSafe(F.col("component"))).select(
        F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(keep, docs["doc_id"].cast("long").eqNullSafe(keep["_kept_id"]), "left_semi")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))
