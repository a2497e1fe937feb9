"""Benchmark decontamination: n-gram seeds find passages, Smith-Waterman alignment scores them.

Words are compared in lower case without ASCII punctuation. Every n-gram of an item is a seed, however often the corpus
holds it: one that an edit left whole is enough. Documents that hold a seed are aligned with the item around it, unless
too few of the item's words occur there to reach the score: local alignment of words with linear gaps, so edited and
rearranged words cost points but don't hide the copy. A document and an item are linked if the best alignment reaches
``min_score`` of the item's perfect score. A copy in which no n consecutive words are left whole has no seed.

The benchmark is a stated query set and is held against all documents in blocks of at most ``block_words`` words, each
broadcast (its size is bounded by that parameter; all texts of an item are in one block, and an item longer than a block
is a block of its own). No document is shuffled.

Items with fewer than ``n`` words (null and empty ones too) are too short to tell and link to nothing; null and empty
documents link to nothing. Rows with the same item_id are one item with several texts; the best counts. Repeated
documents give repeated rows. A null doc_id stays null.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import TwoGenerations, map_texts, table

_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_LOWER = bytes(range(256)).lower()


@dataclass(frozen=True)
class Setup:
    n: int = 3
    match: int = 2
    mismatch: int = -1
    gap: int = -1
    min_score: float = 0.5
    block_words: int = 500_000


class WordIds:
    """64-bit ids of the normalized words of a text; words of punctuation only are left out (id 0)."""

    def __init__(self, most_cached: int = 300_000):
        self.id_of = TwoGenerations(lambda w: xxhash.xxh64_intdigest(w) >> 1 or 1, most_cached)

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").translate(_LOWER, _PUNCTUATION).split()
        return np.fromiter(map(self.id_of, words), np.int64, len(words))


def gram_ids(ids: np.ndarray, n: int) -> np.ndarray:
    """One id per n consecutive words."""
    if len(ids) < n:
        return np.zeros(0, np.int64)
    out = ids[:len(ids) - n + 1].astype(np.uint64)
    for i in range(1, n):
        out = (out * np.uint64(0x9E3779B97F4A7C15)) ^ (out >> np.uint64(29)) ^ ids[i:len(ids) - n + 1 + i].astype(np.uint64)
    return out.view(np.int64)


def align(item: np.ndarray, text: np.ndarray, setup: Setup) -> tuple[int, int]:
    """Score of the best local alignment and the position in ``text`` where it ends (exclusive).

    A row per word of the item: gaps along the row follow from a running maximum.
    """
    slope = -setup.gap * np.arange(len(text) + 1)
    above = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        row = np.zeros(len(text) + 1, np.int64)
        np.maximum(above[:-1] + np.where(text == word, setup.match, setup.mismatch), above[1:] + setup.gap, out=row[1:])
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + slope) - slope
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        above = row
    return best, end


def item_blocks(benchmark: DataFrame, setup: Setup):
    """Lists of (item_id, word ids), each of a bounded number of words, read one partition at a time in the order of
    item_id, so that the best of all texts of an item is found within one block."""
    ids, block, words = WordIds(), [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    for item_id, group in groupby(rows.where("text IS NOT NULL").orderBy("item_id").toLocalIterator(), lambda r: r.item_id):
        texts = [t for t in (ids(bytes(r.text)) for r in group) if len(t) >= setup.n]
        size = sum(map(len, texts))
        if block and words + size > setup.block_words:
            yield block
            block, words = [], 0
        block += [(item_id, t) for t in texts]
        words += size
    if block:
        yield block


@dataclass(frozen=True)
class Model:
    """Items of a block, the n-grams of all of them (sorted ids with item and position), and their words as numbers."""
    items: list
    seeds: np.ndarray
    owner: np.ndarray
    position: np.ndarray
    vocabulary: np.ndarray
    numbers: np.ndarray
    starts: np.ndarray


def build(block: list, setup: Setup) -> Model:
    grams = [gram_ids(item, setup.n) for _, item in block]
    seeds = np.concatenate(grams)
    owner = np.repeat(np.arange(len(block)), [len(g) for g in grams])
    position = np.concatenate([np.arange(len(g)) for g in grams])
    order = np.lexsort((position, owner, seeds))
    vocabulary, numbers = np.unique(np.concatenate([item for _, item in block]), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum([len(item) for _, item in block])])
    return Model(block, seeds[order], owner[order], position[order], vocabulary, numbers, starts)


def possible(model: Model, candidates: np.ndarray, ids: np.ndarray, setup: Setup) -> np.ndarray:
    """The candidates (sorted items) of which enough words occur in the text. No alignment can score more than a match
    for each word that occurs, so this loses none that reaches ``min_score``."""
    at = np.searchsorted(model.vocabulary, ids)
    at[at == len(model.vocabulary)] = 0
    held = np.zeros(len(model.vocabulary), np.int64)
    held[at[model.vocabulary[at] == ids]] = 1
    first, sizes = model.starts[candidates], model.starts[candidates + 1] - model.starts[candidates]
    begins = np.cumsum(sizes) - sizes
    words = np.repeat(first - begins, sizes) + np.arange(sizes.sum())
    return candidates[np.add.reduceat(held[model.numbers[words]], begins) / sizes >= setup.min_score]


def matches(ids: np.ndarray, model: Model, setup: Setup) -> list[tuple[int, float, int, int]]:
    """(item, score, first word, end word) of the best alignment with each item that a seed of the text points to."""
    items, seeds = model.items, model.seeds
    grams = gram_ids(ids, setup.n)
    low = np.searchsorted(seeds, grams, "left")
    held = np.flatnonzero((low < len(seeds)) & (seeds[np.minimum(low, len(seeds) - 1)] == grams))
    if not len(held):
        return []
    low = low[held]
    many = np.searchsorted(seeds, grams[held], "right") - low
    begins = np.cumsum(many) - many
    hits = np.repeat(low - begins, many) + np.arange(many.sum())
    owner, start = model.owner[hits], np.repeat(held, many) - model.position[hits]
    stay = np.isin(owner, possible(model, np.unique(owner), ids, setup))
    around: dict[int, list] = {}
    for k, at in zip(owner[stay].tolist(), start[stay].tolist()):
        around.setdefault(k, []).append(at)
    out = []
    for k, starts in around.items():
        item = items[k][1]
        size, best = len(item), (0, 0, 0)
        starts = sorted(set(starts))
        first = last = starts[0]
        for start in [*starts[1:], None]:
            if start is not None and start - last <= size:
                last = start
                continue
            a, b = max(0, first - size), min(len(ids), last + 2 * size)
            first = last = start
            if np.isin(item, ids[a:b]).sum() / size < setup.min_score:
                continue
            score, end = align(item, ids[a:b], setup)
            if score > best[0]:
                back, begin = align(item[::-1], ids[a:a + end][::-1], setup)
                best = (score, a + end - begin if back == score else a, a + end)
        share = best[0] / (setup.match * size)
        if share >= setup.min_score:
            out.append((k, share, best[1], best[2]))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, setup: Setup = Setup()) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, score (0 to 1), first_word, end_word (of the
    normalized words) of the best alignment. ``docs`` needs doc_id and text, ``benchmark`` item_id and text."""
    found = None
    for block in item_blocks(benchmark, setup):
        part = _align_block(docs, build(block, setup), setup)
        found = part if found is None else found.union(part)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, score double, first_word long, end_word long")
    return found


def _align_block(docs: DataFrame, model: Model, setup: Setup) -> DataFrame:
    shared, holder = docs.sparkSession.sparkContext.broadcast(model), {}

    def block(texts: list) -> dict:
        words = holder.get("w") or holder.setdefault("w", WordIds())
        items, out = shared.value.items, []
        for text in texts:
            best: dict = {}
            for k, score, first, end in matches(words(text), shared.value, setup):
                if score > best.get(items[k][0], (0.0,))[0]:
                    best[items[k][0]] = (score, first, end)
            out.append([{"item_id": i, "score": s, "first_word": a, "end_word": b} for i, (s, a, b) in best.items()])
        return {"found": out}

    row = "struct<item_id: bigint, score: double, first_word: bigint, end_word: bigint>"
    return map_texts(docs, block, f"found array<{row}>").select("doc_id", F.explode("found").alias("f")).select(
        "doc_id", "f.*")


def clean_documents(docs: DataFrame, benchmark: DataFrame, setup: Setup = Setup()) -> DataFrame:
    """The documents (all columns) that hold no benchmark item."""
    bad = contaminated(docs, benchmark, setup).select(F.col("doc_id").alias("_bad_id")).distinct()
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_bad_id"]), "left_anti")


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
