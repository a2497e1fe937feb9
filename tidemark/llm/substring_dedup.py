"""Exact substring deduplication: words covered by a window of ``size`` words that already starts earlier are removed.

Earlier means in a document of smaller doc_id, or further left in the same document. The reference of a document is
thus the whole corpus before it, which no broadcast can hold; the suffix automata are built where they are needed:

1. *Seeds.* In every window the smallest hash of its ``seed``-word sequences is sampled. Sampled places are counted over
   the corpus (one row per place, pre-aggregated); a window whose smallest hash occurs once occurs once itself.
2. *Routing.* The remaining windows are cut into stretches whose smallest hash is at one place; the windows of a stretch
   thus differ. Equal windows have equal hashes, so all copies of a window meet under one hash. Equal stretches are reduced to their first place before they are
   sorted, so copies cost one row per task whatever their number.
3. *Automata.* The stretches of a hash are the reference shard of that hash: streamed in corpus order, each is matched
   against the suffix automaton of those before it. Where the matching statistic reaches ``size``, the window was there
   earlier; else it is new, and the stretch extends the automaton. A hash with more than ``crowded`` different
   stretches (a phrase that goes on differently in very many documents) would make one long task: its stretches are
   routed on as single windows, whose first places are an aggregate over equal windows.
4. *Removal.* Every window left in step 1 that is not new is covered; maximal covered spans go.

Null and empty texts have no words. Rows without a doc_id are neither compared nor changed; repeated rows of one
document are one document (each row gets the same result). Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, cut, release, table

#: Windows in one stretch at most (they are flagged in one integer).
STRETCH = 31
_BLOCK = 2 << 20


class Automaton:
    """Suffix automaton over word sequences that are added one after another."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, edges: dict) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, word, q: int) -> int:
        """A state for the suffixes of q that p reaches by the word."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list) -> None:
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
                continue
            state, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = state
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
            last = state

    def statistics(self, words: list) -> Iterator[int]:
        """Length of the longest match that ends at each word."""
        state, length = 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(word, 0)
            length = length + 1 if state else 0
            yield length


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


def _slide(values: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) over every ``width`` consecutive values."""
    span, out = 1, values
    while 2 * span <= width:
        out = of(out[:-span], out[span:])
        span *= 2
    return of(out[:len(out) - (width - span)], out[width - span:]) if span < width else out


class Block:
    """The words of some texts end to end, with the smallest sequence hash of every window."""

    def __init__(self, texts: list, size: int, seed: int):
        self.words = [(t or b"").split() for t in texts]
        self.counts = np.fromiter(map(len, self.words), np.int64, len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        n, self.width = int(self.first[-1]), size - seed + 1
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        if n < size:
            self.low = self.hash = np.zeros(0, np.uint64)
            self.inside = np.zeros(0, bool)
            return
        ids = np.fromiter((xxhash.xxh64_intdigest(w) for part in self.words for w in part), np.uint64, n)
        grams, span, left = ids, 1, seed
        while 2 * span <= seed:
            grams, span = _mix(grams[:-span], grams[span:]), 2 * span
        left = seed - span
        if left:
            grams = _mix(grams[:len(grams) - left], grams[left:])
        self.hash = grams | np.uint64(1)
        self.inside = self.doc[:n - size + 1] == self.doc[size - 1:]
        self.low = np.where(self.inside, _slide(self.hash, self.width, np.minimum), np.uint64(0))

    def sampled(self) -> np.ndarray:
        """Places whose sequence hash is the smallest of some window."""
        if not len(self.low):
            return np.zeros(0, np.int64)
        pad = np.zeros(self.width - 1, np.uint64)
        return np.flatnonzero(_slide(np.concatenate([pad, self.low, pad]), self.width, np.maximum) == self.hash)

    def maybe_repeated(self, once: np.ndarray) -> np.ndarray:
        """Window starts whose smallest sequence hash doesn't belong to one of the places ``once``."""
        if not len(self.low):
            return np.zeros(0, np.int64)
        maybe = self.inside.copy()
        for back in range(self.width):
            start = once - back
            fits = (start >= 0) & (start < len(maybe))
            start = start[fits]
            maybe[start[self.low[start] == self.hash[once[fits]]]] = False
        return np.flatnonzero(maybe)


    def lowest_place(self, starts: np.ndarray) -> np.ndarray:
        """Of each window the leftmost place with its smallest sequence hash."""
        place, low = starts.copy(), self.low[starts]
        for ahead in range(self.width - 1, -1, -1):
            place = np.where(self.hash[starts + ahead] == low, starts + ahead, place)
        return place


def _seeds(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """One row per sampled place: hash, doc_id, place."""
    def run(batches):
        for batch in batches:
            for part in blocks(batch, 1, _BLOCK):
                block = Block(part.column(1).to_pylist(), size, seed)
                at = block.sampled()
                doc = block.doc[at]
                yield pa.RecordBatch.from_arrays([
                    pa.array(block.hash[at].view(np.int64)),
                    pa.array(part.column(0).to_numpy(zero_copy_only=False)[doc]),
                    pa.array((at - block.first[doc]).astype(np.int32))], names=["hash", "doc_id", "place"])

    return docs.mapInArrow(run, "hash long, doc_id long, place int")


def _stretches(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """One row per document with its words and maybe repeated windows; ``docs`` has doc_id, text and once (places). The
    column starts holds the runs of such windows: first ones, then lengths.

    ``kept_sha256`` is final for documents without such windows, the others keep their text and bring stretches."""
    schema = ("doc_id long, n_words long, kept_sha256 string, text binary, starts binary, "
              "stretches array<struct<hash: long, start: int, n: int, words: binary>>")
    stretch = pa.list_(pa.struct([("hash", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("words", pa.binary())]))

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 1, _BLOCK):
                texts, once = part.column(1).to_pylist(), part.column(2)
                block = Block(texts, size, seed)
                flat = once.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                lengths = once.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                starts = block.maybe_repeated(flat + np.repeat(block.first[:-1], lengths))
                doc, places = block.doc[starts], block.lowest_place(starts)
                bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
                out = {"hash": [], "text": [], "starts": [], "stretches": []}
                for i, text in enumerate(texts):
                    words, own = block.words[i], starts[bounds[i]:bounds[i + 1]]
                    if not len(own):
                        out["hash"].append(hashlib.sha256(b" ".join(words)).hexdigest())
                        for name in ("text", "starts", "stretches"):
                            out[name].append(None)
                        continue
                    low, place = block.low[own], places[bounds[i]:bounds[i + 1]]
                    breaks = np.flatnonzero((np.diff(own) != 1) | (np.diff(place) != 0)) + 1
                    own = own - block.first[i]
                    found: dict = {}
                    for a, b in zip([0, *breaks.tolist()], [*breaks.tolist(), len(own)]):
                        for c in range(a, b, STRETCH):
                            start, n = int(own[c]), min(b - c, STRETCH)
                            key = (int(low[c:c + 1].view(np.int64)[0]), n, b" ".join(words[start:start + n - 1 + size]))
                            found.setdefault(key, start)
                    out["hash"].append(None)
                    out["text"].append(text)
                    edges = np.flatnonzero(np.diff(own, prepend=-2, append=own[-1] + 2) != 1)
                    out["starts"].append(np.stack([own[edges[:-1]], np.diff(edges)]).astype("<i4").tobytes())
                    out["stretches"].append([
                        {"hash": h, "start": s, "n": n, "words": w} for (h, n, w), s in found.items()])
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(block.counts), pa.array(out["hash"], pa.string()),
                    pa.array(out["text"], pa.binary()), pa.array(out["starts"], pa.binary()),
                    pa.array(out["stretches"], stretch)],
                    names=["doc_id", "n_words", "kept_sha256", "text", "starts", "stretches"])

    return docs.mapInArrow(run, schema)


def _new_windows(stretches: DataFrame, size: int) -> DataFrame:
    """doc_id, start and the flags of the windows of a stretch that start nowhere earlier; rows come sorted by hash and
    place, so a task holds one automaton at a time."""
    def run(batches):
        current, automaton, waiting = None, None, None
        for batch in batches:
            docs, starts, flags = [], [], []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for h, doc, start, text in zip(*columns):
                words = text.split(b" ")
                n = len(words) - size + 1
                if h != current:
                    current, automaton, waiting, mask = h, None, words, (1 << n) - 1
                else:
                    if automaton is None:
                        automaton = Automaton()
                        automaton.add(waiting)
                    mask = 0
                    for end, length in enumerate(automaton.statistics(words)):
                        if end >= size - 1 and length < size:
                            mask |= 1 << (end - size + 1)
                    if mask:
                        automaton.add(words)
                if mask:
                    docs.append(doc)
                    starts.append(start)
                    flags.append(mask)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(starts, pa.int32()), pa.array(flags, pa.int64())],
                names=["doc_id", "start", "flags"])

    return stretches.mapInArrow(run, "doc_id long, start int, flags long")


def _single_windows(stretches: DataFrame, size: int) -> DataFrame:
    """Every window of some stretches by itself: words, doc_id, start."""
    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            for doc, start, text in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                words = text.split(b" ")
                for i in range(len(words) - size + 1):
                    for column, value in zip(out, (b" ".join(words[i:i + size]), doc, start + i)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32())],
                names=["words", "doc_id", "start"])

    return stretches.select("doc_id", "start", "words").mapInArrow(run, "words binary, doc_id long, start int")


def _remove(rows: DataFrame, size: int, with_text: bool) -> DataFrame:
    """Documents with maybe repeated windows and their new ones (columns at and flags): what is left of them."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 1, _BLOCK):
                out: list[list] = [[] for _ in range(5)]
                for doc, text, starts, at, flags in zip(*[part.column(i).to_pylist() for i in range(5)]):
                    words = text.split()
                    gone = np.zeros(len(words) + 1, np.int32)
                    repeated = np.zeros(len(words), bool)
                    for first, n in np.frombuffer(starts, "<i4").reshape(2, -1).T.tolist():
                        repeated[first:first + n] = True
                    for a, mask in zip(at or (), flags or ()):
                        while mask:
                            low = mask & -mask
                            repeated[a + low.bit_length() - 1] = False
                            mask ^= low
                    windows = np.flatnonzero(repeated)
                    gone[windows] += 1
                    np.subtract.at(gone, windows + size, 1)
                    covered = np.cumsum(gone[:-1]) > 0
                    kept = b" ".join([w for w, c in zip(words, covered.tolist()) if not c])
                    for column, value in zip(out, (doc, len(words), int(covered.sum()),
                                                   hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace"))):
                        column.append(value)
                arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                          pa.array(out[3], pa.string())] + ([pa.array(out[4], pa.string())] if with_text else [])
                yield pa.RecordBatch.from_arrays(
                    arrays, names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][:len(arrays)])

    return rows.select("doc_id", "text", "starts", "at", "flags").mapInArrow(run, schema)


def deduplicate(docs: DataFrame, size: int = 20, seed: int = 10, with_text: bool = False, crowded: int = 256) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space) and, with
    ``with_text``, kept_text: those words, or null where nothing was removed."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counted = _seeds(plain.where("doc_id IS NOT NULL"), size, seed).groupBy("hash").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.min("place").alias("place"))
    once = counted.where("n = 1").groupBy("doc_id").agg(F.collect_list("place").alias("once"))
    places = F.coalesce("once", F.array().cast("array<int>"))
    judged = cut(_stretches(plain.where("doc_id IS NOT NULL").join(once, "doc_id", "left").select(
        "doc_id", "text", places.alias("once")), size, seed))
    stretches = judged.where("text IS NOT NULL").select("doc_id", F.explode("stretches").alias("s"))
    # a document brings one row per stretch
    first = cut(stretches.groupBy("s.hash", "s.words").agg(
        F.min("doc_id").alias("doc_id"), F.min_by("s.start", "doc_id").alias("start")))
    many = cut(first.groupBy("hash").count().where(F.col("count") > crowded).select("hash"))
    ordered = first.join(many, "hash", "left_anti").select("hash", "doc_id", "start", "words").repartition(
        "hash").sortWithinPartitions("hash", "doc_id", "start")
    single = _first_places(_single_windows(first.join(many, "hash", "left_semi"), size), "words").select(
        "doc_id", "start", F.lit(1).cast("long").alias("flags"))
    new = cut(_new_windows(ordered, size).union(single).groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "flags")).alias("new")))
    release(first, many)
    repeated = judged.where("text IS NOT NULL").select("doc_id", "text", "starts").join(new, "doc_id", "left").select(
        "doc_id", "text", "starts", F.col("new.start").alias("at"), F.col("new.flags").alias("flags"))
    changed = _remove(repeated, size, with_text)
    no_text = [F.lit(None).cast("string").alias("kept_text")] if with_text else []
    same = judged.where("text IS NULL").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", *no_text)
    return changed.union(same).union(_untouched(plain.where("doc_id IS NULL"), with_text))


def _first_places(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows with equal keys reduced to the leftmost one in the smallest document."""
    return rows.groupBy(*keys, "doc_id").agg(F.min("start").alias("start")).groupBy(*keys).agg(F.min("doc_id").alias("doc_id"), F.min_by("start", "doc_id").alias("start"))


def _untouched(rows: DataFrame, with_text: bool) -> DataFrame:
    """Rows without a doc_id, as they are."""
    def run(batches):
        for batch in batches:
            words = [(t or b"").split() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(w) for w in words], pa.int64()), pa.array([0] * len(words), pa.int64()),
                pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words])],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    out = rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return out.withColumn("kept_text", F.lit(None).cast("string")) if with_text else out


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS words
  FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(words[p:p + 19], ' ') AS w
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 19)) AS p FROM split WHERE len(words) >= 20)),
dup AS (SELECT doc_id, p FROM (
  SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 19)) AS i FROM dup),
every AS (SELECT doc_id, unnest(words) AS w, unnest(generate_series(1, len(words))) AS i FROM split),
kept AS (
  SELECT e.doc_id, string_agg(w, ' ' ORDER BY e.i) AS t, count(*) AS n
  FROM every e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT s.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""
