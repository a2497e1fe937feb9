"""Toxicity by compression distance: one zstandard dictionary learned from toxic text, one from ordinary text.

*Learning* uses a bounded sample of labelled documents (``Setup.docs_per_class`` of smallest id hash per class, twice:
for the dictionaries and for calibration). Character n-grams of words are counted by document in both classes; the
windows of toxic documents that hold an n-gram with a clear lift train the toxic dictionary, windows of ordinary
documents the other one. Few toxic windows are the dictionary themselves.

*Scoring* cuts the whole text into windows of ``Setup.window_words`` words (ASCII letters in lower case) and compresses
each with both dictionaries. A window counts when the toxic one saves at least the calibrated number of bytes; the
document's counts go through a logistic curve fitted on the calibration half and corrected for the share of the class.

Null and empty texts have no window and get the curve's value for none. If one class has no labelled document, every
score is the share of toxic labels (0.0 without labels). Only doc_id and text of a document are read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import TwoGenerations, in_fold, labelled_sample, map_texts, table

#: Windows longer than this train no dictionary (they are scored like any other).
LONGEST_SAMPLE = 256
#: Follows each window: zstandard finds no match in a block's last bytes and stores a block raw that saves too little, so
#: a short word alone has one length under all dictionaries. Bytes that UTF-8 never holds, repeated to be compressible.
CARRIER = bytes(range(0xF5, 0x100)) * 3
#: Around raw content, whose first and last bytes find no match; not UTF-8 and not in the carrier.
MARGIN = b"\xc0\xc1" * 8


@dataclass(frozen=True)
class Setup:
    docs_per_class: int = 1000
    window_words: int = 1
    lengths: tuple = (4, 5, 6)
    min_share: float = 0.02
    min_lift: float = 20.0
    most_grams: int = 4000
    most_samples: int = 40_000
    dictionary_bytes: int = 16_384
    level: int = 3


def windows(text: bytes | None, words: int) -> list[bytes]:
    found = (text or b"").lower().split()
    if words == 1:
        return found
    return [b" ".join(found[i:i + words]) for i in range(0, len(found), words)]


def grams(window: bytes, lengths: tuple) -> set[bytes]:
    marked = b" " + window + b" "
    return {marked[i:i + n] for n in lengths for i in range(len(marked) - n + 1)}


def _gram_docs(sample: DataFrame, setup: Setup) -> DataFrame:
    """Documents per class that hold each n-gram of a window."""
    import pyarrow as pa

    def count(batches):
        for batch in batches:
            found: dict = {}
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = set().union(*[grams(w, setup.lengths) for w in set(windows(text, setup.window_words))])
                for g in held:
                    found[y, g] = found.get((y, g), 0) + 1
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in found], pa.int32()), pa.array([k[1] for k in found], pa.binary()),
                pa.array(list(found.values()), pa.int64())], names=["y", "gram", "n"])

    one = F.coalesce(F.sum(F.when(F.col("y") == 1, F.col("n"))), F.lit(0))
    zero = F.coalesce(F.sum(F.when(F.col("y") == 0, F.col("n"))), F.lit(0))
    return sample.mapInArrow(count, "y int, gram binary, n long").groupBy("gram").agg(one.alias("n1"), zero.alias("n0"))


def _window_samples(sample: DataFrame, y: int, chosen: set | None, setup: Setup) -> list[bytes]:
    """A bounded set of training windows of one class, those with a chosen n-gram only if ``chosen`` is given."""
    import pyarrow as pa
    shared = sample.sparkSession.sparkContext.broadcast(chosen)

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                for w in windows(text, setup.window_words):
                    if len(w) <= LONGEST_SAMPLE and (
                            shared.value is None or not shared.value.isdisjoint(grams(w, setup.lengths))):
                        out.append(b" " + w + b" ")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["w"])

    found = sample.where(F.col("y") == y).select("text").mapInArrow(run, "w binary")
    counted = found.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.xxhash64("w"), "w").limit(setup.most_samples)
    rows = counted.collect()
    room = max(1, setup.most_samples // max(1, len(rows)))
    return [bytes(r.w) for r in rows for _ in range(min(r.n, room))]


def train_dictionary(samples: list[bytes], setup: Setup) -> bytes:
    """A dictionary of zstandard's trainer; of too few samples, their text itself (a raw-content dictionary)."""
    try:
        return zstandard.train_dictionary(setup.dictionary_bytes, samples, level=setup.level).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return MARGIN + b"".join(dict.fromkeys(samples))[-setup.dictionary_bytes:] + MARGIN


def toxic_dictionary(toxic: list[bytes], ordinary: list[bytes], held: dict, setup: Setup) -> bytes:
    """The toxic windows that have a clear lift themselves, the most frequent last, as raw content if they fit: the
    trainer leaves out some of a few short words."""
    most, other = Counter(toxic), Counter(ordinary)
    lifted = [w for w, n in most.most_common() if n * held[0] >= setup.min_lift * (other[w] + 0.5) * held[1]]
    content = MARGIN + b"".join(reversed(lifted)) + MARGIN
    return content if lifted and len(content) <= setup.dictionary_bytes else train_dictionary(toxic, setup)


class Distance:
    """Bytes that the toxic dictionary saves over the ordinary one, by window; windows seen lately are remembered."""

    def __init__(self, ordinary: bytes, toxic: bytes, level: int, most_cached: int = 300_000):
        self.lengths = [self._compressor(d, level) for d in (ordinary, toxic)]
        self.gain = TwoGenerations(self._gain, most_cached)

    @staticmethod
    def _compressor(data: bytes, level: int):
        dictionary = zstandard.ZstdCompressionDict(data)
        dictionary.precompute_compress(level=level)
        return zstandard.ZstdCompressor(
            level=level, dict_data=dictionary, write_content_size=False, write_dict_id=False).compress

    def _gain(self, window: bytes) -> int:
        marked = b" " + window + b" " + CARRIER
        ordinary, toxic = self.lengths
        return len(ordinary(marked)) - len(toxic(marked))

    def gains(self, text: bytes | None, words: int) -> np.ndarray:
        found = windows(text, words)
        return np.fromiter(map(self.gain, found), np.int32, len(found))


#: Candidates for the number of saved bytes from which a window counts.
THRESHOLDS = tuple(range(1, 9))


def features(gains: np.ndarray) -> list[float]:
    """Windows that count at each candidate threshold, the largest saving and the number of windows."""
    if not len(gains):
        return [0.0] * len(THRESHOLDS) + [0.0, 0.0]
    return [float((gains >= t).sum()) for t in THRESHOLDS] + [float(gains.max()), float(len(gains))]


def inputs(rows: np.ndarray, threshold: int) -> np.ndarray:
    hits, most, n = rows[:, THRESHOLDS.index(threshold)], rows[:, -2], rows[:, -1]
    return np.stack([np.ones(len(rows)), np.minimum(hits, 4), np.log1p(hits), np.clip(most, 0, 8),
                     hits / np.maximum(n, 1)], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - ridge * beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        beta = beta + np.linalg.solve(curve, slope)
    return beta


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", setup: Setup = Setup()) -> dict:
    """The model; ``labels`` has doc_id and a column of 0 and 1 (other values and nulls teach nothing)."""
    counts = {r.y: r.n for r in labels.where(F.col(label).isin(0, 1)).groupBy(
        F.col(label).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    first = labelled_sample(docs, labels, label, setup.docs_per_class, 0)
    held = {r.y: r.n for r in first.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not (held.get(0) and held.get(1)):
        return {"share": share}
    table_ = _gram_docs(first, setup)
    lift = table_.where(
        (F.col("n1") >= max(2.0, setup.min_share * held[1]))
        & (F.col("n1") * held[0] >= setup.min_lift * (F.col("n0") + 0.5) * held[1]))
    chosen = {bytes(r.gram) for r in lift.orderBy(F.desc("n1"), "gram").limit(setup.most_grams).collect()}
    plain = _window_samples(first, 0, None, setup)
    ordinary = train_dictionary(plain, setup)
    toxic = toxic_dictionary(_window_samples(first, 1, chosen, setup), plain, held, setup)
    model = {"ordinary": ordinary, "toxic": toxic, "level": setup.level, "words": setup.window_words, "share": share}
    second = labelled_sample(docs, labels, label, setup.docs_per_class, 1)
    rows = [r for r in _features(second, model, {"y": F.col("y")}).collect()]
    y = np.array([r.y for r in rows], float)
    if not len(set(y)) == 2:
        rows = _features(first, model, {"y": F.col("y")}).collect()
        y = np.array([r.y for r in rows], float)
    x = np.array([r.f for r in rows], float)
    best = max(THRESHOLDS, key=lambda t: ((x[y == 1, t - 1] > 0).mean() - (x[y == 0, t - 1] > 0).mean(), -t))
    beta = fit_logistic(inputs(x, best), y)
    beta[0] += np.log((share + 1e-6) / (1 - share + 1e-6)) - np.log(y.mean() / (1 - y.mean()))
    return model | {"threshold": best, "beta": beta.tolist()}


def _features(docs: DataFrame, model: dict, keep: dict[str, Column]) -> DataFrame:
    shared, holder = docs.sparkSession.sparkContext.broadcast(model), {}

    def block(texts: list) -> dict:
        m = shared.value
        distance = holder.get("d") or holder.setdefault("d", Distance(m["ordinary"], m["toxic"], m["level"]))
        return {"f": [features(distance.gains(t, m["words"])) for t in texts]}

    return map_texts(docs, block, "f array<double>", keep)


def score(docs: DataFrame, model: dict, keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: the ``keep`` columns (default doc_id), score, predicted, n_windows and n_toxic_windows."""
    shared, holder = docs.sparkSession.sparkContext.broadcast(model), {}

    def block(texts: list) -> dict:
        m = shared.value
        if "beta" not in m:
            n, found, hits = len(texts), [m["share"]] * len(texts), [0] * len(texts)
            return {"score": found, "predicted": [int(m["share"] >= 0.5)] * n, "n_windows": hits, "n_toxic_windows": hits}
        distance = holder.get("d") or holder.setdefault("d", Distance(m["ordinary"], m["toxic"], m["level"]))
        rows = np.array([features(distance.gains(t, m["words"])) for t in texts])
        p = 1 / (1 + np.exp(-np.clip(inputs(rows, m["threshold"]) @ np.array(m["beta"]), -30, 30)))
        return {"score": p.tolist(), "predicted": (p >= 0.5).astype(int).tolist(),
                "n_windows": rows[:, -1].astype(int).tolist(),
                "n_toxic_windows": rows[:, m["threshold"] - 1].astype(int).tolist()}

    return map_texts(docs, block, "score double, predicted int, n_windows long, n_toxic_windows long", keep)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = in_fold(5, 0)
    model = learn(docs.where(~held_out), labels.where(~held_out))
    return score(docs, model, {"doc_id": F.col("doc_id").cast("long"), "held_out": held_out})
