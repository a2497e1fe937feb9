"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

Each document is a bag of passages of ``Setup.passage_words`` words. A passage is described by hashed word shapes
(letters become ``x`` or ``X``, digits ``9``, runs are shortened, other characters stay), the share of new words, the
mean word length and the share of words already seen in the document. A tanh layer encodes every passage, gated
attention (a tanh and a sigmoid gate) weighs them, and the weighted mean representation gives the score. All weights are
learned together from document labels only.

Learning uses a bounded sample of labelled documents (``Setup.docs_per_class`` of smallest id hash per class, whole
texts); the intercept is corrected for the share of the class among all labels. Null and empty texts are one empty
passage. Without labels of both classes every score is the share of label 1 (1.0 without labels: nothing is rejected).
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import TwoGenerations, in_fold, labelled_sample, map_texts, table

_RULES = [(re.compile(p), r) for p, r in (
    ("[^\\W\\d_]", lambda m: "X" if m[0].isupper() else "x"), ("\\d", "9"), ("(.)\\1+", "\\1"))]


@dataclass(frozen=True)
class Setup:
    docs_per_class: int = 1000
    passage_words: int = 64
    buckets: int = 64
    hidden: int = 16
    attention: int = 8
    rounds: int = 250
    rate: float = 0.03
    decay: float = 1e-3
    #: Scores from here on count as good quality.
    threshold: float = 0.3


def shape_bucket(word: bytes, buckets: int) -> int:
    shape = word.decode("utf-8", "replace")
    for pattern, by in _RULES:
        shape = pattern.sub(by, shape)
    return zlib.crc32(shape[:12].encode()) % buckets


class Passages:
    """Feature rows of the passages of a text."""

    def __init__(self, setup: Setup, most_cached: int = 300_000):
        self.setup = setup
        self.shape = TwoGenerations(lambda w: shape_bucket(w, setup.buckets), most_cached)

    def __call__(self, text: bytes | None) -> np.ndarray:
        setup, words = self.setup, (text or b"").split()
        n, size = len(words), setup.passage_words
        if not n:
            return np.zeros((1, setup.buckets + 3), np.float32)
        count = -(-n // size)
        place = np.arange(n) // size
        rows = np.fromiter(map(self.shape, words), np.int64, n)
        total = np.bincount(place, minlength=count).astype(float)
        out = np.empty((count, setup.buckets + 3), np.float32)
        shares = np.bincount(place * setup.buckets + rows, minlength=count * setup.buckets)
        out[:, :-3] = np.sqrt(shares.reshape(count, -1) / total[:, None])
        known: dict = {}
        first = np.fromiter((known.setdefault(w, i) for i, w in enumerate(words)), np.int64, n)
        out[:, -3] = np.bincount(place, first == np.arange(n), count) / total
        out[:, -2] = np.bincount(place, np.fromiter(map(len, words), float, n), count) / total / 10
        out[:, -1] = np.bincount(place, first < place * size, count) / total
        return out


class Network:
    """Tanh encoder, gated attention and a logistic output; bags are consecutive rows, given by their first rows."""

    def __init__(self, weights: dict):
        self.w = weights

    @staticmethod
    def start(inputs: int, setup: Setup) -> "Network":
        rng, h, a = np.random.default_rng(7), setup.hidden, setup.attention
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        return Network({"enc": draw(inputs, h), "enc0": np.zeros(h), "tan": draw(h, a), "gate": draw(h, a),
                        "att": draw(a), "out": draw(h), "out0": np.zeros(1)})

    def forward(self, x: np.ndarray, starts: np.ndarray):
        w, counts = self.w, np.diff(np.append(starts, len(x)))
        bag = np.repeat(np.arange(len(starts)), counts)
        h = np.tanh(x @ w["enc"] + w["enc0"])
        t, g = np.tanh(h @ w["tan"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        s = (t * g) @ w["att"]
        e = np.exp(s - np.maximum.reduceat(s, starts)[bag])
        alpha = e / np.add.reduceat(e, starts)[bag]
        z = np.add.reduceat(alpha[:, None] * h, starts, axis=0)
        p = 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out0"], -30, 30)))
        return p, (bag, h, t, g, alpha, z)

    def gradients(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        w = self.w
        p, (bag, h, t, g, alpha, z) = self.forward(x, starts)
        d = (p - y) * weight
        dz = d[:, None] * w["out"]
        dh = alpha[:, None] * dz[bag]
        da = (h * dz[bag]).sum(axis=1)
        ds = alpha * (da - np.add.reduceat(alpha * da, starts)[bag])
        du = ds[:, None] * w["att"]
        dt, dg = du * g * (1 - t * t), du * t * g * (1 - g)
        dh = (dh + dt @ w["tan"].T + dg @ w["gate"].T) * (1 - h * h)
        return {"enc": x.T @ dh, "enc0": dh.sum(axis=0), "tan": h.T @ dt, "gate": h.T @ dg,
                "att": (t * g).T @ ds, "out": z.T @ d, "out0": d.sum(keepdims=True)}

    def fit(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray, setup: Setup) -> None:
        """Adam over the whole sample; both classes weigh the same."""
        weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
        m, v = ({k: np.zeros_like(a) for k, a in self.w.items()} for _ in range(2))
        for i in range(1, setup.rounds + 1):
            for k, grad in self.gradients(x, starts, y, weight).items():
                grad = grad + setup.decay * self.w[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                self.w[k] = self.w[k] - setup.rate * (m[k] / (1 - 0.9 ** i)) / (np.sqrt(v[k] / (1 - 0.999 ** i)) + 1e-8)


def _bags(docs: DataFrame, setup: Setup, keep: dict[str, Column]) -> DataFrame:
    holder: dict = {}

    def block(texts: list) -> dict:
        passages = holder.get("p") or holder.setdefault("p", Passages(setup))
        return {"bag": [passages(t).astype("<f4").tobytes() for t in texts]}

    return map_texts(docs, block, "bag binary", keep)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", setup: Setup = Setup()) -> dict:
    """The model; ``labels`` has doc_id and a column of 0 and 1 (other values and nulls teach nothing)."""
    counts = {r.y: r.n for r in labels.where(F.col(label).isin(0, 1)).groupBy(
        F.col(label).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / sum(counts.values()) if counts else 1.0
    sample = labelled_sample(docs, labels, label, setup.docs_per_class, 0)
    rows = _bags(sample, setup, {"y": F.col("y")}).collect() if len(counts) == 2 else []
    y = np.array([r.y for r in rows], float)
    if len(set(y)) < 2:
        return {"share": share, "setup": setup}
    bags = [np.frombuffer(r.bag, "<f4").reshape(-1, setup.buckets + 3) for r in rows]
    starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
    x = np.concatenate(bags).astype(float)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    network = Network.start(x.shape[1], setup)
    network.fit((x - mean) / scale, starts, y, setup)
    network.w["out0"] = network.w["out0"] + np.log((share + 1e-6) / (1 - share + 1e-6))
    return {"share": share, "setup": setup, "weights": network.w, "mean": mean, "scale": scale}


def score(docs: DataFrame, model: dict, keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: the ``keep`` columns (default doc_id), score, predicted, n_passages and top_passage (the
    number, from 0, of the passage with most attention)."""
    shared, holder = docs.sparkSession.sparkContext.broadcast(model), {}

    def block(texts: list) -> dict:
        m = shared.value
        setup = m["setup"]
        if "weights" not in m:
            n = len(texts)
            return {"score": [m["share"]] * n, "predicted": [int(m["share"] >= setup.threshold)] * n,
                    "n_passages": [0] * n, "top_passage": [0] * n}
        passages = holder.get("p") or holder.setdefault("p", Passages(setup))
        bags = [passages(t) for t in texts]
        starts = np.cumsum([0] + [len(b) for b in bags[:-1]])
        p, (_, _, _, _, alpha, _) = Network(m["weights"]).forward(
            (np.concatenate(bags) - m["mean"]) / m["scale"], starts)
        ends = np.append(starts[1:], len(alpha))
        return {"score": p.tolist(), "predicted": (p >= setup.threshold).astype(int).tolist(),
                "n_passages": [len(b) for b in bags],
                "top_passage": [int(alpha[a:b].argmax()) for a, b in zip(starts, ends)]}

    return map_texts(docs, block, "score double, predicted int, n_passages long, top_passage long", keep)


def op7_mil_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = in_fold(5, 0)
    model = learn(docs.where(~held_out), labels.where(~held_out))
    return score(docs, model, {"doc_id": F.col("doc_id").cast("long"), "held_out": held_out})
