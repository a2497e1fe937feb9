"""Language identification, word first: known words score by their log frequency per language, unseen words by the
longest known character n-grams.

*Learning.* From a bounded sample of documents per language (``ModelSize.docs_per_lang``, the documents of smallest id
hash; texts are taken whole) Spark counts words per language and character n-grams of lengths 5 to 1 over words with
marked ends. The model keeps the ``words`` and ``ngrams`` most frequent ones per language, so its size is bounded and it
can be broadcast whatever the corpus.

*Prediction.* A word that the model knows adds its smoothed log frequency in each language. Any other word is read with
n-grams of the longest length of which it holds a known one, else with the next shorter. The language of the highest
sum wins (ties: the alphabetically first); the score is its posterior, with evidence averaged over words and scaled.
Texts that are null or have no letter are ``und`` with score 0, as are all texts if nothing could be learned.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import TwoGenerations, in_fold, map_texts, smallest_hashes, table

UNDETERMINED = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class ModelSize:
    docs_per_lang: int = 1500
    words: int = 20_000
    ngrams: int = 8_000
    longest: int = 5


def word_letters(chunk: str) -> list[str]:
    return _LETTERS.findall(chunk.lower())


def _counts(texts: list, langs: list, longest: int) -> dict:
    """Counts of (lang, length, gram) in a block; length 0 marks whole words."""
    found: dict = {}
    for text, lang in zip(texts, langs):
        for word in word_letters((text or b"").decode("utf-8", "replace")):
            found[lang, 0, word] = found.get((lang, 0, word), 0) + 1
            marked = f"^{word}$"
            for n in range(1, longest + 1):
                for i in range(len(marked) - n + 1):
                    key = (lang, n, marked[i:i + n])
                    found[key] = found.get(key, 0) + 1
    return found


def learn(docs: DataFrame, size: ModelSize = ModelSize()) -> dict:
    """The model from columns doc_id, text and lang; rows without a language teach nothing."""
    import pyarrow as pa
    labelled = docs.where("lang IS NOT NULL").select("doc_id", "text", "lang")
    chosen = smallest_hashes(labelled.select("doc_id", "lang").distinct(), "lang", "doc_id", size.docs_per_lang).select(
        "doc_id", "lang")
    # docs_per_lang ids per language: a bound set by a parameter, so the texts need no shuffle
    sample = labelled.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select(
        F.col("lang"), F.col("text").cast("binary").alias("text"))

    def count(batches):
        for batch in batches:
            found = _counts(batch.column(1).to_pylist(), batch.column(0).to_pylist(), size.longest)
            rows = list(found)
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                pa.array([r[2] for r in rows], pa.string()), pa.array(list(found.values()), pa.int64())],
                names=["lang", "n", "gram", "c"])

    counts = sample.mapInArrow(count, "lang string, n int, gram string, c long").groupBy("lang", "n", "gram").agg(
        F.sum("c").alias("c"))
    most = F.when(F.col("n") == 0, size.words).otherwise(size.ngrams)
    rank = F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("c"), "gram"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= max(size.words, size.ngrams)).where(F.col("rank") <= most)
    rows = [(r.lang, r.n, r.gram, r.c) for r in top.select("lang", "n", "gram", "c").toLocalIterator()]
    return build(rows, size.longest)


def build(rows: list[tuple], longest: int) -> dict:
    """Log frequencies (one vector over languages per word and n-gram), smoothed by half an occurrence."""
    langs = sorted({r[0] for r in rows})
    at = {lang: i for i, lang in enumerate(langs)}
    grams: list[dict] = [{} for _ in range(longest + 1)]
    for lang, n, gram, c in rows:
        grams[n].setdefault(gram, np.zeros(len(langs)))[at[lang]] += c
    model = {"langs": langs, "grams": []}
    for found in grams:
        if not found:
            model["grams"].append(({}, np.zeros((0, len(langs)))))
            continue
        table_ = np.array(list(found.values())) + 0.5
        model["grams"].append((dict(zip(found, range(len(found)))), np.log(table_ / table_.sum(axis=0))))
    return model


class Scorer:
    """Evidence per language of text parts without ASCII white space, remembered as rows of one matrix."""

    def __init__(self, model: dict, most_cached: int = 400_000, scale: float = 6.0):
        self.langs, self.scale, self.most = model["langs"], scale, most_cached
        self.tables = [(index, logs.tolist()) for index, logs in model["grams"]]
        self.none = [0.0] * len(self.langs)
        self.word = TwoGenerations(self._word, most_cached)
        self.index: dict[bytes, int] = {}
        self.rows = np.zeros((1 << 16, len(self.langs) + 1))

    def _word(self, word: str) -> list[float]:
        index, logs = self.tables[0]
        if (i := index.get(word)) is not None:
            return logs[i]
        marked = f"^{word}$"
        for n in range(len(self.tables) - 1, 0, -1):
            index, logs = self.tables[n]
            known = [logs[j] for i in range(len(marked) - n + 1) if (j := index.get(marked[i:i + n])) is not None]
            if known:
                return known[0] if len(known) == 1 else [sum(v) / len(known) for v in zip(*known)]
        return self.none

    def _add(self, chunk: bytes) -> None:
        found = list(map(self.word, word_letters(chunk.decode("utf-8", "replace"))))
        at = len(self.index)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at, 0] = len(found)
        self.rows[at, 1:] = found[0] if len(found) == 1 else [sum(v) for v in zip(*found)] if found else self.none
        self.index[chunk] = at

    def predict(self, text: bytes | None) -> tuple[str, float]:
        words = (text or b"").split()
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        if len(self.index) > self.most:
            self.index.clear()
        for chunk in set(words).difference(self.index):
            self._add(chunk)
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        totals = self.rows.take(at, axis=0).sum(axis=0)
        if not totals[0]:
            return UNDETERMINED, 0.0
        mean = totals[1:] / totals[0] * self.scale * min(totals[0], 20.0) ** 0.5
        odds = np.exp(mean - mean.max())
        best = int(np.argmax(mean))
        return self.langs[best], float(odds[best] / odds.sum())


def identify(docs: DataFrame, model: dict, keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: the ``keep`` columns (default doc_id), lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    holder: dict = {}

    def block(texts: list) -> dict:
        scorer = holder.get("scorer") or holder.setdefault("scorer", Scorer(shared.value))
        found = [scorer.predict(t) for t in texts]
        return {"lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    return map_texts(docs, block, "lang_pred string, score double", keep)


def op5_langid(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~in_fold(4, 2)))
    return identify(docs, model, {"doc_id": F.col("doc_id").cast("long"), "held_out": in_fold(4, 2)})
