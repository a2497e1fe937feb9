"""Spelling variants of words: all pairs at exactly one edit, found with an index of variable-length grams.

*Dictionary.* Grams of ``shortest`` to ``longest`` letters are counted over the distinct words. All grams of ``shortest``
letters are in the dictionary; a longer one is if the gram without its last letter is frequent (met at over ``common``
places, one of the ``most_grams`` most frequent). So rare grams stay short and frequent ones are made rarer.

*Decomposition.* At each place of a word the longest gram of the dictionary is taken, unless the one before covers it.
For every edit the grams it may affect are bounded: those around it, those left of it that a longer gram could replace,
those right of it that a longer gram could cover. All others are grams of the near word too.

*List merging.* Grams have one order, rarest first. For each edit a word enters the lists of its grams up to the first
one that the edit surely leaves alone: two near words thus share a list, that of the first gram which is left. What lies
on the gram's other side from the edit is equal in both words, so the lists of a gram are split by that text. Words of a
list, at lengths that differ by one at most, are verified letter by letter: those that agree with one letter masked, and
those that are another one with a letter taken out. So a list costs time in proportion to its words, not to its pairs.

*The rest.* A list of over ``dense`` words (of over ``dense_long`` if they have more than ``long`` letters) would take
too much memory; its words, and words so short that an edit may affect all their grams, meet under what is left after
one deletion instead. Such a group is bounded by the alphabet and the length.

The counts are aggregated before they are shuffled; every later step works on distinct words, and no step collects them.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from math import ceil, log2, log10

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, splittable, splittable_on, table

RUN = "[A-Za-zÀ-ÿ]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


@dataclass(frozen=True)
class Setup:
    shortest: int = 3
    longest: int = 4
    common: int = 1000
    most_grams: int = 200_000
    dense: int = 100_000
    long: int = 200
    dense_long: int = 64


def runs(docs: DataFrame, spoil: int | None = None) -> DataFrame:
    """One row per letter run of the texts, A-Z in lower case. With ``spoil``, where the crc32 h of ``<doc_id>:<run>``
    is a multiple of it the letter at h modulo the length is deleted (never in rows without a doc_id)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # lower() would change À to Þ as well: texts with one of them take the slower way
    # (in a step before the explode, or the whole text would be searched once for every run)
    found = docs.select(
        F.col("doc_id").cast("string").alias("id"), text.rlike("[À-Þ]").alias("wide"),
        F.regexp_extract_all(text, F.lit(RUN), F.lit(0)).alias("all")).select("id", "wide", F.explode("all").alias("run"))
    low = F.when(F.col("wide"), F.translate("run", _UPPER, _UPPER.lower())).otherwise(F.lower("run"))
    found = found.select("id", low.alias("word"))
    if spoil is None:
        return found.select("word")
    found = found.select("id", "word", F.crc32(F.concat("id", F.lit(":"), "word")).alias("h"))
    return found.select(F.when(F.col("h") % spoil == 0, F.expr(
        "concat(left(word, int(h % length(word))), substring(word, int(h % length(word)) + 2))")).otherwise(
        F.col("word")).alias("word"))


def word_counts(docs: DataFrame, letters: int = 7, uses: int = 2, spoil: int | None = None) -> DataFrame:
    """The distinct words of at least ``letters`` letters met ``uses`` times or more: word, n."""
    return runs(docs, spoil).where(F.length("word") >= letters).groupBy("word").agg(
        F.count("*").alias("n")).where(F.col("n") >= uses)


def gram_dictionary(words: DataFrame, setup: Setup) -> dict[str, int]:
    """The frequent grams, which longer ones extend, with their counts: at most ``most_grams``. Every prefix of one is one."""
    def count(batches):
        for batch in batches:
            seen = Counter()
            for word in batch.column(0).to_pylist():
                for size in range(setup.shortest, setup.longest):
                    seen.update(word[i:i + size] for i in range(len(word) - size + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["gram", "n"])

    counts = words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    # a prefix is met as often at least and is shorter, so it comes first
    rows = counts.where(F.col("n") > setup.common).orderBy(F.desc("n"), F.length("gram"), "gram").limit(
        setup.most_grams).collect()
    return {r.gram: r.n for r in rows}


def endings(frequent: dict[str, int]) -> set[str]:
    """What follows at least one letter in a frequent gram."""
    return {gram[i:] for gram in frequent for i in range(1, len(gram))}


def decompose(word: str, frequent: dict[str, int], setup: Setup) -> list[tuple[int, int]]:
    """First and last place of the variable-length grams of a word."""
    found, reach, n = [], -1, len(word)
    for at in range(n - setup.shortest + 1):
        end = at + setup.shortest
        while end < n and end - at < setup.longest and word[at:end] in frequent:
            end += 1
        if end - 1 > reach:
            found.append((at, end - 1))
            reach = end - 1
    return found


def affected(word: str, grams: list[tuple[int, int]], frequent: dict[str, int], ends: set[str], setup: Setup) -> list[int]:
    """For every edit the grams it may take away, as bits. Edits: before letter i is 2 i, of letter i 2 i + 1."""
    n = len(word)
    hit = [0] * (2 * n + 1)
    for g, (a, b) in enumerate(grams):
        last = 2 * b + 1  # letters of the gram and the gaps between them
        if b - a + 1 < setup.longest and word[a:b + 1] in frequent:
            last += 2  # another letter behind it may make it longer
        touched = list(range(2 * a + 1, min(last, 2 * n) + 1))
        for i in range(max(b - setup.longest + 1, 0), a + 1):  # a gram that starts earlier may reach over its end
            if word[i:b] in ends:
                touched.append(2 * i)
            if i < a and word[i + 1:b] in ends:
                touched.append(2 * i + 1)
        for i in touched:
            hit[i] |= 1 << g
    return hit


def entries(word: str, frequent: dict[str, int], ends: set[str], setup: Setup) -> tuple[set[tuple[bool, int]], bool]:
    """The lists of a word: (the edit is right of the gram, letters of the gram and its side without the edit); and
    whether some edit may affect every gram."""
    grams = decompose(word, frequent, setup)
    order = sorted(range(len(grams)), key=lambda g: (
        frequent.get(word[grams[g][0]:grams[g][1] + 1], 0), word[grams[g][0]:grams[g][1] + 1], grams[g][0]))
    found, unsure = set(), False
    for edit, hit in enumerate(affected(word, grams, frequent, ends, setup)):
        for g in order:
            a, b = grams[g]
            if edit > 2 * b + 1:
                found.add((True, b + 1))
            elif edit <= 2 * a:
                found.add((False, len(word) - a))
            if not hit >> g & 1:
                break
        else:
            unsure = True
    return found, unsure


def one_edit(a: str, b: str) -> bool:
    """True if exactly one inserted, deleted or replaced code point turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)  # longest common prefix, by halves: slices compare at native speed
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return a[low + (len(a) == len(b)):] == b[low + 1:]


def _hash(right: bool, text: str) -> int:
    h = xxhash.xxh64_intdigest(text, int(right))
    return h - (1 << 64) if h >> 63 else h


_SCHEMA = "key long, size int, shared int, word string"


def _rows(keys: list, sizes: list, shared: list, words: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), pa.array(shared, pa.int32()), pa.array(words, pa.string())],
        names=["key", "size", "shared", "word"])


def _list_entries(words: DataFrame, frequent: dict[str, int], setup: Setup) -> DataFrame:
    """key, size (letters of the word; 0: a word with an edit that may affect all its grams), shared (first letters that
    the words of the list share, last ones if negative) and word."""
    broadcast = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        frequent, ends = broadcast.value, endings(broadcast.value)
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for word in batch.column(0).to_pylist():
                found, unsure = entries(word, frequent, ends, setup)
                for right, n in found:
                    rows[0].append(_hash(right, word[:n] if right else word[-n:]))
                    rows[2].append(n if right else -n)
                rows[1] += [len(word)] * len(found)
                if unsure:
                    rows[0].append(_hash(True, word))
                    rows[1].append(0)
                    rows[2].append(0)
                rows[3] += [word] * (len(found) + unsure)
            yield _rows(*rows)

    return words.select("word").mapInArrow(run, _SCHEMA)


def _deletions(words: DataFrame) -> DataFrame:
    """Every word under its own hash and that of each deletion of one letter."""
    def run(batches):
        for batch in batches:
            for word in batch.column(0).to_pylist():
                before, power = [0], [1]
                for c in word:
                    before.append((before[-1] * _BASE + ord(c)) % _PRIME)
                    power.append(power[-1] * _BASE % _PRIME)
                n, whole = len(word), before[-1]
                # hash of word[:i] + word[i + 1:], from the hashes of both parts
                keys = {((before[i] - before[i + 1]) * power[n - i - 1] + whole) % _PRIME for i in range(n)} | {whole}
                yield _rows(list(keys), [n] * len(keys), [0] * len(keys), [word] * len(keys))

    return words.select("word").mapInArrow(run, _SCHEMA)


class _List:
    """The words of one list, in order of length: those of the present length and of one letter less."""

    def __init__(self, key, setup: Setup, emit):
        self.key, self.setup, self.emit, self.size = key, setup, emit, -1
        self.before, self.now, self.masked, self.before_crowded, self.crowded = set(), set(), {}, False, False

    def add(self, size: int, shared: int, word: str, limited: bool) -> None:
        if size != self.size:
            follows = size == self.size + 1
            self.before, self.before_crowded = (self.now, self.crowded) if follows else (set(), False)
            self.size, self.now, self.masked, self.crowded = size, set(), {}, False
        long = size > self.setup.long
        most = self.setup.dense_long if long else self.setup.dense
        if limited and not self.crowded and len(self.before) + len(self.now) >= most:
            for other in (*self.before, *self.now):
                self.emit(other, None)
            self.before, self.now, self.masked, self.crowded = set(), set(), {}, True
        if self.crowded or self.before_crowded:
            self.emit(word, None)
        if self.crowded or word in self.now:
            return
        if long:
            for other in (*self.before, *self.now):
                if one_edit(other, word):
                    self.emit(other, word)
        else:
            for i in range(max(shared, 0), size + min(shared, 0)):  # the edit is not in the shared letters
                left, right = word[:i], word[i + 1:]
                if left + right in self.before:
                    self.emit(left + right, word)
                group = self.masked.setdefault(left + "\0" + right, [])
                for other in group:
                    self.emit(other, word)
                group.append(word)
        self.now.add(word)


def _meet(rows: DataFrame, setup: Setup, limited: bool = True) -> DataFrame:
    """Verified pairs (a, b) of words that meet under a key; rows (a, null) for the words of crowded lists and unsure
    words. A task reads its lists one after another."""
    def run(batches):
        pairs: dict = {}

        def emit(a, b):
            pairs[(a, b) if b is None or a < b else (b, a)] = None

        current = _List(None, setup, emit)
        for batch in batches:
            for key, size, shared, word in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if key != current.key:
                    current = _List(key, setup, emit)
                if size:
                    current.add(size, shared, word, limited)
                else:
                    emit(word, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in pairs], pa.string()), pa.array([b for _, b in pairs], pa.string())], names=["a", "b"])
            pairs.clear()

    return rows.repartition("key").sortWithinPartitions("key", "size", "word").mapInArrow(run, "a string, b string")


def near_words(words: DataFrame, setup: Setup = Setup()) -> DataFrame:
    """All pairs a < b of the distinct words (column word) at exactly one edit."""
    met = cut(_meet(_list_entries(words, gram_dictionary(words, setup), setup), setup))
    rest = met.where("b IS NULL").select(F.col("a").alias("word")).distinct()
    return cut(met.where("b IS NOT NULL").union(_meet(_deletions(rest), setup, limited=False)).distinct())


def _joined(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``right`` has one row per word; joined on the word that ``key`` names."""
    side = splittable(right, "word")
    return left.join(side, splittable_on(left, key), how).drop("_right_key", "_right_hash")


def variants(words: DataFrame, factor: int = 10, setup: Setup = Setup()) -> DataFrame:
    """One row per word of ``words`` (distinct word, n): word, n, n_near, form, form_n, root.

    n_near counts the near words. The form is the near word of largest n (ties: smallest in code-point order) if that n
    is ``factor`` times the word's n or more. The root is reached by following forms; the word itself if it has none.
    No words give no rows."""
    words = cut(words.select("word", "n"))
    pairs = near_words(words, setup)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).union(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    best = _joined(both, words.withColumnRenamed("n", "near_n"), "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("top"))
    best = best.select(F.col("word").alias("_word"), "n_near", F.col("top.near").alias("near"), (-F.col("top.minus")).alias("near_n"))
    formed = F.col("near_n") >= factor * F.col("n")
    found = cut(words.join(best, words["word"] == best["_word"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n")))
    # n grows by the factor with every form: chains are short, and each round doubles the way
    roots = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = words.agg(F.max("n")).first()[0] or 1
    for _ in range(ceil(log2(max(2, log10(most) / log10(factor) + 1)))):
        roots = cut(roots)
        onward = roots.select("word", F.col("root").alias("next"))
        roots = _joined(roots, onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    roots = roots.withColumnRenamed("word", "_word")
    return found.join(roots, found["word"] == roots["_word"], "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    """Null and empty texts have no words, repeated rows count each time, other columns are not read."""
    found = variants(word_counts(table(spark, sf_dir, "documents"), spoil=31))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
