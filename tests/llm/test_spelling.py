import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import spelling


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, factor=10):
    words, out = list(counts), {}
    near = {w: [v for v in words if is_near(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= factor * counts[w] else None
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root)
    return sorted(out.values())


def random_words(n, seed, letters="abé", least=7, most=11):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(least, most))): rng.choice([2, 3, 30, 400, 5000])
             for _ in range(n)}
    return words


SETUPS = [spelling.Setup(), spelling.Setup(shortest=2, longest=5, common=3), spelling.Setup(2, 6, 20, 50, 4, 9, 2),
          spelling.Setup(3, 5, 5, dense=8), spelling.Setup(4, 4)]


@pytest.mark.parametrize("setup", SETUPS)
def test_variants_equal_brute_force(spark, setup):
    counts = random_words(500, 1)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = spelling.variants(words, setup=setup).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(map(tuple, got)) == brute(counts)


@pytest.mark.parametrize("setup", SETUPS)
def test_near_words_share_a_list_or_are_unsure(setup):
    """The bound of affected grams: whatever the edit, a list of one word is one of the other, unless both are unsure."""
    rng = random.Random(2)
    words = list(random_words(300, 3))
    seen = Counter(w[i:i + q] for w in words for q in range(setup.shortest, setup.longest) for i in range(len(w) - q + 1))
    frequent = {g: n for g, n in seen.items() if n > setup.common}
    frequent = {g: n for g, n in frequent.items() if all(g[:i] in frequent for i in range(setup.shortest, len(g)))}
    ends = spelling.endings(frequent)

    def lists(word):
        found, unsure = spelling.entries(word, frequent, ends, setup)
        return {(right, word[:n] if right else word[-n:]) for right, n in found}, unsure

    for word in words:
        at = rng.randrange(len(word))
        for other in (word[:at] + word[at + 1:], word[:at] + rng.choice("abéz") + word[at + 1:], word[:at] + rng.choice("abéz") + word[at:]):
            if other != word:
                (a, unsure), (b, other_unsure) = lists(word), lists(other)
                assert a & b or (unsure and other_unsure)


def test_one_edit():
    words = list(random_words(120, 4, "ab", 1, 5)) + ["", "a"]
    assert all(spelling.one_edit(a, b) == is_near(a, b) for a in words for b in words)


def test_long_words(spark):
    long = "abcdefghij" * 3000
    words = {long: 100, long[:77] + long[78:]: 5, long[:99] + "x" + long[100:]: 2, long + "yy": 2}
    got = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    assert {r.word: r.n_near for r in got} == {w: {100: 2}.get(n, 1 if n == 5 or "x" in w else 0) for w, n in words.items()}


def spoiled(doc_id, text, spoil=31):
    for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
        run = "".join(c.lower() if c.isascii() else c for c in run)
        h = zlib.crc32(f"{doc_id}:{run}".encode())
        if doc_id is not None and h % spoil == 0:
            run = run[:h % len(run)] + run[h % len(run) + 1:]
        yield run


def test_words_of_documents(spark, edge, no_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").union(
        edge.select("doc_id", "text")).union(spark.createDataFrame([(9, "ÀÉÎ K Älteste ÄLTESTE İstanbul naïve×÷")], "doc_id long, text string"))
    rows = docs.collect()
    for spoil in (31, 2):
        counts = Counter(w for r in rows for w in spoiled(r.doc_id, r.text, spoil))
        want = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
        assert {r.word: r.n for r in spelling.word_counts(docs, spoil=spoil).collect()} == want
    plain = Counter(w for r in rows for w in spoiled(None, r.text))
    assert {r.word: r.n for r in spelling.runs(docs).groupBy("word").agg(F.count("*").alias("n")).collect()} == plain
    assert spelling.variants(spelling.word_counts(no_docs)).count() == 0


def test_query_equals_brute_force(spark):
    counts = Counter(w for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
                     for w in spoiled(r.doc_id, r.text))
    want = brute({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})
    got = spelling.op11_spelling(spark, "/root/testdata/sf0.001")
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.select("word", "n", "n_near", "form", "form_n", "root").collect())) == want
