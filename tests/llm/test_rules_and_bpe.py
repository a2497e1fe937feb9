import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import bpe, quality_rules

EDGE_ROWS = 10


def brute_repeats(words, size=8):
    windows = [tuple(words[i:i + size]) for i in range(len(words) - size + 1)]
    often = Counter(windows)
    return len({j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + size)})


def test_repeated_window_words_by_brute_force():
    draw = random.Random(1)
    for n in (0, 1, 7, 8, 9, 16, 40, 200):
        for letters in (1, 2, 5):
            words = [draw.randrange(letters) for _ in range(n)]
            assert quality_rules.repeated_window_words(np.array(words, np.int64)) == brute_repeats(words)


@pytest.mark.parametrize("line, fails", [
    ("A plain sentence of prose.", False), ("of%%% the&&& er***", True), ("Home | News | Sport | More", True),
    ("WORDS!! SHOUTED!! HERE!!", True), ("We use cookies on this site.", True), ("word " * 40, True),
    ("a list of a few words", False), ("if (a > b) { return 1; }", False)])
def test_line_rules(line, fails):
    data = line.encode()
    assert quality_rules.line_fails(data, data.split(), quality_rules.LineRules()) is fails


def test_clean_lines_edge_cases(spark, edge, no_docs):
    found = quality_rules.clean_lines(edge)
    rows = found.collect()
    assert found.columns[0] == "doc_id" and len(rows) == EDGE_ROWS
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].n_words == by_id[4].n_words == by_id[6].n_words == 0 and by_id[3].base_failed
    assert by_id[5].n_repeat_words == by_id[5].n_words == 20_000 and not by_id[5].kept
    assert by_id[8].word_chars == 60_000
    assert by_id[7].word_chars == sum(map(len, "été 漢字 😀 é x <|endoftext|> Σς".split(" ")))
    assert quality_rules.clean_lines(no_docs).count() == 0


def test_cleaned_text_loses_failing_lines_only(spark):
    text = "A good line of prose stays.\n\nHome | News | Sport | More\nA good line of prose stays.\nLast line."
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = quality_rules.clean_lines(docs).first()
    assert row.clean_text == "A good line of prose stays.\n\nLast line."
    assert (row.n_dup_lines, row.n_failed_lines, row.n_lines) == (1, 2, 4)


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(bpe.default_path(), most_cached=500)


def test_bpe_equals_the_library(library, own):
    draw = random.Random(3)
    letters = "aAbBzZeTtHh  \t\n'’éÉÈßΣσς1234567890²½١<|>!?.,-_「漢字カナ́  \x1c\x85😀👍🏽İıǅﬁ"
    texts = ["", " ", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>c", "<|END|><|endoftext|", "x" * 3000,
             "ΑΣ ΟΔΟΣ", "don't they'll I'M we've", "ab" * 700 + " " + "ab" * 700, " ", "The the THE"]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randrange(80))) for _ in range(3000)]
    for start in range(0, len(texts), 100):
        part = texts[start:start + 100]
        for text, (ids, decoded) in zip(part, own.encode_block([t.encode() for t in part])):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want, text
            assert decoded == library.decode(want, skip_special_tokens=False) == own.decode(want)


def test_pair_trees_find_the_leftmost_lowest():
    draw = np.random.default_rng(0)
    leaves = draw.integers(0, 5, (50, 16)).astype(np.int32)
    trees, rows = bpe.PairTrees(leaves.copy()), np.arange(50)
    for _ in range(40):
        assert (trees.leftmost(rows, trees.roots(rows)) == leaves.argmin(axis=1)).all()
        at, new = draw.integers(0, 16, 50), draw.integers(0, 9, 50).astype(np.int32)
        leaves[rows, at] = new
        trees.set(rows, at, new)


def test_encode_edge_cases_and_round_trip(spark, edge, no_docs, library):
    rows = bpe.encode_digests(edge).collect()
    assert len(rows) == EDGE_ROWS
    by_id = {r.doc_id: r for r in rows}
    empty = hashlib.sha256(b"").hexdigest()
    assert by_id[3][1:] == by_id[4][1:] == (0, empty, empty)
    ids = library.encode("x" * 60_000, add_special_tokens=False).ids
    assert by_id[8].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    encoded = bpe.encode(edge)
    assert bpe.decode(encoded.drop("decoded")).exceptAll(encoded).count() == 0
    with_ids = {r.doc_id: r.ids for r in bpe.encode_digests(edge, with_ids=True).collect()}
    assert with_ids[8] == ids
    assert bpe.encode_digests(no_docs).count() == 0
