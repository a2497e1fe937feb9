import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_dedup import brute_fingerprint, groups
from tidemark.llm import near_copies


def brute_set(text, size=5):
    words = text.lower().split()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def corpus(seed):
    """Texts with one to nine words changed, a crowd around one text, a common line, short and wordless texts."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(5000)}"
    line = " ".join(word() for _ in range(12))
    out = []
    for _ in range(25):
        base = [word() for _ in range(draw.choice([8, 40, 150, 300]))]
        for changes in (0, 1, 3, 6, 9):
            words = list(base)
            for at in draw.sample(range(len(base)), min(changes, len(base))):
                words[at] = word()
            out.append(" ".join(words))
    crowd = [word() for _ in range(90)]
    for _ in range(60):
        words = list(crowd)
        for at in draw.sample(range(90), draw.randrange(5)):
            words[at] = word()
        out.append(" ".join(words))
    out += [line + " " + " ".join(word() for _ in range(draw.randrange(30))) for _ in range(60)]
    out += ["a b", "A  b", "", " \t", "c"]
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("seed, dense, sampled, common", [(1, 64, 16, 4), (2, 5, 1, 3), (3, 2, 1, 2), (4, 64, 1, 1)])
def test_groups_equal_brute_force_jaccard(spark, seed, dense, sampled, common):
    texts = corpus(seed)
    sets = [brute_set(t) for t in texts]
    want = groups(range(len(texts)), lambda a, b: similar(sets[a], sets[b]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id for r in near_copies.one_of_each_group(docs, dense=dense, sampled=sampled, common=common).collect()}
    assert got == {i for i, least in want.items() if i == least}


def test_pairs_by_fingerprint_are_confirmed_first(spark, monkeypatch):
    """What pigeonring over five-word fingerprints links is connected by pairs, and all of them are in the first round."""
    texts = [t for t in dict.fromkeys(corpus(8)) if t.strip()]
    prints = [brute_fingerprint(t, 5) for t in texts]
    want = groups(range(len(texts)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert len(set(want.values())) < len(want)
    rows = [(i + 1, i + 1, t.encode()) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[0], (0, 99, b"")], "node long, id long, text binary")
    pairs = {(r.u - 1, r.v - 1) for r in near_copies.fingerprint_pairs(docs, 5).collect()}
    assert groups(range(len(texts)), lambda a, b: (min(a, b), max(a, b)) in pairs) == want
    first, confirmed = [], near_copies.confirmed
    monkeypatch.setattr(near_copies, "confirmed", lambda rows, *rest: first.append({(r.u - 1, r.v - 1) for r in rows.collect()})
                        or confirmed(rows, *rest))
    near_copies.links(docs)
    assert pairs <= first[0]


def test_stage_takes_copies_with_changed_words(spark):
    draw = random.Random(7)
    base = [f"w{draw.randrange(9000)}" for _ in range(300)]
    texts = [" ".join(base)]
    for changes in (1, 3, 6):
        texts.append(" ".join("new" if i in range(20, 20 + 40 * changes, 40) else w for i, w in enumerate(base)))
    texts.append(" ".join("new" if i % 10 == 0 else w for i, w in enumerate(base)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.one_per_group(spark, docs, "").collect()) == [0, 4]


def test_sets_of_enough_similarity_agree_in_a_part():
    draw = np.random.default_rng(5)
    for n in [1, 2, 3, 4, 5, 6, 7, 9, 12, 20, 33, 60, 150, 400] * 8:
        differ = int(0.2 / 1.8 * 2 * n)
        while True:
            gone, new = draw.integers(0, differ + 1), draw.integers(0, differ + 1)
            if gone < n and (n - gone) >= 0.8 * (n + new):
                break
        a = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[gone:], draw.integers(0, 1 << 63, new, dtype=np.uint64)]))
        assert set(near_copies.part_keys(a, 0.8).tolist()) & set(near_copies.part_keys(b, 0.8).tolist())


def test_common_lines_make_no_pairs(spark):
    """Texts of ten lines from a stock of 200 share whole lines without being similar: candidates follow their number."""
    met = []
    for n in (500, 2000):
        draw = random.Random(n)
        stock = [" ".join(f"w{draw.randrange(4000)}" for _ in range(30)) for _ in range(200)]
        texts = [" ".join(draw.sample(stock, 10)) for _ in range(n)]
        docs = spark.createDataFrame([(i, i, t.encode()) for i, t in enumerate(texts)], "node long, id long, text binary")
        known = near_copies.frequent_hashes(docs, 5)
        keys = near_copies.candidate_keys(docs, known, 5, 0.8)
        met.append(near_copies._walk(keys, 0.8, 64, 4).count())
    assert met[1] < 5 * met[0] + 2000


def test_similar_sets_share_enough_first_hashes():
    draw = np.random.default_rng(6)
    for _ in range(400):
        n = int(draw.integers(1, 80))
        a = set(draw.integers(0, 500, n).tolist())
        b = {x for x in a if draw.random() > 0.1} | set(draw.integers(0, 500, int(draw.integers(0, 1 + n // 8))).tolist())
        if b and 5 * len(a & b) >= 4 * len(a | b):
            first = [set(sorted(s)[:len(s) - -(-4 * len(s) // 5) + 1]) for s in (a, b)]
            assert len(first[0] & first[1]) >= near_copies.fewest(len(a), len(b), 0.8)


def around_one_passage(seed):
    """Texts of one long common passage, whole or with a gap, and a rest of their own of few to many words."""
    draw = random.Random(seed)
    passage = [f"p{i}" for i in range(100)]
    out = []
    for i in range(300):
        rest = [f"r{i}x{j}" for j in range(draw.choice([1, 3, 6, 9, 12, 14, 18, 22, 60]))]
        gap = draw.choice([0, 0, 1, 3, 8])
        at = draw.randrange(20, 80)
        out.append(" ".join(passage[:at] + passage[at + gap:] + rest))
    return out


@pytest.mark.parametrize("seed, dense, sampled, common", [(1, 64, 1, 4), (2, 4, 1, 4), (3, 16, 1, 3)])
def test_texts_around_one_passage_equal_brute_force(spark, seed, dense, sampled, common):
    texts = around_one_passage(seed)
    sets = [brute_set(t) for t in texts]
    want = groups(range(len(texts)), lambda a, b: similar(sets[a], sets[b]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id for r in near_copies.one_of_each_group(docs, dense=dense, sampled=sampled, common=common).collect()}
    assert got == {i for i, least in want.items() if i == least}


def test_a_shared_passage_makes_no_pairs(spark):
    """Texts of one passage and more words of their own than similarity allows: rows go on in proportion to their number."""
    met = []
    for n in (500, 2000):
        passage = " ".join(f"p{i}" for i in range(90))
        texts = [passage + " " + " ".join(f"r{i}x{j}" for j in range(9 + i % 8)) for i in range(n)]
        docs = spark.createDataFrame([(i, i, t.encode()) for i, t in enumerate(texts)], "node long, id long, text binary")
        keys = near_copies.candidate_keys(docs, near_copies.frequent_hashes(docs, 5), 5, 0.8)
        met.append(near_copies._walk(keys, 0.8, 64, 4).count())
    assert met[1] < 5 * met[0] + 2000


def test_sketches_differ_in_no_more_bins_than_sets_in_hashes():
    draw = np.random.default_rng(9)
    for n in (1, 2, 30, 300, 5000) * 20:
        a = np.unique(draw.integers(0, 1 << 48, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[draw.integers(0, len(a)):], draw.integers(0, 1 << 48, n // 5, dtype=np.uint64)]))
        bins = sum(int(x ^ y).bit_count() for x, y in zip(*(near_copies.sketch(s).view(np.uint64) for s in (a, b))))
        assert bins <= len(np.setxor1d(a, b))
    assert near_copies.sketch(np.zeros(0, np.uint64)).tolist() == [0] * (near_copies.SKETCH // 64)


def loosely_edited(n):
    """Copies of one text with a tenth of the words changed: all are near the same text, none is near another copy."""
    draw = random.Random(n)
    out = []
    for i in range(n):
        words = [f"b{k}" for k in range(150)]
        for at in draw.sample(range(150), 12):
            words[at] = f"e{i}x{at}"
        out.append(" ".join(words))
    return out


def test_sketches_leave_out_pairs_of_loosely_edited_copies(spark):
    """Of all pairs of a crowded group, few pass the sketches, and every similar one does."""
    texts = loosely_edited(300) + [" ".join(f"b{k}" for k in range(150 - i)) for i in range(4)]
    found = [near_copies.packed(near_copies.shingle_set(t.encode(), 5)) for t in texts]
    rows = [(i, len(f) // 6, near_copies.sketch(near_copies.unpacked(f)).tolist()) for i, f in enumerate(found)]
    frame = spark.createDataFrame(rows, "node long, size int, sketch array<long>")
    met = {(r[0], r[1]) for r in frame.alias("a").join(frame.alias("b"), on=F.col("a.node") < F.col("b.node")).where(
        near_copies._alike("a", "b", 0.8)).select("a.node", "b.node").collect()}
    sets = [brute_set(t) for t in texts]
    near = {(i, j) for j in range(len(texts)) for i in range(j) if similar(sets[i], sets[j])}
    assert near and near <= met
    assert len(met) < 0.01 * len(texts) ** 2 / 2 + len(near)


@pytest.mark.parametrize("dense", [8, 64])
def test_loosely_edited_copies_equal_brute_force(spark, dense):
    texts = loosely_edited(150) + [" ".join(f"b{k}" for k in range(150 - i)) for i in (0, 20, 40)]
    sets = [brute_set(t) for t in texts]
    want = groups(range(len(texts)), lambda a, b: similar(sets[a], sets[b]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id for r in near_copies.one_of_each_group(docs, dense=dense, sampled=1).collect()}
    assert got == {i for i, least in want.items() if i == least}


def test_copies_near_the_central_text_make_no_pairs(spark, monkeypatch):
    """Each text of a dense group is compared with the one that most of its keys have in the middle, so copies that are all
    near that one need no pairs with each other, however many keys they share."""
    draw = random.Random(11)
    texts = [" ".join(f"b{k}" for k in range(400))]
    for i in range(100):
        words = texts[0].split()
        for at in draw.sample(range(400), draw.randrange(4, 7)):
            words[at] = f"e{i}x{at}"
        texts.append(" ".join(words))
    # unlike the others, so that the groups have something left to compare
    texts += [" ".join([f"b{k}" for k in range(320)] + [f"o{i}x{k}" for k in range(85)]) for i in range(3)]
    nodes = [1 << 61, *(draw.randrange(1, 1 << 60) for _ in texts[1:])]
    docs = spark.createDataFrame([(n, n, t.encode()) for n, t in zip(nodes, texts)], "node long, id long, text binary")
    met, pairs = [], near_copies._pairs
    monkeypatch.setattr(near_copies, "_pairs", lambda *a: met.append(near_copies.cut(pairs(*a))) or met[0])
    near_copies.links(docs, sampled=1)
    near = set(nodes[:101])
    assert not [r for r in met[0].collect() if near.issuperset(r)]
