import random

import numpy as np
import pytest

from tidemark.llm import decontaminate, langid, mil_quality, toxicity
from tidemark.llm.common import smallest_hashes, table

SF = "/root/testdata/sf0.01"


def held_out(frame, spark, label):
    rows = frame.where("held_out").join(table(spark, SF, "labels"), "doc_id").select("predicted", label).collect()
    return [(r[0], r[1]) for r in rows]


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, i % 2) for i in range(200)] + [(900, None, None), (None, 1, 1), (901, 7, 7)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def labelled(spark):
    draw = random.Random(4)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "elit", "sed", "magna"]

    def text(bad):
        chosen = [draw.choice(words) for _ in range(40)]
        if bad:
            chosen[5], chosen[20] = "wretched", "vile###"
        return " ".join(chosen) + "."

    return spark.createDataFrame([(i, text(i % 2)) for i in range(200)], "doc_id long, text string")


def test_toxicity_finds_the_words_of_one_class(spark, labelled, labels, edge, no_docs):
    model = toxicity.learn(labelled, labels)
    rows = toxicity.score(labelled, model).collect()
    assert np.mean([r.predicted == r.doc_id % 2 for r in rows]) > 0.95
    got = toxicity.score(edge, model).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(no_docs, model).count() == 0


def test_toxicity_catches_short_words(spark):
    draw, short = random.Random(8), ["scum", "idiot", "moron", "clown", "trash", "stupid"]
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "elit", "sed", "magna"]
    plain = lambda n: [draw.choice(words) for _ in range(n)]
    rows = [(i, " ".join(plain(20) + ([short[i // 2 % 6]] if i % 2 else []) + plain(20))) for i in range(1000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1000)], "doc_id long, toxic int")
    model = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    probe = spark.createDataFrame([(i, " ".join(plain(9) + [w] + plain(9))) for i, w in enumerate(short + ["amet"])],
                                  "doc_id long, text string")
    got = {r.doc_id: (r.predicted, r.n_toxic_windows) for r in toxicity.score(probe, model).collect()}
    assert got == {i: (1, 1) for i in range(6)} | {6: (0, 0)}


def test_toxicity_without_labels(spark, edge, no_docs, labels):
    model = toxicity.learn(edge, labels.where("doc_id > 5000"))
    assert {(r.score, r.predicted) for r in toxicity.score(edge, model).collect()} == {(0.0, 0)}
    assert toxicity.score(edge, toxicity.learn(no_docs, labels)).count() == 10


def test_quality_learns_and_takes_edge_cases(spark, labelled, labels, edge, no_docs):
    model = mil_quality.learn(labelled, labels)
    rows = mil_quality.score(labelled, model).collect()
    good = {p: np.mean([r.score for r in rows if r.doc_id % 2 == p]) for p in (0, 1)}
    assert good[1] > good[0] + 0.3
    got = mil_quality.score(edge, model).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    assert mil_quality.score(no_docs, model).count() == 0
    empty = mil_quality.learn(no_docs, labels.limit(0))
    assert {r.predicted for r in mil_quality.score(edge, empty).collect()} == {1}


def test_gradients_equal_differences():
    setup = mil_quality.Setup(hidden=4, attention=3)
    net = mil_quality.Network.start(5, setup)
    draw = np.random.default_rng(1)
    x, starts, y, weight = draw.normal(size=(9, 5)), np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss():
        p, _ = net.forward(x, starts)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    grads = net.gradients(x, starts, y, weight)
    for name, value in net.w.items():
        for i in list(np.ndindex(value.shape))[:6]:
            before = value[i]
            value[i] = before + 1e-5
            up = loss()
            value[i] = before - 1e-5
            down = loss()
            value[i] = before
            assert abs((up - down) / 2e-5 - grads[name][i]) < 1e-5


def test_held_out_accuracy(spark):
    for query, label, least in ((mil_quality.op7_mil_quality, "quality", 0.9), (toxicity.op3_toxicity, "toxic", 0.85)):
        pairs = held_out(query(spark, SF), spark, label)
        assert np.mean([p == y for p, y in pairs]) > least
    rows = langid.op5_langid(spark, SF).where("held_out").join(
        table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98


def test_language_backoff(spark, edge, no_docs):
    docs = spark.createDataFrame([
        (1, "the house and the garden with flowers", "en"), (2, "das Haus und der Garten mit Blumen", "de"),
        (3, "unlearnt", None)], "doc_id long, text string, lang string")
    model = langid.learn(docs)
    assert model["langs"] == ["de", "en"]
    probe = spark.createDataFrame([(1, "the garden"), (2, "und der"), (3, "gardening"), (4, "Gartens"), (5, "12 .. !"),
                                   (6, None), (7, "")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(probe, model).collect()}
    assert got == {1: "en", 2: "de", 3: "en", 4: "de", 5: "und", 6: "und", 7: "und"}
    assert langid.identify(edge, model).count() == 10
    assert langid.identify(no_docs, model).count() == 0
    assert {r.lang_pred for r in langid.identify(edge, langid.learn(no_docs)).collect()} == {"und"}


def brute_alignment(item, text, match=2, mismatch=-1, gap=-1):
    best = 0
    above = [0] * (len(text) + 1)
    for word in item:
        row = [0]
        for j, other in enumerate(text):
            row.append(max(0, above[j] + (match if word == other else mismatch), above[j + 1] + gap, row[j] + gap))
        best, above = max(best, *row), row
    return best


def test_alignment_equals_brute_force():
    draw = random.Random(6)
    for _ in range(300):
        item = np.array([draw.randrange(4) for _ in range(draw.randrange(1, 9))])
        text = np.array([draw.randrange(4) for _ in range(draw.randrange(1, 14))])
        assert decontaminate.align(item, text, decontaminate.Setup())[0] == brute_alignment(item.tolist(), text.tolist())


@pytest.fixture(scope="module")
def benchmark(spark):
    words = [f"b{i}" for i in range(60)]
    items = [" ".join(words[:20]), " ".join(words[20:40]), "too short", None, "", " ".join(words[40:60])]
    return spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(None, " ".join(words[:20]))],
                                 "item_id long, text string")


def test_contamination_with_edits(spark, benchmark, edge, no_docs):
    words = [f"b{i}" for i in range(60)]
    edited = words[:5] + ["new"] + words[6:12] + words[13:20]
    docs = spark.createDataFrame([
        (1, "x y z " + " ".join(words[:20]).upper() + ". q r"), (2, "p " * 50 + " ".join(edited) + " p" * 50),
        (3, " ".join(reversed(words))), (4, " ".join(words[:3]) + " unlike the rest of it"), (5, " ".join(words[20:40])),
        (5, " ".join(words[20:40]))], "doc_id long, text string")
    got = decontaminate.contaminated(docs, benchmark).collect()
    assert sorted((r.doc_id, -1 if r.item_id is None else r.item_id) for r in got) == [
        (1, -1), (1, 0), (2, -1), (2, 0), (5, 1), (5, 1)]
    spans = {(r.doc_id, r.item_id): (r.first_word, r.end_word, r.score) for r in got}
    assert spans[1, 0] == (3, 23, 1.0) and spans[2, 0][:2] == (50, 69)
    small = decontaminate.Setup(block_words=20)
    assert decontaminate.contaminated(docs, benchmark, small).exceptAll(decontaminate.contaminated(docs, benchmark)).count() == 0
    assert [r.doc_id for r in decontaminate.clean_documents(docs, benchmark).orderBy("doc_id").collect()] == [3, 4]
    assert decontaminate.contaminated(edge, benchmark).count() == 0
    assert decontaminate.clean_documents(edge, benchmark).count() == 10
    assert decontaminate.contaminated(no_docs, benchmark).count() == 0
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [0, 1, 30])
@pytest.mark.parametrize("every", [4, 5, 6])
def test_contamination_with_regular_edits_beside_exact_copies(spark, copies, every):
    items = [[f"i{size}w{k}" for k in range(size)] for size in (20, 40, 80)]
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    rows = [(100 + k, "p q r " + " ".join("new" if i % every == every - 1 else w for i, w in enumerate(words)) + " s t")
            for k, words in enumerate(items)]
    rows += [(1000 + k * 100 + c, " ".join(words)) for k, words in enumerate(items) for c in range(copies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert set(got) == {(100 + k, k) for k in range(3)} | {(1000 + k * 100 + c, k) for k in range(3) for c in range(copies)}
    for k, words in enumerate(items):
        text = next(t for i, t in rows if i == 100 + k).split()
        assert got[100 + k, k] == brute_alignment(words, text) / (2 * len(words))


def test_ranks_in_two_steps_equal_one(spark, plan):
    frame = spark.sql("SELECT id, id % 3 AS y FROM range(3000)")
    want = spark.sql("SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY xxhash64(id), id) AS rank FROM "
                     "(SELECT id, id % 3 AS y FROM range(3000))").where("rank <= 70")
    got = smallest_hashes(frame, "y", "id", 70, buckets=8)
    assert sorted(map(tuple, got.select("id", "y", "rank").collect())) == sorted(map(tuple, want.collect()))
    assert "pmod" in plan(got)


def test_texts_of_one_item_stay_in_one_block(spark):
    words = [f"w{i}" for i in range(24)]
    first, second = " ".join(words[:12]), " ".join(words[12:])
    benchmark = spark.createDataFrame(
        [(7, first), (9, " ".join(f"x{i}" for i in range(12))), (None, second), (7, second), (7, "a b")],
        "item_id long, text string")
    docs = spark.createDataFrame([(1, f"{first} {words[12]} x {words[14]}"), (1, f"{first} {second}"), (2, second)],
                                 "doc_id long, text string")
    whole, small = (sorted((r.doc_id, r.item_id is None, r.item_id or 0, r.score) for r in decontaminate.contaminated(
        docs, benchmark, decontaminate.Setup(block_words=n)).collect()) for n in (500_000, 5))
    assert small == whole
    assert [r[:3] for r in whole] == [(1, False, 7), (1, False, 7), (1, True, 0), (2, False, 7), (2, True, 0)]
