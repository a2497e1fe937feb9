import random
import re
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import passages, personal, pointintime, similarity, snapshots
from tidemark.streaming import appends, transforms

DAY = datetime(2024, 1, 1)


def looked_up(facts, features, within=None):
    out = []
    for i, key, at in facts:
        known = [(t, v) for k, t, v in features if k == key and t is not None and at is not None and t <= at]
        best = max(known, key=lambda x: (x[0], x[1] is not None, x[1] or 0), default=None)
        fresh = best is not None and (within is None or best[0] >= at - within)
        out.append((i, best[1] if fresh else None))
    return sorted(out)


@pytest.mark.parametrize("bucket", [F.to_date, lambda c: F.date_trunc("hour", c), lambda c: F.lit(0)])
@pytest.mark.parametrize("within", [None, timedelta(hours=9)])
def test_as_of_join_equals_brute_force(spark, bucket, within):
    draw = random.Random(3)
    time = lambda: DAY + timedelta(minutes=30 * draw.randrange(500)) if draw.random() > 0.05 else None
    key = lambda: draw.choice([1, 1, 1, 2, 3, None])
    facts = [(i, key(), time()) for i in range(300)]
    features = [(key(), time(), draw.choice([None, 1, 2, 3])) for _ in range(120)]
    left = spark.createDataFrame(facts, "id int, k int, at timestamp_ntz")
    right = spark.createDataFrame(features, "k int, known timestamp_ntz, v int")
    got = pointintime.as_of_join(left, right, ["k"], "at", "known", ["v"], bucket, "9 hours" if within else None)
    assert got.columns == ["id", "k", "at", "v"]
    assert sorted((r.id, r.v) for r in got.collect()) == looked_up(facts, features, within)


def test_as_of_join_spreads_a_hot_key(spark, plan):
    """No window over the rows themselves is dealt by the key alone: only the one over a row per key and bucket is."""
    left = spark.range(2000).select(F.lit(1).alias("k"), (F.lit(DAY) + F.make_dt_interval(F.lit(0), F.col("id"))).cast("timestamp_ntz").alias("at"))
    right = left.limit(100).select("k", F.col("at").alias("known"), F.lit(5).alias("v"))
    found = pointintime.as_of_join(left, right, ["k"], "at", "known", ["v"])
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan(found))
    assert [keys for keys in dealt if "__bucket" not in keys] and sum("__bucket" not in keys for keys in dealt) == 1
    assert found.groupBy(F.to_date("at")).count().count() > 80
    assert found.filter("v IS NULL").count() == 0


def test_empty_sides_of_as_of_join(spark):
    left = spark.createDataFrame([(1, DAY)], "k int, at timestamp_ntz")
    right = spark.createDataFrame([], "k int, known timestamp_ntz, v int")
    assert [r.v for r in pointintime.as_of_join(left, right, ["k"], "at", "known", ["v"]).collect()] == [None]
    assert pointintime.as_of_join(left.limit(0), right, ["k"], "at", "known", ["v"]).count() == 0


@pytest.mark.parametrize("block", [3, 100])
def test_neighbours_equal_brute_force(spark, block):
    draw = np.random.default_rng(4)
    vectors = draw.integers(-2, 3, (150, 3)).astype(float)  # many ties
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(150, None), (151, [float("nan"), 1.0, 1.0]), (152, [1.0, None, 2.0]),
            (153, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (7, vectors[7].tolist())]
    frame = spark.createDataFrame(rows, "vec_id bigint, e array<double>").repartition(4)
    got = similarity.nearest(frame, frame.filter("vec_id % 10 = 0"), 4, "vec_id", "e", block)
    norms = (vectors ** 2).sum(axis=1)
    want = []
    for q in range(0, 150, 10):
        if norms[q]:
            near = sorted((-(vectors[q] @ vectors[i]) / np.sqrt(norms[q] * norms[i]), i) for i in range(150) if i != q and norms[i])
            want += [(q, rank + 1, i, round(-s, 9)) for rank, (s, i) in enumerate(near[:4])]
    assert sorted((r.query_id, r.rank, r.id, round(r.similarity, 9)) for r in got.collect()) == sorted(want)


def test_neighbours_without_queries(spark):
    frame = spark.createDataFrame([(1, [1.0])], "vec_id bigint, e array<double>")
    assert similarity.nearest(frame, frame.limit(0), 4, "vec_id", "e").count() == 0
    assert similarity.nearest(frame, frame, 4, "vec_id", "e").count() == 0


@pytest.mark.parametrize("size, overlap", [(10, 3), (7, 0), (1, 0), (1000, 999)])
def test_chunks_can_be_put_together(spark, size, overlap):
    texts = ["", "a", "abcdefghij", "abcdefghijk", "é😀漢" * 9, "x" * 64, None, " \n\t "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = passages.chunks(docs, ["doc_id"], size=size, overlap=overlap)
    for r in found.collect():
        assert r.chunk_text == texts[r.doc_id][r.start:r.end] and r.start == r.chunk * (size - overlap) and len(r.chunk_text) <= size
    back = {r.doc_id: r.text for r in passages.joined(found, ["doc_id"]).collect()}
    assert back == {i: t for i, t in enumerate(texts) if t is not None}
    with pytest.raises(ValueError):
        passages.chunks(docs, ["doc_id"], size=5, overlap=5)


def test_chunks_need_no_shuffle_and_no_python(spark, plan):
    docs = spark.createDataFrame([(1, "text")], "doc_id int, text string")
    text = plan(passages.chunks(docs, ["doc_id"]))
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


def test_sessions_merge_when_a_late_row_fills_the_gap(spark):
    at = lambda *minutes: [(1, DAY + timedelta(minutes=m)) for m in minutes]
    frame = lambda rows: transforms.event_time(spark.createDataFrame(rows, "user_id int, ts timestamp_ntz"))
    count = lambda rows: sorted(r.n for r in transforms.sessions(frame(rows), "ts", "30 minutes", ["user_id"], n=F.count("*")).collect())
    assert count(at(0, 10, 50, 60)) == [2, 2]
    assert count(at(0, 10, 50, 60, 30)) == [5]


def test_follow_sends_appends_once(spark, path):
    table, target, checkpoint = f"{path}/table", f"{path}/target", f"{path}/offsets"
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    snapshots.append(rows(1, 2), table)
    assert appends.follow(spark, table, target, checkpoint) == 1
    assert appends.follow(spark, table, target, checkpoint) == 0
    snapshots.commit(rows(9), table, "OVERWRITE")
    snapshots.append(rows(3), table)
    snapshots.append(rows(3), table)
    # a call that was cut off after its data: the folder is there, its offset is not
    rows(3).write.parquet(f"{target}/version=2")
    assert appends.follow(spark, table, target, checkpoint) == 2
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2, 3, 3]
    assert [(r.version, r.operation, r.rows) for r in appends.offsets(spark, checkpoint).orderBy("version").collect()] == [
        (0, "APPEND", 2), (1, "OVERWRITE", None), (2, "APPEND", 1), (3, "APPEND", 1)]
    assert sorted(r.id for r in snapshots.read_as_of(spark, table).collect()) == [3, 3, 9]
    assert appends.follow(spark, table, f"{path}/other", f"{path}/later", start=3) == 1
    snapshots.commit(rows(1), table, snapshots.APPEND)
    with pytest.raises(ValueError, match="did not store"):
        appends.follow(spark, table, target, checkpoint)


def by_hand(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += sum(map(int, str(int(d) * (1 + i % 2))))
    return total % 10 == 0


def test_check_digits(spark):
    draw = random.Random(8)
    numbers = ["".join(draw.choice("0123456789") for _ in range(draw.randint(13, 19))) for _ in range(300)]
    frame = spark.createDataFrame([(n,) for n in numbers], "n string")
    assert {r.n: r.ok for r in frame.select("n", personal.luhn_valid(F.col("n")).alias("ok")).collect()} == {n: by_hand(n) for n in numbers}
    codes = ["GB82WEST12345698765432", "DE89370400440532013000", "DE89370400440532013001", "FR1420041010050500013M02606"]
    codes += ["".join(draw.choice("AB09") for _ in range(20)) for _ in range(200)]
    frame = spark.createDataFrame([(c,) for c in codes], "c string")
    number = lambda c: int("".join(str(int(x, 36)) for x in c[4:] + c[:4])) % 97 == 1
    assert {r.c: r.ok for r in frame.select("c", personal.iban_valid(F.col("c")).alias("ok")).collect()} == {c: number(c) for c in codes}
    assert number(codes[0]) and not number(codes[2])


def test_redaction(spark):
    texts = ["card 4111 1111 1111 1111, not 4111 1111 1111 1112", "10.0.0.1 256.1.1.1 01.2.3.4 4111111111111111",
             "to DE89370400440532013000.", "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = [r[0] for r in frame.select("doc_id", personal.redacted(F.col("text")).alias("t")).orderBy("doc_id").select("t").collect()]
    assert got == ["card [card], not 4111 1111 1111 1112", "[ipv4] 256.1.1.1 01.2.3.4 [card]", "to [iban].", "", None]
    counts = {r.rule: (r.candidates, r.valid, r.documents) for r in personal.counts(frame, "doc_id").collect()}
    assert counts["card"] == (4, 2, 2) and counts["ipv4"][1:] == (1, 1) and counts["iban"] == (1, 1, 1)
