import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, whitening

SF = "/root/testdata/sf0.001"


def by_numpy(vectors, most):
    x = np.array([[int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v] for v in vectors], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    away = (n * x - sums).astype(object)
    return n, (away ** 2).sum(axis=1), ((n * x - sums) / n) @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


@pytest.mark.parametrize("block, group", [(1024, 8), (16, 1)])
def test_whitening_equals_numpy(spark, block, group):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(200, 5)) * [5, 4, 3, 2, 1] @ rng.normal(size=(5, 5))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate([*vectors, *[vectors[7]] * 90])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    n, deviation, white, share = by_numpy([v for _, v in rows], 3)
    got = {r.vec_id: r for r in whitening.whiten(frame, most=3, block=block, group=group).collect()}
    assert len(got) == 290 and n == 200
    for i, r in got.items():
        assert (r.n, r.deviation) == (n, deviation[i])
        assert np.allclose(np.abs(r.components), np.abs(white[i]), atol=1e-9) and np.allclose(r.explained, share)
    signs = np.array([np.sign(np.array(got[i].components) * white[i]) for i in got])
    assert (signs == signs[0]).all() and got[0].identity_error < 1e-9


def test_whitening_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.25, 3.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [-inf, 0.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {c: F.lit("extra") for c in ("x", "index", "n", "ok", "part", "components", "_x", "values")})
    got = whitening.whiten(frame).collect()
    assert sorted(str(r.vec_id) for r in got) == ["1", "1", "None"]
    assert all(r.n == 2 and len(r.components) == 1 and abs(abs(r.components[0]) - 1) < 1e-9 for r in got)
    one = whitening.whiten(frame.where("vec_id = 1")).collect()
    assert [(r.n, r.deviation, r.components) for r in one] == [(1, 0, [])] * 2
    assert whitening.whiten(frame.where("vec_id = 2")).count() == 0
    assert whitening.whiten(frame.limit(0)).count() == 0
    far = spark.createDataFrame([(1, [1e12]), (2, [-1e12])], "vec_id long, embedding array<double>")
    assert [r.deviation for r in whitening.whiten(far).collect()] == [None, None]


def test_whitening_query(spark):
    got = whitening.op12_whitening(spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = got.collect()
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, white, share = by_numpy([r.embedding for r in vectors], 16)
    place = {r.vec_id: i for i, r in enumerate(vectors)}
    assert len(rows) == 16 * len(vectors)
    for r in rows:
        i = place[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation[i]) and r.identity_error < 1e-9
        assert abs(abs(r.whitened) - abs(white[i, r.component - 1])) < 1e-8 and abs(r.explained - share[r.component - 1]) < 1e-9


def shared(sizes, weights, most):
    """Targets by sharing the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = Fraction(sum(sizes.values())), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = Fraction(most * sizes[s])
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_the_loop(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 40, 1000]) for i in range(11)} | {None: 7, "": 3, "é": 90, "Z": 12}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = shared(sizes, mixing.WEIGHTS, 3)
    assert got.keys() == want.keys() and all(abs(got[s] - float(want[s])) < 1e-6 for s in want)


def test_a_flight_keeps_the_balances():
    rng = random.Random(5)
    for _ in range(300):
        units = [[rng.uniform(0.01, 0.99), rng.choice([1, 2, 9, 500])] for _ in range(3)]
        before = [list(u) for u in units]
        mixing.fly(units, rng.random())
        assert any(p in (0.0, 1.0) for p, _ in units) and all(0 <= p <= 1 for p, _ in units)
        assert abs(sum(p for p, _ in units) - sum(p for p, _ in before)) < 1e-6
        assert abs(sum(p * s for p, s in units) - sum(p * s for p, s in before)) < 1e-4
    mean = np.mean([(u := [[0.3, 4], [0.6, 9], [0.5, 2]], mixing.fly(u, rng.random()), [p for p, _ in u])[2] for _ in range(20_000)], axis=0)
    assert np.abs(mean - [0.3, 0.6, 0.5]).max() < 0.02


def test_landing_takes_the_nearest_outcome():
    assert mixing.landing([(0.5, 10), (0.5, 10)]) in ([0, 1], [1, 0])
    assert mixing.landing([(0.9, 100)]) == [1]
    assert mixing.landing([(0.5, 6), (0.5, 3), (0.5, 9)]) in ([1, 1, 0], [0, 0, 1])


def test_mix_balances_a_hot_source(spark):
    source = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 7))
    words = (F.pmod(F.xxhash64("id"), F.lit(60)) + 1).cast("int")
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), source.alias("source"), F.repeat(F.lit("w "), words).alias("text"))
    rows = mixing.mix(docs, bucket=100, fan=4).collect()
    assert len(rows) == 6000 and {(r.doc_id, r.size) for r in rows} == {(r.doc_id, r.n) for r in docs.selectExpr("doc_id", "length(text) div 2 AS n").collect()}
    totals: dict = {}
    for r in rows:
        taken, size, number = totals.get(r.source, (0, 0, 0))
        totals[r.source] = (taken + r.taken, size + r.size, number + (r.taken / r.size))
        assert r.taken % r.size == 0 and r.taken <= 3 * r.size
    count = {r.source: r.n for r in docs.groupBy("source").agg(F.count("*").alias("n")).collect()}
    for r in rows:
        taken, size, number = totals[r.source]
        assert size == r.source_size and abs(taken - r.target) < 10
        assert abs(number - count[r.source] * r.target / size) < 3
    again = mixing.mix(docs.repartition(7), bucket=100, fan=4).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_mix_edge_rows(spark, edge, no_docs):
    rows = mixing.mix(edge).collect()
    assert len(rows) == edge.count()
    assert all(r.size == len((t or "").encode().split()) for r, t in zip(
        sorted(rows, key=lambda r: str(r.doc_id)), [r.text for r in sorted(edge.collect(), key=lambda r: str(r.doc_id))]))
    assert all(r.taken <= 3 * r.size for r in rows)
    assert mixing.mix(no_docs).count() == 0
    empty = mixing.mix(edge.where("doc_id = 4")).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)]


def test_mixing_query(spark):
    got = mixing.op13_mixing(spark, SF)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
