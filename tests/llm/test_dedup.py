import hashlib
import random

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash, substring_dedup
from tidemark.llm.common import cut
from tidemark.llm.components import component_of


def brute_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    """The smallest node reachable, by node."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b) and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.fixture(scope="module")
def crowd():
    """Fingerprints in dense clusters and chains, and far ones."""
    draw, found = random.Random(3), set()
    for _ in range(3):
        base = draw.getrandbits(64)
        for _ in range(60):
            value = base
            for _ in range(draw.randrange(4)):
                value ^= 1 << draw.randrange(64)
            found.add(signed(value))
    return sorted(found | {signed(draw.getrandbits(64)) for _ in range(40)} | {0, -1})


@pytest.mark.parametrize("dense, segments", [(1, 5), (20, 5), (10_000, 5), (10_000, 4), (10_000, 7)])
def test_links_connect_what_brute_force_connects(spark, crowd, dense, segments):
    want = groups(crowd, lambda a, b: ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 2)
    prints = spark.createDataFrame([(x,) for x in crowd], "fp long")
    got = {r.node: r.component for r in component_of(simhash.links(prints, segments, dense)).collect()}
    assert {x: got.get(x, x) for x in crowd} == want


def test_pigeonring_quotas_never_lose_a_pair(spark):
    draw = random.Random(5)
    pairs = [(0, sum(1 << b for b in draw.sample(range(64), draw.randrange(3)))) for _ in range(400)]
    frame = spark.createDataFrame([(signed(b),) for _, b in pairs], "d long")
    for segments in (4, 5, 7):
        any_start = F.lit(False)
        for s in range(segments):
            any_start = any_start | simhash.within_quotas(F.col("d"), F.lit(s), segments, 2)
        assert frame.where(~any_start).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, i) for i in range(1001, 1400)]
    edges = spark.createDataFrame(path + star + [(5, 5), (2000, 2000)], "u long, v long")
    got = {r.node: r.component for r in component_of(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{i: 1000 for i in range(1001, 1400)}}


def test_near_duplicates_edge_cases(spark, edge, no_docs):
    rows = simhash.near_duplicates(edge).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].fp == by_id[4].fp == by_id[6].fp == 0
    assert [by_id[i].component for i in (1, 2, 3, 4, 6, 5)] == [1, 1, 3, 3, 3, 5]
    assert by_id[None].component is None
    assert by_id[8].fp == signed(brute_fingerprint("x" * 60_000))
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.one_of_each_group(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in kept.select("doc_id").collect()) == [0, 1, 1, 3, 5, 7, 8]


def test_fingerprints_equal_brute_force(spark):
    draw = random.Random(2)
    texts = [" ".join(draw.choice(["A", "b", "ÉÉ", "c d", "dd"]) for _ in range(n)) for n in range(12)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.fp for r in simhash.fingerprints(docs).collect()}
    assert got == {i: signed(brute_fingerprint(t)) for i, t in enumerate(texts)}


def brute_removal(docs, size):
    """doc_id: (words, words removed, digest of the rest)."""
    seen, out = {}, {}
    for doc, text in sorted(docs):
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - size + 1):
            window = tuple(words[i:i + size])
            if window in seen and seen[window] != (doc, i):
                gone.update(range(i, i + size))
            seen.setdefault(window, (doc, i))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed, letters, count=30):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(letters)]
    docs = [" ".join(draw.choice(words) for _ in range(draw.randrange(60))) for _ in range(count)]
    for _ in range(count):  # pasted passages, also across each other
        source, i = draw.choice(docs).split(" "), draw.randrange(count)
        at = draw.randrange(len(source))
        docs[i] += " " + " ".join(source[at:at + draw.randrange(40)])
    return list(enumerate(docs))


@pytest.mark.parametrize("size, seed, letters, crowded", [
    (20, 6, 500, 256), (20, 6, 2, 256), (20, 6, 3, 1), (8, 3, 4, 2), (8, 8, 4, 256), (5, 1, 3, 256)])
def test_removal_equals_brute_force(spark, size, seed, letters, crowded):
    docs = corpus(letters + size, letters)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup.deduplicate(frame, size, seed, crowded=crowded).collect()}
    assert got == brute_removal(docs, size)


def test_removal_edge_cases(spark, edge, no_docs):
    rows = substring_dedup.deduplicate(edge, with_text=True).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    assert by_id[5].n_removed == 20_000 - 5 and by_id[5].kept_text == "lorem ipsum dolor sit amet"
    assert [by_id[i].n_removed for i in (1, 2, 3, 4, 6, 8, None)] == [0] * 7
    assert by_id[3].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert substring_dedup.deduplicate(no_docs).count() == 0


def test_repeated_rows_get_the_same_result(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (2, text)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed) for r in substring_dedup.deduplicate(docs).collect())
    assert got == [(1, 0), (1, 0), (2, 30), (2, 30)]


def test_written_steps_leave_no_shuffle_files(spark):
    """Only shuffles of the last step, which is the caller's, may stay."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before, name = shuffles(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    frame = spark.createDataFrame(corpus(7, 5), "doc_id long, text string").repartition(3)
    rows = substring_dedup.deduplicate(frame)
    assert not shuffles() - before
    assert rows.count() == 30 and spark.conf.get(name) == "false"


def test_batches_of_a_written_step_are_bounded(spark):
    """Long texts come to Python a few MB at a time, however many rows a batch may have."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    docs = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    got = cut(docs.mapInArrow(run, "rows long, bytes long")).collect()
    assert sum(r.rows for r in got) == 2000 and max(r.bytes for r in got) < 6 << 20


def test_matching_statistics_equal_brute_force():
    draw = random.Random(9)
    for _ in range(200):
        automaton, texts = substring_dedup.Automaton(), []
        for _ in range(draw.randrange(1, 4)):
            texts.append([draw.choice("abc") for _ in range(draw.randrange(12))])
            automaton.add(texts[-1])
        probe = [draw.choice("abcd") for _ in range(15)]
        known = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        want = [max((n for n in range(1, e + 2) if tuple(probe[e + 1 - n:e + 1]) in known), default=0) for e in range(15)]
        assert list(automaton.statistics(probe)) == want
