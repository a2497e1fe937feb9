"""Near copies by Jaccard similarity of word shingles, exact: no pair at or above the threshold is missed.

*Fingerprints.* Texts whose SimHash fingerprints over the same shingles are equal or link by pigeonring (``simhash.links``) are
candidates of the first round. Two bits find copies with few changes only: a pair of similarity 0.8 differs in about ten of
64 bits, where no chain of segments is selective. What follows finds all others.

*Candidates.* A text is the set of XXH64 hashes of its shingles of ``shingle`` words (ASCII letters in lower case). Under
one order of all hashes, two sets of similarity t share a hash among the first n - ceil(t n) + 1 of each (prefix filter).
Any order is right; rare hashes first keeps the groups small, so hashes that a sample of the texts holds often are known
with their counts, a bounded list, and come last. A pair goes on if sizes and the places of the shared hash leave room for
the overlap.

*Common hashes.* A text with such a hash among its first ones is made of common passages, or one of many copies. It does
not enter the group of that hash, which may be a large share of all texts. All its rare hashes are among its first ones, so
what is left are pairs that share common hashes only: their *cores*, the sets of common hashes, have the similarity too.
Cores are dealt into parts by hash: two that differ in k hashes at most agree in one of more than k parts, as a whole.
Sizes are classed, since both cores need the same number of parts; a core takes part in its own class and, as the smaller
one, in the next. Empty parts only count for cores with so many that they may be all that agrees.

*Equal cores.* Texts around one passage have one core and different rest. The text with the smallest rest stands for its
core: if a text is similar to one of another core by common hashes alone, the one that stands for it is as well. The
others of the core are compared with that one by the sizes of core and rests, which is exact here, and need no
confirmation. A text with too large a rest for that can only be similar to those of smaller rest, so it is compared with
those that stand for other cores.

*One exchange.* Keys of both kinds are dealt and sorted once; a task walks through its groups. Under at most ``dense``
texts it forms pairs. The rows of a denser group, in which all but few are copies of each other, go on: its texts are
first compared with the four that most of their groups name (each group names its central text and a mixed one), then, what
that left apart, with the texts outside the largest component. Texts whose
rest is too large for every other text of the group are left out of that, and a pair comes out of it only if the *sketches*
of both texts allow the similarity: the parity of the number of hashes in each of ``SKETCH`` bins differs in no more bins
than the sets differ in hashes. This is exact; it tells texts of up to about a thousand words apart, longer ones fill all bins.

*Counts.* A pair that meets under c of its first hashes has an overlap of at most c and what lies behind the first ones of
one of both. So it goes on only if it met often enough; with a text in parts or in a dense group, c is not known and any
number will do.

*Confirmation.* Whole sets are intersected, in two rounds: each text with its smallest candidate and its candidates by
fingerprint, and then only pairs that this has not connected.

Equal texts are one node from the start, as are all texts without a word.
"""

from __future__ import annotations

from math import ceil, exp, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.common import blocks, cut, doc_key, release, splittable, splittable_on
from tidemark.llm.components import component_of
from tidemark.llm.simhash import shingle_hashes
from tidemark.llm.substring_dedup import _mix

#: One of so many texts counts hashes; a common hash is met in so many of them; the frequent hashes known at most.
SAMPLED, COMMON, KNOWN = 16, 4, 500_000
#: Bins of a sketch, a multiple of 64.
SKETCH = 512
#: Cores of a dense group that a task remembers; of further ones all texts go on.
MOST_HEADS = 100_000
_SLACK = 1e-9


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, size), np.uint64))


def packed(found: np.ndarray) -> bytes:
    """48 bits of each hash, ascending: enough to tell the shingles of two texts apart, and a quarter less to move."""
    return np.unique(found >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(data) -> np.ndarray:
    short = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return np.pad(short, ((0, 0), (0, 2))).view(np.uint64).ravel()


def sketch(found: np.ndarray) -> np.ndarray:
    """Bit i: an odd number of the hashes falls into bin i."""
    odd = np.bincount((found % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _map(frame: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` gets the rows of a block as tuples, text (binary) last, and returns arrays of the output columns."""
    def run(batches):
        for batch in batches:
            for block in blocks(batch, batch.num_columns - 1, 2 << 20):
                arrays = fn(list(zip(*[c.to_pylist() for c in block.columns])))
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=names)

    names = [part.split()[0] for part in schema.split(", ")]
    return frame.mapInArrow(run, schema)


def frequent_hashes(texts: DataFrame, shingle: int, sampled: int = SAMPLED) -> tuple[np.ndarray, np.ndarray]:
    """The ``KNOWN`` most frequent hashes of a sample of the nodes that are met twice or more, ascending, with counts."""
    def run(batches):
        for batch in batches:
            sets = [shingle_set(text.as_py(), shingle) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column(0).to_numpy(), [len(s) for s in sets])),
                pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))], names=["node", "hash"])

    sample = texts.where(F.pmod(F.xxhash64("node"), F.lit(sampled)) == 0).select("node", "text")
    found = sample.mapInArrow(run, "node long, hash long").distinct().groupBy("hash").count().where("count > 1").orderBy(
        F.desc("count"), "hash").limit(KNOWN).toArrow()
    hashes = found.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found.column("count").to_numpy()[order]


def fingerprint_pairs(texts: DataFrame, shingle: int) -> DataFrame:
    """Pairs (u, v), u < v, of nodes that connect all with words whose fingerprints pigeonring links. The smallest node of a
    fingerprint stands for it, and each other one is paired with that."""
    prints = cut(simhash.fingerprints(texts.where("node <> 0"), shingle, {"node": F.col("node")}).distinct())
    least = cut(prints.groupBy("fp").agg(F.min("node").alias("least")))
    equal = prints.join(splittable(least, "fp"), splittable_on(prints, "fp")).where("node > least").select(
        F.col("least").alias("u"), F.col("node").alias("v"))
    near = simhash.links(least)
    for end in ("u", "v"):
        side = splittable(least.select("fp", F.col("least").alias(f"{end}_node")), "fp")
        near = near.join(side, splittable_on(near, end)).drop("_right_hash", "_right_key")
    near = near.select(F.least("u_node", "v_node").alias("u"), F.greatest("u_node", "v_node").alias("v"))
    found = cut(equal.union(near).distinct())
    release(prints, least)
    return found


def counts_of(hashes: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, counts[at], 0)


def size_class(n: int, least: float) -> int:
    """Sizes that differ by the similarity at most are in one class or in neighbours."""
    return int(log(n) / -log(least) + _SLACK)


def class_parts(number: int, least: float) -> tuple[int, int]:
    """Hashes in which two sets, the larger of this class, may differ, and the parts into which both are dealt."""
    largest = least ** -(number + 1)
    differ = int((1 - least) / (1 + least) * 2 * largest + _SLACK)
    parts = differ + 1
    while parts < 2 * differ and parts - differ <= parts * exp(-0.7 * largest / parts):
        parts += 1
    return differ, parts


def part_keys(found: np.ndarray, least: float) -> np.ndarray:
    """The keys of the parts of a set in its class and the next."""
    own, keys = size_class(len(found), least), []
    for number in (own, own + 1):
        differ, parts = class_parts(number, least)
        at = (found % np.uint64(parts)).astype(np.int64)
        mixed = _mix(found, np.full(len(found), 0x5851F42D4C957F2D, np.uint64))
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, at, mixed)
        filled = np.bincount(at, minlength=parts) > 0
        # with so many empty parts, those that agree may be empty ones
        chosen = np.flatnonzero(filled | ((~filled).sum() >= parts - differ))
        keys.append(_mix(sums[chosen], (chosen.astype(np.uint64) << np.uint64(20)) + np.uint64(number + 1)))
    return np.concatenate(keys)


def candidate_keys(
    texts: DataFrame, known: tuple[np.ndarray, np.ndarray], shingle: int, least: float, common: int = COMMON,
) -> DataFrame:
    """key, node, size of the set, place of the key and core: the first hashes of each set, with the node as core; the
    parts of its core and the core itself, with the number of rare hashes as place -1, -2 and so on. The size is negative
    if not all first hashes are there."""
    shared = texts.sparkSession.sparkContext.broadcast(known)
    schema = "key long, node long, size int, place int, core long"

    def run(batches):
        seen: set = set()
        for batch in batches:
            for part in blocks(batch, 1, 2 << 20):
                keys, nodes, sizes, places, cores = [], [], [], [], []
                for node, text in zip(part.column(0).to_pylist(), part.column(1)):
                    if node in seen:  # a copy; those in other tasks are left out where groups are walked through
                        continue
                    if len(seen) < 1_000_000:
                        seen.add(node)
                    found = shingle_set(text.as_py(), shingle)
                    if not (n := len(found)):
                        continue
                    counts = counts_of(found, *shared.value)
                    order = np.lexsort((found, counts))[:n - ceil(least * n - _SLACK) + 1]
                    rare = int((counts[order] < common).sum())  # these come first
                    own = [(found[order[:rare]].view(np.int64), np.arange(rare), node)]
                    if rare < len(order):
                        passages = found[counts >= common]
                        core = np.array([xxhash.xxh64_intdigest(passages.tobytes())], np.uint64)
                        dealt = np.concatenate([core, part_keys(passages, least)]).view(np.int64)
                        own.append((dealt, np.full(len(dealt), -1 - rare), dealt[0]))
                    for key, place, core in own:
                        keys.append(key)
                        places.append(place.astype(np.int32))
                        nodes.append(np.full(len(key), node, np.int64))
                        sizes.append(np.full(len(key), n if rare == len(order) else -n, np.int32))
                        cores.append(np.full(len(key), core, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, kind), *a])) for kind, a in zip(
                    (np.int64, np.int64, np.int32, np.int32, np.int64), (keys, nodes, sizes, places, cores))],
                    names=["key", "node", "size", "place", "core"])

    return texts.select("node", "text").mapInArrow(run, schema)


def _fits(a: tuple, b: tuple, least: float) -> bool:
    """Sizes, and places of a shared hash, allow the similarity: rows (node, size, place). In parts nothing but the cores
    is shared."""
    n, m = abs(a[1]), abs(b[1])
    if a[2] < 0 and b[2] < 0:
        return (min(n + a[2], m + b[2]) + 1) * (1 + least) + _SLACK >= (n + m) * least
    if a[2] < 0 or b[2] < 0:
        return min(n, m) + _SLACK >= least * max(n, m)
    most = min(a[2], b[2]) + min(n - a[2], m - b[2])
    return most * (1 + least) + _SLACK >= (n + m) * least


def fewest(n: int, m: int, least: float) -> int:
    """The first hashes that two similar sets of these sizes share at least; negative sizes: not all are known."""
    if n < 0 or m < 0:
        return 0
    overlap = ceil(least / (1 + least) * (n + m) - _SLACK)
    return overlap - max(ceil(least * k - _SLACK) - 1 for k in (n, m))


def _walk(keys: DataFrame, least: float, dense: int, parts: int) -> DataFrame:
    """Candidates (u, v), u < v, of groups of at most ``dense`` nodes, with the number of keys (met) and how many there have
    to be (need; -1: similar for sure); the rows (u: node, key, size, place) of denser groups. Nodes of one core count
    once. ``parts`` tasks sort the keys."""
    schema = "u long, v long, key long, size int, place int, met int, need int"

    def run(batches):
        key, group, last, crowded = None, [], None, False
        pairs: dict = {}
        rows: list = []
        heads: dict = {}  # of each core, the row of the smallest rest: rows come in that order

        def add(a, b):
            if _fits(a, b, least):
                ends = (min(a[0], b[0]), max(a[0], b[0]))
                met, need = pairs.get(ends) or (0, fewest(a[1], b[1], least))
                pairs[ends] = (met + 1, need)

        def settle():
            for i, a in enumerate(group):
                for b in group[:i]:
                    add(a, b)

        for batch in batches:
            for k, node, size, place, core in zip(*[c.to_pylist() for c in batch.columns]):
                if k != key:
                    settle()
                    key, group, last, crowded, heads = k, [], None, False, {}
                if node == last:
                    continue
                last, row = node, (node, size, place)
                head = heads.get(core) if place < 0 else None
                if head is not None and _fits(head, row, least):
                    if k == core:
                        pairs[min(head[0], node), max(head[0], node)] = (1, -1)
                    continue
                if head is not None and not crowded:
                    for other in group:
                        add(other, row)
                    continue
                if place < 0 and head is None and len(heads) < MOST_HEADS:
                    heads[core] = row
                group.append(row)
                if crowded or len(group) > dense:
                    rows += [(*row, key) for row in group]
                    group, crowded = [], True
            yield out(pairs, rows)
            pairs, rows = {}, []
        settle()
        yield out(pairs, rows)

    def out(pairs, rows):
        n, m = len(pairs), len(rows)
        columns = [[u for u, _ in pairs] + [r[0] for r in rows], [v for _, v in pairs] + [None] * m,
                   *[[None] * n + [r[i] for r in rows] for i in (3, 1, 2)],
                   *[[p[i] for p in pairs.values()] + [None] * m for i in (0, 1)]]
        kinds = [pa.int64()] * 3 + [pa.int32()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                          names=["u", "v", "key", "size", "place", "met", "need"])

    return keys.repartition(parts, "key").sortWithinPartitions("key", F.desc("place"), "core", "node").mapInArrow(run, schema)


def _room(a: str, b: str, least: float) -> Column:
    """The sizes and places of a shared key allow the similarity."""
    size, other, place, other_place = (F.col(f"{t}.{c}") for c in ("size", "place") for t in (a, b))
    most = F.when(F.greatest(place, other_place) < 0, F.least(size + place, other + other_place) + 1).when(
        F.least(place, other_place) >= 0, F.least(place, other_place) + F.least(size - place, other - other_place))
    return (F.least(size, other) + _SLACK >= F.greatest(size, other) * least) & F.coalesce(
        most * (1 + least) + _SLACK >= (size + other) * least, F.lit(True))


def _alike(a: str, b: str, least: float) -> Column:
    """The sketches differ in no more bins than sets of these sizes and this similarity in hashes."""
    bins = [F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(SKETCH // 64)]
    return sum(bins[1:], bins[0]) * (1 + least) <= (F.col(f"{a}.size") + F.col(f"{b}.size")) * (1 - least) + _SLACK


def _spare(least: float) -> Column:
    """What the core of a row leaves for the rest of another one: two rows are similar only if the sum is not negative."""
    return F.when(F.col("place") < 0, (F.col("size") + F.col("place") + 1) * (1 + least) / 2 - F.col("size") * least)


def _pairs(left: DataFrame, right: DataFrame, also: Column, least: float) -> DataFrame:
    joined = left.alias("a").join(right.alias("b"), F.col("a.key") == F.col("b.key")).where(also & _room("a", "b", least))
    return joined.select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose sets (node, hashes) have the similarity."""
    for end, name in (("u", "a"), ("v", "b")):
        side = splittable(sets.select("node", F.col("hashes").alias(name)), "node")
        pairs = pairs.join(side, splittable_on(pairs, end)).drop("_right_hash", "_right_key")

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = unpacked(a.as_buffer()), unpacked(b.as_buffer())
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both + _SLACK >= least * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def links(
    texts: DataFrame, shingle: int = 5, least: float = 0.8, dense: int = 64, sampled: int = SAMPLED, common: int = COMMON,
) -> DataFrame:
    """Edges (u, v) between nodes of ``texts`` (node, id, text; equal nodes have equal texts) that connect all pairs of
    similarity ``least`` or more."""
    known = frequent_hashes(texts, shingle, sampled)
    # keys are about as large as the texts: a few tasks for each that reads them, so that none sorts much in memory
    parts = 4 * texts.rdd.getNumPartitions()
    met = cut(_walk(candidate_keys(texts, known, shingle, least, common), least, dense, parts))
    crowded = met.where("v IS NULL").select("key", F.col("u").alias("node"), F.abs("size").cast("int").alias("size"), "place")
    near = met.where("v IS NOT NULL").groupBy("u", "v").agg(
        F.sum("met").alias("met"), F.max("need").alias("need"), (F.min("need") < 0).alias("sure"))
    uncounted = crowded.where("place >= 0").select("node").distinct()
    for end in ("u", "v"):
        side = splittable(uncounted.withColumn(f"{end}_open", F.lit(True)), "node")
        near = near.join(side, splittable_on(near, end), "left").drop("_right_hash", "_right_key")
    counted = cut(near.where("sure OR met >= need OR u_open OR v_open").select("u", "v", "sure"))
    sure, near = (counted.where(F.col("sure") == kind).select("u", "v") for kind in (True, False))

    # most edited copies of a text are nearer to it than to each other: it is the one of smallest rest and largest core
    central = F.struct(F.greatest(-F.col("place"), F.lit(0)), -F.col("size"), F.xxhash64("node"), F.col("node").alias("node"))
    mixed = F.struct(F.xxhash64("node").alias("h"), F.col("node"))
    pivots = crowded.groupBy("key").agg(F.min(central).alias("low"), F.max(mixed).alias("high")).select(
        "key", F.explode(F.array("low.node", "high.node")).alias("pivot"))
    stars = crowded.join(splittable(pivots, "key"), splittable_on(crowded, "key")).where("node <> pivot")
    # those that a text shares most keys with: of one text's many keys, most have the same central one
    stars = stars.groupBy("node", "pivot").agg((-F.count("*")).alias("rank")).groupBy("node").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("rank", "pivot"))), 1, 4).alias("p")).select(
        "node", F.explode("p.pivot").alias("pivot")).select(
        F.least("node", "pivot").alias("u"), F.greatest("node", "pivot").alias("v"))
    printed = fingerprint_pairs(texts, shingle)
    first = cut(near.groupBy("v").agg(F.min("u").alias("u")).select("u", "v").union(stars).union(printed).distinct())

    members = near.union(printed).select(F.explode(F.array("u", "v")).alias("node")).union(crowded.select("node")).distinct()
    # one document per node, found by its id too: copies of one text spread over the tasks
    named = texts.groupBy("node").agg(F.min("id").alias("id")).join(members, "node", "left_semi")
    chosen = texts.join(named, ["node", "id"], "left_semi").groupBy("node", "id").agg(F.first("text").alias("text")).select(
        "node", "text")

    def hashed(rows):
        found = [packed(shingle_set(text, shingle)) for _, text in rows]
        return [pa.array([node for node, _ in rows], pa.int64()), pa.array(found, pa.binary()),
                pa.array([sketch(unpacked(f)) for f in found], pa.list_(pa.int64()))]

    sets = cut(_map(chosen, hashed, "node long, hashes binary, sketch array<long>"))

    edges = cut(sure.union(confirmed(first, sets, least)))
    release(first, printed)
    parts = component_of(edges)
    # candidates that are not connected yet
    for end in ("u", "v"):
        side = splittable(parts.withColumnRenamed("component", f"{end}_part"), "node")
        near = near.join(side, splittable_on(near, end), "left").drop("_right_hash", "_right_key")
    near = near.where(F.coalesce("u_part", "u") != F.coalesce("v_part", "v")).select("u", "v")

    placed = crowded.join(splittable(parts, "node"), splittable_on(crowded, "node"), "left").select(
        "key", "node", "size", "place", F.coalesce("component", "node").alias("part"), _spare(least).alias("spare"))
    largest = placed.groupBy("key", "part").agg(F.count("*").alias("count"), F.max("spare").alias("spare")).groupBy("key").agg(
        F.max(F.struct("count", "part")).alias("most"), F.count("*").alias("parts"), F.max("spare").alias("most_spare")).where(
        "parts > 1").select("key", F.col("most.part").alias("largest"), "most_spare")
    open_ = placed.join(splittable(largest, "key"), splittable_on(placed, "key")).where(
        F.coalesce(F.col("spare") + F.col("most_spare") + _SLACK >= 0, F.lit(True))).select(
        "key", "node", "size", "place", "part", "largest")
    open_ = cut(open_.join(splittable(sets.select("node", "sketch"), "node"), splittable_on(open_, "node")).drop(
        "_right_hash", "_right_key"))
    across = _pairs(open_.where("part <> largest"), open_,
                    (F.col("a.part") != F.col("b.part")) & _alike("a", "b", least), least)
    second = cut(near.union(across).distinct())
    found = cut(edges.union(confirmed(second, sets, least)).distinct())
    release(met, counted, sets, open_, second, edges)
    return found


def one_of_each_group(docs: DataFrame, shingle: int = 5, least: float = 0.8, **options) -> DataFrame:
    """The documents (all columns) whose doc_id is the smallest of those that links lead to; a null doc_id is smallest.

    Of repeated rows of one doc_id all stay or go together. Null, empty and wordless texts are copies of each other. Long
    texts are whole sets; an empty table stays empty. Only doc_id and text are read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    node = F.when(text.rlike(r"[^ \t\n\x0B\f\r]"), F.xxhash64(text)).otherwise(F.lit(0))
    texts = docs.select(node.alias("node"), doc_key().alias("id"), text.cast("binary").alias("text"))
    found = links(texts, shingle, least, **options)
    parts = component_of(found)
    release(found)
    named = cut(texts.select("node", "id").distinct())
    roots = named.join(splittable(parts, "node"), splittable_on(named, "node"), "left").select(
        "id", F.coalesce("component", "node").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("id").alias("least_id"))
    gone = roots.join(splittable(smallest, "root"), splittable_on(roots, "root")).groupBy("id").agg(
        F.max(F.col("id") == F.col("least_id")).alias("stays")).where(
        "NOT stays").select(F.col("id").alias("_gone_id"))
    return docs.join(cut(gone), docs["doc_id"].cast("long") == F.col("_gone_id"), "left_anti")
