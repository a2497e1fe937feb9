"""Sharding by a k-d tree over document metadata, balanced by bytes (law ``bytes``).

The root holds all documents. A node is split at a weighted median (weight: bytes) along the dimension in which it is
widest, relative to the root: text size, source, language (as hashes) and doc_id. Leaves are the shards; a node of n
shards gives n // 2 of them to its left child and aims at that share of its bytes.

Medians are found without sorting: a pass counts bytes in ``bins`` ranges of the key for all nodes of a level at once
and goes on inside the range that holds the median. Documents with equal coordinates are ordered by a hash of the text
and then doc_id, so equal texts lie side by side. They take the metadata of their first document and stay in one shard,
unless the median falls into a group of more than ``whole_group`` of a shard's bytes; such a group is split by doc_id.
Only bins reach the driver: ``bins`` rows per open node.

Null texts have size 1 and equal each other; a null source, language or doc_id is a value like
others. Repeated rows stay together. An empty table gives no rows. Only doc_id, text, lang and source are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, doc_key, splittable, splittable_on, table

DIMENSIONS = ("_size", "_source", "_lang", "_id")
_KEYS = ("_group", "_doc")


@dataclass
class Node:
    """A node of ``shards`` shards from ``first`` on; ``keys`` are the columns of its order, ``cut`` the first values
    that belong to its right child (fewer values than keys: the rest doesn't matter)."""
    first: int
    shards: int
    bytes: int = 0
    keys: tuple = ()
    cut: tuple = ()
    children: list = field(default_factory=list)


def _before(keys: tuple, values: tuple) -> Column:
    """The row's keys come before the values in lexicographic order."""
    column, value = F.col(keys[0]), F.lit(values[0]).cast("long")
    if len(values) == 1:
        return column < value
    return (column < value) | ((column == value) & _before(keys[1:], values[1:]))


def _assign(node: Node, leaf) -> Column:
    """The number that ``leaf`` gives the row's node."""
    if not node.children:
        return F.lit(leaf(node))
    left, right = node.children
    return F.when(_before(node.keys, node.cut), _assign(left, leaf)).otherwise(_assign(right, leaf))


def _medians(rows: DataFrame, nodes: list[Node], bins: int, exact: float, whole: float) -> None:
    """Sets ``cut`` of each node; ``rows`` has _node, the number of the row's node in the list (or -1)."""
    open_ = {i: {"fixed": (), "low": None, "high": None, "before": 0} for i in range(len(nodes))}
    while open_:
        ends = [i for i in open_ if open_[i]["low"] is None]
        if ends:  # the range of the next key, inside the fixed ones
            found = rows.where(_inside(nodes, open_, ends)).groupBy("_node").agg(
                F.min(_key(nodes, open_, ends)).alias("low"), F.max(_key(nodes, open_, ends)).alias("high"),
                F.sum("size").alias("bytes")).collect()
            for r in found:
                open_[r["_node"]] |= {"low": r.low, "high": r.high}
                if not open_[r["_node"]]["fixed"]:
                    nodes[r["_node"]].bytes = r.bytes
            for i in set(ends) - {r["_node"] for r in found}:  # no rows: any cut will do
                nodes[i].cut = (0,)
                del open_[i]
            continue
        keys = sorted(open_)
        bin_ = F.lit(-1).cast("long")
        for i in keys:
            state = open_[i]
            state["width"] = (state["high"] - state["low"]) // bins + 1
            offset = F.col(nodes[i].keys[len(state["fixed"])]) - F.lit(state["low"]).cast("long")
            bin_ = F.when(F.col("_node") == i, F.floor(offset / F.lit(state["width"])) if state["width"] < 1 << 40
                          else F.shiftrightunsigned(offset, state["width"].bit_length() - 1)).otherwise(bin_)
            if state["width"] >= 1 << 40:
                state["width"] = 1 << (state["width"].bit_length() - 1)
        counted: dict[int, list] = {i: [] for i in keys}
        for r in rows.where(_inside(nodes, open_, keys)).groupBy("_node", bin_.alias("bin")).agg(
                F.sum("size").alias("bytes")).collect():
            counted[r["_node"]].append((r.bin, r.bytes))
        for i in keys:
            _narrow(nodes[i], open_[i], sorted(counted[i]), exact, whole)
            if nodes[i].cut:
                del open_[i]


def _key(nodes: list[Node], open_: dict, which: list[int]) -> Column:
    out = F.lit(None).cast("long")
    for i in which:
        out = F.when(F.col("_node") == i, F.col(nodes[i].keys[len(open_[i]["fixed"])])).otherwise(out)
    return out


def _inside(nodes: list[Node], open_: dict, which: list[int]) -> Column:
    """Rows of some nodes that still may hold the median."""
    out = F.lit(False)
    for i in which:
        state, here = open_[i], F.col("_node") == i
        for key, value in zip(nodes[i].keys, state["fixed"]):
            here = here & (F.col(key) == F.lit(value).cast("long"))
        if state["low"] is not None:
            here = here & F.col(nodes[i].keys[len(state["fixed"])]).between(
                F.lit(state["low"]).cast("long"), F.lit(state["high"]).cast("long"))
        out = out | here
    return out


def _narrow(node: Node, state: dict, counted: list, exact: float, whole: float) -> None:
    """One step of the search: a smaller range, the next key, or the cut."""
    target = node.bytes * (node.shards // 2) / node.shards
    total = state["before"]
    for at, size in counted:
        if total + size >= target:
            break
        total += size
    low = state["low"] + at * state["width"]
    single = state["width"] == 1
    last = len(state["fixed"]) + 1 == len(node.keys)
    is_group = single and node.keys[len(state["fixed"])] == "_group"
    if size <= exact or (single and last) or (is_group and size <= whole):
        nearer = total + size - target < target - total
        node.cut = state["fixed"] + (low + state["width"] if nearer else low,)
    elif single:
        state |= {"fixed": state["fixed"] + (low,), "low": None, "high": None, "before": total}
    else:
        state |= {"low": low, "high": min(state["high"], low + state["width"] - 1), "before": total}


def grow_tree(points: DataFrame, shards: int, bins: int, whole_group: float) -> Node:
    """The tree over points with size, the dimensions and the two keys that order equal coordinates."""
    ends = [f(d).alias(f"{n}{d}") for d in DIMENSIONS for n, f in (("low", F.min), ("high", F.max))]
    root, level = Node(0, shards), [Node(0, shards)]
    all_ = points.agg(F.sum("size").alias("bytes"), *ends).first()
    if all_.bytes is None:
        return root
    extent = {d: max(1, all_[f"high{d}"] - all_[f"low{d}"]) for d in DIMENSIONS}
    target, level = all_.bytes / shards, [root]
    while level := [n for n in level if n.shards > 1]:
        number = {id(n): i for i, n in enumerate(level)}
        rows = points.withColumn("_node", _assign(root, lambda n: number.get(id(n), -1)))
        for r in rows.where("_node >= 0").groupBy("_node").agg(*ends).collect():
            widest = max(DIMENSIONS, key=lambda d: (r[f"high{d}"] - r[f"low{d}"]) / extent[d])
            level[r["_node"]].keys = (widest, *_KEYS)
        for n in level:
            n.keys = n.keys or (DIMENSIONS[0], *_KEYS)
        _medians(rows, level, bins, target * whole_group / 10, target * whole_group)
        for n in level:
            half = n.shards // 2
            n.children = [Node(n.first, half), Node(n.first + half, n.shards - half)]
        level = [c for n in level for c in n.children]
    return root


def shard(docs: DataFrame, shards: int = 16, bins: int = 4096, whole_group: float = 0.01) -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes plus 1), text_crc32, shard and slot (gapless from 0 in
    each shard, in order of blocks of documents)."""
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), doc_key().alias("_doc"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64("text"), 1).alias("_group"),
        F.coalesce(F.crc32(F.col("source").cast("binary")), F.lit(-1)).cast("long").alias("_source"),
        F.coalesce(F.crc32(F.col("lang").cast("binary")), F.lit(-1)).cast("long").alias("_lang"))
    plain = cut(plain)
    groups = plain.groupBy("_group").agg(
        F.min("_doc").alias("_first"), F.min_by("_source", "_doc").alias("_s"), F.min_by("_lang", "_doc").alias("_l"))
    points = plain.drop("_source", "_lang").join(splittable(groups, "_group"), splittable_on(plain, "_group")).select(
        "doc_id", "size", "text_crc32", "_group", F.shiftrightunsigned("_doc", 1).alias("_doc"),
        F.col("size").alias("_size"), F.col("_s").alias("_source"), F.col("_l").alias("_lang"),
        F.shiftrightunsigned("_first", 1).alias("_id"))
    points = cut(points)
    root = grow_tree(points, shards, bins, whole_group)
    blocks = F.pmod(F.xxhash64("doc_id", "_group"), F.lit(max(1, int(
        docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    placed = points.withColumn("shard", _assign(root, lambda n: n.first)).withColumn("_block", blocks).select(
        "doc_id", "size", "text_crc32", "shard", "_block", "_group")
    sizes = placed.groupBy("shard", "_block").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    own = Window.partitionBy("shard", "_block").orderBy("doc_id", "_group")
    return placed.withColumn("_row", F.row_number().over(own)).join(starts, ["shard", "_block"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_start") + F.col("_row") - 1).alias("slot"))


def op8_kd_shards(spark, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
