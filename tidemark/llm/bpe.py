"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word starts as single symbols. The leaves of a tournament tree hold the merge rank of each adjacent pair; the root
names the leftmost pair of lowest rank. A merge changes at most two pairs and removes one leaf, each a point update of
logarithmic cost, until the root holds no mergeable pair. Long words without white space therefore cost n log n.

The tokenizer is a JSON vocabulary file (its path is a parameter, nothing is trained): special tokens are cut out of the
raw text, the rest is put in NFC and lower case, split by the file's pattern, and each piece is mapped to byte symbols
with a word end on the last. Decoding joins the symbols of the ids by one space, as the file names no decoder.

A null text is encoded as an empty one: no tokens. Rows are independent, repeated rows give repeated results.
"""

from __future__ import annotations

import gc
import hashlib
import json
import struct
import unicodedata
from functools import lru_cache
from operator import itemgetter

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts, table

#: Rank of a pair that can't be merged.
NO_MERGE = 1 << 30
#: White space of Unicode (property White_Space).
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: visible Latin-1 stays, the others follow from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0x100
    for byte in range(256):
        out.append(chr(byte if byte in visible else extra))
        extra += byte not in visible
    return out


class PairTrees:
    """Segment trees of one size, one per word, side by side in arrays.

    ``node[w, 1]`` is the root of word w and ``node[w, size + i]`` the rank of its i-th adjacent pair. A node holds the
    smaller rank of its children; on the way down the left child wins ties, which gives the leftmost lowest pair.
    """

    def __init__(self, leaves: np.ndarray):
        words, self.size = leaves.shape
        self.node = np.full((words, 2 * self.size), NO_MERGE, np.int32)
        self.node[:, self.size:] = leaves
        half = self.size // 2
        while half:
            np.minimum(self.node[:, 2 * half:4 * half:2], self.node[:, 2 * half + 1:4 * half:2],
                       out=self.node[:, half:2 * half])
            half //= 2
        self.flat = self.node.reshape(-1)

    def roots(self, words: np.ndarray) -> np.ndarray:
        return self.node[words, 1]

    def leftmost(self, words: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """The leaf that holds each word's root rank."""
        base, at = words * (2 * self.size), np.ones(len(words), np.int64)
        for _ in range(self.size.bit_length() - 1):
            at *= 2
            at += self.flat[base + at] != ranks
        return at - self.size

    def set(self, words: np.ndarray, leaf: np.ndarray, ranks: np.ndarray | int) -> None:
        """Point updates: one leaf in each of some words."""
        base, at = words * (2 * self.size), leaf + self.size
        self.flat[base + at] = ranks
        for _ in range(self.size.bit_length() - 1):
            at >>= 1
            child = base + 2 * at
            self.flat[base + at] = np.minimum(self.flat[child], self.flat[child + 1])


class PairTree:
    """The same tree for one long word: a round on arrays would cost more than these few steps."""

    def __init__(self, ranks: list[int]):
        self.size = 1 << max(0, (len(ranks) - 1).bit_length())
        self.node = [NO_MERGE] * self.size + ranks + [NO_MERGE] * (self.size - len(ranks))
        for i in range(self.size - 1, 0, -1):
            self.node[i] = min(self.node[2 * i], self.node[2 * i + 1])

    def leftmost(self) -> int:
        """The leaf of the root's rank, or -1 if no pair can be merged."""
        node, rank, i = self.node, self.node[1], 1
        while i < self.size:
            i = 2 * i + (node[2 * i] != rank)
        return i - self.size if rank < NO_MERGE else -1

    def set(self, leaf: int, rank: int) -> None:
        node, i = self.node, self.size + leaf
        node[i] = rank
        while i > 1:
            i >>= 1
            best = min(node[2 * i], node[2 * i + 1])
            if node[i] == best:
                return
            node[i] = best


#: Words of more bytes than this get a tree of their own.
LONG_WORD = 1024


class Bpe:
    """A tokenizer read from a vocabulary file; ``encode`` and ``decode`` work on one text."""

    def __init__(self, path: str, most_cached: int = 400_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.symbols = {i: s for s, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.symbols.update({i: s for s, i in self.special.items()})
        self.end = model["end_of_word_suffix"] or ""
        #: Merges sorted by the ids of their two parts; the id of the result by rank.
        pairs = np.array([self.vocab[l] << 32 | self.vocab[r] for l, r in model["merges"]], np.int64)
        self.keys, self.ranks = np.unique(pairs, return_index=True)
        self.result = np.array([self.vocab[l + r] for l, r in model["merges"]], np.int64)
        names = byte_symbols()
        self.inner = np.array([self.vocab[c] for c in names], np.int64)
        self.last = np.array([self.vocab[c + self.end] for c in names], np.int64)
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern.replace("\\s", _SPACE)).findall
        marks = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, marks)) or "(?!)")
        self.marks = [m.encode() for m in marks]
        self.mark_ids = {m.encode(): (struct.pack("<I", i), m) for m, i in self.special.items()}
        self.by_pair: dict[int, int] | None = None
        self.most = most_cached
        self.chunks: dict[bytes, tuple[bytes, str]] = {}
        self.older: dict[bytes, tuple[bytes, str]] = {}

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_MERGE).astype(np.int32)

    def _merge(self, pieces: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of 2 to size + 1 bytes, end to end, with the end of each; all words advance together, one merge each per round."""
        words, width = len(pieces), size + 2
        lengths = np.fromiter(map(len, pieces), np.int64, words)
        place = np.arange(width)
        real = place < lengths[:, None]
        symbols = np.zeros((words, width), np.uint8)
        symbols[real] = np.frombuffer(b"".join(pieces), np.uint8)
        ids = self.inner[symbols]
        rows = np.arange(words)
        ids[rows, lengths - 1] = self.last[symbols[rows, lengths - 1]]
        pair = place[:size] < (lengths - 1)[:, None]
        trees = PairTrees(np.where(pair, self._rank_of(ids[:, :size], ids[:, 1:size + 1]), NO_MERGE))
        after = np.tile(place + 1, (words, 1))
        before = np.tile(place - 1, (words, 1))
        while len(rows):
            rank = trees.roots(rows)
            rows = rows[rank < NO_MERGE]
            if not len(rows):
                break
            rank = rank[rank < NO_MERGE]
            at = trees.leftmost(rows, rank)
            gone = after[rows, at]
            nxt = after[rows, gone]
            ids[rows, at] = self.result[rank]
            real[rows, gone] = False
            after[rows, at] = nxt
            before[rows, nxt] = at
            inside = gone < size
            trees.set(rows[inside], gone[inside], NO_MERGE)
            more = nxt < lengths[rows]
            trees.set(rows, at, np.where(more, self._rank_of(ids[rows, at], ids[rows, nxt]), NO_MERGE))
            prev = before[rows, at]
            has = prev >= 0
            left = rows[has]
            trees.set(left, prev[has], self._rank_of(ids[left, prev[has]], ids[left, at[has]]))
        return ids[real], np.cumsum(real.sum(axis=1))

    def _merge_long(self, data: bytes) -> list[int]:
        """Ids of one long piece."""
        symbols = np.frombuffer(data, np.uint8)
        first = self.inner[symbols]
        first[-1] = self.last[symbols[-1]]
        ids, n = first.tolist(), len(data)
        tree = PairTree(self._rank_of(first[:-1], first[1:]).tolist())
        if self.by_pair is None:
            self.by_pair = dict(zip(self.keys.tolist(), self.ranks.tolist()))
        after, before = list(range(1, n + 1)), list(range(-1, n))
        rank = lambda a, b: self.by_pair.get(ids[a] << 32 | ids[b], NO_MERGE)
        while (at := tree.leftmost()) >= 0:
            gone = after[at]
            ids[at] = int(self.result[tree.node[tree.size + at]])
            ids[gone] = -1
            nxt = after[at] = after[gone]
            before[nxt] = at
            if gone < n - 1:
                tree.set(gone, NO_MERGE)
            tree.set(at, rank(at, nxt) if nxt < n else NO_MERGE)
            if (prev := before[at]) >= 0:
                tree.set(prev, rank(prev, at))
        return [i for i in ids if i >= 0]

    def encode_pieces(self, pieces: list[str]) -> dict[str, list[int]]:
        """Ids of distinct pieces, grouped by the size of their tree."""
        out, groups = {}, {}
        for piece in pieces:
            data = piece.encode("utf-8")
            if len(data) == 1:
                out[piece] = [int(self.last[data[0]])]
            elif len(data) > LONG_WORD:
                out[piece] = self._merge_long(data)
            else:
                groups.setdefault(1 << max(0, (len(data) - 2).bit_length()), []).append((piece, data))
        for size, group in groups.items():
            step = max(1, (1 << 18) // size)  # bounds the arrays of a round
            for i in range(0, len(group), step):
                some = group[i:i + step]
                ids, ends = self._merge([d for _, d in some], size)
                ids, at = ids.tolist(), 0
                for (piece, _), end in zip(some, ends.tolist()):
                    out[piece] = ids[at:end]
                    at = end
        return out

    def _fill(self, chunks: set[bytes]) -> None:
        """Puts text parts without ASCII white space or special tokens into the cache of ids and symbols."""
        new = {}
        for chunk in chunks:
            if chunk in self.chunks:
                continue
            if (known := self.older.get(chunk)) is not None:
                self.chunks[chunk] = known
                continue
            if chunk in self.mark_ids:  # only a cut-out token is a word with its text: no other word holds it
                self.chunks[chunk] = self.mark_ids[chunk]
                continue
            text = unicodedata.normalize("NFC", chunk.decode("utf-8", "replace"))
            # lower case of each character by itself: only the final sigma depends on its neighbours
            text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
            new[chunk] = self.pieces(text)
        ids_of = self.encode_pieces(list({p for pieces in new.values() for p in pieces}))
        for chunk, pieces in new.items():
            ids = ids_of[pieces[0]] if len(pieces) == 1 else [i for p in pieces for i in ids_of[p]]
            self.chunks[chunk] = struct.pack(f"<{len(ids)}I", *ids), " ".join([self.symbols[i] for i in ids])

    def encode_block(self, texts: list[bytes]) -> list[tuple[bytes, str]]:
        """For each whole UTF-8 text its ids (little-endian, unsigned, 32 bits) and the decoded text."""
        parts = [self._parts(t) for t in texts]
        if len(self.chunks) >= self.most:  # two generations: words seen lately survive, the rest is dropped
            self.older, self.chunks = self.chunks, {}
        unseen: set = set()
        for part in parts:
            unseen.update(set(part).difference(self.chunks))
        collecting = gc.isenabled()
        gc.disable()  # the cache holds no cycles, and scanning it again and again costs half the time
        try:
            self._fill(unseen)
        finally:
            if collecting:
                gc.enable()
        ids, symbols, known = itemgetter(0), itemgetter(1), self.chunks.__getitem__
        out = []
        for part in parts:
            found = list(map(known, part))
            out.append((b"".join(map(ids, found)), " ".join(filter(None, map(symbols, found)))))
        return out

    def _parts(self, data: bytes) -> list:
        """Words of a text, with each special token as a word of its own."""
        if not any(m in data for m in self.marks):
            return data.split()
        found, at, text = [], 0, data.decode("utf-8", "replace")
        for m in self.cut.finditer(text):
            found += text[at:m.start()].encode().split()
            found.append(m[0].encode())
            at = m.end()
        return found + text[at:].encode().split()

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_block([text.encode("utf-8")])[0][0], "<u4").tolist()

    def decode(self, ids) -> str:
        return " ".join([self.symbols[int(i)] for i in ids])


@lru_cache(maxsize=4)
def tokenizer(path: str, most_cached: int = 400_000) -> Bpe:
    """One tokenizer per Python worker and file. It stays with the worker, and so do the words it has cached."""
    return Bpe(path, most_cached)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def encode(
    docs: DataFrame, path: str | None = None, keep: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per document: the ``keep`` columns (default doc_id), ids (array of ids) and decoded (their text)."""
    path = path or default_path()

    def block(texts: list) -> dict:
        import pyarrow as pa
        bpe = tokenizer(path)
        found = bpe.encode_block([t or b"" for t in texts])
        ids = np.frombuffer(b"".join([f[0] for f in found]), "<u4").astype(np.int32)
        ends = np.cumsum([0] + [len(f[0]) // 4 for f in found]).astype(np.int32)
        return {"ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)), "decoded": [f[1] for f in found]}

    return map_texts(docs, block, "ids array<int>, decoded string", keep)


def encode_digests(
    docs: DataFrame, path: str | None = None, keep: dict[str, Column] | None = None, with_ids: bool = False,
    most_cached: int = 400_000,
) -> DataFrame:
    """The ``keep`` columns (default doc_id) with n_tokens and the digests ids_sha256 and decoded_sha256; ``with_ids``
    adds the array of ids."""
    path = path or default_path()

    def block(texts: list) -> dict:
        bpe = tokenizer(path, most_cached)
        out: dict = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        found = bpe.encode_block([t or b"" for t in texts])
        for ids, decoded in found:
            out["n_tokens"].append(len(ids) // 4)
            out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
        if with_ids:
            out["ids"] = [np.frombuffer(ids, "<i4") for ids, _ in found]
        return out

    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return map_texts(docs, block, columns, keep)


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids") -> DataFrame:
    """Adds the column decoded to rows with an array of ids (null: empty)."""
    path = path or default_path()

    @F.pandas_udf("string")
    def text_of(column):
        bpe = tokenizer(path)
        return column.map(lambda x: bpe.decode(x) if x is not None else "")

    return encoded.withColumn("decoded", text_of(F.col(ids)))


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))
