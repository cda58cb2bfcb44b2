"""Byte-level BPE encoding and decoding by a segment tree over adjacent pair ranks.

Each word is a row of leaves, one per adjacent pair of live symbols, holding ``rank * size + position``; an inner
node holds the least of its two children. The root thus names the leftmost pair of lowest rank. A merge changes
three leaves, and each change climbs to the root in log2(size) steps, until the root holds no mergeable pair.

Short words climb together: the trees of all new words of a batch are rows of one array. Long words (over
``LONG`` bytes) use the same tree one at a time. Words already seen are kept in a bounded memo per Python worker.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from pagefold.llm.common import only, slices

#: The public pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space that Unicode has beyond ASCII, with the separators that Python's own patterns count as space.
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -     　]")
#: White space and the run of other characters after it: no match of PATTERN crosses such a border.
UNIT = re.compile(r"[ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+")
LONG = 64
MEMO_WORDS = 400_000
NONE = np.int64(1) << 62


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), ord("\xff") + 1)]
    names = {b: chr(b) for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in names):
        names[b] = chr(256 + i)
    return [names[b] for b in range(256)]


class SegmentTreeBPE:
    """Encoder and decoder for a byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, symbols = spec["model"]["vocab"], byte_symbols()
        self.byte_id = np.array([vocab[s] for s in symbols], np.int64)
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs.setdefault(vocab[a] << 32 | vocab[b], (rank, vocab[a + b]))
        keys = np.array(sorted(self.pairs), np.int64)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.ranks = np.array([*(self.pairs[int(k)][0] for k in keys), 0], np.int64)
        self.merged = np.array([*(self.pairs[int(k)][1] for k in keys), 0], np.int64)
        self.by_rank = np.zeros(max(self.ranks) + 1, np.int64)
        self.by_rank[self.ranks[:-1]] = self.merged[:-1]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        value = {c: b for b, c in enumerate(symbols)}
        self.bytes_of: dict[int, bytes] = {i: bytes(value[c] for c in t) for t, i in vocab.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.split = regex.compile(PATTERN)
        self.memo: dict[str, bytes] = {}

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; NONE where they don't merge."""
        key = (a << 32) | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def _together(self, words: list[bytes], size: int) -> list[np.ndarray]:
        """Words of at most `size` bytes (a power of two), each with a tree in one row."""
        n, shift = len(words), size.bit_length()
        length = np.array([len(w) for w in words])
        raw = np.zeros((n, size), np.uint8)
        for i, w in enumerate(words):
            raw[i, : len(w)] = np.frombuffer(w, np.uint8)
        tok = self.byte_id[raw]
        nxt = np.tile(np.arange(1, size + 1), (n, 1))
        nxt = np.minimum(nxt, length[:, None])
        prv = np.tile(np.arange(-1, size - 1), (n, 1))
        tree = np.full((n, 2 * size), NONE)
        rank = self.rank_of(tok[:, :-1], tok[:, 1:]) if size > 1 else np.empty((n, 0), np.int64)
        rank[np.arange(1, size)[None, :] >= length[:, None]] = NONE
        here = np.arange(size - 1)
        tree[:, size : 2 * size - 1] = np.where(rank == NONE, NONE, (rank << shift) | here)
        width = size
        while width > 1:
            tree[:, width // 2 : width] = np.minimum(tree[:, width : 2 * width : 2], tree[:, width + 1 : 2 * width : 2])
            width //= 2
        live = np.ones((n, size), bool) & (np.arange(size)[None, :] < length[:, None])
        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            root = tree[rows, 1]
            i = root & ((1 << shift) - 1)
            tok[rows, i] = self.by_rank[root >> shift]
            j = nxt[rows, i]
            k = nxt[rows, j]
            live[rows, j] = False
            nxt[rows, i] = k
            more = k < length[rows]
            prv[rows[more], k[more]] = i[more]
            tree[rows, size + j] = NONE
            right = np.full(len(rows), NONE)
            r, im, km = rows[more], i[more], k[more]
            right[more] = self.rank_of(tok[r, im], tok[r, km])
            tree[rows, size + i] = np.where(right == NONE, NONE, (right << shift) | i)
            p = prv[rows, i]
            before = p >= 0
            r, pb = rows[before], p[before]
            left = self.rank_of(tok[r, pb], tok[r, i[before]])
            tree[r, size + pb] = np.where(left == NONE, NONE, (left << shift) | pb)
            spots = (size + i, size + j, size + np.maximum(p, 0))
            at = [s >> 1 for s in spots]
            while at[0][0] >= 1:
                for s in at:
                    tree[rows, s] = np.minimum(tree[rows, 2 * s], tree[rows, 2 * s + 1])
                at = [s >> 1 for s in at]
            rows = rows[tree[rows, 1] != NONE]
        return [tok[i][live[i]] for i in range(n)]

    def _alone(self, word: bytes) -> np.ndarray:
        """The same tree for one long word."""
        n = len(word)
        size = 1 << max(1, (n - 1).bit_length())
        shift, none, pairs = size.bit_length(), int(NONE), self.pairs
        tok = [int(self.byte_id[b]) for b in word]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))

        def leaf(i: int, j: int) -> int:
            found = pairs.get(tok[i] << 32 | tok[j])
            return none if found is None else found[0] << shift | i

        tree = [none] * (2 * size)
        for i in range(n - 1):
            tree[size + i] = leaf(i, i + 1)
        for s in range(size - 1, 0, -1):
            tree[s] = min(tree[2 * s], tree[2 * s + 1])

        def put(i: int, value: int) -> None:
            s = size + i
            tree[s] = value
            s >>= 1
            while s:
                least = tree[2 * s] if tree[2 * s] < tree[2 * s + 1] else tree[2 * s + 1]
                if tree[s] == least:
                    break
                tree[s] = least
                s >>= 1

        dead = bytearray(n)
        while tree[1] != none:
            rank, i = tree[1] >> shift, tree[1] & ((1 << shift) - 1)
            j = nxt[i]
            k = nxt[j]
            tok[i], nxt[i], dead[j] = int(self.by_rank[rank]), k, 1
            put(j, none)
            if k < n:
                prv[k] = i
            put(i, leaf(i, k) if k < n else none)
            if prv[i] >= 0:
                put(prv[i], leaf(prv[i], i))
        return np.array([t for t, d in zip(tok, dead) if not d], np.int64)

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        out: list = [None] * len(words)
        by_size: dict[int, list[int]] = {}
        for at, w in enumerate(words):
            if len(w) > LONG:
                out[at] = self._alone(w)
            else:
                by_size.setdefault(1 << (len(w) - 1).bit_length(), []).append(at)
        for size, spots in by_size.items():
            for start in range(0, len(spots), 20_000):
                part = spots[start : start + 20_000]
                for at, ids in zip(part, self._together([words[x] for x in part], size)):
                    out[at] = ids
        return out

    def units(self, text: str) -> list[str]:
        """Pieces of the text that encode on their own and join to the whole."""
        return self.split.findall(text) if OTHER_SPACE.search(text) else UNIT.findall(text)

    def _learn(self, units: set[str]) -> None:
        """Makes sure that the memo has these units; it starts anew when it is full."""
        new = units.difference(self.memo)
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
            new = units
        found = [(u, self.split.findall(u)) for u in new]
        distinct = list({w for _, words in found for w in words})
        ids = dict(zip(distinct, (x.astype("<u4").tobytes() for x in self.encode_words([w.encode() for w in distinct]))))
        for u, words in found:
            self.memo[u] = b"".join([ids[w] for w in words])

    def encode_batch(self, texts: list[str], at_once: int = 128) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        special, memo = self.special, self.memo
        for start in range(0, len(texts), at_once):
            parts = [self.at_special.split(t) if self.at_special and self.at_special.search(t) else [t] for t in texts[start : start + at_once]]
            units = [[p if p in special else self.units(p) for p in t] for t in parts]
            self._learn({u for t in units for p in t if isinstance(p, list) for u in p})
            for t in units:
                yield b"".join([b"".join([memo[u] for u in p]) if isinstance(p, list) else special[p].to_bytes(4, "little") for p in t])

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that are no UTF-8 become U+FFFD, and ids that the vocabulary lacks nothing."""
        get = self.bytes_of.get
        return b"".join([get(i, b"") for i in ids.tolist()]).decode("utf-8", "replace")


@lru_cache(2)
def coder(path: str) -> SegmentTreeBPE:
    """One coder per vocabulary and Python worker."""
    return SegmentTreeBPE(path)


def encode(docs: DataFrame, vocab_path: str, text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Encodes every whole text and decodes it again.

    Returns per row: the key, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers),
    decoded_sha256 (of the decoded text), and with `with_ids` also ids (array<int>) and decoded (string).
    A null text counts as empty: no ids, and the digests of nothing. Repeated rows and null keys stay rows of their
    own; further columns are left out. An empty table gives an empty one.
    """
    source = only(docs, key, text)
    kind = source.schema[0].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocab_path)
        for batch in slices(batches, 1):
            keys, rows = batch.column(0), []
            for ids in bpe.encode_batch([t or "" for t in batch.column(1).to_pylist()]):
                n = np.frombuffer(ids, "<u4")
                decoded = bpe.decode(n)
                rows.append((len(n), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), *((n.astype(np.int32), decoded) if with_ids else ())))
            columns = list(zip(*rows)) or [()] * (5 if with_ids else 3)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
            arrays = [keys, *(pa.array(list(c), k) for c, k in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    return source.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocab_path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """Adds the text that an array of ids stands for; null ids give null. The column `out` must be new."""
    if out in encoded.columns:
        raise ValueError(f"column {out} is there already")
    at, schema = encoded.columns.index(ids), StructType([*encoded.schema.fields, StructField(out, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(vocab_path)
        for batch in batches:
            texts = [None if x is None else bpe.decode(np.array(x, np.int64)) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return encoded.mapInArrow(run, schema)
