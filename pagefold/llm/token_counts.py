"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie with two roots, one for the start of a word and one for its continuation. Each node has a
failure link to the node that stands for what is left after the longest pieces are taken off, and the number of
pieces that this takes off. A word costs one step a byte and as many failure steps at most; no piece is ever built.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from pagefold.llm.bpe import byte_symbols
from pagefold.llm.common import WORD, only, slices

MEMO_WORDS = 600_000
WORDS = re.compile(WORD)


class LongestMatch:
    """Counts the pieces of words for a vocabulary of initial and continuing pieces (bytes)."""

    def __init__(self, initial: Iterable[bytes], continuing: Iterable[bytes]):
        start, rest = 0, 1
        step: dict[int, int] = {}  # node * 256 + byte -> node
        ends: set[int] = set()
        nodes = 2
        for root, pieces in ((start, initial), (rest, continuing)):
            for piece in pieces:
                u = root
                for byte in piece:
                    v = step.get(u << 8 | byte)
                    if v is None:
                        v = step[u << 8 | byte] = nodes
                        nodes += 1
                    u = v
                if u != root:
                    ends.add(u)
        fail, pops = [-1] * nodes, [0] * nodes
        children: dict[int, list[tuple[int, int]]] = {}
        for key, v in step.items():
            children.setdefault(key >> 8, []).append((key & 255, v))
        level = [start, rest]
        while level:
            below = []
            for u in level:
                for byte, v in children.get(u, ()):
                    below.append(v)
                    if v in ends:
                        fail[v], pops[v] = rest, 1
                        continue
                    z, popped = fail[u], pops[u]
                    while z >= 0 and (z << 8 | byte) not in step:
                        popped += pops[z]
                        z = fail[z]
                    if z >= 0:
                        fail[v], pops[v] = step[z << 8 | byte], popped
            level = below
        self.step, self.fail, self.pops, self.rest = step, fail, pops, rest

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1 (the unknown piece) where the vocabulary can't cover it, 0 for an empty word."""
        step, fail, pops = self.step, self.fail, self.pops
        u = n = 0
        for byte in word:
            v = step.get(u << 8 | byte)
            while v is None:
                n += pops[u]
                u = fail[u]
                if u < 0:
                    return 1
                v = step.get(u << 8 | byte)
            u = v
        if not word:
            return 0
        while u != self.rest:
            n += pops[u]
            u = fail[u]
            if u < 0:
                return 1
        return n


class FileCounter:
    """Word pieces of a byte-level vocabulary file: pieces with a leading space start a word, all others continue it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        value = {c: b for b, c in enumerate(byte_symbols())}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        pieces = [bytes(value[c] for c in t) for t in spec["model"]["vocab"] if t not in special]
        self.pieces = LongestMatch([p for p in pieces if p[:1] == b" "], [p for p in pieces if p[:1] != b" "])
        self.memo: dict[str, int] = {}

    def count_text(self, text: str) -> tuple[int, int]:
        """Words and pieces of a text."""
        words, memo = WORDS.findall(text), self.memo
        try:
            return len(words), sum(map(memo.__getitem__, words))
        except KeyError:
            if len(memo) > MEMO_WORDS:
                memo.clear()
            for w in set(words).difference(memo):
                memo[w] = self.pieces.count(b" " + w.encode())
            return len(words), sum(map(memo.__getitem__, words))


@lru_cache(2)
def counter(path: str) -> FileCounter:
    return FileCounter(path)


def token_counts(docs: DataFrame, vocab_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Number of words (runs of anything but ASCII white space) and of greedy longest-match pieces in each whole text.

    Returns per row: the key, n_words, n_tokens. Null and empty texts have 0 of both; repeated rows and null keys
    stay rows of their own; further columns are left out.
    """
    source = only(docs, key, text)
    schema = f"`{key}` {source.schema[0].dataType.simpleString()}, n_words bigint, n_tokens bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocab_path).count_text
        for batch in slices(batches, 1):
            found = [count(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], [key, "n_words", "n_tokens"])

    return source.mapInArrow(run, schema)
