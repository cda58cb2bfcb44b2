"""Near-duplicates by SimHash, found through an index of fingerprint bytes at their positions.

Fingerprints within `max_bits` of each other differ in as many of their 8 bytes at most, so they share 8 - max_bits
positional bytes: the count filter. Posting lists of single bytes would hold 1/256 of all rows each; lists of
byte triples (quads in very large sets) lose no pair that passes the filter, as the chosen position sets meet every
choice of 8 - max_bits positions. Pairs on a list are tallied by their shared positional bytes, those under the
guaranteed minimum fall away, and the rest are verified by their differing bits. A list yields links that span its
linked fingerprints, never all of their pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.llm.common import ASCII_LOWER, BATCH_ROWS, WORD, arrow_rows, keep_marked, only, slices, written

WORDS = re.compile(WORD)
#: Distinct fingerprints beyond which byte quads are indexed, as triples would share lists by chance.
QUADS_FROM = 1 << 26
#: A list of more fingerprints is cut into blocks of this size, and pairs of blocks are dealt out.
BLOCK = 2048


def fingerprint(text: str, n: int = 4) -> int:
    """SimHash of the word n-gram shingles (repeats included) of a text; 0 without words."""
    words = WORDS.findall(text.translate(ASCII_LOWER))
    if not words:
        return 0
    encoded = [w.encode() for w in words]
    joined = b" ".join(encoded)
    if len(words) <= n:
        digests, count = xxhash.xxh64_digest(joined, 42), 1
    else:
        ends = np.cumsum([len(w) + 1 for w in encoded])
        starts, digest = [0, *ends[:-1].tolist()], xxhash.xxh64_digest
        count = len(words) - n + 1
        digests = b"".join([digest(joined[a:b], 42) for a, b in zip(starts, (ends[n - 1 :] - 1).tolist())])
    raw = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, 1 << 16):
        ones += np.unpackbits(raw[start : start + (1 << 16)], axis=1).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def text_sign(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = 4) -> DataFrame:
    """key, sign (a hash of the text) and fp (the fingerprint as a signed 64-bit integer) of each row."""
    source = only(docs, key, text).withColumn("sign", text_sign(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            prints = np.array([fingerprint(t or "", n) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints.view(np.int64))], [key, "sign", "fp"])

    return source.mapInArrow(run, f"`{key}` {source.schema[0].dataType.simpleString()}, sign bigint, fp bigint")


def position_sets(size: int, least: int) -> list[tuple[int, ...]]:
    """Sets of `size` byte positions such that any `least` of the 8 positions contain one whole set.

    For 3 of 4 positions: the 8 positions in a ring of three parts; a set lies in one part, or has two positions of a
    part and one of the next (Turan's construction). Otherwise all sets.
    """
    every = list(combinations(range(8), size))
    if (size, least) != (3, 4):
        return every
    part = lambda p: p % 3
    chosen = []
    for s in every:
        counts = [sum(part(p) == g for p in s) for g in range(3)]
        if 3 in counts or any(counts[g] == 2 and counts[(g + 1) % 3] == 1 for g in range(3)):
            chosen.append(s)
    return chosen


def linked(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Whether fingerprints share enough positional bytes and differ in few enough bits."""
    x = a ^ b
    out = np.zeros(x.shape, bool)
    shared = (x.view(np.uint8).reshape(*x.shape, 8) == 0).sum(-1)
    tally = shared >= 8 - max_bits
    out[tally] = np.bitwise_count(x[tally]) <= max_bits
    return out


def spanning(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest node that each of n nodes reaches over links i-j."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links(prints: DataFrame, max_bits: int = 4, quads_from: int = QUADS_FROM, block: int = BLOCK) -> DataFrame:
    """Links (a, b), a != b, that connect just what pairs within max_bits connect, for distinct fingerprints `fp`."""
    if max_bits > 4:
        raise ValueError("at most 4 differing bits")
    size = 4 if prints.count() >= quads_from else 3
    sets = position_sets(size, 8 - max_bits)
    value = lambda s: sum((F.shiftrightunsigned("fp", 8 * (7 - p)).bitwiseAND(F.lit(255)) * F.lit(256 ** (size - 1 - k)) for k, p in enumerate(s)), F.lit(0).cast("bigint"))
    lists = prints.select("fp", F.posexplode(F.array(*[value(s) for s in sets]))).select((F.col("pos").cast("bigint") * F.lit(1 << 32) + F.col("col")).alias("list"), "fp")
    lists = lists.repartition("list").sortWithinPartitions("list", "fp")

    def within(lists_of: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links on lists that are neighbours in the arrays."""
        left, right, gap = [], [], 1
        while gap < len(fp):
            at = np.flatnonzero(lists_of[gap:] == lists_of[:-gap])
            if not len(at):
                break
            for part in np.array_split(at, len(at) // 1_000_000 + 1):
                good = part[linked(fp[part], fp[part + gap], max_bits)]
                left.append(good)
                right.append(good + gap)
            gap += 1
        if not left:
            return fp[:0], fp[:0]
        label = spanning(np.concatenate(left), np.concatenate(right), len(fp))
        at = np.flatnonzero(label != np.arange(len(fp)))
        return fp[at], fp[label[at]]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links_out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.binary())], ["a", "b", "list", "block", "fps"])

        def block_out(which: int, number: int, fp: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([which], pa.int64()), pa.array([number], pa.int32()), pa.array([fp.tobytes()], pa.binary())], ["a", "b", "list", "block", "fps"])

        keys, fps, cut = np.empty(0, np.int64), np.empty(0, np.uint64), {}
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            last = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if last:
                yield from whole(keys[:last], fps[:last], cut, links_out, block_out)
                keys, fps = keys[last:], fps[last:]
            while len(keys) > 2 * block:  # a long list leaves block by block
                number = cut.get(int(keys[0]), 0)
                yield block_out(int(keys[0]), number, fps[:block])
                cut.clear()
                cut[int(keys[0])] = number + 1
                keys, fps = keys[block:], fps[block:]
        if len(keys):
            yield from whole(keys, fps, cut, links_out, block_out)

    def whole(keys, fps, cut, links_out, block_out) -> Iterator[pa.RecordBatch]:
        """Complete lists; those that are long, or whose first blocks have left, go as blocks."""
        starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
        sizes = np.diff(np.append(starts, len(keys)))
        long = (sizes > block) | np.array([int(keys[s]) in cut for s in starts[:1]] + [False] * (len(starts) - 1))
        for s, n in zip(starts[long], sizes[long]):
            number = cut.pop(int(keys[s]), 0)
            for k in range(0, n, block):
                yield block_out(int(keys[s]), number + k // block, fps[s + k : s + min(k + block, n)])
        short = np.repeat(~long, sizes)
        if short.any():
            yield links_out(*within(keys[short], fps[short]))

    with arrow_rows(prints.sparkSession, 20_000):
        found = written(lists.mapInArrow(scan, "a bigint, b bigint, list bigint, block int, fps binary"), "links")
    out = found.filter("a is not null").select("a", "b")
    blocks = found.filter("list is not null")
    if blocks.limit(1).count():
        n = blocks.count()
        one = blocks.select("list", F.col("block").alias("i"), F.col("fps").alias("x"))
        two = blocks.select("list", F.col("block").alias("j"), F.col("fps").alias("y"))
        pairs = one.join(two, (one["list"] == two["list"]) & (F.col("i") <= F.col("j"))).select("x", "y").repartition(max(8, min(4 * n, 4000)))

        def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for x, y in zip(batch.column(0), batch.column(1)):
                    a, b = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                    both = np.concatenate([a, b])
                    label = np.arange(len(both))
                    for start in range(0, len(a), 256):
                        i, j = np.nonzero(linked(np.repeat(a[start : start + 256, None], len(b), 1), np.repeat(b[None], len(a[start : start + 256]), 0), max_bits))
                        more = np.concatenate([np.arange(len(both)), i + start]), np.concatenate([label, j + len(a)])
                        label = spanning(*more, len(both))
                    at = np.flatnonzero(both != both[label])
                    yield pa.RecordBatch.from_arrays([pa.array(both[at].view(np.int64)), pa.array(both[label[at]].view(np.int64))], ["a", "b"])

        out = out.unionByName(pairs.mapInArrow(across, "a bigint, b bigint"))
    return out.distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Smallest node (root) that each node of the links (a, b) reaches, by alternating large and small stars.

    Each round is written to the shared folder; only two sums come to the driver. A node with very many links is
    met as pre-aggregated minima and by joins that Spark splits.
    """
    now = written(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    mark = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # in written storage, so that Spark can split the joins where one node has very many links
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m")), "least")
        large = both.join(least, both["u"] == least["c"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = written(large, "large")
        low = written(large.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")), "low")
        small = large.join(low, large["u"] == low["c"]).select("v", "m").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select(F.col("c").alias("u"), F.col("m").alias("v"))).filter("u != v").distinct()
        now = written(small, "stars")
        total = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(total) == mark:
            return now.groupBy("u").agg(F.min("v").alias("root"))
        mark = tuple(total)
    raise RuntimeError("the components did not settle")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = 4, max_bits: int = 4) -> DataFrame:
    """Fingerprint and component of every row.

    Returns: the key, fingerprint (16 lowercase hex digits), component_id (smallest key of a row reachable over
    links of at most max_bits differing bits, itself included). Equal fingerprints are linked, those of texts without
    words (zero) too; null texts count as empty. Repeated rows stay rows. Null keys get a component, but count in
    none. Further columns are left out.
    """
    return classes(docs, text, key, n, max_bits).select(F.col("k").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def classes(docs: DataFrame, text: str, key: str, n: int, max_bits: int) -> DataFrame:
    """k, sign, fp and component_id of every row."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        prints = written(fingerprints(docs, text, key, n).toDF("k", "sign", "fp"), "prints")
    distinct = written(prints.groupBy("fp").agg(F.min("k").alias("low")), "distinct")
    roots = components(links(distinct.select("fp"), max_bits)).withColumnRenamed("u", "fp")
    classed = written(distinct.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "classes")
    lows = written(classed.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    by_print = written(classed.join(lows, "root").select("fp", "component_id"), "by-print")
    return prints.join(by_print, "fp")


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest key (of repeated rows the greatest by the rest).

    Rows without a key are kept only where no row of their component has one.
    """
    found = classes(docs, text, key, n, max_bits)
    found = written(found.select(F.col("k").alias("__key"), F.col("sign").alias("__sign"), F.col("k").eqNullSafe(F.col("component_id")).alias("__kept")), "found")
    marks = found.groupBy("__key", "__sign").agg(F.max("__kept").alias("__kept"), F.count(F.lit(1)).alias("__n")).filter("not __kept or __n > 1")
    return keep_marked(docs, key, text_sign(text), written(marks, "marks"))
