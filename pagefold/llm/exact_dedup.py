"""Exact deduplication by counting quotient filters.

Each partition counts its texts' fingerprints in quotient filters, one per block of the fingerprint space. The
filters of a block merge losslessly, as their remainders are sorted. Fingerprints that the merged filters count more
than once send their documents to verification, where whole texts are compared byte by byte; all others are unique.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagefold.llm.common import arrow_rows, ascii_lower, keep_marked, only, written

#: Fingerprints with copies that are broadcast at most (8 bytes each); beyond it, documents are joined by a shuffle.
BROADCAST_ROWS = 500_000


class QuotientFilter:
    """A counting quotient filter as its run of slots, in order of quotient and remainder.

    `occupied` has a bit for each quotient with a run, `runend` a bit for each slot that ends one. A slot holds a
    remainder, or, where `counter` is set, a digit (base 2**remainder bits, lowest first) of the number of further
    copies of the remainder before it.
    """

    def __init__(self, quotient_bits: int, remainder_bits: int, occupied: np.ndarray, runend: np.ndarray, counter: np.ndarray, slots: np.ndarray):
        self.q, self.r, self.occupied, self.runend, self.counter, self.slots = quotient_bits, remainder_bits, occupied, runend, counter, slots

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
        """keys: distinct sorted unsigned integers of `bits` bits; counts: 1 or more of each."""
        n = len(keys)
        q = min(bits - 1, max(1, int(n).bit_length()))
        r = bits - q
        quotient, remainder = keys >> np.uint64(r), keys & np.uint64((1 << r) - 1)
        digits, left = np.zeros(n, np.int64), counts.astype(np.uint64) - np.uint64(1)
        each = []
        while left.any():
            digits += left > 0
            each.append(left & np.uint64((1 << r) - 1))
            left = left >> np.uint64(r) if r < 64 else np.zeros_like(left)
        start = np.concatenate([[0], np.cumsum(1 + digits)])
        slots, counter = np.zeros(start[-1], np.uint64), np.zeros(start[-1], bool)
        slots[start[:-1]] = remainder
        for k, digit in enumerate(each):
            has = digits > k
            at = start[:-1][has] + 1 + k
            slots[at], counter[at] = digit[has], True
        occupied, runend = np.zeros(1 << q, bool), np.zeros(start[-1], bool)
        occupied[quotient.astype(np.int64)] = True
        last = np.append(quotient[1:] != quotient[:-1], True) if n else np.empty(0, bool)
        runend[start[1:][last] - 1] = True
        return cls(q, r, occupied, runend, counter, slots)

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order, and their counts."""
        run = np.concatenate([[0], np.cumsum(self.runend)[:-1]]) if len(self.slots) else np.empty(0, np.int64)
        quotient = np.flatnonzero(self.occupied).astype(np.uint64)
        heads = np.flatnonzero(~self.counter)
        keys = (quotient[run[heads].astype(np.int64)] << np.uint64(self.r)) | self.slots[heads]
        counts = np.ones(len(heads), np.int64)
        owner = np.cumsum(~self.counter) - 1
        digit = np.arange(len(self.slots)) - heads[owner] - 1 if len(heads) else np.empty(0, np.int64)
        at = np.flatnonzero(self.counter)
        np.add.at(counts, owner[at], (self.slots[at] << (digit[at].astype(np.uint64) * np.uint64(self.r))).astype(np.int64))
        return keys, counts

    def dump(self) -> bytes:
        head = np.array([self.q, self.r, len(self.slots)], "<i8").tobytes()
        width = (self.r + 7) // 8
        packed = self.slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        return head + b"".join(np.packbits(x).tobytes() for x in (self.occupied, self.runend, self.counter)) + packed.tobytes()

    @classmethod
    def load(cls, data: bytes) -> QuotientFilter:
        q, r, n = (int(x) for x in np.frombuffer(data, "<i8", 3))
        raw, at, bitmaps = np.frombuffer(data, np.uint8), 24, []
        for size in (1 << q, n, n):
            width = (size + 7) // 8
            bitmaps.append(np.unpackbits(raw[at : at + width], count=size).view(bool))
            at += width
        width, slots = (r + 7) // 8, np.zeros((n, 8), np.uint8)
        slots[:, :width] = raw[at:].reshape(n, width)
        return cls(q, r, *bitmaps, slots.view("<u8").reshape(-1))

    @classmethod
    def merge(cls, filters: list[QuotientFilter], bits: int) -> QuotientFilter:
        """All keys with the sums of their counts."""
        items = [f.items() for f in filters]
        keys, inverse = np.unique(np.concatenate([k for k, _ in items]), return_inverse=True)
        return cls.build(keys, np.bincount(inverse, np.concatenate([c for _, c in items]), len(keys)).astype(np.int64), bits)


def copied_fingerprints(prints: DataFrame, column: str, blocks: int) -> DataFrame:
    """Fingerprints (64-bit) that rows share, as `column` and `copies`, from one filter per partition and block."""
    top = blocks.bit_length() - 1
    bits = 64 - top

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.column(0).to_numpy(zero_copy_only=False).astype(np.int64) for b in batches]
        if not parts:
            return
        keys, counts = np.unique(np.concatenate(parts).view(np.uint64), return_counts=True)
        block = (keys >> np.uint64(bits)).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(keys)]
        mask = np.uint64((1 << bits) - 1)
        for start in range(0, len(cuts) - 1, 1000):
            spans = [(a, b) for a, b in zip(cuts[start : start + 1000], cuts[start + 1 : start + 1001]) if b > a]
            yield pa.RecordBatch.from_arrays([pa.array([int(block[a]) for a, _ in spans], pa.int64()), pa.array([QuotientFilter.build(keys[a:b] & mask, counts[a:b], bits).dump() for a, b in spans], pa.binary())], ["block", "filter"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        keys, counts = QuotientFilter.merge([QuotientFilter.load(x) for x in frame["filter"]], bits).items()
        more = counts > 1
        full = keys[more] | (np.uint64(int(frame["block"].iloc[0])) << np.uint64(bits))
        return pd.DataFrame({column: full.view(np.int64), "copies": counts[more]})

    filters = only(prints, column).mapInArrow(count, "block bigint, filter binary")
    return filters.groupBy("block").applyInPandas(merge, f"`{column}` bigint, copies bigint")


def groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The group of equal texts that each row belongs to. Texts are equal when identical after lower-casing A-Z.

    Returns per row: the key, keep_id (largest key of the group), group_size, kept, text_sha256. A null text counts as
    empty. Of rows with the same text and key (repeated rows) each is a row here, and all of them are marked kept if
    the key is the largest; `dedup` keeps one. Null keys are below all others. Further columns are left out.

    Rows of one text meet only as counts and largest keys made before the shuffle, and the rows get their
    group by a join that Spark splits where one group is large.
    """
    plain = only(docs, key, text).toDF("k", "t").withColumn("t", ascii_lower(F.coalesce("t", F.lit(""))))
    prints = written(plain.select("k", F.xxhash64("t").alias("fp"), F.sha2("t", 256).alias("sha")), "prints")
    blocks = 1 << max(6, (4 * prints.rdd.getNumPartitions()).bit_length())
    with arrow_rows(docs.sparkSession, 20_000):
        copied = written(copied_fingerprints(prints, "fp", blocks), "copied")
    few = copied.count() <= BROADCAST_ROWS
    routed = plain.withColumn("fp", F.xxhash64("t")).join(F.broadcast(copied.select("fp")) if few else copied.select("fp"), "fp", "left_semi")
    # byte by byte: the text itself is the grouping key
    verified = routed.groupBy("fp", "t").agg(F.max("k").alias("keep"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    verified = written(verified.select(F.sha2("t", 256).alias("sha"), "keep", "n"), "verified")
    joined = prints.join(verified, "sha", "left")
    keep = F.when(F.col("n").isNull(), F.col("k")).otherwise(F.col("keep"))
    return joined.select(
        F.col("k").alias(key), keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"), F.col("k").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256")
    )


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows to keep, with all their columns: of each group of equal texts the one with the largest key.

    Of repeated rows (same key and text) one stays, the greatest by its other columns, so that reruns agree.
    """
    found = groups(docs, text, key).filter("group_size > 1")
    found = written(found.select(F.col(f"`{key}`").alias("__key"), F.col("text_sha256").alias("__sha"), F.col("kept").alias("__kept")), "groups")
    marks = found.groupBy("__key", F.col("__sha").alias("__sign")).agg(F.max("__kept").alias("__kept"), F.count(F.lit(1)).alias("__n"))
    sign = F.sha2(ascii_lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), 256)
    return keep_marked(docs, key, sign, written(marks, "marks"))
