"""Lexicons, candidate words by shared n-grams, and correction with rejected ties.

Candidates come from an index of n-grams, so that edit distance is measured only for words that share enough of them. Words
are deduplicated before they are corrected and joined back after.
"""

from __future__ import annotations

import difflib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def build(weighted: list[tuple[DataFrame, str, int | str]], fallback: list[tuple[DataFrame, str, int]] = (), least: int = 2, most: int = 30) -> DataFrame:
    """Lexicon (word, freq): sums over weighted sources; fallback sources add only words that no source has so far.

    A source is (rows, word column, weight or weight column).
    """
    one = lambda df, word, w: df.select(F.col(word).alias("word"), (F.col(w) if isinstance(w, str) else F.lit(w)).cast("bigint").alias("freq")).filter(F.length("word").between(least, most))
    rows = one(*weighted[0])
    for source in weighted[1:]:
        rows = rows.unionByName(one(*source))
    out = rows.groupBy("word").agg(F.sum("freq").alias("freq"))
    for source in fallback:
        out = out.unionByName(one(*source).groupBy("word").agg(F.max("freq").alias("freq")).join(out, "word", "left_anti"))
    return out


def grams(word: Column, short: int = 4, both: bool = False) -> Column:
    """Set of n-grams of a word: pairs below `short` letters, else triples; a word shorter than that is its own gram.

    both adds pairs to longer words too, so that words of neighbouring lengths can meet.
    """
    of = lambda n: F.when(F.length(word) <= n, F.array(word)).otherwise(F.transform(F.sequence(F.lit(1), F.length(word) - n + 1), lambda i: F.call_function("substr", word, i, F.lit(n))))
    own = F.when(F.length(word) >= short, of(3)).otherwise(of(2))
    return F.array_distinct(F.concat(own, of(2)) if both else own)


def gram_index(lexicon: DataFrame, word: str = "word", both: bool = False) -> DataFrame:
    return lexicon.select(word, F.explode(grams(F.col(word), both=both)).alias("gram"))


#: Words of a lexicon that one index holds; larger ones are cut into blocks that meet blocks of the asked words.
INDEX_WORDS, ASKED_BLOCK = 100_000, 20_000


def gram_set(word: str, short: int = 4, both: bool = False) -> set[str]:
    """The n-grams of a word, as `grams` has them."""
    of = lambda n: [word] if len(word) <= n else [word[i : i + n] for i in range(len(word) - n + 1)]
    own = of(3) if len(word) >= short else of(2)
    return set(own + of(2)) if both else set(own)


class GramIndex:
    """Lexicon words by their n-grams. Words are numbered in their order, so the lesser number wins ties."""

    def __init__(self, words: list[str], both: bool):
        self.words, self.both = sorted(words), both
        lists: dict[str, list[int]] = {}
        self.n_grams, self.lengths = np.zeros(len(words), np.int64), np.array([len(w) for w in self.words], np.int64)
        for i, w in enumerate(self.words):
            own = gram_set(w, both=both)
            self.n_grams[i] = len(own)
            for g in own:
                lists.setdefault(g, []).append(i)
        self.lists = {g: np.array(x, np.int32) for g, x in lists.items()}

    def best(self, word: str, pool: int | None, within: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and shared n-grams of the `pool` words that share most, best first; with `within` those of them that
        may be at that edit distance: an edit changes three n-grams of a kind at most."""
        own = gram_set(word, both=self.both)
        lists = [x for g in own if (x := self.lists.get(g)) is not None]
        if not lists:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        shared = np.bincount(np.concatenate(lists), minlength=len(self.words))
        at = np.flatnonzero(shared)
        rank = shared[at] * len(self.words) - at
        if pool is not None and len(at) > pool:
            some = np.argpartition(-rank, pool - 1)[:pool]
            at, rank = at[some], rank[some]
        if within is not None:
            lost = within * (5 if self.both else 3)
            near = (np.abs(self.lengths[at] - len(word)) <= within) & (shared[at] >= np.maximum(self.n_grams[at], len(own)) - lost)
            at, rank = at[near], rank[near]
        at = at[np.argsort(-rank)]
        return at, shared[at]


@lru_cache(4)
def _index(words: tuple[str, ...], both: bool) -> GramIndex:
    return GramIndex(list(words), both)


def pools(words: DataFrame, lexicon: DataFrame, pool: int | None = 400, both: bool = False, within: int | None = None) -> DataFrame:
    """word, pool: for each asked word the `pool` lexicon words that share most n-grams (all without a pool), best first, ties by
    word, as an array of (candidate, shared). within: only those of them that may be at that edit distance.

    A lexicon of bounded size goes to all workers as one index, after a count. Larger ones are cut into blocks, each
    of which meets each block of asked words; the best of all blocks are the pool.
    """
    spark = words.sparkSession
    asked, listed = words.select("word").distinct(), lexicon.select("word").distinct()
    item = "array<struct<candidate:string,shared:bigint>>"

    def found(index: GramIndex, some: list[str], near: int | None) -> pa.RecordBatch:
        rows = [(w, at, n) for w in some for at, n in [index.best(w, pool, near)] if len(at)]
        ends = np.cumsum([0, *[len(at) for _, at, _ in rows]])
        names = pa.array(index.words, pa.string()).take(pa.array(np.concatenate([at for _, at, _ in rows]) if rows else [], pa.int64()))
        pairs = pa.StructArray.from_arrays([names, pa.array(np.concatenate([n for _, _, n in rows]) if rows else [], pa.int64())], ["candidate", "shared"])
        return pa.RecordBatch.from_arrays([pa.array([w for w, _, _ in rows], pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)], ["word", "pool"])

    n = listed.count()
    if n <= INDEX_WORDS:
        sent = spark.sparkContext.broadcast(tuple(r["word"] for r in listed.collect()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(sent.value, both)
            for batch in batches:
                some = batch.column(0).to_pylist()
                for start in range(0, len(some), 1000):
                    yield found(index, some[start : start + 1000], within)

        return asked.mapInArrow(run, f"word string, pool {item}")
    blocks, asked_blocks = -(-n // INDEX_WORDS), max(1, -(-asked.count() // ASKED_BLOCK))
    deal = lambda c, k, name: F.pmod(F.xxhash64(c), F.lit(k)).cast("int").alias(name)
    each = lambda k, name: F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias(name)
    left = asked.select("word", deal("word", asked_blocks, "a"), each(blocks, "b"))
    right = listed.select("word", each(asked_blocks, "a"), deal("word", blocks, "b"))

    def meet(x: pa.Table, y: pa.Table) -> pa.Table:
        # what is far may hold a place in the pool, so it is told apart only after the blocks are put together
        index = GramIndex(y.column("word").to_pylist(), both)
        return pa.Table.from_batches([found(index, x.column("word").to_pylist(), within if pool is None else None)])

    parts = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(meet, f"word string, pool {item}")
    least = lambda x: F.transform(F.array_sort(F.transform(x, lambda p: F.struct((-p["shared"]).alias("s"), p["candidate"].alias("c")))), lambda p: F.struct(p["c"].alias("candidate"), (-p["s"]).alias("shared")))
    every = least(F.flatten(F.collect_list("pool")))
    out = parts.groupBy("word").agg((every if pool is None else F.slice(every, 1, pool)).alias("pool"))
    if within is not None and pool is not None:
        size = lambda c: F.size(grams(c, both=both))
        near = lambda p: (F.abs(F.length(p["candidate"]) - F.length("word")) <= within) & (p["shared"] >= F.greatest(size(p["candidate"]), size(F.col("word"))) - within * (5 if both else 3))
        out = out.withColumn("pool", F.filter("pool", near)).filter(F.size("pool") > 0)
    return out


def candidates(words: DataFrame, lexicon: DataFrame, pool: int | None = 400, both: bool = False, within: int | None = None) -> DataFrame:
    """word, candidate, shared: the rows of `pools`."""
    return pools(words, lexicon, pool, both, within).select("word", F.explode("pool").alias("p")).select("word", "p.candidate", "p.shared")


def within_distance(a: Column, b: Column, most: Column | int) -> Column:
    """Edit distance, null above `most`."""
    if isinstance(most, int):
        return F.nullif(F.levenshtein(a, b, most), F.lit(-1))
    d = F.levenshtein(a, b)
    return F.when(d <= most, d)


def suggestions(words: DataFrame, lexicon: DataFrame, pool: int = 400, top: int = 3, both: bool = False) -> DataFrame:
    """word, candidate, distance, freq, place: lexicon words at distance 1 (2 from six letters on), nearest and most
    frequent first, `top` of each word."""
    limit = F.when(F.length("word") <= 5, 1).otherwise(2)
    found = candidates(words, lexicon, pool, both, 2).withColumn("distance", F.levenshtein("word", "candidate", 2))
    found = found.filter((F.col("distance") >= 1) & (F.col("distance") <= limit)).join(lexicon.select(F.col("word").alias("candidate"), "freq"), "candidate")
    w = Window.partitionBy("word").orderBy("distance", F.col("freq").desc(), "candidate")
    return found.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= top).select("word", "candidate", "distance", "freq", "place")


def corrections(words: DataFrame, lexicon: DataFrame, domain: DataFrame | None = None, least: int = 3, pool: int = 400) -> DataFrame:
    """word, kind, correction of each distinct word: known, short, unknown, ambiguous (two nearest alike), or fixed."""
    asked = words.select("word").distinct()
    known = lexicon.select("word") if domain is None else lexicon.select("word").unionByName(domain.select("word")).distinct()
    marked = asked.join(known.withColumn("known", F.lit(True)), "word", "left")
    open_ = marked.filter(F.col("known").isNull() & (F.length("word") >= least))
    best = suggestions(open_, lexicon, pool).groupBy("word").agg(F.min_by("candidate", "place").alias("candidate"), F.min("distance").alias("nearest"), F.collect_list("distance").alias("d"))
    best = best.withColumn("alike", F.size(F.filter("d", lambda d: d == F.col("nearest"))))
    out = marked.join(best, "word", "left")
    kind = F.when(F.col("known"), "known").when(F.length("word") < least, "short").when(F.col("candidate").isNull(), "unknown").when(F.col("alike") > 1, "ambiguous").otherwise("fixed")
    return out.select("word", kind.alias("kind"), F.when(kind == "fixed", F.col("candidate")).otherwise(F.col("word")).alias("correction"))


def moved_marks(original: str, target: str, marks: frozenset[str], compat: bool = False) -> str:
    """The letters of target with the marks of original. compat keeps the source where as many letters are replaced."""
    bare = [(i, c) for i, c in enumerate(original) if c not in marks]
    after = {k: original[i + 1 : (bare[k + 1][0] if k + 1 < len(bare) else len(original))] for k, (i, _) in enumerate(bare)}
    lead = original[: bare[0][0]] if bare else original
    out = [lead]
    for tag, a0, a1, b0, b1 in difflib.SequenceMatcher(None, "".join(c for _, c in bare), target, autojunk=False).get_opcodes():
        if tag == "equal" or tag == "replace" and a1 - a0 == b1 - b0:
            keep = tag == "equal" or compat
            out += [(bare[a0 + k][1] if keep else target[b0 + k]) + after[a0 + k] for k in range(a1 - a0)]
        elif tag != "delete":
            out.append(target[b0:b1])
    return "".join(out)


def transfer_marks(original: Column, target: Column, marks: str, compat: bool = False) -> Column:
    """The letters of a correction with the marks of the word that it replaces. marks: the characters that are marks."""
    chars = frozenset(marks)

    @F.pandas_udf("string")
    def move(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else moved_marks(x, y, chars, compat) for x, y in zip(a, b)], dtype=object)

    return move(original, target)


def outcome_counts(corrected: DataFrame) -> DataFrame:
    """kind, n: how many words had each outcome, most frequent first."""
    return corrected.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "kind")


def replace_tokens(lines: DataFrame, key: list[str], text: str, table: DataFrame, pattern: str, out: str = "corrected", on: list[str] | None = None) -> DataFrame:
    """Lines with each token replaced as table (word, correction) says; what stands between tokens stays. on: columns of the key
    that the table has too, where a correction holds for some lines only.

    Tokens are met with the table by a join on the word; the line is put together again by place.
    """
    parts = F.arrays_zip(F.split(F.col(text), pattern, -1).alias("gap"), F.regexp_extract_all(F.col(text), F.lit(f"({pattern})"), F.lit(1)).alias("word"))
    exploded = lines.select(*key, F.posexplode(parts).alias("place", "part")).select(*key, "place", F.col("part.gap").alias("gap"), F.col("part.word").alias("word"))
    joined = exploded.join(table.select(*(on or []), "word", "correction"), [*(on or []), "word"], "left")
    piece = F.concat("gap", F.coalesce("correction", "word", F.lit("")))
    line = joined.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", piece.alias("t")))), lambda s: s["t"]), "").alias(out))
    return lines.join(line, key, "left")
