"""Exact top-k search by inner product as a Voronoi join.

Pivots part all rows into cells; each row is written with its cell once. A cell of data is summed up by its radius, its
largest norm and the rows nearest to its pivot; a cell of queries by its radius, its largest norm and the least score that
each of its queries is sure to reach k times, which those rows give. From the summaries alone follows a bound on the scores
between two cells, and cells that can't give each other a neighbour never meet. What is left is tested vector by vector: x
scores at most <p, x> + radius * |x| with the queries about pivot p.

Neighbouring query cells share a block of bounded size, and a vector is sent once to each block that wants it: where no
bound prunes and the queries fill one block, no vector is sent twice. In a block, chunks of data meet the queries, cell by
cell again, and the best k of all chunks are the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagefold.llm.common import only, written

#: Rows of a cell, bounds on the number of cells (their summaries meet on the driver), and rows by hash for each pivot.
CELL_ROWS, LEAST_CELLS, MOST_CELLS, SAMPLE_PER_PIVOT, ROUNDS = 2_000, 16, 1024, 16, 4
#: Queries of a block; rows of data in a chunk at least, and bytes of a chunk as floats at most.
BLOCK, LEAST_CHUNK, CHUNK_BYTES = 32_768, 8_192, 64 << 20
TILE = 2_000_000  # scores at once
#: Below this all integers are kept in 16 bits.
NARROW = 1 << 15
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1


def quantised(lists: pa.Array, width: int) -> np.ndarray:
    """floor(256 * x) / 256 of each component, which no finite x overflows; shorter vectors are filled up with zeros."""
    sizes = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(lists), width))
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    fine = np.abs(out) < 2.0**45  # floats beyond are multiples of 1 / 128
    out[fine] = np.floor(256.0 * out[fine]) / 256.0
    return out


def packed(x: np.ndarray, narrow: bool) -> pa.Array:
    rows = (256.0 * x).astype("<i2") if narrow else x.astype("<f8")
    return pa.array([r.tobytes() for r in rows], pa.binary())


def unpacked(column: list[bytes], width: int, narrow: bool) -> np.ndarray:
    """The quantised components again."""
    x = np.frombuffer(b"".join(column), "<i2" if narrow else "<f8").reshape(len(column), width).astype(float)
    return x / 256.0 if narrow else x


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows' integers (256 times the quantised components) as 64-bit integers; products beyond
    64 bits stand as the nearest one.

    Floating point where no sum can leave its exact range, else 64-bit arithmetic, else, for rows with components of
    some 2 ** 30 and more, Python's integers.
    """
    width = max(1, a.shape[1])
    with np.errstate(over="ignore"):
        of_a, of_b = (np.abs(x).max(1, initial=0.0) * 256.0 for x in (a, b))
    peak = of_a.max(initial=0.0) * of_b.max(initial=0.0) * width
    if peak < 2.0**53:
        return ((256.0 * a) @ (256.0 * b).T).astype(np.int64)
    if peak < 2.0**62:
        return (256.0 * a).astype(np.int64) @ (256.0 * b).astype(np.int64).T
    out = np.empty((len(a), len(b)), np.int64)
    fits = 2.0**31 / width**0.5
    plain_a, plain_b = np.flatnonzero(of_a < fits), np.flatnonzero(of_b < fits)
    if len(plain_a) and len(plain_b):
        out[np.ix_(plain_a, plain_b)] = products(a[plain_a], b[plain_b])
    whole = lambda x: [[int(c * 256) if abs(c) < 2.0**45 else int(c) * 256 for c in r] for r in x.tolist()]
    large_a, large_b = np.flatnonzero(of_a >= fits), np.flatnonzero(of_b >= fits)
    for some_a, some_b in ((large_a, np.arange(len(b))), (plain_a, large_b)):
        rows, others = whole(a[some_a]), whole(b[some_b])
        for i, r in zip(some_a, rows):
            for j, o in zip(some_b, others):
                out[i, j] = max(LEAST_LONG, min(MOST_LONG, sum(p * q for p, q in zip(r, o))))
    return out


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest integer scores of each row, in order; ties to the earlier place. Fewer than k columns: all."""
    n = scores.shape[1]
    if n and max(int(scores.max(initial=0)), -int(scores.min(initial=0))) * n >= 1 << 62:  # too large for that
        down = np.where(scores == LEAST_LONG, MOST_LONG, -np.where(scores == LEAST_LONG, 0, scores))
        return np.lexsort((np.broadcast_to(scores == LEAST_LONG, scores.shape), down), axis=1)[:, :k]
    ordered = scores * n + np.arange(n - 1, -1, -1)  # one number for score and place
    if n > k:
        at = np.argpartition(-ordered, k - 1, axis=1)[:, :k]
    else:
        at = np.tile(np.arange(n), (len(scores), 1))
    return np.take_along_axis(at, np.argsort(-np.take_along_axis(ordered, at, 1), axis=1), 1)


def pivots_of(sample: np.ndarray, n: int) -> np.ndarray:
    """At most n pivots of a sample: spread rows, drawn to the middle of what lies nearest to each."""
    sample = np.unique(sample, axis=0)
    sample = sample[(np.abs(sample) < 1e150).all(1)]
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    chosen, away = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    pivots = sample[chosen]
    for _ in range(ROUNDS):
        cell = nearest(sample, pivots)[0]
        sums = np.zeros_like(pivots)
        np.add.at(sums, cell, sample)
        n_of = np.bincount(cell, minlength=len(pivots))[:, None]
        pivots = np.where(n_of > 0, sums / np.maximum(n_of, 1), pivots)
    return pivots


def nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each row and the distance to its pivot."""
    with np.errstate(over="ignore", invalid="ignore"):
        cell = ((pivots * pivots).sum(1) - 2 * (x @ pivots.T)).argmin(1)
        return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1))


def cell_bounds(pivots: np.ndarray, q_radius: np.ndarray, q_norm: np.ndarray, d_radius: np.ndarray, d_norm: np.ndarray) -> np.ndarray:
    """What no score between a query of one cell (rows) and a vector of another (columns) exceeds, from their summaries."""
    norm = np.sqrt((pivots * pivots).sum(1))
    apart = np.sqrt(np.maximum(((pivots[:, None] - pivots[None]) ** 2).sum(2), 0.0))
    by_pivots = pivots @ pivots.T + np.outer(norm, d_radius) + np.outer(q_radius, norm) + np.outer(q_radius, d_radius)
    gap = np.maximum(apart - q_radius[:, None] - d_radius[None], 0.0)
    by_distance = (q_norm[:, None] ** 2 + d_norm[None] ** 2 - gap**2) / 2
    return np.fmin(np.fmin(by_pivots, by_distance), np.outer(q_norm, d_norm))


def vector_bounds(x: np.ndarray, pivots: np.ndarray, radius: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What no score between a vector (rows) and a query of a cell (columns) exceeds."""
    size = np.sqrt((x * x).sum(1))[:, None]
    inner = x @ pivots.T
    apart = np.sqrt(np.maximum(size**2 - 2 * inner + (pivots * pivots).sum(1), 0.0))
    gap = np.maximum(apart * (1 - 1e-9) - radius, 0.0)
    return np.fmin(np.fmin(inner + radius * size, (size**2 + norm**2 - gap**2) / 2), size * norm)


def search(vectors: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding", figures: dict | None = None) -> DataFrame:
    """The k best-scoring other rows of each row whose key is divisible by `every`.

    Returns query_id, rank (from 1), vec_id, score: the integer inner products of floor(256 * x), ties to the smaller
    key; all other rows where there are fewer than k. Rows without a key, and vectors that are null or hold null or
    non-finite components, take no part. Shorter vectors count as filled up with zeros. Rows of one key are one row,
    with the best of their scores; scores beyond 64 bits are the nearest number of 64 bits. Further columns are left out.

    figures, if given, takes the numbers of cells, of pairs of cells that meet, of vectors and of vectors sent.
    """
    spark = vectors.sparkSession
    usable = F.forall(F.col("x"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = only(vectors, key, vector).toDF("id", "x").filter(F.col("id").isNotNull() & F.col("x").isNotNull() & usable)
    rows = rows.select(F.col("id").cast("bigint").alias("id"), F.col("x").cast("array<double>").alias("x"))
    is_query = F.col("id") % every == 0
    largest = F.aggregate("x", F.lit(0.0), lambda a, c: F.greatest(a, F.abs(c)))
    n_rows, width, peak, n_queries = rows.agg(F.count(F.lit(1)), F.max(F.size("x")), F.max(largest), F.sum(is_query.cast("bigint"))).first()
    if not n_queries:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width, narrow = max(1, width), 256.0 * peak + 1 < NARROW
    n_cells = int(min(MOST_CELLS, max(LEAST_CELLS, n_rows // CELL_ROWS)))
    by_hash = F.xxhash64(F.lit("pivot"), F.col("id"))
    sample = rows.orderBy(by_hash, "id").limit(n_cells * SAMPLE_PER_PIVOT).select("x").toArrow().column("x").combine_chunks()
    pivots = pivots_of(quantised(sample, width), n_cells)

    def into_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = quantised(batch.column(1), width)
            cell, away = nearest(x, pivots)
            with np.errstate(over="ignore"):
                norm = np.sqrt((x * x).sum(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell, pa.int32()), pa.array(away), pa.array(norm), packed(x, narrow)], ["id", "cell", "away", "norm", "v"])

    placed = written(rows.mapInArrow(into_cells, "id bigint, cell int, away double, norm double, v binary"), "cells")
    radius_of, norm_of = F.max("away").alias("radius"), F.max("norm").alias("norm")
    summed = placed.groupBy("cell").agg(radius_of, norm_of).collect()
    near = F.row_number().over(Window.partitionBy("cell").orderBy("away", "id"))
    guides = {r["id"]: r["v"] for r in placed.select("cell", "away", "id", "v").withColumn("n", near).filter(F.col("n") <= k + 1).select("id", "v").collect()}
    guide_ids, guide = np.array(list(guides), np.int64), unpacked(list(guides.values()), width, narrow)
    with np.errstate(over="ignore"):
        guide_norm = float(np.sqrt((guide * guide).sum(1)).max(initial=0.0))

    def surely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The score that each query reaches with k of the guides."""
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), unpacked(batch.column(3).to_pylist(), width, narrow)
            sure = np.full(len(ids), -np.inf)
            for start in range(0, len(ids), 500):
                with np.errstate(over="ignore", invalid="ignore"):
                    s = x[start : start + 500] @ guide.T
                    s[ids[start : start + 500, None] == guide_ids[None]] = -np.inf
                    if s.shape[1] >= k:
                        least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
                        least = least - 1e-9 * (1 + batch.column(2).to_numpy()[start : start + 500] * guide_norm)
                        sure[start : start + 500] = np.where((s < np.inf).all(1) & ~np.isnan(least), least, -np.inf)  # no bound from overflows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sure)], ["id", "cell", "norm", "v", "away", "sure"])

    queries = placed.filter(is_query).select("id", "cell", "norm", "v", "away")
    queries = written(queries.mapInArrow(surely, "id bigint, cell int, norm double, v binary, away double, sure double"), "queries")
    asked = queries.groupBy("cell").agg(radius_of, norm_of, F.min("sure").alias("sure"), F.count(F.lit(1)).alias("n")).collect()
    d_radius, d_norm, q_radius, q_norm, sure, n_of = (np.zeros(len(pivots)) for _ in range(6))
    sure += np.inf
    for r in summed:
        d_radius[r["cell"]], d_norm[r["cell"]] = r["radius"], r["norm"]
    for r in asked:
        c = r["cell"]
        q_radius[c], q_norm[c], sure[c], n_of[c] = r["radius"], r["norm"], r["sure"], r["n"]
    with np.errstate(over="ignore", invalid="ignore"):
        bounds = cell_bounds(pivots, q_radius, q_norm, d_radius, d_norm)
        meets = ~(bounds + 1e-9 * (1 + np.outer(q_norm, d_norm)) < sure[:, None]) & (n_of > 0)[:, None]

    # query cells in an order where neighbours follow one another, cut into blocks; a large cell is many blocks of its own
    live = [c for c in range(len(pivots)) if n_of[c]]
    chain = [live.pop(0)]
    while live:
        chain.append(live.pop(int(((pivots[live] - pivots[chain[-1]]) ** 2).sum(1).argmin())))
    blocks_of: dict[int, range] = {}
    n_blocks, room = 0, 0.0
    for c in chain:
        if n_of[c] > room or n_of[c] > BLOCK:
            parts = max(1, int(-(-n_of[c] // BLOCK)))
            n_blocks += parts
            room = float(BLOCK) if parts == 1 else 0.0
            blocks_of[c] = range(n_blocks - parts, n_blocks)
        else:
            blocks_of[c] = range(n_blocks - 1, n_blocks)
        room -= n_of[c] if room else 0.0
    cells = np.array(chain)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The blocks of each vector."""
        for batch in batches:
            cell, x = batch.column(1).to_numpy(), unpacked(batch.column(2).to_pylist(), width, narrow)
            with np.errstate(over="ignore", invalid="ignore"):
                above = vector_bounds(x, pivots[cells], q_radius[cells], q_norm[cells])
                slack = 1e-9 * (1 + np.sqrt((x * x).sum(1))[:, None] * q_norm[cells])
                goes = meets[cells][:, cell].T & ~(above + slack < sure[cells])
            to = np.zeros((len(cell), n_blocks), bool)
            for i, c in enumerate(cells):
                to[:, blocks_of[c].start : blocks_of[c].stop] |= goes[:, i : i + 1]
            row, block = np.nonzero(to)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(cell)))]), pa.int32()), pa.array(block, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, batch.column(2)], ["id", "cell", "blocks", "v"])

    data = written(placed.select("id", "cell", "v").mapInArrow(wanted, "id bigint, cell int, blocks array<int>, v binary"), "data")
    sent = {r["block"]: r["n"] for r in data.select(F.explode("blocks").alias("block")).groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()}
    if figures is not None:
        figures |= {"cells": int((n_of > 0).sum()) * len(summed), "meet": int(meets[:, [r["cell"] for r in summed]].sum()), "vectors": n_rows, "sent": sum(sent.values())}
    size = int(min(max(LEAST_CHUNK, n_rows // (4 * spark.sparkContext.defaultParallelism)), max(LEAST_CHUNK, CHUNK_BYTES // (8 * width))))
    chunks = {b: max(1, -(-n // size)) for b, n in sent.items()}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query with its block, for all chunks of it."""
        for batch in batches:
            ids, cell = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            block = np.array([blocks_of[c].start + i % len(blocks_of[c]) for i, c in zip((ids // every).tolist(), cell.tolist())], np.int64)
            times = np.array([chunks.get(b, 0) for b in block.tolist()], np.int64)
            at = np.repeat(np.arange(len(ids)), times)
            chunk = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            some = pa.array(at)
            yield pa.RecordBatch.from_arrays([pa.array(block[at], pa.int32()), pa.array(chunk, pa.int32()), *(batch.column(c).take(some) for c in range(4))], ["block", "chunk", "id", "cell", "sure", "v"])

    left = queries.select("id", "cell", "sure", "v").mapInArrow(dealt, "block int, chunk int, id bigint, cell int, sure double, v binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector with each of its blocks, in the chunk that its key gives."""
        for batch in batches:
            ids, lists = batch.column(0), batch.column(2)
            block = lists.flatten().to_numpy()
            at = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy())
            mixed = (ids.to_numpy().astype(np.uint64)[at] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            chunk = mixed.astype(np.int64) % np.array([chunks[b] for b in block.tolist()], np.int64) if len(at) else np.zeros(0, np.int64)
            some = pa.array(at)
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(chunk, pa.int32()), ids.take(some), batch.column(1).take(some), batch.column(3).take(some)], ["block", "chunk", "id", "cell", "v"])

    right = data.filter(F.size("blocks") > 0).mapInArrow(cut, "block int, chunk int, id bigint, cell int, v binary")

    def solve(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(d):
            d = d.sort_values("id", kind="stable")
            x, y = unpacked(d["v"], width, narrow), unpacked(q["v"], width, narrow)
            ids, of, q_ids, q_of, least = (c.to_numpy() for c in (d["id"], d["cell"], q["id"], q["cell"], q["sure"]))
            # queries of cells that meet the same cells of data are solved together
            alike: dict[bytes, list[int]] = {}
            for c in np.unique(q_of).tolist():
                alike.setdefault(meets[c].tobytes(), []).append(c)
            for group in alike.values():
                there = np.flatnonzero(meets[group[0]][of])
                if not len(there):
                    continue
                keys, at_key = np.unique(ids[there], return_index=True)
                rows_ = np.flatnonzero(np.isin(q_of, group))
                step = max(1, TILE // len(there))
                for start in range(0, len(rows_), step):
                    some = rows_[start : start + step]
                    s = products(y[some], x[there])
                    if len(keys) < len(there):
                        s = np.maximum.reduceat(s, at_key, axis=1)
                    at = best(s, k + 1)  # one may be the query itself
                    part = pd.DataFrame({"query_id": np.repeat(q_ids[some], at.shape[1]), "vec_id": keys[at].ravel(), "score": np.take_along_axis(s, at, 1).ravel()})
                    floor = np.minimum(np.repeat(least[some], at.shape[1]) * 65536.0, 2.0**62)
                    out.append(part[part["score"].to_numpy() >= floor - 1e-9 * np.abs(floor) - 2])  # k others reach that
        out = pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        return out[out["query_id"] != out["vec_id"]]

    keys = ["block", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(solve, "query_id bigint, vec_id bigint, score bigint")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


#: The same rows in SQL, for a table embeddings, with k = 5 and every 50th key.
SQL = """
with rows as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) as v from embeddings
  where embedding is not null and vec_id is not null and not list_bool_or(list_transform(embedding, lambda x: x is null or not isfinite(cast(x as double)))) ),
scores as (
  select q.vec_id as query_id, d.vec_id as vec_id, max(cast(list_inner_product(q.v, d.v) as bigint)) as score
  from rows q join rows d on q.vec_id <> d.vec_id where q.vec_id % 50 = 0 group by q.vec_id, d.vec_id),
ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scores)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""
