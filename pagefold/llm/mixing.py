"""Mixing sources to target weights, on DataFrame functions alone.

Sizes are summed per source, targets and repetition rates follow from the sums, and each document is emitted
floor(rate) times, plus once more with the fraction as probability, by a hash of its key and a seed. Where few long
documents hold most words, such draws stray far from the target, so each source draws with the one of DRAWS seeds
whose words come nearest to its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagefold.llm.common import WORD, only, written

#: Sources whose rates are broadcast at most; with more, documents meet them by a shuffle that Spark can split.
BROADCAST_SOURCES = 50_000
SEED = "mix-1"
#: Seeds that each source can draw with; four share a digest.
DRAWS = 16


def running(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Adds inclusive running sums in a total order, without ever bringing all rows into one task.

    Rows are dealt out by ranges of the order; sums within a range and sums of the ranges before it make the whole.
    """
    ranged = written(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("__part").agg(*[F.sum(c).alias(f"__all_{out}") for out, c in sums.items()])
    w = Window.orderBy("__part")
    before = totals.select("__part", *[(F.sum(f"__all_{out}").over(w) - F.col(f"__all_{out}")).alias(f"__before_{out}") for out in sums])
    within = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = ranged.join(before, "__part")
    return joined.select(*df.columns, *[(F.col(f"__before_{out}") + F.sum(c).over(within)).alias(out) for out, c in sums.items()])


def rates(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """source_size, target and rate of each source, from rows of `source` and `size`.

    Sources in code point order, null last, weigh `weights` in turn and share the sum of all sizes. A target stops at
    `most` times its source's size; what is above is shared anew by weight. The outcome is min(most * size,
    level * weight) with one level for all, which is found in one pass over sources in order of most * size / weight.
    """
    totals = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("bigint")), "totals")
    by_name = [F.col("source").asc_nulls_last()]
    ranked = running(totals, by_name, {"place": "one"})
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most).withColumn("full_at", F.col("cap") / F.col("weight"))
    ranked = written(ranked, "ranked")
    total, all_weights = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level = 0.0
    if total:
        filled = running(ranked, [F.col("full_at"), F.col("place")], {"caps": "cap", "heavy": "weight"})
        share = (F.lit(total) - (F.col("caps") - F.col("cap"))) / (F.lit(all_weights) - (F.col("heavy") - F.col("weight")))
        level = filled.withColumn("share", share).filter("share <= full_at").agg(F.min_by("share", F.struct("full_at", "place"))).first()[0]
    target = F.least(F.col("cap").cast("double"), F.lit(float(level)) * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    return written(ranked.withColumn("target", target).withColumn("rate", rate).select("source", "source_size", "target", "rate"), "rates")


def chance(key: Column, draw: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on seed, draw and key alone: 8 hex digits of a digest."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.floor(draw / 4).cast("string"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.call_function("substr", digest, (draw % 4 * 8 + 1).cast("int"), F.lit(8)), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def meet(rows: DataFrame, by_source: DataFrame, source: str) -> DataFrame:
    """Rows with their source's columns; the few sources of most corpora are broadcast, after a count."""
    few = by_source.count() <= BROADCAST_SOURCES
    of = by_source.withColumnRenamed("source", "__source")
    return rows.join(F.broadcast(of) if few else of, F.col(f"`{source}`").eqNullSafe(F.col("__source"))).drop("__source")


def draws(sized: DataFrame, by_source: DataFrame, seed: str = SEED) -> DataFrame:
    """Adds to each source the draw (0 to DRAWS - 1) whose words come nearest to its target, the first of ties.

    sized: k, source, size, all in written storage. Sums are made before the shuffle.
    """
    fraction = F.col("rate") - F.floor("rate")
    sums = [F.sum(F.when(chance(F.col("k"), F.lit(j), seed) < fraction, F.col("size")).otherwise(0)).alias(f"__{j}") for j in range(DRAWS)]
    drawn = meet(sized, by_source, "source").groupBy("source").agg(*sums, F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("rate").alias("rate"))
    off = [F.struct(F.abs(F.floor("rate") * F.col("source_size") + F.col(f"__{j}") - F.col("target")).alias("off"), F.lit(j).alias("draw")) for j in range(DRAWS)]
    return written(drawn.select("source", "source_size", "target", "rate", F.array_min(F.array(*off))["draw"].alias("draw")), "draws")


def with_copies(rows: DataFrame, by_source: DataFrame, source: str, key: str, seed: str) -> DataFrame:
    """Adds source_size, target and copies."""
    fraction = F.col("rate") - F.floor("rate")
    copies = F.floor("rate") + F.when(chance(F.col(f"`{key}`"), F.col("draw"), seed) < fraction, 1).otherwise(0)
    return meet(rows, by_source, source).withColumn("copies", copies.cast("bigint")).drop("rate", "draw")


def size_of(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD)).cast("bigint")


def plan(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: str = SEED) -> DataFrame:
    """What the mix takes of each row: the key, size, source_size, target, taken, copies.

    size is the number of words (0 for null). Rows of empty sources (size 0) have target 0 and are not taken. Repeated
    rows are decided alike, as are all rows without a key. Further columns are left out.
    """
    sized = sizes(docs, text, key, source)
    out = with_copies(sized, draws(sized, rates(sized, weights, most), seed), "source", "k", seed)
    return out.select(F.col("k").alias(key), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def sizes(docs: DataFrame, text: str, key: str, source: str) -> DataFrame:
    return written(only(docs, key, source, text).toDF("k", "source", "t").select("k", "source", size_of("t").alias("size")), "sized")


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: str = SEED) -> DataFrame:
    """The mix itself: each row as often as it is taken, with all its columns."""
    sized = sizes(docs, text, key, source)
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("k"), F.col(f"`{source}`").alias("source"))
    out = with_copies(held, draws(sized, rates(sized, weights, most), seed), "source", "k", seed).filter("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")).select("row.*")


#: The same rows in SQL, for a table documents and the values above.
SQL = f"""
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size from documents),
totals as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
ranked as (select *, ((row_number() over (order by source nulls last) - 1) % 3) + 1 as weight from totals),
caps as (
  select *, source_size * 3 as cap, source_size * 3 / weight as full_at, sum(source_size) over () as total, sum(weight) over () as weights,
    row_number() over (order by source_size * 3 / weight, source nulls last) as place from ranked),
shares as (
  select *, (total - (sum(cap) over (order by place) - cap)) / (weights - (sum(weight) over (order by place) - weight)) as share from caps),
level as (select coalesce(min_by(share, place) filter (share <= full_at), 0) as level from shares),
rates as (
  select source, source_size, least(cast(cap as double), level * weight) as target,
    case when source_size > 0 then least(least(cast(cap as double), level * weight) / source_size, 3.0) else 0.0 end as rate from caps, level),
seeds as (select unnest(range({DRAWS})) as draw),
chances as (
  select s.*, r.source_size, r.target, r.rate, draw,
    floor(r.rate) + case when cast('0x' || substr(md5('{SEED}:' || (draw // 4) || ':' || coalesce(cast(s.doc_id as varchar), '')), cast(draw % 4 * 8 + 1 as bigint), 8) as bigint) / 4294967296.0 < r.rate - floor(r.rate) then 1 else 0 end as copies
  from sized s join rates r on s.source is not distinct from r.source, seeds),
off as (select source, draw, abs(sum(size * copies) - any_value(target)) as off from chances group by source, draw),
best as (select source, min_by(draw, (off, draw)) as draw from off group by source)
select doc_id, size, source_size, target, cast(size * copies as bigint) as taken, cast(copies as bigint) as copies
from chances c join best b on c.source is not distinct from b.source and c.draw = b.draw
"""
