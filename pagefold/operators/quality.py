"""Measures of text and pictures: noise, confidence, coverage, histograms, and checks of data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagefold.functions import charsets as cs
from pagefold.functions import text as tx


def bound(values: dict[str, Column], then: Callable[[Column], Column]) -> Column:
    """then(struct of the values), with each value worked out once however often it is used."""
    return F.element_at(F.transform(F.array(F.struct(*[v.alias(n) for n, v in values.items()])), then), 1)


def is_noise(c: Column, letters: str = cs.ARABIC_LETTERS, marks: str = cs.DIACRITICS_BOOK) -> Column:
    """Lines that hold no language: blank; no letters (unless digits alone); few letters among other signs; mostly
    words of one or two letters.

    Sizes come from counts, so that no stripped copy of a line is made but for lines of few letters.
    """
    word = rf"[\p{{L}}\p{{N}}_\p{{M}}&&[^{marks}]]"
    n = F.regexp_count(c, F.lit(f"[{letters}]"))
    values = {"n": n, "all": F.regexp_count(c, F.lit(word)), "words": F.regexp_count(c, F.lit(r"(?U)\S+"))}

    def judge(v: Column) -> Column:
        choppy = (v["words"] >= 4) & (short_words(c, marks) / v["words"] > 0.75)
        few = (v["n"] / F.greatest(v["all"], F.lit(1)) < 0.5) & (v["n"] < 6)
        digits = (v["all"] > 0) & (F.regexp_count(c, F.lit(r"\p{Nd}")) == v["all"])
        return F.when(v["words"] == 0, True).when(v["n"] == 0, ~digits).otherwise(few | choppy)

    return bound(values, judge)


def short_words(c: Column, marks: str) -> Column:
    """Number of the words of at most two characters other than marks; punctuation counts."""
    return F.regexp_count(c, F.lit(rf"(?U)(?<!\S)(?=\S)[{marks}]*+(?:[^\s{marks}][{marks}]*+){{0,2}}+(?!\S)"))


def is_marker_line(c: Column, longest: int = 10, chars: str = cs.MARKER_LINE) -> Column:
    """Short lines of digits, brackets and marks alone, with a digit."""
    t = tx.strip(c)
    return (t != "") & (F.length(t) <= longest) & t.rlike(f"(?U)^[{chars}]*$") & t.rlike(r"\p{Nd}")


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: mean by weight, 0 where all weights are."""
    return F.sum(value * weight) / F.greatest(F.sum(weight), F.lit(1))


def box_union(x0: str, y0: str, x1: str, y1: str) -> list[Column]:
    """Aggregates: the box around all boxes."""
    return [F.min(x0).alias(x0), F.min(y0).alias(y0), F.max(x1).alias(x1), F.max(y1).alias(y1)]


def drop_last_line(df: DataFrame, by: list[str], order: str, matches: Column) -> DataFrame:
    """Drops the last line of each page where it matches, and no other."""
    w = Window.partitionBy(*by).orderBy(F.col(order).desc())
    return df.withColumn("__last", F.row_number().over(w) == 1).withColumn("__hit", matches).filter(~(F.col("__last") & F.col("__hit"))).drop("__last", "__hit")


def confident_text(df: DataFrame, by: list[str], word: str, conf: str, marks: str, least: float, out: str = "clean") -> DataFrame:
    """Words without their marks where the best reading of the same word in the same line is below `least`."""
    best = df.groupBy(*by, word).agg(F.max(conf).alias("best_conf"))
    return df.join(best, [*by, word]).withColumn(out, F.when(F.col("best_conf") < least, F.regexp_replace(word, f"[{marks}]", "")).otherwise(F.col(word)))


def clean_lines(lines: DataFrame, words: DataFrame, by: list[str], text: str = "text", conf: str = "conf", token: str = cs.ARABIC_TOKEN, marks: str = cs.DIACRITICS_BOOK, least: float = 62.0, out: str = "clean") -> DataFrame:
    """Lines of low confidence without the marks of their doubtful words; lines of `least` and more stay as they are.

    words: by, text, conf as they were read. A word is doubtful if its best reading in the line is below `least`; words that were
    not read so stay. All else in the line stays in its place.
    """
    from pagefold.operators.lexicon import replace_tokens

    best = words.groupBy(*by, F.col("text").alias("word")).agg(F.max("conf").alias("best")).filter(F.col("best") < least)
    table = best.select(*by, "word", F.regexp_replace("word", f"[{marks}]", "").alias("correction"))
    low = lines.filter(F.col(conf) < least)
    fixed = replace_tokens(low, by, text, table, token, out, on=by)
    return fixed.unionByName(lines.filter(~(F.col(conf) < least) | F.col(conf).isNull()).withColumn(out, F.col(text)))


def flip_decision(direct: Column, flipped: Column) -> Column:
    """Aggregate: whether the flipped distances have the lower median; true without evidence."""
    return F.coalesce(F.median(flipped) < F.median(direct), F.lit(True))


def pixel_metrics(difference: Column, threshold: int = 40) -> list[Column]:
    """Aggregates: mean and root mean square of absolute differences, and the share above the threshold."""
    d = F.abs(difference)
    return [F.avg(d).alias("mean_diff"), F.sqrt(F.avg(d * d)).alias("rms_diff"), F.avg(F.when(d > threshold, 1.0).otherwise(0.0)).alias("share_over")]


def rgb_metrics(a: list[Column], b: list[Column], threshold: int = 40) -> list[Column]:
    """Aggregates over pixels of three channels: mean and root mean square of all channels' differences, and the share of pixels of
    which a channel differs by more than the threshold."""
    d = [F.abs(x - y) for x, y in zip(a, b)]
    mean = lambda c: F.avg(sum(c[1:], c[0]) / len(c))
    return [mean(d).alias("mean_diff"), F.sqrt(mean([x * x for x in d])).alias("rms_diff"), F.avg(F.when(F.greatest(*d) > threshold, 1.0).otherwise(0.0)).alias("share_over")]


def otsu_threshold(histogram: DataFrame, level: str, count: str) -> DataFrame:
    """One row: the level that parts a histogram into two classes of the largest variance between them (first of ties).

    The histogram has one row per level, 256 at most for pictures."""
    w = Window.orderBy(level).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.orderBy(level).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = histogram.select(level, F.sum(count).over(w).alias("n0"), F.sum(F.col(level) * F.col(count)).over(w).alias("s0"), F.sum(count).over(every).alias("n"), F.sum(F.col(level) * F.col(count)).over(every).alias("s"))
    n1 = F.col("n") - F.col("n0")
    between = F.when(n1 > 0, F.col("n0") * n1 * F.pow(F.col("s0") / F.col("n0") - (F.col("s") - F.col("s0")) / n1, 2)).otherwise(F.lit(0.0))
    return s.withColumn("v", between).agg(F.min_by(level, F.struct(-F.col("v"), F.col(level))).alias("threshold"), F.max("v").alias("variance"))


def printed_numbers(lines: DataFrame, page: str, order: str, text: str) -> DataFrame:
    """Of each page the last line of one to three digits as a number, null where it has none."""
    t = tx.strip(F.col(text))
    hits = lines.filter(t.rlike(r"^\p{Nd}{1,3}$")).groupBy(page).agg(F.max_by(tx.to_ascii_digits(t), order).cast("int").alias("printed"))
    return lines.select(page).distinct().join(hits, page, "left")


def violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Rows that break each named check: rule, bad, total. A null counts as broken."""
    one = [F.struct(F.lit(n).alias("rule"), F.sum(F.when(ok, 0).otherwise(1)).alias("bad")) for n, ok in checks.items()]
    return df.agg(F.count(F.lit(1)).alias("total"), F.array(*one).alias("r")).select("total", F.explode("r").alias("r")).select("r.rule", F.coalesce("r.bad", F.lit(0)).cast("bigint").alias("bad"), "total")
