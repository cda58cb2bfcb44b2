"""Sources: OCR tables, page records, page-marked text, corpora, word lists, character maps, page ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagefold.functions import text as tx

OCR_COLUMNS = "level int, page int, blk int, par int, ln int, word int, left int, top int, width int, height int, conf double, text string"
WORD = "struct<text:string,conf:double,bbox:array<int>>"
PAGE_RECORD = f"page int, native_shape array<int>, passes map<string,array<struct<bbox:array<int>,words:array<{WORD}>>>>"
CORPUS = "array<struct<id:int,name:string,verses:array<struct<id:int,text:string>>>>"


def ocr_words(lines: DataFrame, line: str = "line", order: str = "no", by: tuple[str, ...] = ()) -> DataFrame:
    """Words of an OCR engine's tab-separated rows: level 5, twelve fields, numbers that parse, text that is not blank."""
    # each row is cut once: no condition on the fields moves below the explode
    cut = lines.select(*by, order, F.explode(F.array(F.split(line, "\t"))).alias("__f"))
    field = lambda i, kind: F.try_element_at("__f", F.lit(i + 1)).try_cast(kind)
    names = [c.split() for c in OCR_COLUMNS.split(", ")]
    parsed = cut.select(*by, order, F.size("__f").alias("__n"), *[field(i, kind).alias(name) for i, (name, kind) in enumerate(names)])
    numbers = [F.col(n).isNotNull() for n, kind in names if kind != "string"]
    good = (F.col("__n") >= 12) & (F.col("level") == 5) & F.col("text").rlike(r"(?U)\S")
    for n in numbers:
        good = good & n
    return parsed.filter(good).drop("__n")


def ocr_lines(words: DataFrame, order: str = "no", by: tuple[str, ...] = ()) -> DataFrame:
    """Lines of those words: box around them, words in order and their number, numbered from the top.

    The number is a count of its own: who needs no words doesn't have them gathered."""
    box = F.array(F.col("left"), F.col("top"), F.col("left") + F.col("width"), F.col("top") + F.col("height"))
    word = F.struct(order, F.struct("text", "conf", box.alias("bbox")).alias("w"))
    lines = words.groupBy(*by, "page", "blk", "par", "ln").agg(
        F.array(F.min("left"), F.min("top"), F.max(F.col("left") + F.col("width")), F.max(F.col("top") + F.col("height"))).alias("bbox"),
        F.transform(F.array_sort(F.collect_list(word)), lambda s: s["w"]).alias("words"), F.count(F.lit(1)).alias("n_words"), F.min(order).alias("__first"))
    w = Window.partitionBy(*by, "page").orderBy(F.element_at("bbox", 2), "__first")
    return lines.withColumn("line_no", F.row_number().over(w)).drop("__first")


def page_records(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Page records from files named p<number>.json, of a stated schema; with a limit those of the lowest page numbers."""
    out = spark.read.schema(PAGE_RECORD).option("multiLine", True).option("pathGlobFilter", "p[0-9]*.json").json(path)
    return out if limit is None else out.orderBy("page").limit(limit)


def page_range(spec: Column, total: Column) -> Column:
    """Places from 0 of a range of pages like '1-5,7', in its order; those beyond total are left out, repeats stay.

    A range that runs down ('5-3') has no pages; an empty or null one stands for all pages.
    """

    def part(p: Column) -> Column:
        first, last = F.split_part(p, F.lit("-"), F.lit(1)).cast("int"), F.when(F.contains(p, F.lit("-")), F.split_part(p, F.lit("-"), F.lit(2))).otherwise(p).cast("int")
        return F.when(first <= last, F.sequence(first, F.greatest(first, last))).otherwise(F.array().cast("array<int>"))

    plain = F.nullif(F.regexp_replace(spec, r"\s", ""), F.lit(""))
    every = F.flatten(F.transform(F.split(plain, ","), part))
    chosen = F.filter(F.transform(every, lambda p: p - 1), lambda p: (p >= 0) & (p < total))
    return F.when(plain.isNotNull(), chosen).when(total > 0, F.sequence(F.lit(0), total.cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def page_subset(df: DataFrame, pages: list[int] | None, page: str = "page") -> DataFrame:
    """Rows of the pages listed; all where none are."""
    return df if not pages else df.filter(F.col(page).isin(pages))


PAGE_MARK = r"^===== PAGE (\d+) =====$"


def page_lines(lines: DataFrame, order: str, text: str, by: tuple[str, ...], mark: str = PAGE_MARK) -> DataFrame:
    """by, page, line_no, text of page-marked text: what comes before the first mark and blank lines are left out; of a
    page that is marked twice the later lines count. by: the columns that tell files apart, as a file is read by one task."""
    if not by:
        raise ValueError("page_lines needs the columns that tell files apart")
    number = F.nullif(F.regexp_extract(tx.strip(F.col(text)), mark, 1), F.lit("")).cast("int")
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumn("__mark", number)
    marked = marked.withColumn("page", F.last_value("__mark", ignoreNulls=True).over(w)).withColumn("__at", F.max(F.when(F.col("__mark").isNotNull(), F.col(order))).over(w))
    last = F.max("__at").over(Window.partitionBy(*by, "page"))
    kept = marked.withColumn("__last", last).filter(F.col("page").isNotNull() & F.col("__mark").isNull() & (F.col("__at") == F.col("__last")) & (tx.strip(F.col(text)) != ""))
    no = F.row_number().over(Window.partitionBy(*by, "page").orderBy(order))
    return kept.select(*by, "page", no.alias("line_no"), F.regexp_replace(text, r"(?U)\s+$", "").alias("text"))


def verse_corpus(df: DataFrame, json: str) -> DataFrame:
    """part, name, verse, text of a corpus in nested JSON."""
    parts = df.select(F.explode(F.from_json(json, CORPUS)).alias("p"))
    return parts.select(F.col("p.id").alias("part"), F.col("p.name").alias("name"), F.explode("p.verses").alias("v")).select("part", "name", F.col("v.id").alias("verse"), F.col("v.text").alias("text"))


def frequency_list(lines: DataFrame, line: str, least: int = 20, shortest: int = 2, longest: int = 30, key=tx.skeleton) -> DataFrame:
    """word, freq of lines 'word count': counts of digits, at least `least`, summed over words of one skeleton."""
    rows = lines.select(F.regexp_extract(line, r"^(.*) (\d+)\s*$", 1).alias("w"), F.regexp_extract(line, r"^(.*) (\d+)\s*$", 2).try_cast("bigint").alias("freq"))
    rows = rows.filter(F.col("freq") >= least).select(key(F.col("w")).alias("word"), "freq")
    return rows.filter(F.length("word").between(shortest, longest)).groupBy("word").agg(F.sum("freq").alias("freq"))


def affix_words(lines: DataFrame, line: str, order: str) -> DataFrame:
    """Distinct words of an affix dictionary: the header line left out, flags after '/' taken off."""
    body = lines.join(lines.agg(F.min(order).alias(order)), order, "left_anti")
    return body.select(F.substring_index(tx.strip(F.col(line)), "/", 1).alias("word")).filter("word <> ''").distinct()


def domain_words(lines: DataFrame, line: str, pattern: str, least: int = 3, key=tx.skeleton) -> DataFrame:
    return lines.select(F.explode(tx.tokens(F.col(line), pattern)).alias("w")).select(key(F.col("w")).alias("word")).filter(F.length("word") >= least).distinct()


def character_map(df: DataFrame, by: list[str], body: str) -> DataFrame:
    """by, cid, text of ToUnicode maps: single entries, ranges with an array, and ranges that count up.

    Later sections win, and ranges over single entries, as a reader that fills a table would have it. Two-byte targets
    count up by code point, longer ones by their last byte.
    """
    section = lambda name: F.regexp_extract_all(F.col(body), F.lit(rf"(?s)begin{name}(.*?)end{name}"), F.lit(1))
    hex_ = r"<\s*([0-9A-Fa-f]+)\s*>"
    number = lambda c: F.conv(c, 16, 10).cast("int")
    text = lambda h: F.decode(F.unhex(h), "UTF-16BE")
    chars = df.select(*by, F.posexplode(section("bfchar")).alias("sec", "s")).select(*by, F.lit(0).alias("kind"), "sec", F.posexplode(F.regexp_extract_all("s", F.lit(rf"({hex_}\s*{hex_})"), F.lit(1))).alias("pos", "e"))
    chars = chars.select(*by, "kind", "sec", "pos", number(F.regexp_extract("e", hex_, 1)).alias("cid"), text(F.regexp_extract("e", rf"{hex_}\s*{hex_}", 2)).alias("text"))
    entry = rf"({hex_}\s*{hex_}\s*(?:{hex_}|\[[^\]]*\]))"
    ranges = df.select(*by, F.posexplode(section("bfrange")).alias("sec", "s")).select(*by, F.lit(1).alias("kind"), "sec", F.posexplode(F.regexp_extract_all("s", F.lit(entry), F.lit(1))).alias("pos", "e"))
    ranges = ranges.withColumn("lo", number(F.regexp_extract("e", hex_, 1))).withColumn("hi", number(F.regexp_extract("e", rf"{hex_}\s*{hex_}", 2)))
    listed = F.regexp_extract_all(F.regexp_extract("e", r"\[(.*)\]", 1), F.lit(hex_), F.lit(1))
    first = F.regexp_extract("e", rf"{hex_}\s*{hex_}\s*{hex_}", 3)
    ranges = ranges.filter("hi >= lo and hi - lo <= 65535").withColumn("listed", listed).withColumn("first", first)
    each = ranges.select("*", F.explode(F.sequence(F.lit(0), F.col("hi") - F.col("lo"))).alias("i"))
    wrapped = F.concat(F.expr("left(first, length(first) - 2)"), F.lpad(F.hex((F.conv(F.expr("right(first, 2)"), 16, 10).cast("int") + F.col("i")) % 256), 2, "0"))
    counted = F.when(F.length("first") <= 4, F.lpad(F.hex(number(F.col("first")) + F.col("i")), 4, "0")).otherwise(wrapped)
    target = F.when(F.size("listed") > 0, F.try_element_at("listed", (F.col("i") + 1).cast("int"))).otherwise(F.nullif(counted, F.lit("")))
    ranged = each.select(*by, "kind", "sec", "pos", (F.col("lo") + F.col("i")).alias("cid"), text(target).alias("text")).filter("text is not null")
    return chars.unionByName(ranged).groupBy(*by, "cid").agg(F.max_by("text", F.struct("kind", "sec", "pos")).alias("text"))
