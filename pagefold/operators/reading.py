"""Reading order: glyphs of a page become lines of text, right to left, with numbers left to right.

All steps are joins and windows keyed by page. glyphs: page, glyph_seq, chars, x, y, is_mark, width.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagefold.functions import charsets as cs
from pagefold.functions import text as tx
from pagefold.operators import bands, spatial

LINE_Y, MARK_Y, MARK_X, SPACE_Y, PHANTOM = 3.5, 16.0, 30.0, 6.5, 2.5


def kinds(glyphs: DataFrame) -> DataFrame:
    """Adds kind: space for blank text, else mark or letter."""
    blank = tx.strip(F.col("chars")) == ""
    return glyphs.withColumn("kind", F.when(blank, "space").when(F.col("is_mark"), "mark").otherwise("letter"))


def lines_of(letters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Letters with their line_no (from the top), and the lines with the upper median of their letters' heights."""
    of = bands.anchored_bands(letters, ["page"], "y", LINE_Y).distinct()
    placed = letters.join(of, ["page", "y"])
    heights = placed.groupBy("page", "leader").agg(bands.upper_median("y").alias("line_y"))
    numbered = heights.withColumn("line_no", F.row_number().over(Window.partitionBy("page").orderBy(F.col("line_y").desc(), "leader")))
    return placed.join(numbered, ["page", "leader"]).drop("leader"), numbered.drop("leader")


def marks_of(marks: DataFrame, letters: DataFrame) -> DataFrame:
    """Each mark's letter: the nearest on the page, height counting a tenth, ties to the first line and glyph."""
    m = marks.select("page", F.col("glyph_seq").alias("mark_seq"), F.col("chars").alias("mark"), F.col("x").alias("mx"), F.col("y").alias("my"))
    to = letters.select("page", F.col("glyph_seq").alias("letter_seq"), F.col("x").alias("lx"), F.col("y").alias("ly"), "line_no")
    dx, dy = F.abs(F.col("mx") - F.col("lx")), F.abs(F.col("my") - F.col("ly"))
    return spatial.nearest_join(m, to, ["page"], "mx", "lx", MARK_X, ["page", "mark_seq"], ["line_no", "letter_seq"], dx + 0.1 * dy, dy <= MARK_Y)


def assemble(glyphs: DataFrame) -> DataFrame:
    """page, line_no, y, text of the glyphs' lines."""
    g = kinds(glyphs)
    letters, lines = lines_of(g.filter("kind = 'letter'"))
    marks = g.filter("kind = 'mark'")
    hung = marks_of(marks, letters)
    on_letter = hung.groupBy("page", F.col("letter_seq").alias("glyph_seq")).agg(F.collect_list(F.struct(F.col("mx").alias("x"), F.col("mark").alias("text"))).alias("marks"))
    none = F.array().cast("array<struct<x:double,text:string>>")
    whole = letters.join(on_letter, ["page", "glyph_seq"], "left").select("page", "line_no", "glyph_seq", "x", F.lit("c").alias("kind"), bands.merge_marks(F.col("chars"), F.coalesce("marks", none)).alias("text"))
    alone = marks.select("page", "glyph_seq", "chars", "x", "y").join(hung.select("page", F.col("mark_seq").alias("glyph_seq")), ["page", "glyph_seq"], "left_anti")
    alone = spatial.range_join(alone, lines, ["page"], "y", "line_y", MARK_Y).groupBy("page", "glyph_seq").agg(F.min("line_no").alias("line_no"), F.first("x").alias("x"), F.first("chars").alias("text")).select("page", "line_no", "glyph_seq", "x", F.lit("c").alias("kind"), "text")
    tokens = whole.unionByName(alone)
    spaces = spatial.range_join(g.filter("kind = 'space'").select("page", "glyph_seq", F.col("x").alias("sx"), "y"), lines, ["page"], "y", "line_y", SPACE_Y).select("page", "line_no", "glyph_seq", "sx")
    spaces = spatial.without_near(spaces, tokens.select("page", "line_no", F.col("x").alias("tx")), ["page", "line_no"], "sx", "tx", PHANTOM, ["page", "line_no", "glyph_seq"])
    every = tokens.unionByName(spaces.select("page", "line_no", "glyph_seq", F.col("sx").alias("x"), F.lit("s").alias("kind"), F.lit(" ").alias("text")))
    order = [F.col("x").desc(), F.col("glyph_seq")]
    every = every.withColumn("n", F.row_number().over(Window.partitionBy("page", "line_no").orderBy(*order)))
    every = bands.single_separators(every, ["page", "line_no"], ["n"], F.col("kind") == "s")
    joined = left_to_right(every).groupBy("page", "line_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda t: t["text"]), "").alias("text"))
    final = tx.unify_glyph_variants(tx.strip(tx.tidy_punctuation(F.col("text"))))
    return joined.join(lines, ["page", "line_no"]).select("page", "line_no", F.col("line_y").alias("y"), final.alias("text"))


def left_to_right(tokens: DataFrame) -> DataFrame:
    """Adds place: order from the right (n), but runs of digits and Latin letters, with punctuation between them, turned round."""
    by = ["page", "line_no"]
    kind = F.when(F.col("text").rlike(f"^[{cs.LTR_CORE}]+$"), "core").when(F.col("text").rlike(f"^[{cs.LTR_PUNCTUATION}]$"), "punct").otherwise("other")
    w = Window.partitionBy(*by).orderBy("n")
    solid = F.when(F.col("k") != "punct", F.col("k"))
    before = F.last(solid, True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(solid, True).over(w.rowsBetween(1, Window.unboundedFollowing))
    t = tokens.withColumn("k", kind).withColumn("ltr", (F.col("k") == "core") | ((F.col("k") == "punct") & (before == "core") & (after == "core")))
    t = bands.islands(t.withColumn("ltr", F.coalesce("ltr", F.lit(False))), by, ["n"], F.col("ltr"))
    turned = F.when(F.col("ltr"), -F.col("n")).otherwise(F.col("n"))
    return t.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy("run", turned))).drop("k", "ltr", "run")


def layout_lines(glyphs: DataFrame) -> DataFrame:
    """page, line_no, segment, x0, x1, y, text: the same lines with their geometry, cut into segments at gaps."""
    letters, _ = lines_of(kinds(glyphs).filter("kind = 'letter'"))
    c = letters.select(F.struct("page", "line_no").alias("line"), F.col("glyph_seq").cast("bigint").alias("glyph_seq"), "chars", F.col("x").alias("x0"), (F.col("x") + F.col("width")).alias("x1"), "y")
    segments = bands.layout_segments(c, ["line"], "x0", "x1", "y", "glyph_seq")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("x0")).alias("o"), "glyph_seq", "chars"))), lambda s: s["chars"]), "")
    out = c.join(segments, ["line", "glyph_seq"]).groupBy("line", "segment").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), bands.upper_median("y").alias("y"), text.alias("text"))
    return out.select("line.*", "segment", F.bround("x0", 2).alias("x0"), F.bround("x1", 2).alias("x1"), F.bround("y", 2).alias("y"), "text")
