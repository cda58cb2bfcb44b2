"""The whole ways from a source to a result, composed of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.functions import charsets as cs
from pagefold.functions import text as tx
from pagefold.operators import align, corpus, lexicon, quality, reading, resolve
from pagefold.sources import sinks


def decode(glyph_rows: DataFrame, sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """Digital pages to text: glyphs (page, glyph_seq, xref, cid, x, y, is_mark, width) resolved by the sources (xref, cid,
    chars) in order of priority, only for the glyphs that are drawn, and assembled to lines. Unresolved ones are U+FFFD."""
    drawn = glyph_rows.select("xref", "cid").distinct()
    wanted = [(name, df.join(drawn, ["xref", "cid"], "left_semi")) for name, df in sources]
    chars = resolve.cascade(wanted, ["xref", "cid"])
    whole = glyph_rows.join(chars.select("xref", "cid", "chars"), ["xref", "cid"], "left").withColumn("chars", F.coalesce("chars", F.lit("�")))
    return reading.assemble(whole)


def unknown_glyphs(glyph_rows: DataFrame, chars: DataFrame, top: int = 60) -> DataFrame:
    """The most frequent glyphs without text: a report of the top."""
    lost = glyph_rows.join(chars.select("xref", "cid"), ["xref", "cid"], "left_anti")
    return lost.groupBy("xref", "cid").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "xref", "cid").limit(top)


def correct(lines: DataFrame, verses: DataFrame | None, words: DataFrame | None, token: str = cs.ARABIC_TOKEN, letters: str = cs.ARABIC_LETTERS, marks: str = cs.DIACRITICS_BOOK, plain: tx.Rule | None = None, skeleton: tx.Rule | None = None, threshold: float = 0.8, page_number: str = r"^[\s()\d.\-]{1,6}$") -> tuple[DataFrame, DataFrame]:
    """Scanned lines (page, line_no, text, conf) to corrected ones, and the log of changes.

    Noise is dropped, quotations of verses (part, verse, text) are put right where they stand, also over two lines, then structural
    rules and the lexicon (word, freq) correct words, and a last line of digits goes. Every change is logged. Without verses or
    words that step is left out. plain makes comparable form of a run of non-space, skeleton of a word.
    """
    same: tx.Rule = lambda c: c
    plain = plain or (lambda c: tx.normalise(c, compose=same))
    kept = lines.filter(~quality.is_noise(F.col("text"), letters, marks))
    if verses is not None:
        composed = kept.withColumn("text", tx.nfc(F.col("text")))
        repaired, fixes = corpus.repair_quotations(composed, "page", "line_no", "text", plain, verses, ["part", "verse"], "text", threshold)
        log = [fixes.select("page", "line_no", "kind", F.concat_ws(":", "part", "verse").alias("ref"), "before", "after", "score")]
    else:
        repaired, log = kept.withColumn("repaired", F.col("text")), []
    # between the brackets of a verse nothing is touched
    quoted = rf"{cs.VERSE_CLOSE}[^{cs.VERSE_OPEN}]*{cs.VERSE_OPEN}"
    runs = lambda c: tx.typed_runs(c, quoted)
    rules = lambda c: F.array_join(F.transform(runs(c), lambda r: F.when(r["special"], r["text"]).otherwise(tx.apply_rules(r["text"], tx.STRUCTURAL_RULES))), "")
    ready = repaired.withColumn("ready", rules(F.col("repaired")))
    out = ready.withColumn("corrected", F.col("ready"))
    if words is not None:
        open_words = lambda c: F.flatten(F.transform(F.filter(runs(c), lambda r: ~r["special"]), lambda r: tx.tokens(r["text"], token)))
        asked = ready.select(F.explode(open_words(F.col("ready"))).alias("raw")).distinct().withColumn("word", (skeleton or tx.skeleton)(F.col("raw")))
        table = asked.join(lexicon.corrections(asked, words), "word")
        table = table.filter("kind = 'fixed'").select(F.col("raw").alias("word"), lexicon.transfer_marks(F.col("raw"), F.col("correction"), "ًٌٍَُِّْ").alias("correction"))
        out = lexicon.replace_tokens(ready, ["page", "line_no"], "ready", table, f"{quoted}|{token}")
        changed = ready.select("page", "line_no", F.explode(open_words(F.col("ready"))).alias("word")).join(table, "word")
        log.append(changed.select("page", "line_no", F.lit("word").alias("kind"), F.col("word").alias("before"), F.col("correction").alias("after")))
    final = out.select("page", "line_no", F.col("corrected").alias("text"), "conf")
    final = quality.drop_last_line(final, ["page"], "line_no", F.col("text").rlike(page_number))
    if not log:
        log = [final.limit(0).select("page", "line_no")]
    return final, sinks.change_log(log)


def report(before: DataFrame, after: DataFrame, by: list[str], **how) -> dict[str, DataFrame]:
    """Two versions of pages (by, no, text) compared: changes with their kinds in order of page, block and place (pages without a
    number first), kinds by count, the commonest first, with the pages that have them, and changes by page."""
    changes = align.line_diff(before, after, by, "no", "text").withColumn("kinds", tx.classify_change(F.col("before"), F.col("after"), **how))
    order = [F.coalesce(F.col(by[-1]), F.lit(0))] if changes.schema[by[-1]].dataType.typeName() in ("integer", "long") else [F.col(by[-1])]
    return {"changes": changes.orderBy(*order, "block", "k"), "kinds": kind_counts(changes, by), "pages": changes.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))}


def kind_counts(changes: DataFrame, by: list[str], kinds: str = "kinds") -> DataFrame:
    """kind, n, n_pages: changes by kind, where a change may be of several, and the pages that have it; the commonest first."""
    each = changes.select(*by, F.explode(F.split(kinds, r" \+ ")).alias("kind"))
    return each.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(*by).alias("n_pages")).orderBy(F.col("n").desc(), "kind")


def map_layout(layout: DataFrame, final: DataFrame) -> dict[str, DataFrame]:
    """Layout lines (page, no, y, segments: array of arrays of cluster texts) mapped to final lines (page, no, text).

    Marker lines go to their nearest line first. Returns lines (page, no, segments, mapped: the segments with the final text dealt
    out to their clusters; lines without a partner and segments left blank keep their text), pairs, the report, and matched and
    final lines of each page.
    """
    text = align.line_text(F.transform("segments", lambda s: F.array_join(s, "")))
    told = layout.withColumn("text", text)
    absorbed = align.absorb_markers(told, ["page"], "no", "y", quality.is_marker_line(F.col("text")))
    lines = align.with_absorbed(layout, ["page"], "no", "segments", absorbed).withColumn("text", text)
    keyed = lambda df: df.withColumn("key", tx.layout_key(F.col("text")))
    left, right = keyed(lines), keyed(final)
    pairs = align.align_pages(left, right, ["page"], "no", "key", full=True)
    partner = pairs.filter("left_no is not null and right_no is not null").select("page", F.col("left_no").alias("no"), F.col("right_no").alias("__no"))
    whole = lines.join(partner, ["page", "no"], "left").join(final.select("page", F.col("no").cast("bigint").alias("__no"), F.col("text").alias("__final")), ["page", "__no"], "left")
    mapped = whole.select("page", "no", "segments", align.transfer_segments(F.col("segments"), F.col("__final")).alias("mapped"))
    both = F.col("left_no").isNotNull() & F.col("right_no").isNotNull()
    coverage = pairs.groupBy("page").agg(F.sum(F.col("right_no").isNotNull().cast("bigint")).alias("n_final"), F.sum(both.cast("bigint")).alias("n_matched"))
    return {"lines": mapped, "pairs": pairs, "report": align.mapping_report(pairs, left, right), "coverage": coverage}
