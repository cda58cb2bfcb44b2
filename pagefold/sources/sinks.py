"""Sinks: page-marked text, page records, rendered pages, change logs, nested layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagefold.functions import charsets as cs
from pagefold.functions import text as tx


def page_texts(lines: DataFrame, page: str = "page", order: str = "line_no", text: str = "text", pages: DataFrame | None = None, head: str = "===== PAGE %d =====") -> DataFrame:
    """page, body: the mark of each page and its lines in order; of the pages given, those without lines have the mark alone."""
    body = lines.groupBy(page).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda s: s[text]), "\n").alias("__body"))
    if pages is not None:
        body = pages.select(page).distinct().join(body, page, "left")
    return body.select(page, F.concat_ws("\n", F.format_string(head, F.col(page)), "__body").alias("body"))


def write_text(texts: DataFrame, path: str, page: str = "page") -> None:
    """Pages in ascending order as text files that read in order of their names; ranges of pages are written side by side."""
    texts.repartitionByRange(F.col(page)).sortWithinPartitions(page).select("body").write.mode("overwrite").text(path)


def rendered(lines: DataFrame, printed: DataFrame | None = None, clean: bool = False, doubtful: float = 40.0, head: str = "===== %d =====", foot: str = "[%s]") -> DataFrame:
    """page, body of lines (page, line_no, text, conf): blank lines left out, doubtful ones marked unless clean, and the
    printed number (page, printed) in Arabic-Indic digits at the foot."""
    text = F.when((F.col("conf") < doubtful) & F.lit(not clean), F.concat("text", F.lit("   " + cs.DOUBT))).otherwise(F.col("text"))
    kept = lines.filter(tx.strip(F.col("text")) != "").withColumn("text", text)
    out = page_texts(kept, pages=lines, head=head)
    if printed is None:
        return out
    number = tx.to_arabic_digits(F.col("printed"))
    return out.join(printed, "page", "left").select("page", F.concat_ws("\n", "body", F.when(F.col("printed").isNotNull(), F.format_string(foot, number))).alias("body"))


def write_records(records: DataFrame, path: str, page: str = "page") -> None:
    """One folder of JSON per page; other pages' folders stay."""
    records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(page).json(path)


def change_log(changes: list[DataFrame]) -> DataFrame:
    """All changes as page, line_no, kind, ref, before, after, score; what a source lacks is null."""
    schema = {"page": "int", "line_no": "int", "kind": "string", "ref": "string", "before": "string", "after": "string", "score": "double"}
    out = None
    for df in changes:
        part = df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in schema.items()])
        out = part if out is None else out.unionByName(part)
    return out


def nested(df: DataFrame, levels: list[tuple[list[str], str, str]]) -> DataFrame:
    """Rows folded level by level: (keys, order, name) groups by keys and collects the rest, in order, into name."""
    for keys, order, name in levels:
        rest = [c for c in df.columns if c not in keys]
        df = df.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, F.struct(*rest).alias("r")))), lambda s: s["r"]).alias(name))
    return df


def as_json(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, F.to_json(F.struct(*df.columns)).alias("json"))


def run_properties(family: Column, size: Column, colour: Column, bold: Column) -> Column:
    """Properties of a word-processor run as XML."""
    face = F.format_string('<w:rFonts w:ascii="%1$s" w:hAnsi="%1$s" w:cs="%1$s"/>', tx.escape_xml(family))
    half = F.bround(size * 2).cast("int")
    return F.concat(F.lit("<w:rPr>"), face, F.when(bold, "<w:b/><w:bCs/>").otherwise(""), F.format_string('<w:color w:val="%s"/><w:sz w:val="%d"/><w:szCs w:val="%d"/>', F.upper(F.replace(F.coalesce(colour, F.lit("#000000")), F.lit("#"), F.lit(""))), half, half), F.lit("</w:rPr>"))


def run(text: Column, properties: Column) -> Column:
    return F.concat(F.lit("<w:r>"), properties, F.lit('<w:t xml:space="preserve">'), tx.escape_xml(text), F.lit("</w:t></w:r>"))
