"""Geometry of pages: units, affine maps, pen positions, text boxes, symbol codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Units of a point, and the page.
EMU_PER_POINT, TWIPS_PER_POINT = 12700, 20
PAGE_WIDTH, PAGE_HEIGHT = 595.28, 841.92
#: Line spacing, box height and baseline in units of the type size.
LINE, BOX, BASELINE = 1.30, 2.20, 0.8
#: Codes of symbols in legacy symbol fonts.
SYMBOL_CODES = {"•": "F0B7", "◆": "F0A8", "": "F0A8", "": "F0B7", "√": "F0D6", "○": "F06F"}


def emu(points: Column) -> Column:
    return F.bround(points * EMU_PER_POINT).cast("bigint")


def half_points(size: Column) -> Column:
    return F.bround(size * 2).cast("int")


def twips(points: Column) -> Column:
    return F.bround(points * TWIPS_PER_POINT).cast("int")


def compose(m: Column, n: Column) -> Column:
    """Product of two affine maps (a, b, c, d, e, f): m first, then n."""
    a = lambda x, i: F.element_at(x, i + 1)
    linear = [a(m, 2 * i) * a(n, j) + a(m, 2 * i + 1) * a(n, 2 + j) for i in (0, 1) for j in (0, 1)]
    shift = [a(m, 4) * a(n, j) + a(m, 5) * a(n, 2 + j) + a(n, 4 + j) for j in (0, 1)]
    return F.array(*linear, *shift)


def translate(m: Column, x: Column, y: Column) -> Column:
    """The map m after a shift by (x, y) in its own coordinates."""
    return compose(F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(1.0), x, y), m)


def flip(y: Column, height: Column) -> Column:
    return F.bround(height - y, 2)


def pen_positions(df: DataFrame, by: list[str], order: list[str], advance: str, out: str = "pen") -> DataFrame:
    """Where each glyph begins: the sum of the advances before it."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(advance).over(w), F.lit(0.0)))


def aligned_start(x0: Column, x1: Column, width: Column, how: Column) -> Column:
    """Where text of a width begins in a box, by `right`, `center` or else left."""
    return F.when(how == "right", x1 - width).when(how == "center", (x0 + x1 - width) / 2).otherwise(x0)


def text_box(x0: Column, x1: Column, baseline: Column, size: Column, page_width: float = PAGE_WIDTH) -> Column:
    """Struct x, y, w, h, align of the box that holds a segment: centred for wide segments about the middle of the page and
    for tiny ones, else right-aligned; kept on the page."""
    wide, middle = x1 - x0, (x0 + x1) / 2
    centred, tiny = (F.abs(middle - page_width / 2) < 28.0) & (wide > 90), wide < 26.0
    w = wide + F.when(centred, 16.0).otherwise(10.0)
    x = F.greatest(F.when(centred | tiny, middle - w / 2).otherwise(x1 + 1.2 - w), F.lit(0.0))
    return F.struct(x.alias("x"), F.greatest(baseline - BASELINE * LINE * size, F.lit(0.0)).alias("y"), F.least(w, page_width - x).alias("w"), (size * BOX).alias("h"), F.when(centred | tiny, "center").otherwise("right").alias("align"))


def symbol_code(char: Column) -> Column:
    """Code of a character in a legacy symbol font: by table, from the private use area, or below 256; else null."""
    table = F.create_map(*[F.lit(x) for pair in SYMBOL_CODES.items() for x in pair])
    point = F.conv(F.hex(F.encode(char, "UTF-16BE")), 16, 10).cast("int")
    own = F.when(point.between(0xF000, 0xF0FF), F.lpad(F.hex(point), 4, "0")).when(point <= 0xFF, F.concat(F.lit("F0"), F.lpad(F.hex(point), 2, "0")))
    return F.coalesce(F.try_element_at(table, char), own)


def colour(rgb: Column) -> Column:
    return F.format_string("#%06X", rgb.bitwiseAND(0xFFFFFF))
