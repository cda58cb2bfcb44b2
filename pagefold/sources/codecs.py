"""Leaf codecs in plain Python: content streams of pages, and word-processor documents. Each runs one file or page a row."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

SPACE, DELIMITER = b"\x00\t\n\x0c\r ", b"()<>[]{}/%"
ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
ESCAPE = re.compile(rb"\\(\r\n|[0-7]{1,3}|.|\Z)", re.S)


def unescape(raw: bytes) -> bytes:
    """Bytes of a literal string: named and octal escapes, continued lines, any other character as itself."""

    def one(m: re.Match) -> bytes:
        c = m[1]
        if c[:1] in b"01234567" and c:
            return bytes([int(c, 8) & 255])
        return b"" if c in (b"\n", b"\r", b"\r\n") else ESCAPES.get(c, c)

    return ESCAPE.sub(one, raw)


LEXEME = re.compile(rb"[\x00\t\n\x0c\r ]+|%[^\r\n]*|(?P<dict><<|>>)|(?P<array>[\[\]])|<(?P<hex>[^>]*)>?|/(?P<name>[^\x00\t\n\x0c\r ()<>\[\]{}/%]*)|(?P<num>[+-]?(?:\d+\.?\d*|\.\d+)(?=[\x00\t\n\x0c\r ()<>\[\]{}/%]|\Z))|(?P<op>[^\x00\t\n\x0c\r ()<>\[\]{}/%]+)")


def lex(data: bytes) -> Iterator[tuple[str, object]]:
    """Lexemes of a content stream: name, num, str, hexstr, op, and the ends of arrays and dictionaries."""
    at, n = 0, len(data)
    while at < n:
        if data[at] == 40:  # a literal string nests its parentheses
            depth, end = 1, at + 1
            while end < n and depth:
                c = data[end]
                depth += (c == 40) - (c == 41)
                end += 2 if c == 92 else 1
            yield "str", unescape(data[at + 1 : end - (depth == 0)])
            at = end
            continue
        m = LEXEME.match(data, at)
        if m is None:
            at += 1
            continue
        at = m.end()
        kind = m.lastgroup
        if kind == "dict":
            yield ("dict_begin" if m[kind] == b"<<" else "dict_end"), None
        elif kind == "array":
            yield ("array_begin" if m[kind] == b"[" else "array_end"), None
        elif kind == "hex":
            digits = re.sub(rb"\s", b"", m[kind])
            good = re.fullmatch(rb"[0-9A-Fa-f]*", digits)
            yield "hexstr", bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode()) if good else b""
        elif kind == "num":
            yield "num", float(m[kind])
        elif kind:
            yield kind, m[kind].decode("latin-1")


IDENTITY = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)


def times(m: tuple, n: tuple) -> tuple:
    return (m[0] * n[0] + m[1] * n[2], m[0] * n[1] + m[1] * n[3], m[2] * n[0] + m[3] * n[2], m[2] * n[1] + m[3] * n[3], m[4] * n[0] + m[5] * n[2] + n[4], m[4] * n[1] + m[5] * n[3] + n[5])


def glyphs(data: bytes, fonts: dict[str, dict]) -> Iterator[tuple]:
    """(font, cid, x, y, size, width) of the glyphs that a content stream draws.

    fonts: by resource name, `wide` (two-byte codes) and `widths` (by code, thousandths). Graphics states nest; codes of
    unknown fonts are left out.
    """
    ctm, saved, line, tm, font, size, lead = IDENTITY, [], IDENTITY, IDENTITY, None, 1.0, 0.0
    stack: list = []

    def show(items: list) -> Iterator[tuple]:
        nonlocal tm
        spec, shift = fonts.get(font), 0.0
        for item in items:
            if isinstance(item, float):
                shift -= item / 1000 * size
            elif isinstance(item, bytes) and spec is not None:
                step = 2 if spec.get("wide") else 1
                for k in range(0, len(item) - step + 1, step):
                    cid = int.from_bytes(item[k : k + step], "big")
                    width = spec.get("widths", {}).get(cid, 1000.0 if step == 2 else 500.0) / 1000 * size
                    place = times(times((1, 0, 0, 1, shift, 0), tm), ctm)
                    yield font, cid, place[4], place[5], size * abs(place[3] or place[0]), width * abs(place[0] or 1)
                    shift += width
        tm = times((1, 0, 0, 1, shift, 0), tm)

    def move(x: float, y: float) -> None:
        nonlocal line, tm
        line = tm = times((1, 0, 0, 1, x, y), line)

    for kind, value in lex(data):
        if kind != "op":
            if kind == "array_end":
                items = []
                while stack and stack[-1] != "[":
                    items.append(stack.pop())
                if stack:
                    stack.pop()
                stack.append(items[::-1])
            else:
                stack.append("[" if kind == "array_begin" else value)
            continue
        numbers = [x for x in stack if isinstance(x, float)]
        if value == "q":
            saved.append(ctm)
        elif value == "Q" and saved:
            ctm = saved.pop()
        elif value == "cm" and len(numbers) >= 6:
            ctm = times(tuple(numbers[-6:]), ctm)
        elif value == "BT":
            line = tm = IDENTITY
        elif value == "Tf" and len(stack) >= 2:
            font, size = stack[-2], numbers[-1] if numbers else size
        elif value == "TL" and numbers:
            lead = numbers[-1]
        elif value == "Tm" and len(numbers) >= 6:
            line = tm = tuple(numbers[-6:])
        elif value in ("Td", "TD") and len(numbers) >= 2:
            lead = -numbers[-1] if value == "TD" else lead
            move(numbers[-2], numbers[-1])
        elif value == "T*":
            move(0, -lead)
        elif value in ("Tj", "'", '"', "TJ") and stack:
            if value in ("'", '"'):
                move(0, -lead)
            yield from show(stack[-1] if isinstance(stack[-1], list) else [stack[-1]])
        stack = []


def content_tokens(df: DataFrame, by: list[str], body: str) -> DataFrame:
    """by, seq, kind, value of each lexeme; strings in hex."""
    schema = df.select(*by).schema.simpleString()[7:-1] + ", seq bigint, kind string, value string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for row in frame.itertuples(index=False):
                for seq, (kind, value) in enumerate(lex(bytes(getattr(row, body) or b""))):
                    text = value.hex() if isinstance(value, bytes) else None if value is None else f"{value:g}" if isinstance(value, float) else value
                    rows.append((*[getattr(row, k) for k in by], seq, kind, text))
            yield pd.DataFrame(rows, columns=[*by, "seq", "kind", "value"])

    return df.select(*by, body).mapInPandas(run, schema)


def page_glyphs(df: DataFrame, by: list[str], body: str, fonts: dict[str, dict]) -> DataFrame:
    """by, glyph_seq, font, cid, x, y, size, width of each page's glyphs."""
    schema = df.select(*by).schema.simpleString()[7:-1] + ", glyph_seq bigint, font string, cid int, x double, y double, size double, width double"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(*[getattr(row, k) for k in by], seq, *g) for row in frame.itertuples(index=False) for seq, g in enumerate(glyphs(bytes(getattr(row, body) or b""), fonts))]
            yield pd.DataFrame(rows, columns=[*by, "glyph_seq", "font", "cid", "x", "y", "size", "width"])

    return df.select(*by, body).mapInPandas(run, schema)


W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing}"


def document_runs(data: bytes) -> Iterator[tuple]:
    """(page, box, run, x, y, text, font, size, colour) of a word-processor file's runs; a page break before a paragraph
    begins a page. Runs outside boxes have box 0."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        root = ET.fromstring(z.read("word/document.xml"))
    page, box, n = 1, 0, 0

    def runs(element: ET.Element, box_no: int, x: int | None, y: int | None) -> Iterator[tuple]:
        nonlocal n
        for r in element.iter(f"{W}r"):
            text = "".join(t.text or "" for t in r.findall(f"{W}t"))
            if text:
                p = r.find(f"{W}rPr")
                get = lambda tag, name: None if p is None or p.find(f"{W}{tag}") is None else p.find(f"{W}{tag}").get(f"{W}{name}")  # noqa: B023, E731
                size = get("sz", "val")
                yield page, box_no, n, x, y, text, get("rFonts", "ascii"), int(size) / 2 if size else None, get("color", "val")
                n += 1

    for paragraph in root.iter(f"{W}p"):
        if paragraph.find(f"{W}pPr/{W}pageBreakBefore") is not None:
            page += 1
        anchors = list(paragraph.iter(f"{A}anchor"))
        for anchor in anchors:
            box += 1
            at = [anchor.find(f"{A}position{d}/{A}posOffset") for d in "HV"]
            yield from runs(anchor, box, *(int(a.text) if a is not None and a.text else None for a in at))
        if not anchors and not any(paragraph is q for t in root.iter(f"{W}txbxContent") for q in t.iter(f"{W}p")):
            yield from runs(paragraph, 0, None, None)


def read_documents(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """Runs of word-processor files read with binaryFile."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "page", "box", "run", "x", "y", "text", "font", "size", "color"]
        for frame in frames:
            yield pd.DataFrame([(p, *r) for p, c in zip(frame[path], frame[content]) for r in document_runs(bytes(c))], columns=names).astype({"x": "Int64", "y": "Int64"})

    return files.select(path, content).mapInPandas(run, "path string, page int, box int, run int, x bigint, y bigint, text string, font string, size double, color string")
