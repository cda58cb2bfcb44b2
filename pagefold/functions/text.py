"""Text functions, Column to Column. Regular expressions are Java's; (?U) gives Unicode classes."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagefold.functions import charsets as cs

Rule = Callable[[Column], Column]


def _form(form: str, stable: str) -> Callable[[Column], Column]:
    def normal(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else unicodedata.normalize(form, t))

    def apply(c: Column) -> Column:
        # Python sees only what can change: texts of stable characters alone are in the form
        return F.when(c.rlike(f"[^{stable}]"), F.pandas_udf(normal, "string")(F.when(c.rlike(f"[^{stable}]"), c))).otherwise(c)

    return apply


#: Unicode normal forms; Spark has no built-in for them.
nfc, nfkc = _form("NFC", r"\x00-\u02ff"), _form("NFKC", r"\x00-\x7f")


@cache
def members(chars: str) -> str:
    """All characters of a class that names none beyond U+FFFF; its \\s must be spelled out, as Python's is not Java's."""
    return "".join(re.findall(f"[{chars}]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))))


@cache
def one_map(*steps: tuple[str, str]) -> tuple[str, str]:
    """The pair for F.translate that does in one pass what the pairs do one after another."""
    whole: dict[str, str] = {}
    for source, target in steps:
        step: dict[str, str] = {}
        for k, x in enumerate(source):
            step.setdefault(x, target[k : k + 1])
        whole = step | {x: step.get(y, y) for x, y in whole.items()}
    kept = {x: y for x, y in whole.items() if y}
    return "".join(kept) + "".join(x for x in whole if x not in kept), "".join(kept.values())


def to_spaces(chars: str) -> tuple[str, str]:
    return members(chars), " " * len(members(chars))


def apply_rules(c: Column, rules: list[Rule]) -> Column:
    """The rules, each on the outcome of the one before."""
    return reduce(lambda x, rule: rule(x), rules, c)


def strip(c: Column) -> Column:
    """Trims white space of any kind, not just spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def drop(c: Column, chars: str) -> Column:
    return F.regexp_replace(c, f"[{chars}]", "")


def strip_diacritics(c: Column) -> Column:
    return drop(c, cs.DIACRITICS_NORMALISE)


def to_ascii_digits(c: Column) -> Column:
    return F.translate(c, cs.ARABIC_DIGITS, "0123456789")


def to_arabic_digits(c: Column) -> Column:
    """Number in Arabic-Indic digits; null stays null."""
    return F.translate(c.cast("string"), "0123456789", cs.ARABIC_DIGITS)


def normalise(c: Column, strip_punctuation: bool = True, compose: Rule = nfc) -> Column:
    """Comparable form: composed, punctuation to spaces, no diacritics, one form of each letter, ASCII digits, single spaces."""
    punct = [to_spaces(cs.OCR_PUNCTUATION)] if strip_punctuation else []
    # a regular expression's class costs a test by character and range, and a pass for each rule; a map is one pass
    chars = one_map(*punct, (members(cs.DIACRITICS_NORMALISE), ""), cs.UNIFY, (cs.ARABIC_DIGITS, "0123456789"), to_spaces(cs.WHITE))
    return F.trim(F.regexp_replace(F.translate(compose(F.coalesce(c, F.lit(""))), *chars), " {2,}", " "))


def skeleton(c: Column, compose: Rule = nfc) -> Column:
    """Letters of a word alone: composed, stripped of marks, in comparable form, without spaces."""
    # normalise drops all of DIACRITICS_PROOF and makes spaces of none
    return F.replace(normalise(c, compose=compose), F.lit(" "), F.lit(""))


DOTS_KEY = "\x00DOTS\x00"


def layout_key(c: Column, compose: Rule = nfc) -> Column:
    """Key to match lines by: letters only, in one form. Lines of dots alone share a key of their own."""
    key = F.translate(compose(c), *one_map((members(cs.DIACRITICS_LAYOUT + cs.LAYOUT_PUNCTUATION.replace(r"\s", cs.WHITE)), ""), cs.UNIFY_LAYOUT))
    return F.when(c.rlike(r"(?U)^\s*+\.[. ]*+\s*+$"), F.lit(DOTS_KEY)).otherwise(key)


def collapse_repeats(c: Column, letter: str) -> Column:
    """Runs of one letter become a single one."""
    return F.regexp_replace(c, f"{letter}{{2,}}", letter)


def unify_glyph_variants(c: Column) -> Column:
    return collapse_repeats(F.translate(c, *cs.GLYPH_VARIANTS), "ي")


def fix_shadda(c: Column) -> Column:
    return collapse_repeats(c, cs.SHADDA)


def fix_conflicting_marks(c: Column) -> Column:
    """Of each run of vowel marks the first; a shadda ends a run."""
    return F.regexp_replace(c, f"([{cs.VOWEL_MARKS}])[{cs.VOWEL_MARKS}]+", "$1")


STRUCTURAL_RULES: list[Rule] = [fix_shadda, fix_conflicting_marks]


def tidy_punctuation(c: Column, chars: str = cs.TIDY) -> Column:
    """No white space before closing punctuation."""
    return F.regexp_replace(c, rf"(?U)\s+([{chars}])", "$1")


def printed_page(page: Column, offset: int = 2) -> Column:
    """Printed number of a page, null for the pages before the first."""
    return F.when(page - offset >= 1, page - offset)


def mirror(c: Column) -> Column:
    return F.translate(c, *cs.MIRROR_PAIRS)


def escape_xml(c: Column) -> Column:
    for raw, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot")):
        c = F.replace(c, F.lit(raw), F.lit(f"&{name};"))
    return c


def is_arabic(c: Column, chars: str = cs.ARABIC_DECODER) -> Column:
    return c.rlike(f"[{chars}]")


def unless_mirrored(c: Column) -> Column:
    """Null where all characters are paired punctuation, whose drawn and typed forms may differ."""
    return F.when(~c.rlike(f"^[{cs.MIRRORED}]*$"), c)


def before_first_dot(c: Column) -> Column:
    return F.substring_index(c, ".", 1)


def from_hex(c: Column) -> Column:
    """Text of a run of UTF-16 code units in hex (surrogate pairs joined), compatibility-composed, no zero-width spaces."""
    return F.replace(nfkc(F.decode(F.unhex(c), "UTF-16BE")), F.lit("​"), F.lit(""))


#: Endings of glyph names that tell the form of a letter, tried in this order.
FORM_SUFFIXES = [".initlow.tall", ".initlow", ".init.tall", ".medi.tall", ".fina.tall", ".fina.short", ".medi.narrow", ".fina.narrow", ".init", ".medi", ".fina", ".isol", *(f".alt{k}" for k in range(1, 11))]

#: Glyph names of common characters.
BASIC_NAMES = dict(
    zip(
        "space nonmarkingreturn nbspace period comma colon semicolon hyphen endash emdash slash backslash bar underscore question exclam percent plus equal "
        "asterisk numbersign ampersand at dollar asciicircum asciitilde grave quotesingle quotedbl zero one two three four five six seven eight nine".split(),
        [" ", " ", " ", *".,:;-–—/\\|_?!%+=*#&@$^~`'\"0123456789"],
    )
)
LIGATURES = {"Allah": "لله"}
MIRRORED_NAMES = "parenleft parenright bracketleft bracketright braceleft braceright less greater angleleft angleright guilsinglleft guilsinglright".split()
FEATURE_TAG = r"(?i)^(zz\d*|calt|init|medi|fina|isol|alt\d*|liga|rlig|swsh|ss\d+|salt|ccmp|locl|kern|mkmk|curs|tnum|onum)$"


def _hex_name(base: Column) -> list[Column]:
    """Readings of uniXXXX.., uXXXX and liga.XXXX.. names; null where a name is none."""
    units = lambda p: F.nullif(F.regexp_extract(base, p, 1), F.lit(""))
    even = lambda h: F.call_function("substr", h, F.lit(1), (F.floor(F.length(h) / 4) * 4).cast("int"))
    uni, liga, u = units(r"^uni([0-9A-Fa-f]+)$"), units(r"^liga\.([0-9A-Fa-f]+)$"), units(r"^u([0-9A-Fa-f]{4,6})$")
    point = F.conv(u, 16, 10).cast("int")
    pair = F.concat(F.lpad(F.hex((F.shiftright(point - 0x10000, 10) + 0xD800).cast("int")), 4, "0"), F.lpad(F.hex(((point - 0x10000).bitwiseAND(0x3FF) + 0xDC00).cast("int")), 4, "0"))
    single = F.when(point < 0x10000, F.lpad(F.hex(point), 4, "0")).otherwise(pair)
    return [from_hex(even(uni)), from_hex(F.when(u.isNotNull() & ~base.rlike("^uni"), single)), from_hex(even(liga))]


def glyph_name_text(name: Column) -> Column:
    """Text of a glyph name after one known form ending is taken off; empty where it has none."""
    hits = F.coalesce(*[F.when(F.endswith(name, F.lit(s)), F.lit(len(s))) for s in FORM_SUFFIXES], F.lit(0))
    base = F.call_function("substr", name, F.lit(1), F.length(name) - hits)
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in _hex_name(base)], F.lit(""))


def plain_name_text(name: Column) -> Column:
    """Text of a glyph name by table, ligature or code points, whatever follows its first dot; null where it has none, for
    names that begin with a dot, and for mirrored punctuation."""
    base = F.when(F.startswith(name, F.lit("liga.")), F.concat(F.lit("liga."), before_first_dot(F.call_function("substr", name, F.lit(6))))).otherwise(before_first_dot(name))
    names = F.create_map(*[F.lit(x) for pair in BASIC_NAMES.items() for x in pair])
    found = F.coalesce(F.try_element_at(names, base), *[F.nullif(c, F.lit("")) for c in _hex_name(base)])
    return F.when(~(F.startswith(name, F.lit(".")) | base.isin(MIRRORED_NAMES)), unless_mirrored(found))


def char_multiset(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(c, "")), "")


def digit_signature(c: Column) -> Column:
    """Digits of a text in order, each as often as it comes."""
    return char_multiset(F.regexp_replace(c, r"[^\p{Nd}]", ""))


def classify_change(before: Column, after: Column, letters: str = cs.ARABIC_LETTERS, fake: str = cs.FAKE_MARKS, punctuation: str = ":،؛.", labels: dict[str, str] | None = None) -> Column:
    """What kinds of correction make `after` of `before`, joined by ' + ' in a fixed order.

    Two lines of digits alone are a reversed page number and nothing else. labels renames the kinds.
    """
    name = lambda k: F.lit((labels or {}).get(k, k))
    digits = lambda c: F.regexp_extract_all(c, F.lit(r"(\p{Nd}+)"), F.lit(1))
    times = lambda c, p: F.length(c) - F.length(F.replace(c, F.lit(p), F.lit("")))
    n_letters = lambda c: F.length(F.regexp_replace(c, f"[^{letters}]", ""))
    reversed_ = F.exists(digits(before), lambda d: F.array_contains(digits(after), F.reverse(d)))
    more = [times(after, p) > times(before, p) for p in punctuation]
    kinds = F.array_compact(
        F.array(
            F.when((digits(before) != digits(after)) & reversed_, name("reversed numbers")),
            F.when(char_multiset(before) == char_multiset(after), name("moved within line")),
            F.when(times(before, fake) > times(after, fake), name("fake marks removed")),
            F.when(n_letters(after) > n_letters(before), name("letters restored")),
            F.when(reduce(lambda a, b: a | b, more), name("punctuation restored")),
        )
    )
    page = strip(before).rlike(r"^\p{Nd}+$") & strip(after).rlike(r"^\p{Nd}+$")
    return F.when(page, name("reversed page number")).otherwise(F.when(F.size(kinds) == 0, name("marks or order")).otherwise(F.array_join(kinds, " + ")))


def typed_runs(c: Column, pattern: str) -> Column:
    """A line cut into runs (text, special): what the pattern matches, and what stands between."""
    gaps, hits = F.split(c, pattern, -1), F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1))
    pairs = F.flatten(F.transform(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda p: F.array(F.struct(p["gap"].alias("text"), F.lit(False).alias("special")), F.struct(p["hit"].alias("text"), F.lit(True).alias("special")))))
    return F.filter(pairs, lambda r: F.length(r["text"]) > 0)


def tokens(c: Column, pattern: str = cs.ARABIC_TOKEN) -> Column:
    return F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1))
