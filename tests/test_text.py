"""Text functions on hand-made rows."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagefold.functions import charsets as cs
from pagefold.functions import text as tx


def of(spark, function, *rows):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], "a string" if not isinstance(rows[0], tuple) else "a string, b string")
    return [r[0] for r in df.select(function(*[F.col(c) for c in df.columns]).alias("x")).collect()]


def test_normalise(spark):
    assert of(spark, tx.normalise, "بِٱلنَّفْسِ", "ءَايَةٍ", "آيَةٍ", "«قال»،  ٣٤", None, "a \tb") == ["بالنفس", "ايه", "ايه", "قال 34", "", "a b"]


def test_normalise_is_idempotent(spark):
    texts = ["بِٱلنَّفْسِ", "é é ﷺ", "‏ـa", "٣٤ (x)", "ﬁ ② ى"]
    once = of(spark, tx.normalise, *texts)
    assert of(spark, tx.normalise, *once) == once


def test_forms(spark):
    assert of(spark, tx.nfc, "é", "abc", None) == ["é", "abc", None]
    assert of(spark, tx.nfkc, "ﻩ", "②") == [unicodedata.normalize("NFKC", "ﻩ"), "2"]


def test_skeleton_and_layout_key(spark):
    assert of(spark, tx.skeleton, "المُلَاحَظَة") == ["الملاحظه"]
    assert of(spark, tx.layout_key, " . . .", "باب: ٣ (أ)", "") == [tx.DOTS_KEY, "بابا", ""]


def test_marks(spark):
    assert of(spark, tx.fix_shadda, "اّّ") == ["اّ"]
    a, d, s = "َ", "ُ", "ّ"
    assert of(spark, tx.fix_conflicting_marks, f"ب{a}{d}{s}{d}{a}", f"ب{d}{a}") == [f"ب{a}{s}{d}", f"ب{d}"]
    assert of(spark, tx.unify_glyph_variants, "ھیی") == ["هي"]


def test_tidy_numbers_and_mirror(spark):
    assert of(spark, tx.tidy_punctuation, "a  . b ،c") == ["a. b،c"]
    assert of(spark, lambda c: tx.to_arabic_digits(c.cast("int")), "120", None) == ["١٢٠", None]
    assert of(spark, lambda c: tx.printed_page(c.cast("int")), "2", "3", "45") == [None, 1, 43]
    assert of(spark, tx.mirror, "(a)[«b»]") == [")a(]»b«["]
    assert of(spark, tx.escape_xml, '<a & "b">') == ["&lt;a &amp; &quot;b&quot;&gt;"]


def test_glyph_names(spark):
    names = ["uniFEE9", "uniFEE9.fina", "uni06440627.alt10", "u1D538", "u0628.init", "liga.0628.init", "Allah", "", "uni06"]
    assert of(spark, tx.glyph_name_text, *names) == ["ه", "ه", "لا", "A", "ب", "ب", "", "", ""]
    assert of(spark, tx.plain_name_text, "period", "parenleft", ".notdef", "zero.tnum", "uni0028", "uni0628.xyz") == [".", None, None, "0", None, "ب"]
    assert of(spark, tx.unless_mirrored, "«", "a(", "[]") == [None, "a(", None]


@pytest.mark.parametrize(
    ("before", "after", "want"),
    [
        ("12", "21", "reversed page number"), ("ص 12 ا", "ص 21 اب", "reversed numbers + letters restored"), ("ا ب", "ب ا", "moved within line"),
        ("ا" + cs.FAKE_MARKS, "ا", "fake marks removed"), ("قال", "قال:", "punctuation restored"), ("قَال", "قُال", "marks or order"),
    ],
)
def test_classify(spark, before, after, want):
    assert of(spark, tx.classify_change, (before, after)) == [want]


def test_typed_runs_and_signature(spark):
    runs = of(spark, lambda c: tx.typed_runs(c, "﴾[^﴾﴿]*﴿"), "a ﴾b﴿c")[0]
    assert [(r["text"], r["special"]) for r in runs] == [("a ", False), ("﴾b﴿", True), ("c", False)]
    assert of(spark, tx.digit_signature, "a3-1٢1") == ["113٢"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab ()<>[]«»َّ.1", max_size=12), min_size=1, max_size=6))
def test_mirror_twice_is_the_text(spark, texts):
    assert of(spark, lambda c: tx.mirror(tx.mirror(c)), *texts) == texts


def test_one_pass_does_what_the_rules_do(spark):
    """Every character up to U+FFFF, between letters and beside its neighbours."""
    every = [chr(k) for k in range(0x10000) if not 0xD800 <= k < 0xE000]
    texts = [glue.join(every[k : k + 1024]) for glue in ("x", "") for k in range(0, len(every), 1024)] + ["", " ", "a \u3000\t b ", "\U0001d538 ٣"]
    same = lambda c: c
    cut = lambda c, chars, by="": F.regexp_replace(c, chars, by)
    folded = lambda c: F.translate(F.translate(cut(c, f"[{cs.DIACRITICS_NORMALISE}]"), *cs.UNIFY), cs.ARABIC_DIGITS, "0123456789")
    spaced = lambda c: cut(cut(c, r"(?U)\s+", " "), r"(?U)^\s+|\s+$")
    normal = lambda c: spaced(folded(cut(c, f"[{cs.OCR_PUNCTUATION}]", " ")))
    assert of(spark, lambda c: tx.normalise(c, compose=same), *texts) == of(spark, normal, *texts)
    assert of(spark, lambda c: tx.normalise(c, False, same), *texts) == of(spark, lambda c: spaced(folded(c)), *texts)
    assert of(spark, lambda c: tx.skeleton(c, same), *texts) == of(spark, lambda c: cut(normal(cut(c, f"[{cs.DIACRITICS_PROOF}]")), " "), *texts)
    key = lambda c: F.translate(cut(cut(c, f"[{cs.DIACRITICS_LAYOUT}]"), f"(?U)[{cs.LAYOUT_PUNCTUATION}]+"), *cs.UNIFY_LAYOUT)
    assert of(spark, lambda c: tx.layout_key(c, same), *texts) == of(spark, key, *texts)


@pytest.mark.parametrize("fold", [tx.normalise, tx.skeleton, tx.layout_key])
def test_folds_take_few_passes(spark, fold):
    """Each rule was a pass of its own over the text, up to seven of them."""
    plan = spark.createDataFrame([("a",)], "a string").select(fold(F.col("a"), compose=lambda c: c).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_replace(") + plan.count("translate(") <= 2


def test_runs_of_spaces(spark):
    """Each of the run's places was a place to part dots from white space."""
    assert of(spark, tx.layout_key, "." + " " * 200_000 + "x", "." + " ." * 9 + " \t\n") == ["x", tx.DOTS_KEY]


def test_latin_letters_are_composed():
    """What nfc keeps from Python is in the form."""
    low = [chr(k) for k in range(0x300)]
    assert all(unicodedata.is_normalized("NFC", a + b) for a in low for b in low)
