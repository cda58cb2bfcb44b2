"""Operators on hand-computed frames."""

import difflib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagefold.functions import geometry as geo
from pagefold.operators import align, bands, corpus, lexicon, quality, reading, resolve, spatial
from pagefold.plans import pipelines
from pagefold.sources import codecs, readers, sinks
from pagefold.streaming import incremental


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_noise(spark):
    lines = ["", "  ", "12", "***", "سلام عليكم", "ab", "ا ب ت ث", "سلام *** ()", "!a!", "كتاب علم التجويد في النحو"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    assert [r[1] for r in rows(df.select("i", quality.is_noise(F.col("line"))))] == [True, True, False, True, False, True, True, False, True, False]
    assert [r[0] for r in df.select(quality.is_marker_line(F.col("line"))).collect()] == [False, False, True] + [False] * 7


def test_weighted_mean_stays_within_bounds(spark):
    df = spark.createDataFrame([("a", 10.0, 2), ("a", 40.0, 4), ("b", 7.0, 0)], "g string, c double, n int")
    assert rows(df.groupBy("g").agg(quality.weighted_mean(F.col("c"), F.col("n")))) == [("a", 30.0), ("b", 0.0)]


def test_nearest_prefers_the_first_of_ties(spark):
    left = spark.createDataFrame([(1, 10, 5.0), (1, 11, 99.0)], "page int, id int, x double")
    right = spark.createDataFrame([(1, 1, 3.0), (1, 2, 7.0), (2, 3, 5.0)], "page int, rid int, u double")
    assert rows(spatial.nearest_join(left, right, ["page"], "x", "u", 10.0, ["page", "id"], ["rid"]), "id", "rid", "distance") == [(10, 1, 2.0)]
    assert rows(spatial.without_near(left, right, ["page"], "x", "u", 10.0, ["page", "id"]), "id") == [(11,)]


def test_overlap_join_meets_each_pair_once(spark):
    rnd = random.Random(0)
    a = [(1, i, float(x), float(x + rnd.randint(1, 60))) for i, x in enumerate(rnd.sample(range(300), 40))]
    b = [(1, i, float(x), float(x + rnd.randint(1, 60))) for i, x in enumerate(rnd.sample(range(300), 40))]
    got = rows(spatial.overlap_join(spark.createDataFrame(a, "p int, i int, s double, e double"), spark.createDataFrame(b, "p int, j int, t double, f double"), ["p"], ("s", "t"), ("e", "f"), 25.0, 6.0), "i", "j")
    assert got == sorted(((i, j) for _, i, s, e in a for _, j, t, f in b if min(e, f) - max(s, t) > 6), key=repr)


def test_bands_are_anchored_not_chained(spark):
    df = spark.createDataFrame([(1, y) for y in (0.0, 3.0, 6.0, 20.0, None)], "page int, y double")
    assert rows(bands.anchored_bands(df, ["page"], "y", 3.5)) == [(1, 0.0, 0.0), (1, 20.0, 20.0), (1, 3.0, 0.0), (1, 6.0, 6.0)]


def test_layout_segments(spark):
    cells = [(1, 0, 0.0, 10.0, 0.0), (1, 1, 11.0, 20.0, 0.0), (1, 2, 26.5, 30.0, 0.0), (1, 3, 32.0, 40.0, 3.0), (1, 4, 47.0, 50.0, 3.0)]
    df = spark.createDataFrame(cells, "line int, o bigint, a double, b double, y double")
    assert rows(bands.layout_segments(df, ["line"], "a", "b", "y", "o"), "o", "segment") == [(0, 1), (1, 1), (2, 2), (3, 3), (4, 4)]


def test_overlaid_looks_at_the_last_unflagged(spark):
    df = spark.createDataFrame([(1, 0, 0.0, 8.0), (1, 1, 1.0, 8.0), (1, 2, 1.9, 8.0), (1, 3, 2.5, 8.0)], "l int, o bigint, x double, w double")
    assert [r[1] for r in rows(bands.overlaid(df, ["l"], "x", "w", "o"), "o", "overlaid")] == [False, True, True, False]


def test_lexicon_and_corrections(spark):
    some = lambda *w: spark.createDataFrame([(x, 1) for x in w], "word string, n int")
    lex = lexicon.build([(some("grape", "grapes", "melon"), "word", 2000), (some("melon"), "word", 1)], [(some("melon", "peach"), "word", 1)])
    assert rows(lex) == [("grape", 2000), ("grapes", 2000), ("melon", 2001), ("peach", 1)]
    got = dict((w, (k, c)) for w, k, c in rows(lexicon.corrections(some("melom", "grape", "ab", "zzzzz", "graper", "peachy"), lex), "word", "kind", "correction"))
    assert got == {"melom": ("fixed", "melon"), "grape": ("known", "grape"), "ab": ("short", "ab"), "zzzzz": ("unknown", "zzzzz"), "graper": ("ambiguous", "graper"), "peachy": ("fixed", "peach")}
    lines = spark.createDataFrame([(1, "a melom, peech!")], "no int, t string")
    table = spark.createDataFrame([("melom", "melon"), ("peech", "peach")], "word string, correction string")
    assert rows(lexicon.replace_tokens(lines, ["no"], "t", table, "[a-z]+"), "corrected") == [("a melon, peach!",)]


def test_marks_move_with_their_letters():
    acute, grave = "\u0301", "\u0300"
    marks, word = frozenset(acute + grave), f"a{acute}bc{grave}"
    assert lexicon.moved_marks(word, "abc", marks) == word
    assert lexicon.moved_marks(word, "axc", marks) == f"a{acute}xc{grave}"
    assert lexicon.moved_marks(word, "axc", marks, compat=True) == word
    assert lexicon.moved_marks(f"a{acute}b", "abd", marks) == f"a{acute}bd"


@given(st.text("abc", max_size=8), st.text("abc", max_size=8))
def test_moved_marks_keeps_the_target(a, b):
    acute = "\u0301"
    assert lexicon.moved_marks(acute.join(a), b, frozenset(acute)).replace(acute, "") == b


def test_corpus(spark):
    verses = spark.createDataFrame([(1, 1, "in the beginning was the word"), (1, 2, "and the light shines in darkness"), (1, 3, "the word became flesh")], "part int, verse int, text string")
    index = corpus.inverted_index(verses, ["part", "verse"], "text")
    anchors = corpus.unique_anchors(index, ["part", "verse"])
    assert rows(anchors, "token", "verse") == [("became", 3), ("beginning", 1), ("darkness", 2), ("flesh", 3), ("light", 2), ("shines", 2)]
    q = spark.createDataFrame([(9, "the the word")], "q int, t string")
    assert rows(corpus.probe(q, ["q"], "t", index, ["part", "verse"]), "verse", "hits") == [(1, 3), (2, 2), (3, 3)]
    lines = spark.createDataFrame([(1, 1, "he said and the light shines in darknes there"), (1, 2, "nothing here at all")], "page int, line_no int, t string")
    spans = corpus.find_spans(lines, ["page", "line_no"], "t", verses, anchors, ["part", "verse"], "text")
    assert rows(spans, "line_no", "verse", "first", "last")[0][:2] == (1, 2) and spans.count() == 1
    fixed, log = corpus.repair_spans(lines, ["page", "line_no"], "t", spans, ["part", "verse"], verses, "text")
    assert rows(fixed, "repaired") == [("he said ﴿and the light shines in darkness﴾ darknes there",), ("nothing here at all",)] and log.count() == 1
    names = spark.createDataFrame([(1, "the cow"), (2, "the cowherd")], "id int, name string")
    asked = spark.createDataFrame([("the cow",), ("cowherd",), ("none",)], "name string")
    assert rows(corpus.resolve_name(asked, names, "id", "id")) == [("cowherd", 2), ("none", None), ("the cow", 1)]


VERSES = [(1, 1, "alphaone betatwo gammathree deltafour epsilonfive"), (1, 2, "zetasix etaseven thetaeight iotanine kappaten")]


def bare(c):
    return F.regexp_replace(F.lower(c), "[^a-z]", "")


def test_repair_keeps_what_is_not_quoted(spark):
    verses = spark.createDataFrame(VERSES, "part int, verse int, text string")
    lines = [
        (1, 1, "He Said,  (loudly): alphaone betatwo gamathree deltafour epsilonfive - END!"), (1, 2, "Nothing at all."), (1, 3, "so: Zetasix, etaseven"), (1, 4, "thetaeight iotanine kappaten; Done."),
        (2, 1, "etaseven thetaeight"), (2, 2, "of no verse"), (2, 3, "  "),
    ]
    df = spark.createDataFrame(lines, "page int, line_no int, text string")
    out, log = corpus.repair_quotations(df, "page", "line_no", "text", bare, verses, ["part", "verse"], "text")
    got = {(r["page"], r["line_no"]): r["repaired"] for r in out.collect()}
    assert got == {
        (1, 1): f"He Said,  (loudly): ﴿{VERSES[0][2]}﴾ - END!", (1, 2): "Nothing at all.", (1, 3): f"so: ﴿{VERSES[1][2]}﴾ Done.", (2, 1): "etaseven thetaeight", (2, 2): "of no verse", (2, 3): "  ",
    }
    assert rows(log, "page", "line_no", "kind", "before") == [(1, 1, "verse", "alphaone betatwo gamathree deltafour epsilonfive"), (1, 3, "verse over two lines", "Zetasix, etaseven thetaeight iotanine kappaten;")]
    alone, _ = corpus.repair_quotations(df, "page", "line_no", "text", bare, verses, ["part", "verse"], "text", join_next=False)
    assert alone.count() == len(lines)


def test_correct(spark):
    verses = spark.createDataFrame(VERSES, "part int, verse int, text string")
    words = spark.createDataFrame([("melon", 9), ("grape", 7), ("nothing", 5), ("said", 5)], "word string, freq bigint")
    lines = spark.createDataFrame([(1, 1, "He said, (Loudly): alphaone betatwo gammathree deltafour epsilonfive - END!", 80.0), (1, 2, "a melom, Nothing!", 50.0), (1, 3, "***", 90.0), (1, 4, "(12)", 90.0)], "page int, line_no int, text string, conf double")
    how = {"token": "[A-Za-z]+", "letters": "A-Za-z", "plain": bare, "skeleton": F.lower}
    out, log = pipelines.correct(lines, verses, words, **how)
    assert rows(out, "line_no", "text") == [(1, f"He said, (Loudly): ﴿{VERSES[0][2]}﴾ - END!"), (2, "a melon, Nothing!")]
    assert rows(log, "line_no", "kind", "before", "after") == [(1, "verse", VERSES[0][2], VERSES[0][2]), (2, "word", "melom", "melon")]
    plain, none = pipelines.correct(lines, None, None, **how)
    assert rows(plain, "line_no", "text")[1] == (2, "a melom, Nothing!") and none.count() == 0


def test_noise_counts_punctuation_in_words(spark):
    df = spark.createDataFrame([("ab, cd, ef, gh,",), ("ab cd ef gh",), ("a! bc de fgh ij",)], "line string")
    assert [r[0] for r in df.select(quality.is_noise(F.col("line"), "a-z", "~")).collect()] == [False, True, True]


def test_clean_lines(spark):
    lines = spark.createDataFrame([(1, "ka~t, do~g ka~t", 50.0), (2, "ka~t", 70.0), (3, "ma~t", 10.0)], "no int, text string, conf double")
    words = spark.createDataFrame([(1, "ka~t", 40.0), (1, "ka~t", 61.0), (1, "do~g", 80.0), (2, "ka~t", 1.0)], "no int, text string, conf double")
    assert rows(quality.clean_lines(lines, words, ["no"], token="[a-z~]+", marks="~"), "no", "clean") == [(1, "kat, do~g kat"), (2, "ka~t"), (3, "ma~t")]


def test_rgb_metrics(spark):
    df = spark.createDataFrame([(0, 0, 0, 0, 0, 50), (10, 10, 10, 10, 10, 10)], "a int, b int, c int, d int, e int, f int")
    mean, rms, share = df.agg(*quality.rgb_metrics([F.col(x) for x in "abc"], [F.col(x) for x in "def"])).first()
    assert abs(mean - 50 / 6) < 1e-9 and abs(rms - (2500 / 6) ** 0.5) < 1e-9 and share == 0.5


def test_blank_segments_keep_their_text():
    assert align.spread_line([["abc"], ["def"]], "abc") == [["abc"], ["def"]]
    assert align.spread_line([["a", "b"], [" ", "c"]], "axc") == [["a", "x"], ["", "c"]]
    assert align.spread_line([], "x") == []


def test_line_text(spark):
    df = spark.createDataFrame([([("ab", False), ("c", True), (" ", True), ("d", True)],)], "s array<struct<text:string,sp:boolean>>")
    assert df.select(align.segment_text(F.col("s"))).first()[0] == "ab c  d"
    lines = spark.createDataFrame([(["one", " ", "two", "."],)], "s array<string>")
    assert lines.select(align.line_text(F.col("s"))).first()[0] == "one two."


def test_map_layout(spark):
    layout = [(1, 1, 100.0, [["first ", "line"], ["tail"]]), (1, 2, 110.0, [["(1)"]]), (1, 3, 200.0, [["second line of text"]]), (1, 4, 300.0, [["nobody has this one"]])]
    final = [(1, 1, "first lime (1)"), (1, 2, "second line of test"), (1, 3, "quite different words entirely")]
    out = pipelines.map_layout(spark.createDataFrame(layout, "page int, no bigint, y double, segments array<array<string>>"), spark.createDataFrame(final, "page int, no bigint, text string"))
    mapped = {r["no"]: ["".join(s) for s in r["mapped"]] for r in out["lines"].collect()}
    assert set(mapped) == {1, 3, 4} and mapped[1][0].startswith("first lime") and mapped[1][2] == "(1)" and mapped[3] == ["second line of test"]
    kinds = {r["kind"] for r in out["report"].collect()}
    assert rows(out["coverage"], "n_final")[0] == (3,) and kinds & {"weak match", "kept as it was", "not mapped"}


def test_winner_that_holds_the_query(spark):
    pairs = spark.createDataFrame([(1, 1, 0.9, False), (1, 2, 0.88, True), (2, 1, 0.9, True), (2, 3, 0.89, True)], "q int, v int, s double, h boolean")
    assert rows(corpus.clear_winner(corpus.rank(pairs, ["q"], "s", ["v"]), ["q"], holds=F.col("h")), "q", "v") == [(1, 2)]
    verses = spark.createDataFrame([(1, "n", v, f"t{v}") for v in range(1, 5)] + [(2, "m", 1, "x")], "part int, name string, verse int, text string")
    assert rows(corpus.verse_range(verses, 1, 2, 9), "verse") == [(2,), (3,), (4,)] and rows(corpus.verse_range(verses, 1, 3), "text") == [("t3",)]
    assert rows(corpus.part_names(verses)) == [(1, "n"), (2, "m")]


def test_report_order(spark):
    a = spark.createDataFrame([(2, 1, "x1"), (1, 1, "a"), (1, 2, "b")], "p int, no int, text string")
    b = spark.createDataFrame([(2, 1, "x2"), (1, 1, "ab"), (1, 2, "b.")], "p int, no int, text string")
    out = pipelines.report(a, b, ["p"], letters="a-z")
    assert [r["p"] for r in out["changes"].collect()] == [1, 1, 2]
    assert [tuple(r) for r in out["kinds"].collect()][0][1:] == (1, 1)


def test_unknown_glyphs_and_decode(spark):
    g = [(1, k, 7, cid, 100.0 - 6 * k, 700.0, False, 5.0) for k, cid in enumerate([1, 2, 9, 9, 8])]
    glyphs = spark.createDataFrame(g, "page int, glyph_seq int, xref int, cid int, x double, y double, is_mark boolean, width double")
    known = lambda *r: spark.createDataFrame(list(r), "xref int, cid int, chars string")
    assert rows(pipelines.unknown_glyphs(glyphs, known((7, 1, "a"), (7, 2, "b")))) == [(7, 8, 1), (7, 9, 2)]
    out = pipelines.decode(glyphs, [("map", known((7, 1, "ا"), (7, 2, "ب"))), ("names", known((7, 9, "ت"), (7, 1, "x")))])
    assert rows(out, "page", "text") == [(1, "ابتت�")]


def test_printed_numbers_first_font_and_family(spark):
    lines = spark.createDataFrame([(1, 1, "12"), (1, 2, " ٣٤ "), (1, 3, "x"), (2, 1, "none")], "page int, no int, text string")
    assert rows(quality.printed_numbers(lines, "page", "no", "text")) == [(1, 34), (2, None)]
    fonts = spark.createDataFrame([("F1", 9, "b", 2), ("F1", 4, "a", 1), ("F2", 5, "c", 3)], "ref string, xref int, name string, page int")
    assert rows(resolve.first_font(fonts)) == [("F1", 4, "a"), ("F2", 5, "c")]
    names = spark.createDataFrame([("ABC+Traditional-Bold",), ("Other",)], "name string")
    assert [r[0] for r in names.select(resolve.family(F.col("name"), [("traditional", "T")], F.lit("D"))).collect()] == ["T", "D"]
    wanted = spark.createDataFrame([(1,), (2,), (3,)], "gid int")
    assert rows(resolve.source_counts(wanted, spark.createDataFrame([(1, "cmap"), (2, "cmap")], "gid int, source string"), ["gid"])) == [("cmap", 2), ("unresolved", 1)]


def test_folds_carry_their_state_over_batches(spark):
    """Long groups against the rule: their rows come in many Arrow batches."""
    rnd = random.Random(1)
    cells = [(g, i, rnd.randrange(4000) / 4) for i in range(3000) for g in (1, 2)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    got = rows(bands.anchored_bands(spark.createDataFrame(cells, "g int, i int, v double"), ["g"], "v", 3.0))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want, leader = [], {}
    for g, v in sorted((g, v) for g, _, v in cells):
        leader[g] = v if g not in leader or v - leader[g] > 3 else leader[g]
        want.append((g, v, leader[g]))
    assert got == sorted(want, key=repr)


def test_ranking_margin(spark):
    pairs = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.88), (2, 1, 0.9), (2, 3, 0.5), (3, 1, 0.7)], "q int, v int, s double")
    won = corpus.clear_winner(corpus.rank(pairs, ["q"], "s", ["v"]), ["q"])
    assert rows(won, "q", "v") == [(2, 1), (3, 1)]


@given(st.lists(st.sampled_from(["aa", "ab", "bb", ""]), max_size=6), st.lists(st.sampled_from(["aa", "ab", "bb", ""]), max_size=6))
def test_alignment_keeps_order_and_rows(a, b):
    pairs, left, right = align.align(a, b)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    assert sorted([i for i, _ in pairs] + left) == list(range(len(a))) and sorted([j for _, j in pairs] + right) == list(range(len(b)))


def test_mapping_pairs_digits_and_takes_a_second_chance():
    pairs, findings = align.map_lines(["12", "chapter one of it", "tail words here"], ["tail words hera", "chapter one of it", "21"])
    assert (0, 2, "digits") in pairs and len(pairs) == 3 and findings == []
    assert align.map_lines(["abc"], ["xyz"])[1] == [("left only", 0), ("right only", 0)] or align.map_lines(["abc"], ["xyz"])[1][0][0] == "weak"


@given(st.lists(st.text("ab ", max_size=4), min_size=1, max_size=5), st.text("abc ", max_size=14))
def test_characters_are_all_dealt_out(clusters, final):
    out = align.spread_characters(clusters, final)
    assert len(out) == len(clusters) and sorted("".join(out)) == sorted(final if "".join(clusters) or final else "")


def test_line_diff_with_a_page_missing(spark):
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "only left")], "p int, no int, text string")
    b = spark.createDataFrame([(1, 1, "x"), (1, 2, "z"), (1, 3, "w"), (3, 1, "only right")], "p int, no int, text string")
    assert rows(align.line_diff(a, b, ["p"], "no", "text"), "p", "before", "after") == [(1, "", "w"), (1, "y", "z"), (2, "only left", ""), (3, "", "only right")]
    out = pipelines.report(a, b, ["p"], letters="a-z")
    assert dict(rows(out["pages"])) == {1: 2, 2: 1, 3: 1}


def test_resolver(spark):
    s = lambda *r: spark.createDataFrame(list(r), "gid int, chars string")
    assert rows(resolve.cascade([("name", s((1, ""), (2, "b"))), ("ref", s((1, "r"), (2, "x"), (3, None)))], ["gid"])) == [(1, "r", "ref"), (2, "b", "name")]
    assert rows(resolve.with_override(s((1, "a"), (2, "b")), s((2, "B"), (3, "C")), ["gid"])) == [(1, "a"), (2, "B"), (3, "C")]
    parts = spark.createDataFrame([(10, 0, 1), (10, 1, 2), (11, 0, 10), (11, 1, 1), (12, 0, 12), (13, 0, 99)], "gid int, ord int, component int")
    assert rows(resolve.composites(parts, s((1, "a"), (2, "b")))) == [(10, "ab"), (11, "aba")]
    chain = spark.createDataFrame([(k, 0, k - 1) for k in range(2, 10)], "gid int, ord int, component int")
    assert [g for g, _ in rows(resolve.composites(chain, s((1, "a"))))] == [2, 3, 4, 5, 6, 7]
    single = spark.createDataFrame([(5, 1), (6, 5)], "out int, inp int")
    ligature = spark.createDataFrame([(7, 0, 6), (7, 1, 2), (8, 0, 2), (8, 1, 77)], "out int, ord int, comp int")
    incremental.ensure_checkpoint(spark)
    assert rows(resolve.substitution_closure(s((1, "a"), (2, "b")), single, ligature)) == [(1, "a"), (2, "b"), (5, "a"), (6, "a"), (7, "ab")]
    names = spark.createDataFrame([(1, "lam_alef_init"), (2, "lam_what")], "gid int, name string")
    table = spark.createDataFrame([("lam", "ل"), ("alef", "ا")], "part string, chars string")
    assert rows(resolve.name_parts(names, table, "(?i)^(init|medi)$")) == [(1, "لا")]


def test_character_map(spark):
    from pagefold.plans.table_queries import _CIDS, CMAP

    df = spark.createDataFrame([("f", CMAP)], "font string, body string")
    assert rows(readers.character_map(df, ["font"], "body"), "cid", "text") == sorted(_CIDS, key=repr)


def test_content_stream():
    lexed = list(codecs.lex(rb"/F1 12 Tf (a\(b\)\051\101\q(x)) Tj <4 1zz> [<41> -5.5(c)]TJ % c" + b"\n<</A 1>>"))
    assert lexed[:4] == [("name", "F1"), ("num", 12.0), ("op", "Tf"), ("str", b"a(b))Aq(x)")]
    assert ("hexstr", b"") in lexed and ("num", -5.5) in lexed and lexed[-4:] == [("dict_begin", None), ("name", "A"), ("num", 1.0), ("dict_end", None)]
    drawn = list(codecs.glyphs(b"q 2 0 0 2 10 20 cm BT /F 10 Tf 1 0 0 1 5 5 Tm (ab) Tj ET Q BT /F 10 Tf (c) Tj /G 1 Tf (d) Tj ET", {"F": {}}))
    assert [(g[1], g[2], g[3]) for g in drawn] == [(97, 20.0, 30.0), (98, 30.0, 30.0), (99, 0.0, 0.0)]


def test_readers(spark):
    lines = ["5\t1\t1\t1\t1\t1\t10\t20\t30\t5\t91.5\tab", "5\t1\t1\t1\t1\t2\t50\t18\t10\t9\t80\tcd", "4\t1\t1\t1\t1\t0\t0\t0\t0\t0\t-1\t", "5\t1\t1\t1\t2\t1\t0\t2\t5\t5\tx\ty", "5\t1\t1", "5\t1\t1\t1\t3\t1\t0\t2\t5\t5\t7\t  "]
    words = readers.ocr_words(spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "no int, line string"))
    out = readers.ocr_lines(words).collect()
    assert len(out) == 1 and out[0]["bbox"] == [10, 18, 60, 27] and [w["text"] for w in out[0]["words"]] == ["ab", "cd"]
    text = ["lost", "===== PAGE 1 =====", "old", "===== PAGE 2 =====", "", "two  ", "===== PAGE 1 =====", "new"]
    pages = readers.page_lines(spark.createDataFrame([("f", i, x) for i, x in enumerate(text)], "file string, no int, line string"), "no", "line", ("file",))
    assert rows(pages, "page", "line_no", "text") == [(1, 1, "new"), (2, 1, "two")]
    spec = spark.createDataFrame([("1-3,7, 2,99",)], "s string")
    assert spec.select(readers.page_range(F.col("s"), F.lit(10))).first()[0] == [0, 1, 2, 6, 1]
    odd = spark.createDataFrame([("5-3", 10), ("", 3), (None, 2), ("2-2,5-3,1", 9), ("", 0)], "s string, n int")
    assert [r[0] for r in odd.select(readers.page_range(F.col("s"), F.col("n"))).collect()] == [[], [0, 1, 2], [0, 1], [1, 0], []]
    assert rows(readers.page_subset(odd, [9], "n"), "s") == [("2-2,5-3,1",)] and readers.page_subset(odd, None).count() == 5
    freq = spark.createDataFrame([("ab cd 25",), ("word 30",), ("word 5",), ("bad",), ("x 99",)], "line string")
    assert rows(readers.frequency_list(freq, "line", key=lambda c: F.replace(c, F.lit(" "), F.lit("")))) == [("abcd", 25), ("word", 30)]
    nested = spark.createDataFrame([('[{"id":1,"name":"n","verses":[{"id":1,"text":"a"},{"id":2,"text":"b"}]}]',)], "j string")
    assert rows(readers.verse_corpus(nested, "j")) == [(1, "n", 1, "a"), (1, "n", 2, "b")]


def test_reading_order(spark):
    """Two lines, a mark on its letter, a space, and a number inside right-to-left text."""
    g = []

    def put(text, x, y, mark=False):
        g.append((1, len(g), text, float(x), float(y), mark, 5.0))

    for k, c in enumerate("ابت"):
        put(c, 100 - 6 * k, 700)
    put("َ", 94, 703, True)
    put(" ", 84, 701)
    for k, c in enumerate("120"):
        put(c, 60 + 6 * k, 702)
    put("ج", 50, 600)
    df = spark.createDataFrame(g, "page int, glyph_seq int, chars string, x double, y double, is_mark boolean, width double")
    assert rows(reading.assemble(df), "line_no", "text") == [(1, "ابَت 120"), (2, "ج")]
    assert rows(reading.layout_lines(df), "line_no", "segment", "text")[-1] == (2, 1, "ج")


def test_partitions_do_not_change_results(spark):
    e = [(u, i, float((i * 37) % 100), float((i * 37) % 100 + 9)) for u in range(3) for i in range(40)]
    df = spark.createDataFrame(e, "u int, i int, a double, b double")
    outcomes = []
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        d = df.repartition(n)
        outcomes.append((rows(bands.gap_segments(d, ["u"], "a", "b", ["a", "i"], 1.0)), rows(bands.anchored_bands(d, ["u"], "a", 3.0)), rows(spatial.merge_passes(*(d.filter(f"i % 2 = {k}").selectExpr("u", "i", "a x0", "b x1", "0D y0", "'w' text", "cast(i as double) conf") for k in (0, 1)), ["u"], ["i"], (12.0, 12.0, 14.0)))))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert outcomes[0] == outcomes[1]


def test_geometry(spark):
    df = spark.createDataFrame([(100.0, 400.0, 500.0, 12.0)], "x0 double, x1 double, y double, s double")
    box = df.select(geo.text_box(*[F.col(c) for c in df.columns]).alias("b")).first()["b"]
    assert box["align"] == "right" and abs(box["x"] + box["w"] - 401.2) < 1e-9
    ident = F.array(*[F.lit(float(v)) for v in (2, 0, 0, 2, 10, 20)])
    assert df.select(geo.translate(ident, F.lit(5.0), F.lit(5.0)).alias("m")).first()["m"] == [2.0, 0.0, 0.0, 2.0, 20.0, 30.0]
    assert df.select(geo.emu(F.col("s")), geo.colour(F.lit(255)), geo.symbol_code(F.lit("√")), geo.symbol_code(F.lit("A")), geo.symbol_code(F.lit("ع"))).first() == (152400, "#0000FF", "F0D6", "F041", None)


def test_sinks(spark, tmp_path):
    lines = spark.createDataFrame([(1, 2, "b", 30.0), (1, 1, "a", 90.0), (2, 1, " ", 90.0)], "page int, line_no int, text string, conf double")
    assert rows(sinks.rendered(lines, spark.createDataFrame([(1, 7)], "page int, printed int"))) == [(1, "===== 1 =====\na\nb   ⟨؟⟩\n[٧]"), (2, "===== 2 =====")]
    sinks.write_text(sinks.page_texts(lines), f"{tmp_path}/t")
    assert sorted(r[0] for r in spark.read.text(f"{tmp_path}/t").collect()) == [" ", "===== PAGE 1 =====", "===== PAGE 2 =====", "a", "b"]
    tree = sinks.nested(lines, [(["page"], "line_no", "lines")])
    assert [[x["text"] for x in r["lines"]] for r in tree.orderBy("page").collect()] == [["a", "b"], [" "]]
    log = sinks.change_log([spark.createDataFrame([(1, "x")], "page int, before string")])
    assert log.columns == ["page", "line_no", "kind", "ref", "before", "after", "score"]


def test_stream_takes_each_file_once(spark, tmp_path):
    land, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    for k in (1, 2):
        spark.createDataFrame([(k, "x" * k)], "page int, text string").write.mode("append").json(land)
        incremental.follow(spark, land, "page int, text string", out, ck, lambda df: df.withColumn("n", F.length("text")))
        assert rows(spark.read.parquet(out), "page", "n") == [(i, i) for i in range(1, k + 1)]


def test_docx_runs(spark, tmp_path):
    import io
    import zipfile

    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    body = f'<w:document {w}><w:body><w:p><w:r><w:rPr><w:sz w:val="24"/></w:rPr><w:t>one</w:t></w:r></w:p><w:p><w:pPr><w:pageBreakBefore/></w:pPr><w:r><w:t>two</w:t></w:r></w:p></w:body></w:document>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", body)
    files = spark.createDataFrame([("f", bytearray(buffer.getvalue()))], "path string, content binary")
    assert rows(codecs.read_documents(files), "page", "text", "size") == [(1, "one", 12.0), (2, "two", None)]


@pytest.mark.parametrize("a,b", [("kitten", "sitting"), ("", "abc"), ("same", "same")])
def test_ratio_is_the_librarys(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(corpus.similarity(F.col("a"), F.col("b"))).first()[0] == difflib.SequenceMatcher(None, a, b).ratio()


def test_all_candidates_meet_the_edit_distance(spark, monkeypatch):
    """Thirty words share more n-grams with the asked word than the one at distance 1."""
    from pagefold.plans import text_queries

    near, far = "zbcdefgh", [f"abcdefghij{a}{b}" for a in "klm" for b in "nopqrstuvw"]
    monkeypatch.setattr(text_queries, "_asked", lambda *_: spark.createDataFrame([("abcdefgh",)], "word string"))
    monkeypatch.setattr(text_queries, "_small_lexicon", lambda *_: spark.createDataFrame([(w, 1) for w in [near, *far]], "word string, freq bigint"))
    assert rows(text_queries.bounded_edit(spark, "")) == [("abcdefgh", near, 1)]
    assert rows(text_queries.gram_candidates(spark, ""), "word", "n") == [("abcdefgh", 31)]


def test_pools_in_blocks_are_the_same(spark, monkeypatch):
    """One index, blocks of a larger lexicon, and a join on n-grams by the definition."""
    rnd = random.Random(3)
    made = lambda n: sorted({"".join(rnd.choices("abcd", k=rnd.randint(1, 9))) for _ in range(n)})
    asked, lex = made(60), made(300)
    words, listed = (spark.createDataFrame([(w,) for w in x], "word string") for x in (asked, lex))
    want = {}
    for w in asked:
        shared = sorted((-len(lexicon.gram_set(w) & lexicon.gram_set(x)), x) for x in lex if lexicon.gram_set(w) & lexicon.gram_set(x))
        want[w] = [(x, -n) for n, x in shared]
    joined = lexicon.gram_index(words).join(lexicon.gram_index(listed.select(F.col("word").alias("candidate")), "candidate"), "gram").groupBy("word", "candidate").count()
    assert rows(joined) == sorted([(w, x, n) for w, found in want.items() for x, n in found], key=repr)
    for pool in (None, 7):
        got = {r["word"]: [tuple(p) for p in r["pool"]] for r in lexicon.pools(words, listed, pool).collect()}
        assert got == {w: found[:pool] for w, found in want.items() if found}
        near = rows(lexicon.candidates(words, listed, pool, within=2))
        with monkeypatch.context() as m:
            m.setattr(lexicon, "INDEX_WORDS", 70)
            m.setattr(lexicon, "ASKED_BLOCK", 25)
            assert {r["word"]: [tuple(p) for p in r["pool"]] for r in lexicon.pools(words, listed, pool).collect()} == got
            assert rows(lexicon.candidates(words, listed, pool, within=2)) == near
        close = lambda df: rows(df.withColumn("d", F.levenshtein("word", "candidate")).filter("d <= 2"), "word", "candidate")
        assert close(lexicon.candidates(words, listed, pool, within=2)) == close(lexicon.candidates(words, listed, pool))


def test_ratio_score_ranks_all_candidates(spark, monkeypatch):
    """A long text that holds the item, and one with a single token in common, against a score of every pair."""
    from pagefold.plans import text_queries

    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(3, 6))) for _ in range(60)]
    items = [(i, " ".join(rnd.sample(words, 4))) for i in range(6)] + [(6, "unseen hapax")]
    docs = [(i, " ".join(rnd.choices(words, k=rnd.choice([3, 5, 8, 30])))) for i in range(60)]
    docs += [(100 + i, " ".join([*rnd.choices(words, k=90), t, *rnd.choices(words, k=90)])) for i, t in items] + [(200, "hapax")]
    frame = lambda r, k, t: spark.createDataFrame(r, f"{k} bigint, {t} string")
    monkeypatch.setattr(text_queries, "_bench", lambda *_: frame(items, "item_id", "q"))
    monkeypatch.setattr(text_queries, "_plain_docs", lambda *_: frame(docs, "doc_id", "t"))
    monkeypatch.setattr(text_queries, "_index", lambda *_: corpus.inverted_index(frame(docs, "doc_id", "t"), ["doc_id"], "t"))
    want = []
    for i, q in items:
        scores = []
        for d, t in docs:
            x, y = set(q.split()), set(t.split())
            if not x & y:
                continue
            s = 0.6 * difflib.SequenceMatcher(None, q, t).ratio() + 0.4 * len(x & y) / len(x | y)
            s = max(s, 0.92) if q in t or t in q else s
            cover = len(x & y) / len(x)
            scores.append((-max(s, 0.75 + 0.2 * cover) if cover >= 0.8 and len(x) >= 3 else -s, d))
        want += [(i, d, round(-s, 6)) for s, d in sorted(scores)[:6]]
    assert rows(text_queries.ratio_score(spark, "")) == sorted(want, key=repr)
    assert sum(d == 100 + i for i, d, _ in want) >= 4  # long texts with low Jaccard are among the first
