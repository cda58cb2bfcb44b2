"""Steps whose work must grow no faster than their input."""

from pyspark.sql import functions as F

from pagefold.operators import align, corpus, spatial
from pagefold.sources import readers


def test_nearest_join_makes_no_pairs(spark):
    """Half the rows of one neighbourhood against the other half: 400 million pairs."""
    rows = spark.range(40_000).select(F.lit(1).alias("p"), "id", (F.col("id") * 7919 % 40_000 / 2000.0).alias("y"))
    left = rows.filter("id % 2 = 0").select("p", F.col("id").alias("a"), F.col("y").alias("x"))
    right = rows.filter("id % 2 = 1").select("p", F.col("id").alias("b"), "y")
    out = spatial.nearest_join(left, right, ["p"], "x", "y", 40.0, ["a"], ["b"])
    assert out.columns == ["p", "a", "x", "b", "y", "distance"]
    got = {r["a"]: (r["b"], r["distance"]) for r in out.collect()}
    at = {i * 7919 % 40_000: i for i in range(40_000)}
    for a in range(0, 40_000, 998):
        k = a * 7919 % 40_000
        near = min((abs(k / 2000.0 - j / 2000.0), at[j]) for j in range(max(0, k - 5), min(40_000, k + 6)) if at[j] % 2)
        assert got[a] == (near[1], near[0])


def test_nearest_join_ties_and_nulls(spark):
    left = spark.createDataFrame([(1, 1, 5.0), (1, 2, None), (1, 3, 90.0), (2, 4, 5.0)], "p int, a int, x double")
    right = spark.createDataFrame([(1, 9, 3.0), (1, 8, 7.0), (1, 7, 7.0), (1, 6, None), (1, 5, 50.0), (1, 4, 130.0)], "p int, b int, y double")
    got = sorted(map(tuple, spatial.nearest_join(left, right, ["p"], "x", "y", 40.0, ["a"], ["b"]).collect()))
    assert got == [(1, 1, 5.0, 7, 7.0, 2.0), (1, 3, 90.0, 4, 130.0, 40.0)]


def test_largest_overlap_of_boxes_in_one_place(spark):
    """800 million pairs of two distinct boxes."""
    box = lambda n: [F.lit(float(v)).alias(c) for c, v in zip(n, (0, 0, 120, 80))]
    a, b = ["x0", "y0", "x1", "y1"], ["u0", "v0", "u1", "v1"]
    left = spark.range(40_000).select(F.lit(1).alias("p"), F.col("id").alias("a"), *box(a))
    right = spark.range(20_000).select(F.lit(1).alias("p"), F.col("id").alias("b"), *box(b))
    rows = spatial.largest_overlap(left, right, ["p"], (a, b), ["p", "a"], "b").select("b", "area").distinct().collect()
    assert [tuple(r) for r in rows] == [(0, 9600.0)]


def test_lines_without_words_gather_none(spark):
    row = "\t".join(["5", "1", "1", "1", "3", "1", "10", "20", "30", "12", "90", "w"])
    lines = spark.range(50).select(F.col("id").alias("no"), F.lit(row).alias("line"))
    out = readers.ocr_lines(readers.ocr_words(lines))
    assert [(len(r["words"]), r["n_words"]) for r in out.collect()] == [(50, 50)]
    assert "collect_list" not in out.select("ln", "n_words", "bbox")._jdf.queryExecution().optimizedPlan().toString()


def test_span_search_moves_no_lines(spark):
    """A line of 20,000 tokens was copied to each of them."""
    lines = spark.createDataFrame([(1, " ".join(["the"] * 20_000 + ["alpha", "bravos", "charlie", "delta"]))], "id int, t string")
    verses = spark.createDataFrame([(7, "bravos charlie delta")], "v int, q string")
    anchors = corpus.unique_anchors(corpus.inverted_index(verses, ["v"], "q"), ["v"])
    out = corpus.find_spans(lines, ["id"], "t", verses, anchors, ["v"], "q")
    assert [tuple(r) for r in out.collect()] == [(1, 7, 20_001, 20_003, 1.0)]
    assert "posexplode" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_alignment_compares_few_lines(monkeypatch):
    """All pairs of two versions of a page were compared: 12,000."""
    lines = [f"{k * 7919 % 1000:03d} " + chr(97 + k % 26) * 20 + chr(97 + k // 26) * 9 for k in range(120)]
    calls, likeness = [], align.likeness
    monkeypatch.setattr(align, "likeness", lambda a, b: calls.append(1) or likeness(a, b))
    pairs, left, right = align.align(lines, [x + "." for k, x in enumerate(lines) if k % 6])
    assert pairs == [(k, n) for n, k in enumerate(k for k in range(120) if k % 6)] and left == list(range(0, 120, 6)) and not right
    assert len(calls) < 1000


def test_empty_lines_align():
    assert align.align(["", "a", ""], ["", ""]) == ([(0, 0), (2, 1)], [1], [])
