"""Alignment of lines and characters, page by page: a dynamic programme needs the whole page, and a page is bounded.

Pages are dealt out by key; each is aligned on its own in Arrow groups.
"""

from __future__ import annotations

import difflib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql.group import GroupedData
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagefold.functions import charsets as cs
from pagefold.functions import matching
from pagefold.functions import text as tx
from pagefold.operators import quality
from pagefold.operators.corpus import ratio

GAP = -0.3


def pair_score(r: float) -> float:
    return 2 * r - 0.6


def likeness(a: str, b: str) -> float:
    return 1.0 if a == b else 0.0 if not a or not b else ratio(a, b)


def most_alike(left: list[str], right: list[str]) -> np.ndarray:
    """What the likeness of each two lines can't exceed: twice the signs that both have, by their length together."""
    signs = {c: k for k, c in enumerate(sorted(set("".join(right))))}
    count = np.zeros((len(left), len(signs)), np.int32), np.zeros((len(right), len(signs)), np.int32)
    for side, lines in zip(count, (left, right)):
        for k, line in enumerate(lines):
            for c in set(line):
                if c in signs:
                    side[k, signs[c]] = line.count(c)
    common = np.zeros((len(left), len(right)), np.int64)
    for k in range(len(signs)):
        common += np.minimum(count[0][:, k, None], count[1][None, :, k])
    sizes = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :]
    return np.where(sizes == 0, 1.0, 2.0 * common / np.maximum(sizes, 1))  # empty lines are alike


def best_ways(score: np.ndarray, gap: float) -> np.ndarray:
    """Best sum to each place of the grid, by diagonals: each depends on the two before."""
    n, m = score.shape
    best = np.zeros((n + 1, m + 1))
    best[:, 0], best[0, :] = gap * np.arange(n + 1), gap * np.arange(m + 1)
    for d in range(2, n + m + 1):
        i = np.arange(max(1, d - m), min(n, d - 1) + 1)
        j = d - i
        best[i, j] = np.maximum(np.maximum(best[i - 1, j - 1] + score[i - 1, j - 1], best[i - 1, j] + gap), best[i, j - 1] + gap)
    return best


def align(left: list[str], right: list[str], gap: float = GAP) -> tuple[list[tuple[int, int]], list[int], list[int]]:
    """Best order-preserving pairs of two lists of keys, and what is left of each. Ties prefer a pair, then the left.

    Lines are compared only where a best way may lead: bounds on their likeness show which pairs are on none, and those
    stay out. Each round compares the pairs of the best way by bounds; its exact sum is one that the best way has at least.
    """
    n, m = len(left), len(right)
    memo: dict[tuple[str, str], float] = {}

    def told(i: int, j: int) -> float:
        if (left[i], right[j]) not in memo:
            memo[left[i], right[j]] = pair_score(likeness(left[i], right[j]))
        return memo[left[i], right[j]]

    score = pair_score(most_alike(left, right)) if n and m else np.zeros((n, m))
    known = np.zeros((n, m), bool)
    rounds = 0
    while n and m:
        best, rest = best_ways(score, gap), best_ways(score[::-1, ::-1], gap)[::-1, ::-1]
        i, j, way, total = n, m, [], 0.0
        while i and j:
            if best[i, j] == best[i - 1, j - 1] + score[i - 1, j - 1]:
                i, j = i - 1, j - 1
                way.append((i, j))
                total += told(i, j)
            elif best[i, j] == best[i - 1, j] + gap:
                i, total = i - 1, total + gap
            else:
                j, total = j - 1, total + gap
        total += gap * (i + j)
        score[best[:-1, :-1] + score + rest[1:, 1:] < total - 1e-6] = -np.inf
        open_ = np.argwhere(~known & np.isfinite(score))
        rounds += 1
        if len(open_) > 4 * (n + m) and rounds < 8 and not all(known[p] for p in way):
            open_ = way
        for i, j in open_:
            score[i, j], known[i, j] = told(i, j), True
        if open_ is not way:
            break
    best = best_ways(score, gap)
    pairs, i, j = [], n, m
    while i and j:
        if best[i, j] == best[i - 1, j - 1] + score[i - 1, j - 1]:
            i, j = i - 1, j - 1
            pairs.append((i, j))
        elif best[i, j] == best[i - 1, j] + gap:
            i -= 1
        else:
            j -= 1
    pairs.reverse()
    used = {i for i, _ in pairs}, {j for _, j in pairs}
    return pairs, [i for i in range(n) if i not in used[0]], [j for j in range(m) if j not in used[1]]


def map_lines(left: list[str], right: list[str], weak: float = 0.45, second: float = 0.55, digits: bool = True) -> tuple[list[tuple[int, int, str]], list[tuple[str, int]]]:
    """Pairs (left, right, how) of a page's lines, and findings (kind, line).

    Lines of digits alone pair by their digits, in order; the rest is aligned; what is left over pairs greedily,
    best first, from `second` on, in any order. Pairs below `weak` are findings, as is what stays alone.
    """
    pairs: list[tuple[int, int, str]] = []
    if digits:
        at = defaultdict(list)
        for j, b in enumerate(right):
            if b and b.isdigit():
                at["".join(sorted(b))].append(j)
        for i, a in enumerate(left):
            if a and a.isdigit() and at["".join(sorted(a))]:
                pairs.append((i, at["".join(sorted(a))].pop(0), "digits"))
    used = {i for i, _, _ in pairs}, {j for _, j, _ in pairs}
    rest = [i for i in range(len(left)) if i not in used[0]], [j for j in range(len(right)) if j not in used[1]]
    matched, alone, single = align([left[i] for i in rest[0]], [right[j] for j in rest[1]])
    findings: list[tuple[str, int]] = []
    for i, j in matched:
        i, j = rest[0][i], rest[1][j]
        pairs.append((i, j, "aligned"))
        if likeness(left[i], right[j]) < weak:
            findings.append(("weak", i))
    alone, single = [rest[0][i] for i in alone], [rest[1][j] for j in single]
    # only what may be alike enough is compared
    near = np.argwhere(most_alike([left[i] for i in alone], [right[j] for j in single]) >= second - 1e-9) if alone and single else ()
    options = sorted(((likeness(left[alone[x]], right[single[y]]), -alone[x], -single[y]) for x, y in near), reverse=True)
    free = set(alone), set(single)
    for r, i, j in options:
        if r >= second and -i in free[0] and -j in free[1]:
            free[0].remove(-i)
            free[1].remove(-j)
            pairs.append((-i, -j, "second"))
    findings += [("left only", i) for i in alone if i in free[0]] + [("right only", j) for j in single if j in free[1]]
    return sorted(pairs), findings


def in_order(frame: pd.DataFrame, order: str, text: str) -> tuple[list, list[str]]:
    """Ordinals and texts of a side of a page; a page that one side lacks has none."""
    if not len(frame):
        return [], []
    frame = frame.sort_values(order)
    return frame[order].tolist(), frame[text].fillna("").tolist()


def pages_of(lines: DataFrame, by: list[str], order: str, text: str) -> GroupedData:
    """Lines by page, under columns of their own: two versions may come from one table."""
    return lines.select(*[F.col(c).alias(c) for c in (*by, order, text)]).groupBy(*by)


def align_pages(left: DataFrame, right: DataFrame, by: list[str], order: str, text: str, full: bool = False) -> DataFrame:
    """by, left_no, right_no, how: a full outer pairing of the lines of two versions of each page.

    how: aligned, weak (aligned, but hardly alike), digits, second (a second chance, in any order), left or right (alone).
    """
    schema = left.select(*by).schema.simpleString()[7:-1] + ", left_no bigint, right_no bigint, how string"

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        (no_a, x), (no_b, y) = in_order(a, order, text), in_order(b, order, text)
        if full:
            pairs, findings = map_lines(x, y)
            weak = {i for kind, i in findings if kind == "weak"}
            rows = [(i, j, "weak" if i in weak and how == "aligned" else how) for i, j, how in pairs] + [(i, None, "left") if kind == "left only" else (None, i, "right") for kind, i in findings if kind != "weak"]
        else:
            matched, one, two = align(x, y)
            rows = [(i, j, "aligned") for i, j in matched] + [(i, None, "left") for i in one] + [(None, j, "right") for j in two]
        head = (a if len(a) else b)[by].iloc[0].tolist()
        out = [(*head, None if i is None else no_a[i], None if j is None else no_b[j], how) for i, j, how in rows]
        return pd.DataFrame(out, columns=[*by, "left_no", "right_no", "how"]).astype({"left_no": "Int64", "right_no": "Int64"})

    return pages_of(left, by, order, text).cogroup(pages_of(right, by, order, text)).applyInPandas(run, schema)


def line_diff(left: DataFrame, right: DataFrame, by: list[str], order: str, text: str) -> DataFrame:
    """by, block, k, before, after of the lines that two versions differ in; the shorter side of a block is filled with ''."""
    schema = left.select(*by).schema.simpleString()[7:-1] + ", block bigint, k bigint, before string, after string"

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, y = (in_order(f, order, text)[1] for f in (a, b))
        head, rows = (a if len(a) else b)[by].iloc[0].tolist(), []
        for block, (tag, a0, a1, b0, b1) in enumerate(difflib.SequenceMatcher(None, x, y, autojunk=False).get_opcodes()):
            if tag != "equal":
                for k in range(max(a1 - a0, b1 - b0)):
                    before, after = x[a0 + k] if a0 + k < a1 else "", y[b0 + k] if b0 + k < b1 else ""
                    if before != after:
                        rows.append((*head, block, k, before, after))
        return pd.DataFrame(rows, columns=[*by, "block", "k", "before", "after"])

    return pages_of(left, by, order, text).cogroup(pages_of(right, by, order, text)).applyInPandas(run, schema)


def spread_characters(clusters: list[str], final: str) -> list[str]:
    """The final text of a line, dealt out to the clusters that its characters come from.

    Characters alike stay with their cluster; replaced ones go to the first cluster replaced (else the one before,
    else the first); inserted ones to the cluster before (else the next); deleted ones go."""
    source = "".join(clusters)
    owner = [k for k, c in enumerate(clusters) for _ in c]
    out = [""] * len(clusters)
    if not out:
        return out
    for tag, a0, a1, b0, b1 in matching.opcodes(source, final):
        if tag == "equal":
            for k in range(a1 - a0):
                out[owner[a0 + k]] += final[b0 + k]
        elif tag != "delete":
            k = owner[a0] if tag == "replace" else owner[a0 - 1] if a0 else owner[0] if owner else 0
            out[k] += final[b0:b1]
    return out


def spread_line(segments: list[list[str]], final: str) -> list[list[str]]:
    """The final text of a line, dealt out to the clusters of its segments. A segment that would be left blank keeps its text."""
    flat = spread_characters([c for s in segments for c in s], final)
    out, at = [], 0
    for s in segments:
        part = flat[at : at + len(s)]
        at += len(s)
        out.append(part if "".join(part).strip() else list(s))
    return out


def transfer_segments(segments: Column, final: Column) -> Column:
    """Array of the segments' clusters' final texts (arrays of arrays); those of a line without a final text stay."""

    @F.pandas_udf("array<array<string>>")
    def run(c: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else [list(s) for s in x] if y is None else spread_line([list(s) for s in x], y) for x, y in zip(c, t)])

    return run(segments, final)


def segment_text(clusters: Column) -> Column:
    """Text of a segment's clusters (text, sp: whether a space stands before it, where none is yet)."""
    add = lambda acc, c: F.concat(acc, F.when(c["sp"] & (acc != "") & ~F.endswith(acc, F.lit(" ")), F.lit(" ")).otherwise(F.lit("")), c["text"])
    return F.aggregate(clusters, F.lit(""), add)


def line_text(segments: Column) -> Column:
    """Text of a line from its segments' texts: blank ones left out, no space before closing punctuation."""
    parts = F.filter(segments, lambda s: tx.strip(s) != "")
    return tx.strip(tx.tidy_punctuation(F.array_join(parts, " ")))


def transfer_text(clusters: Column, final: Column) -> Column:
    """Array of the clusters' final texts."""

    @F.pandas_udf("array<string>")
    def run(c: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series([spread_characters(list(x), y) for x, y in zip(c, t)])

    return run(clusters, final)


def pair_by_digits(left: DataFrame, right: DataFrame, by: list[str], signature: str, order: str) -> DataFrame:
    """Rows of two sides with the same digits, paired in order, each once: by, signature, left and right order."""
    w = Window.partitionBy(*by, signature).orderBy(order)
    side = lambda df, name: df.filter(F.col(signature) != "").select(*by, signature, F.col(order).alias(name), F.row_number().over(w).alias("__n"))
    return side(left, "left_no").join(side(right, "right_no"), [*by, signature, "__n"]).drop("__n")


def zip_by_place(left: DataFrame, right: DataFrame, by: list[str], left_text: str, right_text: str) -> DataFrame:
    """Full outer pairing of two sides by place: by and place, '' where a side is shorter; equal pairs are left out."""
    both = left.select(*by, F.col(left_text).alias("before")).join(right.select(*by, F.col(right_text).alias("after")), by, "full")
    return both.select(*by, F.coalesce("before", F.lit("")).alias("before"), F.coalesce("after", F.lit("")).alias("after")).filter("before <> after")


def absorb_markers(lines: DataFrame, by: list[str], order: str, y: str, is_marker: Column, lowest: float = 735.0, farthest: float = 40.0) -> DataFrame:
    """Marker lines with the nearest other line of their page (host; ties to the first), within `farthest` and above `lowest`."""
    marked = lines.withColumn("__m", is_marker)
    markers = marked.filter(F.col("__m") & (F.col(y) <= lowest)).select(*by, F.col(order).alias("marker"), F.col(y).alias("__my"))
    hosts = marked.filter(~F.col("__m")).select(*by, F.col(order).alias("host"), F.col(y).alias("__hy"))
    from pagefold.operators.spatial import nearest_join

    return nearest_join(markers, hosts, by, "__my", "__hy", farthest, [*by, "marker"], ["host"]).select(*by, "marker", "host", "distance")


def with_absorbed(lines: DataFrame, by: list[str], order: str, segments: str, absorbed: DataFrame) -> DataFrame:
    """The lines, marker lines taken into their hosts: their segments stand behind the host's, in order of the markers.

    absorbed: by, marker, host (as absorb_markers gives them). segments: an array column.
    """
    taken = lines.select(*by, F.col(order).alias("marker"), F.col(segments).alias("__s")).join(absorbed.select(*by, "marker", "host"), [*by, "marker"])
    more = taken.groupBy(*by, F.col("host").alias(order)).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("marker", "__s"))), lambda s: s["__s"])).alias("__more"))
    kept = lines.join(absorbed.select(*by, F.col("marker").alias(order)), [*by, order], "left_anti").join(more, [*by, order], "left")
    return kept.withColumn(segments, F.when(F.col("__more").isNull(), F.col(segments)).otherwise(F.concat(segments, "__more"))).drop("__more")


def uncovered(right: DataFrame, left: DataFrame, by: list[str], text: str, key: str) -> DataFrame:
    """Lines of the right that the left's lines of the same page don't hold: key in a line's key, or for marker lines all digits in
    the page's text. Scraps of up to three signs count as held. Both sides: by, text, key (in comparable form)."""
    pages = left.groupBy(*by).agg(F.collect_set(key).alias("__keys"), F.array_join(F.collect_list(text), "").alias("__page"))
    scrap = ~F.col(text).rlike(cs.WORD_SIGN) & (F.length(tx.strip(F.col(text))) <= 3)
    held = F.exists("__keys", lambda k: F.contains(k, F.col(key))) & (F.col(key) != "")
    digits = F.forall(F.split(F.regexp_replace(text, r"[^\p{Nd}]", ""), ""), lambda c: F.contains(F.col("__page"), c))
    marker = quality.is_marker_line(F.col(text)) & digits
    joined = right.join(pages, by, "left")
    return joined.filter(~(scrap | F.coalesce(held, F.lit(False)) | F.coalesce(marker, F.lit(False)))).select(*right.columns)


def mapping_report(pairs: DataFrame, left: DataFrame, right: DataFrame, page: str = "page", order: str = "no", text: str = "text", key: str = "key") -> DataFrame:
    """page, kind, left, right of what a reader of a mapping should see: weak pairs, lines of the left alone that hold more than markers,
    and lines of the right alone that the left doesn't hold. In order of page, kind and line."""
    l, r = (df.select(page, F.col(order).cast("bigint").alias(f"{n}_no"), F.col(text).alias(n), F.col(key).alias(f"{n}_key")) for n, df in (("left", left), ("right", right)))
    told = pairs.join(l, [page, "left_no"], "left").join(r, [page, "right_no"], "left")
    weak = told.filter("how = 'weak'").withColumn("kind", F.lit("weak match"))
    alone = told.filter((F.col("how") == "left") & (F.col("left_key") != "") & ~quality.is_marker_line(F.col("left"))).withColumn("kind", F.lit("kept as it was"))
    lost = uncovered(told.filter("how = 'right'").select(page, "left_no", "right_no", "left", F.col("right").alias(text), F.col("right_key").alias(key)), left, [page], text, key)
    lost = lost.select(page, "left_no", "right_no", "left", F.col(text).alias("right"), F.lit("not mapped").alias("kind"))
    out = weak.unionByName(alone, allowMissingColumns=True).select(page, "kind", "left_no", "right_no", "left", "right").unionByName(lost.select(page, "kind", "left_no", "right_no", "left", "right"))
    return out.orderBy(page, "kind", F.coalesce("left_no", "right_no"))
