"""Queries over text: normalisation, lines, noise, classification of changes, indexes, words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pagefold.functions import charsets as cs
from pagefold.functions import text as tx
from pagefold.operators import corpus, lexicon, quality
from pagefold.plans import pipelines
from pagefold.plans.base import DUCK_LINES, DUCK_PLAIN, FOLD, LATIN, SPACE, doc_lines, plain, read


def weighted_conf(spark: SparkSession, d: str) -> DataFrame:
    joined = read(spark, d, "documents").join(read(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return joined.groupBy("source").agg(F.round(quality.weighted_mean(F.coalesce("quality", F.lit(0)), F.col("n_chars")), 6).alias("conf"))


WEIGHTED_CONF = "select source, round(sum(coalesce(quality, 0) * n_chars) / greatest(sum(n_chars), 1), 6) as conf from documents d left join labels l on d.doc_id = l.doc_id group by source"


def weighted_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines that are no noise, with words and their document's quality as confidence."""
    lines = doc_lines(spark, d).filter(~quality.is_noise(F.col("line"), LATIN, cs.DIACRITICS_BOOK))
    words = F.size(F.filter(F.split(tx.strip(F.col("line")), r"(?U)\s+"), lambda w: w != ""))
    conf = read(spark, d, "labels").select("doc_id", (F.col("quality") * 60.0 + 35.0).alias("conf"))
    return lines.withColumn("n_words", words).join(conf, "doc_id", "left").select("doc_id", "line_no", "n_words", F.coalesce("conf", F.lit(50.0)).alias("conf"), F.length("line").alias("n_chars"))


_BARE = rf"regexp_replace(regexp_replace(line, '[{cs.DIACRITICS_BOOK}]', '', 'g'), '[^\p{{L}}\p{{N}}\p{{M}}_]', '', 'g')"
_NOISE = f"""(select doc_id, line_no, line, bare, t,
  len(regexp_replace(bare, '[^{LATIN}]', '', 'g')) as n, list_filter(string_split_regex(t, '{SPACE}+'), lambda w: len(w) > 0) as words
  from (select *, {_BARE} as bare, regexp_replace(regexp_replace(line, '^{SPACE}+', ''), '{SPACE}+$', '') as t from {DUCK_LINES}))"""
_IS_NOISE = rf"""case when t = '' then true when n = 0 then not regexp_full_match(bare, '\p{{Nd}}+')
  else (n / greatest(len(bare), 1) < 0.5 and n < 6) or (len(words) >= 4 and len(list_filter(words, lambda w: len(regexp_replace(w, '[{cs.DIACRITICS_BOOK}]', '', 'g')) <= 2)) / len(words) > 0.75) end"""
WEIGHTED_LINES = f"""select x.doc_id, line_no, cast(len(words) as integer) as n_words, coalesce(quality * 60.0 + 35.0, 50.0) as conf, cast(len(line) as integer) as n_chars
from {_NOISE} x left join labels l on x.doc_id = l.doc_id where not ({_IS_NOISE})"""


def page_lines(spark: SparkSession, d: str) -> DataFrame:
    return doc_lines(spark, d).select("doc_id", "line_no", F.length("line").alias("n_chars"), F.md5(F.col("line").cast("binary")).alias("line_md5"))


PAGE_LINES = f"select doc_id, line_no, cast(len(line) as integer) as n_chars, md5(line) as line_md5 from {DUCK_LINES}"


def noise_filter(spark: SparkSession, d: str) -> DataFrame:
    return doc_lines(spark, d).select("doc_id", "line_no", quality.is_noise(F.col("line"), LATIN, cs.DIACRITICS_BOOK).alias("noise"))


NOISE_FILTER = f"select doc_id, line_no, {_IS_NOISE} as noise from {_NOISE}"


def marker_lines(spark: SparkSession, d: str) -> DataFrame:
    """Marker lines, and the lines that stay when a last line of few digits is dropped."""
    lines = doc_lines(spark, d).withColumn("marker", quality.is_marker_line(F.col("line")))
    kept = quality.drop_last_line(lines, ["doc_id"], "line_no", F.col("line").rlike(r"^[\s()\d.\-]{1,6}$"))
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("marker").cast("bigint")).alias("n_markers"))


MARKER_LINES = rf"""select doc_id, count(*) as n_lines, cast(sum(case when t <> '' and len(t) <= 10 and regexp_full_match(t, '[\s()\d.٠-٩]*') and regexp_matches(t, '\p{{Nd}}') then 1 else 0 end) as bigint) as n_markers
from (select *, regexp_replace(regexp_replace(line, '^{SPACE}+', ''), '{SPACE}+$', '') as t, row_number() over (partition by doc_id order by line_no desc) = 1 as last from {DUCK_LINES})
where not (last and regexp_full_match(line, '[\s()\d.\-]{{1,6}}')) group by doc_id"""


def normalise_text(spark: SparkSession, d: str) -> DataFrame:
    composed = read(spark, d, "documents").select("doc_id", tx.nfc(F.coalesce("text", F.lit(""))).alias("t"))
    same = lambda c: c
    return composed.select("doc_id", F.md5(tx.normalise(F.col("t"), compose=same).cast("binary")).alias("normal_md5"), F.md5(tx.layout_key(F.col("t"), same).cast("binary")).alias("key_md5"), F.length(tx.skeleton(F.col("t"), same)).alias("n_skeleton"))


_COMMON = lambda t: f"translate(regexp_replace(regexp_replace({t}, '[{cs.OCR_PUNCTUATION}]', ' ', 'g'), '[{cs.DIACRITICS_NORMALISE}]', '', 'g'), '{cs.UNIFY[0]}', '{cs.UNIFY[1]}')"
_NORMAL = lambda t: f"trim(regexp_replace(translate({_COMMON(t)}, '{cs.ARABIC_DIGITS}', '0123456789'), '{SPACE}+', ' ', 'g'))"
_LAYOUT = cs.LAYOUT_PUNCTUATION.replace("'", "''").replace(r"\s", r"\s\p{Z}\x{85}\x0b")
NORMALISE_TEXT = f"""select doc_id, md5({_NORMAL('t')}) as normal_md5,
  md5(translate(regexp_replace(regexp_replace(t, '[{cs.DIACRITICS_LAYOUT}]', '', 'g'), '[{_LAYOUT}]+', '', 'g'), '{cs.UNIFY_LAYOUT[0]}', '{cs.UNIFY_LAYOUT[1]}')) as key_md5,
  cast(len(replace({_NORMAL(f"regexp_replace(t, '[{cs.DIACRITICS_PROOF}]', '', 'g')")}, ' ', '')) as integer) as n_skeleton
from (select doc_id, nfc_normalize(coalesce(text, '')) as t from documents)"""


def collapse_marks(spark: SparkSession, d: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    for letter in "elos":
        t = tx.collapse_repeats(t, letter)
    return read(spark, d, "documents").select("doc_id", F.length(t).alias("n_chars"), F.md5(t.cast("binary")).alias("text_md5"))


COLLAPSE_MARKS = "select doc_id, cast(len(t) as integer) as n_chars, md5(t) as text_md5 from (select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), 'e{2,}', 'e', 'g'), 'l{2,}', 'l', 'g'), 'o{2,}', 'o', 'g'), 's{2,}', 's', 'g') as t from documents)"


def tidy_punct(spark: SparkSession, d: str) -> DataFrame:
    t = tx.tidy_punctuation(F.regexp_replace(F.coalesce("text", F.lit("")), "([.,])", " $1"))
    return read(spark, d, "documents").select("doc_id", F.length(t).alias("n_chars"), F.md5(t.cast("binary")).alias("text_md5"))


TIDY_PUNCT = rf"select doc_id, cast(len(t) as integer) as n_chars, md5(t) as text_md5 from (select doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '([.,])', ' \1', 'g'), '{SPACE}+([.,،؛:؟!])', '\1', 'g') as t from documents)"


def digit_map(spark: SparkSession, d: str) -> DataFrame:
    page = (F.col("o_orderkey") % 7).cast("int")
    return read(spark, d, "orders").select("o_orderkey", tx.to_arabic_digits(F.col("o_orderkey")).alias("digits"), tx.to_ascii_digits(tx.to_arabic_digits(F.col("o_custkey"))).alias("back"), tx.printed_page(page).alias("printed"))


DIGIT_MAP = "select o_orderkey, translate(cast(o_orderkey as varchar), '0123456789', '٠١٢٣٤٥٦٧٨٩') as digits, cast(o_custkey as varchar) as back, case when cast(o_orderkey % 7 as integer) - 2 >= 1 then cast(o_orderkey % 7 as integer) - 2 end as printed from orders"


def _plain_docs(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", plain(F.coalesce("text", F.lit(""))).alias("t"))


def _index(spark: SparkSession, d: str) -> DataFrame:
    return corpus.inverted_index(_plain_docs(spark, d), ["doc_id"], "t")


_INDEX = f"(select distinct doc_id, unnest(string_split({DUCK_PLAIN.format('coalesce(text, chr(32))')}, ' ')) as token from documents)"


def token_explode(spark: SparkSession, d: str) -> DataFrame:
    return _index(spark, d).groupBy("token").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))


TOKEN_EXPLODE = f"select token, count(*) as n_docs, min(doc_id) as first_doc from {_INDEX} where len(token) >= 3 group by token"


def unique_anchors(spark: SparkSession, d: str) -> DataFrame:
    return corpus.unique_anchors(_index(spark, d), ["doc_id"])


UNIQUE_ANCHORS = f"select token, min(doc_id) as doc_id from {_INDEX} where len(token) >= 5 group by token having count(*) = 1"


def _bench(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "benchmark").select("item_id", plain(F.coalesce("text", F.lit(""))).alias("q"))


def index_probe(spark: SparkSession, d: str) -> DataFrame:
    return corpus.probe(_bench(spark, d), ["item_id"], "q", _index(spark, d), ["doc_id"], least_hits=3)


_QUERY = f"(select item_id, unnest(string_split({DUCK_PLAIN.format('coalesce(text, chr(32))')}, ' ')) as token from benchmark)"
INDEX_PROBE = f"select item_id, doc_id, count(*) as hits from {_QUERY} q join {_INDEX} i on q.token = i.token where len(q.token) >= 3 group by item_id, doc_id having count(*) >= 3"


def _likeness(spark: SparkSession, d: str, least_hits: int = 3) -> DataFrame:
    """Jaccard likeness and cover from sizes and shared counts: no text is moved to the pairs."""
    sizes = lambda df, key, t, n: df.select(key, F.size(F.array_distinct(F.filter(corpus.words_of(F.col(t)), lambda w: F.length(w) >= 3))).alias(n))
    q, docs = _bench(spark, d), _plain_docs(spark, d)
    shared = corpus.probe(q, ["item_id"], "q", _index(spark, d), ["doc_id"], q_tokens_distinct=True, least_hits=least_hits)
    both = shared.join(sizes(q, "item_id", "q", "n_q"), "item_id").join(sizes(docs, "doc_id", "t", "n_d"), "doc_id")
    return both.withColumn("jaccard", F.col("hits") / (F.col("n_q") + F.col("n_d") - F.col("hits"))).withColumn("cover", F.col("hits") / F.col("n_q"))


_LIKE = f"""(select item_id, doc_id, hits, n_q, n_d, hits / (n_q + n_d - hits) as jaccard, hits / n_q as cover from (
  select item_id, doc_id, count(*) as hits from (select distinct * from {_QUERY}) q join {_INDEX} i on q.token = i.token where len(q.token) >= 3 group by item_id, doc_id having count(*) >= 3)
  join (select item_id, count(distinct token) as n_q from {_QUERY} where len(token) >= 3 group by item_id) using (item_id)
  join (select doc_id, count(*) as n_d from {_INDEX} where len(token) >= 3 group by doc_id) using (doc_id))"""


def jaccard_cover(spark: SparkSession, d: str) -> DataFrame:
    return _likeness(spark, d).select("item_id", "doc_id", "hits", F.round("jaccard", 6).alias("jaccard"), F.round("cover", 6).alias("cover"))


JACCARD_COVER = f"select item_id, doc_id, hits, round(jaccard, 6) as jaccard, round(cover, 6) as cover from {_LIKE}"


def rank_margin(spark: SparkSession, d: str) -> DataFrame:
    ranked = corpus.rank(_likeness(spark, d), ["item_id"], "jaccard", ["doc_id"])
    return ranked.select("item_id", "doc_id", "place", F.round("jaccard", 6).alias("jaccard"), F.round("margin", 6).alias("margin"))


RANK_MARGIN = f"""select item_id, doc_id, cast(place as integer) as place, round(jaccard, 6) as jaccard, round(margin, 6) as margin from (
  select *, row_number() over w as place, jaccard - coalesce(lead(jaccard) over w, 0.0) as margin from {_LIKE} window w as (partition by item_id order by jaccard desc, doc_id)) where place <= 6"""


def ratio_score(spark: SparkSession, d: str) -> DataFrame:
    """The first documents of each item by blended score, among all that share a token."""
    found = corpus.rank_blended(_likeness(spark, d, least_hits=1), _bench(spark, d), ["item_id"], "q", _plain_docs(spark, d), ["doc_id"], "t")
    return found.select("item_id", "doc_id", F.round("score", 6).alias("score"))


def span_search(spark: SparkSession, d: str) -> DataFrame:
    """Passages of benchmark items in the lines of documents, anchored at tokens that one item alone has."""
    lines = doc_lines(spark, d).select("doc_id", "line_no", plain(F.col("line")).alias("t")).filter("t <> ''")
    items = _bench(spark, d)
    anchors = corpus.unique_anchors(corpus.inverted_index(items, ["item_id"], "q"), ["item_id"])
    spans = corpus.find_spans(lines, ["doc_id", "line_no"], "t", items, anchors, ["item_id"], "q")
    return spans.select("doc_id", "line_no", "item_id", F.col("first").alias("first_token"), F.col("last").alias("last_token"), F.round("score", 6).alias("score"))


def _words(spark: SparkSession, d: str, name: str, text: str) -> DataFrame:
    return read(spark, d, name).select(F.explode(corpus.words_of(F.translate(plain(F.coalesce(text, F.lit(""))), *FOLD))).alias("word"))


_WORDS = lambda table, text: f"(select unnest(string_split(translate({DUCK_PLAIN.format(f'coalesce({text}, chr(32))')}, '{FOLD[0]}', '{FOLD[1]}'), ' ')) as word from {table})"


def lexicon_build(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.build([(_words(spark, d, "documents", "text"), "word", 1), (_words(spark, d, "part", "p_name"), "word", 1000)], [(_words(spark, d, "benchmark", "text"), "word", 1)])


_LEXICON = f"""(with a as (select word, cast(sum(w) as bigint) as freq from (select word, 1 as w from {_WORDS('documents', 'text')} union all select word, 1000 from {_WORDS('part', 'p_name')}) where len(word) between 2 and 30 group by word)
select * from a union all select word, cast(1 as bigint) from (select distinct word from {_WORDS('benchmark', 'text')} where len(word) between 2 and 30) b where not exists (select 1 from a where a.word = b.word))"""
LEXICON_BUILD = f"select word, freq from {_LEXICON}"


def _small_lexicon(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.build([(_words(spark, d, "benchmark", "text"), "word", 1), (_words(spark, d, "part", "p_name"), "word", 1)])


def _asked(spark: SparkSession, d: str) -> DataFrame:
    return _words(spark, d, "conversations", "text").filter("length(word) between 2 and 30").distinct()


_SMALL = f"(select word, count(*) as freq from (select word from {_WORDS('benchmark', 'text')} union all select word from {_WORDS('part', 'p_name')}) where len(word) between 2 and 30 group by word)"
_ASKED = f"(select distinct word from {_WORDS('conversations', 'text')} where len(word) between 2 and 30)"
_GRAMS = "list_distinct(case when len({0}) >= 4 then list_transform(range(1, len({0}) - 1), lambda i: substr({0}, i, 3)) when len({0}) <= 2 then [{0}] else list_transform(range(1, len({0})), lambda i: substr({0}, i, 2)) end)"
_PAIRS = f"(select word, candidate, count(*) as shared from (select word, unnest({_GRAMS.format('word')}) as gram from {_ASKED}) a join (select word as candidate, unnest({_GRAMS.format('word')}) as gram from {_SMALL}) b using (gram) group by word, candidate)"
_CANDIDATES = f"(select word, candidate, shared, n from (select *, row_number() over (partition by word order by shared desc, candidate) as n from {_PAIRS}) where n <= 400)"


def gram_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Of each word the pool of candidates: its size, the n-grams shared in all, and a digest of the list in its order."""
    found = lexicon.pools(_asked(spark, d), _small_lexicon(spark, d))
    listed = F.array_join(F.transform("pool", lambda p: F.concat_ws(":", p["candidate"], p["shared"].cast("string"))), ",")
    shared = F.aggregate("pool", F.lit(0).cast("bigint"), lambda acc, p: acc + p["shared"])
    return found.select("word", F.size("pool").cast("bigint").alias("n"), shared.alias("shared"), F.md5(listed.cast("binary")).alias("pool_md5"))


GRAM_CANDIDATES = f"select word, count(*) as n, cast(sum(shared) as bigint) as shared, md5(string_agg(candidate || ':' || shared, ',' order by n)) as pool_md5 from {_CANDIDATES} group by word"


def bounded_edit(spark: SparkSession, d: str) -> DataFrame:
    """All lexicon words that share an n-gram with a word and are within two edits of it."""
    pairs = lexicon.candidates(_asked(spark, d), _small_lexicon(spark, d), None, within=2)
    return pairs.withColumn("distance", lexicon.within_distance(F.col("word"), F.col("candidate"), 2)).filter("distance is not null").select("word", "candidate", "distance")


BOUNDED_EDIT = f"select word, candidate, cast(levenshtein(word, candidate) as integer) as distance from {_PAIRS} where abs(len(word) - len(candidate)) <= 2 and levenshtein(word, candidate) <= 2"


def correct_words(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.corrections(_asked(spark, d), _small_lexicon(spark, d))


CORRECT_WORDS = f"""with near as (select c.word, candidate, levenshtein(c.word, candidate) as distance, freq from {_CANDIDATES} c join {_SMALL} l on c.candidate = l.word
  where levenshtein(c.word, candidate) between 1 and case when len(c.word) <= 5 then 1 else 2 end),
placed as (select *, row_number() over (partition by word order by distance, freq desc, candidate) as place, min(distance) over (partition by word) as nearest from near),
best as (select word, min(candidate) filter (place = 1) as candidate, count(*) filter (distance = nearest) as alike from placed where place <= 3 group by word),
kinds as (select a.word, candidate, case when l.word is not null then 'known' when len(a.word) < 3 then 'short' when candidate is null then 'unknown' when alike > 1 then 'ambiguous' else 'fixed' end as kind
  from {_ASKED} a left join {_SMALL} l on a.word = l.word left join best b on a.word = b.word)
select word, kind, case when kind = 'fixed' then candidate else word end as correction from kinds"""


def proofread_lines(spark: SparkSession, d: str) -> DataFrame:
    """Turns of conversations with their words corrected."""
    turns = read(spark, d, "conversations").select("conv_id", "turn", F.lower(F.coalesce("text", F.lit(""))).alias("t"))
    table = lexicon.corrections(_asked(spark, d), _small_lexicon(spark, d)).filter("kind = 'fixed'")
    fixed = lexicon.replace_tokens(turns, ["conv_id", "turn"], "t", table, "[a-zà-öø-ÿ]+")
    return fixed.select("conv_id", "turn", F.md5(F.col("corrected").cast("binary")).alias("line_md5"), (F.col("t") != F.col("corrected")).alias("changed"))


def mark_transfer(spark: SparkSession, d: str) -> DataFrame:
    """Corrections with the accents and signs of the words that they replace."""
    fixed = lexicon.corrections(_asked(spark, d), _small_lexicon(spark, d)).filter("kind = 'fixed'")
    marked = F.concat_ws("́", F.split("word", ""))
    return fixed.select("word", "correction", lexicon.transfer_marks(marked, F.col("correction"), "́").alias("marked"))


def conf_by_token(spark: SparkSession, d: str) -> DataFrame:
    words = read(spark, d, "conversations").select("conv_id", "turn", F.explode(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda w: w != "")).alias("word"))
    scored = words.withColumn("conf", F.lit(50.0) + (F.col("turn") * 7 + F.length("word") * 3) % 40)
    clean = quality.confident_text(scored, ["conv_id"], "word", "conf", "aeiou", 62.0)
    return clean.select("conv_id", "turn", "word", "best_conf", "clean").distinct()


CONF_BY_TOKEN = """with w as (select conv_id, turn, unnest(list_filter(string_split(coalesce(text, ''), ' '), lambda w: w <> '')) as word from conversations),
s as (select *, 50.0 + (turn * 7 + len(word) * 3) % 40 as conf from w),
b as (select conv_id, word, max(conf) as best_conf from s group by conv_id, word)
select distinct s.conv_id, s.turn, s.word, cast(best_conf as double) as best_conf, case when best_conf < 62 then regexp_replace(s.word, '[aeiou]', '', 'g') else s.word end as clean from s join b on s.conv_id = b.conv_id and s.word = b.word"""


LABELS = {"reversed page number": "page", "reversed numbers": "numbers", "moved within line": "moved", "fake marks removed": "marks", "letters restored": "letters", "punctuation restored": "punctuation", "marks or order": "other"}


def _changes(spark: SparkSession, d: str) -> DataFrame:
    turns = read(spark, d, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("before"))
    after = F.lead("before").over(Window.partitionBy("conv_id").orderBy("turn"))
    pairs = turns.withColumn("after", after).filter("after is not null")
    return pairs.select("conv_id", "turn", tx.classify_change(F.col("before"), F.col("after"), letters=LATIN, fake="??", labels=LABELS).alias("kinds"))


_DIGITS = r"regexp_extract_all({0}, '\p{{Nd}}+')"
_SORTED = "list_sort(string_split({0}, ''))"
_TIMES = "(len({0}) - len(replace({0}, '{1}', ''))) / {2}"
_CHANGES = f"""(select conv_id, turn, case when regexp_full_match(trim(a), '\\p{{Nd}}+') and regexp_full_match(trim(b), '\\p{{Nd}}+') then 'page'
  else coalesce(nullif(concat_ws(' + ',
    case when {_DIGITS.format('a')} <> {_DIGITS.format('b')} and len(list_filter({_DIGITS.format('a')}, lambda x: list_contains({_DIGITS.format('b')}, reverse(x)))) > 0 then 'numbers' end,
    case when {_SORTED.format('a')} = {_SORTED.format('b')} then 'moved' end,
    case when {_TIMES.format('a', '??', 2)} > {_TIMES.format('b', '??', 2)} then 'marks' end,
    case when len(regexp_replace(b, '[^{LATIN}]', '', 'g')) > len(regexp_replace(a, '[^{LATIN}]', '', 'g')) then 'letters' end,
    case when {' or '.join(f"{_TIMES.format('b', p, 1)} > {_TIMES.format('a', p, 1)}" for p in ':،؛.')} then 'punctuation' end), ''), 'other') end as kinds
  from (select conv_id, turn, coalesce(text, '') as a, lead(coalesce(text, '')) over (partition by conv_id order by turn) as b from conversations) where b is not null)"""


def classify_diff(spark: SparkSession, d: str) -> DataFrame:
    return _changes(spark, d)


CLASSIFY_DIFF = f"select conv_id, turn, kinds from {_CHANGES}"


def label_counts(spark: SparkSession, d: str) -> DataFrame:
    return pipelines.kind_counts(_changes(spark, d), ["conv_id"]).withColumnRenamed("n_pages", "n_convs")


LABEL_COUNTS = f"select kind, count(*) as n, count(distinct conv_id) as n_convs from (select conv_id, unnest(string_split(kinds, ' + ')) as kind from {_CHANGES}) group by kind"


def lead_join(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("doc_id").orderBy("line_no")
    both = F.concat_ws(" ", "line", F.lead("line").over(w))
    return doc_lines(spark, d).select("doc_id", "line_no", F.length(both).alias("n_chars"), F.md5(both.cast("binary")).alias("pair_md5"))


LEAD_JOIN = f"select doc_id, line_no, cast(len(p) as integer) as n_chars, md5(p) as pair_md5 from (select doc_id, line_no, concat_ws(' ', line, lead(line) over (partition by doc_id order by line_no)) as p from {DUCK_LINES})"


def html_runs(spark: SparkSession, d: str) -> DataFrame:
    """Pages cut into tags and text, in order."""
    runs = read(spark, d, "pages").select("page_id", F.posexplode(tx.typed_runs(F.coalesce("html", F.lit("")), "<[^<>]*>")).alias("pos", "r"))
    return runs.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_runs"), F.sum(F.col("r.special").cast("bigint")).alias("n_tags"), F.sum(F.when(~F.col("r.special"), F.length("r.text")).otherwise(0)).alias("text_chars"))


HTML_RUNS = """select page_id, n_tags + n_texts as n_runs, n_tags, text_chars from (select page_id, len(regexp_extract_all(h, '<[^<>]*>')) as n_tags,
  len(list_filter(string_split_regex(h, '<[^<>]*>'), lambda t: len(t) > 0)) as n_texts, cast(len(regexp_replace(h, '<[^<>]*>', '', 'g')) as bigint) as text_chars from (select page_id, coalesce(html, '') as h from pages))"""


def escape_text(spark: SparkSession, d: str) -> DataFrame:
    t = tx.mirror(tx.escape_xml(F.coalesce("html", F.lit(""))))
    return read(spark, d, "pages").select("page_id", F.md5(t.cast("binary")).alias("escaped_md5"), F.length(t).alias("n_chars"))


ESCAPE_TEXT = f"select page_id, md5(t) as escaped_md5, cast(len(t) as integer) as n_chars from (select page_id, translate(replace(replace(replace(replace(coalesce(html, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '{cs.MIRROR_PAIRS[0]}', '{cs.MIRROR_PAIRS[1]}') as t from pages)"


def repair_log(spark: SparkSession, d: str) -> DataFrame:
    """The change log of benchmark passages found in lines and put back whole."""
    lines = doc_lines(spark, d).select("doc_id", "line_no", plain(F.col("line")).alias("t")).filter("t <> ''")
    items = _bench(spark, d)
    anchors = corpus.unique_anchors(corpus.inverted_index(items, ["item_id"], "q"), ["item_id"])
    spans = corpus.find_spans(lines, ["doc_id", "line_no"], "t", items, anchors, ["item_id"], "q")
    return corpus.repair_spans(lines, ["doc_id", "line_no"], "t", spans, ["item_id"], items, "q")[1]


def correct_pages(spark: SparkSession, d: str) -> DataFrame:
    """Turns of conversations as scanned lines: noise out, passages of benchmark items put right, words corrected."""
    lines = read(spark, d, "conversations").select(F.col("conv_id").alias("page"), F.col("turn").alias("line_no"), F.coalesce("text", F.lit("")).alias("text"), F.lit(50.0).alias("conf"))
    verses = read(spark, d, "benchmark").select(F.col("item_id").alias("part"), F.lit(1).alias("verse"), F.coalesce("text", F.lit("")).alias("text"))
    bare = lambda c: F.regexp_replace(F.lower(c), f"[^{LATIN}]", "")
    out, log = pipelines.correct(lines, verses, _small_lexicon(spark, d), f"[{LATIN}]+", LATIN, plain=bare, skeleton=lambda c: F.translate(F.lower(c), *FOLD))
    counts = log.groupBy("page", "line_no").agg(F.count(F.lit(1)).alias("n_changes"))
    return out.join(counts, ["page", "line_no"], "left").select("page", "line_no", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.coalesce("n_changes", F.lit(0)).alias("n_changes"))


QUERIES = {
    "correct_pages": (correct_pages, None),
    "weighted_conf": (weighted_conf, WEIGHTED_CONF), "weighted_lines": (weighted_lines, WEIGHTED_LINES), "page_lines": (page_lines, PAGE_LINES), "noise_filter": (noise_filter, NOISE_FILTER),
    "marker_lines": (marker_lines, MARKER_LINES), "normalise_text": (normalise_text, NORMALISE_TEXT), "collapse_marks": (collapse_marks, COLLAPSE_MARKS), "tidy_punct": (tidy_punct, TIDY_PUNCT),
    "digit_map": (digit_map, DIGIT_MAP), "token_explode": (token_explode, TOKEN_EXPLODE), "unique_anchors": (unique_anchors, UNIQUE_ANCHORS), "index_probe": (index_probe, INDEX_PROBE),
    "jaccard_cover": (jaccard_cover, JACCARD_COVER), "rank_margin": (rank_margin, RANK_MARGIN), "ratio_score": (ratio_score, None), "span_search": (span_search, None), "repair_log": (repair_log, None),
    "lexicon_build": (lexicon_build, LEXICON_BUILD), "gram_candidates": (gram_candidates, GRAM_CANDIDATES), "bounded_edit": (bounded_edit, BOUNDED_EDIT), "correct_words": (correct_words, CORRECT_WORDS),
    "proofread_lines": (proofread_lines, None), "mark_transfer": (mark_transfer, None), "conf_by_token": (conf_by_token, CONF_BY_TOKEN), "classify_diff": (classify_diff, CLASSIFY_DIFF),
    "label_counts": (label_counts, LABEL_COUNTS), "lead_join": (lead_join, LEAD_JOIN), "html_runs": (html_runs, HTML_RUNS), "escape_text": (escape_text, ESCAPE_TEXT),
}
