"""Secret scans on DataFrame functions alone.

Base spans come from three patterns. Character Markov models add what the patterns miss: a run of token characters,
or a part of it, is a secret where random strings explain its transitions far better than ordinary identifiers do. What
base spans leave of a run is judged by itself. Both models are counted from labelled samples, by a DataFrame aggregation too.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagefold.llm.common import only

#: The kinds of base spans in order, their patterns, and the length that a match must have.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ASSIGN_LEAST = 8
#: Whole runs: a longer least length drops just the matches that would fail.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Runs that the models judge, the characters they know, and the log-likelihood ratio that makes a secret. A run, and a part that counts, has LEAST_PIECE characters.
LEAST_PIECE = 12
CANDIDATE = r"[A-Za-z0-9+/_=-]{12,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST_RATIO = 15.0
#: Places about a part that its ends are chosen from.
NEIGHBOURS = 64
#: Words of ordinary identifiers, from which the sample of negatives is put together.
IDENTIFIER_WORDS = (
    "account action active address after agent amount answer array author average before binary block board body book border bottom branch "
    "buffer build button cache call cancel category center change channel character check child class clear client close cluster code color "
    "column command comment common company compile complete config connect content context control convert copy count country create current "
    "customer data date default delete description detail device dialog direction directory display document domain double driver element "
    "email empty enable encode engine entry error event example execute export factory feature field file filter final first float folder "
    "font format forward frame function general generate global graph group handle hash header height history host icon image import index "
    "info input insert instance integer internal interface item job key label language last layer layout left length level library limit line "
    "link list load local location lock login machine main manager map master match maximum member memory menu message method minimum mode "
    "model module month mouse name native network node normal notification number object offset open option order output owner package page "
    "panel parameter parent parse partition password path pattern payment pending period person phone picture pixel plain player point policy "
    "position post prefix price print private process product profile project property provider public query queue random range read record "
    "reference region register release remote remove render report request reset resource response result return right role root route rule "
    "sample scale schedule schema scope screen script search second section security select send sequence server service session setting "
    "shape share signal simple single size sort source space special stack standard start state statement static status step stop storage "
    "store stream string style submit success suffix support switch symbol system table target task template test text thread time title "
    "token tool total trace track transaction transform tree trigger type unique unit update upload user value variable vector version video "
    "view visible volume wait warning web width window word work worker write year zone that there with which their would about these other "
    "through between nation station question statement thing another together whether weather themselves understanding notwithstanding"
).split()


def samples(spark: SparkSession, n: int = 12_000) -> DataFrame:
    """Labelled samples (text, label), made by rule: label 1 random strings of several alphabets, label 0 identifiers."""
    i = F.col("id").cast("string")
    digest = F.sha2(F.concat(F.lit("s"), i).cast("binary"), 256)
    base64 = F.base64(F.unhex(digest))
    alnum = F.translate(base64, "+/=", "Zq")
    url_safe = F.translate(base64, "+/=", "-_")
    kinds = [base64, alnum, url_safe, digest, F.upper(F.substring(alnum, 1, 32)), F.lower(alnum)]
    text = kinds[-1]
    for k in range(len(kinds) - 1):
        text = F.when(F.col("id") % len(kinds) == k, kinds[k]).otherwise(text)
    positive = spark.range(n).select(text.alias("text"), F.lit(1).alias("label"))
    words = F.array(*[F.lit(w) for w in IDENTIFIER_WORDS])
    pick = lambda k: F.element_at(words, (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(IDENTIFIER_WORDS))) + 1).cast("int"))
    w = [pick(k) for k in range(4)]
    number = F.when(F.col("id") % 4 == 0, (F.pmod(F.xxhash64("id", F.lit(9)), F.lit(3000))).cast("string")).otherwise(F.lit(""))
    forms = [
        F.concat(*w, number),
        F.concat_ws("_", *w, F.nullif(number, F.lit(""))),
        F.concat_ws("-", *w, F.nullif(number, F.lit(""))),
        F.concat(w[0], *[F.initcap(x) for x in w[1:]], number),
        F.concat_ws("/", *w),
        F.concat_ws("_", *[F.upper(x) for x in w]),
        F.concat(*[F.initcap(x) for x in w]),
        F.concat(F.lit("/"), F.concat_ws("/", w[0], w[1]), F.lit("/"), F.concat_ws("-", w[2], w[3]), F.lit("="), number),
    ]
    form = forms[-1]
    for k in range(len(forms) - 1):
        form = F.when(F.pmod(F.xxhash64("id", F.lit(77)), F.lit(len(forms))) == k, forms[k]).otherwise(form)
    return positive.unionByName(spark.range(n).select(form.alias("text"), F.lit(0).alias("label")))


CODES = 128


def by_code(model: list[float]) -> list[float]:
    """The model's table by the codes of two characters."""
    size, out = len(ALPHABET), [0.0] * (CODES * CODES)
    for a, first in enumerate(ALPHABET):
        for b, second in enumerate(ALPHABET):
            out[ord(first) * CODES + ord(second)] = model[a * size + b]
    return out


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of each transition, as a table of len(ALPHABET) ** 2 numbers.

    labelled: text and label (1 random, 0 ordinary). Counts are smoothed by one; only sums for pairs of known
    characters come to the driver.
    """
    size = len(ALPHABET)
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("text") - 1), lambda i: F.call_function("substr", F.col("text"), i, F.lit(2))))
    counts = labelled.filter("length(text) > 1").select("label", pair.alias("pair")).groupBy("label", "pair").count()
    seen = {0: [[1.0] * size for _ in range(size)], 1: [[1.0] * size for _ in range(size)]}
    place = {c: k for k, c in enumerate(ALPHABET)}
    for label, two, n in counts.filter(F.col("pair").rlike(f"^[{ALPHABET[:-1]}-]{{2}}$")).collect():
        seen[label][place[two[0]]][place[two[1]]] += n
    of = lambda label, a, b: math.log(seen[label][a][b] / sum(seen[label][a]))
    return [round(of(1, a, b) - of(0, a, b), 4) for a in range(size) for b in range(size)]


SPAN = "struct<start:int,kind:int,end:int,hit:string>"
#: Steps of an inner fold, and inner folds of a middle one.
FOLD = 128


def _struct(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def folded(n: Column, start: dict[str, Column], step: Callable[[Column, Column], dict[str, Column]], kind: str) -> Column:
    """A fold over the places 1 to n that lists items of a type on its way: a struct of the last state `s` and the list `out`.

    step gives the next state, in which `good` tells whether its `item` is listed. Spark copies a fold's state at each
    step, so a list grown in one fold takes time with the square of its length. Here folds are nested three deep: an inner one
    lists what FOLD places give, a middle one what FOLD inner ones give, and only the outer one carries everything.
    """
    none = F.array().cast(f"array<{kind}>")
    zero = _struct(**start, good=F.lit(False), item=F.lit(None).cast(kind))
    listed = lambda out, s: F.when(s["good"], F.array_append(out, s["item"])).otherwise(out)

    def inner(s: Column, lo: Column) -> Column:
        places = F.sequence(lo, F.least(n, lo + (FOLD - 1)))
        done = lambda acc: _struct(s=acc["s"].withField("good", F.lit(False)), out=listed(acc["out"], acc["s"]))
        return F.aggregate(places, _struct(s=s, out=none), lambda acc, i: _struct(s=_struct(**step(acc["s"], i)), out=listed(acc["out"], acc["s"])), done)

    def gather(s: Column, lo: Column, hi: Column, by: int, below: Callable[[Column, Column], Column]) -> Column:
        # the latest part stays apart until the next one is made of its state
        part = lambda acc: F.concat(acc["out"], acc["part"]["out"])
        return F.aggregate(F.sequence(lo, hi, F.lit(by)), _struct(part=_struct(s=s, out=none), out=none), lambda acc, at: _struct(part=below(acc["part"]["s"], at), out=part(acc)), lambda acc: _struct(s=acc["part"]["s"], out=part(acc)))

    middle = lambda s, lo: gather(s, lo, F.least(n, lo + (FOLD * FOLD - 1)), FOLD, inner)
    return F.when(n > 0, gather(zero, F.lit(1), n, FOLD * FOLD, middle)).otherwise(_struct(s=zero, out=none))


def _spans(text: Column, pattern: str, kind: int, judge: tuple[int, int] | None = None) -> Column:
    """Spans of the leftmost matches that do not overlap, as structs (start, kind, end, hit).

    What stands between the matches (split) and the matches give the places. judge: a group and its least length.
    """
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"), F.regexp_extract_all(text, F.lit(pattern), F.lit(judge[0] if judge else 0)).alias("inner"))
    sized = F.transform(parts, lambda p: _struct(gap=F.length(p["gap"]), hit=p["hit"], size=F.coalesce(F.length(p["hit"]), F.lit(0)), good=F.coalesce(F.length(p["inner"]) >= (judge[1] if judge else 1), F.lit(False))))

    def of(all_: Column) -> Column:
        def step(s: Column, i: Column) -> dict[str, Column]:
            part = F.element_at(all_, i)
            start = s["at"] + part["gap"]
            end = start + part["size"]
            return {"at": end, "good": part["good"], "item": _struct(start=start, kind=F.lit(kind), end=end, hit=part["hit"])}

        return folded(F.size(all_), {"at": F.lit(0)}, step, SPAN)["out"]

    return bound(sized, of)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(n) for n in ("assign", "access", "hex", "random")])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


PIECE = "struct<start:int,end:int,first:int,bytes:binary>"


def left_over(base: Column, runs: Column) -> Column:
    """What base spans leave of the runs: pieces (start, end, first: the run's start, bytes: the run's characters).

    One sweep over both in order of their starts, so the time doesn't depend on how many meet.
    """
    plain = lambda x: _struct(start=x["start"], kind=x["kind"], end=x["end"], hit=F.when(x["kind"] == 4, x["hit"].cast("binary")))
    # a last item behind all others closes the last run
    close = F.array(_struct(start=F.lit((1 << 31) - 1), kind=F.lit(5), end=F.lit((1 << 31) - 1), hit=F.lit(None).cast("binary")))

    def of(items: Column) -> Column:
        def step(s: Column, i: Column) -> dict[str, Column]:
            x = F.element_at(items, i)
            run = x["kind"] == 4
            to = F.when(run, s["last"]).otherwise(F.least(x["start"], s["last"]))
            now = {n: F.when(run, x[m]).otherwise(s[n]) for n, m in (("first", "start"), ("last", "end"), ("bytes", "hit"))}
            at = F.when(run, F.greatest(x["start"], s["covered"])).otherwise(F.greatest(s["at"], x["end"]))
            covered = F.when(run, s["covered"]).otherwise(F.greatest(s["covered"], x["end"]))
            return {"covered": covered, "at": at, **now, "good": to - s["at"] >= LEAST_PIECE, "item": _struct(start=s["at"], end=to, first=s["first"], bytes=s["bytes"])}

        start = {"covered": F.lit(0), "at": F.lit(0), "first": F.lit(0), "last": F.lit(0), "bytes": F.lit(None).cast("binary")}
        return folded(F.size(items), start, step, PIECE)["out"]

    return bound(F.concat(F.array_sort(F.transform(F.concat(base, runs), plain)), close), of)


def judged(piece: Column, model: list[float], least_ratio: float) -> Column:
    """Spans of a piece: the whole of it where it is a secret as a whole, else its parts of most weight.

    A part is the best of as many as there are pairs of places about it, so it has to reach least_ratio and the logarithm
    of their number. It ends at its peak once the sum is used up or has fallen by that much: nothing from its peak to there
    reaches it. Characters are taken from the bytes by place, one step each.
    """
    ratios = F.split(F.lit(",".join(map(str, by_code(model)))), ",").cast("array<double>")
    n, skip = piece["end"] - piece["start"], piece["start"] - piece["first"]
    code = lambda i: F.ascii(F.call_function("substring", piece["bytes"], skip + i, F.lit(1)).cast("string"))
    move = lambda i: F.element_at(ratios, code(i) * CODES + code(i + 1) + 1)
    text = lambda a, b: F.call_function("substring", piece["bytes"], skip + a + 1, b - a).cast("string")
    span = lambda a, b: _struct(start=piece["start"] + a, kind=F.lit(4), end=piece["start"] + b, hit=text(a, b))
    zero, least = F.lit(0.0), least_ratio + 2 * F.log(F.least(n, F.lit(NEIGHBOURS)).cast("double"))

    def step(s: Column, i: Column) -> dict[str, Column]:
        # `next` is the sum with the coming transition, made a step ahead
        over = (s["next"] <= 0) | (s["next"] <= s["peak"] - least)
        higher = ~over & (s["next"] > s["peak"])
        peak = F.when(over, zero).when(higher, s["next"]).otherwise(s["peak"])
        good = over & (s["peak"] >= least) & (s["last"] - s["first"] >= LEAST_PIECE)
        following = F.when(over, zero).otherwise(s["next"]) + F.when(i + 1 < n, move(i + 1)).otherwise(-1e9)
        return {"next": following, "first": F.when(over, i).otherwise(s["first"]), "peak": peak, "last": F.when(higher, i + 1).otherwise(s["last"]), "good": good, "item": F.when(good, span(s["first"], s["last"]))}

    # the last place has no transition: its sum of less than nothing closes the last part
    parts = folded(n, {"next": move(F.lit(1)), "first": F.lit(0), "peak": zero, "last": F.lit(0)}, step, SPAN)["out"]
    # no part sums to more than all that counts for it
    add = lambda acc, i: bound(move(i), lambda m: _struct(all=acc["all"] + m, up=acc["up"] + F.greatest(m, zero)))
    sums = F.aggregate(F.sequence(F.lit(1), n - 1), _struct(all=zero, up=zero), add)
    none = F.array().cast(f"array<{SPAN}>")
    return bound(sums, lambda x: F.when(x["all"] >= least_ratio, F.array(span(F.lit(0), n))).when(x["up"] < least, none).otherwise(parts))


def scan(docs: DataFrame, model: list[float], text: str = "text", key: str = "doc_id", least_ratio: float = LEAST_RATIO, with_spans: bool = False) -> DataFrame:
    """Secrets in every whole text.

    Returns per row: the key, n_assign, n_access, n_hex, base_sha256 (of kind:start:end of the base spans by start,
    then kind, comma-joined; code points, end exclusive), spans (all spans, joined likewise; those that the models add
    are of kind `random` and overlap no base span), n_random, and with `with_spans` also found, an array of
    (start, kind, end, hit). Null texts count as empty; repeated rows stay rows; further columns are left out.
    """
    t = F.col("t")
    none = F.array().cast(f"array<{SPAN}>")
    rows = only(docs, key, text).toDF("k", "t").withColumn("t", F.coalesce("t", F.lit("")))
    base = [
        F.when(t.rlike(ASSIGN_HINT), _spans(t, ASSIGN, 1, (2, ASSIGN_LEAST))).otherwise(none),
        F.when(t.rlike(ACCESS), _spans(t, ACCESS, 2)).otherwise(none),
        F.when(t.rlike(HEX), _spans(t, HEX, 3)).otherwise(none),
    ]
    rows = rows.select("k", *[b.alias(n) for b, n in zip(base, ("assign", "access", "hex"))], F.when(t.rlike(CANDIDATE), _spans(t, CANDIDATE, 4)).otherwise(none).alias("runs"))
    rows = rows.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    added = F.flatten(F.transform(left_over(F.col("base"), F.col("runs")), lambda p: judged(p, model, least_ratio)))
    rows = rows.withColumn("random", F.when(F.size("runs") > 0, added).otherwise(none))
    found = F.array_sort(F.concat("base", "random"))
    long = lambda c: F.size(c).cast("bigint")
    return rows.select(
        F.col("k").alias(key), long("assign").alias("n_assign"), long("access").alias("n_access"), long("hex").alias("n_hex"), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(found).alias("spans"), long("random").alias("n_random"), *([found.alias("found")] if with_spans else [])
    )
