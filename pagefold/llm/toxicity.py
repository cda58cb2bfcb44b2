"""Toxicity by a subsequence string kernel machine with Nystrom landmarks.

Two strings are as alike as the subsequences of three characters that they share, each weighted by LAMBDA to the power
of the characters it spans; so gapped words, and words with characters put in, stay close to the insult they come
from. The kernel spans at most SPAN characters, is normalised and squared, and counts as nothing below FLOOR. Landmarks
are stems that tell toxic documents from clean ones, the start of a word marked; a word is compared by its pieces, the best of
which counts, so an insult is found under any ending. Where a stem tells the classes apart wherever it stands in a word, pieces may start
at any letter: then it is found behind any other word too. Whole words of clean documents that come near a stem are landmarks as well,
so that a harmless word can be told from an insult.

A sentence is known by its best word for each landmark; these values, whitened by the landmarks' own kernel matrix
(Nystrom), go to a linear support vector machine. It is trained on the sentences of labelled documents: those of clean
documents are clean, those of toxic documents that come nearest to a telling stem begin as toxic, and each round takes in and out
what the machine finds, but for the worst of each document. A document's score is a logistic function of its worst sentence and of
the toxic sentences and different toxic words found, so that one look-alike in a long clean text weighs little.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from pagefold.llm.common import BATCH_ROWS, WORD, arrow_rows, only, slices, written

LAMBDA, SPAN, FLOOR = 0.7, 8, 0.3
#: A word is compared by its pieces if its kernel with a stem is this share of the stem's own.
NEAR = 0.45
#: Labelled rows of each class that a model is fitted on at most: the one bound on what it learns from.
SAMPLE_ROWS = 2500
#: Stems that become landmarks at most, and the letters that a stem has.
LANDMARKS, STEM = 32, range(3, 10)
#: Log-likelihood ratio (nats) from which a stem tells the classes apart by more than chance among very many stems, and how many
#: times its share must be larger in toxic documents: words of a language that has more of them differ by less.
TELLING, LIFT = 12.0, 20.0
#: What share of its frequency in toxic documents a stem may have inside the words of clean ones, to count inside words.
INSIDE = 0.002
#: A piece from inside a word must come this near to a landmark.
INSIDE_FLOOR = 0.7
#: How near to a stem some word of a sentence has to come for the sentence to be taken for toxic in training.
CLOSE = 0.6
#: Margin from which a sentence or word counts as toxic.
SURE = 0.75
#: Whole words of clean documents that become landmarks beside each stem.
LOOKALIKES = 2
#: Lengths of the pieces of a word that are compared beside the rest of it, of which LONG_WORD letters count at most.
LENGTHS, LONG_WORD = (3, 4, 5, 6, 7, 8, 9, 10, 12), 20
#: Values are kept in steps of this size where a model is fitted, so that equal sentences are one row.
STEPS = 32
MEMO_WORDS = 400_000
THRESHOLD = 0.7
#: Cost of misjudging all sentences of both classes, against the squared length of the weights.
COST = 20_000.0
WORDS = re.compile(WORD)
#: Three or more single characters in a row: a word spelt out.
SPELT = re.compile(r"(?<!\S)(?:[^\W\d_][ .\-_*]{1,2}){2,}[^\W\d_](?![^\W_])")
#: Digits and signs that stand for letters inside a word.
LEET = str.maketrans("013457@$!|", "oieastasii")
CODES = 64  # 0: start of a word, 1-26: a-z, others share the rest


MARKS = "\"'`.,:;!?()[]{}<>*#%&$@|/\\-_+=~^"


#: Three and more of a letter, in a word drawn out.
DRAWN_OUT = re.compile(r"(.)\1{2,}")


def plain(word: str) -> str:
    """The letters of a word: lower case, stand-ins put back, letters drawn out once, all else dropped."""
    w = word.lower().strip(MARKS)
    if not w.isalpha():
        w = "".join([c for c in unicodedata.normalize("NFC", w.translate(LEET)) if c.isalpha()])
    elif not w.isascii():
        w = unicodedata.normalize("NFC", w)
    return DRAWN_OUT.sub(r"\1", w)


def pieces_from(word: str, k: int) -> list[str]:
    """Pieces of a plain word that start at its k-th letter, and the rest with its end marked."""
    rest = word[k : k + LONG_WORD + 1]
    return [rest[:p] for p in LENGTHS if p <= len(rest)] + [rest[:LONG_WORD] + "$" * (len(rest) <= LONG_WORD)]


def subsequences(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """string, code (of three characters) and weight of each subsequence; a string begins with the mark of a start."""
    marked = ["^" + s for s in strings]
    raw = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.int32)
    code = np.where((raw >= 97) & (raw <= 122), raw - 96, 27 + raw % (CODES - 27)).astype(np.int32)
    sizes = [len(m) for m in marked]
    code[np.cumsum([0, *sizes[:-1]])] = 0
    of = np.repeat(np.arange(len(strings), dtype=np.int32), sizes)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for k in range(2, SPAN):
        n = len(code) - k
        if n <= 0:
            break
        at = np.flatnonzero(of[:n] == of[k:])
        ends, owner = code[at] * (CODES * CODES) + code[at + k], of[at]
        for j in range(1, k):
            out.append((owner, ends + code[at + j] * CODES, np.full(len(at), LAMBDA ** (k + 1))))
    if not out:
        return np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def norms(of: np.ndarray, code: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Kernel of each string with itself."""
    both, at = np.unique(of.astype(np.int64) * CODES**3 + code, return_inverse=True)
    return np.bincount(both // CODES**3, np.bincount(at, weight, len(both)) ** 2, n)


@dataclass
class Kernel:
    """Values of words at the landmarks, remembered for words seen.

    The first `stems` landmarks are stems; a word that comes near none of them has no values. free: which landmarks count at
    any letter of a word.
    """

    landmarks: list[str]
    stems: int | None = None  # all
    free: list[bool] | None = None  # all

    def __post_init__(self) -> None:
        n = len(self.landmarks)
        self.stems = n if self.stems is None else self.stems
        self.free = [True] * n if self.free is None else self.free
        of, code, weight = subsequences(self.landmarks)
        codes, at = np.unique(code, return_inverse=True)
        self.row_of = np.zeros(CODES**3, np.int32)
        self.row_of[codes] = np.arange(1, len(codes) + 1)
        table = np.zeros((len(codes) + 1, n))
        np.add.at(table, (at + 1, of), weight)
        self.own = np.maximum(norms(of, code, weight, n), 1e-300)
        self.table, self.rough = table, table.astype(np.float32)
        # what a subsequence adds to a word's nearness to any stem at most
        self.most = np.zeros(CODES**3, np.float32)
        self.most[codes] = (table / self.own)[1:, : self.stems].max(1)
        self.is_free = np.array(self.free, bool)
        self.memo: dict[str, int] = {}
        self.rows = [np.zeros(n, np.float32)]

    def __getstate__(self) -> dict:
        return {"landmarks": self.landmarks, "stems": self.stems, "free": self.free}

    def __setstate__(self, state: dict) -> None:
        self.landmarks, self.stems, self.free = state["landmarks"], state["stems"], state["free"]
        self.__post_init__()

    def shared(self, of: np.ndarray, code: np.ndarray, weight: np.ndarray, n: int, table: np.ndarray) -> np.ndarray:
        """Kernel of each of n strings with each landmark."""
        out = np.zeros((n, len(self.landmarks)), table.dtype)
        hit = np.flatnonzero(self.row_of[code])
        if len(hit):
            hit = hit[np.argsort(of[hit], kind="stable")]
            first = np.flatnonzero(np.append(True, np.diff(of[hit]) > 0))
            out[of[hit][first]] = np.add.reduceat(table[self.row_of[code[hit]]] * weight[hit, None], first, axis=0)
        return out

    def near(self, strings: list[str]) -> np.ndarray:
        """Which strings come near which stems."""
        n = len(strings)
        out = np.zeros((n, self.stems), bool)
        of, code, weight = subsequences(strings)
        may = np.bincount(of, weight * self.most[code], n) >= NEAR * (1 - 1e-6)
        keep = may[of]
        if keep.any():
            out = (self.shared(of[keep], code[keep], weight[keep], n, self.rough) / self.own)[:, : self.stems] >= NEAR
        return out

    def values(self, strings: list[str]) -> np.ndarray:
        """Normalised and squared kernel of each string with each landmark; 0 where below FLOOR."""
        of, code, weight = subsequences(strings)
        out = self.shared(of, code, weight, len(strings), self.table)
        own = norms(of, code, weight, len(strings))
        out = np.minimum(out**2 / np.maximum(own[:, None] * self.own, 1e-300), 1.0)
        out[out < FLOOR] = 0
        return out

    def of_words(self, words: list[str]) -> np.ndarray:
        """Values of plain words: of their best pieces."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        near = self.near(words)
        for inside in (False, True):  # pieces at the start count for all landmarks, others for those that are free
            some = np.flatnonzero((near & self.is_free[: self.stems]).any(1) if inside else near.any(1)).tolist()
            lists = [[p for k in range(1, len(words[i]) - STEM[0] + 1) for p in pieces_from(words[i], k)] if inside else pieces_from(words[i], 0) for i in some]
            owners = np.repeat(np.array(some, np.int64), [len(x) for x in lists])
            if not len(owners):
                continue
            every, at = np.unique([p for x in lists for p in x], return_inverse=True)
            values = np.concatenate([self.values(every[start : start + 5000].tolist()) for start in range(0, len(every), 5000)])
            if inside:
                values[:, ~self.is_free] = 0
                values[values < INSIDE_FLOOR] = 0
            np.maximum.at(out, owners, values[at])
        return out

    def learn(self, words: set[str]) -> None:
        """Makes sure that the memo has these words; it starts anew when it is full."""
        new = list(words.difference(self.memo))
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo, self.rows, new = {}, self.rows[:1], list(words)
        self.memo.update(dict.fromkeys(new, 0))
        letters = [plain(w) for w in new]
        able = [i for i, w in enumerate(letters) if len(w) >= STEM[0]]
        for start in range(0, len(able), 2000):
            part = able[start : start + 2000]
            values = self.of_words([letters[i] for i in part])
            for k in np.flatnonzero(values.any(1)).tolist():
                self.memo[new[part[k]]] = len(self.rows)
                self.rows.append(values[k])

    def sentences(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """For each text: best values for each landmark of the sentences that have any, values of the different words that
        have any, and the number of all sentences."""
        none = np.zeros((0, len(self.landmarks)))
        for start in range(0, len(texts), 128):
            part = []
            for text in texts[start : start + 128]:
                words = WORDS.findall(text)
                words += ["".join(c for c in m[0] if c.isalpha()) + "." for m in SPELT.finditer(text)]
                part.append(words)
            self.learn({w for words in part for w in words})
            memo = self.memo
            for words in part:
                rows = [memo[w] for w in words]
                n = 1 + sum([w[-1] in ".!?" for w in words])
                if not any(rows):
                    yield none, none, n
                    continue
                rows = np.array(rows, np.int64)
                hit = np.flatnonzero(rows)
                sentence = np.searchsorted([i for i, w in enumerate(words) if w[-1] in ".!?"], hit)
                first = np.flatnonzero(np.append(True, np.diff(sentence) > 0))
                different, at = np.unique(rows[hit], return_inverse=True)
                values = np.array([self.rows[r] for r in different])
                yield np.maximum.reduceat(values[at], first, axis=0), values, n


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Weights and offset of a linear machine with squared hinge loss, by Newton steps. y: 1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    loss = lambda v: 0.5 * v @ ridge @ v + c * (weight * np.maximum(0, 1 - y * (x @ v)) ** 2).sum()
    for _ in range(rounds):
        on = y * (x @ w) < 1
        xs, ws = x[on], weight[on]
        grad = ridge @ w - 2 * c * (xs.T @ (ws * (y[on] - xs @ w)))
        step = np.linalg.solve(ridge + 2 * c * (xs * ws[:, None]).T @ xs, grad)
        size, now = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def fit_logistic(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 0.3, rounds: int = 100) -> np.ndarray:
    """Weights and offset of the chance 1 / (1 + exp(-(x w + b))). y: 0 or 1; share: what part of all is 1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    up, down = (y == 1).sum(), (y == 0).sum()
    weight = np.where(y == 1, share / up, (1 - share) / down) * len(y)
    hold = np.diag([ridge] * (x.shape[1] - 1) + [1e-3])
    v = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        step = np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + hold, x.T @ (weight * (p - y)) + hold @ v)
        v = v - np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-9:
            break
    return v


def of_document(margins: np.ndarray, words: np.ndarray, rest: float, n: float) -> list[float]:
    """What a document is judged by: margins of the sentences and of the different words that have any value, the
    margin of other sentences, and how many sentences there are."""
    worst = max([*margins.tolist(), *([rest] if n > len(margins) else [])])
    bad, different = float((margins > SURE).sum()), float((words > SURE).sum())
    return [float(np.clip(worst, -1.5, 1.5)), float(np.log1p(bad)), bad / max(n, 1.0) ** 0.5, bad / max(n, 1.0), float(np.log1p(different)), different / max(n, 1.0) ** 0.5]


@dataclass
class Model:
    """Scores texts. Without labels of both classes every text scores `prior`."""

    kernel: Kernel | None
    whiten: np.ndarray | None = None
    weights: np.ndarray | None = None
    logistic: np.ndarray | None = None
    prior: float = 0.0

    def __post_init__(self) -> None:
        self.direction = None if self.kernel is None else self.whiten @ self.weights[:-1]

    def score(self, texts: list[str]) -> list[float]:
        if self.kernel is None:
            return [self.prior] * len(texts)
        rest, out = float(self.weights[-1]), []
        for best, words, n in self.kernel.sentences(texts):
            of = of_document(best @ self.direction + rest, words @ self.direction + rest, rest, n)
            out.append(float(1 / (1 + np.exp(-np.clip(np.dot(of, self.logistic[:-1]) + self.logistic[-1], -30, 30)))))
        return out


def sampled(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, rows: int) -> tuple[DataFrame, float]:
    """The labelled texts that a model is fitted on (k, y and t of at most `rows` rows of each class, chosen by hash),
    and the share of class 1 among all labels."""
    y = labels.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{label}`").cast("int").alias("y")).filter("__key is not null and y in (0, 1)")
    y = written(y.groupBy("__key").agg(F.max("y").alias("y")), "labels")
    order = F.xxhash64(F.lit("sample"), F.col("__key"))
    first = lambda df, *by: [df.filter(F.col("y") == c).orderBy(*by).limit(rows) for c in (1, 0)]
    up, down = first(y, order, "__key")
    few = written(up.unionByName(down), "few")
    texts = only(docs, key, text).toDF("k", "t").join(F.broadcast(few), F.col("k") == F.col("__key"))
    # a key may have many rows: the bound holds for rows, not only for keys
    texts = written(texts.select("k", "__key", "y", F.coalesce("t", F.lit("")).alias("t"), F.xxhash64("t").alias("h")), "texts")
    up, down = first(texts.select("__key", "y", "h").withColumn("n", F.row_number().over(Window.partitionBy("__key", "h").orderBy("y"))), order, "__key", "h", "n")
    most = written(up.unionByName(down).groupBy("__key", "h").agg(F.max("n").alias("n")), "most")
    place = F.row_number().over(Window.partitionBy("__key", "h").orderBy("t"))
    kept = texts.join(F.broadcast(most), ["__key", "h"]).withColumn("__n", place).filter(F.col("__n") <= F.col("n"))
    share = y.agg(F.avg("y")).first()[0] or 0.0
    return written(kept.select("k", "y", "t"), "sample"), float(share)


def surprise(up: Column, down: Column, all_up: float, all_down: float) -> Column:
    """Log-likelihood ratio of counts in the two classes against one share in both; 0 where the share is no larger in `up`."""
    both = (up + down) / (all_up + all_down)
    term = lambda k, n, p: F.when(k > 0, k * F.log(k / n / p)).otherwise(0.0) + F.when(k < n, (n - k) * F.log((n - k) / n / (1 - p))).otherwise(0.0)
    return F.when((up / all_up > down / all_down) & (both < 1), term(up, F.lit(all_up), both) + term(down, F.lit(all_down), both)).otherwise(0.0)


def choose(ordered: list[str], most: int) -> list[str]:
    """Stems from the most telling on, without those that only lengthen or shorten one taken before."""
    out: list[str] = []
    for stem in ordered:
        if len(out) == most:
            break
        if not any(stem in o or o in stem for o in out):
            out.append(stem)
    return out


def counted_words(sample: DataFrame) -> DataFrame:
    """w, up, down: in how many documents of each class a word comes up.

    Copies of documents would make any of their words telling. So a word counts where it stands between two neighbours
    that no document before has it between, and once in a document.
    """
    words = F.regexp_extract_all("t", F.lit(f"({WORD})"), F.lit(1))
    around = lambda a: F.transform(F.sequence(F.lit(1), F.size(a)), lambda i: F.struct(F.element_at(a, i).alias("word"), F.xxhash64(F.try_element_at(a, i - 1 + F.when(i == 1, -1).otherwise(0)), F.element_at(a, i), F.try_element_at(a, i + 1)).alias("window")))
    held = sample.select("y", F.xxhash64("k", "t").alias("doc"), words.alias("a")).filter(F.size("a") > 0)
    each = held.select("y", "doc", F.explode(F.element_at(F.transform(F.array("a"), around), 1)).alias("x")).select("y", "doc", "x.word", "x.window")
    once = each.groupBy("word", "y", "window").agg(F.min("doc").alias("doc")).groupBy("word", "y").agg(F.count_distinct("doc").alias("n"))

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([plain(w) for w in batch.column(0).to_pylist()]), batch.column(1), batch.column(2)], ["w", "y", "n"])

    of_class = lambda y: F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0)).cast("double")
    return once.select("word", "y", "n").mapInArrow(letters, "w string, y int, n bigint").filter(F.length("w") >= STEM[0]).groupBy("w").agg(of_class(1).alias("up"), of_class(0).alias("down"))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", rows: int = SAMPLE_ROWS, landmarks: int = LANDMARKS) -> Model:
    """Fits a model on labelled documents (labels: key and label 0 or 1; give only those it may learn from).

    At most `rows` rows of each class are used, all of their sentences and words. Sentences with equal values come to the
    driver as one row each and document, with bytes for values.
    """
    sample, share = sampled(docs, labels, text, key, label, rows)
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return Model(None, prior=float(bool(sizes.get(1))))
    words = written(counted_words(sample), "words")
    all_up, all_down = (float(x or 0.0) + 1.0 for x in words.agg(F.sum("up"), F.sum("down")).first())
    stems = F.explode(F.transform(F.sequence(F.lit(STEM[0]), F.least(F.lit(STEM[-1]), F.length("w"))), lambda n: F.call_function("substr", F.col("w"), F.lit(1), n)))
    shares = words.select(stems.alias("w"), "up", "down").groupBy("w").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    shares = shares.filter((F.col("up") / all_up) >= LIFT * (F.col("down") + 0.5) / all_down).withColumn("s", F.round(surprise(F.col("up"), F.col("down"), all_up, all_down), 6)).filter(F.col("s") >= TELLING)
    # a word has seven stems, and a stem hides those that hold it: so many are enough to choose from
    found = shares.orderBy(F.col("s").desc(), F.length("w").desc(), "w").limit(50 * landmarks).collect()
    top = choose([r["w"] for r in found], landmarks)
    if not top:
        return Model(None, prior=sizes[1] / (sizes[0] + sizes[1]))
    # a stem is free where clean documents hardly ever have it inside a word
    begins, inside = F.startswith, lambda w, t: F.contains(w, t) & ~F.startswith(w, t)
    counts = [F.sum(F.when(how(F.col("w"), F.lit(t)), F.col(c)).otherwise(0.0)) for t in top for how, c in ((begins, "up"), (inside, "down"))]
    held = words.agg(*counts).first()
    free = [held[2 * i + 1] / all_down <= INSIDE * held[2 * i] / all_up for i in range(len(top))]
    of_stems = Kernel(top, len(top), free)

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ws, down = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            near, stem = np.nonzero(of_stems.of_words(ws)) if ws else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array([ws[i] for i in near], pa.string()), pa.array([int(j) for j in stem], pa.int32()), pa.array([down[i] for i in near], pa.float64())], ["w", "stem", "down"])

    place = F.row_number().over(Window.partitionBy("stem").orderBy(F.col("down").desc(), "w"))
    clean_words = words.filter("down > 1 and down >= up").select("w", "down").mapInArrow(alike, "w string, stem int, down double")
    near = clean_words.withColumn("place", place).filter(F.col("place") <= LOOKALIKES).groupBy("w").agg(F.min("stem").alias("stem")).orderBy("w").collect()
    near = [(r["w"][:LONG_WORD] + "$" * (len(r["w"]) <= LONG_WORD), free[r["stem"]]) for r in near]
    kernel = Kernel(top + [w for w, _ in near], len(top), free + [f for _, f in near])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            out: list[tuple] = []
            for k, y, (best, words, n) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), kernel.sentences(batch.column(2).to_pylist())):
                packed = lambda x: Counter(r.tobytes() for r in np.round(x * STEPS).astype(np.uint8))
                out += [(k, y, float(m), False, v) for v, m in packed(best).items()] + [(k, y, float(m), True, v) for v, m in packed(words).items()]
                if n > len(best):
                    out.append((k, y, float(n - len(best)), False, bytes(len(kernel.landmarks))))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array([f"{k}" for k in columns[0]], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.bool_()), pa.array(columns[4], pa.binary())], ["k", "y", "m", "word", "x"])

    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        rows_ = sample.mapInArrow(features, "k string, y int, m double, word boolean, x binary").toArrow()
    order = np.lexsort([rows_.column("x").to_numpy(), rows_.column("word").to_numpy(), rows_.column("k").to_numpy()])
    _, of = np.unique(rows_.column("k").to_numpy()[order].astype(str), return_inverse=True)
    y, m, word = (rows_.column(c).to_numpy()[order] for c in ("y", "m", "word"))
    x = np.frombuffer(b"".join(rows_.column("x").to_numpy()[order]), np.uint8).reshape(len(of), len(kernel.landmarks)).astype(np.float32) / STEPS
    gram = kernel.values(kernel.landmarks).astype(float)
    gram = (gram + gram.T) / 2
    value, vector = np.linalg.eigh(gram)
    whiten = vector @ np.diag(1 / np.sqrt(np.maximum(value, 0.05))) @ vector.T
    s = np.flatnonzero(~word)  # sentences
    z = x[s] @ whiten
    # at first those sentences of toxic documents are toxic that come nearest to a telling stem
    near = x[s][:, : kernel.stems].max(1)
    nearest = np.zeros(of.max() + 1)
    np.maximum.at(nearest, of[s], near)
    bad, w = (y[s] == 1) & (near >= np.minimum(nearest[of[s]], 0.9)) & (near >= CLOSE), None
    if not bad.any():
        bad = y[s] == 1
    for _ in range(12):
        weight = np.where(bad, 0.5 / max(1, m[s][bad].sum()), 0.5 / max(1, m[s][~bad].sum())) * m[s] * COST
        w = fit_svm(z, np.where(bad, 1.0, -1.0), weight)
        margin = z @ w[:-1] + w[-1]
        worst = np.full(of.max() + 1, -np.inf)
        np.maximum.at(worst, of[s], margin)
        new = (y[s] == 1) & (near >= CLOSE) & ((margin > 0) | (margin >= worst[of[s]] - 1e-12))
        if (new == bad).all():
            break
        bad = new
    margin, some = x @ (whiten @ w[:-1]) + w[-1], x.any(1)
    documents, truth = [], []
    for spots in np.split(np.arange(len(of)), np.flatnonzero(np.diff(of)) + 1):
        sentence = spots[~word[spots]]
        known, words_ = sentence[some[sentence]], spots[word[spots]]
        documents.append(of_document(np.repeat(margin[known], m[known].astype(int)), np.repeat(margin[words_], m[words_].astype(int)), float(w[-1]), m[sentence].sum()))
        truth.append(y[spots[0]])
    return Model(kernel, whiten, w, fit_logistic(np.array(documents), np.array(truth), min(max(share, 0.02), 0.98)))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Adds the score (0 to 1, higher: likelier toxic) of each whole text; null and empty texts are scored as empty.

    All columns stay; the column `out` must be new. Repeated rows stay rows.
    """
    if out in docs.columns:
        raise ValueError(f"column {out} is there already")
    at, schema = docs.columns.index(text), StructType([*docs.schema.fields, StructField(out, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            scores = model.score([t or "" for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def held_out(key: str) -> Column:
    """Rows that no label may be learnt from: crc32 of the key as text, mod 3, is 1."""
    return F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: the key, held_out, score, predicted (1 if score >= threshold), from a model fitted on rows not held out."""
    model = train(docs, labels.filter(~held_out(key)), text, key, label)
    out = score(only(docs, key, text).toDF("k", "t"), model, "t")
    return out.select(F.col("k").alias(key), held_out("k").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, that score below the threshold."""
    model = train(docs, labels.filter(~held_out(key)), text, key, label)
    return score(docs, model, text, "__score").filter(F.col("__score") < threshold).drop("__score")
