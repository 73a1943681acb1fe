"""Toxic texts by a support vector machine over a subsequence string kernel with Nyström landmarks.

The kernel counts the subsequences of three characters that two words share, each weighed down by the gaps it spans, so
``i.d.i.o.t`` and ``idiiot`` stay close to ``idiot``. Landmarks are words that mark toxic training texts. A sentence is
described by its words' greatest kernel value with each landmark, mapped by the inverse root of the landmarks' own
kernel matrix, and a linear machine on that map is trained on sentences of labelled texts: of each toxic text the one
closest to a landmark, of each clean text the closest too, as the hardest to tell apart. A text scores as its worst
sentence.

Training reads a bounded sample of labelled rows; scoring is a map over all texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import fresh

ORDER = 3
DECAY = 0.7
# The normalised kernel is raised to this power, which is a kernel too and parts close words more clearly.
POWER = 3
THRESHOLD = 0.7
# Labelled training rows that are looked at, at most; the seeded hash of the id chooses them.
SAMPLE = 6_000
LANDMARKS = 32
# Strings that are looked at closely on the way to the landmarks, and the lengths of stems among them.
CANDIDATES = 2_000
STEMS = (4, 5, 6)
# A landmark is at least so many times more frequent in toxic training texts than in clean ones, and in this share of them.
MIN_RATIO = 15.0
MIN_SHARE = 0.01
# Words are compared in stretches of this many characters that overlap by half, so long ones are covered whole.
STRETCH = 32
# Part of a landmark's characters that a word must have in order for its kernel value to count; below it counts as zero.
SHARED = 0.85
# Words that a task remembers at most; beyond it the memory starts anew.
MEMORY = 400_000
SEED = 42
# Sentences keep their last mark, so that their words are those of the whole text.
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
# Left off both ends of a word; inside a word they are gaps.
_EDGES = ".,;:!?\"'()[]{}<>«»“”„‘’-–—*_~|/\\#%&$"


def kernel(words: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The subsequence kernel of each of ``words`` with each of ``marks``, rows of code points padded with zeros.

    The recurrence runs over characters and is vectorised over all pairs.
    """
    n, m = len(words), len(marks)
    width, across = words.shape[1], marks.shape[1]
    same = (words[:, None, :, None] == marks[None, :, None, :]) & (marks != 0)[None, :, None, :]
    ahead = np.ones((n, m, width + 1, across + 1), np.float32)
    square = np.float32(DECAY * DECAY)
    for _ in range(ORDER - 1):
        now = np.zeros_like(ahead)
        for i in range(width):
            run = np.zeros((n, m), np.float32)
            for j in range(across):
                run = DECAY * run + square * ahead[:, :, i, j] * same[:, :, i, j]
                now[:, :, i + 1, j + 1] = DECAY * now[:, :, i, j + 1] + run
        ahead = now
    return square * (ahead[:, :, :-1, :-1] * same).sum(axis=(2, 3))


def codes(words: list[str], width: int) -> np.ndarray:
    """Code points of words of at most ``width`` characters, padded with zeros."""
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)


def in_order(words: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """How many characters of ``mark`` each of ``words`` has in order: the longest common subsequence, a bit per character."""
    mark = mark[mark != 0]
    places = {int(c): np.uint64(sum(1 << int(k) for k in np.flatnonzero(mark == c))) for c in np.unique(mark)}
    free = np.full(len(words), np.uint64((1 << len(mark)) - 1))
    for column in words.T:
        hits = np.zeros(len(words), np.uint64)
        for c, bits in places.items():
            hits[column == c] = bits
        hits &= free
        free = (free + hits) | (free - hits)
    return len(mark) - np.bitwise_count(free & np.uint64((1 << len(mark)) - 1)).astype(np.int64)


def _letters(found: np.ndarray) -> np.ndarray:
    """The characters of each word as bits."""
    bits = np.where(found > 0, np.uint64(1) << (found % 61).astype(np.uint64), np.uint64(0))
    return np.bitwise_or.reduce(bits, axis=1)


def _self_kernel(found: np.ndarray) -> np.ndarray:
    return np.array([kernel(w[None, :], w[None, :])[0, 0] for w in found], np.float32)


def _stretches(word: str) -> list[str]:
    """What is compared of a word: itself without its edges, its letters alone if other characters part them, its stem."""
    bare = word.strip(_EDGES)
    forms = [bare] if bare.isalpha() else [bare, "".join(filter(str.isalpha, bare))]
    forms += [bare[: STEMS[-1]]] if len(bare) > STEMS[-1] + 1 else []
    half = STRETCH // 2
    return [f[k : k + STRETCH] for f in forms if len(f) >= ORDER for k in range(0, max(1, len(f) - half), half)]


class Kernels:
    """Normalised kernel values of words with the landmarks, remembered by word."""

    def __init__(self, landmarks: list[str]) -> None:
        self.landmarks = landmarks
        self._marks = codes(landmarks, max(map(len, landmarks)))
        self._own = np.sqrt(_self_kernel(self._marks))
        self._need = np.ceil(SHARED * (self._marks != 0).sum(axis=1)).astype(np.int64)
        self._letters = _letters(self._marks)
        # How many of a landmark's distinct letters can be missing: no more than characters can.
        self._present = np.bitwise_count(self._letters).astype(np.int64) - ((self._marks != 0).sum(axis=1) - self._need)
        self._seen: set[str] = set()
        self.near: dict[str, np.ndarray] = {}

    def __reduce__(self) -> tuple:
        return Kernels, (self.landmarks,)

    def matrix(self) -> np.ndarray:
        return (kernel(self._marks, self._marks) / np.outer(self._own, self._own)) ** POWER

    def learn(self, words: set[str]) -> None:
        """Computes the words that aren't known yet; those with a value are in ``near``."""
        new = words - self._seen
        if new and len(self._seen) + len(new) > MEMORY:
            self._seen, self.near, new = set(), {}, words
        self._seen |= new
        parts = sorted(((w, s) for w in new for s in _stretches(w)), key=lambda p: (len(p[1]), p))
        for at in range(0, len(parts), 8192):
            some = parts[at : at + 8192]
            self._values(some, codes([s for _, s in some], len(some[-1][1])))

    def _values(self, parts: list[tuple[str, str]], found: np.ndarray) -> None:
        shared = np.bitwise_count(_letters(found)[:, None] & self._letters[None, :]) >= self._present
        rows = np.flatnonzero(shared.any(axis=1))
        close = np.zeros_like(shared[rows])
        for k, mark in enumerate(self._marks):
            some = np.flatnonzero(shared[rows, k])
            close[some, k] = in_order(found[rows[some]], mark) >= self._need[k]
        keep = np.flatnonzero(close.any(axis=1))
        for row, near in zip(rows[keep], close[keep]):
            cut = found[row : row + 1, : int((found[row] != 0).sum())]
            value = np.where(near, kernel(cut, self._marks)[0] / (np.sqrt(_self_kernel(cut)[0]) * self._own), 0) ** POWER
            word = parts[row][0]
            self.near[word] = np.maximum(self.near.get(word, 0), value)

    def sentences(self, texts: list[str | None]) -> list[list[np.ndarray]]:
        """For each text the descriptions of its sentences that have a word near a landmark."""
        found = []
        for at in range(0, len(texts), 256):
            low = [(t or "").lower() for t in texts[at : at + 256]]
            parted = [t.split() for t in low]
            spelled = [_spelled(words) for words in parted]
            own = [set(w).union(s) for w, s in zip(parted, spelled)]
            self.learn(set().union(*own))
            for text, more, words in zip(low, spelled, own):
                near = words.intersection(self.near)
                described = []
                for sentence in [*_SENTENCE.split(text), *more] if near else []:
                    if values := [self.near[w] for w in sentence.split() if w in near]:
                        described.append(np.max(values, axis=0))
                found.append(described)
        return found


def _nearness(described: np.ndarray) -> tuple[float, float]:
    """How close a sentence comes to any landmark, and of equally close ones to all of them."""
    return round(float(described.max()), 2), float(described.sum())


def _spelled(words: list[str]) -> list[str]:
    """Words made of runs of four or more single characters, as in ``i d i o t``."""
    if list(map(len, words)).count(1) < 4:
        return []
    found, run = [], []
    for w in [*words, ""]:
        if len(w) == 1:
            run.append(w)
        else:
            if len(run) >= 4:
                found.append("".join(run))
            run = []
    return found


@dataclass
class Model:
    """Landmark kernels, the Nyström map folded into the machine's weights, and a sigmoid for its margin."""

    kernels: Kernels | None
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """From 0 to 1, higher if toxic is likelier. Texts without anything near a landmark share one low score."""
        margin = np.full(len(texts), self.bias)
        if self.kernels is not None:
            for k, described in enumerate(self.kernels.sentences(texts)):
                margin[k] += max([0.0, *(float(x @ self.weights) for x in described)])
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 3000) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, classes weighed alike, by accelerated gradient steps. ``y`` is -1 or 1."""
    one = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    rate = 1.0 / (2 * np.linalg.norm(one.T * np.sqrt(share), 2) ** 2 + penalty)
    w = ahead = np.zeros(one.shape[1])
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (one @ ahead))
        grad = -2 * one.T @ (share * y * slack) + penalty * np.append(ahead[:-1], 0)
        new = ahead - rate * grad
        ahead, w = new + t / (t + 3) * (new - w), new
    return w[:-1], float(w[-1])


def _sigmoid(margin: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Slope and shift of the probability for a margin, by Newton steps on smoothed targets."""
    good, bad = (y > 0).sum(), (y < 0).sum()
    goal = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    z, at = np.stack([margin, np.ones_like(margin)], axis=1), np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ at, -30, 30)))
        step = np.linalg.solve(z.T * (p * (1 - p)) @ z + 1e-6 * np.eye(2), z.T @ (p - goal))
        at = at - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(at[0]), float(at[1])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels training never sees; a NULL id has no label and isn't one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``text`` and ``toxic`` of at most ``sample`` labelled ids, those with the least seeded hash.

    An id that several rows have counts once, with the least of their texts, so there are no more rows than ids.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id")
    # At most ``sample`` pairs of numbers, hence small enough for every executor at any size of the tables.
    small = F.broadcast(chosen.limit(sample))
    found = docs.select("doc_id", "text").join(small, "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def _beginnings(word: Column) -> Column:
    """A word and its stems: its first characters, for languages that inflect."""
    return F.array(word, *[F.left(word, F.lit(n)) for n in STEMS])


def landmarks(rows: DataFrame, count: int = LANDMARKS) -> list[str]:
    """Words and stems of many toxic training texts and few clean ones, the most telling first.

    Texts are counted twice. The first count gives at most ``CANDIDATES`` strings of ``ORDER + 1`` to ``STRETCH`` characters;
    if more are in ``MIN_SHARE`` of the toxic texts, that share is doubled until no more are. In the second, a string counts once for
    each text that is the first with some word before it, so that neither the common words of many copies of one toxic
    text nor those of one long text look telling. Of two strings of which one begins the other the more frequent stays,
    or the longer. At most ``CANDIDATES`` strings come to the driver.
    """
    sizes = rows.agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n")).first()
    bad, good = sizes["bad"] or 0, (sizes["n"] or 0) - (sizes["bad"] or 0)
    if not bad or not good:
        return []

    def telling(counts: DataFrame, share: float = MIN_SHARE) -> DataFrame:
        ratio = (F.col("bad") / bad) / ((F.col("good") + 0.5) / good)
        enough = F.col("bad") >= F.greatest(F.lit(3.0), F.lit(share * bad))
        return counts.filter(enough & (ratio >= MIN_RATIO)).orderBy(F.col("bad").desc(), F.length("word").desc(), "word")

    parted = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+")
    parts = rows.select("doc_id", "toxic", parted.alias("words"))
    own = F.array_distinct(F.flatten(F.transform(F.array_distinct("words"), _beginnings)))
    seen = parts.select("toxic", F.explode(own).alias("word")).filter(F.length("word").between(ORDER + 1, STRETCH))
    counts = seen.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    known, share = list(range(CANDIDATES + 1)), MIN_SHARE
    while len(known) > CANDIDATES:
        known = [r["word"] for r in telling(counts, share).limit(CANDIDATES + 1).collect()]
        share *= 2
    pairs = F.arrays_zip(F.slice("words", 2, F.size("words")).alias("word"), F.col("words").alias("before"))
    near = parts.select("doc_id", "toxic", F.explode(pairs).alias("p")).select("doc_id", "toxic", "p.before", F.explode(_beginnings(F.col("p.word"))).alias("word"))
    firsts = near.filter(F.col("word").isin(known)).groupBy("word", "before").agg(F.min(F.struct("doc_id", "toxic")).alias("first"))
    texts = firsts.groupBy("word", "first.doc_id").agg(F.max("first.toxic").alias("toxic"))
    spread = texts.groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    chosen: dict[str, int] = {}
    for row in telling(spread).collect():
        word, n = row["word"], row["bad"]
        related = [c for c in chosen if c.startswith(word) or word.startswith(c)]
        # A whole word nearly as frequent as its stem says more than the stem.
        if len(related) == 1 and word.startswith(related[0]) and n >= 0.9 * chosen[related[0]]:
            del chosen[related[0]]
            related = []
        if not related:
            chosen[word] = n
    return list(chosen)[:count]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, count: int = LANDMARKS) -> Model:
    """The model from at most ``sample`` labelled rows.

    The driver sees the landmarks and a description of one sentence for each training row. Without toxic and clean
    training rows, or without a telling word, nothing scores as toxic.
    """
    rows = training_rows(docs, labels, sample)
    marks = landmarks(rows, count)
    if not marks:
        return Model(None, np.zeros(0), -1.0, 1.0, -4.0)
    kernels = Kernels(marks)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = kernels.sentences(batch["text"].tolist())
            worst = [max(f, key=_nearness, default=np.zeros(len(marks))) for f in found]
            yield pd.DataFrame({"toxic": batch["toxic"].astype("int32"), "x": [x.astype(float).tolist() for x in worst]})

    found = rows.select("text", "toxic").mapInPandas(describe, "toxic int, x array<double>").toPandas()
    x, y = np.array(found["x"].tolist(), float), np.where(found["toxic"] > 0, 1.0, -1.0)
    # Map by the inverse root of the landmarks' kernel matrix, then fold the map into the weights.
    values, vectors = np.linalg.eigh(kernels.matrix().astype(float))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    w, bias = _svm(x @ root, y)
    slope, shift = _sigmoid(x @ root @ w + bias, y)
    return Model(kernels, root @ w, bias, slope, shift)


def scores(model: Model, text: Column) -> Column:
    """The score of each whole text as a column."""

    @F.pandas_udf(T.DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.scores(batch.tolist()))

    return scored(text)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for each row of ``docs``.

    Only the text is scored. NULL and empty texts get the lowest score; repeated rows are scored alike; a NULL id is
    kept and never trains; an empty table gives no row; other columns are not looked at.
    """
    model = train(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scores(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that don't score as toxic, all columns unchanged."""
    (score,) = fresh(docs, "_score")
    scored = docs.withColumn(score, scores(train(docs, labels), F.col("text")))
    return scored.filter(F.col(score) < threshold).select(*[f"`{c}`" for c in docs.columns])
