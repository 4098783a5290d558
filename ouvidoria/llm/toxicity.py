"""Toxicity by class-conditional Kneser-Ney models.

Expressions are words, spelt as characters between a start and an end mark. Two models, of toxic and of ordinary texts,
have their own counts for the longest n-grams; what they leave over is given out by backoff models of lower orders whose
continuation counts both classes share, so that rare expressions say little either way and inflected forms of a toxic
stem still count. A text is compared by its length-normalised log-likelihood ratio: over its most toxic words, over the
most toxic run of words, and over the whole. A logistic fit on the training texts turns the three into a score.

The n-gram tables come from a bounded sample of labelled rows; their counts are gathered by Spark, over distinct words.

Defined results: null and empty texts have no evidence and get the score of none; without labels of both kinds every
score is the share of label 1 (0 if there are none); rows that repeat a doc_id are scored each; texts of any length are
scored whole; equal evidence gives equal scores; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ouvidoria.llm.common import fold, staged, text_or_empty

# Labelled rows of each class that are fitted at most, chosen by a hash of their ids.
TRAIN_TOXIC = 2000
TRAIN_ORDINARY = 4000
ORDER = 8
# What is taken from counts of one, two, and three or more; rare n-grams are left to the shared backoff.
DISCOUNTS = (0.0, 1.0, 1.6, 2.2)
SHARED_DISCOUNT = 0.75
RUN = 8
TOP = 3
REMEMBERED = 300_000
START, END = "\x02", "\x03"

_WORDS = regex.compile(r"[\p{L}\p{M}\p{N}']+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def word_counts(docs: DataFrame) -> DataFrame:
    """(toxic, word, docs) over rows (text, toxic); every task counts its own words first."""

    def run(frames):
        for frame in frames:
            own: dict[tuple[int, str], int] = defaultdict(int)
            for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
                for w in set(words_of(text)):
                    own[toxic, w] += 1
            yield pd.DataFrame([(*k, n) for k, n in own.items()], columns=["toxic", "word", "docs"])

    counted = docs.mapInPandas(run, "toxic int, word string, docs long")
    return counted.groupBy("toxic", "word").agg(F.sum("docs").alias("docs"))


def ngram_counts(words: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, toxic, ordinary): n-grams of ``order`` characters, shorter at a word's start, by class.

    A word counts once per text, so that a text that repeats itself speaks no louder.
    """
    spelt = words.withColumn("s", F.concat(F.lit(START), "word", F.lit(END)))
    ends = F.sequence(F.lit(2), F.length("s"))
    grams = F.transform(ends, lambda e: F.substring(F.col("s"), F.greatest(F.lit(1), e - order + 1), F.least(e, F.lit(order))))
    cut = spelt.select("toxic", "docs", F.explode(grams).alias("gram"))
    return cut.groupBy("gram").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("docs")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") == 0, F.col("docs")).otherwise(0)).alias("ordinary"),
    )


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _codes(text: str) -> np.ndarray:
    """Characters as numbers from one on; zero is no character."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


def _hashes(rows: np.ndarray) -> np.ndarray:
    """One number for each row of characters; zeros before them change nothing."""
    h = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        h = h * _BASE + column
    return h


def _aligned(grams: list[str], order: int) -> np.ndarray:
    """A row of ``order`` characters for each n-gram, zeros first."""
    lengths = np.fromiter(map(len, grams), np.int64, len(grams))
    out = np.zeros((len(grams), order), np.uint32)
    row = np.repeat(np.arange(len(grams)), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, order - lengths[row] + place] = _codes("".join(grams))
    return out


def _found(keys: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``sought`` among sorted ``keys``, and which of them are there."""
    if not len(keys):
        return np.zeros(len(sought), np.int64), np.zeros(len(sought), bool)
    at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
    return at, keys[at] == sought


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys, the place of each row's key among them, and sums of ``values`` by key."""
    distinct, of = np.unique(keys, return_inverse=True)
    return distinct, of, [np.bincount(of, v, len(distinct)) for v in values]


def shared_backoff(rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted hashes, probabilities) of the n-grams of each length below the longest, by continuation counts.

    An n-gram counts by how many longer ones of either class end in it.
    """
    order = rows.shape[1]
    lengths = (rows > 0).sum(axis=1)
    levels, longer = [], np.zeros((0, order), np.uint32)
    for k in range(order, 0, -1):
        ends = longer.copy()
        ends[:, order - k - 1] = 0
        level, own = np.concatenate([ends, rows[lengths == k]]), np.r_[np.ones(len(ends)), np.zeros((lengths == k).sum())]
        hashes, one, of = np.unique(_hashes(level), return_index=True, return_inverse=True)
        longer = level[one]
        if k < order:
            shorter = longer.copy()
            shorter[:, order - k] = 0
            levels.append((hashes, np.bincount(of, own, len(hashes)), _hashes(longer[:, :-1]), _hashes(shorter)))
    known, out = (np.zeros(1, np.uint64), np.array([1e-4])), []
    for hashes, n, context, shorter in reversed(levels):
        _, of, (total, kinds) = _summed(context, n, (n > 0).astype(float))
        total, kinds = total[of], kinds[of]
        lower = known[1][_found(known[0], shorter)[0]]
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.maximum(n - SHARED_DISCOUNT, 0) / total + SHARED_DISCOUNT * kinds / total * lower
        known = hashes, np.where(total > 0, p, lower)
        out.append(known)
    return out


@dataclass
class KneserNey:
    """Log ratio of toxic to ordinary probability for every n-gram that either class has, and how to find the others.

    Tables are sorted hashes and numbers beside them: a few bytes an n-gram, in the driver and in every task.
    """

    grams: np.ndarray
    ratio: np.ndarray
    contexts: np.ndarray
    left: np.ndarray
    order: int = ORDER

    @classmethod
    def fit(cls, rows: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> KneserNey:
        """From n-grams (rows of characters, zeros first) and how often each class has them."""
        order = rows.shape[1]
        lengths = (rows > 0).sum(axis=1)
        lower = np.full(len(rows), 1e-4)
        for k, (hashes, p) in enumerate(shared_backoff(rows), 1):
            mine = np.flatnonzero(lengths == k + 1)
            ends = rows[mine].copy()
            ends[:, order - k - 1] = 0
            lower[mine] = p[_found(hashes, _hashes(ends))[0]]
        discounts = np.array(DISCOUNTS)
        t_off, o_off = (discounts[np.minimum(n, 3).astype(np.int64)] for n in (toxic, ordinary))
        # Of every context: what follows it in toxic and in ordinary texts, and how much of that is left to the backoff.
        contexts, of, (nt, st, no, so) = _summed(_hashes(rows[:, :-1]), toxic, t_off, ordinary, o_off)

        def given(n, off, total, spare):
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.where(total > 0, (n - off + spare * lower) / total, lower)

        ratio = np.log(given(toxic, t_off, nt[of], st[of])) - np.log(given(ordinary, o_off, no[of], so[of]))
        # An n-gram that neither class has gets what both left over of a context: only the shares differ.
        both = (nt > 0) & (no > 0)
        left = np.log(st[both] / nt[both]) - np.log(so[both] / no[both])
        hashes = _hashes(rows)
        sort = np.argsort(hashes)
        return cls(hashes[sort], ratio[sort], contexts[both], left, order)

    def words(self, words: list[str]) -> np.ndarray:
        """Log-likelihood ratios of whole words."""
        spelt = [START + w + END for w in words]
        codes = _codes("".join(spelt))
        lengths = np.fromiter(map(len, spelt), np.int64, len(spelt))
        place = np.arange(len(codes))
        first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        before, whole = np.zeros(len(codes), np.uint64), np.zeros(len(codes), np.uint64)
        for back in range(self.order - 1, -1, -1):
            inside = np.flatnonzero(place - back >= first)
            before[inside] = whole[inside]
            whole[inside] = whole[inside] * _BASE + codes[inside - back]
        at, known = _found(self.grams, whole)
        spare, open_ = _found(self.contexts, before)
        value = np.where(known, self.ratio[at] if len(self.ratio) else 0.0, np.where(open_, self.left[spare] if len(self.left) else 0.0, 0.0))
        value[place == first] = 0.0  # the mark that opens a word is given
        return np.add.reduceat(value, np.cumsum(lengths) - lengths) if len(spelt) else np.zeros(0)


class Reader:
    """Evidence of texts under a model; remembers the ratios of words."""

    def __init__(self, model: KneserNey):
        self.model, self.known = model, {}

    def learn(self, words: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(words.difference(self.known))
        for at in range(0, len(new), 50_000):
            block = new[at : at + 50_000]
            self.known.update(zip(block, self.model.words(block).tolist(), strict=True))

    def evidence(self, words: list[str]) -> tuple[float, float, float]:
        """Mean ratio of the most toxic words, of the most toxic run of words, and of all words."""
        if not words:
            return (0.0, 0.0, 0.0)
        known = self.known
        r = np.array([known[w] for w in words])
        top = np.sort(r)[-TOP:].sum() / TOP
        sums = np.cumsum(np.r_[0.0, r])
        run = min(RUN, len(r))
        return (float(top), float((sums[run:] - sums[:-run]).max() / RUN), float(r.mean()))


@dataclass
class Toxicity:
    model: KneserNey | None
    weights: np.ndarray
    bias: float

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.weights + self.bias, -500, 500)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps; a class weighs as the root of its share, features are scaled meanwhile."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    share = np.where(y == 1, 1 / np.sqrt(max(y.sum(), 1)), 1 / np.sqrt(max((1 - y).sum(), 1)))
    share = share / share.sum()
    w = np.zeros(z.shape[1])
    penalty = ridge * np.diag([*np.ones(x.shape[1]), 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + penalty + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (share * (p - y)) + penalty @ w)
        w = w - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / scale, float(w[-1] - (w[:-1] * mean / scale).sum())


def evidence_frame(docs: DataFrame, model: KneserNey, keep: str) -> DataFrame:
    """``keep`` (name and type) with the evidence of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name, kind = keep.split()

    def run(frames):
        reader = Reader(shared.value)
        for frame in frames:
            rows = []
            # Two hundred texts at a time: the words that are new are looked up together.
            for at in range(0, len(frame), 200):
                texts = [words_of(t) for t in frame["text"].iloc[at : at + 200]]
                reader.learn(set().union(*texts))
                rows += [reader.evidence(words) for words in texts]
            out = pd.DataFrame(rows, columns=["top", "run", "mean"], dtype=float)
            out.insert(0, name, frame[name].astype("Int64").array)
            yield out

    return docs.select(name, text_or_empty().alias("text")).mapInPandas(run, f"{name} {kind}, top double, run double, mean double")


def sample(docs: DataFrame, labels: DataFrame, usable: Column, toxic: int, ordinary: int) -> DataFrame:
    """(doc_id, text, toxic, half): up to so many labelled documents of each class."""
    fine = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & usable)
    order = (F.xxhash64("doc_id"), "doc_id")
    picked = [
        fine.filter(F.col("toxic") == kind).select("doc_id", F.col("toxic").cast("int").alias("toxic")).orderBy(*order).limit(n)
        for kind, n in ((1, toxic), (0, ordinary))
    ]
    ids = picked[0].union(picked[1]).distinct().select(F.col("doc_id").alias("_id"), "toxic")
    # The number of sampled rows is bounded by the two parameters, so they may be broadcast.
    joined = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
    return joined.select("doc_id", "text", "toxic", (F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(3)) == 0).alias("half"))


def _model(spark: SparkSession, rows: DataFrame) -> KneserNey:
    words = staged(word_counts(rows.select("text", "toxic")), "toxic-words")
    # Words of a single document stay: discounts and continuation counts weaken them, and what they share still counts.
    table = ngram_counts(words).orderBy("gram").toArrow()
    rows = [_aligned(b.column("gram").to_pylist(), ORDER) for b in table.to_batches(max_chunksize=100_000)]
    counts = [table.column(c).to_numpy().astype(float) for c in ("toxic", "ordinary")]
    return KneserNey.fit(np.concatenate(rows) if rows else np.zeros((0, ORDER), np.uint32), *counts)


def train(
    docs: DataFrame, labels: DataFrame, usable: Column, toxic: int = TRAIN_TOXIC, ordinary: int = TRAIN_ORDINARY
) -> Toxicity:
    """n-gram models from two thirds of the sample; the logistic fit is made on the rest, which the models haven't seen."""
    spark = docs.sparkSession
    rows = staged(sample(docs, labels, usable, toxic, ordinary), "toxic-sample")
    seen = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not seen.get(0) or not seen.get(1):
        share = 1.0 if seen.get(1) else 0.0
        return Toxicity(None, np.zeros(3), 500.0 if share else -500.0)
    both = [set(r["k"]) for r in rows.groupBy("half").agg(F.collect_set("toxic").alias("k")).collect()]
    apart = len(both) == 2 and all(len(k) == 2 for k in both)
    model = _model(spark, rows.filter(~F.col("half")) if apart else rows)
    tune = (rows.filter("half") if apart else rows).withColumn("toxic", F.col("toxic").cast("long"))
    known = evidence_frame(tune, model, "toxic long").toPandas().to_numpy(float)
    weights, bias = logistic(known[:, 1:], known[:, 0])
    return Toxicity(model, weights, bias)


def toxicity_scores(docs: DataFrame, labels: DataFrame, divisor: int = 5, held: int = 0, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; rows of the held-out fold teach nothing."""
    fitted = train(docs, labels, fold(divisor) != held, **options)
    if fitted.model is None:
        found = docs.select("doc_id", F.lit(float(fitted.bias > 0)).alias("score"))
    else:
        rows = evidence_frame(docs, fitted.model, "doc_id long")
        names = ("top", "run", "mean")
        total = sum((F.col(c) * float(w) for c, w in zip(names, fitted.weights, strict=True)), F.lit(fitted.bias))
        found = rows.select("doc_id", (F.lit(1.0) / (F.lit(1.0) + F.exp(-total))).alias("score"))
    return found.select(
        "doc_id",
        (fold(divisor) == held).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
