"""Quality classifier by a sparse rule ensemble.

Statistics of every text are Spark expressions. Small trees are boosted on a bounded sample of labelled rows; each path
from the root of a tree is a conjunctive rule over statistics. A lasso logistic fit leaves few rules with weights, and
those are compiled into one Spark column expression, so that scoring is a projection over whole texts.

Defined results: null and empty texts have all statistics zero and are scored like others; without labels of both kinds
every score is the share of label 1 (0.5 if there are none); rows that repeat a doc_id are scored each; labels that are
null or have no document teach nothing; texts of any length are measured whole; equal statistics give equal scores; other
columns are not read by scores and are returned as they are by ``good_documents``; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouvidoria.llm.common import SPACES, WORD, fold, text_or_empty, whole_row

# Labelled rows that are fitted at most; the share of each label stays as it is.
TRAIN_ROWS = 8000
TREES = 24
DEPTH = 3
PENALTY = 0.002

MARKS = r"[^#$%&*!|<>{}=~^@_+\\]+"


def statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the statistics of the text, each found once per row."""
    text = text_or_empty()
    # One pass leaves what isn't a letter or white space; the counts of marks are taken on that short rest.
    base = docs.select(
        *keep,
        F.length(text).alias("chars"),
        F.regexp_replace(text, r"[\p{L}\s]+", "").alias("signs"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).alias("upper"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))).alias("breaks"),
        F.filter(F.split(text, SPACES), lambda w: w != "").alias("words"),
    )
    counted = base.select(
        *keep,
        "chars",
        "upper",
        "breaks",
        F.length("signs").alias("signs"),
        F.length(F.regexp_replace("signs", MARKS, "")).alias("marks"),
        F.length(F.regexp_replace("signs", r"[^0-9]+", "")).alias("digits"),
        (F.length("signs") - F.length(F.regexp_replace("signs", r"[.?]", ""))).alias("stops"),
        F.size("words").alias("n"),
        F.size(F.array_distinct("words")).alias("distinct"),
        F.aggregate(
            F.zip_with("words", F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))), lambda a, b: a == b),
            F.lit(0),
            lambda s, same: s + F.when(same, 1).otherwise(0),
        ).alias("echoes"),
    )
    words, chars = F.greatest("n", F.lit(1)), F.greatest("chars", F.lit(1))
    return counted.select(
        *keep,
        F.log1p("n").alias("log_words"),
        (F.col("chars") / words).alias("word_chars"),
        (F.col("signs") / chars).alias("sign_share"),
        (F.col("marks") / words).alias("marks_per_word"),
        (F.col("digits") / chars).alias("digit_share"),
        (F.col("stops") / words).alias("stops_per_word"),
        (F.col("upper") / chars).alias("upper_share"),
        (F.col("breaks") / words).alias("breaks_per_word"),
        (F.col("distinct") / words).alias("distinct_share"),
        (F.col("echoes") / words).alias("echo_share"),
    )


FEATURES = (
    "log_words word_chars sign_share marks_per_word digit_share stops_per_word upper_share breaks_per_word "
    "distinct_share echo_share"
).split()

Condition = tuple[int, bool, float]  # feature, above, threshold
Rule = tuple[Condition, ...]


def grow(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, depth: int, least: int = 15) -> list[tuple[Rule, float]]:
    """One regression tree on the gradient; leaves as (conditions, step)."""

    def leaf(rows, path):
        return [(path, float(gradient[rows].sum() / (weight[rows].sum() + 1.0)))]

    def split(rows, path):
        if len(path) == depth or len(rows) < 2 * least:
            return leaf(rows, path)
        best = (1e-6, None, None)
        g, h = gradient[rows], weight[rows]
        whole = g.sum() ** 2 / (h.sum() + 1.0)
        for f in range(x.shape[1]):
            order = np.argsort(x[rows, f], kind="stable")
            v = x[rows[order], f]
            gl, hl = np.cumsum(g[order])[:-1], np.cumsum(h[order])[:-1]
            gain = gl**2 / (hl + 1.0) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1.0) - whole
            place = np.arange(1, len(rows))
            gain[(v[1:] <= v[:-1]) | (place < least) | (len(rows) - place < least)] = -1.0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], f, float((v[k] + v[k + 1]) / 2))
        _, f, cut = best
        if f is None:
            return leaf(rows, path)
        above = x[rows, f] > cut
        return split(rows[~above], (*path, (f, False, cut))) + split(rows[above], (*path, (f, True, cut)))

    return split(np.arange(len(x)), ())


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(x[:, f] > cut) == above for f, above, cut in rule])


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = 0.3) -> list[Rule]:
    """All paths, from the root to inner nodes and leaves, of boosted trees; each rule once."""
    score = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        for path, step in grow(x, y - p, p * (1 - p), depth):
            if not path:
                continue
            score[holds(path, x)] += rate * step
            for k in range(1, len(path) + 1):
                rules[path[:k]] = None
    return list(rules)


def lasso(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, rounds: int = 1500) -> tuple[np.ndarray, float]:
    """Lasso logistic weights by accelerated proximal gradients; the intercept is not penalised."""
    n, m = z.shape
    w, b = np.zeros(m), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    seen, seen_b, t = w.copy(), b, 1.0
    step = 4.0 / max(1e-9, np.linalg.norm(np.c_[z, np.ones(n)], 2) ** 2 / n)
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(z @ seen + seen_b))) - y
        ahead = seen - step * (z.T @ error) / n
        new = np.sign(ahead) * np.maximum(np.abs(ahead) - step * penalty, 0)
        new_b = seen_b - step * error.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        seen, seen_b = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        if np.abs(new - w).max(initial=0) < 1e-7:
            return new, new_b
        w, b, t = new, new_b, t_new
    return w, b


@dataclass
class RuleEnsemble:
    """Rules with weights and an intercept; without rules a constant."""

    rules: list[tuple[Rule, float]]
    intercept: float
    features: tuple[str, ...] = tuple(FEATURES)

    def column(self) -> Column:
        """The ensemble compiled into one expression over the statistics' columns."""

        def condition(f, above, cut):
            c = F.col(self.features[f])
            return c > F.lit(cut) if above else c <= F.lit(cut)

        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            met = reduce(Column.__and__, [condition(*c) for c in rule])
            total = total + F.when(met, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> RuleEnsemble:
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if len(y) else 0.5
        return RuleEnsemble([], float(np.log(share / (1 - share))))
    rules = tree_rules(x, y)
    if not rules:
        return RuleEnsemble([], float(np.log(y.mean() / (1 - y.mean()))))
    z = np.stack([holds(r, x) for r in rules], axis=1).astype(float)
    weights, intercept = lasso(z, y, penalty)
    return RuleEnsemble([(r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6], float(intercept))


def train(docs: DataFrame, labels: DataFrame, usable: Column, train_rows: int = TRAIN_ROWS) -> RuleEnsemble:
    """Fit on up to ``train_rows`` labelled rows, chosen by a hash of their ids.

    ``usable`` says of a label's doc_id whether it may teach. The driver gets ten numbers a row of the sample.
    """
    fine = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & usable)
    sample = (
        fine.select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id", "_y")
        .limit(train_rows)
    )
    # The sample is bounded by its parameter, so it may be broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    data = statistics(rows, ["doc_id", "_y"]).orderBy("doc_id").select("_y", *FEATURES).toPandas().to_numpy(float)
    return fit(data[:, 1:], np.clip(data[:, 0], 0, 1))


def quality_scores(docs: DataFrame, labels: DataFrame, divisor: int = 3, held: int = 1, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; rows of the held-out fold teach nothing."""
    ensemble = train(docs, labels, fold(divisor) != held, **options)
    measured = statistics(docs, ["doc_id"]).withColumn("score", ensemble.column())
    return measured.select(
        "doc_id",
        (fold(divisor) == held).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, divisor: int = 3, held: int = 1, **options) -> DataFrame:
    """The rows of ``docs``, with all columns, that the classifier does not reject."""
    ensemble = train(docs, labels, fold(divisor) != held, **options)
    measured = statistics(docs.select(whole_row(docs), "text"), ["row"]).withColumn("score", ensemble.column())
    return measured.filter("score >= 0.5").select("row.*")
