"""Language identification by error-correcting output codes.

Every language has a codeword; for every bit a binary classifier over hashed byte n-grams tells the languages with a one
from those with a zero. The classifiers are log-odds of smoothed n-gram counts, which are gathered per language by Spark
and reach the driver as one row per language and hash bucket. Decoding is loss-weighted: a language's loss is the sum of
the logistic losses of its bits, the smallest loss wins, and a near tie is flagged as ambiguous.

Defined results: ``und`` with score 0 where the text is null or has no letter, or where nothing was learned; a single
learned language is predicted everywhere else; rows that repeat a doc_id are predicted each; texts of any length are read
whole; equal losses go to the language that comes first by name; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ouvidoria.llm.common import fold

UNKNOWN = "und"
BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
# Training documents of a language at most, chosen by a hash of their ids, and the number of bits of a codeword at least.
TRAIN_PER_LANGUAGE = 2000
BITS = 15
# Codewords differ in this many bits at least.
APART = 4
# A runner-up this close to the winner's probability makes a prediction ambiguous.
MARGIN = 0.2

_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def codewords(languages: int, bits: int = BITS, seed: int = 7) -> np.ndarray:
    """A matrix of +1 and -1, one row per language: of many random draws the one whose closest rows differ most."""
    if languages < 2:
        return np.ones((languages, bits))
    rng = np.random.default_rng(seed)
    best, widest = None, -1
    for _ in range(300):
        draw = rng.choice([-1.0, 1.0], size=(languages, bits))
        same = np.abs(draw.sum(axis=0)) == languages
        draw[0, same] *= -1.0  # a column must tell some languages apart
        apart = (bits - draw @ draw.T) / 2
        np.fill_diagonal(apart, bits)
        if apart.min() > widest:
            best, widest = draw, apart.min()
    return best


def distance(codes: np.ndarray) -> int:
    """In how many bits the closest two rows differ."""
    apart = (codes.shape[1] - codes @ codes.T) / 2
    np.fill_diagonal(apart, codes.shape[1])
    return int(apart.min(initial=codes.shape[1]))


def enough_codewords(languages: int, bits: int = BITS) -> np.ndarray:
    """Codewords of ``bits`` bits, or of as many more as that number of languages needs to stay ``APART``."""
    bits = max(bits, 4 * max(0, languages - 1).bit_length())
    codes = codewords(languages, bits)
    while languages > 1 and distance(codes) < APART:
        bits += 4
        codes = codewords(languages, bits)
    return codes


def grams(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """How often each hash bucket occurs among the byte n-grams of the folded text."""
    folded = f" {_OTHER.sub(' ', text.lower()).strip()} ".encode()
    data = np.frombuffer(folded, np.uint8).astype(np.uint32)
    out = np.zeros(buckets, np.int64)
    shift = np.uint32(33 - buckets.bit_length())
    code = np.zeros(len(data), np.uint32)
    for k in range(max(ORDERS)):
        code = (code[: len(data) - k] << np.uint32(8)) + data[k:]
        if k + 1 in ORDERS:
            hashed = (code + np.uint32(k * 0x51ED270B & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
            out += np.bincount(hashed >> shift, minlength=buckets)
    return out


def gram_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(lang, bucket, n) over all rows of (lang, text): every task sums its own before the shuffle."""

    def run(frames):
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for lang, part in frame.groupby("lang"):
                own = sums.setdefault(lang, np.zeros(buckets, np.int64))
                for text in part["text"]:
                    own += grams(text, buckets)
        for lang, own in sums.items():
            seen = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "bucket": seen, "n": own[seen]})

    counted = docs.select("lang", "text").mapInPandas(run, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class OutputCodes:
    languages: list[str]
    codes: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits

    @classmethod
    def fit(cls, languages: list[str], counts: np.ndarray, bits: int = BITS) -> OutputCodes:
        """Log-odds of each bit from counts (languages x buckets); languages count alike, however many texts they have."""
        codes = enough_codewords(len(languages), bits)
        share = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * counts.shape[1])
        ones, zeros = (codes.T > 0).astype(float), (codes.T < 0).astype(float)
        p = (ones @ share) / np.maximum(ones.sum(axis=1, keepdims=True), 1)
        q = (zeros @ share) / np.maximum(zeros.sum(axis=1, keepdims=True), 1)
        both = (ones.any(axis=1) & zeros.any(axis=1))[:, None]
        odds = np.where(both, np.log(np.maximum(p, 1e-12)) - np.log(np.maximum(q, 1e-12)), codes[0][:, None] if len(codes) else 0.0)
        return cls(languages, codes, odds.T.astype(np.float32))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, probability and the ambiguity flag of every text."""
        langs = [UNKNOWN] * len(texts)
        score, unsure = np.zeros(len(texts)), np.zeros(len(texts), bool)
        known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        if not self.languages:
            return langs, score, unsure
        for at in range(0, len(known), 128):
            some = known[at : at + 128]
            counts = np.stack([grams(texts[i], len(self.weights)) for i in some]).astype(np.float32)
            # Evidence grows with the root of the length, as n-grams of a text aren't independent.
            margin = (counts @ self.weights).astype(float) / np.sqrt(counts.sum(axis=1, keepdims=True))
            loss = np.logaddexp(0.0, -margin[:, None, :] * self.codes[None]).sum(axis=2)
            odds = np.exp(loss.min(axis=1, keepdims=True) - loss)
            odds /= odds.sum(axis=1, keepdims=True)
            best = odds.argmax(axis=1)
            top = odds[np.arange(len(some)), best]
            rest = np.where(np.arange(odds.shape[1]) == best[:, None], 0.0, odds).max(axis=1)
            for k, i in enumerate(some):
                langs[i], score[i], unsure[i] = self.languages[best[k]], top[k], top[k] - rest[k] < MARGIN
        return langs, score, unsure


def sampled(ids: DataFrame, per_language: int) -> DataFrame:
    """The first ``per_language`` rows of (doc_id, lang) of each language by a hash of the id.

    Rows are counted per range of hashes first, so only those up to the range that fills the sample are ordered.
    """
    hashed = ids.filter(F.col("doc_id").isNotNull()).withColumn("place", F.shiftright(F.xxhash64("doc_id"), 52))
    counts = hashed.groupBy("lang", "place").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begun = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    needed = begun.filter(F.col("before") < per_language).select("lang", "place")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    first = hashed.join(needed, ["lang", "place"], "left_semi").withColumn("r", F.row_number().over(order))
    return first.filter(F.col("r") <= per_language).select("doc_id", "lang")


def train(docs: DataFrame, usable: Column, per_language: int = TRAIN_PER_LANGUAGE, bits: int = BITS) -> OutputCodes:
    """Learn from up to ``per_language`` whole texts of each language among ``usable`` rows."""
    fine = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & usable).select("doc_id", "lang", "text")
    picked = sampled(fine.select("doc_id", "lang"), per_language)
    ids = picked.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct()
    sample = fine.join(ids, (F.col("doc_id") == F.col("_id")) & (F.col("lang") == F.col("_lang")), "left_semi")
    rows = gram_counts(sample).toPandas()
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS))
    counts[np.searchsorted(languages, rows["lang"]) if len(rows) else [], rows["bucket"].to_numpy(int)] = rows["n"]
    return OutputCodes.fit(languages, counts, bits)


def predictions(docs: DataFrame, model: OutputCodes) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of every row, from the whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames):
        for frame in frames:
            langs, score, unsure = shared.value.predict([t if isinstance(t, str) else None for t in frame["text"]])
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"].astype("Int64"), "lang_pred": langs, "score": score, "ambiguous": unsure}
            )

    schema = "doc_id long, lang_pred string, score double, ambiguous boolean"
    return docs.select("doc_id", "text").mapInPandas(run, schema)


def identify(docs: DataFrame, divisor: int = 5, held: int = 0, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous; rows of the held-out fold teach nothing."""
    model = train(docs, fold(divisor) != held, **options)
    found = predictions(docs, model)
    return found.select("doc_id", (fold(divisor) == held).alias("held_out"), "lang_pred", "score", "ambiguous")
