"""Language-model scoring with a probabilistic suffix tree.

Symbols are the characters of lower-cased words, with marks for a word's start, a word's end and the text's end. The
first symbols of a word also see the end of the word before, which tells the language and the style of a text. The
tree holds contexts of variable length: a context is kept if it is frequent enough and if a divergence test finds that
what follows it differs from what follows the longest kept suffix of it. Next-symbol distributions are smoothed with
those of that suffix, down to a uniform distribution over all characters, so every text has a probability. A symbol is
scored in the state of the longest kept suffix of what it sees.

All counts cover all training documents. Documents are read once, in blocks of about ``BLOCK_TOKENS`` tokens with a
vocabulary of their own; vocabularies, not tokens, are joined with the corpus counts and come back to their block.
Contexts are counted over distinct words, and over distinct pairs of word ends and word starts in each block. The root
keeps every symbol that occurs. A longer context is kept if it holds at least ``P_MIN`` of all symbols, and a symbol in
it ``GAMMA`` of that, so besides the root the tree that is broadcast has at most DEPTH / (P_MIN * GAMMA) entries.

Defined results: null and empty texts are the end alone; rows that repeat a doc_id count and are scored each; without
training documents all counts are 0 and the tree is the uniform distribution.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from itertools import count
from math import log10

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouvidoria.llm.common import fold, staged, text_or_empty

DEPTH = 5
# Characters of the word before that the first, second and third symbol of a word see.
TAILS = (3, 3, 2)
P_MIN = 4e-6
GAMMA = 0.02
# A context stays if its log-likelihood gain over its suffix is this many nats for every symbol that follows it.
GAIN = 2.0
BLOCK_TOKENS = 2_000_000
CHUNK = 200_000
REMEMBERED = 1_000_000
REMEMBERED_GRAMS = 300_000

# Words never hold white space, so these three can mark what isn't a character.
START, END, STOP = " ", "\n", "\t"
UNIFORM = 1.0 / (0x110000 + 2)


# --- the tree ---------------------------------------------------------------------------------------------------------


def spelling(word: str) -> str:
    """Symbols of a word after its start; the empty word is the end of the text."""
    return word + END if word else STOP


def longest_grams(words: list[str], n: np.ndarray, depth: int = DEPTH) -> pd.DataFrame:
    """(gram, n): every symbol of weighted words after up to ``depth`` symbols before it in the word."""
    spelt = [START + spelling(w) for w in words]
    text = "".join(spelt)
    data = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, spelt), np.int64, len(spelt))
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = np.arange(len(data))
    begin = np.maximum(first, place - depth)
    key = np.zeros(len(data), np.uint64)
    for k in range(depth + 1):
        inside = place - k >= begin
        key[inside] = key[inside] * np.uint64(0x9E3779B97F4A7C15) + data[place[inside] - k] + np.uint64(1)
    use = np.flatnonzero(place > first)
    order = use[np.argsort(key[use], kind="stable")]
    edges = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]]) if len(order) else order
    sums = np.add.reduceat(np.repeat(n, lengths)[order], edges) if len(order) else np.zeros(0, np.int64)
    return pd.DataFrame({"gram": [text[begin[i] : i + 1] for i in order[edges].tolist()], "n": sums})


def word_grams(words: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, n) over all distinct words (word, n); several rows of a gram may follow."""

    def run(frames):
        words, n = [], []
        for frame in frames:
            words += frame["word"].tolist()
            n.append(frame["n"].to_numpy(np.int64))
            if len(words) >= CHUNK:
                yield longest_grams(words, np.concatenate(n), depth)
                words, n = [], []
        if words:
            yield longest_grams(words, np.concatenate(n), depth)

    return words.mapInPandas(run, "gram string, n long")


def context_counts(within: DataFrame, across: DataFrame) -> DataFrame:
    """(context, symbol, n) of all contexts, from (gram, n) of the longest ones.

    Grams within a word are cut down to the symbol alone; those that reach into the word before only down to the start.
    """
    longest = [
        grams.groupBy("gram").agg(F.sum("n").alias("n")).withColumn("cuts", cuts)
        for grams, cuts in (
            (within, F.length("gram")),
            (across, F.instr("gram", START) - F.lit(1)),
        )
    ]
    cut = longest[0].union(longest[1]).select("gram", "n", F.explode(F.sequence(F.lit(1), F.col("cuts"))).alias("b"))
    sums = cut.select(F.expr("substring(gram, b)").alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n"))
    return sums.select(
        F.expr("substring(gram, 1, length(gram) - 1)").alias("context"), F.expr("right(gram, 1)").alias("symbol"), "n"
    )


class Joints:
    """Where words meet: numbers for the ends of a block's words, for their starts, and for pairs of the two."""

    def __init__(self, words: list[str], tails: tuple[int, ...] = TAILS):
        spelt = [spelling(w) for w in words]
        self.parts, by_tail = [], {}
        for j, k in enumerate(tails):
            if k not in by_tail:
                ends = defaultdict(count().__next__)
                none = ends[""]
                by_tail[k] = np.array([ends[w[-k:]] for w in words] + [none], np.int64), ends
            end_of, ends = by_tail[k]
            starts = defaultdict(count().__next__)
            start_of = np.array([starts[s[: j + 1]] if len(s) > j else -1 for s in spelt], np.int64)
            self.parts.append((end_of, start_of, list(ends), list(starts)))

    def pairs(self, ids: np.ndarray, before: np.ndarray):
        """For each symbol: the distinct (end, start) strings, how often each occurs, and the pair of every token or -1.

        ``before`` has the word before each token, -1 for none.
        """
        for end_of, start_of, ends, starts in self.parts:
            start = start_of[ids]
            here = start >= 0
            # By a hash table: numbers of the pairs in the order in which they come.
            back, code = pd.factorize(end_of[before[here]] * len(starts) + start[here])
            of = np.full(len(ids), -1, np.int64)
            of[here] = back
            n = np.bincount(back, minlength=len(code))
            yield [(ends[c // len(starts)], starts[c % len(starts)]) for c in code.tolist()], n, of


def outer_letters(word: Column, tails: tuple[int, ...] = TAILS) -> Column:
    """What ``Joints`` reads of a word: its first and last letters; short words stay whole."""
    heads, ends = len(tails), max(tails)
    shortened = F.concat(F.left(word, F.lit(heads)), F.right(word, F.lit(ends)))
    return F.when(F.length(word) > heads + ends, shortened).otherwise(word)


def packed(ids: np.ndarray) -> bytes:
    """Numbers by planes of their bytes, which squeeze better: the high ones are mostly zero."""
    return ids.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def before_each(documents: list[np.ndarray]) -> np.ndarray:
    """The token before each, over documents laid end to end; -1 at their starts."""
    return np.concatenate([np.r_[np.int64(-1), d[:-1].astype(np.int64)] for d in documents])


def frequent(counts: DataFrame, p_min: float = P_MIN, gamma: float = GAMMA) -> DataFrame:
    """Contexts with at least ``p_min`` of all symbols, and what follows them at least ``p_min * gamma`` of the time."""
    total = counts.filter(F.col("context") == "").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    often = counts.groupBy("context").agg(F.sum("n").alias("all")).filter(F.col("all") >= total * p_min)
    # The root knows every symbol it has seen, however rare: there are no more than characters.
    kept = counts.filter((F.col("context") == "") | (F.col("n") >= total * p_min * gamma))
    return kept.join(often.select("context"), "context", "left_semi")


@dataclass
class SuffixTree:
    """log10 probabilities of symbols in kept states, and log10 of the share that a state leaves to its suffix."""

    known: dict[str, float]
    left: dict[str, float]
    depth: int = DEPTH + max(TAILS)
    grams: dict[str, float] = field(default_factory=dict, compare=False, repr=False)

    @classmethod
    def grow(cls, rows: list[tuple[str, str, int]], gain: float = GAIN) -> SuffixTree:
        follow: dict[str, dict[str, int]] = defaultdict(dict)
        for context, symbol, n in rows:
            follow[context][symbol] = n
        tree = cls({}, {})
        for context in sorted(follow, key=len):
            after = follow[context]
            total, kinds = sum(after.values()), len(after)
            lower = {a: 10 ** tree.log10(context[1:], a) if context else UNIFORM for a in after}
            own = {a: (n + kinds * lower[a]) / (total + kinds) for a, n in after.items()}
            # Divergence test: what the state's own distribution gains over its suffix, in nats over the corpus.
            if context and sum(n * np.log(own[a] / lower[a]) for a, n in after.items()) < gain * kinds:
                continue
            tree.left[context] = log10(kinds / (total + kinds))
            for a, p in own.items():
                tree.known[context + a] = log10(p)
        return tree

    def log10(self, context: str, symbol: str) -> float:
        """Probability of a symbol in the longest kept suffix of a context."""
        known, left = self.known, self.left
        spare = 0.0
        for b in range(max(0, len(context) - self.depth), len(context) + 1):
            state = context[b:]
            p = known.get(state + symbol)
            if p is not None:
                return spare + p
            spare += left.get(state, 0.0)
        return spare + log10(UNIFORM)

    def head(self, end: str, start: str) -> float:
        """Of the last of a word's first symbols, after the ones before it and the end of the word before."""
        return self.log10(end + START + start[:-1], start[-1])

    def rest(self, word: str, heads: int = len(TAILS), within: int = DEPTH) -> float:
        """Of a word's symbols after its first ``heads``, which see only their own word."""
        s = START + spelling(word)
        parts, grams = [], self.grams
        for e in range(heads + 1, len(s)):
            gram = s[max(0, e - within) : e + 1]
            p = grams.get(gram)
            if p is None:
                if len(grams) >= REMEMBERED_GRAMS:
                    grams.clear()
                p = grams[gram] = self.log10(gram[:-1], gram[-1])
            parts.append(p)
        return sum(parts)


# --- corpus counts and scores -----------------------------------------------------------------------------------------

_BLOCKS = (
    "block long, doc_id long, held_out boolean, n_tokens long, tokens binary, word string, local int, gram string, n long"
)


def token_blocks(docs: DataFrame, held_out, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Documents as numbers in the vocabulary of their block, and those vocabularies with their training counts."""

    def vocabulary(block, ids, train):
        words = [w.decode() for w in ids]
        n = np.zeros(len(ids), np.int64)
        if train:
            tokens = np.concatenate(train)
            n += np.bincount(tokens, minlength=len(ids))
            before = before_each(train)
            inner = before >= 0
            for pairs, times, _ in Joints(words).pairs(tokens[inner], before[inner]):
                grams = [end + START + start for end, start in pairs]
                yield shaped(pd.DataFrame({"block": block, "gram": grams, "n": times}))
        yield shaped(pd.DataFrame({"block": block, "word": words, "local": np.arange(len(ids)), "n": n}))

    def shaped(frame):
        for name in ("doc_id", "n_tokens", "local", "n"):
            frame[name] = frame[name].astype("Int64") if name in frame else pd.Series(pd.NA, index=frame.index, dtype="Int64")
        for name in ("held_out", "tokens", "word", "gram"):
            if name not in frame:
                frame[name] = None
        return frame[["block", "doc_id", "held_out", "n_tokens", "tokens", "word", "local", "gram", "n"]]

    def run(frames):
        squeeze = zstandard.ZstdCompressor(level=1)
        block = TaskContext.get().partitionId() << 32
        ids, train, size = defaultdict(count().__next__), [], 0
        for frame in frames:
            rows = []
            for doc_id, text, held in zip(frame["doc_id"], frame["text"], frame["held_out"], strict=True):
                words = text.encode().lower().split()
                words.append(b"")
                own = np.fromiter(map(ids.__getitem__, words), np.int32, len(words))
                if not held:
                    train.append(own)
                rows.append((block, doc_id, held, len(own), squeeze.compress(packed(own))))
                size += len(own)
                if size >= block_tokens:
                    yield shaped(pd.DataFrame(rows, columns=["block", "doc_id", "held_out", "n_tokens", "tokens"]))
                    yield from vocabulary(block, ids, train)
                    rows, block = [], block + 1
                    ids, train, size = defaultdict(count().__next__), [], 0
            if rows:
                yield shaped(pd.DataFrame(rows, columns=["block", "doc_id", "held_out", "n_tokens", "tokens"]))
        if ids:
            yield from vocabulary(block, ids, train)

    rows = docs.select("doc_id", text_or_empty().alias("text"), held_out.alias("held_out"))
    return rows.mapInPandas(run, _BLOCKS)


def word_scores(words: DataFrame, tree: SuffixTree) -> DataFrame:
    """(word, n) with the log10 probability of what follows the first symbols of each distinct word."""
    shared = words.sparkSession.sparkContext.broadcast(tree)

    def run(frames):
        for frame in frames:
            score = shared.value.rest
            yield frame.assign(lp=np.fromiter(map(score, frame["word"]), float, len(frame)))

    return words.mapInPandas(run, "word string, n long, lp double")


def block_scores(docs: pd.DataFrame, table: pd.DataFrame, tree: SuffixTree, known: dict, rest: float) -> pd.DataFrame:
    """Counts and scores of a block's documents from its vocabulary (local, outer letters of the word, c, lp)."""
    table = table.sort_values("local")
    c, lp = table["c"].to_numpy(np.int64), table["lp"].to_numpy(float)
    base = np.log10(c + 1.0) - rest
    open_ = zstandard.ZstdDecompressor()
    own = [unpacked(open_.decompress(t)) for t in docs["tokens"]]
    ids = np.concatenate(own)
    score = lp[ids]
    if len(known) > REMEMBERED:
        known.clear()
    for pairs, _, of in Joints(table["word"].tolist()).pairs(ids, before_each(own)):
        values = np.zeros(len(pairs) + 1)  # the last for words that are shorter
        for i, pair in enumerate(pairs):
            p = known.get(pair)
            if p is None:
                p = known[pair] = tree.head(*pair)
            values[i] = p
        score = score + values[of]
    first = np.cumsum([0, *map(len, own[:-1])])
    out = docs[["doc_id", "held_out", "n_tokens"]].reset_index(drop=True).astype({"doc_id": "Int64"})
    out["n_known"] = np.add.reduceat((c[ids] > 0).astype(np.int64), first)
    out["base_score"] = np.add.reduceat(base[ids], first)
    out["score"] = np.add.reduceat(score, first)
    return out


def lm_scores(docs: DataFrame, divisor: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    blocks = staged(token_blocks(docs, fold(divisor) == held), "token-blocks", "zstd")
    vocabulary = blocks.filter(F.col("word").isNotNull()).select("block", "word", "local", "n")
    words = staged(vocabulary.groupBy("word").agg(F.sum("n").alias("n")), "corpus-words")
    seen = words.filter("n > 0")
    sums = seen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    across = blocks.filter(F.col("gram").isNotNull()).select("gram", "n")
    counts = staged(context_counts(word_grams(seen), across), "context-counts", "zstd")
    rows = frequent(counts).toPandas()
    tree = SuffixTree.grow(list(zip(rows["context"], rows["symbol"], rows["n"].tolist(), strict=True)))
    scored = word_scores(words, tree)
    values = vocabulary.drop("n").join(scored, "word").select(
        F.col("block").alias("of_block"), "local", outer_letters(F.col("word")).alias("word"), F.col("n").alias("c"), "lp"
    )
    texts = blocks.filter(F.col("tokens").isNotNull()).select("block", "doc_id", "held_out", "n_tokens", "tokens")
    tokens, kinds = int(sums["n"]), int(sums["v"])
    rest = log10(tokens + kinds + 1)
    shared = spark.sparkContext.broadcast(tree)
    known: dict[tuple[str, str], float] = {}

    def run(_, docs, table):
        return block_scores(docs, table, shared.value, known, rest)

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    found = texts.groupBy("block").cogroup(values.groupBy("of_block")).applyInPandas(run, schema)
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
