"""Substring dedup with repeated-phrase automata.

A window is ``WINDOW`` consecutive words. Every window has an anchor: of its runs of ``ANCHOR`` words the one with the
smallest hash. Consecutive windows with one anchor form a segment, about one for every twenty words. Equal windows have
equal anchors, so only segments whose anchor recurs in another document can hold repeated windows.

1. All documents are read once for their segments (hashes only); anchors of two or more documents are kept.
2. Recurring passages are confirmed: equal segments by the hash of all their words, unequal segments with one anchor by
   the hashes of their windows. The document with the smallest id is the source, and gives its words.
3. Each bucket of documents gets the passages that recur in it, compiles an Aho-Corasick automaton over their anchors
   (a word is one symbol), and streams all its documents through. A hit is extended over the words of the passage; a
   run of a window or more, equal word by word to a source with a smaller id, is removed.

A passage is sent once to each bucket that has it, however many documents do. No group of documents meets in one task:
rows without an id never reach the automata, and rows that repeat an id beyond the size of a bucket are dealt by their
texts to as many shares of that id as their bytes ask for, equal ones as one row with a count.

Defined results: null text has no words; rows without an id take no part and lose nothing; rows that repeat a doc_id
never remove each other's words, and all lose what a smaller id has; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import compress, repeat
from re import compile as pattern
from zlib import crc32

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ouvidoria.llm.common import SPACES, WORD, staged, text_or_empty

WINDOW = 50
ANCHOR = 8
BUCKET_BYTES = 4_000_000
# Distinct words that one automaton's passages may have; more passages make another automaton.
SHARD_WORDS = 400_000
# Windows whose anchors are found at a time; places within them take the low bits of a hash.
STRETCH, PLACE_BITS = 65_536, np.uint64(20)

# The symbol of all words that no passage of an automaton has.
OTHER = "\x01"

_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15 | 1

_SPACE = pattern(rb"[\x20\x09-\x0D]")
_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
# A number for every byte, none for white space.
_OF_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OF_BYTE[_IS_SPACE] = 0


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX1
    x = (x ^ (x >> np.uint64(29))) * _MIX2
    return x ^ (x >> np.uint64(32))


def least_places(grams: np.ndarray, span: int) -> np.ndarray:
    """Place of the smallest hash, by its high bits, in every run of ``span``; the first of equal ones.

    The least of a run is the lesser of two shorter runs that cover it, and the place goes along in the low bits.
    """
    low = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    least, width = (grams & ~low) | np.arange(len(grams), dtype=np.uint64), 1
    while width < span:
        step = min(width, span - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    return (least & low).astype(np.int64)


class Hasher:
    """Hashes of the words, anchors, segments and windows of a document."""

    def __init__(self, window: int = WINDOW, anchor: int = ANCHOR):
        self.window, self.anchor = window, anchor
        self.steps = np.ones(1, np.uint64)
        self.powers = self.inverses = np.ones(1, np.uint64)
        rng = np.random.default_rng(11)
        self.factors = rng.integers(1, 2**63, anchor, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, spelt: bytes) -> np.ndarray:
        """A hash of every word of a text, from its bytes and their places in the word."""
        data, found, a = np.frombuffer(spelt, np.uint8), [np.zeros(0, np.uint64)], 0
        while a < len(data):
            cut = _SPACE.search(spelt, a + STRETCH)
            b = cut.start() if cut else len(data)
            found.append(self._of_bytes(data[a:b]))
            a = b
        return np.concatenate(found)

    def _of_bytes(self, data: np.ndarray) -> np.ndarray:
        space = _IS_SPACE[data]
        start = np.flatnonzero(~space & np.r_[True, space[:-1]])
        if not len(start):
            return np.zeros(0, np.uint64)
        length = np.diff(np.r_[start, len(data)])
        place = np.arange(start[0], len(data)) - np.repeat(start, length)
        if length.max() > len(self.steps):
            self.steps = np.full(2 * length.max(), _BASE, np.uint64)
            self.steps[0] = 1
            self.steps = np.multiply.accumulate(self.steps)
        return _mixed(np.add.reduceat(_OF_BYTE[data[start[0] :]] * self.steps[place], start - start[0]))

    def prefix(self, h: np.ndarray) -> np.ndarray:
        """Sums from which the hash of any run of words follows."""
        if len(h) >= len(self.powers):
            n = 2 * len(h) + 1
            inverse = pow(_BASE, -1, 2**64)
            steps = [np.full(n, b, np.uint64) for b in (_BASE, inverse)]
            for s in steps:
                s[0] = 1
            self.powers, self.inverses = (np.multiply.accumulate(s) for s in steps)
        return np.r_[np.uint64(0), np.cumsum(h * self.powers[: len(h)], dtype=np.uint64)]

    def runs(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words from ``start`` to before ``end``, the same wherever they stand."""
        value = (prefix[end] - prefix[start]) * self.inverses[start]
        return _mixed(value + (end - start).astype(np.uint64)).view(np.int64)

    def segments(self, h: np.ndarray):
        """Anchor hash, segment hash, first window, number of windows and place of the anchor, per segment."""
        n = len(h) - self.window + 1
        k = self.anchor
        grams = np.zeros(len(h) - k + 1, np.uint64)
        for j in range(k):
            grams += h[j : j + len(grams)] * self.factors[j]
        grams = _mixed(grams)
        span = self.window - k + 1
        owner = np.concatenate([least_places(grams[a : a + STRETCH + span - 1], span) + a for a in range(0, n, STRETCH)])
        start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        count = np.diff(np.r_[start, n])
        hashes = self.runs(self.prefix(h), start, start + count - 1 + self.window)
        return grams[owner[start]].view(np.int64), hashes, start, count, owner[start] - start


def segment_rows(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """One row per distinct segment of each document."""

    def shaped(parts, owners):
        anchor, segment, start, windows, place = (np.concatenate(column) for column in zip(*parts, strict=True))
        n = [len(part[0]) for part in parts]
        doc_id, row = (np.repeat(np.array(column, np.int64), n) for column in zip(*owners, strict=True))
        return pd.DataFrame(
            {
                "anchor": anchor,
                "segment": segment,
                "doc_id": doc_id,
                "row": row,
                "start": start.astype(np.int32),
                "windows": windows.astype(np.int16),
                "place": place.astype(np.int16),
            }
        )

    def run(frames):
        hasher = Hasher(window, anchor)
        for frame in frames:
            parts, owners = [], []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                spelt = text.encode()
                hashed = hasher.of(spelt)
                if len(hashed) < window:
                    continue
                anchors, hashes, start, count, place = hasher.segments(hashed)
                _, one = np.unique(hashes, return_index=True)
                parts.append((anchors[one], hashes[one], start[one], count[one], place[one]))
                owners.append((doc_id, crc32(spelt)))
                if len(parts) >= 500:
                    yield shaped(parts, owners)
                    parts, owners = [], []
            if parts:
                yield shaped(parts, owners)

    schema = "anchor long, segment long, doc_id long, row long, start int, windows short, place short"
    return docs.filter(F.col("doc_id").isNotNull()).mapInPandas(run, schema)


def source_rows(docs: DataFrame, sources: DataFrame, window: int, anchor: int) -> DataFrame:
    """Words of the source segments, and window hashes of those that share their anchor with other segments.

    Rows with ``words`` hold a segment's text, rows without it one window hash each.
    """
    fields = ("segment", "start", "windows", "place", "shared")
    # The checksum of the text tells the rows of a repeated id apart, so that each is asked for its own segments only.
    keys = F.col("doc_id").alias("source"), F.col("row").alias("source_row")
    wanted = sources.groupBy(*keys).agg(F.collect_list(F.struct(*fields)).alias("pieces"))
    same = (F.col("doc_id") == F.col("source")) & (F.crc32("text") == F.col("source_row"))
    joined = docs.join(wanted, same).select("doc_id", "text", "pieces")

    def run(frames):
        hasher = Hasher(window, anchor)
        for frame in frames:
            rows, hashes, owners = [], [], []
            for doc_id, text, pieces in zip(frame["doc_id"], frame["text"], frame["pieces"], strict=True):
                spelt = text.encode()
                words, prefix = spelt.split(), hasher.prefix(hasher.of(spelt))
                segment, start, count, place, shared = (np.array([p[f] for p in pieces]) for f in fields)
                end = start.astype(np.int64) + count - 1 + window
                fits = end <= len(words)
                # Another row with this id and checksum may have given a segment; then that row has the words.
                same = hasher.runs(prefix, start[fits], end[fits]) == segment[fits]
                mine = np.flatnonzero(fits)[same]
                for i in mine.tolist():
                    rows.append((segment[i], doc_id, place[i], b" ".join(words[start[i] : end[i]]).decode()))
                split = mine[shared[mine]]
                if len(split):
                    n = count[split].astype(np.int64)
                    at = np.repeat(start[split] - np.cumsum(n) + n, n) + np.arange(n.sum())
                    hashes.append(hasher.runs(prefix, at, at + window))
                    owners.append((np.repeat(segment[split], n), doc_id))
            out = pd.DataFrame(rows, columns=["segment", "source", "place", "words"])
            yield out.assign(hash=0)
            if hashes:
                of = np.concatenate([o for o, _ in owners])
                sources = np.repeat(np.array([d for _, d in owners], np.int64), [len(o) for o, _ in owners])
                yield pd.DataFrame({"segment": of, "source": sources, "place": 0, "words": None, "hash": np.concatenate(hashes)})

    return joined.mapInPandas(run, "segment long, source long, place int, words string, hash long")


class Shard:
    """An automaton over the anchors of some passages; every word of theirs is one symbol, all other words another."""

    def __init__(self, passages: list[tuple[int, int, list[bytes]]], window: int, anchor: int):
        self.window, self.anchor = window, anchor
        self.codes = _Codes()
        by_anchor: dict[str, list[tuple[str, int, int]]] = defaultdict(list)
        for source, place, words in passages:
            spelt = "".join([self.codes.add(w) for w in words])
            by_anchor[spelt[place : place + anchor]].append((spelt, place, source))
        self.automaton = ahocorasick.Automaton()
        for phrase, found in by_anchor.items():
            self.automaton.add_word(phrase, sorted(found, key=lambda f: f[2]))
        self.automaton.make_automaton()

    def mark(self, doc_id: int, words: list[bytes], covered: bytearray) -> None:
        """Mark the words of a document that lie in runs of a window or more that a source with a smaller id has."""
        text = "".join(map(self.codes.get, words, repeat(OTHER)))
        for end, found in self.automaton.iter(text):
            at = end - self.anchor + 1
            for spelt, place, source in found:
                if source >= doc_id:
                    break
                a, b = at - place, at - place + len(spelt)
                if a >= 0 and text[a:b] == spelt:
                    covered[a:b] = b"\x01" * len(spelt)
                    continue
                left, most = 0, min(at, place)
                while left < most and text[at - left - 1] == spelt[place - left - 1]:
                    left += 1
                right, most = self.anchor, min(len(text) - at, len(spelt) - place)
                while right < most and text[at + right] == spelt[place + right]:
                    right += 1
                if left + right >= self.window:
                    covered[at - left : at + right] = b"\x01" * (left + right)


class _Codes(dict):
    def add(self, word: bytes) -> str:
        code = self.get(word)
        if code is None:
            n = len(self) + 2
            code = self[word] = chr(n if n < 0xD800 else n + 0x800)
        return code


def shards(passages: pd.DataFrame, window: int, anchor: int, most: int = SHARD_WORDS):
    """Automata over all passages, each with at most ``most`` distinct words (one passage at least)."""
    held, seen = [], set()
    for source, place, words in zip(passages["source"], passages["place"], passages["words"], strict=True):
        own = words.encode().split()
        if held and len(seen) + len(own) > most and len(seen.union(own)) > most:
            yield Shard(held, window, anchor)
            held, seen = [], set()
        held.append((source, place, own))
        seen.update(own)
    if held:
        yield Shard(held, window, anchor)


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space) of every row."""
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    segments = staged(segment_rows(texts, window, anchor), "segments")
    anchors = (
        segments.groupBy(F.col("anchor").alias("a"))
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min("segment").alias("s"), F.max("segment").alias("t"))
        .filter("lo < hi")
        .select("a", (F.col("s") != F.col("t")).alias("shared"))
    )
    recurring = staged(segments.join(anchors, F.col("anchor") == F.col("a")).drop("a", "anchor"), "recurring")
    first = F.min(F.struct("doc_id", "row", "start", "windows", "place")).alias("f")
    sources = recurring.groupBy("segment", "shared").agg(first, F.max("doc_id").alias("last"))
    sources = staged(
        sources.filter(F.col("shared") | (F.col("last") > F.col("f.doc_id"))).select("segment", "shared", "last", "f.*"), "sources"
    )
    given = staged(source_rows(texts, sources, window, anchor), "passages")
    passages = given.filter(F.col("words").isNotNull()).select("segment", "source", "place", "words").dropDuplicates(["segment"])
    windows = given.filter(F.col("words").isNull()).select("hash", "segment", "source")

    sizes = texts.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    sizes = staged(sizes, "bytes-by-id")
    total = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first()["n"]
    large = sizes.filter(F.col("doc_id").isNotNull() & (F.col("rows") > 1) & (F.col("bytes") > bucket_bytes))
    shares = large.select(F.col("doc_id").alias("large_id"), F.ceil(F.col("bytes") / bucket_bytes).cast("int").alias("shares"))
    repeated = bool(large.take(1))

    def bucket(share):
        return F.pmod(F.xxhash64("doc_id", share), F.lit(max(1, -(-total // bucket_bytes)))).alias("bucket")

    def in_all_shares(rows):
        """(bucket, segment) of (doc_id, segment): the passages of a document go wherever its rows may be."""
        if not repeated:
            return rows.select(bucket(F.lit(0)), "segment")
        spread = rows.join(shares, F.col("doc_id") == F.col("large_id"), "left")
        share = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("shares"), F.lit(1)) - 1)).alias("share")
        return spread.select("doc_id", "segment", share).select(bucket(F.col("share")), "segment")

    origin = sources.select(F.col("segment").alias("of"), F.col("doc_id").alias("origin"))
    whole = recurring.join(origin, F.col("segment") == F.col("of")).filter("doc_id > origin")
    least = windows.groupBy(F.col("hash").alias("h")).agg(
        F.min(F.struct(F.col("source").alias("origin"), F.col("segment").alias("of"))).alias("m"), F.max("source").alias("hi")
    )
    parted = (
        windows.join(least.filter("hi > m.origin"), F.col("hash") == F.col("h"))
        .filter("source > m.origin")
        .select(F.col("source").alias("doc_id"), F.col("m.of").alias("segment"))
    )
    wanted = whole.select("doc_id", "segment").union(parted)
    wanted = staged(in_all_shares(wanted).distinct(), "wanted")
    sent = wanted.join(passages, "segment").select(F.col("bucket").alias("to"), "source", "place", "words")

    def run(_, docs, passages):
        words = [t.encode().split() for t in docs["text"]]
        covered = [bytearray(len(w)) for w in words]
        for shard in shards(passages, window, anchor):
            for doc_id, own, marks in zip(docs["doc_id"], words, covered, strict=True):
                if len(own) >= window:
                    shard.mark(doc_id, own, marks)
        flipped = bytes([1, 0])
        kept = [
            b" ".join(compress(own, marks.translate(flipped + bytes(254))) if 1 in marks else own).decode()
            for own, marks in zip(words, covered, strict=True)
        ]
        return pd.DataFrame(
            {
                "doc_id": docs["doc_id"],
                "copies": docs["copies"],
                "n_words": [len(w) for w in words],
                "n_removed": [m.count(1) for m in covered],
                "kept": kept,
            }
        )

    named = texts.filter(F.col("doc_id").isNotNull())
    dealt = named.select("doc_id", "text", F.lit(1).cast("long").alias("copies"), bucket(F.lit(0)))
    if repeated:
        known = F.col("doc_id") == F.col("large_id")
        # Equal rows of one id are counted where they are read and go on as one.
        equal = named.join(shares, known).groupBy("doc_id", "shares", "text").agg(F.count(F.lit(1)).alias("copies"))
        share = F.pmod(F.xxhash64("text"), F.col("shares"))
        spread = equal.withColumn("share", share.cast("int")).select("doc_id", "text", "copies", bucket(F.col("share")))
        dealt = dealt.join(shares, known, "left_anti").union(spread)
    marked = dealt.groupBy("bucket").cogroup(sent.groupBy("to"))
    found = marked.applyInPandas(run, "doc_id long, copies long, n_words long, n_removed long, kept string")
    if repeated:
        found = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    words = F.trim(F.regexp_replace("text", SPACES, " ")).alias("kept")
    nameless = texts.filter(F.col("doc_id").isNull()).select(
        "doc_id",
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_removed"),
        words,
    )
    return found.select("doc_id", "n_words", "n_removed", "kept").union(nameless)
