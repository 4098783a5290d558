"""Benchmark decontamination with suffix arrays over the training text.

Training documents are cut into shards of about ``SHARD_WORDS`` words where they lie, without a shuffle. A shard numbers its
words by the vocabulary of the test items (all others are one number that matches nothing), and sorts the suffixes that
could hold a match by their first words: its suffix array. Every distinct test suffix, cut to a window, is searched in it by
bisection, all of them at once, and gives the interval of the array, hence all the places, that begin with it. Places that
follow each other in document and item alike make one longest match.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but of some, is one window. Items are broadcast
in blocks of about ``BLOCK_WORDS`` words: usually there is one block, and one pass over the documents. With more blocks the
documents get a row number in a staged table, every block is a pass over it, and only hit documents are combined.

Defined results: null texts and items have no words; rows that repeat a doc_id (or have none) are judged each; rows that
repeat an item_id are one item; items without an id hit words but are not listed; without documents there are no rows,
without items no hits; texts of any length are searched whole; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import repeat
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ouvidoria.llm.common import staged, text_or_empty
from ouvidoria.session import scratch_path

WINDOW = 10
SHARD_WORDS = 1_000_000
BLOCK_WORDS = 2_000_000

# Words are runs of digits, lower-case letters and all that is beyond ASCII, after lower-casing A-Z.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())

FOUND = "doc_id long, n_words long, n_hit long, items array<string>"
SPANS = "row long, start long, end long, items array<string>"
MATCHES = "doc_id long, start long, length long, item_id long, item_start long"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


@dataclass
class Items:
    """A block of test items: its vocabulary, its words as numbers, and its distinct windows in the order of a suffix array."""

    vocabulary: dict[bytes, int]
    numbers: np.ndarray  # words of all items, a zero after each
    owner: np.ndarray  # item of every word
    ids: list[str | None]
    starts: np.ndarray  # where windows begin
    window_of: np.ndarray  # distinct window of each start
    low: np.ndarray  # keys of the distinct windows, padded with the smallest and the largest words
    high: np.ndarray
    lengths: np.ndarray  # words of the distinct windows
    items_of: list[np.ndarray]  # items of each distinct window
    window: int

    @property
    def shortest(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else self.window


class Packing:
    """Several word numbers in one 64-bit key, so that comparing a few keys compares ``depth`` words."""

    def __init__(self, kinds: int, depth: int):
        self.bits = max(1, kinds.bit_length())
        self.each = max(1, min(depth, 62 // self.bits))
        self.depth, self.keys = depth, -(-depth // self.each)
        self.most = (1 << self.bits) - 1

    def of(self, numbers: np.ndarray, at: np.ndarray, lengths: np.ndarray | None = None, pad: int = 0) -> np.ndarray:
        """Keys (one row each) of the words from ``at`` on; after ``lengths`` words they are ``pad``."""
        out = np.zeros((self.keys, len(at)), np.int64)
        for d in range(self.keys * self.each):
            word = np.zeros(len(at), np.int64)
            if d < self.depth:
                place = at + d
                inside = place < len(numbers)
                word[inside] = numbers[place[inside]]
                if lengths is not None:
                    word[d >= lengths] = pad
            out[d // self.each] = (out[d // self.each] << self.bits) | word
        return out


def prepared(items: list[tuple[int | None, list[bytes]]], window: int = WINDOW) -> Items:
    """The windows of items (item_id, words)."""
    vocabulary: dict[bytes, int] = {}
    numbers, owner, starts, lengths = [], [], [], []
    for k, (_, words) in enumerate(items):
        first, n = len(numbers), min(window, len(words))
        numbers += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words]
        numbers.append(0)
        owner += [k] * (len(words) + 1)
        here = range(first, first + len(words) - n + 1) if n else range(0)
        starts += here
        lengths += [n] * len(here)
    numbers, owner = np.array(numbers, np.int64), np.array(owner, np.int64)
    starts, lengths = np.array(starts, np.int64), np.array(lengths, np.int64)
    packing = Packing(len(vocabulary), window)
    keys = packing.of(numbers, starts, lengths)
    rows = np.vstack([lengths[None, :], keys]) if len(starts) else np.zeros((packing.keys + 1, 0), np.int64)
    _, one, of = np.unique(rows, axis=1, return_index=True, return_inverse=True)
    of = of.reshape(-1)
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order])) + 1
    items_of = [np.unique(owner[starts[g]]) for g in np.split(order, cuts)] if len(starts) else []
    distinct = starts[one]
    return Items(
        vocabulary,
        numbers,
        owner,
        [None if i is None else str(i) for i, _ in items],
        starts,
        of,
        packing.of(numbers, distinct, lengths[one]),
        packing.of(numbers, distinct, lengths[one], packing.most),
        lengths[one],
        items_of,
        window,
    )


class SuffixArray:
    """Suffixes of a shard's words that may begin with a test window, in order of their first words."""

    def __init__(self, numbers: np.ndarray, items: Items):
        packing = Packing(len(items.vocabulary), items.window)
        # A suffix may match if its words are known for as long as the shortest window.
        unknown = np.flatnonzero(numbers == 0)
        at = np.flatnonzero(numbers)
        wall = np.r_[unknown, len(numbers)][np.searchsorted(unknown, at)]
        at = at[wall - at >= items.shortest]
        keys = packing.of(numbers, at)
        order = np.lexsort(keys[::-1])
        self.at, self.keys = at[order], keys[:, order]

    def search(self, keys: np.ndarray, after: bool) -> np.ndarray:
        """For every column of keys the place of the first suffix that is not before it (or, ``after``, that is after it)."""
        lo, hi = np.zeros(keys.shape[1], np.int64), np.full(keys.shape[1], len(self.at))
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            before, equal = np.zeros(len(open_), bool), np.ones(len(open_), bool)
            for own, sought in zip(self.keys, keys, strict=True):
                mine, theirs = own[mid], sought[open_]
                before |= equal & (mine < theirs)
                equal &= mine == theirs
            right = before | equal if after else before
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]

    def places(self, items: Items) -> tuple[np.ndarray, np.ndarray]:
        """(place in the shard, distinct window that occurs there), in order of place."""
        lo, hi = self.search(items.low, False), self.search(items.high, True)
        n = hi - lo
        window = np.repeat(np.arange(len(n)), n)
        found = self.at[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
        order = np.lexsort((window, found))
        return found[order], window[order]


class Shard:
    """Documents laid end to end, as numbers, with a zero between them."""

    def __init__(self, items: Items):
        self.items, self.rows, self.parts, self.size = items, [], [], 0

    def add(self, row, words: list[bytes]) -> None:
        get = self.items.vocabulary.get
        self.rows.append((row, len(words)))
        self.parts.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
        self.size += len(words)

    def matches(self):
        """For every document: its row, number of words, places of windows in it (from its start), and their windows."""
        zero = np.zeros(1, np.int64)
        numbers = np.concatenate([x for p in self.parts for x in (p, zero)]) if self.parts else zero
        at, window = SuffixArray(numbers, self.items).places(self.items) if len(self.items.starts) else (zero[:0], zero[:0])
        first = np.cumsum([0, *[n + 1 for _, n in self.rows]])
        cuts = np.searchsorted(at, first)
        for k, (row, n) in enumerate(self.rows):
            a, b = cuts[k], cuts[k + 1]
            yield row, n, at[a:b] - first[k], window[a:b]


def covered(n: int, at: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
    """Spans of words (start, end) inside any occurrence."""
    if not len(at):
        return []
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + lengths, -1)
    inside = np.cumsum(edges) > 0
    turns = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
    return list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))


def longest(items: Items, at: np.ndarray, window: np.ndarray) -> list[tuple[int, int, str | None, int]]:
    """(start, length, item, start in the item) of the longest verbatim matches of a document."""
    order = np.argsort(items.window_of, kind="stable")
    edges = np.searchsorted(items.window_of[order], np.arange(len(items.lengths) + 1))
    each = edges[window + 1] - edges[window]
    place = np.repeat(at, each)
    test = items.starts[order[np.repeat(edges[window] - np.cumsum(each) + each, each) + np.arange(each.sum())]]
    size = np.repeat(items.lengths[window], each)
    run = np.lexsort((place, place - test))
    place, test, size = place[run], test[run], size[run]
    same = (np.diff(place) == 1) & (np.diff(test) == 1) & (items.owner[test[1:]] == items.owner[test[:-1]])
    begin = np.flatnonzero(np.r_[True, ~same]) if len(place) else place
    count = np.diff(np.r_[begin, len(place)])
    own = items.owner[test[begin]]
    first = np.searchsorted(items.owner, own)
    length = size[begin] + count - 1
    return [
        (int(p), int(m), items.ids[o], int(t - f))
        for p, m, o, t, f in sorted(zip(place[begin], length, own, test[begin], first, strict=True))
    ]


def _shards(batches, names: list[str], items: Items, shard_words: int):
    """Shards of a task's rows; a document that is longer than a shard has one of its own."""
    shard = Shard(items)
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in names]
        texts = batch.column("text")
        for k, row in enumerate(zip(*columns, strict=True)):
            words = words_of(texts[k].as_py())
            if shard.size and shard.size + len(words) > shard_words:
                yield shard
                shard = Shard(items)
            shard.add(row, words)
    if shard.rows:
        yield shard


class _Lists:
    """The items of a set of windows, remembered: copies of a document have the same."""

    def __init__(self, items: Items):
        self.items, self.known = items, {}

    def of(self, windows: np.ndarray) -> list[str]:
        key = np.unique(windows).tobytes()
        if key not in self.known:
            if len(self.known) > 10_000:
                self.known.clear()
            own = np.unique(np.concatenate([self.items.items_of[w] for w in np.unique(windows)])) if len(windows) else []
            self.known[key] = sorted({i for i in (self.items.ids[k] for k in own) if i is not None})
        return self.known[key]


def _sized(benchmark: DataFrame) -> DataFrame:
    """Items with their number of words."""
    n = F.regexp_count(F.translate(text_or_empty(), ascii_uppercase, ascii_lowercase), F.lit(WORD_PATTERN))
    return benchmark.select(F.col("item_id").cast("long"), "text", n.alias("n"))


def _block_count(benchmark: DataFrame, block_words: int) -> int:
    total = _sized(benchmark).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    return max(1, -(-total // block_words))


def _block(benchmark: DataFrame, k: int, of: int, window: int):
    """Broadcast block ``k`` of ``of``: about ``block_words`` words pass the driver; an item is never cut."""
    mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(of)) == k
    rows = benchmark.select(F.col("item_id").cast("long"), "text").filter(mine).collect()
    return benchmark.sparkSession.sparkContext.broadcast(prepared([(r["item_id"], words_of(r["text"])) for r in rows], window))


def found_in(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """doc_id, n_words, n_hit and the sorted ids of the items with windows in the text, of every document (doc_id, text)."""
    n_blocks = _block_count(benchmark, block_words)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if n_blocks == 1:
        return rows.mapInArrow(_one_pass(_block(benchmark, 0, 1, window), shard_words), FOUND)
    numbered = staged(rows.withColumn("row", F.monotonically_increasing_id()), "numbered-documents")
    path = scratch_path(docs.sparkSession, "hits")
    for k in range(n_blocks):
        block = _block(benchmark, k, n_blocks, window)
        numbered.mapInArrow(_spans(block, shard_words), SPANS).write.mode("append").parquet(path)
        block.destroy()
    hits = docs.sparkSession.read.schema(SPANS).parquet(path)
    listed = hits.select("row", F.explode("items").alias("item")).distinct()
    listed = listed.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    # Spans of one document from several blocks are laid over each other.
    spans = hits.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["to"]))).alias("n"),
        F.greatest(acc["to"], s["end"]).alias("to"),
    )
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    covered_ = spans.select("row", F.aggregate("spans", zero, step, lambda acc: acc["n"]).alias("n_hit"))
    counts = numbered.mapInArrow(_word_counts, "row long, doc_id long, n_words long")
    none = F.array().cast("array<string>")
    return counts.join(covered_, "row", "left").join(listed, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items")
    )


def _one_pass(block, shard_words: int):
    def run(batches):
        items = block.value
        lists = _Lists(items)
        for shard in _shards(batches, ["doc_id"], items, shard_words):
            ids, n_words, n_hit, found = [], [], [], []
            for (doc_id,), n, at, window in shard.matches():
                ids.append(doc_id)
                n_words.append(n)
                n_hit.append(sum(b - a for a, b in covered(n, at, items.lengths[window])))
                found.append(lists.of(window) if len(window) else [])
            columns = [pa.array(ids, pa.int64()), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64())]
            yield pa.record_batch([*columns, pa.array(found, pa.list_(pa.string()))], names=["doc_id", "n_words", "n_hit", "items"])

    return run


def _spans(block, shard_words: int):
    def run(batches):
        items = block.value
        lists = _Lists(items)
        for shard in _shards(batches, ["row"], items, shard_words):
            out = []
            for (row,), n, at, window in shard.matches():
                for k, (a, b) in enumerate(covered(n, at, items.lengths[window])):
                    out.append((row, a, b, [] if k else lists.of(window)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())]
            columns = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
            yield pa.record_batch(columns, names=["row", "start", "end", "items"])

    return run


def _word_counts(batches):
    for batch in batches:
        n = [len(words_of(t)) for t in batch.column("text").to_pylist()]
        yield pa.record_batch([batch.column("row"), batch.column("doc_id"), pa.array(n, pa.int64())], names=["row", "doc_id", "n_words"])


def longest_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """doc_id, start, length, item_id, item_start (in words): every longest verbatim match of a window or more.

    One row per document, item and place, so a passage that stands in many items and many documents makes as many rows.
    """

    def run_with(block):
        def run(batches):
            items = block.value
            for shard in _shards(batches, ["doc_id"], items, shard_words):
                out = [(d, *m) for (d,), _, at, window in shard.matches() if len(at) for m in longest(items, at, window)]
                columns = [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64())]
                columns += [pa.array([o[2] for o in out], pa.int64())]
                columns += [pa.array([None if o[3] is None else int(o[3]) for o in out], pa.int64())]
                columns += [pa.array([o[4] for o in out], pa.int64())]
                yield pa.record_batch(columns, names=["doc_id", "start", "length", "item_id", "item_start"])

        return run

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    n_blocks = _block_count(benchmark, block_words)
    path = scratch_path(docs.sparkSession, "matches")
    for k in range(n_blocks):
        block = _block(benchmark, k, n_blocks, window)
        rows.mapInArrow(run_with(block), MATCHES).write.mode("append").parquet(path)
        block.destroy()
    return docs.sparkSession.read.schema(MATCHES).parquet(path)


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``."""
    found = found_in(docs, benchmark, **options)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, in whose texts no window occurs.

    Rows are judged by their texts, so rows that repeat a doc_id, or have none, don't go for each other.
    """
    digest = F.sha2(text_or_empty(), 256)
    texts = docs.select(F.lit(None).cast("long").alias("doc_id"), "text", digest.alias("of")).dropDuplicates(["of"])
    numbered = staged(texts.select(F.monotonically_increasing_id().alias("doc_id"), "text", "of"), "distinct-texts")
    hit = found_in(numbered, benchmark, **options).filter("n_hit > 0").select("doc_id")
    gone = staged(numbered.join(hit, "doc_id", "left_semi").select(F.col("of").alias("_of")), "contaminated-texts")
    return docs.join(gone, digest == F.col("_of"), "left_anti")

