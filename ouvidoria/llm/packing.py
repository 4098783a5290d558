"""Best-fit packing of tokenised documents by linear grouping.

Lengths are whole numbers up to the capacity, so all that packing decides follows from how many pieces have each length:
a table of at most ``capacity`` rows, whatever the corpus holds. On that table large lengths are cut into groups of
equal cardinality and rounded up to the longest of their group, configurations of the few sizes are chosen one after
the other, each as full as it can be, actual lengths are put in place of the rounded ones, and small lengths go where
they fit best. The plan says, for every length, which of its pieces (by rank) go to which sequences, and is applied to
all pieces by their ranks. Ranks are counted within (length, salt), so no length is sorted in one task.

Defined results: null and empty texts are the closing id alone; rows that repeat a document are packed each; an empty
table gives no rows.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort
from collections import deque
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ouvidoria.llm.common import partitions, staged, text_or_empty

CAPACITY = 2048
TOKENIZER = "byte_bpe_50k.json"
# Lengths above capacity / LARGE are grouped and configured; GROUPS bounds the number of rounded sizes.
LARGE = 8
GROUPS = 256
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# Fixed value: the units of text that byte-level tokenizers of this family never merge across.
_UNITS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which serves one task after the other."""
    return Encoder(path)


def _byte_letters() -> dict[str, int]:
    """Letter of the byte-level alphabet -> byte: printable bytes stand for themselves, others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _same_merges(tokenizer) -> tiktoken.Encoding | None:
    """The tokenizer's ids by a faster merging loop, if that provably gives the same; else None.

    The loop merges the neighbours whose union has the smallest id. That is what the file's list of merges does if ids
    rise along the list and if the merges alone spell every token: then, when a union of id r is next, its bytes are split
    as the list splits them, since all smaller merges inside have been done and none across its ends has.
    """
    state = json.loads(tokenizer.to_str())
    model, way = state["model"], state["pre_tokenizer"] or {}
    plain = (
        state["normalizer"] is None
        and (way.get("type"), way.get("use_regex", True), bool(way.get("add_prefix_space"))) == ("ByteLevel", True, False)
        and model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and not any(t[k] for t in state["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not plain:
        return None
    letters, added = _byte_letters(), {t["content"]: t["id"] for t in state["added_tokens"]}
    vocabulary = {token: i for token, i in model["vocab"].items() if token not in added}
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    bare = Tokenizer(tokenizer.model)
    spelt = zip(vocabulary.values(), bare.encode_batch(list(vocabulary), add_special_tokens=False), strict=True)
    if merged != sorted(merged) or not all(e.ids == [i] for i, e in spelt):
        return None
    ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
    return tiktoken.Encoding("same", pat_str=_UNITS, mergeable_ranks=ranks, special_tokens=added)


class Encoder:
    """Ids of whole texts as little-endian 32-bit words, added tokens included."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.same = _same_merges(self.tokenizer)

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.same is None:
            batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
            found = [e.ids for e in batch(texts, add_special_tokens=False)]
        else:
            found = [self.same.encode(t, allowed_special="all") for t in texts]
        return [np.array(ids, dtype="<u4").tobytes() for ids in found]


def tokenised_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece: only documents longer than the capacity are cut, and only their first piece is shorter.

    ``task`` numbers the task that made it, so that equal rows of a hot document can be told apart.
    """

    def run(frames):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = encoder(path or tokenizer_path()).encode
        tail = np.uint32(end_id).astype("<u4").tobytes()
        for frame in frames:
            texts = frame["text"].tolist()
            out = []
            at = 0
            while at < len(texts):
                # About a million characters at a time, and one document at least.
                to, chars = at, 0
                while to < len(texts) and (to == at or chars < 1_000_000):
                    chars += len(texts[to])
                    to += 1
                for doc_id, ids in zip(frame["doc_id"].iloc[at:to], encode(texts[at:to]), strict=True):
                    ids += tail
                    n = len(ids) // 4
                    start, length = 0, n % capacity or capacity
                    piece = 0
                    while start < n:
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        out.append((doc_id, piece, start, length, crc))
                        start, length, piece = start + length, capacity, piece + 1
                at = to
            result = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield result.astype({"doc_id": "Int64"}).assign(task=TaskContext.get().partitionId())

    return docs.select("doc_id", text_or_empty().alias("text")).mapInPandas(run, f"{PIECES}, task int")


# --- the plan, over counts of lengths ---------------------------------------------------------------------------------


@dataclass
class Run:
    """Pieces of one length with ranks from ``rank`` on: ``each`` to a sequence from ``first`` on, placed at ``base``."""

    length: int
    rank: int
    count: int
    first: int
    each: int
    base: int


class _Supply:
    """Pieces left of every length, handed out in the order of their ranks."""

    def __init__(self, counts: dict[int, int]):
        self.left = dict(counts)
        self.rank = dict.fromkeys(counts, 0)

    def take(self, length: int, count: int) -> int:
        rank = self.rank[length]
        self.rank[length] += count
        self.left[length] -= count
        return rank


def linear_groups(counts: dict[int, int], groups: int) -> list[deque]:
    """Lengths in descending order, cut into at most ``groups`` groups of equal cardinality; runs [length, count]."""
    total = sum(counts.values())
    size = max(1, -(-total // groups))
    out, room = [], 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append(deque())
                room = size
            n = min(left, room)
            out[-1].append([length, n])
            left, room = left - n, room - n
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int):
    """Choose configurations, each with the largest size left and as full as it can be; yield (multiplicities, times).

    Reachable fills are bits of a whole number, so one choice costs a few shifts per size.
    """
    demand = list(demand)
    lead = 0
    mask = (1 << (capacity + 1)) - 1
    while True:
        while lead < len(sizes) and not demand[lead]:
            lead += 1
        if lead == len(sizes):
            return
        room = capacity - sizes[lead]
        reach = [1]
        for g in range(lead, len(sizes)):
            most = min(demand[g] - (g == lead), room // sizes[g])
            bits = reach[-1]
            for _ in range(most):
                more = (bits | bits << sizes[g]) & mask
                if more == bits:
                    break
                bits = more
            reach.append(bits)
        fill = (reach[-1] & ((1 << (room + 1)) - 1)).bit_length() - 1
        chosen = {lead: 1}
        for g in range(len(sizes) - 1, lead - 1, -1):
            below = reach[g - lead]
            m = 0
            while not below >> fill & 1:
                fill -= sizes[g]
                m += 1
            if m:
                chosen[g] = chosen.get(g, 0) + m
        times = min(demand[g] // m for g, m in chosen.items())
        for g, m in chosen.items():
            demand[g] -= m * times
        yield chosen, times


def pack(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[list[Run], int]:
    """The runs of a packing of ``counts`` (length -> pieces), and how many sequences it has."""
    supply = _Supply(counts)
    runs: list[Run] = []
    open_bins: dict[int, list[tuple[int, int, int]]] = {}
    residuals: list[int] = []
    n_bins = 0

    def leave(first: int, count: int, used: int) -> None:
        room = capacity - used
        if count and room:
            if room not in open_bins:
                insort(residuals, room)
            open_bins.setdefault(room, []).append((first, count, used))

    def give(length: int, count: int, first: int, each: int, base: int) -> None:
        runs.append(Run(length, supply.take(length, count), count, first, each, base))

    large = {k: n for k, n in counts.items() if n and k > capacity // LARGE}
    grouped = linear_groups(large, groups)
    sizes, demand = [g[0][0] for g in grouped], [sum(n for _, n in g) for g in grouped]
    for chosen, times in configurations(sizes, demand, capacity):
        slots = [g for g in sorted(chosen) for _ in range(chosen[g])]
        # Each slot draws as many actual lengths as the configuration has sequences; they change at ``edges``.
        drawn = []
        for g in slots:
            need, own = times, []
            while need:
                run = grouped[g][0]
                n = min(need, run[1])
                own.append((run[0], n))
                run[1] -= n
                need -= n
                if not run[1]:
                    grouped[g].popleft()
            drawn.append(own)
        edges = sorted({0, times, *(int(e) for own in drawn for e in np.cumsum([n for _, n in own]))})
        at = [iter(own) for own in drawn]
        held = [[0, 0] for _ in drawn]
        for a, b in zip(edges, edges[1:], strict=False):
            used = 0
            for s in range(len(slots)):
                if not held[s][1]:
                    held[s] = list(next(at[s]))
                held[s][1] -= b - a
                give(held[s][0], b - a, n_bins + a, 1, used)
                used += held[s][0]
            leave(n_bins + a, b - a, used)
        n_bins += times

    for length in sorted((k for k, n in counts.items() if n and k <= capacity // LARGE), reverse=True):
        while left := supply.left[length]:
            k = bisect_left(residuals, length)
            if k == len(residuals):
                count = -(-left // (capacity // length))
                leave(n_bins, count, 0)
                n_bins += count
                continue
            room = residuals[k]
            first, count, used = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], residuals[k]
            each = room // length
            full = min(count, left // each)
            if full:
                give(length, full * each, first, each, used)
                leave(first, full, used + each * length)
            first, count, rest = first + full, count - full, left - full * each
            if count and rest:
                give(length, rest, first, rest, used)
                leave(first, 1, used + rest * length)
                first, count = first + 1, count - 1
            leave(first, count, used)
    return runs, n_bins


def placements(spark: SparkSession, runs: list[Run]):
    """The plan as sorted arrays for the tasks; its size depends on the capacity alone."""
    ordered = sorted(runs, key=lambda r: (r.length, r.rank))
    return spark.sparkContext.broadcast(
        np.array([(r.length, r.rank, r.first, r.each, r.base) for r in ordered], dtype=np.int64).reshape(-1, 5)
    )


def place(ranked: DataFrame, plan) -> DataFrame:
    """Sequence and offset of every piece, from its length and its rank among pieces of that length."""

    def run(frames):
        table = plan.value
        starts = {k: (a, b) for k, a, b in _spans(table[:, 0])}
        for frame in frames:
            length, rank = frame["length"].to_numpy(np.int64), frame["rank"].to_numpy(np.int64)
            row = np.zeros(len(frame), dtype=np.int64)
            for k in np.unique(length):
                a, b = starts[int(k)]
                mine = length == k
                row[mine] = a + np.searchsorted(table[a:b, 1], rank[mine], side="right") - 1
            past = rank - table[row, 1]
            frame["sequence_id"] = table[row, 2] + past // table[row, 3]
            frame["offset"] = table[row, 4] + past % table[row, 3] * length
            yield frame.drop(columns="rank")

    return ranked.mapInPandas(run, f"{PIECES}, sequence_id long, offset long")


def _spans(keys: np.ndarray):
    firsts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return [(int(keys[a]), int(a), int(b)) for a, b in zip(firsts, [*firsts[1:], len(keys)], strict=False)]


def best_fit_sequences(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, groups: int = GROUPS, end_id: int = 0
) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` ids; one row per piece."""
    spark = docs.sparkSession
    pieces = staged(tokenised_pieces(docs, path, capacity, end_id), "pieces")
    salts = max(16, partitions(spark))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "task"), F.lit(salts)))
    dealt = staged(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "length-counts")
    # At most ``capacity`` rows reach the driver.
    counts = {int(r["length"]): int(r["n"]) for r in dealt.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = pack(counts, capacity, groups)
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.select("length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = (
        salted.withColumn("own", F.row_number().over(own) - 1)
        .join(bases, ["length", "salt"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("own")).alias("rank"))
    )
    return place(ranked, placements(spark, runs))
