"""SimHash near-dedup by tiled exact comparison.

Equal fingerprints are one node. Distinct fingerprints are dealt to tiles by the population counts of their segments:
two fingerprints whose segment counts differ by more than the radius in sum cannot be within the radius, so such pairs
of tiles are skipped, and every pair that may link is compared exactly with exclusive-or and bit counts in numpy. With
one segment this is the plain population count; more segments skip more tile pairs and lose no link. Tiles hold at most
``TILE`` fingerprints; fuller ones are cut by hash into chunks. Links become components by star contraction.

Defined results: null and empty texts have fingerprint zero and are linked like any other; rows that repeat a doc_id are
one document; component_id is null only if no document of a component has an id; texts of any length are read whole;
other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouvidoria.llm.common import staged, text_or_empty
from ouvidoria.llm.components import roots

SHINGLE = 3
RADIUS = 2
SEED = 42
SEGMENTS = 4
TILE = 2048


def fingerprint_of(text: str, shingle: int = SHINGLE) -> int:
    """Majority of the hash bits of all word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        hashes = digest(joined, SEED)
        n, ones = 1, np.unpackbits(np.frombuffer(hashes, np.uint8)).astype(np.int64)
    else:
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
        ends = (starts[shingle:] - 1).tolist()
        n, ones = len(ends), np.zeros(64, np.int64)
        begin = starts.tolist()
        for at in range(0, n, 65_536):
            block = b"".join(
                [digest(joined[s:e], SEED) for s, e in zip(begin[at : at + 65_536], ends[at : at + 65_536], strict=False)]
            )
            bits = np.unpackbits(np.frombuffer(block, np.uint8)).reshape(-1, 64)
            ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of hashes that are there already, each counted once."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at : at + 65_536].astype(">u8").view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint as a signed 64-bit number."""

    def run(frames):
        for frame in frames:
            bits = np.array([fingerprint_of(t, shingle) for t in frame["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "fp": bits.view(np.int64)})

    return docs.select("doc_id", text_or_empty().alias("text")).mapInPandas(run, "doc_id long, fp long")


def segment_counts(fp: Column, segments: int) -> list[Column]:
    """Population count of each of ``segments`` equal parts of the fingerprint."""
    width = 64 // segments
    if segments == 1:
        return [F.bit_count(fp)]
    mask = F.lit((1 << width) - 1)
    return [F.bit_count(F.shiftrightunsigned(fp, width * i).bitwiseAND(mask)) for i in range(segments)]


def neighbour_steps(segments: int, radius: int) -> list[tuple[int, ...]]:
    """Half of the steps between tiles whose counts differ by at most ``radius`` in sum: no pair is visited twice."""
    zero = (0,) * segments
    steps = product(range(-radius, radius + 1), repeat=segments)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= zero]


def close_pairs(distinct: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS, tile: int = TILE) -> DataFrame:
    """(a, b): all pairs of distinct fingerprints (column fp) that differ in at most ``radius`` bits."""
    base = 65
    key = sum((c.cast("long") * base**i for i, c in enumerate(segment_counts(F.col("fp"), segments))), F.lit(0).cast("long"))
    keyed = distinct.select("fp", key.alias("key"))
    sizes = keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / tile).alias("chunks"))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    tiles = staged(
        keyed.join(sizes, "key").groupBy("key", chunk.alias("chunk")).agg(F.collect_list("fp").alias("fps")), "tiles"
    )
    steps = F.array(*[F.lit(sum(d * base**i for i, d in enumerate(s))).cast("long") for s in neighbour_steps(segments, radius)])
    left = tiles.select(
        F.col("key").alias("ka"), F.col("chunk").alias("ca"), F.col("fps").alias("fa"), F.explode(steps).alias("step")
    ).withColumn("key", F.col("ka") + F.col("step"))
    pairs = left.join(tiles, "key").filter((F.col("step") != 0) | (F.col("ca") <= F.col("chunk")))
    pairs = pairs.select("fa", F.col("fps").alias("fb"), ((F.col("step") == 0) & (F.col("ca") == F.col("chunk"))).alias("own"))

    def run(frames):
        for frame in frames:
            a, b = [], []
            for fa, fb, own in zip(frame["fa"], frame["fb"], frame["own"], strict=True):
                x, y = np.asarray(fa, np.int64).view(np.uint64), np.asarray(fb, np.int64).view(np.uint64)
                for at in range(0, len(x), 512):
                    i, j = np.nonzero(np.bitwise_count(x[at : at + 512, None] ^ y[None, :]) <= radius)
                    i = i + at
                    if own:
                        i, j = i[i < j], j[i < j]
                    a.append(x[i])
                    b.append(y[j])
            a, b = (np.concatenate(v) if v else np.zeros(0, np.uint64) for v in (a, b))
            yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return pairs.mapInPandas(run, "a long, b long")


def rooted_fingerprints(distinct: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS, tile: int = TILE) -> DataFrame:
    """(node, root) of the distinct fingerprints (column fp) that links within the radius join to another."""
    return roots(staged(close_pairs(distinct, radius, segments, tile), "links"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, segments: int = SEGMENTS, tile: int = TILE
) -> DataFrame:
    """doc_id, fp, component_id of every row: the smallest doc_id reachable over links, itself included."""
    rows = staged(fingerprints(docs, shingle), "fingerprints")
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = rooted_fingerprints(distinct, radius, segments, tile)
    rooted = distinct.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    names = staged(rooted.join(named, "root").select("fp", "component_id"), "components")
    return rows.join(names.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def representatives(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all columns, of the document with the smallest id of each component.

    Components without any id are kept; rows that repeat a doc_id all stay with it.
    """
    stay = near_duplicates(docs, **options).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = staged(stay.select(F.col("doc_id").alias("_stay")).distinct(), "stay")
    return docs.join(stay, F.col("doc_id").eqNullSafe(F.col("_stay")), "left_semi")
