"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

Candidates lie in one component of SimHash fingerprints (of the shingle sets, linked by ``simhash`` within its radius), or
share a band of MinHash values, which finds those whose fingerprints lie further apart. A fingerprint component is one more
band value. Every link is confirmed on the whole shingle sets. With ``BANDS`` bands of
``ROWS`` values a pair of similarity s is a candidate with probability 1 - (1 - s^ROWS)^BANDS: 0.99999 at 0.8.

Documents with equal shingle sets are one node. In each band value nodes are first compared with the least and the
greatest node of it, which links a large group of copies without comparing all its pairs. Band values that still hold
several components are then compared whole, tile by tile: nodes are dealt to tiles of about ``TILE_SHINGLES`` shingles, and
a task counts the common shingles of all pairs of two tiles at once, as a product of two matrices. No pair becomes a row:
a task gives the links that join components, fewer than it has nodes, so what is written grows with the nodes of a band and
the number of its tiles. All candidates are compared; none are capped or dropped.

Defined results: null and empty texts are equal; a text of fewer words than a shingle is one shingle; words are those of
``simhash``; rows that repeat a doc_id are told apart by their texts, and of equal rows one stays; texts of any length are
compared whole; columns may have any names and types and are returned as they are; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouvidoria.llm import simhash
from ouvidoria.llm.common import staged, text_or_empty
from ouvidoria.llm.components import roots
from ouvidoria.llm.exact_dedup import digest_column, rows_at

SHINGLE = 5
# The least similarity, as a fraction.
SIMILAR = (4, 5)
# Shingles of the nodes of one tile; a single node may have more.
TILE_SHINGLES = 200_000
BANDS = 48
ROWS = 7
SEED = 42


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct word shingles, in order."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
    ends = (starts[min(shingle, len(words)) :] - 1).tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends, strict=False)])
    return np.unique(np.frombuffer(hashes, ">u8").astype(np.uint64))


def node_of(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def band_values(hashes: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One number per band, from the least values of the hashes under ``rows`` multiplications."""
    rng = np.random.default_rng(SEED)
    times = rng.integers(0, 2**64, bands * rows, dtype=np.uint64) | np.uint64(1)
    mixed = rng.integers(0, 2**64, (bands, rows), dtype=np.uint64) | np.uint64(1)
    least = np.full(bands * rows, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 256):
        np.minimum(least, (hashes[at : at + 256, None] * times).min(axis=0), out=least)
    least = least.reshape(bands, rows)
    return ((least ^ (least >> np.uint64(32))) * mixed).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, node, number of shingles, band values and SimHash fingerprint of every row."""

    def run(frames):
        for frame in frames:
            rows = []
            for text in frame["text"]:
                hashes = shingle_set(text)
                rows.append((node_of(hashes), len(hashes), band_values(hashes).view(np.int64), simhash.majority(hashes)))
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].astype("Int64"),
                    "digest": frame["digest"],
                    "node": np.array([r[0] for r in rows], np.uint64).view(np.int64),
                    "size": [r[1] for r in rows],
                    "bands": [r[2] for r in rows],
                    "fp": np.array([r[3] for r in rows], np.uint64).view(np.int64),
                }
            )

    texts = docs.select("doc_id", digest_column().alias("digest"), text_or_empty().alias("text"))
    return texts.mapInPandas(run, "doc_id long, digest binary, node long, size long, bands array<long>, fp long")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(node, hashes) of every row."""

    def run(frames):
        for frame in frames:
            sets = [shingle_set(t) for t in frame["text"]]
            nodes = np.array([node_of(s) for s in sets], np.uint64).view(np.int64)
            yield pd.DataFrame({"node": nodes, "hashes": [s.view(np.int64) for s in sets]})

    return docs.select(text_or_empty().alias("text")).mapInPandas(run, "node long, hashes array<long>")


def similar(both: Column, a: Column, b: Column, least: tuple[int, int] = SIMILAR) -> Column:
    """Whether sets of sizes ``a`` and ``b`` with ``both`` in common are similar enough."""
    return both * least[1] >= (a + b - both) * least[0]


def confirmed(pairs: DataFrame, sets: DataFrame, least: tuple[int, int] = SIMILAR) -> DataFrame:
    """The pairs (a, b) of nodes whose whole shingle sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    found = pairs.join(left, "a").join(right, "b")
    return found.filter(similar(both, F.size("of_a"), F.size("of_b"), least)).select("a", "b")


def common_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of ``a`` shares with each of ``b``. Sets hold no hash twice."""
    flat = np.concatenate([*a, *b]) if a or b else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in (*a, *b)])
    _, of, n = np.unique(flat, return_inverse=True, return_counts=True)
    kept = n[of] > 1  # what one set has alone is common to none
    flat, row = np.unique(of[kept], return_inverse=True)[1], row[kept]
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    out = np.zeros((len(a), len(b)), np.float32)
    step = max(1, 8_000_000 // max(1, len(a) + len(b)))
    for first in range(0, int(flat[-1]) + 1 if len(flat) else 0, step):
        lo, hi = np.searchsorted(flat, [first, first + step])
        has = np.zeros((len(a) + len(b), step), np.float32)
        has[row[lo:hi], flat[lo:hi] - first] = 1
        out += has[: len(a)] @ has[len(a) :].T
    return out.astype(np.int64)


def joining_links(roots_a, sets_a, roots_b, sets_b, least: tuple[int, int] = SIMILAR) -> list[tuple[int, int]]:
    """Pairs of components (by their roots) that similar sets join; fewer than there are components."""
    sizes_a, sizes_b = (np.array([len(s) for s in x], np.int64) for x in (sets_a, sets_b))
    both = common_counts(sets_a, sets_b)
    near = both * least[1] >= (sizes_a[:, None] + sizes_b[None, :] - both) * least[0]
    apart = np.asarray(roots_a)[:, None] != np.asarray(roots_b)[None, :]
    i, j = np.nonzero(near & apart)
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    links = []
    for x, y in set(zip(np.asarray(roots_a)[i].tolist(), np.asarray(roots_b)[j].tolist(), strict=True)):
        p, q = top(x), top(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            links.append((min(x, y), max(x, y)))
    return links


def tiled_links(placed: DataFrame, sets: DataFrame, tile: int = TILE_SHINGLES, least: tuple[int, int] = SIMILAR) -> DataFrame:
    """(a, b): links between the components of (band, node, size, root), of all pairs that share a band value."""
    # A node without shingles is like no other node, and takes no place.
    tiles = placed.groupBy("band").agg(F.ceil(F.sum("size") / tile).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("node", "band"), F.col("tiles")).cast("int")
    dealt = placed.join(tiles, "band").select("band", "node", "root", own.alias("own"), "tiles")
    # Every pair of tiles is one group, so a node goes to as many groups as its band has tiles.
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    spread = dealt.select("band", "node", "root", "own", every)
    spread = spread.select(
        "band", "node", "root", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")
    )
    rows = spread.join(sets.dropDuplicates(["node"]), "node")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(frame["lo"].iloc[0]), int(frame["hi"].iloc[0])
        sides = []
        for side in (lo, hi):
            mine = frame[frame["own"] == side]
            sides += [mine["root"].to_numpy(np.int64), [np.asarray(h, np.int64) for h in mine["hashes"]]]
        return pd.DataFrame(joining_links(*sides, least), columns=["a", "b"], dtype="int64")

    return rows.groupBy("band", "lo", "hi").applyInPandas(run, "a long, b long")


def fingerprint_bands(nodes: DataFrame) -> DataFrame:
    """(node, size, band): the SimHash component of every node, as a band value of its own."""
    distinct = staged(nodes.select("fp").distinct(), "near-fingerprints")
    found = staged(simhash.rooted_fingerprints(distinct), "near-fingerprint-roots")
    rooted = nodes.select("size", "fp", F.col("node").alias("of")).join(found, F.col("fp") == F.col("node"), "left")
    return rooted.select(F.col("of").alias("node"), "size", F.xxhash64(F.lit("simhash"), F.coalesce("root", "fp")).alias("band"))


def components(docs: DataFrame, nodes: DataFrame, least: tuple[int, int] = SIMILAR, tile: int = TILE_SHINGLES) -> DataFrame:
    """(node, root) of all nodes that are linked to another."""
    members = nodes.select("node", "size", F.explode("bands").alias("band")).union(fingerprint_bands(nodes))
    ends = members.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi")
    members = staged(members.join(ends, "band"), "near-members")
    # Sets whose sizes alone forbid it are not compared.
    may = similar(F.least("sa", "sb"), F.col("sa"), F.col("sb"), least)
    sized = nodes.select(F.col("node").alias("end"), F.col("size").alias("end_size"))
    ended = members.select("node", "size", F.explode(F.array("lo", "hi")).alias("end")).filter("node <> end").distinct()
    starred = ended.join(sized, "end").select(
        F.least("node", "end").alias("a"), F.greatest("node", "end").alias("b"), F.col("size").alias("sa"), F.col("end_size").alias("sb")
    )
    stars = staged(starred.filter(may).select("a", "b").distinct(), "near-stars")
    used = members.select("node").distinct()
    places = nodes.join(used, "node", "left_semi").select("least.digest", F.col("least.doc_id").alias("stay"))
    chosen = rows_at(docs.select("doc_id", "text"), staged(places, "near-places"))
    sets = staged(shingle_sets(chosen), "near-sets")
    links = staged(confirmed(stars, sets, least), "near-star-links")
    found = staged(roots(links), "near-roots")

    placed = members.join(found, "node", "left").select("band", "node", "size", F.coalesce("root", "node").alias("root"))
    open_ = placed.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("band")
    placed = staged(placed.join(open_, "band", "left_semi"), "near-open")
    more = tiled_links(placed, sets, tile, least)
    return roots(staged(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more), "near-links"))


def representatives(docs: DataFrame, least: tuple[int, int] = SIMILAR) -> DataFrame:
    """One row of ``docs``, with all its columns, of each component: that of the smallest doc_id.

    ``least`` is the least similarity, as a fraction; the bands are laid out for 0.8 or more. Rows without an id come after
    all others and are told apart by their texts.
    """
    rows = staged(signatures(docs), "near-signatures")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    nodes = rows.groupBy("node").agg(F.first("size").alias("size"), *[F.first(c).alias(c) for c in ("bands", "fp")], F.min(place).alias("least"))
    nodes = staged(nodes, "near-nodes")
    found = components(docs, nodes, least)
    rooted = nodes.select("node", "least").join(found, "node", "left")
    stay = rooted.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("least").alias("least"))
    return rows_at(docs, staged(stay.select("least.digest", F.col("least.doc_id").alias("stay")), "near-stay"))
