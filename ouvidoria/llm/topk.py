"""Exact top-k inner products over norm-sorted, SVD-rotated vectors.

Vectors are rotated by the right singular vectors of the whole table (from its d x d second moments), so that the first
coordinates carry most of a product, sorted by descending length, and cut into parts. The longest vectors give every
query a first threshold, and with it the length below which no vector can matter to it; queries of like lengths form
blocks. Blocks meet the parts that are long enough for them, as rows of one join, so there is one job for any number of
queries. In a part a run of vectors is left out for a query if length times length cannot reach its threshold, and a
vector if, after the first 8, 16, 32 ... coordinates, the partial sum plus the Cauchy-Schwarz bound of the rest cannot.
What survives is scored with whole numbers. Bounds are widened by the rounding error, so no answer is lost.

Defined results: rows without an id, and vectors that are null, or hold null or non-finite components, take no part; shorter vectors are padded
with zeros; scores beyond 64 bits are clipped to the nearest; rows with the query's own id are no candidates of it, and
rows that repeat a query ask once; equal scores rank by smaller vec_id; other columns are not read; an empty table gives
no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ouvidoria.llm.common import partitions, staged

SCALE = 1024
K = 10
QUERY_BLOCK = 4096
HEAD = 2048
# Vectors that a part has at least, but for the last of a stretch, and blocks that a task keeps open.
PART_ROWS = 4096
OPEN_BLOCKS = 8
RUN = 1024
# Numbers of paired vectors that are held at once, whatever a block holds; pairs are multiplied as matrices when more than
# one in DENSE of them is left.
NUMBERS = 1 << 22
DENSE = 8
LONG = 2**63 - 1
SCORES = "query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and floor(scale * x) of every component, as exact doubles; rows that take no part are gone."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    # Spark's floor gives a long and would clip; a double beyond 2**52 has no fraction left to cut.
    floor = lambda v: F.when(F.abs(v) < 2.0**52, F.floor(v).cast("double")).otherwise(v)
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine).select(
        "vec_id", F.transform(x, lambda v: floor(v * float(scale))).alias("v")
    )


def padded(column: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def rotation(rows: DataFrame, dims: int) -> np.ndarray:
    """Right singular vectors of the table, from second moments summed per task; the driver gets d x d numbers a task."""

    def run(frames):
        total = np.zeros((dims, dims))
        for frame in frames:
            block = padded(frame["v"], dims)
            top = np.abs(block).max(initial=0.0)
            # Lengths beyond the range of squares only weigh in by direction: the rotation is free to be any.
            total += (block / max(top, 1.0)).T @ (block / max(top, 1.0))
        yield pd.DataFrame({"i": np.repeat(np.arange(dims), dims), "j": np.tile(np.arange(dims), dims), "s": total.ravel()})

    parts = rows.select("v").mapInPandas(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    moments = np.zeros((dims, dims))
    for r in parts.collect():
        moments[r["i"], r["j"]] = r["s"]
    values, basis = np.linalg.eigh((moments + moments.T) / 2)
    return basis[:, np.argsort(-values)]


def fits(q: np.ndarray, v: np.ndarray) -> bool:
    """Whether all inner products of these rows, in any order of adding, are exact in doubles."""
    return q.shape[1] * np.abs(q).max(initial=0) * np.abs(v).max(initial=0) < 2.0**53


def whole_products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, exact: in doubles while all sums stay below 2**53, else in Python's integers."""
    if not len(q):
        return np.zeros(0, np.int64)
    if fits(q, v):
        return np.einsum("ij,ij->i", q, v).astype(np.int64)
    sums = (sum(int(x) * int(y) for x, y in zip(a, b, strict=True)) for a, b in zip(q, v, strict=True))
    return np.array([max(-LONG - 1, min(LONG, s)) for s in sums], dtype=np.int64)


class Search:
    """The k best of a stream of vectors for one block of queries."""

    def __init__(self, ids: np.ndarray, whole: np.ndarray, basis: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.whole, self.k = ids, whole, k
        self.turned = whole @ basis
        self.norm = np.linalg.norm(whole, axis=1)
        self.floor = floor.astype(float).copy()
        dims = whole.shape[1]
        self.cuts = [c for c in (8, 16, 32, 64, 128, 256) if c < dims]
        self.rest = {c: np.linalg.norm(self.turned[:, c:], axis=1) for c in self.cuts}
        self.q = np.zeros(0, np.int64)
        self.vec = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)

    def offer(self, ids: np.ndarray, whole: np.ndarray, turned: np.ndarray, norm: np.ndarray) -> None:
        longest = norm.max(initial=0.0)
        slack = 1e-9 * (1.0 + self.norm * longest)
        live = np.flatnonzero(self.norm * longest + slack >= self.floor)
        if not len(live) or not len(ids):
            return
        rest = {c: np.linalg.norm(turned[:, c:], axis=1) for c in self.cuts}
        found, size = [], 0
        step = max(1, NUMBERS // (whole.shape[1] * len(ids)))
        for at in range(0, len(live), step):
            few = live[at : at + step]
            i, j, score = self._meet(few, (self.floor - slack)[few], ids, whole, turned, rest)
            found.append((few[i], ids[j], score))
            size += len(score)
            if size * whole.shape[1] >= NUMBERS:
                self._keep(*map(np.concatenate, zip(*found, strict=True)))
                found, size = [], 0
        if found:
            self._keep(*map(np.concatenate, zip(*found, strict=True)))

    def _meet(self, few, bar, ids, whole, turned, rest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places and scores of the pairs of ``few`` queries with vectors that reach the queries' thresholds."""
        partial, last, pairs = 0.0, 0, len(few) * len(ids)
        i, j = np.divmod(np.arange(pairs), len(ids))
        for c in self.cuts:
            if not last:
                partial = self.turned[few, :c] @ turned[:, :c].T
                keep = partial + np.outer(self.rest[c][few], rest[c]) >= bar[:, None]
                i, j = np.nonzero(keep)
                partial = partial[keep]
            elif len(i) * DENSE > pairs:
                break  # Whole products cost less than looking up so many pairs.
            else:
                partial = partial + np.einsum("ij,ij->i", self.turned[few[i], last:c], turned[j, last:c])
                keep = partial + self.rest[c][few[i]] * rest[c][j] >= bar[i]
                i, j, partial = i[keep], j[keep], partial[keep]
            last = c
        other = self.ids[few[i]] != ids[j]
        i, j = i[other], j[other]
        if len(i) * DENSE > pairs and fits(self.whole[few], whole):
            score = (self.whole[few] @ whole.T)[i, j].astype(np.int64)
        else:
            score = whole_products(self.whole[few[i]], whole[j])
        fine = score >= self.floor[few[i]]
        return i[fine], j[fine], score[fine]

    def _keep(self, q: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        if not len(q):
            return
        q, vec, score = np.r_[self.q, q], np.r_[self.vec, vec], np.r_[self.score, score]
        # ~score orders from high to low without overflow.
        order = np.lexsort((vec, ~score, q))
        q, vec, score = q[order], vec[order], score[order]
        first = np.r_[0, np.flatnonzero(q[1:] != q[:-1]) + 1]
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        best = rank < self.k
        self.q, self.vec, self.score = q[best], vec[best], score[best]
        last = rank == self.k - 1
        # Doubles may round a large score up; one step down keeps ties.
        self.floor[q[last]] = np.maximum(self.floor[q[last]], np.nextafter(score[last].astype(float), -np.inf))


def numbers(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def matrix(held: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(held, np.float64).reshape(rows, -1)


def vector_parts(ordered: DataFrame, dims: int, part_rows: int) -> DataFrame:
    """(stretch, part, longest, ids, v): runs of norm-sorted vectors; a stretch is one range of lengths, cut into parts."""

    def run(frames):
        stretch = TaskContext.get().partitionId()
        part, held, size = 0, [], 0

        def packed():
            rows = pd.concat(held)
            ids, v = rows["vec_id"].to_numpy(np.int64), padded(rows["v"], dims)
            return pd.DataFrame([(stretch, part, rows["norm"].max(), numbers(ids), numbers(v))], columns=columns)

        columns = ["stretch", "part", "longest", "ids", "v"]
        for frame in frames:
            for at in range(0, len(frame), part_rows):
                # Whole slices only: a part has fewer than twice ``part_rows`` vectors.
                piece = frame.iloc[at : at + part_rows]
                held.append(piece)
                size += len(piece)
                if size >= part_rows:
                    yield packed()
                    part, held, size = part + 1, [], 0
        if held:
            yield packed()

    return ordered.mapInPandas(run, "stretch int, part int, longest double, ids binary, v binary")


def query_blocks(asked: DataFrame, basis, first, dims: int, k: int, block_rows: int) -> DataFrame:
    """(block, reach, ids, v, floor): queries with thresholds; no vector shorter than ``reach`` can matter to a block."""

    def threshold(frames):
        ids, whole = first.value
        turned, norm = whole @ basis.value, np.linalg.norm(whole, axis=1)
        for frame in frames:
            own = padded(frame["v"], dims)
            search = Search(frame["vec_id"].to_numpy(np.int64), own, basis.value, np.full(len(frame), -np.inf), k)
            for at in range(0, len(ids), RUN):
                to = slice(at, at + RUN)
                search.offer(ids[to], whole[to], turned[to], norm[to])
            with np.errstate(divide="ignore", invalid="ignore"):
                # A little less than the floor over the length; a query of length zero meets every vector, or none above 0.
                reach = np.where(search.norm > 0, search.floor / search.norm, np.where(search.floor <= 0, -np.inf, np.inf))
            reach = reach - 1e-6 * np.maximum(1.0, np.abs(np.nan_to_num(reach)))
            yield pd.DataFrame({"vec_id": frame["vec_id"], "v": frame["v"], "floor": search.floor, "reach": reach})

    def pack(frames):
        block = TaskContext.get().partitionId() << 32
        for frame in frames:
            for at in range(0, len(frame), block_rows):
                rows = frame.iloc[at : at + block_rows]
                held = rows["vec_id"].to_numpy(np.int64), padded(rows["v"], dims), rows["floor"].to_numpy(float)
                yield pd.DataFrame(
                    [(block, rows["reach"].min(), *map(numbers, held))], columns=["block", "reach", "ids", "v", "floor"]
                )
                block += 1

    known = staged(asked.mapInPandas(threshold, "vec_id long, v array<double>, floor double, reach double"), "thresholds")
    # Queries of like reach share a block, so that a block can leave out all vectors that are too short for it.
    count = max(1, -(-known.count() // block_rows))
    alike = known.repartitionByRange(count, "reach", F.xxhash64("vec_id")).sortWithinPartitions("reach")
    return staged(alike.mapInPandas(pack, "block long, reach double, ids binary, v binary, floor binary"), "query-blocks")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    scale: int = SCALE,
    query_block: int = QUERY_BLOCK,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """The ``k`` highest scores of every query (vec_id, embedding) among ``vectors``: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows = staged(whole_vectors(vectors, scale), "vectors")
    asked = staged(whole_vectors(queries, scale).dropDuplicates(["vec_id"]), "queries")
    shape = rows.agg(F.max(F.size("v")).alias("d")).first()["d"]
    dims = max(1, shape or 1)
    basis = spark.sparkContext.broadcast(rotation(rows, dims))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    # The hash parts vectors of one length.
    order = F.col("norm").desc(), F.xxhash64("vec_id")
    ordered = rows.withColumn("norm", length).repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    parts = staged(vector_parts(ordered, dims, part_rows), "norm-sorted")
    # At most HEAD vectors, whatever the table holds.
    head = rows.withColumn("norm", length).orderBy(F.col("norm").desc(), "vec_id").limit(HEAD).toPandas()
    first = spark.sparkContext.broadcast((head["vec_id"].to_numpy(np.int64), padded(head["v"], dims)))
    blocks = query_blocks(asked, basis, first, dims, k, query_block)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = grid(blocks, parts, basis, k)
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def grid(blocks: DataFrame, parts: DataFrame, basis, k: int) -> DataFrame:
    """Best candidates of the parts for the blocks of queries that they may matter to, in one job.

    The stretches, one per partition of the sorted vectors, say which parts are long enough for a block.
    """
    stretches = parts.groupBy("stretch").agg(F.max("longest").alias("longest"), F.count(F.lit(1)).alias("parts")).collect()
    if not stretches:
        return blocks.select(F.lit(0).cast("long").alias("query_id"), F.lit(0).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("score")).limit(0)
    listed = F.array(*[F.struct(F.lit(r["stretch"]).alias("s"), F.lit(r["longest"]).alias("l"), F.lit(r["parts"]).alias("n")) for r in stretches])
    near = blocks.select("*", F.explode(F.filter(listed, lambda r: r["l"] >= F.col("reach"))).alias("to"))
    sent = near.select(
        "block",
        F.col("ids").alias("q_ids"),
        F.col("v").alias("q_v"),
        "floor",
        F.col("to.s").alias("s"),
        F.explode(F.sequence(F.lit(0), F.col("to.n").cast("int") - 1)).alias("p"),
    )
    here = (F.col("s") == F.col("stretch")) & (F.col("p") == F.col("part"))
    pairs = sent.join(parts.hint("merge"), here).select("block", "q_ids", "q_v", "floor", "ids", "v")

    def scan(frames):
        # Blocks stay open from part to part, so that their thresholds rise; the oldest makes room.
        opened: dict[int, Search] = {}

        def answers(search):
            return pd.DataFrame({"query_id": search.ids[search.q], "vec_id": search.vec, "score": search.score})

        for frame in frames:
            for block, q_ids, q_v, floor, ids, v in frame.itertuples(index=False):
                search = opened.pop(block, None)
                if search is None:
                    own = np.frombuffer(q_ids, np.int64)
                    search = Search(own, matrix(q_v, len(own)), basis.value, np.frombuffer(floor), k)
                    if len(opened) >= OPEN_BLOCKS:
                        yield answers(opened.pop(next(iter(opened))))
                opened[block] = search
                ids = np.frombuffer(ids, np.int64)
                whole = matrix(v, len(ids))
                turned, norm = whole @ basis.value, np.linalg.norm(whole, axis=1)
                for at in range(0, len(ids), RUN):
                    to = slice(at, at + RUN)
                    search.offer(ids[to], whole[to], turned[to], norm[to])
        for search in opened.values():
            yield answers(search)

    return pairs.mapInPandas(scan, SCORES)
