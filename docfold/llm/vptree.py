"""Approximate nearest neighbours by vantage-point trees, one per shard of the vectors.

Vectors are scaled to length one; the distance of two is then a metric that orders as cosine does.  A tree splits its
vectors at the middle of their distances to a vantage point and keeps the least and the largest distance of either side.
By the triangle inequality a query at distance d of the vantage point is at least low - d or d - high away from all of a
side; the largest such gap on the way to a leaf bounds the leaf.  A search leaves out a leaf if

    largest gap + (factor - 1) * root of the sum of squared gaps > distance of the k-th found,

so factor one is exact, and a larger factor leaves out more: gaps to vantage points that have nothing to do with one another
add up about as the sides of a right triangle do, though nothing guarantees it.  Leaves are visited from the least gap on,
in waves that double, each wave for a block of queries at once.

Every vector is indexed, in one shard of at most ``SHARD_BYTES``, every query visits every shard, and the best of all shards
are merged.  Queries are streamed past the tree in blocks, so memory does not grow with them.

Definitions.  Vectors that are null or zero or hold null or non-finite components take no part, nor do those whose
length is not the most common one.  Ties go to the smaller id.  A query's own id is no candidate.  Rows that repeat an
id are one vector, the smallest.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docfold.scratch import Scratch

K, FACTOR, SHARD_BYTES, LEAF = 5, 4.5, 1 << 23, 16
#: Queries searched at once, leaves of the first wave, candidates held before they are merged.
BLOCK, FIRST, HELD = 256, 4, 1 << 20
#: What rounding may add to a distance or a score.
SLACK = 1e-7


class VantageTree:
    """A complete binary tree; node i has the children 2 i + 1 and 2 i + 2, and the leaves follow the inner nodes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, seed: int = 7):
        """Vectors are float64 of any length but zero.  Of equal ones k + 1 stand for all, as a query finds only the smallest ids."""
        order = np.argsort(ids, kind="stable")
        _, same = np.unique(np.ascontiguousarray(vectors[order]).view(f"V{8 * vectors.shape[1]}").ravel(), return_inverse=True)
        by = np.argsort(same, kind="stable")
        turn = np.empty(len(ids), np.int64)
        turn[by] = np.arange(len(ids)) - np.searchsorted(same[by], same[by])
        order = order[turn <= k]
        ids = ids[order]
        self.ids, self.vectors = ids, np.ascontiguousarray(vectors[order])
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.unit = self.vectors / self.norms[:, None]
        self.depth = max(0, int(np.ceil(np.log2(max(1, len(ids)) / LEAF))))
        self.visited = self.offered = 0
        random = np.random.Generator(np.random.PCG64(seed))
        inner = 2**self.depth - 1
        self.vantage, self.bounds = np.zeros(inner, np.int64), np.zeros((inner, 2, 2))
        parts = [np.arange(len(ids))]
        for at in range(inner):
            rows = parts[at]
            v = int(rows[random.integers(len(rows))])
            d = np.sqrt(np.maximum(0.0, 2 - 2 * (self.unit[rows] @ self.unit[v])))
            by, half = np.argsort(d, kind="stable"), len(rows) // 2
            self.vantage[at] = v
            for side, x in enumerate((by[:half], by[half:])):
                self.bounds[at, side] = d[x].min(), d[x].max()
                parts.append(rows[x])
            parts[at] = None
        self.leaves = parts[inner:]

    def gaps(self, unit: np.ndarray, factor: float) -> np.ndarray:
        """The relaxed gap of each leaf (a column) to each query (a row)."""
        d = np.sqrt(np.maximum(0.0, 2 - 2 * (unit @ self.unit[self.vantage].T)))
        most = squares = np.zeros((len(unit), 1))
        for level in range(self.depth):
            at = slice(2**level - 1, 2 ** (level + 1) - 1)
            low, high = self.bounds[at, :, 0], self.bounds[at, :, 1]
            gap = np.maximum(0.0, np.maximum(low - d[:, at, None], d[:, at, None] - high))
            most = np.maximum(most[:, :, None], gap).reshape(len(unit), -1)
            squares = (squares[:, :, None] + gap * gap).reshape(len(unit), -1)
        return most + (factor - 1) * np.sqrt(squares)

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of the k nearest found of each query; queries by number."""
        norms = np.sqrt((queries * queries).sum(axis=1))
        gaps = self.gaps(queries / norms[:, None], factor)
        order = np.argsort(gaps, axis=1, kind="stable")
        best, score = np.full((len(queries), k), np.iinfo(np.int64).max), np.full((len(queries), k), -np.inf)
        held: list[tuple] = []

        def merge() -> None:
            nonlocal best, score
            if held:
                n = np.arange(len(queries))
                q, i, s = (np.concatenate(x) for x in zip((np.repeat(n, k), best.ravel(), score.ravel()), *held, strict=True))
                by = np.lexsort((i, -s, q))
                first = np.searchsorted(q[by], n)
                by = by[first[:, None] + np.arange(k)]
                best, score = i[by], s[by]
                held.clear()

        lo, hi, wait = 0, min(FIRST, len(self.leaves)), 0
        self.offered += gaps.size
        while lo < len(self.leaves):
            reach = np.sqrt(np.maximum(0.0, 2 - 2 * score[:, -1])) + SLACK  # a chord c has cosine 1 - c * c / 2
            q, rank = np.nonzero(np.take_along_axis(gaps, order[:, lo:hi], 1) <= reach[:, None])
            if not len(q):
                break
            leaf = order[q, lo + rank]
            self.visited += len(q)
            by = np.argsort(leaf, kind="stable")
            q, leaf = q[by], leaf[by]
            cut = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1]]))
            for a, b in zip(cut, [*cut[1:], len(leaf)], strict=True):
                rows, who = self.leaves[leaf[a]], q[a:b]
                rough = (queries[who] @ self.vectors[rows].T) / (norms[who, None] * self.norms[rows])
                i, j = np.nonzero((rough >= score[who, -1:] - SLACK) & (self.ids[rows] != own[who, None]))
                x, y = who[i], rows[j]
                exact = (self.vectors[y] * queries[x]).sum(axis=1) / (self.norms[y] * norms[x])  # the same sum whatever the block
                held.append((x, self.ids[y], exact))
                wait += len(x)
                if wait > HELD:
                    merge()
                    wait = 0
            merge()
            wait, lo, hi = 0, hi, min(len(self.leaves), 2 * hi)
        q, j = np.nonzero(score > -np.inf)
        return q, best[q, j], score[q, j]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def search_batches(k: int, factor: float):
    """Input is sorted by shard, a shard's vectors before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, tree = None, [], None
        for batch in batches:
            shards, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(np.concatenate([[True], (shards[1:] != shards[:-1]) | (asks[1:] != asks[:-1])])) if len(shards) else []
            for lo, hi in zip(cut, [*cut[1:], len(shards)], strict=True):
                part = batch.slice(lo, hi - lo)
                if shards[lo] != shard:
                    shard, held, tree = shards[lo], [], None
                ids, vectors = part.column(2).to_numpy(), _matrix(part.column(3))
                if not asks[lo]:
                    held.append((ids, vectors))
                    continue
                if tree is None:
                    if not held:
                        continue
                    tree = VantageTree(np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held]), k)
                    held = []
                for at in range(0, len(ids), BLOCK):
                    q, found, score = tree.search(ids[at : at + BLOCK], vectors[at : at + BLOCK], k, factor)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at + q]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, factor: float = FACTOR, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """query_id, rank, id and score of the k nearest found of each row that ``queries``, a condition on the id, picks."""
    scratch = Scratch(vectors.sparkSession, "vptree")
    v = F.col(vector_col)
    sound = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(sound).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: x.cast("double")).alias("v"))
    rows = scratch.write(rows.groupBy("id").agg(F.min("v").alias("v")), "vectors")
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    d, n = (sizes["d"], sizes["count"]) if sizes else (0, 0)
    rows = rows.where(F.size("v") == d)
    shards = max(1, -(-8 * d * n // shard_bytes))
    held = rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asks"), "id", "v")
    asked = rows.where(queries(F.col("id"))).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("asks"), "id", "v")
    laid = held.unionByName(asked).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "asks")  # a shard a task
    found = laid.mapInArrow(search_batches(k, factor), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(id_col), "score")
