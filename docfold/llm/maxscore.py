"""Exact top-k search by inner product: MaxScore over postings, one set of postings per shard of the vectors.

A vector's components, scaled and rounded down to integers, are the weights of its terms; a term's postings are the vectors in which its
weight is not zero.  For a query each term has a bound, the most that any vector of the shard can gain by it.  Terms are put in
order of their bounds; those at the end whose bounds together stay below the k-th best score so far are not essential: a vector
that has none of the essential terms cannot come in.  The essential postings are traversed and added up; then the vectors met are
probed for the other terms, the largest bounds first, as long as their sum and the bounds still to come reach the k-th best score.

Vectors and queries are dealt into cells of one shard and one block of queries, of bounded size each.  Every query first
meets one shard, whose k-th best score is where it starts from in all the others, so that these give few rows to merge.  The number of
cells grows with vectors times queries, as it must where each query is held against every vector.

Definitions.  Vectors that are null or hold null or non-finite components take no part.  Vectors of different lengths go on with
zeros, so an empty vector scores 0.  Every row is a vector of its own, rows of one id too; only a query's own row is no
candidate of it.  Ties go to the smaller id, a missing id last.  Scores beyond 64 bits count as the nearest long.
An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfold.scratch import Scratch

K, SCALE = 20, 64
#: Vectors of a shard and queries of a block, on average.
SHARD, QUERIES = 1 << 13, 1 << 12
#: Terms probed between two looks at the bound.
STEP = 4
#: One in so many vectors of a shard may compete when probing begins.
CROWD = 8
_LONG = np.iinfo(np.int64)


def weights(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, with zeros up to ``width``."""
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in a kind of number in which every inner product and bound is exact."""
    most = max(1, a.shape[1]) * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    top = max(most, float(np.abs(a).max(initial=0)), float(np.abs(b).max(initial=0)))
    if top < 2**53:
        kind = np.float32 if top < 2**24 else np.float64
        return a.astype(kind), b.astype(kind)
    whole = np.frompyfunc(int, 1, 1)
    return whole(a).astype(object), whole(b).astype(object)


class Postings:
    """For each term the vectors that have it, with their weights, and the bounds of these."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors, self.n = vectors, len(vectors)
        self.ids = ids
        self.high = vectors.max(axis=0, initial=0)
        self.low = vectors.min(axis=0, initial=0)
        self.lists = []
        for j in range(vectors.shape[1]):
            docs = np.flatnonzero(vectors[:, j])
            # postings of most of the shard are kept as a whole column, which is added up faster
            self.lists.append((None, np.ascontiguousarray(vectors[:, j])) if 2 * len(docs) > self.n else (docs, vectors[docs, j]))

    def top(self, query: np.ndarray, k: int, least, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best with a score of ``least`` (if any) or more, without the place ``own``."""
        if query.dtype == object:  # sums beyond doubles: every term is essential
            scores = np.array([max(_LONG.min, min(_LONG.max, int(x))) for x in self.vectors @ query], object)
            alive = sorted((i for i in range(self.n) if i != own), key=lambda i: (-scores[i], self.ids[i]))[:k]
            return np.array(alive, int), scores[alive]
        terms = np.flatnonzero(query)
        bounds = np.maximum(query[terms] * self.high[terms], query[terms] * self.low[terms])
        order = np.argsort(-bounds, kind="stable")
        terms, bounds = terms[order], bounds[order]
        rest = np.concatenate([np.cumsum(bounds[::-1])[::-1], np.zeros(1, bounds.dtype)])  # what the terms from each on can add
        partial = np.zeros(self.n, query.dtype)
        done = self._traverse(query, terms, 0, len(terms) // 2 if least is None else int(np.searchsorted(-rest, -least, "right")), partial)
        if least is None and self.n > k + 1:
            best = np.argpartition(-partial, 2 * k)[: 2 * k + 1] if self.n > 2 * k + 1 else np.arange(self.n)
            best = best[best != own]
            scores = partial[best] + self._gain(best, query, terms[done:])
            if len(scores) >= k:
                least = np.sort(scores)[-k]
                done = self._traverse(query, terms, done, int(np.searchsorted(-rest, -least, "right")), partial)
        if least is None:
            done = self._traverse(query, terms, done, len(terms), partial)
        alive = self._alive(partial, rest[done], least)
        while done < len(terms) and len(alive) > self.n // CROWD:  # while most vectors compete, whole postings cost less than probes
            done = self._traverse(query, terms, done, done + STEP, partial)
            alive = self._alive(partial, rest[done], least)
        scores = partial[alive]
        while True:
            if least is not None:
                stay = scores + rest[done] >= least
                alive, scores = alive[stay], scores[stay]
            if done == len(terms) or not len(alive):
                break
            scores = scores + self._gain(alive, query, terms[done : done + STEP])
            done = min(len(terms), done + STEP)
        stay = alive != own
        alive, scores = alive[stay], scores[stay]
        order = np.lexsort((self.ids[alive], -scores))[:k]
        return alive[order], scores[order]

    def _alive(self, partial: np.ndarray, rest, least) -> np.ndarray:
        """Vectors that can still reach ``least``; one in no posting so far has only ``rest``."""
        return np.arange(self.n) if least is None else np.flatnonzero(partial + rest >= least)

    def _traverse(self, query, terms, done: int, until: int, partial: np.ndarray) -> int:
        """Adds up the postings of the essential terms from ``done`` to ``until``; how many are done."""
        for j in terms[done:until]:
            docs, values = self.lists[j]
            if docs is None:
                partial += query[j] * values
            else:
                partial[docs] += query[j] * values
        return max(done, min(until, len(terms)))

    def _gain(self, docs: np.ndarray, query: np.ndarray, terms: np.ndarray) -> np.ndarray:
        return self.vectors[docs].take(terms, axis=1) @ query[terms]


FOUND = "query bigint, query_id bigint, row bigint, vec_id bigint, score bigint"


def search_cell(k: int):
    """The best of a shard for each query of a block."""

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = [(), (), (), (), ()]
        if held.num_rows and asked.num_rows:
            held = held.sort_by("row")
            both = held["v"].combine_chunks(), asked["q"].combine_chunks()
            longest = max(int(np.diff(x.offsets.to_numpy()).max()) for x in both)
            vectors, queries = exact(*(weights(x, longest) for x in both))
            rows, ids = held["row"].to_numpy(), held["id"].fill_null(_LONG.max).to_numpy()
            shard = Postings(vectors, ids)
            at = np.searchsorted(rows, asking := asked["query"].to_numpy())
            own = np.where(rows[np.minimum(at, len(rows) - 1)] == asking, at, -1)
            parts = []
            for i, (query, start) in enumerate(zip(queries, asked["start"].to_pylist(), strict=True)):
                found, scores = shard.top(query, k, start, int(own[i]))
                parts.append((np.full(len(found), i), found, scores.astype(np.int64)))
            q, found, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
            out = [asking[q], asked["query_id"].to_numpy()[q], rows[found], held["id"].take(pa.array(found)), scores]
        kinds = [pa.int64()] * 5
        return pa.table([x if isinstance(x, pa.ChunkedArray) else pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["query", "query_id", "row", "vec_id", "score"])

    return run


def _dealt(row: str, parts: int, salt: int) -> Column:
    return F.pmod(F.xxhash64(F.col(row), F.lit(salt)), F.lit(parts)).cast("int")


def _every(parts: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))


def top_k(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """query_id, rank, id and score of the k best rows for each row that satisfies ``queries``."""
    scratch = Scratch(vectors.sparkSession, "maxscore")
    v = F.col(vector_col)
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(sound).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: x.cast("double")).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    rows = scratch.write(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("asks")).first()
    shards, blocks = max(1, -(-size["n"] // shard)), max(1, -(-size["asks"] // block))
    held = rows.select(_dealt("row", shards, 1).alias("shard"), "row", "id", "v")
    asked = rows.where("asks").select(_dealt("row", blocks, 2).alias("in_block"), F.col("row").alias("query"), F.col("id").alias("query_id"), F.col("v").alias("q"))

    def searched(asked: DataFrame, held: DataFrame, shards: Column) -> DataFrame:
        left = held.select("shard", _every(blocks).alias("block"), "row", "id", "v").groupBy("shard", "block")
        right = asked.select(shards.alias("in_shard"), "in_block", "query", "query_id", "q", "start").groupBy("in_shard", "in_block")
        return left.cogroup(right).applyInArrow(search_cell(k), FOUND)

    first = scratch.write(searched(asked.withColumn("start", F.lit(None).cast("long")), held.where("shard = 0"), F.lit(0)), "first")
    starts = first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("start")).where(F.col("n") >= k).select("query", "start")
    found = first
    if shards > 1:
        later = searched(asked.join(starts, "query", "left"), held.where("shard > 0"), F.explode(F.sequence(F.lit(1), F.lit(shards - 1))))
        found = first.unionByName(later)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias(id_col), "score")
