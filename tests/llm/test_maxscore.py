"""Exact top-k search against brute force, and against SQL."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docfold.llm import maxscore, oracle, queries
from tests.oracle import connect, same

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, asks):
    whole = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(whole):
        if i is not None and i % asks == 0:
            found = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(q, v)))), j is None, j or 0, j) for b, (j, v) in enumerate(whole) if b != a)  # noqa: B905
            out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(found[:k])]
    return sorted(out, key=str)


def compare(spark, rows, k=20, asks=20, **sizes):
    got = maxscore.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % asks == 0, k=k, **sizes)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, k, asks)


def vectors(n, width, seed, zero=0.0, step=None):
    r = random.Random(seed)
    one = lambda: 0.0 if r.random() < zero else r.gauss(0, 0.3) if step is None else r.choice([-step, 0.0, step])
    return [(i, [one() for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("zero, step", [(0.0, None), (0.9, None), (0.5, 0.02)])
def test_by_brute_force(spark, zero, step):
    """Dense, sparse and tied vectors, over several shards and blocks."""
    compare(spark, vectors(600, 24, 3, zero, step), shard=150, block=10)


def test_odd_rows(spark):
    """Nulls, non-finite numbers, empty and unequal lengths, repeated ids and rows, fewer candidates than asked for, more columns, no rows."""
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [-1.0]), (20, []), (40, None), (60, [1.0, None]), (80, [nan]), (100, [inf, 1.0]), (None, [3.0, 3.0]), (3, [0.5, -0.5, 9.0]), (120, [0.0, 0.0]), (-20, [-3.0, 1.0])]
    compare(spark, rows)
    compare(spark, rows, k=2, shard=2, block=1)
    compare(spark, [(0, [1.0])])
    found = maxscore.top_k(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as row", "2 as score", "3 as v", "4 as id", "5 as shard"), F.col("vec_id") % 20 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"] and found.count() > 0
    assert maxscore.top_k(spark.createDataFrame(rows, SCHEMA).limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_large_numbers(spark):
    """Products beyond 32 and 64 bits."""
    for size in (1e5, 1e12):
        compare(spark, [(i, [size * x for x in v]) for i, v in vectors(60, 5, 9)], k=4, shard=20)


def test_terms_are_left_out():
    """On vectors with few large components most postings are never read."""
    r = np.random.default_rng(1)
    v = (r.standard_normal((4000, 60)) * np.exp(-np.arange(60) / 3) * 64).astype(np.int32).astype(np.float64)
    shard, read = maxscore.Postings(v, np.arange(4000)), []
    traverse = shard._traverse
    shard._traverse = lambda query, terms, done, until, *a: read.append(until - done) or traverse(query, terms, done, until, *a)
    for q in range(0, 400, 20):
        scores = v @ v[q]
        scores[q] = scores.min()
        want = np.sort(scores)[-5:][::-1]
        assert list(shard.top(v[q], 5, int(want[-1]), q)[1]) == list(want)
    assert np.mean(read) < 20


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    same(spark, connect(sf), queries.op12_max_score, oracle.OP12, sf)
