"""The Merkle manifest against one written out in plain Python, and against SQL."""

import random
import zlib
from hashlib import sha256

import pytest

from docfold.llm import manifest, oracle, queries
from tests.oracle import connect, same


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    values = [row[0], row[3], row[2], row[4], row[1].translate(low) if lower and row[1] is not None else row[1]]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """All levels of a tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def way(levels, i):
    """Siblings of a node on the way up, with its place among them."""
    for nodes in levels[:-1]:
        run = nodes[i // 8 * 8 : i // 8 * 8 + 8]
        yield i % 8, run[: i % 8] + run[i % 8 + 1 :]
        i //= 8


def brute(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = tree([leaf(r) for r in by_lang[lang]])
    top = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for place, lang in enumerate(langs):
        for i, r in enumerate(by_lang[lang]):
            steps = [*way(trees[lang], i), *way(top, place)]
            node = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0)
            for k, siblings in steps:
                node = h("".join(siblings[:k]) + node + "".join(siblings[k:]))
            out.append((r[0], leaf(r), trees[lang][-1][0], top[-1][0], h("".join(x for _, s in steps for x in s)), node, node == top[-1][0]))
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def some_rows(n, seed=1):
    r = random.Random(seed)
    return [(i, r.choice(["Some Text", "no capitals", "", "Été 中", "x" * 5000]) + str(i), r.choice(["en"] * 9 + ["fr", None, ""]), r.choice(["a", None, "b"]), r.choice([1, None, -5])) for i in range(n)]


def compare(spark, rows):
    got = [tuple(r) for r in manifest.manifest(spark.createDataFrame(rows, SCHEMA)).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("n", [1, 65, 600])
def test_by_brute_force(spark, n):
    compare(spark, some_rows(n))


@pytest.mark.parametrize("height, n", [(1, 70), (2, 700)])
def test_blocks_in_many_rounds(spark, monkeypatch, height, n):
    """Blocks of 8 and 64 nodes, so that roots of blocks are walked again, and many languages."""
    monkeypatch.setattr(manifest, "HEIGHT", height)
    monkeypatch.setattr(manifest, "BLOCK", 8**height)
    compare(spark, some_rows(n) + [(1000 + i, "A", f"l{i}", None, 1) for i in range(20)])


def test_odd_rows(spark):
    """Nulls in any column, equal rows, one id with two texts, a long text, more columns, none at all."""
    rows = [(None, None, None, None, None), (None, "A", None, None, None), (3, "B", "en", "s", 1), (3, "B", "en", "s", 1), (3, "A", "en", "s", 1), (-7, "L" * 3_000_000, "en", "s", 1)]
    compare(spark, rows)
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as key", "2 as rank", "3 as digest", "4 as block", "'x' as row")
    assert docs.count() == manifest.manifest(docs).count()
    assert manifest.manifest(docs.limit(0)).count() == 0


def test_tampering_shows(spark):
    rows = some_rows(200)
    for doc_id, leaf_, _, root, _, folded, verified in manifest.manifest(spark.createDataFrame(rows, SCHEMA)).collect():
        text = rows[doc_id][1]
        hit = zlib.crc32(str(doc_id).encode()) % 3 == 0 and any("A" <= c <= "Z" for c in text)
        assert verified == (not hit) == (folded == root)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    same(spark, connect(sf), queries.op13_merkle_manifest, oracle.OP13, sf)
