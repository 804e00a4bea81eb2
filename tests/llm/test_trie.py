"""The trie of rebuilt conversations against one written out in plain Python, and against SQL."""

import random
import zlib
from hashlib import md5, sha256

import pytest

from docfold.llm import oracle, queries, trie
from docfold.scratch import Scratch
from tests.oracle import connect, same

SCHEMA = "conv_id long, turn long, role string, text string"


def originals(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", md5((text or "").encode()).hexdigest(), text or ""))
    return {c: [(r, t) for _, _, r, _, t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(rows):
    convs, out = originals(rows), {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        first = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = tuple(convs.get(first, [])[:h] + turns[h:])
    return out


def brute(convs):
    members = {}
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    children, leaves, saved = {}, {}, {}
    for s in members:
        if s:
            children[s[:-1]] = children.get(s[:-1], 0) + 1
    for s, m in members.items():
        for d in range(len(s) + 1):
            saved[s[:d]] = saved.get(s[:d], 0) + (len(m) - 1) * (len(s[-1][1]) if s else 0)
            leaves[s[:d]] = leaves.get(s[:d], 0) + (s not in children)
    return [
        (min(m), len(s), min(members[s[:-1]]) if s else None, len(m), children.get(s, 0), leaves[s], saved[s], sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(s)).encode()).hexdigest())
        for s, m in members.items()
    ]


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
key = lambda r: tuple(map(str, r))


def some_rows(n, seed, longest=7, words=3):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "bot", None]) if r.random() < 0.3 else "user", r.choice(["a", "bb", "ccc", None, "é中"][:words])) for c in r.sample(range(-120, 450), n) for t in range(r.randint(1, longest))]


@pytest.mark.parametrize("bits, n", [(64, 150), (2, 30)])
def test_by_brute_force(spark, bits, n):
    """Also with fingerprints and hashes of two bits, which all collide, so that every group is split."""
    rows = some_rows(n, bits, 7 if bits == 64 else 3)
    got = trie.rebuilt_trie(spark.createDataFrame(rows, SCHEMA), bits).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rebuilt(rows)), key=key)


def test_long_conversations_over_many_ranges(spark):
    """One conversation holds most turns, and is cut by the ranges of both sorts; its copy shares all its nodes."""
    r = random.Random(1)
    long = [(r.choice(["user", "bot"]), r.choice(["a", "bb"])) for _ in range(3000)]
    rows = [(c, t, *x) for c in (7, 8) for t, x in enumerate(long)] + [(9, t, *x) for t, x in enumerate(long[:1500])] + some_rows(20, 4)
    rows = [x for x in rows if x[0] in (7, 8, 9) or x[0] >= 100]
    nodes, ends = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(8))
    convs = {c: tuple(t) for c, t in originals(rows).items()}
    lens, top = [len(t) for _, t in long], sum(len(t) for _, t in long)
    by = {(x.conv_id, x.depth): x for x in nodes.where("conv_id = 7").collect()}
    if (7, 0) in by:
        assert by[7, 0].n_convs == len(convs)
    assert (by[7, 3000].n_convs, by[7, 3000].n_children, by[7, 3000].saved_tokens) == (2, 0, lens[-1])
    assert (by[7, 1500].n_convs, by[7, 1500].n_children, by[7, 1500].n_leaves) == (3, 1, 1)
    assert by[7, 1500].saved_tokens == sum(lens[1500:]) + 2 * lens[1499]
    assert by[7, 100].saved_tokens == sum(lens[99:]) + sum(lens[99:1500]) and top
    at = {x.conv_id: (x.node, x.depth) for x in ends.collect()}
    assert at[7] == at[8] == (7, 3000) and at[9] == (7, 1500)
    assert {c: d for c, (_, d) in at.items()} == {c: len(s) for c, s in convs.items()}


def test_odd_rows(spark):
    """Nulls in any column, equal rows, ties, missing turns, turnless conversations, negative ids, more columns, no rows."""
    rows = [(None, 1, "user", "x"), (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (2, 5, "user", ""), (2, 5, "user", ""), (100, 0, "user", "é" * 100_000), (150, 0, "user", "q"), (-50, 1, "bot", "q"), (555, 0, "bot", "z")]
    convs = spark.createDataFrame(rows, SCHEMA)
    more = convs.selectExpr("*", "1 as h", "2 as label", "'x' as depth", "3 as part", "4 as key", "5 as pos")
    got = trie.rebuilt_trie(more).select(COLUMNS).collect()
    assert any(len(s) == 0 for s in rebuilt(rows).values())
    assert sorted(map(tuple, got), key=key) == sorted(brute(rebuilt(rows)), key=key)
    assert trie.rebuilt_trie(convs.limit(0)).count() == 0


def test_digest_of_many_ids(spark):
    """More ids at one node than a piece holds."""
    n = 3 * (1 << trie.PIECE_BITS) + 5
    ids = spark.range(-n // 2, n - n // 2).selectExpr("id as conv_id", "0L as node", "3L as depth")
    want = sha256(",".join(map(str, range(-n // 2, n - n // 2))).encode()).hexdigest()
    assert [x.ends_sha256 for x in trie.ends_digest(ids).collect()] == [want]


def test_ranges_hand_on(spark):
    """Depths and fingerprints do not depend on where ranges are cut."""
    rows = spark.range(4000).selectExpr("0L as conv_id", "id as pos", "hash(id % 7) + 0L as h", "id % 3 as label", "0L as extra", "id % 11 as chars")
    made = []
    for n in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        made.append(sorted(map(tuple, trie.prefixes(rows, Scratch(spark, "test"), ["pos"]).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert made[0] == made[1] and [x[6] for x in made[0]] == list(range(4000))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    same(spark, connect(sf), queries.op11_prefix_trie, oracle.OP11, sf)
