import collections
import random

import numpy as np

from docfold.llm import neardup
from docfold.llm.components import components
from docfold.llm.words import WordHasher, shingle_sets, text_bytes
from docfold.scratch import Scratch


def brute(docs, k, threshold):
    """Sets and smallest ids reached, by comparing all pairs."""
    sets = {}
    for i, text in docs:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").split(" ")
        words = [w for w in words if w]
        sets[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(3))
    docs = []
    for base in range(12):
        text = [word() for _ in range(r.randint(30, 160))]
        docs.append(" ".join(text))
        for _ in range(r.randint(0, 12)):
            copy = list(text)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = word()
            docs.append(" ".join(copy))
    passage = " ".join(word() for _ in range(40))
    docs += [passage + " " + " ".join(word() for _ in range(60)) for _ in range(60)]  # a common passage makes large nodes
    docs += ["one", "ONE", "", None, "two words", "two\nwords", "x " * 50]
    return list(enumerate(docs, 1))


def test_agrees_with_all_pairs(spark):
    docs = corpus()
    for k, threshold in ((3, 85), (5, 80)):
        got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=k, threshold=threshold).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, k, threshold)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_nodes(spark, monkeypatch):
    """Nodes are dealt into blocks, branched, and compared by rest and block."""
    monkeypatch.setattr(neardup, "BLOCK", 6)
    monkeypatch.setattr(neardup, "LEVELS", 1)
    monkeypatch.setattr(neardup, "LEAF", 1)
    docs = corpus(8)
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=3, threshold=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, 3, 85)


def test_blocks_bounded_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(neardup, "WEIGHT", 400)
    docs = corpus(5)
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=3, threshold=85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, 3, 85)


def test_group_just_below_the_threshold(spark, monkeypatch):
    """All pairs come near the threshold and few reach it: what is made of it stays in proportion to the sets."""
    r = random.Random(2)
    text = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(240):
        copy = list(text)
        for at in r.sample(range(200), 9):  # shingles of three: similarity of two copies about 0.6 to 0.9
            copy[at] = f"x{r.randrange(4)}"
        docs.append((i, " ".join(copy)))
    made = []
    write = Scratch.write

    def counted(self, df, name):
        out = write(self, df, name)
        made.append((name, out.count()))
        return out

    monkeypatch.setattr(Scratch, "write", counted)
    monkeypatch.setattr(neardup, "BLOCK", 64)
    got = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), k=3, threshold=72).collect()
    want = brute(docs, 3, 72)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == want
    assert len({c for _, c in want.values()}) > 5
    assert max(n for name, n in made if name == "near") <= 240 * neardup.TREES * 2 * neardup.LEAF, made
    assert max(n for name, n in made if name == "links") <= 240 * neardup.TREES, made


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(empty).count() == 0
    assert neardup.keep_one_of_each(empty).count() == 0
    odd = spark.createDataFrame([(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (None, "a b c d e f", "x"), (2, "a b c d e f", None), (3, None, None), (4, "", "y")], "doc_id long, text string, id string").withColumnRenamed("id", "n")
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(odd).collect()}
    assert found == {(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (None, 2, None, True)}
    kept = neardup.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()  # one of the group of copies, and the rows without words
    assert sum(r.text == "a b c d e f" for r in rows) == 1 and sorted(r.doc_id for r in rows if not r.text) == [3, 4]


def test_repeated_ids_and_clashing_columns(spark):
    """Rows of one id with different texts are different documents to ``keep_one_of_each``."""
    rows = [(7, "one text of its own here", "a"), (7, "another text that is not a copy", "b"), (8, "one text of its own here", "c"), (9, "nine is alone in this", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").selectExpr("*", "doc_id as id", "text as node", "1 as row_key", "2 as c", "3 as sketch")
    kept = neardup.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text for r in kept.collect()) == sorted({t for _, t, _ in rows})
    found = neardup.near_duplicates(docs.where("doc_id > 7"))
    assert found.count() == 2


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 9), (9, 1), (7, 8), (2, 2)] + [(100 + i, 101 + i) for i in range(40)], "u long, v long")
    got = {r.id: r.component for r in components(edges, Scratch(spark, "test")).collect()}
    assert {got[i] for i in (1, 4, 5, 9)} == {1} and got[8] == 7 and 2 not in got
    assert {got[i] for i in range(100, 141)} == {100}


def test_words_by_pieces():
    import pyarrow as pa

    from docfold.llm import words

    texts = ["a  b\x0bc", None, "", " ", "x" * 50, "ein Über\x1c b c", "w " * 30] * 3
    whole = WordHasher().hashes(*text_bytes(pa.array(texts)))
    old, words.PIECE = words.PIECE, 16
    try:
        parts = WordHasher().hashes(*text_bytes(pa.array(texts)))
    finally:
        words.PIECE = old
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    counts = np.diff(whole[3])[:7].tolist()
    assert counts == [3, 0, 0, 0, 1, 4, 30]  # 0x1C is no blank
    sliced = pa.array(["skip", *texts]).slice(1)
    assert (WordHasher().hashes(*text_bytes(sliced))[0] == whole[0]).all()
    assert collections.Counter(len(s) for s in shingle_sets(whole[0], whole[3], 3))[0] == 9
