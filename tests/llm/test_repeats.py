import collections
import hashlib
import random

import numpy as np
import pytest

from docfold.llm import repeats


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(x[p : p + 200] for x in data for p in range(len(x) - 199))
    out = []
    for x in data:
        gone = bytearray(len(x))
        for p in range(len(x) - 199):
            if seen[x[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    r = random.Random(5)
    noise = lambda n: "".join(r.choice("abcdé ") for _ in range(n))
    shared, line = noise(700), noise(230)
    texts = [noise(400) + shared + noise(300), noise(90) + shared[100:] + noise(50), shared, shared, "a" * 900, "ab" * 300, "xyz" * 70, noise(150), "", None]
    texts += [noise(60) + line + noise(60) for _ in range(30)]  # one trigger in many phrases
    texts += [noise(50) + shared[200:400] + noise(100), noise(50) + shared[200:399] + "!" + noise(100)]
    loop = noise(330)
    return [*texts, noise(20) + loop + loop[:260] + noise(40), noise(3000)]


def result(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sorted(repeats.remove_repeats(df, **kw).collect(), key=lambda r: r.doc_id)]


@pytest.mark.parametrize("hot", [None, 0])
def test_agrees_with_all_windows(spark, hot, monkeypatch):
    if hot is not None:
        monkeypatch.setattr(repeats, "HOT", hot)  # all shared triggers by counting
    texts = corpus()
    assert result(spark, texts) == brute(texts)


def test_repeated_and_missing_ids(spark):
    text = "q" + "wertzuiop" * 40
    df = spark.createDataFrame([(1, text, 1), (1, text, 1), (None, "other" * 100, 2), (None, None, 3), (2, "short", 4)], "doc_id long, text string, h int").withColumnRenamed("h", "c")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in repeats.remove_repeats(df).collect())
    assert got == [(False, 1, 361, 361), (False, 1, 361, 361), (False, 2, 5, 0), (True, 0, 0, 0), (True, 0, 500, 500)]
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_suffix_ranks_order_bytes():
    r = np.random.default_rng(1)
    data = np.concatenate([r.integers(97, 100, 600), np.full(450, 97), r.integers(97, 100, 300)]).astype(np.uint8)
    raw = data.tobytes()
    windows = [raw[i : i + 200] for i in range(len(raw) - 199)]
    order = {w: k for k, w in enumerate(sorted(set(windows)))}
    rank = repeats.suffix_ranks(data)
    assert len(set(zip(rank.tolist(), (order[w] for w in windows)))) == len(order)
    assert all((rank[i] < rank[j]) == (windows[i] < windows[j]) for i in range(0, 900, 37) for j in range(0, 900, 41))


def test_long_text_by_pieces(monkeypatch):
    r = random.Random(2)
    text = "".join(r.choice("abcdefgh ") for _ in range(5000)).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    monkeypatch.setattr(repeats, "PIECE", 700)
    _, _, owner, s, e, _ = repeats.parse(data, offsets, repeats.RollingHash())
    assert s[0] == 0 and e[-1] == len(text) - 200 and (s[1:] == e[:-1] + 1).all() and not owner.any()
