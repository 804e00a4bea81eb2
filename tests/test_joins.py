"""Joins that must not grow with the square of a group: shared shingles, overlapping rectangles."""

import random

from pyspark.sql import functions as F

from docfold.operators import layout, matching
from docfold.scratch import Scratch


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_containment_over_a_threshold(spark):
    """The pairs over a threshold are those of the whole index, for texts that share much, little and nothing."""
    r = random.Random(1)
    text = lambda n: " ".join(r.choice("a b c d e f g h".split()) for _ in range(n))
    items = spark.createDataFrame([(i, i % 2, text(r.randint(0, 12))) for i in range(40)] + [(90, 0, None), (91, 1, "")], "item long, p int, text string")
    texts = spark.createDataFrame([(i, i % 2, text(r.randint(0, 60))) for i in range(60)] + [(90, 0, None)], "doc long, p int, text string")
    for within in ((), ("p",)):
        whole = matching.containment(items, "item", texts, "doc", within=within)
        for least in (1, 30, 80, 100):
            want = whole.where(100 * F.col("n_common") >= least * F.col("n_items"))
            assert rows(matching.containment(items, "item", texts, "doc", within=within, least=least)) == rows(want)


def test_a_shingle_in_all_texts_pairs_nothing(spark, monkeypatch):
    """Every item and text holds one phrase; candidates are the pairs that share more than it."""
    made = {}
    write = Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, name: made.setdefault(name, write(self, df, name)))
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(8))
    items = spark.createDataFrame([(i, "all hold this " + own(i)) for i in range(300)], "item long, text string")
    texts = spark.createDataFrame([(i, "pad all hold this " + own(i)) for i in range(300)], "doc long, text string")
    assert rows(matching.containment(items, "item", texts, "doc", least=30).select("item", "doc")) == [(i, i) for i in range(300)]
    assert made["candidates"].count() == 300


def brute(spans, links):
    return sorted((p, s, n) for p, s, x0, y0, x1, y1 in spans for q, n, a0, b0, a1, b1 in links if p == q and None not in (x0, y0, x1, y1, a0, b0, a1, b1) and x0 < a1 and x1 > a0 and y0 < b1 and y1 > b0)


def test_overlaps_by_brute_force(spark):
    """Rectangles of all sizes, turned, empty, touching, far out, and without numbers: each pair once."""
    r = random.Random(2)

    def some(n, size):
        out = []
        for i in range(n):
            x, y, w, h = (r.choice([r.uniform(-500, 900), r.randint(-5, 9) * 8.0]) for _ in range(4))
            s = r.choice(size)
            out.append((r.randint(1, 2), i, x, y, x + w * s, y + h * s))
        return out

    spans = some(150, (0.0, 0.01, 0.1, 1.0)) + [(1, 900, None, 0.0, 1.0, 1.0), (1, 901, -1e7, -1e7, 1e7, 1e7), (3, 902, 0.0, 0.0, 1.0, 1.0)]
    links = some(100, (0.0, 0.05, 0.3, 5.0)) + [(1, 900, 0.0, None, 1.0, 1.0), (2, 901, -1e9, 0.0, 1e9, 1.0)]
    a = spark.createDataFrame(spans, "page int, span_no long, x0 double, y0 double, x1 double, y1 double")
    b = spark.createDataFrame(links, "page int, link_no long, x0 double, y0 double, x1 double, y1 double")
    found = layout.overlaps(a, b, ["page"]).select("page", "l_span_no", "r_link_no")
    want = brute(spans, links)
    assert rows(found) == want and len(want) > 150
    assert layout.overlaps(a.limit(0), b, ["page"]).count() == 0


def test_a_page_of_100000_spans(spark):
    """100,000 spans and links of one page: each meets its own, and no task holds all pairs."""
    n = 100_000
    x, y = F.col("id") % 250 * 20.0, F.floor(F.col("id") / 250) * 12.0
    spans = spark.range(n).select(F.lit(1).alias("page"), F.col("id").alias("span_no"), x.alias("x0"), y.alias("y0"), (x + 18).alias("x1"), (y + 10).alias("y1"), F.lit("t").alias("text"))
    links = spark.range(n).select(F.lit(1).alias("page"), F.col("id").alias("link_no"), F.col("id").cast("string").alias("uri"), (x + 1).alias("x0"), (y + 1).alias("y0"), (x + 5).alias("x1"), (y + 5).alias("y1"))
    assert layout.linked_spans(spans, links, ["page"]).where("uri = cast(span_no as string)").count() == n


def test_equal_rectangles_meet_once(spark, monkeypatch):
    """3,000 spans and 3,000 links of a few rectangles meet as those few; the first link counts, spans without a rectangle have none."""
    seen, meet = [], layout.overlaps
    monkeypatch.setattr(layout, "overlaps", lambda a, b, keys: seen.append((a.count(), b.count())) or meet(a, b, keys))
    spans = spark.range(3000).selectExpr("1 AS page", "id AS span_no", "'t' AS text", "double(id % 3 * 100) AS x0", "0D AS y0", "CASE WHEN id > 5 THEN double(id % 3 * 100 + 10) END AS x1", "10D AS y1")
    links = spark.range(3000).selectExpr("1 AS page", "2999 - id AS link_no", "concat('u', 2999 - id) AS uri", "double(id % 2 * 100) AS x0", "0D AS y0", "double(id % 2 * 100 + 10) AS x1", "10D AS y1")
    got = {(r.span_no % 3 if r.span_no > 5 else -1, r.uri) for r in layout.linked_spans(spans, links, ["page"]).collect()}
    assert got == {(-1, None), (0, "u1"), (1, "u0"), (2, None)}
    assert seen[0][0] <= 6 and seen[0][1] == 2
