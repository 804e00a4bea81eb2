"""Recognised words to blocks, languages learned from texts, trees as JSON."""

import json

from docfold.operators import language, layout, trees


def test_word_blocks(spark):
    """Gaps over 20 begin a line, over 40 a block; heights, marks and lengths tell kinds; uncertain and blank words are not there."""
    rows = [
        (1, 1, "Big", 90, 0, 30), (1, 2, "Title", 90, 0, 30), (1, 3, "lost", 39, 500, 30), (1, 4, "• item", 90, 80, 12), (1, 5, "two", 90, 113, 12), (1, 6, "  ", 99, 400, 12),
        (1, 7, "see", 90, 170, 12), (1, 8, "https://x.example/a?b&c", 90, 170, 12), (1, 9, "end", 40, 165, 12), (1, 10, "Short", 50, 230, 16), (1, 11, "3. third", 90, 300, 12), (2, 1, "- a", 90, 0, 12),
    ]
    words = spark.createDataFrame(rows, "page int, word_no int, text string, conf int, top int, height int")
    got = [(r.page, r.block_no, r.block_type, r.text) for r in layout.word_blocks(words, ["page"]).orderBy("page", "block_no").collect()]
    assert got == [
        (1, 0, "heading", "Big Title"), (1, 1, "list_item", "item \n two"), (1, 2, "paragraph", "see https://x.example/a?b&c end"), (1, 3, "heading", "Short"), (1, 4, "list_item", "3. third"), (2, 0, "list_item", "a"),
    ]
    html = {r.page: r.html for r in layout.blocks_html(layout.word_blocks(words, ["page"]), ["page"]).collect()}
    assert html[2] == "<p>• a</p>" and html[1].split("\n")[0] == '<p><span class="heading-large" style="font-size: 45.0px;"><strong>Big Title</strong></span></p>'
    assert '<a href="https://x.example/a?b&amp;c">https://x.example/a?b&amp;c</a> end</p>' in html[1]
    assert layout.word_blocks(words.limit(0), ["page"]).count() == 0


def test_learned_languages(spark):
    """Over 98 percent of the documents it has not learned from are told rightly; short, Arabic and foreign texts go by rule."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language.learned(docs.where("doc_id % 4 <> 0"))
    odd = [(-1, None), (-2, "short"), (-3, "ا" * 40), (-4, "中文" * 20), (-5, " " * 30), (-6, "1234567890 1234567890 12"), (-7, "the and of in " * 300_000)]
    held = docs.where("doc_id % 4 = 0 and length(trim(text)) >= 20")
    got = {r.doc_id: (r.detected, r.score) for r in language.detected(held.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string")), model, "doc_id").collect()}
    truth = {r.doc_id: r.lang for r in held.where("lang is not null").collect()}
    assert sum(got[k][0] == v for k, v in truth.items()) > 0.98 * len(truth)
    assert [got[k][0] for k in (-1, -2, -3, -4, -5, -6)] == ["unknown", "unknown", "ar", "unknown", "unknown", "unknown"] and got[-7][0] == "en" and got[-7][1] < 0


def test_nested_trees(spark):
    """Children by title; a chain of 200 levels; nodes without a known parent are roots; cycles and what hangs on them are left out."""
    rows = [("a", None, 'q"x'), ("b", "a", "2"), ("c", "a", "1"), ("d", "c", "é"), ("e", "gone", "e"), ("x", "y", "x"), ("y", "x", "y"), ("z", "y", "z"), ("s", "s", "s")]
    rows += [(f"n{i}", f"n{i - 1}" if i else None, f"t{i}") for i in range(200)]
    nodes = spark.createDataFrame(rows, "id string, parent_id string, title string")
    got = {r.id: json.loads(r.tree) for r in trees.nested_json(nodes, "id", "parent_id", "title").collect()}
    leaf = lambda i, t: {"id": i, "title": t, "children": []}
    assert set(got) == {"a", "e", "n0"} and got["e"] == leaf("e", "e")
    assert got["a"] == {"id": "a", "title": 'q"x', "children": [{"id": "c", "title": "1", "children": [leaf("d", "é")]}, leaf("b", "2")]}
    at, depth = got["n0"], 1
    while at["children"]:
        at, depth = at["children"][0], depth + 1
    assert depth == 200 and at["id"] == "n199"
    assert trees.nested_json(nodes.limit(0), "id", "parent_id", "title").count() == 0


def test_language_weights_sent_or_joined(spark):
    """No exchange is dealt by the trigrams of texts while all weights are sent; with few or none sent the others are joined, with the same outcome."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "𝒜𝒷c 𝒜𝒷c xyz 𝒜𝒷c xyz " * 3, "xx"), (-2, "𝒜𝒷c and more of that " * 2, None)], docs.schema)
    texts = docs.unionByName(odd).localCheckpoint()
    model = language.learned(texts.where("doc_id % 4 <> 0")).localCheckpoint()
    of = lambda **k: sorted(map(tuple, language.detected(texts, model, "doc_id", **k).collect()))
    assert of() == of(sent=100) == of(sent=0) and dict(r[:2] for r in of())[-1] == "xx"
    assert "hashpartitioning(gram" not in language.detected(texts, model, "doc_id")._jdf.queryExecution().executedPlan().toString()
    n = {r.gram: r.weight for r in model.where("lang = 'xx'").collect()}
    assert {"𝒜𝒷c", "c x", "z 𝒜"} <= set(n) and n["xyz"] < n["𝒜𝒷c"]
