"""Pages that come in parts, and page rows that are handed on before a batch is at its end."""

import pyarrow as pa
from pyspark.sql import functions as F

from docfold.functions import markup
from docfold.plans import documents
from docfold.sources import pages


def test_rows_of_a_few_pages_at_a_time():
    """No batch of rows is of more pages than make the given length; all rows come, with their own columns, those of no page too."""
    batch = pa.RecordBatch.from_pydict({"url": [f"u{i}" for i in range(50)] + ["none"], "html": [f"<table><tr><td>{i}</td></tr></table>" for i in range(50)] + [None]})
    seen = lambda parse: [{"table_no": 0, "row_no": 0, "header": False, "cells": [parse], "links": [], "cell_links": []}] if parse else []
    kind = pa.list_(pa.struct([("cells", pa.list_(pa.string()))]))
    got = list(markup._some_pages(seen, kind, 100)(iter([batch])))
    assert max(b.num_rows for b in got) <= 4 and sum(b.num_rows for b in got) == 51
    assert all(r["__rows"][0]["cells"][0] == f"<table><tr><td>{r['url'][1:]}</td></tr></table>" for b in got for r in b.to_pylist() if r["url"] != "none")


def test_no_page_grows_with_its_table(spark):
    """40,000 entries of one key come in eight parts, in order and whole."""
    rows = spark.range(40_000).select(F.lit(1).alias("one"), F.col("id").alias("k"), F.concat(F.lit("<li>"), "id", F.lit("</li>")).alias("x"))
    parts = documents._page(rows, "one", ["k"], "x", "<ul>", "</ul>").orderBy("part").collect()
    assert len(parts) == 8 and len({p.url for p in parts}) == 1 and max(len(p.html) for p in parts) < 80_000
    assert "".join(p.html.removeprefix("<ul>").removesuffix("</ul>") for p in parts) == "".join(f"<li>{i}</li>" for i in range(40_000))


def test_trees_and_listings_in_parts(spark):
    """Folders of two parts are one document; what comes after the stop marker goes in later parts too; a reference in two parts is one circular with the first link."""
    li = lambda *names: "<ul><li><a href='/f'>F</a><ul>" + "".join(f"<li><a href='/{n}'>{n}</a></li>" for n in names) + "</ul></li></ul>"
    tree = spark.createDataFrame([("u", 2, li("c", "stop", "d")), ("u", 1, li("a", "b")), ("u", 3, li("e")), ("v", 1, li("g"))], "url string, part long, html string")
    got = {r.document_url: (r.type, r.doc_path) for r in pages.tree_documents(tree, "R", "T", "https://x", leaves_only=False, stop="stop").collect()}
    assert {k: t for k, (t, _) in got.items()} == {"https://x/f": "F"} | {f"https://x/{n}": "R" for n in "abcg"}
    assert got["https://x/c"][1] == ["R", "T", "F", "c"]

    row = lambda n: f"<table><tr><td>Year 2020</td></tr><tr><td>No 1</td><td>01/02/2020</td><td><a href='/{n}.pdf'>{n}</a></td></tr></table>"
    listing = spark.createDataFrame([("u", 2, row("late")), ("u", 1, row("first"))], "url string, part long, html string")
    assert [(r.title, r.year) for r in pages.circulars(listing, "R", ("C",), "https://x").collect()] == [("first", "2020")]
