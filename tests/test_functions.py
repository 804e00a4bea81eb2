import datetime as dt
import time

from pyspark.sql import functions as F

from docfold.functions import dates, markup, structured, text


def one(spark, expr, *values):
    """The results of an expression over the column x."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").select("i", expr(F.col("x")).alias("y")).collect()
    return [r.y for r in sorted(rows)]


def test_text_rules(spark):
    assert one(spark, text.clean, "  a  b\n c ", None, "") == ["a b c", None, ""]
    assert one(spark, text.normalize_text, "Shall do X.", " shall  do x") == ["shall do x", "shall do x"]
    assert one(spark, text.post_clean, "a\n\n\n\nb  c\t\td") == ["a\n\nb c d"]
    assert one(spark, text.null_string, "", "null", " NULL ", " a ") == [None, None, None, "a"]
    assert one(spark, text.is_annexure, "Annexure A", "Annex to the circular letter", "x") == [True, False, False]
    assert one(spark, text.collapse_code, "AU-1.2 AU-1.2 Scope", "AU-1.2 Scope") == ["AU-1.2 Scope", "AU-1.2 Scope"]
    assert one(spark, text.filename_title, "my_new-file.pdf") == ["my new file"]
    assert one(spark, lambda x: text.truncated(x, 3), "abcd", "abc", None) == ["abc...", "abc", None]
    assert one(spark, text.csv_ids, "1, 2,x,,3") == [[1, 2, 3]]
    assert one(spark, text.reference_number, "Resolution No. (16) of 2012", "Chapter 4A", "none") == ["16", "4A", None]


def test_language_and_pages(spark):
    assert one(spark, text.language, "short", "ا" * 30, None) == ["unknown", "ar", "unknown"]
    assert one(spark, text.language, "the cat and the dog of that house here") == ["en"]
    assert one(spark, text.bad_page, "x" * 199, "the and " * 60, "valuable words " * 40, None) == [True, True, False, True]
    assert one(spark, text.broken_text, "" * 100, "fine text", "\\u0041" * 16) == [True, False, True]


def test_tiers_at_the_boundary(spark):
    def tiers(strict, start):
        return lambda x: text.first_tier([(x, "pdf_text")], 200, strict, start)["content_type"]

    values = ["a" * 199, "a" * 200, "a" * 201]
    assert one(spark, tiers(False, 0), *values) == [None, "pdf_text", "pdf_text"]
    assert one(spark, tiers(True, 0), *values) == [None, None, "pdf_text"]


def test_dates(spark):
    assert one(spark, dates.validate_date, "2024-12-31", "31/12/2024", "1447/07/09", "1399/01/01", "1500/02/02", "1600/01/01", "Dec 2024") == ["31/12/2024", "31/12/2024", "1447/07/09", "1399/01/01", "1500/02/02", None, None]
    assert one(spark, dates.extract_year, "in 1999 and 2001", "03/04/21", "1/2/1447", "1/2/3/1447", "none") == ["1999", None, "1447", None, None]
    assert one(spark, dates.day_first, "31/12/2024", "nothing", None) == [dt.date(2024, 12, 31), None, None]
    assert one(spark, dates.month_name, "3 May 2019", "3 Dec 2019", "May") == [dt.date(2019, 5, 3), dt.date(2019, 12, 3), None]
    assert one(spark, dates.date_in_cell, "‎12/01/2020 (new)") == [dt.date(2020, 1, 12)]
    assert one(spark, dates.dated_the, "dated the 3rd May, 2019 on") == ["3rd May, 2019"]
    assert one(spark, dates.year_start, "2020", "x") == [dt.date(2020, 1, 1), None]


def test_json(spark):
    assert one(spark, structured.unfenced, '```json {"a":1,} ```') == ['{"a":1}']
    new = one(spark, structured.verdict, '{"match_status":"new","matched_id":7}', '{"match_status":"maybe","matched_id":7}', "junk", '{"match_status":"fully_matched","matched_id":7,"explanation":"e"}')
    assert [tuple(v) for v in new] == [("new", None, ""), ("new", None, "Parsing failed."), ("new", None, "Parsing failed."), ("fully_matched", 7, "e")]
    assert one(spark, structured.salvage_json, 'Sure: ```json\n{"a": [1, 2,],}\n``` bye', "nothing", None) == ['{"a": [1, 2]}', structured.NO_REQUIREMENTS, None]
    assert one(spark, structured.salvage_json, 'See [1]: {"a": 1} and {"b": 2}', 'See {this} or {"a": 1}', "[1, 2]") == ['{"a": 1}', structured.NO_REQUIREMENTS, "[1, 2]"]
    assert one(spark, structured.salvage_json, 'Note {"a":1}. Answer: {"requirements":[{"t":"x"},]}', "[" * 50_000, '{"a":' * 50_000) == ['{"requirements": [{"t": "x"}]}', structured.NO_REQUIREMENTS, structured.NO_REQUIREMENTS]
    assert one(spark, structured.markdown, '{"report":"# A"}', "# B") == ["# A", "# B"]
    assert one(spark, lambda x: structured.path_with_title(F.array(F.lit("a"), x), F.lit("b")), "b", "c") == [["a", "b"], ["a", "c", "b"]]


PAGE = """<ul class="breadcrumb"><li><a href="/">Home</a></li><li><a href="/l">Laws</a></li></ul>
<table><tr><th>No</th><th>Title</th></tr><tr><td colspan=2>2021</td></tr><tr><td>1<td><a href="/a.pdf">First &amp; last</a></tr></table>
<ul><li><a href="/f">Folder</a><ul><li><a href="/r">Leaf</a></li></ul></li></ul><a name=one>One</a><p>first</p><a name="two">Two</a><p>second</p>"""


def test_page_parsers(spark):
    pages = spark.createDataFrame([("u", PAGE), ("v", None)], "url string, html string")
    rows = markup.parsed(pages, "table_rows").orderBy("row_no").collect()
    assert [(r.header, r.cells) for r in rows] == [(True, ["No", "Title"]), (False, ["2021"]), (False, ["1", "First & last"])]
    assert rows[2].links[0].url == "/a.pdf"
    tree = {r.href: (r.path, r.row_type) for r in markup.parsed(pages, "list_tree").collect()}
    assert tree["/f"] == (["Folder"], "F") and tree["/r"] == (["Folder", "Leaf"], "R")
    assert [(r.name, r.section_text) for r in markup.parsed(pages, "anchors").orderBy("pos").collect()] == [("one", "One first"), ("two", "Two second")]
    assert [r.b for r in pages.select(markup.breadcrumb("html").alias("b")).collect()] == [["Home", "Laws"], []]
    acc = spark.createDataFrame([("u", "<h3>A</h3><p>x</p><p>y</p><h3>B</h3>")], "url string, html string")
    assert [(r.title, r.text) for r in markup.parsed(acc, "accordion").orderBy("pos").collect()] == [("A", "x y"), ("B", "")]


def test_deep_pages(spark):
    """Pages that nest without end, or hold end tags of nothing, are read in linear time."""
    deep, began = "<div>x" * 50_000, time.time()
    assert one(spark, markup.page_text, deep, "<b>" * 50_000 + "</i>" * 50_000 + "y", "<ul><li>" * 2_000) == [" ".join("x" * 50_000), "y", ""]
    assert markup.parse(deep).html().count("</div>") == 50_000
    assert len(markup._list_tree("<ul><li>a" * 500)) == 500
    assert time.time() - began < 60


def test_pdf_links(spark):
    pages = ["<a class=x href='/a.PDF?x=1'>p</a>", "<div id=\"download\"><p><a href='/d'>d</a></p></div>", "<a onclick=\"go('b.pdf')\">x</a>", "see /pdffiles/administrator0af.pdf", '<a href="/z">Download now</a>', "<a href='/n'>none</a>"]
    assert one(spark, markup.pdf_link, *pages) == ["/a.PDF?x=1", "/d", "b.pdf", "/pdffiles/administrator0af.pdf", "/z", None]


def test_markup_rewrites(spark):
    assert one(spark, markup.clean_tables, '<table><tr><td colspan=2>a <b>b</b></td></tr><tr><td>1. x</td><td>c</td></tr></table>', "<table><tr><td>1</td></tr></table>") == ['<div class="cleaned-content"><p>ab</p>\n<p><strong>1. x</strong></p>\n<p>c</p></div>', '<table class="data-table"><tr><td>1</td></tr></table>']
    assert one(spark, lambda x: markup.article_tables(x, "https://h"), '<table><tr><td>a.</td><td>see <a href="/x">rule</a></td></tr></table>') == ['<div class="article-content"><p><strong>a.</strong> see <a href="https://h/x">rule</a></p></div>']
    assert one(spark, markup.right_to_left, "<i>a</i><p>b</p><p>c</p>") == ['<i>a</i><p dir="rtl">b</p><p>c</p>']
    page = '<div class="page" style="height:100px"><span style="top:12px">head</span><span style="top:50px">body text that stays</span></div><div class="page"><img src=x></div>'
    assert [("head" in x, "body" in x, x.count("page")) for x in one(spark, markup.trimmed_pages, page)] == [(False, True, 1)]
    assert one(spark, markup.item_content, "<ul><li><p>a</p> b<ul><li>c</li></ul></li></ul>") == ["a b\nc"]
    table = spark.range(1).select(markup.table_html(F.array(F.array(F.lit("a"), F.lit("b")))).alias("t")).first().t
    assert table == "<table><tr><td>a</td><td>b</td></tr></table>"
