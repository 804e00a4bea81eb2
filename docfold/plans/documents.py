"""Pages to documents.  Pages of a layout are made of the given tables, so that SQL knows what must be read from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.functions import dates, markup, structured, text
from docfold.operators import chunking, layout
from docfold.plans.catalog import query
from docfold.scratch import Scratch
from docfold.sources import files, frontier, pages
from docfold.sources.tables import Tables

HOST = "https://regulator.example"


#: Keys of the table in one part of a page.
PART = 5_000


def _part(key: str) -> Column:
    return F.floor(F.col(key) / PART)


def _page(rows: DataFrame, key: str, order: list[str], body: str, before: str = "", after: str = "", part: Column | None = None) -> DataFrame:
    """A page (url, part, html) for each key of the HTML column ``body`` in order, in parts so that none grows with the table."""
    entries = F.transform(F.sort_array(F.collect_list(F.struct(*order, body))), lambda x: x[body])
    html = F.concat(F.lit(before), F.array_join(entries, ""), F.lit(after))
    of = rows.groupBy(key, (_part(order[-1]) if part is None else part).alias("part")).agg(html.alias("html"))
    return of.select(F.concat(F.lit(HOST + "/"), F.col(key).cast("string")).alias("url"), "part", "html")


def _str(c: str):
    return F.col(c).cast("string")


@query("A4 E19 C19 I11", f"""SELECT '{HOST}/' || c_nationkey AS source_page_url, 'BPRD ' || c_custkey AS reference_no, '12/01/' || (2018 + c_custkey % 4) AS published_date, (2018 + c_custkey % 4)::VARCHAR AS year,
  CASE WHEN c_custkey % 5 = 0 THEN 'Annexure A' ELSE c_name END AS title, '{HOST}/' || CASE WHEN c_custkey % 5 = 0 THEN 'annex' || c_custkey ELSE CASE WHEN c_custkey % 6 = 0 THEN 'cl' ELSE 'doc' END || c_custkey END || '.pdf' AS document_url,
  CASE WHEN c_custkey % 6 = 0 AND c_custkey % 5 <> 0 THEN 'Circular Letter' ELSE 'Circular' END AS category, 1 AS n_annexures, '{HOST}/urdu/' || c_custkey || '.pdf' AS urdu_url, 4 AS depth FROM customer""")  # fmt: skip
def circular_documents(t: Tables) -> DataFrame:
    """Listing tables under year heads: links of one reference and date are one document, with annexures and the local version beside it."""
    year = (2018 + F.col("c_custkey") % 4).cast("string")
    k = _str("c_custkey")
    link = lambda href, title: F.concat(F.lit("<a href='/"), href, F.lit(".pdf'>"), title, F.lit("</a>"))
    main = link(F.concat(F.when(F.col("c_custkey") % 6 == 0, "cl").otherwise("doc"), k), F.col("c_name"))
    annex = link(F.concat(F.lit("annex"), k), F.lit("Annexure A"))
    both = F.when(F.col("c_custkey") % 5 == 0, F.concat(annex, main)).otherwise(F.concat(main, annex))
    cells = F.concat(F.lit("<tr><td>BPRD "), k, F.lit("</td><td>12/01/"), year, F.lit("</td><td>"), both, link(F.concat(F.lit("urdu/"), k), F.lit("Urdu")), F.lit("<a href='/x'>no file</a></td></tr>"))
    rows = t.customer.select("c_nationkey", year.alias("y"), (year.cast("long") * (1 << 40) + F.floor(F.col("c_custkey") / (4 * PART))).alias("part"), F.col("c_custkey").alias("at"), cells.alias("row"))
    heads = rows.select("c_nationkey", "y", "part").distinct().select("c_nationkey", "y", "part", F.lit(-1).cast("long").alias("at"), F.concat(F.lit("<tr><td colspan=3>Year "), "y", F.lit("</td></tr><tr><td>Copyright</td><td>x</td></tr>")).alias("row"))
    html = _page(rows.unionByName(heads), "c_nationkey", ["y", "at"], "row", "<table><tr><th>No</th><th>Date</th></tr>", "</table>", F.col("part"))
    docs = pages.circulars(html, "R", ("Circulars",), HOST)
    return docs.select("source_page_url", "reference_no", "published_date", "year", "title", "document_url", "category", F.size("extra_meta.annexures").alias("n_annexures"), F.col("extra_meta.urdu_url").alias("urdu_url"), F.size("doc_path").alias("depth"))


@query("A4 U8", f"""SELECT '{HOST}/' || s_nationkey AS source_page_url, CASE WHEN s_suppkey % 3 = 0 THEN 'Letter ' ELSE '' END || s_name AS title, '{HOST}/c' || s_suppkey || '.htm' AS document_url,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Circular Letter' ELSE 'Circular' END AS category, s_suppkey % 2 AS n_annexures FROM supplier""")  # fmt: skip
def list_circular_documents(t: Tables) -> DataFrame:
    """The layout of lists: an item's main link and its annexures; items with annexures only hold no document."""
    k = F.col("s_suppkey")
    annex = F.when(k % 2 == 1, F.lit("<a href='/a.pdf'>Annexure B</a>")).otherwise("")
    item = F.concat(F.lit("<li>"), annex, F.lit("<a href='/c"), k.cast("string"), F.lit(".htm'> "), F.when(k % 3 == 0, "Letter ").otherwise(""), F.col("s_name"), F.lit(" </a></li><li><a href='/z.pdf'>Annex only</a></li>"))
    html = _page(t.supplier.select("s_nationkey", "s_suppkey", item.alias("item")), "s_nationkey", ["s_suppkey"], "item", "<ul>", "</ul>")
    docs = pages.list_circulars(html, "R", ("Circulars",), HOST, F.lit("2020"))
    return docs.select("source_page_url", "title", "document_url", "category", F.size("extra_meta.annexures").cast("long").alias("n_annexures"))


@query("A5 C20", """SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 7 <> 0""")
def valid_notifications(t: Tables) -> DataFrame:
    """Notifications that have all that is required: reference, date, department, year and address."""
    k = F.col("c_custkey")
    docs = t.customer.select(
        k, k.cast("string").alias("reference_no"), F.when(k % 3 != 0, "01/01/2020").otherwise(F.when(k % 2 == 0, "")).alias("published_date"),
        F.when(k % 7 != 0, F.array(F.lit("D"))).otherwise(F.array().cast("array<string>")).alias("department"), F.lit("2020").alias("year"), F.col("c_name").alias("document_url"),
    )
    return pages.valid(docs).select("c_custkey")


@query("A8", f"""SELECT 'Acts' AS category, p_name AS title, '{HOST}/f/' || p_partkey AS document_url, CASE WHEN p_partkey % 2 = 0 THEN '2020-02-' || lpad((p_partkey % 28 + 1)::VARCHAR, 2, '0') END AS published_date, CASE WHEN p_partkey % 2 = 0 THEN '2020' END AS year
  FROM part WHERE p_size <= 25 AND p_partkey % 4 <> 3 UNION ALL SELECT 'Rules', p_name, '{HOST}/f/' || p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '2020-02-' || lpad((p_partkey % 28 + 1)::VARCHAR, 2, '0') END, CASE WHEN p_partkey % 2 = 0 THEN '2020' END
  FROM part WHERE p_size > 25 AND p_partkey % 4 <> 3""")  # fmt: skip
def category_tables(t: Tables) -> DataFrame:
    """A table page for each category; rows without a download go."""
    k = F.col("p_partkey")
    date = F.when(k % 2 == 0, F.concat(F.lit("on "), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("/02/2020"))).otherwise("soon")
    row = F.concat(F.lit("<tr><td>"), date, F.lit("</td><td>"), F.col("p_name"), F.lit("</td><td><a href='/f/"), k.cast("string"), F.when(k % 4 != 3, "'>Download</a></td></tr>").otherwise("'>View</a></td></tr>"))
    rows = t.part.select((k % 20).alias("page"), k.alias("at"), "p_size", row.alias("row"))
    table = lambda df: _page(df, "page", ["at"], "row", "<table><tr><th>Date</th><th>Title</th></tr>", "</table>")
    docs = pages.category_tables({"Acts": table(rows.where("p_size <= 25")), "Rules": table(rows.where("p_size > 25"))}, "R", HOST)
    return docs.select("category", "title", "document_url", "published_date", "year")


@query("A9 L12 U11", f"""SELECT s_suppkey, CASE WHEN s_suppkey % 4 <> 0 THEN 'N-' || s_suppkey END AS reference_no, CASE WHEN s_suppkey % 4 <> 0 THEN '1447/07/09' END AS date_hijri, CASE WHEN s_suppkey % 4 <> 0 THEN 'In-Force' END AS status,
  CASE s_suppkey % 4 WHEN 1 THEN '/a' || s_suppkey || '.pdf' WHEN 2 THEN '/d' || s_suppkey WHEN 3 THEN 'b' || s_suppkey || '.pdf' END AS pdf FROM supplier""")  # fmt: skip
def listing_with_details(t: Tables) -> DataFrame:
    """A listing joined to its detail pages: info table, and the pdf by the first pattern that is there."""
    k = F.col("s_suppkey")
    url = F.concat(F.lit(HOST + "/d/"), k.cast("string"))
    info = F.concat(F.lit("<table class='info-table'><tr><td>No: N-"), k.cast("string"), F.lit("</td><td>Date(g): 2/1/2026 | Date(h): 1447/07/09Status: In-Force</td></tr></table><p>Body</p>"))
    pdf = F.when(k % 4 == 1, F.concat(F.lit("<a onclick=\"open('x.pdf')\">o</a><a class=l href='/a"), k.cast("string"), F.lit(".pdf'>pdf</a>")))
    pdf = pdf.when(k % 4 == 2, F.concat(F.lit("<div id='download'><a class=b href='/d"), k.cast("string"), F.lit("'>get</a></div>"))).otherwise(F.concat(F.lit("<a onclick=\"show('b"), k.cast("string"), F.lit(".pdf')\">see</a>")))
    details = t.supplier.where(k % 4 != 0).select(url.alias("url"), F.concat(info, pdf).alias("html"))
    listing = t.supplier.select("s_suppkey", F.col("s_name").alias("title"), url.alias("document_url"))
    found = pages.with_details(listing, details)
    return found.select("s_suppkey", "info.reference_no", "info.date_hijri", "info.status", "pdf")


@query("A10", f"""SELECT '{HOST}/' || c_nationkey || '#s' || c_custkey AS document_url, 's' || c_custkey AS section, md5('Appendix ' || c_custkey || ' text of ' || c_name) AS content_hash FROM customer WHERE c_custkey % 5 <> 0""")
def section_documents(t: Tables) -> DataFrame:
    """One page with many sections, each from its anchor on; empty ones go."""
    k = _str("c_custkey")
    body = F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit("<h3>Appendix "), k, F.lit("</h3><p>text of <b>"), F.col("c_name"), F.lit("</b></p>"))).otherwise("<p> </p>")
    part = F.concat(F.lit("<a name='s"), k, F.lit("'></a>"), body)
    html = _page(t.customer.select("c_nationkey", "c_custkey", part.alias("part")), "c_nationkey", ["c_custkey"], "part", "<h1>Intro</h1>")
    docs = pages.section_documents(html, "R", "Law")
    return docs.select("document_url", F.element_at("doc_path", -1).alias("section"), "content_hash")


_NAV = "(SELECT page_id, url, unnest(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1)) AS title, unnest(regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '<li><a href=\"([^\"]*)\">[^<]*</a></li>', 1)) AS href FROM pages)"


@query("A14 U5 U8", f"SELECT '{HOST}' || href AS document_url, min(url) AS source_page_url, 3 AS depth FROM {_NAV} WHERE href <> '' GROUP BY 1")
def menu_documents(t: Tables) -> DataFrame:
    """Leaves of the menus of all pages, each address once."""
    docs = pages.tree_documents(t.pages.select("url", "html"), "R", "Menu", HOST)
    return docs.select("document_url", "source_page_url", F.size("doc_path").alias("depth"))


@query("A14 U5 A13 G5", f"""SELECT '{HOST}/c' || c_custkey AS document_url, 'R > Book > ' || n_name || ' > ' || c_name AS path, 'R' AS type FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey < 20
  UNION ALL SELECT '{HOST}/n' || n_nationkey, 'R > Book > ' || n_name, 'F' FROM nation WHERE n_nationkey < 20 AND n_nationkey IN (SELECT c_nationkey FROM customer)""")  # fmt: skip
def section_tree(t: Tables) -> DataFrame:
    """Nested lists with folders and leaves, up to a stop marker."""
    leaf = t.customer.select("c_nationkey", _part("c_custkey").alias("p"), "c_custkey", F.concat(F.lit("<li><a href='/c"), _str("c_custkey"), F.lit("'>"), F.col("c_name"), F.lit("</a></li>")).alias("x"))
    inner = leaf.groupBy("c_nationkey", "p").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_custkey", "x"))), lambda v: v["x"]), "").alias("x"))
    node = F.concat(F.when(F.col("n_nationkey") == 20, "<li><a href='/end'>The end</a></li>").otherwise(""), F.lit("<li><a href='/n"), _str("n_nationkey"), F.lit("'>"), F.col("n_name"), F.lit("</a><ul>"), F.col("x"), F.lit("</ul></li>"))
    rows = inner.join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("c_nationkey")).select(F.lit(1).alias("one"), (F.col("n_nationkey").cast("long") * (1 << 40) + F.col("p")).alias("part"), node.alias("node"))
    docs = pages.tree_documents(_page(rows, "one", ["part"], "node", "<div><ul>", "</ul></div>", F.col("part")), "R", "Book", HOST, leaves_only=False, stop="The end")
    return docs.select("document_url", F.array_join("doc_path", " > ").alias("path"), "type")


@query("G5 H5", f"""SELECT y AS year, '{HOST}/y' || y AS link, row_number() OVER (ORDER BY y DESC) - 1 AS rank FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)""")
def year_links(t: Tables) -> DataFrame:
    """Year folders found on a page, the latest first."""
    y = F.year("o_orderdate").cast("string")
    years = t.orders.select(y.alias("y")).distinct().select(F.lit(1).alias("one"), "y", F.concat(F.lit("<a class=x href='/y"), "y", F.lit("'><b>Year "), "y", F.lit("</b></a> <a href='/none'>none</a><a href='/y"), "y", F.lit("'>"), "y", F.lit("</a>")).alias("a"))
    found = pages.year_links(_page(years, "one", ["y"], "a", part=F.lit(0)), HOST)
    return found.select(F.col("year").cast("long").alias("year"), "link", F.col("rank").cast("long").alias("rank"))


@query("U12", f"""SELECT '{HOST}/' || s_nationkey AS url, n.cell AS cell_no, s_name || n.cell AS title, '{HOST}/l' || s_suppkey || '-' || n.cell AS link FROM supplier, (VALUES (1), (2)) AS n(cell)""")
def cell_links(t: Tables) -> DataFrame:
    """Named links of each cell; links without a name are none."""
    k = _str("s_suppkey")
    one = lambda n: F.concat(F.lit("<td>"), F.lit("<a href='/e'></a><a href='/l"), k, F.lit(f"-{n}'>"), F.col("s_name"), F.lit(f"{n}</a></td>"))
    row = F.concat(F.lit("<tr><td>x</td>"), one(1), one(2), F.lit("</tr>"))
    html = _page(t.supplier.select("s_nationkey", "s_suppkey", row.alias("row")), "s_nationkey", ["s_suppkey"], "row", "<table>", "</table>")
    return pages.named_links(html, HOST).select("url", "cell_no", "title", "link")


@query("U10 L11 L14", """SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE 'none' END AS book, 'Home > ' || s_name AS trail, 'Item ' || s_suppkey || ' of it' AS item FROM supplier""")
def page_places(t: Tables) -> DataFrame:
    """Where a page stands: active book, breadcrumb; and the content of a list item without what is below it."""
    k, name = _str("s_suppkey"), F.col("s_name")
    active = F.when(F.col("s_suppkey") % 2 == 0, " class='menu-item menu-item--active-trail'").otherwise("")
    html = F.concat(
        F.lit("<nav id='other'><a href='/o'>Other</a></nav><nav id='book-block-menu-7'><ul><li"), active, F.lit("><a href='/b'>"), name, F.lit("</a></li></ul></nav>"),
        F.lit("<ol class='breadcrumb x'><li><a href='/'>Home</a></li><li><a href='/b'>"), name, F.lit("</a></li></ol>"),
    )
    item = F.concat(F.lit("<li><p>Item <b>"), k, F.lit("</b></p> of it<ul></ul></li>"))
    return t.supplier.select("s_suppkey", F.coalesce(markup.book_category(html), F.lit("none")).alias("book"), F.array_join(markup.breadcrumb(html), " > ").alias("trail"), markup.item_content(item).alias("item"))


_ARTICLE = """CASE s_suppkey % 6 WHEN 0 THEN '<div class="article-content"><p><strong>a.</strong> see <a href="https://regulator.example/x">rule ' || s_suppkey || '</a> now</p></div>'
  WHEN 1 THEN '<div class="article-content"><p>' || s_name || '</p></div>' WHEN 2 THEN '<div class="article-content"><p style="margin-left: 20px;"><strong>b)</strong> ' || s_name || '</p></div>'
  WHEN 3 THEN '<div class="article-content"><p><strong>7.</strong> ' || s_name || '</p></div>' WHEN 4 THEN '<table><tr><td>' || s_name || '</td><td>x</td></tr></table>' ELSE '<div class="article-content"><p>one</p><p><strong>2.</strong> ' || s_name || '</p></div>' END"""
_CLEANED = """CASE s_suppkey % 4 WHEN 0 THEN '<div class="cleaned-content"><p><strong>1.</strong></p>' || chr(10) || '<p>' || s_name || '</p></div>' WHEN 1 THEN '<table width="1" class="data-table"><tr><td>' || s_name || '</td></tr></table>'
  WHEN 2 THEN '<table class="data-table">' || repeat('<tr><td colspan="2">' || s_name || '</td></tr>', 21) || '</table>' ELSE '<ul><li>x</li></ul><div><p>' || s_name || '</p></div>' END"""


@query("L4 L5 L8", f"""SELECT s_suppkey, {_ARTICLE} AS article, {_CLEANED} AS cleaned, '<table><tr><td>' || s_name || '</td><td>' || s_suppkey || '</td></tr></table>' AS made FROM supplier""")
def layout_tables(t: Tables) -> DataFrame:
    """Every kind of row and table: marks and links of two cells, cells that span, items of three cells, data; and rows that become a table."""
    k, name = F.col("s_suppkey"), F.col("s_name")
    c = lambda *parts: F.concat(*(F.lit(x) if isinstance(x, str) else x for x in parts))
    row = (
        F.when(k % 6 == 0, c("<tr><td><b> a.</b></td><td>see <br><a href='/x'><i>rule ", _str("s_suppkey"), "</i></a> <span>now</span></td></tr>"))
        .when(k % 6 == 1, c("<tr><td colspan=2> <b>", name, "</b>&nbsp;</td><td>dropped</td></tr><tr><td>&nbsp;</td></tr>"))
        .when(k % 6 == 2, c("<tr><td></td><td>b)</td><td>", name, "</td></tr><tr><td></td><td>no mark</td><td>dropped</td></tr>"))
        .when(k % 6 == 3, c("<tr><td>7.</td><td>", name, "</td><td>dropped</td></tr>"))
        .when(k % 6 == 4, c("<tr><td>", name, "</td><td>x</td></tr>"))
        .otherwise(c("<tr><td>one</td></tr><tr><th>2.</th><td>", name, "</td></tr><tr><td>3.</td><td> </td></tr>"))
    )
    styled = (
        F.when(k % 4 == 0, c("<table style='x'><tr><td colspan=2>1.</td></tr><tr><td> </td><td>", name, "</td></tr></table>"))
        .when(k % 4 == 1, c("<table width=1><tr style='a'><td border=1 cellpadding=2 cellspacing=3>", name, "</td></tr></table>"))
        .when(k % 4 == 2, c("<table>", F.repeat(c("<tr><td colspan=2>", name, "</td></tr>"), F.lit(21)), "</table>"))
        .otherwise(c("<ul style='x'><li>x</li></ul><div><div><p>", name, "</p></div></div>"))
    )
    made = markup.table_html(F.array(F.array(name, _str("s_suppkey"))))
    return t.supplier.select("s_suppkey", markup.article_tables(c("<table>", row, "</table>"), HOST).alias("article"), markup.clean_tables(styled).alias("cleaned"), made.alias("made"))


@query("L6 L7", """SELECT s_suppkey, (s_suppkey % 8 NOT IN (0, 2, 4))::BIGINT + 1 AS n_pages, CASE WHEN s_suppkey % 2 = 0 THEN 'edge ' ELSE 'edge high low ' END || 'body of ' || s_name || ' that stays' ||
  CASE s_suppkey % 8 WHEN 1 THEN ' more than ten characters' WHEN 5 THEN ' go' WHEN 7 THEN ' note' ELSE '' END AS body FROM supplier""")  # fmt: skip
def trimmed_pages(t: Tables) -> DataFrame:
    """Heads and feet of pages with a height in pixels go; pages that show nothing go; every way to show something is tried."""
    k = F.col("s_suppkey")
    c = lambda *parts: F.concat(*(F.lit(x) if isinstance(x, str) else x for x in parts))
    at = lambda top, body: c(f"<span style='left:1px;top:{top}px'>", body, "</span> ")
    height = F.when(k % 2 == 0, "height:200px").otherwise("height:200pt")
    full = c("<div class='page' style='", height, "'>", at(30, "edge"), at(29, "high"), at(181, "low"), "<p style='top:0px'>", at(180, c("body of ", F.col("s_name"))), "that stays</p></div>")
    other = F.get(F.array(*map(F.lit, ("ten chars.", "more than ten characters", "<img src=x>", "<img class=chart>", "<a href=/x><img class=dummyimg></a>", "<a href=/x>go</a>", "<textarea></textarea>", "<div class=annotation>note</div>"))), (k % 8).cast("int"))
    html = markup.trimmed_pages(c(full, "<div class=page>", other, "</div>"))
    return t.supplier.select("s_suppkey", F.size(F.regexp_extract_all(html, F.lit('class="page"'), F.lit(0))).cast("long").alias("n_pages"), markup.page_text(html).alias("body"))


@query("I5 I7 I10 J8 U14 M8 K10 K11", r"""SELECT event_id, 'AU-' || event_id % 9 || '.1 Scope' AS title, 'my file ' || event_id AS file_title, CASE event_id % 3 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN 'A' || event_id || '/20' WHEN 2 THEN '4A' END AS reference,
  CASE WHEN event_id % 4 <> 0 THEN (2000 + event_id % 25) || '-01-01' END AS day, event_id % 28 + 1 || 'th May, 2019' AS dated, event_id % 2 = 0 AS arabic, '# Report ' || event_id AS report, CASE WHEN event_id % 2 = 0 THEN 'a > b' ELSE 'a > c > b' END AS path FROM events""")  # fmt: skip
def title_rules(t: Tables) -> DataFrame:
    """Titles, references, dates, reports and paths as crawlers and models write them."""
    k, n = F.col("event_id"), _str("event_id")
    code = F.concat(F.lit("AU-"), (k % 9).cast("string"), F.lit(".1"))
    reference = F.when(k % 3 == 0, F.concat(F.lit("Resolution No. ("), n, F.lit(") of 2012"))).when(k % 3 == 1, F.concat(F.lit("Notification no. A"), n, F.lit("/20 of May"))).otherwise("see Chapter 4A")
    report = F.concat(F.lit('```json\n{"'), F.get(F.array(F.lit("report"), F.lit("markdown"), F.lit("content"), F.lit("output")), (k % 4).cast("int")), F.lit('": "# Report '), n, F.lit('",}\n```'))
    path = F.when(k % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"), F.lit("c")))
    return t.events.select(
        "event_id", text.collapse_code(F.concat(code, F.lit("  "), code, F.lit(" Scope"))).alias("title"), text.filename_title(F.concat(F.lit("my_file-"), n, F.lit(".pdf"))).alias("file_title"),
        text.reference_number(reference).alias("reference"), dates.year_start(F.when(k % 4 == 0, "n/a").otherwise((2000 + k % 25).cast("string"))).cast("string").alias("day"),
        dates.dated_the(F.concat(F.lit("as amended, dated the "), (k % 28 + 1).cast("string"), F.lit("th May, 2019 and later"))).alias("dated"),
        text.contains_arabic(F.when(k % 2 == 0, F.lit("see المادة 3")).otherwise("see 3")).alias("arabic"), structured.markdown(report).alias("report"),
        F.array_join(structured.path_with_title(path, F.lit("b")), " > ").alias("path"),
    )


@query("C18", """SELECT page_id, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS u FROM pages) WHERE regexp_matches(u, '^/[a-zA-Z]') AND NOT regexp_matches(u, '(?i)(the|and|le|der)') GROUP BY 1""")
def wanted_links(t: Tables) -> DataFrame:
    """Links that match what is wanted and nothing that is not."""
    links = t.pages.select("page_id", F.explode(markup.hrefs(F.col("html"))).alias("u"))
    return links.where(text.link_wanted(F.col("u"), "^/[a-zA-Z]", "(?i)(the|and|le|der)")).groupBy("page_id").agg(F.count("*").alias("n"))


_HEADED = r"""(SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN left(text, 50) || chr(10) || 'Article 12 ' || substr(text, 51, 100) || chr(10) || 'CHAPTER IV ' || substr(text, 151, 100) || chr(10) || 'المادة ' || substr(text, 251, 50)
  WHEN 1 THEN left(text, 50) || chr(10) || '  ' || chr(10) || substr(text, 51, 100) ELSE left(text, 300) END AS x FROM documents)"""


@query("M2", rf"""SELECT doc_id, len(l) AS n_sections, md5(array_to_string(l, '|')) AS h FROM (SELECT doc_id, list_filter(CASE WHEN len(s) > 1 THEN s ELSE string_split(regexp_replace(x, '\n\s*\n', chr(1), 'g'), chr(1)) END, lambda v: length(trim(v)) > 0) AS l
  FROM (SELECT doc_id, x, string_split(regexp_replace(x, '\n(Chapter\s+[0-9]+|Article\s+[0-9]+|Section\s+[0-9]+|CHAPTER\s+[IVXLC0-9]+|Part\s+[IVXLC0-9]+|المادة|الفصل|الباب)', chr(1) || '\1', 'g'), chr(1)) AS s FROM {_HEADED}))""")  # fmt: skip
def head_sections(t: Tables) -> DataFrame:
    """Sections at heads of articles, chapters and parts, in Arabic too; without heads at empty lines."""
    part = lambda a, n: F.substring("text", a, n)
    k = F.col("doc_id") % 3
    headed = F.concat(part(1, 50), F.lit("\nArticle 12 "), part(51, 100), F.lit("\nCHAPTER IV "), part(151, 100), F.lit("\nالمادة "), part(251, 50))
    x = F.when(k == 0, headed).when(k == 1, F.concat(part(1, 50), F.lit("\n  \n"), part(51, 100))).otherwise(part(1, 300))
    s = t.documents.select("doc_id", chunking.sections(x).alias("s"))
    return s.select("doc_id", F.size("s").cast("long").alias("n_sections"), F.md5(F.array_join("s", "|")).alias("h"))


@query("A3", "SELECT doc_id, lang FROM documents WHERE source = 'src3' AND n_chars > 500")
def sql_with_parameters(t: Tables) -> DataFrame:
    """SQL with named parameters over a view."""
    t.documents.createOrReplaceTempView("docfold_documents")
    return files.query(t.spark, "SELECT doc_id, lang FROM docfold_documents WHERE source = :source AND n_chars > :least", source="src3", least=500)


_SPANS = """(SELECT event_id AS span_no, event_id % 40 AS page, event_id // 40 % 7 AS line_no, CASE WHEN event_id % 6 = 0 THEN ' ' WHEN event_id % 11 = 0 THEN 'see https://h.example/' || event_id ELSE 'a<b> ' || event_id END AS text,
  event_id % 97 AS x0, user_id % 53 AS y0, event_id % 97 + 10 AS x1, user_id % 53 + 4 AS y1, CASE WHEN event_id % 5 = 0 THEN 'Arial-BoldMT' ELSE 'Arial' END AS font, 10 + event_id % 10 AS size, event_id % 32 AS flags FROM events)"""
_ESC = "replace(replace(text, '<', '&lt;'), '>', '&gt;')"


@query("D21 M12 U20", f"""WITH s AS {_SPANS}, k AS (SELECT p_partkey AS link_no, p_partkey % 40 AS page, p_size AS x0, p_partkey % 50 AS y0, p_size + 6 AS x1, p_partkey % 50 + 2 AS y1, 'u' || p_partkey AS uri FROM part),
  h AS (SELECT s.span_no, arg_min(uri, link_no) AS uri FROM s JOIN k ON s.page = k.page AND s.x0 < k.x1 AND s.x1 > k.x0 AND s.y0 < k.y1 AND s.y1 > k.y0 GROUP BY 1),
  l AS (SELECT s.*, coalesce(uri, nullif(regexp_extract(text, 'https?://[^ <>]+'), '')) AS uri, (flags & 16) <> 0 OR font LIKE '%Bold%' AS b, (flags & 2) <> 0 AS i FROM s LEFT JOIN h USING (span_no) WHERE trim(text) <> ''),
  x AS (SELECT *, '<span' || CASE WHEN size > 16 THEN ' class="heading-large"' WHEN size > 14 THEN ' class="heading-medium"' ELSE '' END || ' style="font-size: ' || size || 'px;">' || CASE WHEN uri IS NULL THEN '' ELSE '<a href="' || uri || '">' END
    || CASE WHEN b THEN '<strong>' ELSE '' END || CASE WHEN i THEN '<em>' ELSE '' END || {_ESC} || CASE WHEN i THEN '</em>' ELSE '' END || CASE WHEN b THEN '</strong>' ELSE '' END || CASE WHEN uri IS NULL THEN '' ELSE '</a>' END || '</span>' AS html FROM l)
  SELECT page, line_no, count(*) AS n_spans, md5('<p>' || string_agg(html, '' ORDER BY span_no) || '</p>') AS h FROM x GROUP BY 1, 2""")  # fmt: skip
def page_spans(t: Tables) -> DataFrame:
    """Lines of positioned text as paragraphs: links by overlapping rectangles, weights, slopes and heading sizes."""
    k = F.col("event_id")
    body = F.when(k % 6 == 0, " ").when(k % 11 == 0, F.concat(F.lit("see https://h.example/"), _str("event_id"))).otherwise(F.concat(F.lit("a<b> "), _str("event_id")))
    spans = t.events.select(
        k.alias("span_no"), (k % 40).alias("page"), (F.floor(k / 40) % 7).alias("line_no"), body.alias("text"), (k % 97).alias("x0"), (F.col("user_id") % 53).alias("y0"), (k % 97 + 10).alias("x1"), (F.col("user_id") % 53 + 4).alias("y1"),
        F.when(k % 5 == 0, "Arial-BoldMT").otherwise("Arial").alias("font"), (10 + k % 10).alias("size"), (k % 32).alias("flags"),
    )
    p = F.col("p_partkey")
    links = t.part.select(p.alias("link_no"), (p % 40).alias("page"), F.col("p_size").alias("x0"), (p % 50).alias("y0"), (F.col("p_size") + 6).alias("x1"), (p % 50 + 2).alias("y1"), F.concat(F.lit("u"), _str("p_partkey")).alias("uri"))
    linked = layout.linked_spans(spans, links, ["page"])
    counts = spans.where(F.length(F.trim("text")) > 0).groupBy("page", "line_no").agg(F.count("*").alias("n_spans"))
    return layout.line_paragraphs(linked, ["page"]).join(counts, ["page", "line_no"]).select("page", "line_no", "n_spans", F.md5("html").alias("h"))


@query("M9 M10 M11", """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'recognised' ELSE 'text' END AS by, CASE WHEN doc_id % 4 = 0 THEN 'service' WHEN doc_id % 4 = 1 THEN 'digital' WHEN doc_id % 4 = 2 THEN 'scan' END AS engine,
  CASE doc_id % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' END AS html FROM documents""")  # fmt: skip
def conversions(t: Tables) -> DataFrame:
    """Pages that could not be read get what was recognised; of several converters the first with a result counts."""
    k = F.col("doc_id")
    words = F.expr("repeat('valuable words ', 40)")
    pages_ = t.documents.select("doc_id", F.when(k % 3 == 0, "x").otherwise(words).alias("text"))
    read = layout.recognised(pages_, t.documents.select("doc_id", words.alias("text")), ["doc_id"])
    one = lambda keep, what: t.documents.select("doc_id", F.when(keep, what).otherwise(F.when(k % 2 == 0, "")).alias("html"))
    chain = {"service": one(k % 4 == 0, "a"), "digital": one(k % 4 == 1, "b"), "scan": one(k % 4 < 3, "c")}
    return layout.first_conversion(read.drop("text"), chain, "doc_id").select("doc_id", "by", "engine", "html")


@query("U9", f"""SELECT kind, '{HOST}/' || kind || s_suppkey || '.pdf' AS document_url, CASE WHEN kind = 'f' AND s_suppkey % 2 = 0 THEN 'Part ' || s_nationkey ELSE s_name END AS title,
  md5(CASE WHEN kind = 'f' AND s_suppkey % 2 = 0 THEN 'Part ' || s_nationkey ELSE s_name END) AS content_hash FROM supplier, (VALUES ('f'), ('c')) AS k(kind)""")  # fmt: skip
def section_links(t: Tables) -> DataFrame:
    """Files in accordions, and links of one section of a page: each address once."""
    k = _str("s_suppkey")
    title = F.when(F.col("s_suppkey") % 2 == 0, "").otherwise(F.col("s_name"))
    item = F.concat(F.lit("<a href='/f"), k, F.lit(".pdf'>"), title, F.lit("</a><a href='/f"), k, F.lit(".pdf'>again</a><a href='/page'>page</a>"))
    rows = t.supplier.select("s_nationkey", "s_suppkey", item.alias("item"))
    files_ = rows.groupBy("s_nationkey", _part("s_suppkey")).agg(F.concat(F.lit("<div class='accordion-item'><h3>Part "), _str("s_nationkey"), F.lit("</h3>"), F.array_join(F.array_sort(F.collect_list("item")), ""), F.lit("</div>")).alias("html"))
    files_ = files_.select(F.lit(HOST).alias("url"), "html")
    named = F.concat(F.lit("<a href='#top'>top</a><a href='/c"), k, F.lit(".pdf'>"), F.col("s_name"), F.lit("</a>"))
    law = _page(t.supplier.select("s_nationkey", "s_suppkey", named.alias("x")), "s_nationkey", ["s_suppkey"], "x", "<div id='eofi'><a href='/e'>E</a></div><section id='aml'>", "</section>")
    both = {"f": pages.section_links(files_, "R", "Laws", HOST, files_only=True), "c": pages.section_links(law, "R", "Compliance", HOST, "aml")}
    whole = [df.select(F.lit(kind).alias("kind"), "document_url", "title", "content_hash") for kind, df in both.items()]
    return whole[0].unionByName(whole[1])


@query("A13 U5 L2", f"""WITH RECURSIVE n AS (SELECT page_id AS k, (page_id - 1) // 3 AS up, 3 * page_id + 1 < (SELECT count(*) FROM pages) AS folder FROM pages),
  t(k, depth, path, folder) AS (SELECT k, 0, 'R > Book > T0', true FROM n WHERE k = 0
    UNION ALL SELECT n.k, depth + 1, path || ' > T' || n.k, n.folder FROM t JOIN n ON n.k > 0 AND n.up = t.k)
  SELECT '{HOST}/p' || k AS document_url, depth, path, CASE WHEN folder THEN 'F' ELSE 'R' END AS type, md5(CASE WHEN folder THEN 'T' || k ELSE 'text of ' || k END) AS content_hash,
         CASE WHEN NOT folder AND k % 2 = 0 THEN '{HOST}/f' || k || '.pdf' END AS pdf FROM t""")  # fmt: skip
def unfolded_menu(t: Tables) -> DataFrame:
    """A menu whose folders are folded, so that each is looked up on its own page; every page leads back to the first."""
    n = t.pages.agg(F.count("*").alias("n"))
    k = F.col("page_id")
    page = t.pages.select("page_id").join(F.broadcast(n))
    entry = lambda k, n, below="": F.concat(F.lit("<li class='menu-item"), F.when(3 * k + 1 < n, F.lit(" menu-item--collapsed'>")).otherwise("'>"), F.lit("<a href='/p"), k.cast("string"), F.lit("'>T"), k.cast("string"), F.lit("</a>"), F.lit(below) if isinstance(below, str) else below, F.lit("</li>"))

    def below(k, n, deeper):
        kids = F.filter(F.sequence(3 * k + 1, 3 * k + 3), lambda x: x < n)
        return F.concat(F.lit("<ul>"), F.array_join(F.transform(kids, lambda x: entry(x, n, deeper(x, n))), ""), F.lit("<li class='menu-item'><a href='/p0'>Back</a></li></ul>"))

    # every fifth page shows its children's children too
    two = F.when(k % 5 == 0, below(k, F.col("n"), lambda x, n: F.when(3 * x + 1 < n, below(x, n, lambda *_: F.lit(""))).otherwise(""))).otherwise(below(k, F.col("n"), lambda *_: F.lit("")))
    own = F.concat(F.lit("<nav id='book-block-menu-1'><ul>"), entry(k, F.col("n"), F.when(3 * k + 1 < F.col("n"), two).otherwise("")), F.lit("</ul></nav>"))
    pdf = F.when(k % 2 == 0, F.concat(F.lit('<a href="/f'), k.cast("string"), F.lit('.pdf">'))).otherwise("<a>")
    body = F.concat(F.lit("<div class='field field--name-body'><p>text "), pdf, F.lit("of</a> "), k.cast("string"), F.lit("</p></div>"))
    site = page.select(F.concat(F.lit(HOST + "/p"), k.cast("string")).alias("url"), F.concat(own, body).alias("html"))
    seed = page.where("page_id = 0").select(F.lit(HOST + "/").alias("url"), F.concat(own, F.lit("<nav id='book-block-menu-2'><ul><li><a href='/other'>The End of it</a></li></ul></nav><nav id='book-block-menu-3'><ul><li><a href='/p1'>T1</a></li></ul></nav>")).alias("html"))
    docs = frontier.menu_tree(site.unionByName(seed), HOST + "/", "R", "Book", HOST, stop="the end")
    return docs.select("document_url", (F.size("doc_path") - 3).alias("depth"), F.array_join("doc_path", " > ").alias("path"), "type", "content_hash", F.col("extra_meta.org_pdf_link").alias("pdf"))


_LAW_KIND = "CASE n_nationkey % 6 WHEN 0 THEN '/n' || n_nationkey || '.pdf' WHEN 3 THEN '/fe_manual' || n_nationkey || '.htm' ELSE '/n' || n_nationkey END"
_LAW_TITLE = "CASE n_nationkey % 6 WHEN 1 THEN 'Prudential Regulations ' WHEN 2 THEN 'AML rules ' WHEN 3 THEN 'Foreign Exchange Manual ' ELSE 'Law ' END || n_name"
_LAWS = f"(SELECT n_nationkey AS k, n_nationkey % 6 AS kind, r_name AS under, {_LAW_TITLE} AS entry, '{HOST}' || {_LAW_KIND} AS page, s_suppkey AS s, s_name FROM nation JOIN region ON r_regionkey = n_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey)"


@query("A7", f"""SELECT DISTINCT under AS category, entry AS title, page AS document_url, NULL::VARCHAR AS reference_no, 'R > Laws & Regulations > ' || under || ' > ' || entry AS path FROM {_LAWS} WHERE kind = 0
  UNION ALL SELECT 'Regulations', s_name, '{HOST}/f' || s || '.pdf', NULL, 'R > Laws & Regulations > Regulations > ' || CASE kind WHEN 1 THEN 'Prudential Regulations' ELSE 'Anti-Money Laundering, Combating the Financing of Terrorism & Countering Proliferation Financing' END || ' > ' || s_name FROM {_LAWS} WHERE kind IN (1, 2) AND s IS NOT NULL
  UNION ALL SELECT under, s_name, '{HOST}/Download' || s || CASE kind WHEN 4 THEN '.zip' ELSE '.pdf' END, NULL, 'R > Laws & Regulations > ' || under || ' > ' || entry || ' > ' || s_name FROM {_LAWS} WHERE kind IN (4, 5) AND s IS NOT NULL
  UNION ALL SELECT under, CASE WHEN s % 3 = 0 THEN 'Chapter ' || s || ': ' ELSE '' END || s_name, '{HOST}/m' || s || '.pdf', CASE s % 3 WHEN 0 THEN 'Chapter ' || s WHEN 1 THEN 'Appendix ' || s END,
    'R > Laws & Regulations > ' || under || ' > ' || entry || ' > ' || CASE s % 3 WHEN 0 THEN 'Volume II > Chapter ' || s || ': ' WHEN 1 THEN 'Appendices > ' ELSE 'Volume I > ' END || s_name FROM {_LAWS} WHERE kind = 3 AND s IS NOT NULL
  UNION ALL SELECT under, 'Form ' || s, '{HOST}/form' || s || '.pdf', NULL, 'R > Laws & Regulations > ' || under || ' > ' || entry || ' – Appendix ' || s || ' > Volume I > Form ' || s FROM {_LAWS} WHERE kind = 3 AND s % 3 = 1""")  # fmt: skip
def law_documents(t: Tables) -> DataFrame:
    """An index with sections, entries that are files, pages of downloads, and manuals whose appendices are pages again."""
    c, lit = F.concat, F.lit
    kind, k, s = F.col("n_nationkey") % 6, _str("n_nationkey"), _str("s_suppkey")
    title = c(F.when(kind == 1, "Prudential Regulations ").when(kind == 2, "AML rules ").when(kind == 3, "Foreign Exchange Manual ").otherwise("Law "), F.col("n_name"))
    address = c(F.when(kind == 3, "/fe_manual").otherwise("/n"), k, F.when(kind == 0, ".pdf").when(kind == 3, ".htm").otherwise(""))
    nations = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    bullet = "<img src='/i/square-bulit.gif'>"
    entries = nations.select("r_name", F.col("n_nationkey").alias("at"), c(lit(f"<tr><td>{bullet}<a href='"), address, lit("'>"), title, lit("</a></td></tr>")).alias("x"))
    heads = nations.select("r_name").distinct().select("r_name", lit(-1).alias("at"), c(lit("<tr><td bgcolor='#ECF5FB'><span class='style34'>"), "r_name", lit(f"</span></td></tr><tr><td>{bullet}<a href='/h.pdf'>Home</a></td></tr><tr><td><a href='/x.pdf'>No bullet</a></td></tr>")).alias("x"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("r_name", "at", "x"))), lambda v: v["x"])
    index = entries.unionByName(heads).agg(c(lit("<table>"), F.array_join(parts, ""), lit("</table>")).alias("html")).select(lit(HOST + "/laws").alias("url"), "html")
    of = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    page = c(lit(HOST), address)

    def gathered(rows: DataFrame, x, before: str, after: str) -> DataFrame:
        each = F.transform(F.sort_array(F.collect_list(F.struct("s_suppkey", x.alias("x")))), lambda v: v["x"])
        return rows.groupBy(page.alias("url")).agg(c(lit(before), F.array_join(each, ""), lit(after)).alias("html"))

    listed = c(lit("<tr><td>"), "s_name", lit("</td><td><a href='/f"), s, lit(".pdf'>Download</a></td></tr>"))
    by_row = c(lit("<tr><td>"), "s_name", lit("</td><td><a href='/Download"), s, lit(".zip'>get</a></td></tr>"))
    by_link = c(lit("<p><a href='/x'>no file</a><a href='/Download"), s, lit(".pdf'>"), "s_name", lit("</a></p>"))
    cell = lambda n, href, name: c(lit("<tr><td>"), n, lit("</td><td><a href='"), href, lit("'>"), name, lit("</a></td></tr>"))
    m = c(lit("/m"), s, lit(".pdf"))
    at = F.col("s_suppkey") % 3
    rows = lambda want, x: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(at == want, F.struct("s_suppkey", x.alias("x"))))), lambda v: v["x"]), "")
    manual = of.where(kind == 3).groupBy(page.alias("url")).agg(
        c(
            lit("<table><tr><td valign='top' bgcolor='#F8F8F8'><blockquote><ul>"), rows(2, c(lit("<li><a href='"), m, lit("'>"), "s_name", lit("</a></li>"))),
            lit("</ul><p><strong>Volume II</strong></p><ul><li><table><tr><td>Chapter</td><td>Subject</td></tr>"), rows(0, cell(s, m, F.col("s_name"))),
            lit("</table></li></ul></blockquote><ul><li>Appendices<blockquote><table><tr><td>Sr. No.</td><td>Description</td></tr>"),
            rows(1, c(cell(s, m, F.col("s_name")), cell(s, c(lit("/fe_manual_a"), s, lit(".htm")), F.col("s_name")))), lit("</table></blockquote></li></ul></td></tr></table>"),
        ).alias("html")
    )
    forms = of.where((kind == 3) & (at == 1)).select(c(lit(HOST + "/fe_manual_a"), s, lit(".htm")).alias("url"), c(lit("<table><tr><td valign='top' bgcolor='#F8F8F8'><blockquote><ul><li><a href='/form"), s, lit(".pdf'>Form "), s, lit("</a></li></ul></blockquote></td></tr></table>")).alias("html"))
    table = "<table><tr><td>Title</td><td>Size</td></tr>", "</table>"
    site = [index, gathered(of.where(kind.isin(1, 2)), listed, *table), gathered(of.where(kind == 4), by_row, *table), gathered(of.where(kind == 5), by_link, "<div>", "</div>"), manual, forms]
    docs = frontier.law_documents(reduce(DataFrame.unionByName, site), HOST + "/laws", "R", HOST)
    return docs.select("category", "title", "document_url", "reference_no", F.array_join("doc_path", " > ").alias("path"))


_WORDS = r"""(SELECT event_id // 50 AS page, event_id AS word_no, 12 * k + 60 * (k // 9) + 15 * (k // 4) AS top, CASE event_id // 50 % 4 WHEN 0 THEN 24 WHEN 1 THEN 16 + k % 2 ELSE 10 END AS height, value AS conf,
  CASE WHEN k % 9 = 0 AND event_id % 7 = 0 THEN '• ' WHEN k % 9 = 0 AND event_id % 7 = 1 THEN '3. ' ELSE '' END || CASE WHEN event_id % 13 = 0 THEN ' ' WHEN event_id % 11 = 0 THEN 'https://h.example/' || event_id || '?a&b' ELSE event_type END AS text FROM (SELECT *, event_id % 50 AS k FROM events))"""


_ESCAPED = "replace(replace(text, '&', '&amp;'), '<', '&lt;')"


@query("F6 I20 U20 M10", rf"""WITH w AS (SELECT *, coalesce(top - lag(top + height) OVER (PARTITION BY page ORDER BY word_no), 0) AS gap FROM {_WORDS} WHERE trim(text) <> '' AND conf >= 40),
  b AS (SELECT *, sum(CASE WHEN gap > 40 THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY word_no) AS block_no FROM w),
  j AS (SELECT page, block_no, regexp_replace(string_agg(CASE WHEN gap > 20 AND gap <= 40 THEN chr(10) || ' ' ELSE '' END || trim(text), ' ' ORDER BY word_no), ' +', ' ', 'g') AS whole, avg(height) AS h FROM b GROUP BY 1, 2),
  k AS (SELECT *, CASE WHEN h > 20 THEN 'heading' WHEN regexp_matches(whole, '^([•*-]|[1-5]\.)') THEN 'list_item' WHEN len(list_filter(regexp_split_to_array(whole, '\s+'), lambda x: x <> '')) <= 5 AND h > 15 THEN 'heading' ELSE 'paragraph' END AS kind FROM j),
  t AS (SELECT *, CASE WHEN kind = 'list_item' AND regexp_matches(whole, '^[•*-]') THEN trim(substr(whole, 2)) ELSE whole END AS text FROM k),
  e AS (SELECT page, block_no, kind, CASE kind WHEN 'heading' THEN '<p><span class="heading-large" style="font-size: ' || (h * 1.5)::VARCHAR || 'px;"><strong>' || {_ESCAPED} || '</strong></span></p>' WHEN 'list_item' THEN '<p>• ' || {_ESCAPED} || '</p>'
    ELSE '<p>' || regexp_replace({_ESCAPED}, '(https?://[^\s<>"'')]+)', '<a href="\1">\1</a>', 'g') || '</p>' END AS html FROM t)
  SELECT page, count(*) AS n_blocks, count(*) FILTER (kind = 'heading') AS n_headings, count(*) FILTER (kind = 'list_item') AS n_items, md5(string_agg(html, chr(10) ORDER BY block_no)) AS h FROM e GROUP BY 1""")  # fmt: skip
def recognised_blocks(t: Tables) -> DataFrame:
    """Recognised words to lines, blocks of three kinds, and HTML."""
    e, k = F.col("event_id"), F.col("event_id") % 50
    page = F.floor(e / 50)
    height = F.when(page % 4 == 0, 24).when(page % 4 == 1, 16 + k % 2).otherwise(10)
    mark = F.when((k % 9 == 0) & (e % 7 == 0), "• ").when((k % 9 == 0) & (e % 7 == 1), "3. ").otherwise("")
    word = F.when(e % 13 == 0, " ").when(e % 11 == 0, F.concat(F.lit("https://h.example/"), _str("event_id"), F.lit("?a&b"))).otherwise(F.col("event_type"))
    words = t.events.select(page.alias("page"), e.alias("word_no"), (12 * k + 60 * F.floor(k / 9) + 15 * F.floor(k / 4)).alias("top"), height.alias("height"), F.col("value").alias("conf"), F.concat(mark, word).alias("text"))
    blocks = layout.word_blocks(words, ["page"])
    kinds = blocks.groupBy("page").agg(F.count_if(F.col("block_type") == "heading").alias("n_headings"), F.count_if(F.col("block_type") == "list_item").alias("n_items"))
    return layout.blocks_html(blocks, ["page"]).join(kinds, "page").select("page", "n_blocks", "n_headings", "n_items", F.md5("html").alias("h"))


@query("L13", f"""SELECT '{HOST}/' || s_nationkey AS url, 'Part ' || s_suppkey AS title, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE s_name || ' item ' || s_suppkey END AS text,
  md5(CASE WHEN s_suppkey % 4 = 0 THEN 'Part ' || s_suppkey ELSE s_name || ' item ' || s_suppkey END) AS hash FROM supplier""")  # fmt: skip
def accordion_sections(t: Tables) -> DataFrame:
    """Sections of accordions: each heading with what follows it, and a hash of that, or of the heading where nothing does."""
    k = _str("s_suppkey")
    body = F.when(F.col("s_suppkey") % 4 != 0, F.concat(F.lit("<div><p>"), F.col("s_name"), F.lit("</p><ul><li>item "), k, F.lit("</li></ul></div>"))).otherwise("<p> </p>")
    part = F.concat(F.when(F.col("s_suppkey") % 2 == 0, "<h3>").otherwise("<button>"), F.lit("Part "), k, F.when(F.col("s_suppkey") % 2 == 0, "</h3>").otherwise("</button>"), body)
    html = _page(t.supplier.select("s_nationkey", "s_suppkey", part.alias("part")), "s_nationkey", ["s_suppkey"], "part", "<p>before</p>")
    return markup.parsed(html, "accordion").select("url", "title", "text", "hash")


@query("A15 A5", """SELECT kind AS source, CASE kind WHEN 'broken' THEN 'FAILED' ELSE 'DONE' END AS status, CASE kind WHEN 'notices' THEN (SELECT count(*) FROM customer WHERE c_custkey % 3 <> 0) WHEN 'lists' THEN (SELECT count(*) FROM supplier) ELSE 0 END AS n
  FROM (VALUES ('notices'), ('lists'), ('broken')) AS k(kind)""")  # fmt: skip
def isolated_sources(t: Tables) -> DataFrame:
    """Sources run together: notification rows without a date go, and one source that fails takes no other with it."""
    k = _str("c_custkey")
    date = F.when(F.col("c_custkey") % 3 != 0, "12/01/2020").otherwise(" ")
    row = F.concat(F.lit("<tr><td>N-"), k, F.lit("</td><td>"), date, F.lit("</td><td><a href='/n"), k, F.lit(".pdf'>"), F.col("c_name"), F.lit("</a></td></tr>"))
    rows = t.customer.select("c_nationkey", F.col("c_custkey").alias("at"), row.alias("row"))
    html = _page(rows, "c_nationkey", ["at"], "row", "<table><tr><td>Year 2020</td></tr>", "</table>")
    items = t.supplier.select("s_nationkey", "s_suppkey", F.concat(F.lit("<li><a href='/c"), _str("s_suppkey"), F.lit(".htm'>"), F.col("s_name"), F.lit("</a></li>")).alias("item"))
    lists = _page(items, "s_nationkey", ["s_suppkey"], "item", "<ul>", "</ul>")

    def broken() -> DataFrame:
        raise RuntimeError("site is down")

    sources = {
        "notices": lambda: pages.valid(pages.circulars(html, "R", ("Notifications",), HOST), ("reference_no", "published_date", "document_url")),
        "lists": lambda: pages.list_circulars(lists, "R", ("Circulars",), HOST, F.lit("2020")),
        "broken": broken,
    }
    docs, runs = pages.isolated(t.spark, sources, Scratch(t.spark, "sources").path("documents"))
    return runs.join(docs.groupBy("source").agg(F.count("*").alias("n")), "source", "left").select("source", "status", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
