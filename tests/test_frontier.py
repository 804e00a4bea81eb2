"""The page frontier: cycles, restarts, folded menus, indexes of laws."""

import shutil

from pyspark.sql import functions as F

from docfold.functions import markup
from docfold.sources import frontier

HOST = "https://h.example"


def test_waves_over_cycles_and_restarts(spark, tmp_path):
    """Each address comes once, in its first wave and by its first place; a run that broke off goes on from its last whole wave."""
    edges = [("a", "b", 1), ("a", "c", 2), ("b", "d", 1), ("c", "d", 1), ("d", "a", 1), ("d", "e", 2), ("e", "e", 1), ("z", "y", 1)]
    links = spark.createDataFrame(edges, "page string, link string, pos int")
    asked = []

    def step(wave):
        asked.append(sorted(r.url for r in wave.collect()))
        found = wave.withColumnRenamed("url", "page").join(links, "page")
        return found.select(F.col("link").alias("url"), F.concat("place", F.array("pos")).alias("place"), F.concat_ws("/", "path", "link").alias("path"))

    seeds = spark.createDataFrame([("a", [0], "a"), ("a", [1], "again"), (None, [2], "x")], "url string, place array<int>, path string")
    want = [("a", 0, "a"), ("b", 1, "a/b"), ("c", 1, "a/c"), ("d", 2, "a/b/d"), ("e", 3, "a/b/d/e")]
    root = str(tmp_path / "waves")
    assert sorted((r.url, r.wave, r.path) for r in frontier.frontier(seeds, step, root).collect()) == want
    (tmp_path / "waves" / "wave=3" / "_SUCCESS").unlink()  # killed while it wrote this one
    shutil.rmtree(tmp_path / "waves" / "wave=4")
    asked.clear()
    assert sorted((r.url, r.wave, r.path) for r in frontier.frontier(seeds, step, root).collect()) == want
    assert asked == [["a"], ["b", "c"], ["d"], ["e"]]
    assert frontier.frontier(seeds.limit(0), step, str(tmp_path / "none")).count() == 0


def test_menu_entries():
    page = """<nav id=other><ul><li><a href=/no>no</a></li></ul></nav><nav id=book-block-menu-7><div><ul>
      <li class="menu-item menu-item--expanded"><span><a href=/a> A  b </a></span><ul><li class="menu-item--collapsed"><a href=/b>B</a></li><li>no link<ul><li><a href=/lost>x</a></li></ul></li></ul></li>
      <li><a href=/c>C</a><ul><li><a href=/d>D</a></li></ul></li></ul></div></nav>"""
    got = [(r["above"], r["above_href"], r["title"], r["href"], r["folder"], r["unfolded"]) for r in markup._menu(page)]
    assert got[:2] == [(-1, "", "A b", "/a", True, True), (0, "/a", "B", "/b", True, False)]
    assert got[-2:] == [(-1, "", "C", "/c", False, True), (got.index((-1, "", "C", "/c", False, True)), "/c", "D", "/d", False, False)]


def _site(spark, pages):
    return spark.createDataFrame([(HOST + u, h) for u, h in pages.items()], "url string, html string")


def test_menu_tree(spark):
    """Folded entries are looked up on their own pages, also with a slash at the end; leaves without a page or body are empty."""
    li = lambda url, folder="", below="": f"<li class='menu-item {folder}'><a href='{url}'>t{url}</a>{below}</li>"
    nav = lambda n, x: f"<nav id='book-block-menu-{n}'><ul>{x}</ul></nav>"
    seed = nav(1, li("/v1", "menu-item--expanded", "<ul>" + li("/a", "menu-item--collapsed") + li("/b/") + "</ul>")) + nav(2, li("/v2")) + nav(3, li("/stop-here")) + nav(4, li("/v4"))
    site = {
        "/": seed,
        "/a": nav(1, li("/v1", "menu-item--expanded", "<ul>" + li("/a/", "menu-item--expanded", "<ul>" + li("/c") + li("/v1", "menu-item--collapsed") + "</ul>") + "</ul>")) + "<div class=field--name-body>not shown</div>",
        "/b": "<div class='x field--name-body'>body <a href=\"/f.PDF\">b</a></div>",
        "/c": "<p>no body</p>",
    }
    docs = frontier.menu_tree(_site(spark, site), HOST + "/", "R", "Book", HOST, stop="STOP").collect()
    got = {r.document_url.removeprefix(HOST): (" ".join(r.doc_path[2:]), r.type, r.extra_meta.content_text, r.extra_meta.org_pdf_link) for r in docs}
    assert got == {"/v1": ("t/v1", "F", "t/v1", None), "/a": ("t/v1 t/a", "F", "t/a", None), "/b/": ("t/v1 t/b/", "R", "body b", HOST + "/f.PDF"), "/c": ("t/v1 t/a t/c", "R", "", None), "/v2": ("t/v2", "F", "t/v2", None)}


def test_law_pages(spark):
    """Ways to read a page are tried in order; rows of navigation hold no document, and a row with a short title is none of a list."""
    b = "<img src=square-bulit.gif>"
    index = f"""<table><tr><td>{b}<a href=/early.pdf>Early act</a></td></tr><tr><td bgcolor='#ecf5fb'><span class=style34> Acts </span></td></tr>
      <tr><td>{b}<a href=/one>One</a></td></tr><tr><td>{b}<a href=/missing>Missing</a></td></tr><tr><td>{b}<a href=/doc.HTM>Plain</a><a href=/second.pdf>2</a></td></tr>
      <tr><td>{b}<a href=/aml.htm>AML guide</a></td></tr><tr><td>{b}no link</td></tr><tr><td>{b}<a href=/s.pdf>Sitemap of acts</a></td></tr></table>"""
    one = "<table><tr><td>Size</td><td><a href=/Download0>x</a></td></tr><tr><td>Rules</td><td><a href=/Download1>get</a><a href=/Download2>get</a></td></tr></table><a href=/other.pdf>not taken</a>"
    aml = "<table><tr><td>tiny</td><td><a href=/t.pdf>Download</a></td></tr></table><a href=/list.doc>The list</a>"
    docs = frontier.law_documents(_site(spark, {"/i": index, "/one": one, "/aml.htm": aml}), HOST + "/i", "R", HOST).collect()
    got = sorted((r.category, r.title, r.document_url.removeprefix(HOST), " > ".join(r.doc_path[2:]), r.department) for r in docs)
    assert got == [
        ("Acts", "Download", "/t.pdf", "Acts > AML guide > Download", ["Acts", "AML guide"]),
        ("Acts", "Plain", "/doc.HTM", "Acts > Plain", ["Acts"]),
        ("Acts", "Rules", "/Download1", "Acts > One > Rules", ["Acts", "One"]),
        ("Acts", "Rules", "/Download2", "Acts > One > Rules", ["Acts", "One"]),
        ("Acts", "The list", "/list.doc", "Acts > AML guide > The list", ["Acts", "AML guide"]),
        ("Law", "Early act", "/early.pdf", "Unknown > Early act", []),
    ]
