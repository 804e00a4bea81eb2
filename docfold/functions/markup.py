"""HTML operators: expressions for what regular expressions can tell, a tolerant parser for the rest."""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StructField, StructType

HREF = r'href="([^"]*)"'
# How index pages mark sections and rows, and manuals their main cell.
SECTION_COLOUR, SECTION_CLASS, BULLET, MANUAL_COLOUR = "#ECF5FB", "style34", "square-bulit", "#F8F8F8"
_HIDDEN = ("script", "style", "noscript", "header", "footer", "svg")


def html_to_text(x: Column) -> Column:
    """Text without hidden elements, comments and tags; white space collapsed.  Character references stay as they are."""
    for name in _HIDDEN:
        x = F.regexp_replace(x, rf"(?is)<{name}\b[^>]*>.*?</{name}>", " ")
    x = F.regexp_replace(F.regexp_replace(x, "(?s)<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def hrefs(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(HREF), F.lit(1))


def link_kind(u: Column) -> Column:
    low = F.lower(u)
    return F.when(low.rlike(r"\.pdf($|[?#])"), "pdf").when(low.rlike("faq"), "faq").otherwise("other")


def text_nodes(x: Column) -> Column:
    """Texts between tags, without the blank ones."""
    return F.filter(F.regexp_extract_all(x, F.lit("(?<=>)([^<]+)(?=<)"), F.lit(1)), lambda t: t.rlike(r"\S"))


def right_to_left(x: Column) -> Column:
    """``dir="rtl"`` in the first block tag."""
    return F.regexp_replace(x, r"(?is)^(.*?)<(div|p|section|article|table|ul|ol|h[1-6])\b", '$1<$2 dir="rtl"')


def table_html(rows: Column) -> Column:
    """An array of arrays of cells as an HTML table."""
    row = lambda r: F.concat(F.lit("<tr><td>"), F.array_join(r, "</td><td>"), F.lit("</td></tr>"))
    return F.concat(F.lit("<table>"), F.array_join(F.transform(rows, row), ""), F.lit("</table>"))


def info_value(x: Column, name: str) -> Column:
    """The word after ``name:`` in an info table, without a label that runs into it."""
    found = F.regexp_extract(html_to_text(x), rf"{re.escape(name)}:\s*([^\s|]+)", 1)
    return F.nullif(F.regexp_replace(found, r"[A-Z][a-z]+:.*$", ""), F.lit(""))


#: Where a page may name its PDF, most trusted first; the first that is there wins.
PDF_PATTERNS = (
    r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*\.pdf[^\"']*)",
    r"(?is)<div\b[^>]*?\bid\s*=\s*[\"']download[\"'](?:(?!</div).)*?<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)",
    r"(?is)<a\b[^>]*?\bonclick\s*=\s*(?:\"[^\"]*?'|'[^']*?\")([^'\"]+\.pdf)['\"]",
    r"(/?pdffiles/administrator[a-f0-9]+\.pdf)",
    r"(?s)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"'][^>]*>[^<]*(?:Download|DOWNLOAD)",
)


def pdf_link(x: Column) -> Column:
    """The PDF that a page is about."""
    return F.coalesce(*(F.nullif(F.regexp_extract(x, p, 1), F.lit("")) for p in PDF_PATTERNS))


class Node:
    """An element of a parsed page; children are nodes and strings."""

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None = None):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        """This element and all below it in page order; no recursion, as pages may nest without end."""
        left = [self]
        while left:
            n = left.pop()
            yield n
            left.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def find(self, *names: str) -> Iterator[Node]:
        return (n for n in self.walk() if n is not self and n.name in names)

    def has_class(self, *names: str) -> bool:
        return bool(set(self.attrs.get("class", "").split()) & set(names))

    def text(self) -> str:
        out: list[str] = []
        left: list[Node | str] = list(reversed(self.children))
        while left:
            c = left.pop()
            if isinstance(c, str):
                out.append(c)
            elif c.name not in ("script", "style", "noscript"):
                left += [" ", *reversed(c.children), " "]
        return " ".join("".join(out).split())

    def html(self) -> str:
        out: list[str] = []
        left: list[tuple[bool, Node | str]] = [(False, self)]
        while left:
            done, c = left.pop()
            if done:
                out.append(str(c))
            elif isinstance(c, str):
                out.append(html.escape(c, quote=False))
            else:
                out.append(f"<{c.name}" + "".join(f' {k}="{html.escape(v)}"' for k, v in c.attrs.items()) + ">")
                if c.name not in _VOID:
                    left += [(True, f"</{c.name}>"), *((False, x) for x in reversed(c.children))]
        return "".join(out)


_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_IMPLIED = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}, "option": {"option"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}}
_SCOPE = {"li": {"ul", "ol"}, "tr": {"table", "tbody", "thead"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "p": {"div", "td", "li", "body", "section", "article"}, "option": {"select"}, "dd": {"dl"}, "dt": {"dl"}}


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {})
        self.open = Counter()  # names of the elements around ``at``, so that none is looked for in vain

    def up_to(self, n: Node) -> None:
        """Closes ``n`` and all within it."""
        while self.at is not n.parent:
            self.open[self.at.name] -= 1
            self.at = self.at.parent

    def handle_starttag(self, tag, attrs):
        n = self.at
        if any(self.open[name] for name in _IMPLIED.get(tag, ())):
            while n.parent and n.name not in _SCOPE[tag]:
                if n.name in _IMPLIED[tag]:
                    self.up_to(n)
                    break
                n = n.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node
            self.open[tag] += 1

    def handle_endtag(self, tag):
        if self.open[tag]:
            n = self.at
            while n.name != tag:
                n = n.parent
            self.up_to(n)

    def handle_data(self, data):
        self.at.children.append(data)


def parse(page: str | None) -> Node:
    b = _Builder()
    b.feed(page or "")
    b.close()
    return b.root


def _links(n: Node) -> list[dict]:
    return [{"title": a.text(), "url": a.attrs.get("href", "")} for a in n.find("a") if a.attrs.get("href")]


def _table_rows(page: str) -> list[dict]:
    out = []
    for t, table in enumerate(parse(page).find("table")):
        for r, row in enumerate(table.find("tr")):
            cells = [c for c in row.children if isinstance(c, Node) and c.name in ("td", "th")]
            out.append({"table_no": t, "row_no": r, "header": bool(cells) and all(c.name == "th" for c in cells), "cells": [c.text() for c in cells], "links": _links(row), "cell_links": [_links(c) for c in cells]})
    return out


def _list_tree(page: str) -> list[dict]:
    """Folders and leaves of nested lists: depth, path of titles, href; a row with a list below it is a folder F, others R."""
    out: list[dict] = []
    left: list[tuple[Node, list[str]]] = [(parse(page), [])]
    while left:
        n, path = left.pop()
        inside = [c for c in n.children if isinstance(c, Node)]
        if n.name == "li" and n.parent.name in ("ul", "ol"):
            below = [c for c in inside if c.name in ("ul", "ol")]
            own = _own_link(n)
            title = own.text() if own else " ".join(" ".join(c for c in n.children if isinstance(c, str)).split())
            path = [*path, title]
            out.append({"path": path, "depth": len(path) - 1, "row_type": "F" if below else "R", "href": own.attrs.get("href", "") if own else ""})
            inside = below
        elif n.name in ("ul", "ol"):
            inside = [c for c in inside if c.name == "li"]
        left.extend((c, path) for c in reversed(inside))
    return out


def _own_link(li: Node) -> Node | None:
    """The first link of a list item that is not in a list below it."""
    left = [li]
    while left:
        n = left.pop()
        if n.name == "a":
            return n
        left.extend(c for c in reversed(n.children) if isinstance(c, Node) and c.name not in ("ul", "ol"))
    return None


def _list_items(page: str) -> list[dict]:
    """Links of each list item."""
    return [{"links": links} for li in parse(page).find("li") if (links := _links(li))]


def _sections(page: str) -> list[dict]:
    """Links of marked sections (an id, or a class with ``accordion``): the section's id, its heading, title and address of each link."""
    out = []
    for n in parse(page).walk():
        mark = n.attrs.get("id", "")
        if n.name in ("div", "section") and (mark or "accordion" in n.attrs.get("class", "")):
            heading = next(n.find("h2", "h3", "h4", "h5", "h6"), None)
            out += [{"section_id": mark, "section": heading.text() if heading else "", "title": link["title"], "href": link["url"]} for link in _links(n)]
    return out


def _book_category(page: str) -> str | None:
    """The first link of the book menu that holds the active trail."""
    for nav in parse(page).find("nav"):
        if nav.attrs.get("id", "").startswith("book-block-menu-") and any("menu-item--active-trail" in n.attrs.get("class", "") for n in nav.walk()):
            for a in nav.find("a"):
                if "href" in a.attrs:
                    return a.text()
    return None


def _anchors(page: str) -> list[dict]:
    """Sections of a page that begin at ``<a name=...>``."""
    parts = re.split(r"(?is)<a\s+name\s*=\s*[\"']?([^\"'>\s]+)[\"']?[^>]*>", page)
    return [{"name": n, "section_html": body, "section_text": parse(body).text()} for n, body in zip(parts[1::2], parts[2::2], strict=True)]


def _accordion(page: str) -> list[dict]:
    """Headings with what follows each up to the next, and an MD5 of its text."""
    out: list[dict] = []
    flow = [n for n in parse(page).walk() if n.name in ("h2", "h3", "h4", "button", "p", "li", "td")]
    for n in flow:
        if n.name in ("p", "li", "td"):
            if out and not any(True for _ in n.find("p", "li", "td")):
                out[-1]["text"] = f"{out[-1]['text']} {n.text()}".strip()
        else:
            out.append({"title": n.text(), "text": ""})
    return [{**s, "hash": hashlib.md5((s["text"] or s["title"]).encode()).hexdigest()} for s in out]


def _breadcrumb(page: str) -> list[str]:
    """Titles of the breadcrumb, else of the active trail."""
    root = parse(page)
    for mark in ("breadcrumb", "breadcrumbs", "active-trail"):
        found = [n for n in root.walk() if n.has_class(mark) or n.attrs.get("id") == mark]
        titles = [a.text() for n in found for a in ([n] if n.name == "a" else n.find("a", "li")) if a.name == "a" or not any(True for _ in a.find("a"))]
        if titles := [t for t in dict.fromkeys(titles) if t]:
            return titles
    return []


def _strings(n: Node) -> Iterator[tuple[str, Node | None]]:
    """Texts below an element in page order, each with the link that it is in, if any; a link without text is one, too."""
    left: list[tuple[Node | str, Node | None]] = [(c, None) for c in reversed(n.children)]
    while left:
        c, link = left.pop()
        if isinstance(c, str):
            yield c, link
        else:
            if c.name == "a":
                link = c
                yield "", c
            left += [(x, link) for x in reversed(c.children)]


def _bare(n: Node) -> str:
    """All texts of an element, stripped, without anything between them."""
    return "".join(t.strip() for t, _ in _strings(n))


def _inline(cell: Node, base: str) -> list[Node | str]:
    """The texts and links of a cell with blanks between them; links in full, all else without tags."""
    out: list[Node | str] = []
    done: set[int] = set()
    for t, link in _strings(cell):
        if link is None and t.strip():
            out += [t.strip(), " "]
        elif link is not None and id(link) not in done:
            done.add(id(link))
            href = link.attrs.get("href", "")
            a = Node("a", {"href": href if not href or href.startswith("http") else base + href})
            a.children = [_bare(link)]
            out += [a, " "]
    return out[:-1]


def _rows_of(table: Node) -> list[list[Node]]:
    return [list(r.find("td", "th")) for r in table.find("tr")]


def _outer_tables(root: Node) -> list[Node]:
    return [t for t in root.find("table") if not any(True for _ in _around(t, root, "table"))]


def _put(old: Node, new: Node) -> None:
    at = old.parent.children.index(old)
    old.parent.children[at], new.parent = new, old.parent


def _inner(root: Node) -> str:
    return "".join(c.html() if isinstance(c, Node) else html.escape(c, quote=False) for c in root.children)


def _paragraph(mark: str, body: list[Node | str], attrs: dict[str, str]) -> list[Node]:
    """A paragraph of a body with its mark in bold before it; none without a body."""
    p, strong = Node("p", attrs), Node("strong", {})
    strong.children = [mark]
    p.children = [strong, " ", *body] if mark else body
    return [p] if body else []


def _article_tables(page: str, base: str) -> str:
    """Tables as paragraphs: marks of two cells in bold before their text, cells that span as they are, and items of three cells; others stay."""
    root = parse(page)
    for table in _outer_tables(root):
        made: list[Node] = []
        for cells in _rows_of(table):
            first = _bare(cells[0]) if cells else ""
            if len(cells) == 2 and re.fullmatch(r"[0-9]+\.|[a-z][).]", first):
                made += _paragraph(first, _inline(cells[1], base), {})
            elif len(cells) == 1 or len(cells) > 1 and cells[0].attrs.get("colspan"):
                made += _paragraph("", _inline(cells[0], base), {})
            elif len(cells) == 3 and not first:
                second = _bare(cells[1])
                if re.fullmatch(r"[a-z][).]", second):
                    made += _paragraph(second, _inline(cells[2], base), {"style": "margin-left: 20px;"})
            elif len(cells) == 3 and re.fullmatch(r"[0-9]+\.", first):
                made += _paragraph(first, _inline(cells[1], base), {})
        if made:
            div = Node("div", {"class": "article-content"})
            div.children = list(made)
            _put(table, div)
    for ul in root.find("ul"):
        ul.attrs.pop("style", None)
    return re.sub(r">\s+<", "><", re.sub(r"\s+", " ", _inner(root)))


def _clean_tables(page: str) -> str:
    """Tables of at most 20 rows with a cell that spans become a paragraph for each cell, numbered ones in bold; others are data and lose their looks."""
    root = parse(page)
    for table in _outer_tables(root):
        rows = _rows_of(table)
        if len(rows) <= 20 and any(c.attrs.get("colspan") for r in rows for c in r):
            div = Node("div", {"class": "cleaned-content"})
            for t in (t for r in rows for c in r if (t := _bare(c))):
                p, inner = Node("p", {}), Node("strong", {})
                inner.children = [t]
                p.children = [inner] if re.match(r"[0-9]+\.|[a-z]\)", t) else [t]
                div.children += ["\n"] * bool(div.children) + [p]
            _put(table, div)
        else:
            for n in table.walk():
                if n is not table:
                    n.attrs = {k: v for k, v in n.attrs.items() if k not in ("style", "cellpadding", "cellspacing", "border")}
                if n.name == "table":
                    n.attrs["class"] = "data-table"
    for n in list(root.walk()):
        if n.name == "ul":
            n.attrs.pop("style", None)
        elif n.name in ("div", "span") and len(n.children) == 1 and isinstance(n.children[0], Node) and n.children[0].name == n.name:
            _put(n, n.children[0])
    return _inner(root)


# The shares of a page's height, from its top and its bottom, in which heads and feet stand, and the class of images that show nothing.
HEAD_SHARE, FOOT_SHARE, DUMMY = 0.15, 0.10, "dummyimg"


def _points(n: Node, what: str) -> float | None:
    m = re.search(rf"{what}:\s*([\d.]+)px", n.attrs.get("style", ""))
    return float(m[1]) if m else None


def _shows_something(page: Node) -> bool:
    """More than ten characters, an image of a class of its own, something to press or fill in, a link with text, or an annotation."""
    if len(_bare(page)) > 10 or any(True for _ in page.find("button", "input", "textarea")):
        return True
    if any(i.attrs.get("class") and not i.has_class(DUMMY) for i in page.find("img")) or any("href" in a.attrs and _bare(a) for a in page.find("a")):
        return True
    notes = (d for d in page.find("div") if d.has_class("annotation"))
    return any(_bare(d) or any(i.attrs.get("class") != DUMMY for i in d.find("img")) for d in notes)


def _trimmed_pages(page: str) -> str:
    """Pages of positioned text without the spans and blocks in their heads and feet, and without pages that show nothing; a page without a height is not cut."""
    root = parse(page)
    for p in [n for n in root.find("div") if n.has_class("page")]:
        if height := _points(p, "height"):
            for n in list(p.find("span", "div")):
                top = _points(n, "top")
                if top is not None and not HEAD_SHARE * height <= top <= (1 - FOOT_SHARE) * height and n in n.parent.children:
                    n.parent.children.remove(n)
        if not _shows_something(p):
            p.parent.children.remove(p)
    return _inner(root)


def _item(page: str) -> str:
    """The content of list items with block paragraphs unwrapped."""
    own = lambda li: (c for c in li.children if not (isinstance(c, Node) and c.name in ("ul", "ol")))
    items = (" ".join(" ".join(c.text() if isinstance(c, Node) else c for c in own(li)).split()) for li in parse(page).find("li"))
    return "\n".join(t for t in items if t)


def _menu(page: str) -> list[dict]:
    """Entries of the book menus in page order: menu, the entry above and its address, own title and address, whether it can be unfolded and is."""
    out: list[dict] = []
    menus = [n for n in parse(page).find("nav") if n.attrs.get("id", "").startswith("book-block-menu-")]
    for k, nav in enumerate(menus):
        tops = [n for n in nav.find("ul") if not any(True for _ in _around(n, nav, "ul"))]
        left = [(li, -1, "") for ul in reversed(tops) for li in reversed(_items(ul))]
        while left:
            li, above, href = left.pop()
            own = _own_link(li)
            if own is None or "href" not in own.attrs:
                continue
            lists = [c for c in li.children if isinstance(c, Node) and c.name == "ul"]
            folder = li.has_class("menu-item--collapsed", "menu-item--expanded")
            out.append({"menu_no": k, "above": above, "above_href": href, "title": own.text(), "href": own.attrs["href"], "folder": folder, "unfolded": bool(lists)})
            at = len(out) - 1
            left += [(x, at, own.attrs["href"]) for ul in reversed(lists[:1]) for x in reversed(_items(ul))]
    return out


def _items(ul: Node) -> list[Node]:
    return [c for c in ul.children if isinstance(c, Node) and c.name == "li"]


def _around(n: Node, top: Node, name: str) -> Iterator[Node]:
    """Elements of a name around ``n``, below ``top``."""
    n = n.parent
    while n is not None and n is not top:
        if n.name == name:
            yield n
        n = n.parent


def _index_rows(page: str) -> list[dict]:
    """Rows of all tables, each once: the section it opens, its text, whether it has a bullet, cells, links, and the addresses to download."""
    out = []
    for row in parse(page).find("tr"):
        marks = [m.text() for c in row.find("td") if c.attrs.get("bgcolor", "").upper() == SECTION_COLOUR for m in c.find("span") if m.has_class(SECTION_CLASS)]
        links = _links(row)
        files = [x["url"] for x in links if "Download" in x["title"] or "Download" in x["url"]]
        bullet = any(BULLET in i.attrs.get("src", "") for i in row.find("img"))
        cells = [c.text() for c in row.children if isinstance(c, Node) and c.name == "td"]
        out.append({"section": next((m for m in marks if m), ""), "body": row.text(), "bullet": bullet, "cells": cells, "links": links, "files": files})
    return out


def _manual(page: str) -> list[dict]:
    """Links of a manual in page order: kind (item, chapter or appendix), volume, number, title, href."""
    out: list[dict] = []
    for main in (n for n in parse(page).find("td") if n.attrs.get("valign") == "top" and n.attrs.get("bgcolor", "").upper() == MANUAL_COLOUR):
        volume = None
        for block in (c for c in main.children if isinstance(c, Node)):
            if block.name == "ul" and any("Appendices" in li.text() for li in block.find("li")):
                tables = (t for li in block.find("li") for q in li.find("blockquote") for t in q.find("table"))
                out += [{"kind": "appendix", "volume": "Appendices", **x} for t in {id(t): t for t in tables}.values() for x in _numbered(t, r"SR\.? ?NO.*DESCRIPTION")]
            for part in (c for c in block.children if isinstance(c, Node)) if block.name == "blockquote" else ():
                mark = re.search(r"VOLUME (II?)", part.text().upper()) if part.name == "p" else None
                if mark:
                    volume = "Volume II" if "VOLUME II" in part.text().upper() else "Volume I"
                    continue
                volume = volume or "Volume I"
                if part.name == "ul" and (tables := list(part.find("table"))):
                    out += [{"kind": "chapter", "volume": volume, **x} for t in tables for x in _numbered(t, "CHAPTER.*SUBJECT|SUBJECT.*CHAPTER")]
                elif part.name == "ul":
                    out += [{"kind": "item", "volume": volume, "number": "", "title": x["title"], "href": x["url"]} for x in _links(part) if x["title"]]
    return out


def _numbered(table: Node, head: str) -> list[dict]:
    """Number and links of the rows of a table whose first row reads like ``head``."""
    rows = list(table.find("tr"))
    if not rows or not re.search(head, rows[0].text().upper()):
        return []
    cells = [[c for c in r.children if isinstance(c, Node) and c.name == "td"] for r in rows[1:]]
    return [{"number": c[0].text(), "title": x["title"], "href": x["url"]} for c in cells if len(c) >= 2 for x in _links(c[1]) if x["title"]]


def _page_body(page: str) -> str | None:
    """The HTML of the field that holds a page's own content."""
    return next((n.html() for n in parse(page).find("div") if n.has_class("field--name-body")), None)


_LINK = "array<struct<title:string,url:string>>"
_ROWS = {
    "table_rows": (_table_rows, f"table_no int, row_no int, header boolean, cells array<string>, links {_LINK}, cell_links array<{_LINK}>"),
    "sections": (_sections, "section_id string, section string, title string, href string"),
    "list_items": (_list_items, f"links {_LINK}"),
    "list_tree": (_list_tree, "path array<string>, depth int, row_type string, href string"),
    "anchors": (_anchors, "name string, section_html string, section_text string"),
    "menu": (_menu, "menu_no int, above int, above_href string, title string, href string, folder boolean, unfolded boolean"),
    "index_rows": (_index_rows, f"section string, body string, bullet boolean, cells array<string>, links {_LINK}, files array<string>"),
    "anchor_links": (lambda page: [{"title": x["title"], "href": x["url"]} for x in _links(parse(page))], "title string, href string"),
    "manual": (_manual, "kind string, volume string, number string, title string, href string"),
    "accordion": (_accordion, "title string, text string, hash string"),
}


def parsed(pages: DataFrame, what: str, html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Rows of a page parser (``table_rows``, ``list_tree``, ``anchors``, ``accordion``) with ``pos`` and the columns ``keep``.

    Pages are parsed one by one and handed on after about a million characters, so a task holds the rows of a few pages only.
    """
    parse_page, kinds = _ROWS[what]
    given, rows = pages.select(*keep), ArrayType(StructType.fromDDL(kinds))
    read = pages.select(*keep, F.col(html_col).alias("__html")).mapInArrow(_some_pages(parse_page, to_arrow_type(rows)), StructType([*given.schema, StructField("__rows", rows)]))
    return read.select(*keep, F.posexplode("__rows").alias("pos", "row")).select(*keep, "pos", "row.*")


def _some_pages(parse_page: Callable[[str], list[dict]], kind: pa.DataType, together: int = 1 << 20) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches whose last column is HTML as batches with the rows of each page in its place; of some pages at a time, after which it goes on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, pages = batch.columns
            names, first, size, rows = [*batch.schema.names[:-1], "__rows"], 0, 0, []
            for at, page in enumerate(pages, 1):
                text = page.as_py() or ""
                rows.append(parse_page(text))
                size += len(text)
                if size >= together or at == len(pages):
                    yield pa.RecordBatch.from_arrays([*(c.slice(first, at - first) for c in kept), pa.array(rows, kind)], names)
                    first, size, rows = at, 0, []

    return run


def _page_text(page: str) -> str:
    return parse(page).text()


def _of_pages(f: Callable, kind: str = "string") -> Callable[[Column], Column]:
    """A column function of a page function; a null page has a null result.  The UDF is made at each call, so that no module holds one."""

    def column(x: Column) -> Column:
        @F.pandas_udf(kind)
        def run(s: pd.Series) -> pd.Series:
            return s.map(f, na_action="ignore")

        return run(x)

    return column


clean_tables, trimmed_pages, item_content, page_text, page_body, book_category = map(_of_pages, (_clean_tables, _trimmed_pages, _item, _page_text, _page_body, _book_category))


def article_tables(x: Column, base: str) -> Column:
    """A page's layout tables as paragraphs, links with ``base`` before addresses of the site."""
    return _of_pages(lambda page: _article_tables(page, base))(x)


def breadcrumb(x: Column) -> Column:
    """The titles of a page's breadcrumb; none if it has none."""
    return F.coalesce(_of_pages(_breadcrumb, "array<string>")(x), F.array().cast("array<string>"))
