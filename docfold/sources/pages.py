"""Documents out of pages: listings, lists, trees, anchored sections and detail pages, all to one record.

Pages come as tables of (url, html); fetching them is no part of this.  Every source gives the columns of ``DOCUMENT``.
A listing or tree that is too long for one row comes as rows of (url, part, html), each a page that stands by itself: its entries are whole, and heads and folders
that they stand under are in it again.  Parts go in the order of ``part``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.functions import markup, text
from docfold.operators.relational import carry_forward
from docfold.schemas import DOCUMENT

DOC_EXTENSIONS = ("pdf", "htm", "html", "doc", "docx", "xls", "xlsx", "zip")
YEAR = r"\b(?:19|20)\d{2}\b"
#: Rows of listings that hold no document.
TRASH = ("copyright", "back to top", "home page")


def as_documents(rows: DataFrame, regulator: str, source_system: str, **given: Column) -> DataFrame:
    """Rows as records: columns by name, those given instead, null where there is neither."""
    given = {"regulator": F.lit(regulator), "source_system": F.lit(source_system)} | given
    value = lambda f: given[f.name] if f.name in given else F.col(f.name) if f.name in rows.columns else F.lit(None)
    return rows.select(*(value(f).cast(f.dataType).alias(f.name) for f in DOCUMENT.fields))


def extra(**fields: Column) -> Column:
    """The record's extra fields, null where not given."""
    kinds = next(f.dataType for f in DOCUMENT.fields if f.name == "extra_meta")
    return F.struct(*(fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds.fields))


def valid(docs: DataFrame, required: tuple[str, ...] = ("reference_no", "published_date", "department", "year", "document_url")) -> DataFrame:
    """Documents that have all that is required."""
    missing = lambda c: F.size(c) <= 0 if docs.schema[c].dataType.typeName() == "array" else F.length(c) == 0
    return docs.where(reduce(lambda a, b: a & b, (F.col(c).isNotNull() & ~missing(c) for c in required)))


def first_rows(docs: DataFrame, n: int | None, *order: Column) -> DataFrame:
    """The first n of a source, or all."""
    return docs if n is None else docs.orderBy(*order).limit(n)


def in_parts(pages: DataFrame) -> DataFrame:
    """Pages with ``part``, 0 where they come in one row."""
    return pages if "part" in pages.columns else pages.withColumn("part", F.lit(0).cast("long"))


def listing_rows(pages: DataFrame, default_year: Column | None = None) -> DataFrame:
    """Rows of listing tables under year heads: url, part, table_no, row_no, year, cells and links; heads, trash and rows before any year go."""
    rows = markup.parsed(in_parts(pages), "table_rows", keep=("url", "part"))
    whole = F.array_join("cells", " ")
    trash = reduce(lambda a, b: a | b, (F.contains(F.lower(whole), F.lit(t)) for t in TRASH))
    found = F.nullif(F.regexp_extract(whole, YEAR, 0), F.lit(""))
    head = (F.size("cells") == 1) & found.isNotNull()
    year = carry_forward(found, head, ["url", "part"], F.col("pos"))
    year = F.coalesce(year, default_year) if default_year is not None else year
    return rows.withColumn("year", year).where(~trash & ~head & ~F.col("header") & F.col("year").isNotNull() & (F.size("cells") >= 2))


def circulars(pages: DataFrame, regulator: str, path: tuple[str, ...], base: str, default_year: Column | None = None) -> DataFrame:
    """One document for all links of a reference, date and year; annexures are listed beside it.

    The title and address are those of the first link that is in the main language, or of the very first if it is no annexure.
    """
    one = listing_rows(pages, default_year).select("url", "year", "part", "pos", F.get("cells", F.lit(0)).alias("reference_no"), F.get("cells", F.lit(1)).alias("published_date"), F.posexplode("links").alias("at", "link"))
    link = text.absolute_link(F.col("link.url"), F.lit(base))
    rows = one.select("url", "year", "reference_no", "published_date", F.struct("part", "pos", "at").alias("place"), text.clean(F.col("link.title")).alias("title"), link.alias("link"))
    rows = rows.where(F.lower(text.url_extension(F.col("link"))).isin(*DOC_EXTENSIONS))
    low = F.lower(F.col("title"))
    local = low.contains("urdu") | low.contains("(u)") | F.lower("link").contains("/urdu/")
    rows = rows.withColumn("annexure", text.is_annexure(F.col("title"))).withColumn("local", local)
    keys = ["url", "reference_no", "published_date", "year"]
    first = rows.groupBy(*keys).agg(F.min("place").alias("first"))
    main = (F.col("place") == F.col("first")) & ~F.col("annexure") | ~F.col("local")
    named = F.struct("place", "title", "link")
    folded = rows.join(first, keys).groupBy(*keys).agg(
        F.min(F.when(main, named)).alias("m"), F.max(F.when(F.col("local"), named)).alias("u"), F.sort_array(F.collect_list(F.when(F.col("annexure"), named))).alias("a")
    )
    letter = F.lower("m.link").rlike(r"/cl[_-]?\d+\.") & F.lower("m.link").rlike(r"\.(htm|pdf)")
    category = F.when(letter, "Circular Letter").otherwise("Circular")
    head = F.array(*map(F.lit, path))
    annexures = F.transform("a", lambda x: F.struct(x["title"].alias("title"), x["link"].alias("url")))
    return as_documents(
        folded.where("m is not null"), regulator, "CIRCULAR", category=category, title=F.col("m.title"), document_url=F.col("m.link"), source_page_url=F.col("url"), department=head,
        doc_path=F.concat(head, F.array(F.col("year"), category, F.col("m.title"))), extra_meta=extra(annexures=annexures, urdu_url=F.col("u.link")),
    )


def list_circulars(pages: DataFrame, regulator: str, path: tuple[str, ...], base: str, year: Column) -> DataFrame:
    """The layout of lists: of each item the last link that is no annexure, with its annexures."""
    items = markup.parsed(pages, "list_items").withColumn("year", year)
    link = lambda a: F.struct(text.clean(a["title"]).alias("title"), text.absolute_link(a["url"], F.lit(base)).alias("url"))
    annex = lambda a: F.startswith(F.lower(text.clean(a["title"])), F.lit("annex"))
    main = F.element_at(F.filter("links", lambda a: ~annex(a)), -1)
    rows = items.where(F.exists("links", lambda a: ~annex(a))).select("url", "pos", "year", link(main).alias("m"), F.transform(F.filter("links", annex), link).alias("a"))
    category = F.when(F.lower("m.title").contains("letter"), "Circular Letter").otherwise("Circular")
    head = F.array(*map(F.lit, path))
    return as_documents(
        rows, regulator, "UNDATED", category=category, title=F.col("m.title"), document_url=F.col("m.url"), source_page_url=F.col("url"), department=head,
        doc_path=F.concat(head, F.array(F.col("year"), category, F.col("m.title"))), extra_meta=extra(annexures=F.col("a")),
    )


def category_tables(tables: dict[str, DataFrame], regulator: str, base: str) -> DataFrame:
    """One table page a category: date, title, and a link named Download; rows without one go."""
    out = []
    for category, pages in tables.items():
        rows = markup.parsed(pages, "table_rows").where(~F.col("header"))
        link = F.get(F.filter("links", lambda a: F.contains(a["title"], F.lit("Download"))), F.lit(0))["url"]
        date = F.nullif(F.regexp_extract(F.get("cells", F.lit(0)), r"\d{2}/\d{2}/\d{4}", 0), F.lit(""))
        day = F.date_format(F.try_to_timestamp(date, F.lit("dd/MM/yyyy")), "yyyy-MM-dd")
        rows = rows.select("url", F.trim(F.get("cells", F.lit(1))).alias("title"), text.absolute_link(link, F.lit(base)).alias("document_url"), day.alias("published_date"))
        rows = rows.where(text.complete(F.col("title"), F.col("document_url")))
        path = F.array(F.lit(regulator), F.lit(category), F.col("title"))
        out.append(as_documents(rows, regulator, "TABLES", category=F.lit(category), source_page_url=F.col("url"), year=F.substring("published_date", 1, 4), doc_path=path))
    return reduce(DataFrame.unionByName, out)


def with_details(listing: DataFrame, details: DataFrame, reader: Callable[[Column], Column] = markup.page_text) -> DataFrame:
    """A listing with the text, hash, pdf link and info table of its detail pages, joined by address."""
    read = details.select(
        F.col("url").alias("document_url"), reader(F.col("html")).alias("detail_text"), markup.pdf_link(F.col("html")).alias("pdf"),
        F.struct(*(markup.info_value(F.col("html"), label).alias(name) for label, name in (("No", "reference_no"), ("Date(g)", "date"), ("Date(h)", "date_hijri"), ("Status", "status")))).alias("info"),
    )
    return listing.join(read, "document_url", "left").withColumn("content_hash", text.content_hash(F.col("detail_text"), F.col("title")))


def section_documents(pages: DataFrame, regulator: str, category: str) -> DataFrame:
    """A document for each section of a page that begins at an anchor; empty sections go."""
    rows = markup.parsed(pages, "anchors").where(text.complete(F.col("section_text")))
    title = text.truncated(F.col("section_text"), 100)
    return as_documents(
        rows, regulator, "SECTIONS", category=F.lit(category), title=title, document_url=F.concat_ws("#", "url", "name"), source_page_url=F.col("url"), document_html=F.col("section_html"),
        content_hash=F.md5("section_text"), doc_path=F.array(F.lit(regulator), F.lit(category), F.col("name")), extra_meta=extra(content_text=F.col("section_text")),
    )


def tree_documents(pages: DataFrame, regulator: str, category: str, base: str, leaves_only: bool = True, stop: str | None = None) -> DataFrame:
    """Documents of nested lists: folders and leaves with their paths, each address once, up to an entry named ``stop``."""
    rows = markup.parsed(in_parts(pages), "list_tree", keep=("url", "part")).where(F.col("href") != "")
    if stop:
        place = F.struct("part", "pos")
        ends = rows.where(F.element_at("path", -1) == stop).groupBy("url").agg(F.min(place).alias("__end"))
        rows = rows.join(ends, "url", "left").where(F.col("__end").isNull() | (place < F.col("__end")))
    link = text.absolute_link(F.col("href"), F.lit(base))
    once = rows.withColumn("link", link).groupBy("link").agg(F.min(F.struct("url", "part", "pos", "path", "row_type", "depth")).alias("x")).select("link", "x.*")
    once = once.where("row_type = 'R'") if leaves_only else once
    return as_documents(once, regulator, "TREE", category=F.lit(category), title=F.element_at("path", -1), document_url=F.col("link"), source_page_url=F.col("url"), type=F.col("row_type"), doc_path=F.concat(F.array(F.lit(regulator), F.lit(category)), F.col("path")))


def year_links(pages: DataFrame, base: str) -> DataFrame:
    """Links whose title holds a year, each once, with their rank from the latest year on."""
    links = pages.select("url", F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"), F.lit(0))).alias("at", "a"))
    title = F.regexp_replace(F.regexp_replace("a", "(?s)<[^>]*>", " "), r"\s+", " ")
    year = F.nullif(F.regexp_extract(title, YEAR, 0), F.lit(""))
    href = F.regexp_extract("a", r"(?i)\bhref\s*=\s*[\"']([^\"']*)", 1)
    found = links.select("url", year.cast("int").alias("year"), text.absolute_link(href, F.lit(base)).alias("link"), "at").where("year is not null")
    once = found.groupBy("url", "year", "link").agg(F.min("at").alias("at"))
    ranked = once.groupBy("url").agg(F.sort_array(F.collect_list(F.struct((-F.col("year")).alias("down"), "at", "link"))).alias("l"))
    return ranked.select("url", F.posexplode("l").alias("rank", "x")).select("url", "rank", (-F.col("x.down")).alias("year"), "x.link")


def named_links(pages: DataFrame, base: str) -> DataFrame:
    """Named links of each cell of each table row: table_no, row_no, cell_no, title and link."""
    cells = markup.parsed(pages, "table_rows").select("url", "table_no", "row_no", F.posexplode("cell_links").alias("cell_no", "l"))
    one = cells.select("url", "table_no", "row_no", "cell_no", F.posexplode("l").alias("at", "a")).where(text.complete(F.col("a.title"), F.col("a.url")))
    return one.select("url", "table_no", "row_no", "cell_no", "at", "a.title", text.absolute_link(F.col("a.url"), F.lit(base)).alias("link"))


def section_links(pages: DataFrame, regulator: str, category: str, base: str, section_id: str | None = None, files_only: bool = False) -> DataFrame:
    """Documents of the links in one section, by its id, or in all accordions; each address once, the first title stays.

    Links within the page go, and with ``files_only`` all that are no files; a link without a title has its section's.
    """
    rows = markup.parsed(pages, "sections").withColumnRenamed("url", "page").where(~F.startswith("href", F.lit("#")))
    rows = rows.where(F.col("section_id") == section_id) if section_id is not None else rows
    low = F.lower("href")
    rows = rows.where(F.endswith(low, F.lit(".pdf")) | low.contains("/files/")) if files_only else rows
    one = rows.withColumn("link", text.absolute_link(F.col("href"), F.lit(base)))
    title = text.or_else(F.col("title"), F.col("section"))
    once = one.withColumn("title", title).where(text.complete(F.col("title"))).groupBy("link").agg(F.min(F.struct("page", "pos", "title", "section")).alias("x")).select("link", "x.*")
    return as_documents(once, regulator, "SECTION-LINKS", category=F.lit(category), document_url=F.col("link"), source_page_url=F.col("page"), content_hash=F.md5("title"), doc_path=F.array(F.lit(regulator), F.lit(category), F.col("title")))


def isolated(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], path: str, together: int = 4) -> tuple[DataFrame, DataFrame]:
    """(documents, runs): each source is written below ``path`` by itself, some at a time, so one that fails takes no other with it.

    ``runs`` has source, status (DONE or FAILED) and error.
    """

    def one(name: str) -> tuple[str, str, str | None]:
        try:
            sources[name]().select([f.name for f in DOCUMENT.fields]).write.mode("overwrite").parquet(f"{path}/source={name}")
            return name, "DONE", None
        except Exception as e:  # noqa: BLE001 - whatever a source does, the others go on
            return name, "FAILED", str(e).splitlines()[0][:500] if str(e) else type(e).__name__

    with ThreadPoolExecutor(together) as pool:
        runs = list(pool.map(one, sources))
    done = [f"{path}/source={name}" for name, status, _ in runs if status == "DONE"]
    docs = spark.read.schema(DOCUMENT).option("basePath", path).parquet(*done) if done else spark.createDataFrame([], DOCUMENT)
    return docs, spark.createDataFrame(runs, "source string, status string, error string")
