"""Sources of pages that lead to pages: menus that unfold as they are followed, and an index of laws with sub-pages and manuals.

Stored pages are parsed once, into narrow tables of links.  A frontier then goes over these wave by wave: the links of the last wave that
no wave has been at, each once, until there are none; page bodies are joined at the end, to the pages that are documents.
Every wave is a table, so a run that is stopped goes on from the last one that was written to its end.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from docfold.functions import markup, text
from docfold.operators.relational import carry_forward
from docfold.scratch import Scratch
from docfold.sources.pages import as_documents, extra

# Files that are documents, words of rows that hold none, titles whose pages list downloads or chapters.
LAW_FILES = (".pdf", ".doc", ".docx", ".htm", ".html")
INDEX_TRASH = ("home", "about sbp", "best view", "copyright", "contact", "library", "events", "sitemap")
ROW_TRASH = ("home", "about sbp", "best view", "copyright", "contact", "english", "size", "download")
HEAD_WORDS = ("english", "urdu", "size", "download")
DOWNLOADS = (
    ("Prudential Regulations", "Prudential Regulations", r"(?i)prudential"),
    ("Anti-Money Laundering|AML", "Anti-Money Laundering, Combating the Financing of Terrorism & Countering Proliferation Financing", r"(?i)aml"),
)
MANUAL, MANUAL_URL = "Foreign Exchange Manual", "fe_manual"


def _written(df: DataFrame, path: str) -> bool:
    spark = df.sparkSession
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def frontier(seeds: DataFrame, step: Callable[[DataFrame], DataFrame], root: str) -> DataFrame:
    """All that is reached from ``seeds`` (url, place and more), each url once in its first wave, where the smallest place stays; with its ``wave``.

    ``step`` gives the rows that a wave leads to, with the columns of ``seeds``; what it joins should have been parsed before.  Places are
    arrays of positions, so the order among rows of a wave is that of a walk through the pages.
    """
    spark, kinds = seeds.sparkSession, seeds.schema
    rest = [c for c in seeds.columns if c not in ("url", "place")]
    now, paths = seeds, []
    while True:
        path = f"{root}/wave={len(paths)}"
        if not _written(seeds, path):
            once = now.where("url is not null").groupBy("url").agg(F.min_by(F.struct(*rest), "place").alias("x"), F.min("place").alias("place")).select("url", "place", "x.*")
            if paths:
                once = once.join(spark.read.schema("url string").parquet(*paths), "url", "left_anti")
            once.select(*kinds.names).write.mode("overwrite").parquet(path)
        wave = spark.read.schema(kinds).parquet(path)
        paths.append(path)
        if wave.isEmpty():
            return spark.read.schema(StructType([*kinds.fields, StructField("wave", IntegerType())])).option("basePath", root).parquet(*paths)
        now = step(wave).select(*kinds.names)


def menu_tree(pages: DataFrame, seed: str, regulator: str, category: str, base: str, root: str | None = None, stop: str | None = None) -> DataFrame:
    """Documents of the book menus of page ``seed``: folders, and leaves with what their own pages hold.

    An entry that is shown folded is looked up in the menu of its own page.  Each menu's first entry is a volume; none from the first whose title has ``stop``
    on is taken.  Addresses are told apart without a slash at their end, and each is a document once, at its least depth.
    """
    scratch = Scratch(pages.sparkSession, "menu")
    bare = lambda u: F.regexp_replace(u, "/+$", "")
    link = lambda c: text.absolute_link(F.col(c), F.lit(base))
    rows = markup.parsed(pages, "menu").select(bare("url").alias("page"), "pos", "menu_no", "above", bare(link("above_href")).alias("parent"), link("href").alias("link"), bare(link("href")).alias("url"), text.clean(F.col("title")).alias("title"), "folder", "unfolded")
    rows = scratch.write(rows, "links")
    shown = rows.groupBy("page", "parent").agg(F.min("above").alias("above"))  # of several entries of one address the first
    kids = rows.where("above >= 0").join(shown, ["page", "parent", "above"])
    on = lambda known, where: F.when(known, F.col(where)).otherwise(F.col("url"))
    tops = rows.where(F.col("page") == seed.rstrip("/")).where("above = -1")
    first = tops.groupBy("menu_no").agg(F.min("pos").alias("pos"))
    volumes = tops.join(first, ["menu_no", "pos"])
    if stop is not None:
        ends = volumes.where(F.contains(F.lower("title"), F.lit(stop.lower()))).agg(F.min("menu_no").alias("end"))
        volumes = volumes.join(F.broadcast(ends)).where("end is null or menu_no < end")  # one row
    head = F.array(F.lit(regulator), F.lit(category))
    seeds = volumes.select("url", F.array("menu_no").alias("place"), "link", "title", F.concat(head, F.array("title")).alias("path"), on(F.col("unfolded"), "page").alias("look_on"), F.lit(True).alias("folder"))

    def step(wave: DataFrame) -> DataFrame:
        above = wave.where("folder").select(F.col("url").alias("parent"), F.col("look_on").alias("page"), F.col("place").alias("up"), F.col("path").alias("path_up"))
        found = above.join(kids, ["page", "parent"])
        return found.select("url", F.concat("up", F.array("pos")).alias("place"), "link", "title", F.concat("path_up", F.array("title")).alias("path"), on(F.col("folder") & F.col("unfolded"), "page").alias("look_on"), "folder")

    nodes = frontier(seeds, step, root or scratch.path("waves"))
    parents = kids.select(F.col("page").alias("look_on"), F.col("parent").alias("url")).distinct().withColumn("has", F.lit(True))
    nodes = nodes.join(parents, ["look_on", "url"], "left").withColumn("is_folder", F.col("folder") & F.col("has").isNotNull() | (F.col("wave") == 0))
    leaves = nodes.where("not is_folder").select("url").distinct()
    bodies = pages.select(bare("url").alias("url"), "html").join(leaves, "url", "left_semi").select("url", markup.page_body(F.col("html")).alias("body"))
    found = nodes.join(bodies, "url", "left").withColumn("content", F.when(F.col("is_folder"), F.col("title")).otherwise(F.coalesce(markup.page_text(F.col("body")), F.lit(""))))
    folder_html = F.concat(F.lit("<div class='folder'><h2>"), "title", F.lit("</h2></div>"))
    pdf = F.get(F.filter(markup.hrefs(F.col("body")), lambda u: markup.link_kind(u) == "pdf"), F.lit(0))
    return as_documents(
        found, regulator, "MENU", category=F.lit(category), document_url=F.col("link"), doc_path=F.col("path"), type=F.when(F.col("is_folder"), "F").otherwise("R"), content_hash=text.content_hash(F.col("content"), F.col("title")),
        document_html=F.when(F.col("is_folder"), folder_html).otherwise(F.coalesce("body", F.lit(""))), extra_meta=extra(content_text=F.col("content"), org_pdf_link=text.absolute_link(pdf, F.lit(base))),
    )


def _has(x: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(F.lower(x), F.lit(w)) for w in words))


def _is_file(u: Column) -> Column:
    return reduce(lambda a, b: a | b, (F.endswith(F.lower(u), F.lit(e)) for e in LAW_FILES))


def law_documents(pages: DataFrame, index: str, regulator: str, base: str, heading: str = "Laws & Regulations", root: str | None = None) -> DataFrame:
    """Documents of an index of laws, of the pages that it leads to, and of the volumes, chapters and appendices of manuals.

    Of a page's downloads by title, downloads by row, and links to files the first kind that is there is taken.  A page is read once, as what the first
    link to it says.
    """
    scratch = Scratch(pages.sparkSession, "laws")
    absolute = lambda u: text.absolute_link(u, F.lit(base))
    rows = scratch.write(markup.parsed(pages, "index_rows"), "rows")
    chapters = scratch.write(markup.parsed(pages, "manual").withColumn("link", absolute(F.col("href"))), "manuals")
    section = carry_forward(F.col("section"), F.col("section") != "", ["url"], F.col("pos"))
    one = rows.where(F.col("url") == index).withColumn("under", section).where((F.col("section") == "") & ~_has(F.col("body"), INDEX_TRASH) & F.col("bullet"))
    first = F.get("links", F.lit(0))
    entries = one.select("url", "pos", "under", text.clean(first["title"]).alias("title"), absolute(first["url"]).alias("link")).where(text.complete(F.col("title"), F.col("link")))
    lists = reduce(lambda a, b: a | b, (F.col("title").rlike(p) for p, _, _ in DOWNLOADS))
    manual = F.col("title").contains(MANUAL)
    entries = scratch.write(entries.withColumn("follow", lists | manual | ~_is_file(F.col("link"))), "entries")
    context = ["under", "parent_title"]
    seeds = entries.where("follow").select(F.col("link").alias("url"), F.array("pos").alias("place"), F.coalesce("under", F.lit("Unknown")).alias("under"), F.col("title").alias("parent_title"))

    def step(wave: DataFrame) -> DataFrame:
        """Appendices that are pages."""
        found = wave.join(chapters.where("kind = 'appendix'").where(F.lower("link").rlike(r"\.html?$")), "url")
        return found.select(F.col("link").alias("url"), F.concat("place", F.array("pos")).alias("place"), "under", F.concat("parent_title", F.lit(" – Appendix "), "number").alias("parent_title"))

    waves = scratch.write(frontier(seeds, step, root or scratch.path("waves")), "waves")
    is_manual = F.col("url").contains(MANUAL_URL) | F.col("parent_title").contains(MANUAL)
    of_list = F.coalesce(*(F.when(F.col("parent_title").rlike(p) | F.col("url").rlike(u), F.lit(t)) for p, t, u in DOWNLOADS))
    read = waves.withColumns({"manual": is_manual, "listed": of_list})
    # three ways to read a page that is no manual; the first that finds something counts
    plain = read.where("not manual").join(rows, "url")
    cell = text.clean(F.get("cells", F.lit(0)))
    by_title = plain.where(F.col("listed").isNotNull() & (F.size("cells") >= 2) & (F.length(cell) >= 5) & ~_has(cell, HEAD_WORDS) & (F.size("files") > 0))
    by_title = by_title.select("url", *context, "listed", F.lit(1).alias("way"), "pos", F.lit(0).alias("at"), cell.alias("title"), F.get("files", F.lit(0)).alias("href"))
    by_row = plain.where((F.length("body") > 0) & ~_has(F.col("body"), ROW_TRASH)).where(F.length(cell) >= 3).select("url", *context, "listed", F.lit(2).alias("way"), "pos", F.posexplode("files").alias("at", "href"), cell.alias("title"))
    anchors = markup.parsed(pages.join(read.where("not manual").select("url"), "url", "left_semi"), "anchor_links")
    by_link = read.where("not manual").join(anchors, "url").where(_is_file(absolute(F.col("href"))) & (F.length(text.clean(F.col("title"))) > 0))
    by_link = by_link.select("url", *context, "listed", F.lit(3).alias("way"), "pos", F.lit(0).alias("at"), text.clean(F.col("title")).alias("title"), "href")
    found = scratch.write(by_title.unionByName(by_row).unionByName(by_link), "found")
    best = found.groupBy("url").agg(F.min("way").alias("way"))
    found = found.join(best, ["url", "way"]).withColumn("link", absolute(F.col("href")))
    head, none = F.array(F.lit(regulator), F.lit(heading)), F.lit(None).cast("string")
    lists_path = F.array(F.lit("Regulations"), F.col("listed"), F.col("title"))
    by_list = F.col("way") == 1
    docs = found.select(
        F.when(by_list, F.lit("Regulations")).otherwise(F.col("under")).alias("category"), "title", "link", F.when(by_list, F.array(F.lit("Regulations"), F.col("parent_title"))).otherwise(F.array("under", "parent_title")).alias("department"),
        F.col("url").alias("source_page_url"), F.when(by_list, lists_path).otherwise(F.array("under", "parent_title", "title")).alias("path"), none.alias("reference_no"),
    )
    direct = entries.where("not follow").select(F.coalesce("under", F.lit("Law")).alias("category"), "title", "link", F.when(F.col("under").isNotNull(), F.array("under")).otherwise(F.array().cast("array<string>")).alias("department"), F.col("url").alias("source_page_url"), F.array(F.coalesce("under", F.lit("Unknown")), "title").alias("path"), none.alias("reference_no"))
    parts = read.where("manual").join(chapters, "url").where("kind <> 'appendix' or not lower(link) rlike '[.]html?$'")
    named = F.when((F.col("kind") == "chapter") & (F.col("number") != ""), F.concat(F.lit("Chapter "), "number", F.lit(": "), "title")).otherwise(F.col("title"))
    label = F.when(F.col("number") != "", F.concat(F.initcap("kind"), F.lit(" "), "number"))
    of_manual = parts.select(F.col("under").alias("category"), named.alias("title"), "link", F.array("under", "parent_title", "volume").alias("department"), F.col("url").alias("source_page_url"), F.array(F.col("under"), F.col("parent_title"), F.col("volume"), named).alias("path"), label.alias("reference_no"))
    whole = reduce(DataFrame.unionByName, (direct, docs, of_manual))
    return as_documents(whole, regulator, "LAWS", document_url=F.col("link"), doc_path=F.concat(head, F.col("path")))
