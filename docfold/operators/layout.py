"""Positioned text of page images and PDFs: spans with links and formats, recognised pages, chains of converters.

Spans, links and recognised texts come as tables; reading PDFs and recognising images is done by whatever makes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfold.functions import text

BOLD, ITALIC = 16, 2
ADDRESS = r"https?://[^\s<>\"']+"


#: The finest cells of the grid in which rectangles meet, in points.
CELL = 8.0


def _cells(rects: DataFrame, side: str, tops: DataFrame, keys: list[str]) -> DataFrame:
    """Each rectangle with the cells it touches, at its own level of the grid, where they are few, and at all coarser ones of its page."""
    at = lambda x: F.floor(F.col(f"{side}{x}") / F.col("__size")).cast("long")
    span = lambda a, b: F.explode(F.sequence(F.least(at(a), at(b)), F.greatest(at(a), at(b))))
    up = rects.join(tops, keys).withColumn("__at", F.explode(F.sequence("__level", "__top"))).withColumn("__size", F.lit(CELL) * F.pow(F.lit(2.0), "__at"))
    return up.withColumn("__cx", span("x0", "x1")).withColumn("__cy", span("y0", "y1"))


def overlaps(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of rectangles (x0, y0, x1, y1) of one page (``keys``) that overlap, each once; their columns have ``l_`` and ``r_`` before their names.

    Rectangles meet in cells of a grid, so the join is by page and cell.  A rectangle's level is that at which it touches at most three cells a side; a pair meets
    at the higher of its two levels, and counts in the cell where its common part begins.  Rectangles without all four numbers meet none.
    """

    def named(df: DataFrame, side: str) -> DataFrame:
        width = F.greatest(F.abs(F.col("x1") - F.col("x0")), F.abs(F.col("y1") - F.col("y0")))
        level = F.greatest(F.ceil(F.log2(F.greatest(width, F.lit(CELL)) / CELL)), F.lit(0)).cast("int")
        sound = df.where("x0 is not null and y0 is not null and x1 is not null and y1 is not null")
        return sound.select(*keys, *(F.col(c).alias(side + c) for c in df.columns if c not in keys), level.alias("__level"))

    a, b = named(left, "l_"), named(right, "r_")
    tops = a.select(*keys, "__level").unionByName(b.select(*keys, "__level")).groupBy(*keys).agg(F.max("__level").alias("__top"))
    cell = [*keys, "__at", "__cx", "__cy"]
    x = _cells(a, "l_", tops, keys).withColumnRenamed("__level", "__own").drop("__top")
    y = _cells(b, "r_", tops, keys).withColumnRenamed("__level", "__other").drop("__top", "__size")
    begins = lambda c: F.floor(F.greatest(f"l_{c}", f"r_{c}") / F.col("__size"))
    over = (F.col("l_x0") < F.col("r_x1")) & (F.col("l_x1") > F.col("r_x0")) & (F.col("l_y0") < F.col("r_y1")) & (F.col("l_y1") > F.col("r_y0"))
    once = (F.col("__at") == F.greatest("__own", "__other")) & (F.col("__cx") == begins("x0")) & (F.col("__cy") == begins("y0"))
    return x.join(y, cell).where(once & over).select(*keys, *(c for c in a.columns + b.columns if c[:2] in ("l_", "r_")))


def linked_spans(spans: DataFrame, links: DataFrame, keys: list[str]) -> DataFrame:
    """``uri`` of the first link of the page whose rectangle overlaps that of a span, else an address in its text.

    Both have x0, y0, x1, y1 and the page's ``keys``; ``links`` has link_no and uri, ``spans`` a span_no.  Equal rectangles of a page meet once: of links
    only the first of each rectangle can count, and all spans of one rectangle have the same.
    """
    rect = [*keys, "x0", "y0", "x1", "y1"]
    firsts = links.where("link_no is not null").groupBy(*rect).agg(F.min_by("uri", "link_no").alias("uri"), F.min("link_no").alias("link_no"))
    met = overlaps(spans.select(*rect).distinct(), firsts, keys)
    hit = met.groupBy(*(F.col(c if c in keys else f"l_{c}").alias(c) for c in rect)).agg(F.min_by("r_uri", "r_link_no").alias("uri"))
    own = F.nullif(F.regexp_extract("text", ADDRESS, 0), F.lit(""))
    return spans.join(hit, rect, "left").withColumn("uri", F.coalesce("uri", own))


def escaped(x: Column) -> Column:
    """Text as HTML."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def span_html(body: Column, font: Column, size: Column, flags: Column, uri: Column) -> Column:
    """A span with its weight, slope, link and, over 14 and 16 points, its rank as a heading."""
    low = F.lower(F.coalesce(font, F.lit("")))
    bold = (flags.bitwiseAND(BOLD) != 0) | low.contains("bold")
    italic = (flags.bitwiseAND(ITALIC) != 0) | low.contains("italic")
    x = escaped(body)
    x = F.when(italic, F.concat(F.lit("<em>"), x, F.lit("</em>"))).otherwise(x)
    x = F.when(bold, F.concat(F.lit("<strong>"), x, F.lit("</strong>"))).otherwise(x)
    x = F.when(uri.isNotNull(), F.concat(F.lit('<a href="'), escaped(uri), F.lit('">'), x, F.lit("</a>"))).otherwise(x)
    rank = F.when(size > 16, ' class="heading-large"').when(size > 14, ' class="heading-medium"').otherwise("")
    return F.concat(F.lit("<span"), rank, F.lit(' style="font-size: '), size.cast("string"), F.lit('px;">'), x, F.lit("</span>"))


def line_paragraphs(spans: DataFrame, keys: list[str], line: str = "line_no") -> DataFrame:
    """A paragraph for each line of spans (``keys``, line, span_no, text, font, size, flags, uri); blank spans are left out."""
    rows = spans.where(F.length(F.trim("text")) > 0).withColumn("html", span_html(F.col("text"), F.col("font"), F.col("size"), F.col("flags"), F.col("uri")))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("span_no", "html"))), lambda x: x["html"])
    return rows.groupBy(*keys, line).agg(F.concat(F.lit("<p>"), F.array_join(parts, ""), F.lit("</p>")).alias("html"))


def recognised(pages: DataFrame, read: DataFrame | None, keys: list[str], body: str = "text") -> DataFrame:
    """Pages whose text is bad get the text that was recognised from their image, if there is one and it is longer; ``by`` tells which stands."""
    if read is None:
        return pages.withColumn("by", F.lit("text"))
    other = read.select(*keys, F.col(body).alias("__read"))
    better = F.coalesce(text.bad_page(F.col(body)) & (F.length("__read") > F.length(F.coalesce(body, F.lit("")))), F.lit(False))
    joined = pages.join(other, keys, "left").withColumn("by", F.when(better, "recognised").otherwise("text"))
    return joined.withColumn(body, F.when(better, F.col("__read")).otherwise(F.col(body))).drop("__read")


def first_conversion(docs: DataFrame, chain: dict[str, DataFrame], key: str, out: str = "html") -> DataFrame:
    """The result of the first converter in the chain that gave one, and its name; null where none did."""
    for name, result in chain.items():
        docs = docs.join(result.select(key, F.col(out).alias(f"__{name}")), key, "left")
    given = [text.or_else(F.col(f"__{name}")) for name in chain]
    engine = F.coalesce(*(F.when(x.isNotNull(), F.lit(name)) for x, name in zip(given, chain, strict=True)))
    return docs.withColumn(out, F.coalesce(*given)).withColumn("engine", engine).drop(*(f"__{name}" for name in chain))


# The least confidence of a recognised word, gaps that break a line and a block, heights of headings, marks of list items.
CONFIDENCE, LINE_GAP, BLOCK_GAP = 40, 20, 40
HEADING, SHORT_HEADING, SHORT = 20, 15, 5
LIST_MARKS = r"^([•*-]|[1-5]\.)"


def word_blocks(words: DataFrame, keys: list[str]) -> DataFrame:
    """(``keys``, block_no, block_type, text, avg_height, n_words) of recognised words (``keys``, word_no, text, conf, top, height).

    Words go by word_no within a page (``keys``).  The gap between a word's top and the bottom of the word before it begins a line if it is over 20 and a
    block if it is over 40; blank words and those recognised with a confidence under 40 count for nothing.  A block is a heading if its words are high, or few and
    fairly high; an item of a list if it begins with a mark, which goes unless it is a number; else a paragraph.
    """
    kept = words.where((F.length(F.trim("text")) > 0) & (F.col("conf") >= CONFIDENCE))
    w = Window.partitionBy(*keys).orderBy("word_no")
    gap = F.col("top") - F.lag(F.col("top") + F.col("height")).over(w)
    rows = kept.withColumn("__gap", F.coalesce(gap, F.lit(0)))
    rows = rows.withColumn("block_no", F.sum((F.col("__gap") > BLOCK_GAP).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    word = F.concat(F.when((F.col("__gap") > LINE_GAP) & (F.col("__gap") <= BLOCK_GAP), "\n ").otherwise(""), F.trim("text"))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("word_no", word.alias("word")))), lambda x: x["word"])
    blocks = rows.groupBy(*keys, "block_no").agg(F.regexp_replace(F.array_join(parts, " "), " +", " ").alias("whole"), F.avg("height").alias("avg_height"), F.count("*").alias("n_words"))
    few = F.size(F.filter(F.split("whole", r"\s+"), lambda x: x != "")) <= SHORT
    kind = F.when(F.col("avg_height") > HEADING, "heading").when(F.col("whole").rlike(LIST_MARKS), "list_item").when(few & (F.col("avg_height") > SHORT_HEADING), "heading").otherwise("paragraph")
    text = F.when((kind == "list_item") & F.col("whole").rlike("^[•*-]"), F.trim(F.substring("whole", 2, 1 << 30))).otherwise(F.col("whole"))
    return blocks.select(*keys, "block_no", kind.alias("block_type"), text.alias("text"), "avg_height", "n_words")


def blocks_html(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """A page's blocks as HTML, one below the other: headings in their size, addresses in paragraphs as links, items with a dot."""
    body = escaped(F.col("text"))
    heading = F.concat(F.lit('<p><span class="heading-large" style="font-size: '), (F.col("avg_height") * 1.5).cast("string"), F.lit('px;"><strong>'), body, F.lit("</strong></span></p>"))
    linked = F.regexp_replace(body, "(https?://[^\\s<>\"')]+)", '<a href="$1">$1</a>')
    html = F.when(F.col("block_type") == "heading", heading).when(F.col("block_type") == "list_item", F.concat(F.lit("<p>• "), body, F.lit("</p>"))).otherwise(F.concat(F.lit("<p>"), linked, F.lit("</p>")))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("block_no", html.alias("html")))), lambda x: x["html"])
    return blocks.groupBy(*keys).agg(F.array_join(parts, "\n").alias("html"), F.count("*").alias("n_blocks"))
