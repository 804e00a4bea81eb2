"""File sources and sinks: pages, uploads, listings, exports."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.functions import markup, text
from docfold.functions.dates import date_in_cell
from docfold.functions.markup import parse
from docfold.operators.relational import carry_forward

UPLOADS = ("pdf", "docx", "doc", "txt", "html")


def uploads(spark: SparkSession, path: str) -> DataFrame:
    """Binary files with extension, sha256 and whether the type is accepted."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    ext = text.url_extension(F.col("path"))
    return files.select("path", "length", "content", ext.alias("extension"), F.sha2("content", 256).alias("file_hash"), F.coalesce(ext.isin(*UPLOADS), F.lit(False)).alias("accepted"))


def extracted(files: DataFrame, extract=None) -> DataFrame:
    """Text of uploads.  Plain text and HTML are read here; for the rest ``extract`` (bytes -> text) is asked, null without one."""

    @F.pandas_udf("string")
    def run(content: pd.Series, extension: pd.Series) -> pd.Series:
        def one(c: bytes, e: str | None) -> str | None:
            if e == "txt":
                return c.decode("utf-8", "replace")
            if e == "html":
                return parse(c.decode("utf-8", "replace")).text()
            return extract(c) if extract else None

        return pd.Series([one(c, e) for c, e in zip(content, extension, strict=True)], dtype="object")

    return files.withColumn("content_text", run("content", "extension"))


def assembled_pages(pages: DataFrame, keys: list[str], number: str = "page_no", body: str = "text") -> DataFrame:
    """Documents from pages: bad pages left out, the rest in order under ``PAGE n`` heads, scanned ones told apart."""
    bar = "=" * 60
    good = F.coalesce(~text.bad_page(F.col(body)), F.lit(False))
    page = F.struct(F.col(number), F.concat(F.lit("PAGE "), F.col(number).cast("string"), F.lit(f"\n{bar}\n"), F.col(body)).alias("t"))
    first = F.when(F.col(number) <= 3, F.length(F.coalesce(body, F.lit(""))))
    return pages.groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(good, page))), lambda p: p["t"]), "\n\n").alias("content_text"),
        F.count("*").alias("total_pages"), F.count_if(good).alias("good_pages"), (F.coalesce(F.avg(first), F.lit(0.0)) < 100).alias("scanned"),
    )


def table_documents(pages: DataFrame, columns: dict[str, int], source_system: str, base: str, header: Column | None = None, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Documents from listing tables: a column by cell number each, section heads carried forward, links made absolute.

    A row with one cell is a head.  Rows without a title go.
    """
    rows = markup.parsed(pages, "table_rows", html_col, (url_col,))
    head = header if header is not None else F.size("cells") == 1
    section = carry_forward(F.get("cells", F.lit(0)), head, [url_col, "table_no"], F.col("row_no"))
    rows = rows.withColumn("category", section).where(~head & ~F.col("header"))
    cells = [F.nullif(F.trim(F.get("cells", F.lit(i))), F.lit("")).alias(name) for name, i in columns.items()]
    out = rows.select(F.lit(source_system).alias("source_system"), F.col(url_col).alias("source_page_url"), "table_no", "row_no", "category", *cells, text.absolute_link(F.get("links", F.lit(0))["url"], F.lit(base)).alias("document_url"))
    if "published_date" in columns:
        out = out.withColumn("published", date_in_cell(F.col("published_date")))
    return out.where(text.complete(F.col("title")))


def union_modes(modes: dict[str, DataFrame], only: str | None = None) -> DataFrame:
    """One mode of a source, or all of them."""
    chosen = [df.withColumn("source_system", F.lit(name)) for name, df in modes.items() if only in (None, name)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chosen)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def query(spark: SparkSession, sql: str, **params) -> DataFrame:
    """SQL with named parameters."""
    return spark.sql(sql, args=params)
