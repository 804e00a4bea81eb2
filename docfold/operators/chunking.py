"""Texts in chunks for models with a limited window."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK, TEXT_CHUNK, OVERLAP = 12_000, 15_000, 500


def greedy(text: Column, most: int = CHUNK, separator: str = "\n\n") -> Column:
    """Paragraphs packed in order up to ``most`` characters, separators not counted; a longer paragraph is a chunk by itself."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("n"))

    def add(acc: Column, p: Column) -> Column:
        fits = acc["n"] + F.length(p) <= most
        full = F.when(acc["n"] > 0, F.array_append(acc["done"], acc["open"])).otherwise(acc["done"])
        joined = F.when(acc["n"] > 0, F.concat(acc["open"], F.lit(separator), p)).otherwise(p)
        return F.struct(
            F.when(fits, acc["done"]).otherwise(full).alias("done"),
            F.when(fits, joined).otherwise(p).alias("open"),
            F.when(fits, acc["n"] + F.length(p)).otherwise(F.length(p)).alias("n"),
        )

    parts = F.filter(F.transform(F.split(text, separator), lambda p: F.trim(p)), lambda p: F.length(p) > 0)
    return F.aggregate(parts, start, add, lambda acc: F.when(acc["n"] > 0, F.array_append(acc["done"], acc["open"])).otherwise(acc["done"]))


def fixed(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Windows of ``size`` characters with their true offsets: chunk_num from 1, total_chunks, char_start, char_end."""
    n = F.length(text)
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(size))
    rows = docs.where(F.col(text).isNotNull()).select(key, text, n.alias("n"), F.size(starts).cast("long").alias("total_chunks"), F.posexplode(starts).alias("i", "s"))
    return rows.select(key, (F.col("i") + 1).cast("long").alias("chunk_num"), "total_chunks", F.col("s").cast("long").alias("char_start"), F.least(F.col("s") + size, F.col("n")).cast("long").alias("char_end"), F.expr(f"substring({text}, s + 1, {size})").alias("chunk_text"))


def context(title: Column, num: Column, total: Column) -> Column:
    """A header that tells a model where it reads."""
    return F.concat_ws(
        " | ",
        F.concat(F.lit("Document: "), title),
        F.concat(F.lit("Chunk "), num.cast("string"), F.lit(" of "), total.cast("string")),
        F.when(num > 1, F.lit("Continuation")),
        F.when(num < total, F.lit("Continues")),
    )


_HEADS = r"(?=Chapter\s+\d+|Article\s+\d+|Section\s+\d+|CHAPTER\s+[IVXLC\d]+|Part\s+[IVXLC\d]+|المادة|الفصل|الباب)"


def sections(text: Column) -> Column:
    """Text split before chapter, article, section and part heads at line starts; without any, at empty lines."""
    by_head = F.split(text, r"\n" + _HEADS)
    return F.filter(F.when(F.size(by_head) > 1, by_head).otherwise(F.split(text, r"\n\s*\n")), lambda s: F.length(F.trim(s)) > 0)


def line_sections(text: Column) -> Column:
    """Text split before lines that begin with a capital letter."""
    return F.split(text, r"\n(?=[A-Z])")


def _overlapping(parts: list[str], most: int, overlap: int) -> list[str]:
    out: list[str] = []
    held = ""
    for p in parts:
        if held and len(held) + len(p) > most:
            out.append(held)
            held = held[-overlap:] + "\n" + p if overlap else p
        else:
            held = f"{held}\n{p}" if held else p
    return [*out, held] if held else out


def _by_size(text: str, most: int, overlap: int) -> list[tuple[int, str]]:
    """Cuts go back to the end of a paragraph, else of a sentence, if that lies past the half of the window."""
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + most)
        if end < len(text):
            for mark in ("\n\n", ". ", "\n"):
                cut = text.rfind(mark, at, end)
                if cut > at + most // 2:
                    end = cut + len(mark)
                    break
        out.append((at, text[at:end]))
        if end == len(text):
            break
        at = max(at + 1, end - overlap)
    return out


def overlapping(text: Column, most: int = TEXT_CHUNK, overlap: int = OVERLAP, structured: bool = True) -> Column:
    """Chunks with an overlap, as structs (char_start, chunk_text); structured chunks end at section heads where they can."""

    @F.pandas_udf("array<struct<char_start:long,chunk_text:string>>")
    def run(x: pd.Series) -> pd.Series:
        def one(t: str | None) -> list[dict]:
            if not t:
                return []
            if structured:
                parts = [p for p in re.split(r"\n" + _HEADS, t) if p.strip()]
                if len(parts) > 1:
                    return [{"char_start": max(0, t.find(c[overlap:] if i else c)), "chunk_text": c} for i, c in enumerate(_overlapping(parts, most, overlap))]
            return [{"char_start": s, "chunk_text": c} for s, c in _by_size(t, most, overlap)]

        return x.map(one)

    return run(text)


def chunk_stats(chunks: DataFrame, key: str, text: str = "chunk_text") -> DataFrame:
    n = F.length(text).cast("long")
    return chunks.groupBy(key).agg(
        F.count("*").alias("n_chunks"), F.sum(n).alias("total_chars"), F.floor(F.sum(n) / F.count("*")).cast("long").alias("avg_chars"), F.min(n).alias("min_chars"), F.max(n).alias("max_chars"), F.floor(F.sum(n) / 4).cast("long").alias("est_tokens")
    )
