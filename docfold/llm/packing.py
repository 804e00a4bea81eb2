"""Best-fit packing into sequences of several permitted lengths.

Documents are dealt by a hash of their id into packing groups of about ``GROUP`` pieces, which are packed independently,
so no task holds more.  A document longer than the longest sequence is cut into pieces of that length and a rest.
Within a group pieces go longest first, each to the open bin that it leaves the least room in.  If none has room, a bin
is opened whose size costs least for each word it can expect: a bin of size c costs ``c * (1 + c / STEEP)``, as attention
over long sequences does, and can expect the piece and, as far as room is left, the shorter pieces that are still to be
packed.  Last, every bin is cut down to the smallest permitted size that holds its contents.

Definitions.  Length is counted in words.  A document without words, or with a null text, is returned once, in no bin.
Rows that repeat an id and a length are copies, numbered from 0; equal rows are counted before they are dealt and dealt in runs of
``RUN``, so a row that is repeated without end burdens no group.  A missing id is an id.  Only the id and the text are read.
An empty table gives an empty result.  Ties between bins go to the one opened first.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.llm.columns import word_count, words
from docfold.scratch import Scratch

SIZES, STEEP, GROUP, RUN = (256, 512, 1024, 2048, 4096), 32_768.0, 20_000, 64


def best_fit(lengths: np.ndarray, sizes: tuple[int, ...] = SIZES) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each piece, and the final size of each bin; lengths are from 1 to the largest size."""
    lengths = np.asarray(lengths, np.int64)
    waiting = np.bincount(lengths, minlength=sizes[-1] + 1)  # pieces to be packed, by length
    order = np.argsort(-lengths, kind="stable")
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    filled: list[int] = []
    capacity: list[int] = []
    room: dict[int, list[int]] = {}  # bins by room left
    rooms: list[int] = []
    shorter = np.cumsum(waiting * np.arange(len(waiting)))
    seen = 0
    for k in order:
        n = int(lengths[k])
        at = bisect.bisect_left(rooms, n)
        if at < len(rooms):
            left = rooms[at]
            b = room[left].pop(0)
            if not room[left]:
                del room[left]
                rooms.pop(at)
        else:
            if seen % 64 == 0:  # what is waiting changes slowly
                shorter = np.cumsum(waiting * np.arange(len(waiting)))
            seen += 1
            choices = [c for c in sizes if c >= n]
            left = min(choices, key=lambda c: c * (1 + c / STEEP) / (n + min(c - n, int(shorter[min(c - n, n)]))))
            b = len(filled)
            filled.append(0)
            capacity.append(left)
        waiting[n] -= 1
        where[k], offset[k] = b, filled[b]
        filled[b] += n
        left -= n
        if left:
            if left not in room:
                bisect.insort(rooms, left)
                room[left] = []
            bisect.insort(room[left], b)
    return where, offset, [sizes[bisect.bisect_left(sizes, f)] for f in filled]


def pieces(n: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of documents with n words: the document of each piece, where it starts and its length."""
    parts = -(-n // longest)
    doc = np.repeat(np.arange(len(n)), parts)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * longest
    return doc, start, np.minimum(longest, n[doc] - start)


_OUT = "id long, copy long, start long, n_words long, bin string, bin_size int, bin_offset long"


def pack_group(sizes: tuple[int, ...]):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "n", "first"], na_position="last", ignore_index=True)
        row = np.repeat(np.arange(len(pdf)), pdf["times"])
        copy = pdf["first"].to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(pdf["times"]) - pdf["times"], pdf["times"]).to_numpy()
        doc, start, length = pieces(pdf["n"].to_numpy()[row], sizes[-1])
        where, offset, final = best_fit(length, sizes)
        return pd.DataFrame(
            {
                "id": pdf["id"].astype("Int64").take(row[doc]).reset_index(drop=True),
                "copy": copy[doc],
                "start": start,
                "n_words": length,
                "bin": [f"{key[0]}-{b}" for b in where],
                "bin_size": np.array(final, np.int32)[where],
                "bin_offset": offset,
            }
        )

    return run


def _runs(lengths: DataFrame, run: int) -> DataFrame:
    """A row for each ``run`` copies, with the number of the first; numbers are made in steps, so that no array holds all."""
    for step in (run << 36, run << 18, run):
        begin = F.col("first") if "first" in lengths.columns else F.lit(0).cast("long")
        last = F.least(F.col("times"), F.col("until")) if "until" in lengths.columns else F.col("times")
        numbers = F.explode(F.sequence(begin, last - 1, F.lit(step).cast("long"))).alias("first")
        lengths = lengths.select("id", "n", "times", numbers).withColumn("until", F.col("first") + step)
    return lengths.drop("until")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sizes: tuple[int, ...] = SIZES, group: int = GROUP) -> DataFrame:
    """A row for each piece: id, copy, start and n_words within the document, bin, bin_size and bin_offset within the bin."""
    scratch = Scratch(docs.sparkSession, "packing")
    lengths = docs.select(F.col(id_col).cast("long").alias("id"), word_count(F.col(text_col)).alias("n"))
    lengths = scratch.write(lengths.groupBy("id", "n").agg(F.count("*").alias("times")), "lengths")
    total = lengths.agg(F.sum(F.col("times") * F.ceil(F.col("n") / sizes[-1]))).first()[0] or 0
    groups = max(1, -(-int(total) // group))
    runs = _runs(lengths, RUN)
    dealt = runs.where("n > 0").select("id", "n", "first", F.least(F.lit(RUN), F.col("times") - F.col("first")).cast("long").alias("times"), F.pmod(F.xxhash64("id", "first"), F.lit(groups)).alias("g"))
    packed = dealt.groupBy("g").applyInPandas(pack_group(tuple(sizes)), _OUT)
    none = _runs(lengths.where("n = 0"), 1).select("id", F.col("first").alias("copy"), F.lit(0).cast("long").alias("start"), F.col("n").alias("n_words"), F.lit(None).cast("string").alias("bin"), F.lit(None).cast("int").alias("bin_size"), F.lit(None).cast("long").alias("bin_offset"))
    return packed.unionByName(none).withColumnRenamed("id", id_col)


def piece_text(text: Column, start: Column, n_words: Column) -> Column:
    """The words of a piece, one space between them; the pieces of a document in order have all its words."""
    return F.array_join(F.slice(words(text), (start + 1).cast("int"), n_words.cast("int")), " ")
