"""Language identification by rank-order profiles.

The profile of a language is the order of its most frequent n-grams; a text gets the language whose profile is nearest
to the order of its own most frequent n-grams by out-of-place distance.

N-grams are of 1 to ``LONGEST`` bytes of UTF-8, with A-Z lower-cased, every other byte that is no letter's read as a
space, and none that is a space or holds two in a row.  Texts are counted whole, and profiles are learned from all training texts.

Definitions.  A null text, or one without a letter, is ``und`` with score 0.  Of equal counts the shorter n-gram comes first, then
the smaller bytes; equal distances by the language's code points.  Without training texts every text is ``und``.  Rows are judged one
by one, so repeated rows are judged alike.  A row with a null language is not learned from; one without id is learned
from.  The profiles sent to executors hold ``PROFILE`` n-grams a language.  Language, source and id are never read for a
prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docfold.llm.columns import id_hash
from docfold.llm.words import text_bytes

LONGEST, PROFILE = 4, 400
#: Bytes whose n-grams are sorted at once.
PIECE = 1 << 18


def _letters() -> np.ndarray:
    t = np.full(256, 32, np.uint8)
    t[97:123] = t[65:91] = np.arange(97, 123)
    t[128:] = np.arange(128, 256)
    return t


def grams(text: np.ndarray) -> np.ndarray:
    """Keys of all n-grams of mapped bytes; a key holds the bytes and, in its top byte, their number."""
    out = []
    blank = text == 32
    double = np.zeros(len(text), dtype=bool)
    double[:-1] = blank[:-1] & blank[1:]
    wide = text.astype(np.uint64)
    key, bad = np.zeros(len(text), np.uint64), np.zeros(len(text), dtype=bool)
    for n in range(1, LONGEST + 1):
        m = len(text) - n + 1
        if m <= 0:
            break
        key = (key[:m] << np.uint64(8)) | wide[n - 1 :]
        if n > 1:
            bad = bad[:m] | double[n - 2 : n - 2 + m]
        out.append(key[~(bad if n > 1 else blank)] | np.uint64(n << 56))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weights is not None:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    else:
        keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(keys))) if weights is None else (np.add.reduceat(weights, first) if len(first) else weights)
    return keys[first], n


def text_grams(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of a whole text with counts; long texts piece by piece, overlapping so that none is missed or met twice."""
    if len(text) <= PIECE:
        return counted(grams(text))
    parts = []
    for lo in range(0, len(text), PIECE):
        parts.append(counted(grams(text[lo : lo + PIECE])))
        edge = text[max(0, lo - LONGEST + 1) : lo + LONGEST - 1] if lo else text[:0]
        if len(edge):  # n-grams across the cut: those of the edge less those of its halves
            a, n = counted(np.concatenate([grams(edge)]))
            parts.append((a, n))
            for half in (text[max(0, lo - LONGEST + 1) : lo], text[lo : lo + LONGEST - 1]):
                a, n = counted(grams(half))
                parts.append((a, -n))
    keys, n = counted(np.concatenate([a for a, _ in parts]), np.concatenate([n for _, n in parts]))
    return keys[n > 0], n[n > 0]


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of each batch."""
    table = _letters()
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        langs = batch.column(0).to_pylist()
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        held: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}

        def count(lang: str) -> None:
            found.setdefault(lang, []).append(counted(np.concatenate([grams(x) if len(x) <= PIECE else np.zeros(0, np.uint64) for x in held[lang]])))
            found[lang] += [text_grams(x) for x in held[lang] if len(x) > PIECE]
            if len(found[lang]) > 16:
                found[lang] = [counted(np.concatenate([a for a, _ in found[lang]]), np.concatenate([n for _, n in found[lang]]))]
            held[lang], size[lang] = [], 0

        for i, lang in enumerate(langs):
            text = table[data[offsets[i] : offsets[i + 1]]]
            held.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text)
            if size[lang] > PIECE:
                count(lang)
        for lang in list(held):
            if held[lang]:
                count(lang)
            keys, n = counted(np.concatenate([a for a, _ in found[lang]]), np.concatenate([n for _, n in found[lang]]))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], ["lang", "gram", "n"])


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, the n-grams of their profiles (sorted) and the rank of each in each profile, ``PROFILE`` if it is not in it."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = rows.mapInArrow(count_batches, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    first = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= PROFILE)  # cut before the shuffle too
    top = first.select("lang", "gram", (F.col("place") - 1).alias("rank")).toPandas()
    langs = sorted(top["lang"].unique())
    keys = np.unique(top["gram"].to_numpy(np.int64).view(np.uint64))
    ranks = np.full((len(keys), len(langs)), PROFILE, np.int64)
    at = np.searchsorted(keys, top["gram"].to_numpy(np.int64).view(np.uint64))
    ranks[at, np.searchsorted(np.array(langs, dtype=object), top["lang"].to_numpy())] = top["rank"].to_numpy()
    return langs, keys, ranks


def predict_batches(langs: list[str], keys: np.ndarray, ranks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _letters()
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            lettered = batch.column(1).to_pylist()
            best, score = [], []
            for i in range(batch.num_rows):
                g = n = ()
                if lettered[i] and langs:
                    g, n = text_grams(table[data[offsets[i] : offsets[i + 1]]])
                if not len(g):
                    best.append("und")
                    score.append(0.0)
                    continue
                if len(n) > PROFILE:  # the most frequent, with all that tie with the last, then cut in order
                    least = np.partition(n, len(n) - PROFILE)[len(n) - PROFILE]
                    g, n = g[n >= least], n[n >= least]
                g = g[np.argsort(-n, kind="stable")[:PROFILE]]
                at = np.searchsorted(keys, g)
                at[at == len(keys)] = 0
                theirs = np.where((keys[at] == g)[:, None], ranks[at], PROFILE)
                apart = np.where(theirs < PROFILE, np.abs(theirs - np.arange(len(g))[:, None]), PROFILE).sum(axis=0)
                k = int(apart.argmin())
                best.append(langs[k])
                score.append(1.0 - float(apart[k]) / (PROFILE * len(g)))
            yield pa.RecordBatch.from_arrays([pa.array(best, pa.string()), pa.array(score, pa.float64()), *batch.columns[2:]], ["lang_pred", "score", *batch.schema.names[2:]])

    return run


def identify(docs: DataFrame, train: DataFrame, keep: list[str], text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang_pred and score of every row, with the columns ``keep``."""
    langs, keys, ranks = learn(train, text_col, lang_col)
    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(text_col).cast("string").alias("1"), lettered.alias("2"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)))
    kinds = ", ".join(f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    out = rows.mapInArrow(predict_batches(langs, keys, ranks), f"lang_pred string, score double{', ' * bool(keep)}{kinds}")
    return out.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), "lang_pred", "score")


def held_out_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, fold: int = 2) -> DataFrame:
    """Learn without one fold of ids, then predict every row."""
    out = F.coalesce(id_hash(id_col, folds) == fold, F.lit(False))
    found = identify(docs, docs.where(~out), [id_col], text_col, lang_col)
    return found.select(id_col, out.alias("held_out"), "lang_pred", "score")
