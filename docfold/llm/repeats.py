"""Removal of repeated passages by prefix-free parsing.

Every 200-byte string that starts at two or more places of the corpus is removed wherever it occurs.

Method.  A rolling hash is taken of all ``GRAM``-byte strings.  The trigger of a 200-byte window is the smallest such hash
within it, so equal windows have equal triggers.  A phrase is the text of a maximal run of windows with one trigger:
phrases overlap by 199 bytes, so each window lies in exactly one phrase.  A document's parse is its sequence of phrases;
the dictionary is the set of distinct phrases.  The parse then orders by counting: a phrase met twice has all its
windows repeated, a trigger met once, in one place, has none.  Only phrases whose trigger is shared with a different phrase, or is in it twice, need
an order of suffixes: the dictionary's suffix array, to 200 bytes deep, is built by prefix doubling over each group of
triggers, and neighbours of equal rank are repeated.  As no window crosses a phrase, the order of dictionary suffixes with the
counts of the parse is the corpus order as far as 200 bytes can tell.

Bounds.  Phrases met twice within an Arrow batch are settled before the shuffle, so a passage that a third of all rows
hold costs one row a batch.  Groups of triggers are gathered up to ``GROUP`` bytes; a trigger with more bytes of
different phrases is settled by counting fingerprints of its windows in Spark instead, which has the same result.

Definitions.  A null text is empty.  Texts under 200 bytes lose nothing.  Rows that repeat an id, or have none, are
separate documents.  Only the id and the text are read.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docfold.llm.columns import row_key
from docfold.llm.words import _U, _table, mix, text_bytes
from docfold.scratch import Scratch

LENGTH, GRAM = 200, 32
#: Bytes hashed at once; bytes of phrases whose suffixes are ordered at once.
PIECE, GROUP = 1 << 20, 4 << 20
#: A trigger with more bytes of different phrases than this is settled by counting.
HOT = 16 << 20


class RollingHash:
    """Hashes of substrings from prefix sums of random byte values times powers of an odd base."""

    def __init__(self, seed: int = 21):
        self.values = _table(seed, 256)
        self.base = int(_table(seed + 1, 1)[0]) | 1
        self.n = 0

    def sums(self, data: np.ndarray) -> np.ndarray:
        if self.n <= len(data):
            self.n = len(data) + 1
            p, q = np.full(self.n, self.base, np.uint64), np.full(self.n, pow(self.base, -1, 2**64), np.uint64)
            p[0] = q[0] = 1
            self.powers, self.inverses = np.multiply.accumulate(p), np.multiply.accumulate(q)
        out = np.empty(len(data) + 1, np.uint64)
        out[0] = 0
        np.cumsum(self.values[data] * self.powers[: len(data)], out=out[1:])
        return out

    def every(self, sums: np.ndarray, length: int) -> np.ndarray:
        return mix((sums[length:] - sums[:-length]) * self.inverses[: len(sums) - length])

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.inverses[start] + (end - start).astype(np.uint64))


def window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, by running minima of blocks from both sides."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    padded = padded.reshape(blocks, width)
    right = np.minimum.accumulate(padded, axis=1).ravel()
    left = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(left[:n], right[width - 1 : width - 1 + n])


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of bytes for hashing, each some texts or some windows of a long text."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE, "right")) - 1)
        if hi == lo + 1:
            a, b = int(offsets[lo]), int(offsets[hi])
            while b - a > PIECE + LENGTH:
                yield a, a + PIECE
                a += PIECE - LENGTH + 1
            yield a, b
        else:
            yield int(offsets[lo]), int(offsets[hi])
        lo = hi


def _edge(grams: np.ndarray, least: np.ndarray, window: np.ndarray, way: int) -> np.ndarray:
    """The first (way 1) or last (way -1) place of the trigger in a window."""
    width = LENGTH - GRAM + 1
    out = np.empty(len(window), np.int64)
    reach = np.arange(width)[::way]
    for lo in range(0, len(window), 4096):
        part = slice(lo, lo + 4096)
        out[part] = window[part] + reach[(grams[window[part, None] + reach] == least[part, None]).argmax(axis=1)]
    return out


def parse(data: np.ndarray, offsets: np.ndarray, hasher: RollingHash) -> tuple[np.ndarray, ...]:
    """Of each phrase: trigger, hash, text, first and last window within the text, and if the trigger is in it twice."""
    out: list[tuple[np.ndarray, ...]] = []
    for a, b in _pieces(offsets):
        if b - a < LENGTH:
            continue
        sums = hasher.sums(data[a:b])
        grams = hasher.every(sums, GRAM)
        least = window_minima(grams, LENGTH - GRAM + 1)
        at = np.arange(a, a + len(least))
        text = np.searchsorted(offsets, at, "right") - 1
        whole = at + LENGTH <= offsets[text + 1]
        first = np.empty(len(least), dtype=bool)
        first[0] = True
        first[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(first & whole)
        stop = np.empty(len(least), dtype=bool)
        stop[-1] = True
        stop[:-1] = first[1:] | ~whole[1:]
        end = np.flatnonzero(stop & whole)
        if len(begin):
            least = least[begin]
            inner = _edge(grams, least, begin, 1) != _edge(grams, least, end, -1)
            out.append((least, hasher.ranges(sums, begin, end + LENGTH), text[begin], begin + a - offsets[text[begin]], end + a - offsets[text[begin]], inner))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, bool))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phrases; those without a trigger are known to be repeated, and one of each of them also has its trigger."""
    hasher = RollingHash()
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        h, c, text, s, e, inner = parse(data, offsets, hasher)
        order = np.argsort(c, kind="stable")
        same = np.empty(len(c), dtype=bool)
        same[:1] = False
        same[1:] = (c[order][1:] == c[order][:-1]) & (h[order][1:] == h[order][:-1])
        again = np.zeros(len(c), dtype=bool)
        again[order] = same
        twice = np.zeros(len(c), dtype=bool)
        twice[order[:-1]] = same[1:]
        twice |= again
        ids = batch.column(0).take(pa.array(text))
        trigger = pa.array(h.view(np.int64), mask=again)
        yield pa.RecordBatch.from_arrays([trigger, pa.array(c.view(np.int64)), pa.array(twice), pa.array(inner), ids, pa.array(s), pa.array(e)], ["h", "c", "twice", "inner", "id", "s", "e"])


def phrase_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the phrases (h, twice, s, e) listed for each text."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        lists = batch.column(2)
        items, owner = lists.flatten(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        s, e = items.field("s").to_numpy(), items.field("e").to_numpy()
        at = offsets[owner] + s
        for lo in range(0, len(s), 20_000):
            part = slice(lo, lo + 20_000)
            text = [data[x:y].tobytes() for x, y in zip(at[part], at[part] + e[part] - s[part] + LENGTH, strict=True)]
            pick = pa.array(np.arange(lo, min(len(s), lo + 20_000)))
            yield pa.RecordBatch.from_arrays([items.field("h").take(pick), items.field("twice").take(pick), batch.column(0).take(pa.array(owner[part])), pa.array(s[part]), pa.array(text, pa.binary())], ["h", "twice", "id", "s", "phrase"])


def suffix_ranks(data: np.ndarray) -> np.ndarray:
    """Of each position with ``LENGTH`` bytes from it, the rank of those bytes among all; equal bytes have equal ranks.

    Prefix doubling: ranks of 8 bytes, then of 16 to 128, last of 200 from two overlapping 128.
    """
    n = len(data)
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key[: n - j] |= data[j:].astype(np.uint64) << _U(56 - 8 * j)
    depth = 8
    while True:
        order = np.argsort(key)
        ordered = key[order]
        step = np.empty(n, np.uint64)
        step[:1] = 0
        np.cumsum(ordered[1:] != ordered[:-1], out=step[1:])
        rank = np.empty(n, np.uint64)
        rank[order] = step
        if depth == LENGTH:
            return rank[: n - LENGTH + 1]
        further = depth if depth < 128 else LENGTH - 128
        key = rank << _U(32)
        key[: n - further] |= rank[further:]
        depth = depth * 2 if depth < 128 else LENGTH


def _settle(phrases: list[bytes], twice: np.ndarray, ids: pa.Array, s: np.ndarray) -> pa.RecordBatch:
    """Runs of repeated windows of phrases that are not known to be repeated as a whole."""
    data = np.frombuffer(b"".join(phrases), np.uint8)
    ends = np.cumsum([len(x) for x in phrases])
    starts = ends - np.array([len(x) for x in phrases])
    rank = suffix_ranks(data)
    at = np.arange(len(rank))
    owner = np.searchsorted(ends, at, "right")
    whole = at + LENGTH <= ends[owner]
    rank, at, owner = rank[whole].astype(np.int64), at[whole], owner[whole]
    known = twice.astype(bool)[owner]
    count = np.bincount(rank, weights=1 + known)
    hit = (count[rank] > 1) & ~known
    first, last = hit.copy(), hit.copy()
    first[1:] &= ~(hit[:-1] & (owner[1:] == owner[:-1]))
    last[:-1] &= ~(hit[1:] & (owner[1:] == owner[:-1]))
    begin, end = np.flatnonzero(first), np.flatnonzero(last)
    own = owner[begin]
    return pa.RecordBatch.from_arrays([ids.take(pa.array(own)), pa.array(s[own] + at[begin] - starts[own]), pa.array(s[own] + at[end] - starts[own])], ["id", "s", "e"])


def order_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input is sorted by trigger; whole groups of triggers are gathered and their suffixes ordered."""
    held: list[pa.RecordBatch] = []

    def settle(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        return _settle(t["phrase"].to_pylist(), t["twice"].to_numpy(), t["id"].combine_chunks(), t["s"].to_numpy())

    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column(0).to_numpy()
        length = np.cumsum(np.diff(batch.column(4).offsets if hasattr(batch.column(4), "offsets") else np.frombuffer(batch.column(4).buffers()[1], np.int32)[batch.column(4).offset : batch.column(4).offset + batch.num_rows + 1]))
        new = np.flatnonzero(np.concatenate([[not held or held[-1].column(0)[-1].as_py() != h[0]], h[1:] != h[:-1]]))
        at = before = 0
        for k in new:
            if size + (length[k - 1] if k else 0) - before >= GROUP and (held or k > at):
                yield settle([*held, batch.slice(at, k - at)])
                held, size, at, before = [], 0, k, length[k - 1] if k else 0
        held.append(batch.slice(at))
        size += int(length[-1] - before)
    if held:
        yield settle(held)


def window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two fingerprints of each window of a phrase."""
    one, two = RollingHash(31), RollingHash(41)
    for batch in batches:
        for i in range(batch.num_rows):
            data = np.frombuffer(batch.column(4)[i].as_buffer(), np.uint8)
            x, y = (r.every(r.sums(data), LENGTH).view(np.int64) for r in (one, two))
            n = len(x)
            pick = pa.array(np.full(n, i))
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), batch.column(1).take(pick), batch.column(2).take(pick), pa.array(batch.column(3)[i].as_py() + np.arange(n))], ["x", "y", "twice", "id", "s"])


def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What stays of each text once the windows listed for it are removed."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        removed, spans, digest, kept = [], [], [], []
        for i, runs in enumerate(batch.column(2).to_pylist()):
            text = data[offsets[i] : offsets[i + 1]]
            merged: list[list[int]] = []
            for a, b in sorted((r["s"], r["e"] + LENGTH) for r in runs or ()):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            rest, at = [], 0
            for a, b in merged:
                rest.append(text[at:a].tobytes())
                at = b
            rest.append(text[at:].tobytes())
            kept.append(b"".join(rest))
            removed.append(len(text) - len(kept[-1]))
            spans.append(len(merged))
            digest.append(hashlib.sha256(kept[-1]).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(3), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.binary())], ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, kept_bytes (the text that stays, perhaps cut within a character)."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "repeats")
    texts = docs.select(row_key(docs, id_col, text_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("doc"))

    phrases = scratch.write(texts.select("id", "text").mapInArrow(parse_batches, "h long, c long, twice boolean, inner boolean, id long, s long, e long"), "phrases")
    same, shared = Window.partitionBy("h", "c"), Window.partitionBy("h")
    known = (
        phrases.where("h is not null")
        .withColumn("first", F.row_number().over(same.orderBy("id", "s")) == 1)
        .withColumn("twice", F.max("twice").over(same) | (F.count("*").over(same) > 1))
        .withColumn("mixed", (F.min("c").over(shared) != F.max("c").over(shared)) | F.max("inner").over(shared))
        .where("twice or mixed")
        .withColumn("bytes", F.when(F.col("mixed"), F.sum(F.when(F.col("first"), F.col("e") - F.col("s") + LENGTH)).over(shared)))
    )
    known = scratch.write(known, "known")
    whole = phrases.where("h is null").select("id", "s", "e").unionByName(known.where("twice").select("id", "s", "e"))

    wanted = known.where("mixed and first").select("id", F.struct("h", "twice", "s", "e", (F.col("bytes") > HOT).alias("hot")).alias("p"))

    def bytes_of(which: str) -> DataFrame:
        lists = wanted.where(which).groupBy("id").agg(F.collect_list("p").alias("p"))
        return texts.join(lists, "id").select("id", "text", "p").mapInArrow(phrase_batches, "h long, twice boolean, id long, s long, phrase binary")

    ordered = bytes_of("not p.hot").repartition("h").sortWithinPartitions("h").mapInArrow(order_batches, "id long, s long, e long")
    found = [whole, scratch.write(ordered, "ordered")]
    if not wanted.where("p.hot").isEmpty():
        windows = scratch.write(bytes_of("p.hot").mapInArrow(window_batches, "x long, y long, twice boolean, id long, s long"), "windows")
        often = windows.groupBy("x", "y").agg(F.count("*").alias("n"), F.max("twice").alias("any")).where("n > 1 or any").select("x", "y")
        found.append(windows.where("not twice").join(often, ["x", "y"]).select("id", "s", F.col("s").alias("e")))
    runs = found[0]
    for x in found[1:]:
        runs = runs.unionByName(x)
    lists = runs.groupBy("id").agg(F.collect_list(F.struct("s", "e")).alias("runs"))
    cut = texts.join(lists, "id", "left").select("id", "text", "runs", "doc")
    kind = docs.schema[id_col].dataType.simpleString()
    return cut.mapInArrow(cut_batches, f"doc {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary").withColumnRenamed("doc", id_col)
