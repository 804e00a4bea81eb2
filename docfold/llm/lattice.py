"""Language-model scores from a lattice of subwords.

The pieces are those of an existing byte-level vocabulary; none is trained.  No vocabulary at hand carries unigram
scores, so each piece's score is its share among the pieces of the training texts as the vocabulary's own tokenizer cuts
them, smoothed by 0.1.  A word with the blank before it is scored by all its segmentations into pieces: the forward
recursion in log space over its bytes.  As no piece spans two words, the probability of a text is the product over its
words and its end, which is one more piece.

Beside it stands the base: log10 of smoothed word frequencies.  Counts of all training words stay distributed.  Of the
most frequent words those are sent to executors whose count lies in the highest bins, sixteen to a doubling, that hold at most
``FREQUENT`` words together; a bin that does not fit is left out whole.  Occurrences of all other words are joined with
their counts, pre-aggregated per document.  The vocabulary is read on the driver and sent along.

Definitions.  A null or empty text has one token, its end.  A text of any length is scored whole.  Rows that repeat an id
are scored one by one and alike; a row without id is trained on.  An empty table gives an empty result.  Pieces of every
length are in the lattice; the longest cost only the words that are as long.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm.columns import id_hash, row_key
from docfold.llm.words import WordHasher, _table, lower_table, slices, text_bytes
from docfold.scratch import Scratch

#: Where the vocabulary lies: a file of base64 pieces with ranks, one a line.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
FREQUENT, SMOOTH = 150_000, 0.1
#: Words scored at once; bytes of text worked on at once; bytes of a word up to which words of one length are scored together.
BLOCK, SLICE, SHORT = 1 << 14, 1 << 23, 64


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def tokenizer(ranks: dict[bytes, int]):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Lattice:
    """Forward recursion over the bytes of words; ``scores`` are log10 probabilities by rank of the piece."""

    def __init__(self, ranks: dict[bytes, int], scores: np.ndarray):
        usable = [(p, scores[r]) for p, r in ranks.items()]
        self.longest = max(len(p) for p, _ in usable)
        self.values = _table(51, 256)
        base = int(_table(52, 1)[0]) | 1
        self.powers = np.full(self.longest, base, np.uint64)
        self.powers[0] = 1
        self.powers = np.multiply.accumulate(self.powers)
        keys = np.array([int((self.values[np.frombuffer(p, np.uint8)] * self.powers[: len(p)]).sum(dtype=np.uint64)) for p, _ in usable], np.uint64)
        order = np.argsort(keys)
        self.keys, self.scores = keys[order], np.array([s for _, s in usable])[order]
        self.lengths = sorted({len(p) for p, _ in usable})
        self.maybe = np.zeros(1 << 22, dtype=bool)
        self.maybe[self.keys >> np.uint64(42)] = True

    def _piece_scores(self, key: np.ndarray) -> np.ndarray:
        out = np.full(key.shape, -np.inf)
        hit = np.nonzero(self.maybe[key >> np.uint64(42)])
        at = np.searchsorted(self.keys, key[hit])
        at[at == len(self.keys)] = 0
        out[hit] = np.where(self.keys[at] == key[hit], self.scores[at], -np.inf)
        return out

    def score(self, words: np.ndarray) -> np.ndarray:
        """log10 probability of words of one length, given as rows of bytes."""
        m, n = words.shape
        alpha = np.full((m, n + 1), -np.inf)
        alpha[:, 0] = 0
        values = self.values[words]
        for j in range(1, n + 1):
            paths = []
            for length in self.lengths:
                if length > j:
                    break
                i = j - length
                key = (values[:, i:j] * self.powers[:length]).sum(axis=1, dtype=np.uint64)
                paths.append(alpha[:, i] + self._piece_scores(key))
            paths = np.stack(paths)
            top = paths.max(axis=0)
            alpha[:, j] = top + np.log10((10.0 ** (paths - top)).sum(axis=0))
        return alpha[:, n]

    def score_long(self, word: np.ndarray) -> float:
        """The same of one word of any length: pieces are looked up for many places at once, and only those found are walked over.

        Probabilities of the last places are held as numbers and scaled up together, so that they do not vanish.
        """
        n, scaled = len(word), 0.0
        values = self.values[word]
        recent = {0: 1.0}
        for lo in range(0, n, 1 << 16):
            hi = min(n, lo + (1 << 16))
            key, ends, sizes, scores = np.zeros(hi - lo, np.uint64), [], [], []
            for length in range(1, self.longest + 1):
                key = key[: max(0, min(hi, n - length + 1) - lo)]
                key = key + values[lo + length - 1 : lo + length - 1 + len(key)] * self.powers[length - 1]
                if length in self.lengths:
                    found = self._piece_scores(key)
                    at = np.flatnonzero(found > -np.inf)
                    ends.append(lo + at)
                    sizes.append(np.full(len(at), length))
                    scores.append(found[at])
            begin = np.concatenate(ends)
            by = np.argsort(begin, kind="stable")
            steps = zip(begin[by].tolist(), np.concatenate(sizes)[by].tolist(), (10.0 ** np.concatenate(scores)[by]).tolist(), strict=True)
            last = -1
            for i, length, p in steps:
                if i != last:
                    last = i
                    if i % 8 == 0:
                        recent = {j: v for j, v in recent.items() if j >= i}
                        if 0 < (top := max(recent.values(), default=0.0)) < 1e-50:
                            recent = {j: v / top for j, v in recent.items()}
                            scaled += np.log10(top)
                if v := recent.get(i):
                    recent[i + length] = recent.get(i + length, 0.0) + v * p
        return float(np.log10(recent[n]) + scaled) if recent.get(n) else -np.inf

    def score_words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of words at the given places of lower-cased bytes, each with a blank before it."""
        out = np.empty(len(start))
        length = end - start
        for n in np.unique(length):
            at = np.flatnonzero(length == n)
            if n >= SHORT:
                for i in at:
                    out[i] = self.score_long(np.concatenate([np.array([32], np.uint8), data[start[i] : end[i]]]))
                continue
            step = max(1, min(BLOCK, (1 << 22) // int(n)))
            for lo in range(0, len(at), step):
                part = at[lo : lo + step]
                rows = np.empty((len(part), n + 1), np.uint8)
                rows[:, 0] = 32
                rows[:, 1:] = data[start[part, None] + np.arange(n)]
                out[part] = self.score(rows)
        return out


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct hash in its sorted order, and where each hash is in that order."""
    _, first, back = np.unique(h, return_index=True, return_inverse=True)
    return first, back


def count_batches(ranks: dict[bytes, int]):
    """Rows (kind, key, n): kind 0 counts words by hash, 1 pieces by rank, 2 training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, lower = WordHasher(), lower_table()
        pieces, size = tokenizer(ranks), max(ranks.values()) + 1
        inner = re.compile(r"\s")

        def cut(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
            """Pieces of words by rank.  The tokenizer cuts at the blank before a word, so words can be cut in one text, if no white space of Unicode is in them."""
            words = [lower[data[a:b]].tobytes().decode("utf-8", "replace") for a, b in zip(start, end, strict=True)]
            ids = pieces.encode_ordinary("".join(" " + w for w in words if not inner.search(w)))
            for w in words:
                if inner.search(w):
                    ids += pieces.encode_ordinary(" " + w)
            return np.bincount(np.array(ids, np.int64), minlength=size)

        for batch in (part for whole in batches for part in slices(whole, 0, SLICE)):
            data, offsets = text_bytes(batch.column(0))
            h, s, e, _ = hasher.hashes(data, offsets)
            first, back = _distinct(h)
            n = np.bincount(back, minlength=len(first))
            total = np.zeros(size, np.int64)
            order = np.argsort(n, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(n[order])) + 1):
                for lo in range(0, len(group), 50_000):
                    total += n[group[0]] * cut(data, s[first[group[lo : lo + 50_000]]], e[first[group[lo : lo + 50_000]]]) if len(group) else 0
            found = np.flatnonzero(total)
            kinds = np.repeat(np.array([0, 1, 2]), [len(first), len(found), 1])
            keys = np.concatenate([h[first].view(np.int64), found, [0]])
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(keys, pa.int64()), pa.array(np.concatenate([n, total[found], [batch.num_rows]]), pa.int64())], ["kind", "key", "n"])

    return run


def score_batches(ranks: dict[bytes, int], scores: np.ndarray, end_score: float, keys: np.ndarray, terms: np.ndarray):
    """A row for each text (word null) with sums over its frequent words and its whole score, and one for each other word in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, lower, lattice = WordHasher(), lower_table(), None
        for batch in (part for whole in batches for part in slices(whole, 1, SLICE)):
            lattice = lattice or Lattice(ranks, scores)
            data, offsets = text_bytes(batch.column(1))
            h, s, e, bounds = hasher.hashes(data, offsets)
            rows = batch.num_rows
            owner = np.repeat(np.arange(rows), np.diff(bounds))
            first, back = _distinct(h)
            marginal = lattice.score_words(lower[data], s[first], e[first])
            word = h[first]
            at = np.searchsorted(keys, word)
            at[at == len(keys)] = 0
            known = keys[at] == word if len(keys) else np.zeros(len(word), dtype=bool)
            term = np.where(known, terms[at], 0.0) if len(keys) else np.zeros(len(word))
            total = lambda x: np.bincount(owner, weights=x, minlength=rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.nulls(rows, pa.int64()), pa.array(np.diff(bounds) + 1), pa.array(total(known[back]).astype(np.int64)), pa.array(total(term[back])), pa.array(total(marginal[back]) + end_score)],
                ["id", "word", "n", "known", "base", "score"],
            )
            rest = ~known[back]
            pair, n = np.unique(owner[rest] * np.int64(len(first) + 1) + back[rest], return_counts=True)
            who, what = pair // (len(first) + 1), pair % (len(first) + 1)
            nothing = pa.nulls(len(pair), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(who)), pa.array(word[what].view(np.int64)), pa.array(n), pa.nulls(len(pair), pa.int64()), nothing, nothing], ["id", "word", "n", "known", "base", "score"])

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, fold: int = 0, vocabulary: str = VOCABULARY) -> DataFrame:
    """Learn without one fold of ids, then score every row."""
    scratch = Scratch(docs.sparkSession, "lattice")
    out = F.coalesce(id_hash(id_col, folds) == fold, F.lit(False))
    text = F.col(text_col).cast("string")
    ranks = load_ranks(vocabulary)
    rows = docs.where(~out).select(text.alias("text")).mapInArrow(count_batches(ranks), "kind int, key long, n long")
    counts = scratch.write(rows.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    words = counts.where("kind = 0").select(F.col("key").alias("word"), F.col("n").alias("c"), F.floor(16 * F.log2("n")).alias("bin"))

    pieces = counts.where("kind = 1").toPandas()  # one row a piece of the vocabulary at most
    texts = int(counts.where("kind = 2").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    seen = np.zeros(max(ranks.values()) + 1)
    seen[pieces["key"].to_numpy(np.int64)] = pieces["n"].to_numpy(float)
    scores = np.log10((seen + SMOOTH) / (seen.sum() + texts + SMOOTH * (len(ranks) + 1)))
    end_score = float(np.log10((texts + SMOOTH) / (seen.sum() + texts + SMOOTH * (len(ranks) + 1))))

    size = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens, distinct = int(size[0]) + texts, int(size[1]) + (texts > 0)
    below = tokens + SMOOTH * (distinct + 1)
    term = lambda c: np.log10((c + SMOOTH) / below)
    least, held = 16 * 64, 0  # bins of counts are few, whatever the corpus
    for r in words.groupBy("bin").count().orderBy(F.col("bin").desc()).collect():
        if (held := held + r["count"]) > FREQUENT:
            break
        least = r["bin"]
    frequent = words.where(F.col("bin") >= least).toPandas()
    keys = frequent["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    terms = term(frequent["c"].to_numpy(float)[order])

    key = row_key(docs, id_col, text_col)
    keyed = docs.select(key.alias("id"), text.alias("text"))
    scored = scratch.write(keyed.mapInArrow(score_batches(ranks, scores, end_score, keys[order], terms), "id long, word long, n long, known long, base double, score double"), "scored")
    rare = scored.where("word is not null").select("id", "word", "n").join(words.where(F.col("bin") < least), "word", "left")
    rare = rare.groupBy("id").agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known2"), F.sum(F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + SMOOTH) / below)).alias("base2"))
    texts_ = scored.where("word is null").dropDuplicates(["id"]).join(rare, "id", "left")
    end_known = int(texts > 0)
    result = texts_.select(
        F.col("id").alias("row_id"),
        F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("known2", F.lit(0)) + end_known).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0)) + float(term(texts))).alias("base_score"),
        "score",
    )
    ids = docs.select(F.col(id_col), out.alias("held_out"), key.alias("row_id"))
    return ids.join(result, "row_id").select(id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
