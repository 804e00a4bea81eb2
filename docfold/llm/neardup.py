"""Near-duplicate detection by a chosen-path set similarity join.

Method.  A document is the set of its distinct word shingles.  Documents of one set are one class, found by a strong
hash; only one of a class goes on.  Each set is embedded by minwise hashing into ``COORDINATES`` tokens (coordinate,
smallest hash).  A node of a tree holds the sets that share a path of such tokens.  ``TREES`` independent trees start
with a path of two tokens each, as nodes of one token are never small.  Small nodes are compared exhaustively.  A larger
node is branched: every coordinate is chosen by a hash of the node with a probability that makes ``BRANCHES`` children of a
set in the mean, so that a pair at the threshold is expected to share more than one of them.

Comparing without all pairs of a group.  A node is dealt into blocks of about ``BLOCK`` sets and ``WEIGHT`` shingles.  In
a block the sets are compared by their sketches of all coordinates; a set that comes near the threshold with one of
another component brings its full set into the block, where links are confirmed, and the block gives only what joins its
components, fewer rows than it has sets.  So nothing is capped, no connection between different texts is lost, and a group of n
near copies, linked or just not, makes rows in proportion to n.  ``HOOKS`` trees come first, large nodes in random blocks;
their links are contracted, and nodes of one component are done.  Sketches and texts are joined by a merge at every size.  Then all nodes follow: small are those of one block,
or with at most ``LEAF`` blocks outside their main component, which are held against all blocks.  A pair is compared in the first
tree that has both in one small node.  A node that stays large after ``LEVELS`` branchings is treated as small ones are.

Recall.  A pair at 0.85 shares no first node with a probability of 1e-9, one at 0.80 with 8e-8; in nodes branched four times
about 1e-4 of pairs at 0.80 are missed, unless their group links them otherwise.  ``SLACK`` standard deviations below the
threshold a sketch misses a pair at 0.85 with a probability of 2.8e-6, one at 0.80 with 1.4e-6.

Definitions.  Rows of one id are one document, that of its smallest set hash.  A null or empty text, or one without
words, has an empty set and is linked with nothing.  A text with fewer words than a shingle has one shingle, all of its
words.  A row without id is linked with nothing and kept.  Only the id and the text are read, so other columns may have
any names.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm.columns import fresh, row_key
from docfold.llm.components import components
from docfold.llm.words import WordHasher, _table, mix, shingle_sets, slices, text_bytes
from docfold.scratch import Scratch

TREES, HOOKS, COORDINATES, LEVELS, BRANCHES, SLACK = 16, 2, 128, 4, 2.0, 5.0
BLOCK, WEIGHT, LEAF = 512, 1 << 21, 4
SHINGLE, THRESHOLD = 5, 80

#: A sketch keeps 32 bits of the tokens that trees start with and 16 of the others.
ROOTS = 2 * TREES
SKETCH = 4 * ROOTS + 2 * (COORDINATES - ROOTS)
_SKETCHED = "row long, id long, n long, k1 long, k2 long, roots array<long>, sketch binary"


def _smallest(x: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The smallest of each permuted 32-bit hash; blocks keep the table small."""
    out = np.full(len(seeds), 2**32 - 1, np.uint32)
    folded = (x >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(folded), 4096):
        np.minimum(out, (folded[None, at : at + 4096] * seeds[:, None]).min(axis=1), out=out)
    return out


def _strong(x: np.ndarray) -> np.ndarray:
    """128 bits that tell sets apart."""
    return np.frombuffer(hashlib.blake2b(x.tobytes(), digest_size=16).digest(), np.int64)


def _tokens(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The tokens of sketches, a row each."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)
    first, others = np.ascontiguousarray(raw[:, : 4 * ROOTS]), np.ascontiguousarray(raw[:, 4 * ROOTS :])
    return np.hstack([first.view(np.uint32), others.view(np.uint16).astype(np.uint32)])


def _children(node: np.ndarray, tokens: np.ndarray, branches: float):
    """(row, child) of all chosen coordinates: choice depends on the node and the coordinate, the child on its token too."""
    place = _table(303, tokens.shape[1])
    drawn = mix(node[:, None] ^ place[None, :])
    row, c = np.nonzero(drawn < np.uint64(int(branches / tokens.shape[1] * 2**64)))
    return row, mix(drawn[row, c] * np.uint64(0x9E3779B97F4A7C15) + tokens[row, c].astype(np.uint64))


def sketch_batches(k: int):
    """Of (row, id, text): the set with its size, strong hash, first nodes and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seeds = WordHasher(), (_table(202, COORDINATES) | np.uint64(1)).astype(np.uint32)
        tree = _table(404, TREES)
        for batch in (part for whole in batches for part in slices(whole, 2)):
            data, offsets = text_bytes(batch.column(2))
            h, _, _, first = hasher.hashes(data, offsets)
            n, keys, roots, sketches = [], [], [], []
            for x in shingle_sets(h, first, k):
                n.append(len(x))
                keys.append(_strong(x))
                s = _smallest(x, seeds)
                roots.append(mix((s[:TREES].astype(np.uint64) << np.uint64(32) | s[TREES:ROOTS]) ^ tree).view(np.int64) if len(x) else np.zeros(0, np.int64))
                sketches.append(s[:ROOTS].tobytes() + s[ROOTS:].astype(np.uint16).tobytes())
            keys = np.array(keys, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(roots, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["row", "id", "n", "k1", "k2", "roots", "sketch"],
            )

    return run


def item_batches(k: int):
    """Of (row, k1, k2, text): the full set of a text, if it is the one with that strong hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in (part for whole in batches for part in slices(whole, 3)):
            data, offsets = text_bytes(batch.column(3))
            h, _, _, first = hasher.hashes(data, offsets)
            keys = np.stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()], axis=1)
            items = [x.tobytes() if (_strong(x) == key).all() else None for x, key in zip(shingle_sets(h, first, k), keys, strict=True)]
            out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(items, pa.binary())], ["row", "items"])
            yield out.filter(out.column(1).is_valid())

    return run


def branch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            row, child = _children(part.column(0).to_numpy().view(np.uint64), _tokens(part.column(5)), BRANCHES)
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), *(part.column(i).take(pa.array(row)) for i in (1, 2, 3, 4))], ["node", "row", "id", "n", "c"])


#: Roles of the rows of a block: compared with all, asked about, or held against those that ask.
BOTH, ASKS, HELD = 0, 1, 2
_LAID = ["node", "part", "role", "row", "n", "c", "tree", "mask"]


def _sides(role: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.flatnonzero(role != HELD), np.flatnonzero(role != ASKS)


def _near(t: pa.Table, least: int, threshold: int) -> pa.Table:
    """Those rows of one block that come near the threshold with a row of another component, by their sketches."""
    role, n, c, tree, mask = (t.column(x).to_numpy() for x in ("role", "n", "c", "tree", "mask"))
    tokens, hit = _tokens(t.column("sketch")), np.zeros(len(t), dtype=bool)
    asks, held = _sides(role)
    for lo in range(0, len(asks), 64):
        x = asks[lo : lo + 64]
        y = held[np.searchsorted(held, x[0] + 1) :] if len(asks) == len(held) == len(t) else held
        fit = (c[x, None] != c[None, y]) & (100 * np.minimum(n[x, None], n[None, y]) >= threshold * np.maximum(n[x, None], n[None, y]))
        y = y[some := np.flatnonzero(fit.any(axis=0))]
        i, j = np.nonzero(fit[:, some] & (np.count_nonzero(tokens[x, None] == tokens[None, y], axis=2) >= least))
        a, b = x[i], y[j]
        if tree[0] < TREES:
            met = (tokens[a, :TREES] == tokens[b, :TREES]) & (tokens[a, TREES:ROOTS] == tokens[b, TREES:ROOTS])
            both = (mask[a] & mask[b])[:, None] >> np.arange(TREES) & 1
            new = ~(met & (both == 1) & (np.arange(TREES) < tree[0])).any(axis=1)  # not in a small node of an earlier tree
            a, b = a[new], b[new]
        hit[a] = hit[b] = True
    return t.select(["node", "part", "role", "row", "c"]).filter(pa.array(hit))


def _shared_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of x with all of y."""
    left, right = np.concatenate(x), np.concatenate(y)
    values = np.intersect1d(left, right)
    out = np.zeros((len(x), len(y)), np.float32)
    row_x, row_y = np.repeat(np.arange(len(x)), [len(s) for s in x]), np.repeat(np.arange(len(y)), [len(s) for s in y])
    at_x, at_y = np.searchsorted(values, left), np.searchsorted(values, right)
    if not len(values):
        return out
    at_x[values[np.minimum(at_x, len(values) - 1)] != left] = -1
    at_y[values[np.minimum(at_y, len(values) - 1)] != right] = -1
    for lo in range(0, len(values), 2048):
        wide = min(2048, len(values) - lo)
        m, k = np.zeros((len(x), wide), np.float32), np.zeros((len(y), wide), np.float32)
        for table, row, at in ((m, row_x, at_x), (k, row_y, at_y)):
            inside = (at >= lo) & (at < lo + wide)
            table[row[inside], at[inside] - lo] = 1
        out += m @ k.T
    return out


def _joined(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """The smallest number that each of ``size`` numbers reaches over the links (a, b)."""
    label = np.arange(size)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(t: pa.Table, threshold: int) -> pa.Table:
    """Of one block: each component that links join to a smaller one, with the smallest that it reaches."""
    role, c = t.column("role").to_numpy(), t.column("c").to_numpy()
    items = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("items")]
    sizes = np.array([len(x) for x in items])
    asks, held = _sides(role)
    names, at = np.unique(c, return_inverse=True)
    found: list[tuple] = []
    for lo in range(0, len(asks), 128 if len(held) else len(asks) + 1):
        x = asks[lo : lo + 128]
        both = _shared_counts([items[i] for i in x], [items[i] for i in held])
        i, j = np.nonzero((100 * both >= threshold * (sizes[x, None] + sizes[None, held] - both)) & (c[x, None] != c[None, held]))
        found.append((at[x[i]], at[held[j]]))
    if not found:
        return pa.table({"u": names[:0], "v": names[:0]})
    label = _joined(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), len(names))
    moved = np.flatnonzero(label != np.arange(len(names)))
    return pa.table({"u": names[moved], "v": names[label[moved]]})


def by_block(settle):
    """``settle`` of each block; input is sorted by (node, part), and a block is gathered whole, as it has a bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        last = None

        def settled() -> Iterator[pa.RecordBatch]:
            if parts:
                yield from settle(pa.concat_tables(parts).combine_chunks()).to_batches()
                parts.clear()

        for batch in batches:
            node, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cut = [0, *(np.flatnonzero((node[1:] != node[:-1]) | (part[1:] != part[:-1])) + 1).tolist(), batch.num_rows]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if a < b:
                    if (node[a], part[a]) != last:
                        yield from settled()
                        last = (node[a], part[a])
                    parts.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        yield from settled()

    return run


def _dealt(df: DataFrame) -> DataFrame:
    return df.repartition("node", "part").sortWithinPartitions("node", "part")


class ChosenPathJoin:
    """One run of the join; tables that later steps read are written to the shared folder."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, threshold: int):
        self.spark, self.k, self.threshold = docs.sparkSession, k, threshold
        self.scratch = Scratch(self.spark, "neardup")
        self.docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def shared(self, rows: DataFrame) -> DataFrame:
        """Rows of nodes of several components: main, the largest component, and of how many blocks are node and rest, the sets outside main."""
        parts = rows.groupBy("node", "c").agg(F.count("*").alias("m"), F.sum("n").alias("w")).groupBy("node")
        known = parts.agg(F.max(F.struct("m", "w", "c")).alias("main"), F.sum("m").alias("m"), F.sum("w").alias("w"), F.count("*").alias("parts")).where("parts > 1")
        blocks = lambda m, w: F.ceil(F.greatest(m / F.lit(float(BLOCK)), w / F.lit(float(WEIGHT))))
        sized = known.select("node", F.col("main.c").alias("main"), blocks(F.col("m"), F.col("w")).alias("blocks"), blocks(F.col("m") - F.col("main.m"), F.col("w") - F.col("main.w")).alias("asking"))
        return rows.join(sized, "node")

    def near(self, laid: DataFrame) -> DataFrame:
        """Those rows of the blocks ``laid`` whose full sets are to be compared."""
        s, threshold = self.threshold / 100, self.threshold
        least = max(1, math.ceil(COORDINATES * s - SLACK * (COORDINATES * s * (1 - s)) ** 0.5))
        rough = _dealt(laid.select(_LAID).join(self.sets.select("row", "sketch").hint("merge"), "row").select(*_LAID, "sketch"))
        return self.scratch.write(rough.mapInArrow(by_block(lambda t: _near(t, least, threshold)), "node long, part long, role int, row long, c long"), "near")

    def links(self, near: list[DataFrame]) -> DataFrame:
        """Pairs (u, v) of components that links join.  Full sets are made again for the rows in question only."""
        threshold = self.threshold
        rows = reduce(DataFrame.unionByName, near)
        asked = self.scratch.write(rows.select("row").distinct().join(self.classes.select("row", "id", "k1", "k2"), "row"), "asked")
        items = self.docs.join(asked.hint("merge"), "id").select("row", "k1", "k2", "text").mapInArrow(item_batches(self.k), "row long, items binary").dropDuplicates(["row"])
        full = _dealt(rows.join(items.hint("merge"), "row").select("node", "part", "role", "c", "items"))
        out = self.scratch.write(full.mapInArrow(by_block(lambda t: _links(t, threshold)), "u long, v long"), "links")
        self.scratch.drop(asked, *near)
        return out

    def hooks(self, rows: DataFrame) -> DataFrame:
        """All nodes of the first trees, dealt into random blocks."""
        block = F.pmod(F.xxhash64("id"), F.col("blocks")).alias("part")
        return self.shared(rows.where(F.col("tree") < HOOKS)).select("node", block, F.lit(BOTH).alias("role"), "row", "n", "c", F.lit(TREES).alias("tree"), F.lit(0).cast("long").alias("mask"))

    def laid(self, rows: DataFrame) -> DataFrame:
        """Blocks of small nodes: whole, or what is outside the main component against all."""
        whole = rows.where("blocks = 1").select("node", F.lit(0).cast("long").alias("part"), F.lit(BOTH).alias("role"), "row", "n", "c", "tree", "mask")
        wide = rows.where("blocks > 1")
        mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
        each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        part = (F.col("r") * (1 << 24) + F.col("j")).alias("part")
        held = wide.select("node", each("asking").alias("r"), mine("blocks").alias("j"), F.lit(HELD).alias("role"), "row", "n", "c", "tree", "mask")
        asks = wide.where("c <> main").select("node", mine("asking").alias("r"), each("blocks").alias("j"), F.lit(ASKS).alias("role"), "row", "n", "c", "tree", "mask")
        return whole.unionByName(held.unionByName(asks).select("node", part, "role", "row", "n", "c", "tree", "mask"))

    def all_nodes(self, rows: DataFrame) -> DataFrame:
        """Pairs (u, v) of components that links join, of all nodes; larger nodes are branched."""
        near = []
        for level in range(LEVELS + 1):
            rows = self.scratch.write(self.shared(rows), f"level{level}")
            small = F.lit(True) if level == LEVELS else F.col("asking") <= LEAF
            if level == 0:  # the trees whose first node is small, by set
                masks = self.scratch.write(rows.where(small).groupBy("row").agg(F.bit_or(F.expr("shiftleft(1L, tree)")).alias("mask")), "masks")
                seen = rows.where(small).join(masks, "row")
            else:
                seen = rows.where(small).withColumn("mask", F.lit(0).cast("long"))
            near.append(self.near(self.laid(seen)))
            large = rows.where(~small).select("node", "row", "id", "n", "c")
            if level == LEVELS or large.isEmpty():
                self.scratch.drop(rows, masks)
                break
            large = large.join(self.sets.select("row", "sketch"), "row").select("node", "row", "id", "n", "c", "sketch")
            branched = self.scratch.write(large.mapInArrow(branch_batches, "node long, row long, id long, n long, c long").withColumn("tree", F.lit(TREES)), f"branch{level}")
            self.scratch.drop(rows)
            rows = branched
        return self.links(near)

    def contracted(self, links: DataFrame, now: DataFrame) -> DataFrame:
        """(id, c) after ``links`` of components are added to the components ``now`` (id, c)."""
        step = self.scratch.write(components(links, self.scratch), "step").select("id", F.col("component").alias("further"))
        moved = now.join(step.withColumnRenamed("id", "c"), "c", "left").select("id", F.coalesce("further", "c").alias("c"))
        new = step.join(now.select("id"), "id", "left_anti").select("id", F.col("further").alias("c"))
        return self.scratch.write(moved.unionByName(new), "components")

    def run(self) -> DataFrame:
        """(id, n, rep, component) of every id, and of every row without id, whose rep and component are null."""
        numbered = self.docs.select(F.monotonically_increasing_id().alias("row"), "id", "text")
        self.sets = self.scratch.write(numbered.mapInArrow(sketch_batches(self.k), _SKETCHED), "sets")
        narrow = self.sets.select("row", "id", "n", "k1", "k2")
        known = narrow.where("id is not null").groupBy("id").agg(F.min(F.struct("k1", "k2", "n", "row")).alias("x")).select("id", "x.*")
        members = self.scratch.write(known, "members")
        self.classes = classes = self.scratch.write(members.where("n > 0").groupBy("k1", "k2").agg(F.min(F.struct("id", "row", "n")).alias("x")).select("k1", "k2", "x.*"), "classes")
        roots = self.sets.select("row", "roots").join(classes.select("row", "id", "n"), "row")
        top = roots.select(F.posexplode("roots").alias("tree", "node"), "row", "id", "n")
        top = self.scratch.write(top.join(top.groupBy("node").count().where("count > 1").select("node"), "node", "left_semi"), "top")
        now = self.contracted(self.links([self.near(self.hooks(top.withColumn("c", F.col("id"))))]), self.spark.createDataFrame([], "id long, c long"))
        placed = top.join(now, "id", "left").select("node", "row", "id", "n", F.coalesce("c", "id").alias("c"), "tree")
        now = self.contracted(self.all_nodes(placed), now)
        reps = members.join(classes.select("k1", "k2", F.col("id").alias("rep")), ["k1", "k2"], "left").select("id", "n", F.coalesce("rep", "id").alias("rep"))
        found = reps.join(now.withColumnRenamed("id", "rep"), "rep", "left").select("id", "n", "rep", F.coalesce("c", "rep").alias("component"))
        lost = self.scratch.write(narrow.where("id is null").select("id", "n", F.col("id").alias("rep"), F.col("id").alias("component")), "without")
        self.scratch.drop(self.sets, top)
        return found.unionByName(lost)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """Per id: n_shingles, component_id (smallest id reached by links), kept, class_id (smallest id of an equal set).

    A row without id is kept, and its component and class are null.
    """
    found = ChosenPathJoin(docs, id_col, text_col, k, threshold).run()
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"), F.col("rep").alias("class_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of one document of each group: that with the smallest id.  Equal rows stay once.

    Where an id is missing or repeated, all rows go by a hash of id and text instead, so that rows of one id with
    different texts are told apart and copies without id are found; one of each group stays, the same in every run.
    """
    key = fresh(docs, "row_key")
    named = docs.withColumn(key, row_key(docs, id_col, text_col))
    kept = near_duplicates(named, key, text_col, k, threshold).where("kept").select(key)
    return named.join(kept, key, "left_semi").dropDuplicates([key]).select(docs.columns)
