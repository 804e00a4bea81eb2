"""The prefix trie of conversations: which turns they begin with in common, and what is saved by keeping these once.

A conversation's turns are scanned in order and every prefix gets a fingerprint, the turns' hashes times the powers of an odd
base, summed modulo 2**64 by numpy.  Prefixes of one depth and fingerprint are candidates for one node, and each group is verified turn by
turn against its representative: its last turns must be the same turn and the prefixes before them of one group, at every depth,
so that by induction all turns agree.  Turns are the same if their role and text are, which is verified for every hash that occurs.  What
collides is split: turns by label, groups by a mark that enters a second fingerprint of all longer prefixes.

A node is named by its smallest member and its depth.  Sums over subtrees need no walk over levels: the nodes that a
conversation represents are the end of its path, so what it shares with smaller conversations is a prefix, of which each node on
its path is given the part from itself on; the parts, and the leaves, are added up by node with partial sums.

A conversation may hold any share of all turns: rows are sorted in ranges which may cut it, and what one range hands to the
next is a row a range.  Texts are shuffled once, to be verified; later steps move hashes and lengths.

Definitions.  Turns go by number, missing ones first, then by role and by MD5 of the text; equal rows are turns each.  A missing
role or text is empty.  Rows without a conversation are left out.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfold.llm.words import mix
from docfold.scratch import Scratch

BASE = 0x9E3779B97F4A7C15 | 1
LAST64 = (1 << 64) - 1
#: Rounds of splitting; each settles at least one more depth.
MAX_ROUNDS = 1000
#: Ids are joined to text in pieces of this many.
PIECE_BITS = 16
HEAD, GROUP = 6, 100

_U = np.uint64
_CHUNK = 1 << 16


class Powers:
    """Powers of the base modulo 2**64, from two short tables."""

    def __init__(self):
        self.low = self._table(BASE, _CHUNK)
        self.high = self._table(pow(BASE, _CHUNK, 1 << 64), 1)

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        t = np.full(n, base & LAST64, _U)
        t[0] = 1
        return np.multiply.accumulate(t)

    def of(self, k: np.ndarray) -> np.ndarray:
        high = k // _CHUNK
        if len(k) and high.max() >= len(self.high):
            self.high = self._table(pow(BASE, _CHUNK, 1 << 64), int(high.max()) + 1)
        return self.low[k % _CHUNK] * self.high[high]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


SUMS = ("fp", "split", "total")


def _segments(values: np.ndarray, starts: np.ndarray, number: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Running sums that start again at every segment; the first goes on from ``before``."""
    out = np.cumsum(values, dtype=values.dtype)
    base = np.where(starts > 0, out[starts - 1], 0).astype(values.dtype)
    base[0] -= before
    return out - base[number]


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix fingerprints and sums of sorted rows, as far as their conversation lies in this task's range."""
    powers, part = Powers(), TaskContext.get().partitionId()
    conv, done, row, sums = None, 0, 0, (_U(0), _U(0), np.int64(0))
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ids, h, label, extra = (batch[c].to_numpy() for c in ("conv_id", "h", "label", "extra"))
        new = np.concatenate([[True], ids[1:] != ids[:-1]])
        starts = np.flatnonzero(new)
        number = np.cumsum(new) - 1
        index = np.arange(n) - starts[number]
        if ids[0] == conv:
            index[number == 0] += done
        else:
            sums = (_U(0), _U(0), np.int64(0))
        weight = powers.of(index)
        turn = np.where(h == 0, _U(0), mix(h.view(_U) + mix(label.view(_U)))) * weight
        mark = np.where(extra == 0, _U(0), mix(extra.view(_U))) * weight
        chars = batch["chars"].to_numpy()
        made = [_segments(x, starts, number, b) for x, b in zip((turn, mark, chars), sums, strict=True)]
        conv, done, sums = ids[-1], int(index[-1]) + 1, tuple(x[-1] for x in made)
        columns = [*batch.columns, pa.array(np.full(n, part, np.int64)), pa.array(np.arange(row, row + n)), pa.array(index), _signed(made[0]), _signed(made[1]), pa.array(made[2])]
        columns += [_signed(made[0] - turn), _signed(made[1] - mark)]
        row += n
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "row", "depth", *SUMS, "up_fp", "up_split"])


def handed_on(ends: list) -> dict[int, tuple]:
    """For each range what it takes over: the conversation that the ranges before end with, its rows and sums there."""
    out, held = {}, None
    for r in sorted(ends, key=lambda r: r["part"]):
        if held is not None:
            out[r["part"]] = held
        x = r["last"]
        mine = (x["depth"] + 1, x["fp"] & LAST64, x["split"] & LAST64, x["total"])
        if held is not None and held[0] == x["conv_id"]:
            power = pow(BASE, held[1], 1 << 64)
            mine = (held[1] + mine[0], (held[2] + power * mine[1]) & LAST64, (held[3] + power * mine[2]) & LAST64, held[4] + mine[3])
        held = (x["conv_id"], *mine)
    return out


def carry(taken: dict[int, tuple]):
    """Completes what ``scan`` made of conversations that a range takes over."""
    parts = np.array(sorted(taken), np.int64)
    table = [np.array([taken[p][i] for p in parts.tolist()], kind) for i, kind in enumerate((np.int64, np.int64, _U, _U, np.int64))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            if len(parts) and batch.num_rows:
                part = batch["part"].to_numpy()
                at = np.minimum(np.searchsorted(parts, part), len(parts) - 1)
                late = np.flatnonzero((parts[at] == part) & (table[0][at] == batch["conv_id"].to_numpy()))
                if len(late):
                    _, depth, fp, split, total = (x[at[late]] for x in table)
                    power = powers.of(depth)
                    columns = dict(zip(batch.schema.names, batch.columns, strict=True))

                    def put(name, add, times=None, columns=columns, late=late):
                        x = columns[name].to_numpy().copy()
                        y = x if times is None else x.view(_U)
                        y[late] = y[late] + add if times is None else add + times * y[late]
                        columns[name] = pa.array(x)

                    put("depth", depth)
                    put("total", total)
                    for name, add in (("fp", fp), ("up_fp", fp), ("split", split), ("up_split", split)):
                        put(name, add, power)
                    batch = pa.RecordBatch.from_arrays(list(columns.values()), batch.schema.names)
            yield batch

    return run


def prefixes(rows: DataFrame, scratch: Scratch, order: list[str]) -> DataFrame:
    """``rows`` (conv_id, h, label, extra, chars and ``order``) with the depth of each in its conversation, from 0, and its prefix's sums."""
    made = ", ".join(f"{c} long" for c in ("part", "row", "depth", *SUMS, "up_fp", "up_split"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", " + made
    ordered = rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    ordered = scratch.write(ordered.mapInArrow(scan, schema), "scanned")
    ends = ordered.groupBy("part").agg(F.max_by(F.struct("conv_id", "depth", *SUMS), "row").alias("last")).collect()  # a row a range
    return ordered.mapInArrow(carry(handed_on(ends)), schema).drop("part", "row")


def _hash(x: Column, bits: int) -> Column:
    """Never 0, which is the hash of the place before the first turn; fewer ``bits`` than 64 make collisions, for tests."""
    return F.coalesce(F.nullif(x, F.lit(0)), F.lit(1)).cast("long") if bits == 64 else F.shiftrightunsigned(x, 64 - bits) + 1


def identified(conversations: DataFrame, scratch: Scratch, bits: int = 64) -> DataFrame:
    """(conv_id, pos, h, label, chars): each turn at its place; two have one ``h`` and ``label`` only if role and text are the same."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    turns = turns.withColumn("h", _hash(F.xxhash64("role", "text"), bits))
    whole = F.struct("role", "text")
    mixed = turns.groupBy("h").agg(F.min(whole).alias("least"), F.max(whole).alias("most")).where("least <> most").select("h")
    mixed = scratch.write(mixed, "mixed_turns")
    if mixed.isEmpty():
        turns = turns.withColumn("label", F.lit(0).cast("long"))
    else:
        kinds = turns.join(mixed, "h", "left_semi").select("h", "role", "text").distinct()
        kinds = kinds.withColumn("label", F.row_number().over(Window.partitionBy("h").orderBy("role", "text")).cast("long"))
        turns = turns.join(kinds, ["h", "role", "text"], "left").withColumn("label", F.coalesce("label", F.lit(0).cast("long")))
    turns = turns.select("conv_id", "turn", "role", F.md5("text").alias("tie"), "h", "label", F.lit(0).cast("long").alias("extra"), F.length("text").cast("long").alias("chars"))
    return prefixes(turns, scratch, ["turn", "role", "tie"]).select("conv_id", F.col("depth").alias("pos"), "h", "label", "chars")


def head_size(conv_id: str) -> Column:
    return F.crc32(F.col(conv_id).cast("string").cast("binary")) % HEAD


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sequences (conv_id, pos, h, label, chars) that begin with the head of the first conversation of their hundred, and all conv_id.

    A head has fewer than ``HEAD`` turns and goes to the conversations of one hundred only, so no key of the join is large.
    """
    ids = turns.select("conv_id").distinct()
    first = F.col("conv_id") - F.col("conv_id") % GROUP
    own = turns.where(F.col("pos") >= head_size("conv_id"))
    heads = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("pos") < HEAD)).withColumnRenamed("conv_id", "first")
    taken = ids.withColumn("first", first).join(heads, "first").where(F.col("pos") < head_size("conv_id")).select(*own.columns)
    return taken.unionByName(own), ids


KEY = ["depth", "key", "split"]


def _grouped(sequences: DataFrame, scratch: Scratch, bits: int) -> tuple[DataFrame, DataFrame]:
    """All prefixes with their groups, and the groups, each verified to hold one sequence of turns."""
    now = sequences
    key = lambda fp: _hash(F.xxhash64(fp), bits)
    step = F.struct("up_key", "up_split", "h", "label")
    for _ in range(MAX_ROUNDS):
        found = prefixes(now, scratch, ["pos"]).withColumns({"key": key("fp"), "up_key": key("up_fp")})
        groups = found.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("chars").alias("chars"), F.min("total").alias("total"), F.min(step).alias("step"), F.max(step).alias("most")
        )
        groups = scratch.write(groups, "groups")
        mixed = groups.where("depth > 0 and step <> most").select(*KEY)
        if mixed.isEmpty():
            return found, groups.select(*KEY, "conv_id", "n_convs", "chars", "total", "step.up_key", "step.up_split")
        kinds = found.join(mixed, KEY, "left_semi").select(*KEY, step.alias("step")).distinct()
        kinds = kinds.withColumn("mark", F.row_number().over(Window.partitionBy(*KEY).orderBy("step")))
        marked = found.withColumn("step", step).join(kinds, [*KEY, "step"], "left")
        extra = F.when(F.col("mark").isNull(), F.col("extra")).otherwise(F.xxhash64("extra", "mark"))
        now = scratch.write(marked.withColumn("extra", extra).select(*sequences.columns), "marked")
    raise RuntimeError(f"prefixes still collide after {MAX_ROUNDS} rounds")


def trie(sequences: DataFrame, ids: DataFrame, scratch: Scratch, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """The nodes of the trie of ``sequences`` (conv_id, pos, h, label, chars), and for each of ``ids`` the node where it ends.

    Nodes: conv_id and depth, which name them, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens.  Ends: conv_id, node, depth.
    """
    zero = F.lit(0).cast("long")
    start = ids.select("conv_id", F.lit(-1).cast("long").alias("pos"), zero.alias("h"), zero.alias("label"), zero.alias("chars"))
    laid = scratch.write(start.unionByName(sequences.select(*start.columns)).withColumn("extra", zero), "sequences")
    found, nodes = _grouped(laid, scratch, bits)
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_key").alias("key"), F.col("up_split").alias("split")).agg(F.count("*").alias("n_children"))
    nodes = scratch.write(nodes.join(children, KEY, "left").fillna(0, ["n_children"]), "nodes")
    ends = found.groupBy("conv_id").agg(F.max(F.struct("depth", "key", "split", "total")).alias("end")).select("conv_id", "end.*")
    named = nodes.select(*KEY, F.col("conv_id").alias("node"))
    # what each conversation has in common with smaller ones, and whether it represents a leaf
    own = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", (F.col("total") - F.col("chars")).alias("shared"))).alias("top"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    own = ends.join(own, "conv_id", "left").select("conv_id", F.coalesce("top.shared", "total").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    part = F.greatest(F.col("shared") - F.col("total") + F.col("chars"), zero)
    sums = found.join(own, "conv_id").groupBy(*KEY).agg(F.sum(part).alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    parents = named.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("up_key"), F.col("split").alias("up_split"), F.col("node").alias("parent_conv_id"))
    nodes = nodes.join(sums, KEY).join(parents, ["depth", "up_key", "up_split"], "left")
    nodes = nodes.select("conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens")
    return nodes, ends.join(named, KEY).select("conv_id", "node", "depth")


def prefix_trie(conversations: DataFrame, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """The trie of conversations as they are, and where they end; see ``trie``."""
    scratch = Scratch(conversations.sparkSession, "trie")
    turns = scratch.write(identified(conversations, scratch, bits), "turns")
    return trie(turns, turns.select("conv_id").distinct(), scratch, bits)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order, one after another."""
    held, state = None, None
    for batch in batches:
        out = []
        for node, depth, text in zip(*(batch[c].to_pylist() for c in ("node", "depth", "ids")), strict=True):
            if held != (node, depth):
                if held is not None:
                    out.append((*held, state.hexdigest()))
                held, state = (node, depth), sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["node", "depth", "ends_sha256"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*held, state.hexdigest())], ["node", "depth", "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """(node, depth, ends_sha256): the digest of the ascending ids that end at a node, joined by commas.

    Ids are joined in pieces of at most 2**16, however many there are; what one task reads of a node in the end are pieces, one at a time.
    """
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))
    pieces = ends.groupBy("node", "depth", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(F.array_join(ids, ",").alias("ids"))
    laid = pieces.repartition("node", "depth").sortWithinPartitions("node", "depth", "piece")
    return laid.mapInArrow(_joined, "node long, depth long, ends_sha256 string")


def rebuilt_trie(conversations: DataFrame, bits: int = 64) -> DataFrame:
    """The nodes of the trie of rebuilt conversations, with the digest of the ids that end at each."""
    scratch = Scratch(conversations.sparkSession, "trie")
    turns = scratch.write(identified(conversations, scratch, bits), "turns")
    nodes, ends = trie(*rebuilt(turns), scratch, bits)
    digests = ends_digest(scratch.write(ends, "ends")).withColumnRenamed("node", "conv_id")
    none = F.lit(sha256(b"").hexdigest())
    return nodes.join(digests, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
