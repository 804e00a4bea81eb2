"""A Merkle manifest of a table: one digest for all rows, and for each row the proof that it is among them.

Rows are leaves in order of language and id.  Blocks of ``BLOCK`` consecutive nodes, aligned at multiples of it, are walked
in postorder: the digest of a subtree is returned, and while the walk unwinds each leaf below is given the siblings of the node it
stands under.  The blocks' roots are the nodes of the next walk, distributed in the same way, until one node of each language
is left; the languages' nodes are walked likewise.  Then the siblings found high up go down again to the blocks they belong to.

No group holds more than ``BLOCK`` nodes, whatever the languages' shares, and texts are read once and never shuffled: only their
digests are.

Definitions.  A missing value is ``-``, any other its number of UTF-8 bytes, ``:`` and the value.  Missing languages and ids come first;
rows of one id are ordered by digest, and equal rows are leaves each.  Columns beyond the five have no part in a leaf.  A
missing id is never tampered with.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docfold.scratch import Scratch

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY, HEIGHT = 8, 4
BLOCK = ARITY**HEIGHT
#: Hex digits of a digest.
WIDTH = 64
LOWERED = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_digest(values: list[Column]) -> Column:
    """The digest of a row's values, each told apart from its neighbours by its length."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def climb(leaves: list[str], height: int, proofs: list[list[str]] | None = None) -> str:
    """The digest of ``height`` levels above ``leaves``; to each leaf's proof its siblings are appended, the nearest first."""

    def walk(lo: int, height: int) -> str:
        if height == 0:
            return leaves[lo]
        step = ARITY ** (height - 1)
        starts = range(lo, min(len(leaves), lo + ARITY * step), step)
        run = [walk(at, height - 1) for at in starts]
        if proofs is not None and len(run) > 1:
            for i, at in enumerate(starts):
                siblings = "".join(run[:i] + run[i + 1 :])
                for leaf in range(at, min(len(leaves), at + step)):
                    proofs[leaf].append(siblings)
        return digest("".join(run))

    return walk(0, height)


def levels_above(n: int) -> int:
    """How many levels of a block are made: all if other blocks stand beside it, else as many as leave one node."""
    height = 0
    while height < HEIGHT and ARITY**height < n:
        height += 1
    return height


def fold(node: str, rank: int, n: int, proof: str, at: int = 0) -> tuple[str, int]:
    """The root over the node of this rank among ``n``, recomputed with the siblings in ``proof`` from ``at`` on; where they end."""
    while n > 1:
        before = rank % ARITY
        size = WIDTH * (min(ARITY, n - rank + before) - 1)
        siblings, at = proof[at : at + size], at + size
        node = digest(siblings[: WIDTH * before] + node + siblings[WIDTH * before :])
        rank, n = rank // ARITY, -(-n // ARITY)
    return node, at


def numbered(nodes: DataFrame, scratch: Scratch, order: list[str]) -> DataFrame:
    """``nodes`` with their rank in their key, from 0, and the key's number of nodes; no key is gathered anywhere.

    Rows are sorted in ranges, so a key may take many tasks; what is added up are one row for each key in each range.
    """
    row = F.monotonically_increasing_id()
    ordered = nodes.repartitionByRange("key", *order).sortWithinPartitions("key", *order).withColumn("row", row)
    ordered = scratch.write(ordered.select("*", F.shiftright("row", 33).alias("part")), "ordered")
    parts = ordered.groupBy("key", "part").agg(F.min("row").alias("first"), F.count("*").alias("held"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("key", "part", (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("held").over(Window.partitionBy("key")).alias("n"))
    return ordered.join(parts, ["key", "part"]).withColumn("rank", F.col("row") + F.col("shift")).drop("part", "row", "shift")


def _blocks(nodes: DataFrame):
    return nodes.withColumn("block", F.expr(f"rank div {BLOCK}")).groupBy("key", "block")


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by("rank")


def _root(key: tuple, table: pa.Table) -> pa.Table:
    n = table["n"][0].as_py()
    root = climb(_ordered(table)["digest"].to_pylist(), levels_above(n))
    return pa.table({"key": [key[0]], "rank": [key[1]], "n": [-(-n // BLOCK)], "digest": [root]})


def raised(nodes: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """The nodes, their blocks' roots, the roots of these, and so on until each key has one: (key, rank, n, digest)."""
    nodes = nodes.select("key", "rank", "n", "digest")
    levels = [nodes]
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        nodes = scratch.write(_blocks(nodes).applyInArrow(_root, "key string, rank long, n long, digest string"), "roots")
        levels.append(nodes)
    return levels


def lowered(nodes: DataFrame, above: DataFrame, make: Callable[[dict, list[str]], dict], schema: str) -> DataFrame:
    """``make`` of a block's nodes, with all that ``above`` says of the block's root, and the nodes' proofs."""

    def prove(left: pa.Table, right: pa.Table) -> pa.Table:
        left, up = _ordered(left), right.to_pylist()[0]
        leaves = left["digest"].to_pylist()
        proofs: list[list[str]] = [[] for _ in leaves]
        climb(leaves, levels_above(left["n"][0].as_py()), proofs)
        rows = left.to_pylist()
        return pa.Table.from_pylist([make(row | {"up": up}, "".join(proof) + up["proof"]) for row, proof in zip(rows, proofs, strict=True)], schema=arrow)

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return _blocks(nodes).cogroup(above.withColumnRenamed("rank", "block").groupBy("key", "block")).applyInArrow(prove, schema)


def _pass_on(row: dict, proof: str) -> dict:
    up = row["up"]
    return {"key": row["key"], "rank": row["rank"], "proof": proof} | {k: up[k] for k in ("subroot", "root", "place", "places")}


def _subroot(row: dict, proof: str) -> dict:
    return {"key": row["lang_key"], "rank": row["lang_rank"], "proof": proof, "subroot": row["digest"], "root": row["up"]["root"], "place": row["rank"], "places": row["n"]}


def _verdict(row: dict, proof: str) -> dict:
    up = row["up"]
    folded, at = fold(row["tampered"], row["rank"], row["n"], proof)
    folded, _ = fold(folded, up["place"], up["places"], proof, at)
    return {"doc_id": row["doc_id"], "leaf": row["digest"], "subroot": up["subroot"], "root": up["root"], "proof_sha256": digest(proof), "folded_root": folded, "verified": folded == up["root"]}


PROOFS = "key string, rank long, proof string, subroot string, root string, place long, places long"
VERDICTS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _descend(levels: list[DataFrame], above: DataFrame, scratch: Scratch) -> DataFrame:
    """Proofs of the blocks of the lowest level, from those of the single nodes at the top."""
    for nodes in reversed(levels[1:]):
        above = scratch.write(lowered(nodes, above, _pass_on, PROOFS), "proofs")
    return above


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of each row."""
    scratch = Scratch(docs.sparkSession, "manifest")
    values = {f: F.col(f) for f in FIELDS}
    leaf = leaf_digest(list(values.values()))
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    tampered = F.when(touched, leaf_digest(list((values | {"text": F.translate("text", *LOWERED)}).values()))).otherwise(leaf)
    key = F.coalesce(F.concat(F.lit("1"), F.col("lang").cast("string")), F.lit("0"))  # in the order of languages, missing ones first
    leaves = scratch.write(docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("digest"), tampered.alias("tampered")), "leaves")
    leaves = scratch.write(numbered(leaves, scratch, ["doc_id", "digest"]), "numbered")
    levels = raised(leaves, scratch)
    subroots = levels[-1].select(F.lit("").alias("key"), F.col("key").alias("lang_key"), F.col("rank").alias("lang_rank"), "digest")
    subroots = scratch.write(numbered(subroots, scratch, ["lang_key"]), "subroots")
    tops = raised(subroots, scratch)
    blank = [F.lit("").alias("proof"), F.lit("").alias("subroot"), F.col("digest").alias("root"), F.lit(0).cast("long").alias("place"), F.lit(0).cast("long").alias("places")]
    above = _descend(tops, tops[-1].select("key", "rank", *blank), scratch)
    above = _descend(levels, scratch.write(lowered(subroots, above, _subroot, PROOFS), "proofs"), scratch)
    return lowered(leaves, above, _verdict, VERDICTS)
