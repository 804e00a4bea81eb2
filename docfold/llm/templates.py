"""Line dedup by a log-template tree, in DataFrame functions only.

Method.  A line with words goes down a tree of fixed depth: its number of words, then its ``LEAD`` first words (of a line of
three words two), where a word with a digit is a variable and reads ``<*>``.  Within a leaf a word is constant if it stands at its
place in at least ``DOCUMENTS`` documents and in one of ``COMMON`` of the leaf's documents at least; any other is a
variable field, wherever it stands and whatever stands beside it.  The constants in their places are the line's template, if they
are at least ``FIXED`` hundredths of its words: lines that share less have no template of the leaf.  Beside it every line has one
template of its own, in which all its words are constant: so a line that recurs as it stands goes however many others share its leaf.

A template recurs if at least ``DOCUMENTS`` different documents hold it, and in one of ``SHARE`` of its lines at least,
where a class of copies counts the lines of the one that holds most: what a document says again and again is its own.  Documents
are counted by classes of copies: whole texts that are equal, or nearly equal (``SHINGLE`` words, ``ALIKE`` percent,
through any chain of such texts), are one.  So the lines of copied documents do not recur by being copied, and near-duplicate
removal is left to decide about those; the lines around a line, blank or not, have no say.  Lines of recurring templates are dropped wherever they are.

Nearly equal texts are found by the ``SKETCH`` smallest hashes of their shingles.  Texts that agree in the two smallest of one of ``BANDS``
parts of these are held against one text of each such group, and linked if the sketches agree; links are contracted to components.  A pair at
the threshold meets in a band with a probability over 0.999; its likeness is judged with a standard error of 5 points.

Everything is counted by hashes: per leaf and class, per leaf, word and class, per template and class, each with partial
sums before its shuffle, so a line in a third of all rows costs its tasks no more than others.  Words are looked at only in leaves that
recur; a leaf has at most ``COMMON`` constants a place.

Definitions.  A null text stays null; lines without words always stay, as does the order of the rest.  Rows that repeat an id, or have none,
are told apart by a hash of id and text; equal rows are one document.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfold.llm.columns import WORD, fresh, let, row_key, words
from docfold.llm.components import components
from docfold.scratch import Scratch

LEAD, DOCUMENTS, SHARE, COMMON, FIXED = 3, 5, 5, 20, 66
SHINGLE, ALIKE, SKETCH, BANDS = 5, 80, 64, 8


def _masked(word: Column) -> Column:
    return F.when(word.rlike("[0-9]"), "<*>").otherwise(word)


def _lead(n: Column) -> Column:
    """How many words lead a line of n."""
    return F.when(n == 3, 2).otherwise(F.least(n, F.lit(LEAD)))


def _leaf(line: Column) -> Column:
    return let(words(line), lambda w: F.xxhash64(F.size(w), F.transform(F.slice(w, F.lit(1), _lead(F.size(w))), _masked)))


def _tokens(line: Column) -> Column:
    """A hash of each word with its place."""
    return F.transform(words(line), lambda w, i: F.xxhash64(i, _masked(w)))


def _lines(docs: DataFrame, key: Column, text_col: str) -> DataFrame:
    """(doc, pos, leaf) of each line that has words."""
    keyed = F.transform(F.split(F.col(text_col), "\n"), lambda x: F.when(x.rlike(WORD), _leaf(x)))
    return docs.select(key.alias("doc"), F.posexplode(keyed).alias("pos", "leaf")).where("leaf is not null")


def _sketch(text: Column) -> Column:
    """The smallest hashes of a text's shingles, in order; a text with fewer words than a shingle has one, all of its words."""
    shingle = lambda h: lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(SHINGLE)))
    every = lambda h: F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - SHINGLE, F.lit(0))), shingle(h))
    hashes = let(F.transform(words(text), lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) < SHINGLE, F.array(F.xxhash64(h))).otherwise(every(h)))
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, SKETCH)


def _classes(docs: DataFrame, scratch: Scratch, key: Column, text_col: str) -> DataFrame:
    """(doc, class, rows): each document with the one that stands for its copies, and its number of equal rows."""
    known = docs.where(F.col(text_col).rlike(WORD)).select(key.alias("doc"), F.xxhash64(text_col).alias("whole"), _sketch(F.col(text_col)).alias("sketch"))
    known = scratch.write(known, "sketches")
    equal = known.groupBy("whole").agg(F.min("doc").alias("class"))
    first = known.join(equal.select(F.col("class").alias("doc"), "whole").hint("merge"), ["doc", "whole"], "left_semi").dropDuplicates(["doc"])
    first = scratch.write(first.select("doc", "sketch"), "first")
    parts = F.array(*(F.xxhash64(F.lit(b), F.slice(F.filter("sketch", lambda x, b=b: F.pmod(x, F.lit(BANDS)) == b), 1, 2)) for b in range(BANDS)))
    bands = scratch.write(first.select("doc", F.explode(F.array_distinct(parts)).alias("band")), "bands")
    met = bands.groupBy("band").agg(F.min("doc").alias("v"), F.count("*").alias("n")).where("n > 1")
    pairs = bands.join(met.hint("merge"), "band").where("doc <> v").select(F.col("doc").alias("u"), "v").distinct()
    side = lambda name: first.select(F.col("doc").alias(name), F.col("sketch").alias(f"{name}_sketch")).hint("merge")
    least = F.slice(F.sort_array(F.array_union("u_sketch", "v_sketch")), 1, SKETCH)
    alike = let(least, lambda x: 100 * F.size(F.array_intersect(F.array_intersect("u_sketch", "v_sketch"), x)) >= ALIKE * F.size(x))
    links = pairs.join(side("u"), "u").join(side("v"), "v").where(alike).select("u", "v")
    near = components(links, scratch).select(F.col("id").alias("class"), "component")
    same = known.groupBy("doc", "whole").agg(F.count("*").alias("rows")).join(equal.hint("merge"), "whole").select("doc", "class", "rows")
    classes = scratch.write(same.join(near.hint("merge"), "class", "left").select("doc", F.coalesce("component", "class").alias("class"), "rows"), "classes")
    scratch.drop(known, first, bands)
    return classes


def _candidates(docs: DataFrame, scratch: Scratch, key: Column, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The lines (doc, class, rows, pos, leaf, tokens) of leaves that recur, and the leaves with their number of classes."""
    lines, classes = scratch.write(_lines(docs, key, text_col), "lines"), _classes(docs, scratch, key, text_col)
    met = lines.select("doc", "leaf").distinct().join(classes.select("doc", "class").hint("merge"), "doc").select("leaf", "class").distinct()
    leaves = scratch.write(met.groupBy("leaf").agg(F.count("*").alias("m")).where(F.col("m") >= DOCUMENTS), "leaves")
    wanted = lines.join(leaves.select("leaf").hint("merge"), "leaf", "left_semi").groupBy("doc").agg(F.collect_set(F.struct("pos", "leaf")).alias("wanted"))  # equal rows share their lines
    wanted = wanted.join(classes.hint("merge"), "doc").withColumnRenamed("doc", "wanted_doc")
    texts = docs.select(key.alias("doc"), F.col(text_col).alias("whole")).join(wanted.hint("merge"), F.col("doc") == F.col("wanted_doc"))
    one = let(F.split("whole", "\n"), lambda x: F.transform("wanted", lambda w: F.struct(w["pos"].alias("pos"), w["leaf"].alias("leaf"), _tokens(F.get(x, w["pos"])).alias("tokens"))))
    cand = scratch.write(texts.select("doc", "class", "rows", F.inline(one)), "candidates")
    scratch.drop(lines, classes)
    return cand, leaves


def dropped_lines(docs: DataFrame, scratch: Scratch, key: Column, text_col: str = "text") -> DataFrame:
    """(doc, dropped): the places of the lines that go, for each document that loses any."""
    cand, leaves = _candidates(docs, scratch, key, text_col)
    n = F.size("tokens")
    rest = F.slice("tokens", _lead(n) + 1, n)
    seen = cand.select("leaf", "class", F.explode(rest).alias("token")).distinct().groupBy("leaf", "token").agg(F.count("*").alias("c"))
    constant = (F.col("c") >= DOCUMENTS) & (COMMON * F.col("c") >= F.col("m"))
    common = scratch.write(seen.join(leaves.hint("merge"), "leaf").where(constant).groupBy("leaf").agg(F.collect_set("token").alias("common")), "common")
    fixed = F.array_intersect(rest, F.coalesce("common", F.array().cast("array<bigint>")))
    held = cand.join(common.hint("merge"), "leaf", "left").select("doc", "class", "rows", "pos", "leaf", _lead(n).alias("lead"), n.alias("n"), fixed.alias("fixed"), rest.alias("rest"))
    of_leaf = F.when(100 * (F.col("lead") + F.size("fixed")) >= FIXED * F.col("n"), F.xxhash64("leaf", "fixed"))
    whole = F.when(F.size("fixed") < F.size("rest"), F.xxhash64("leaf", "rest", F.lit("whole")))
    held = scratch.write(held.select("doc", "class", "rows", "pos", F.explode(F.array_compact(F.array(of_leaf, whole))).alias("template")), "held")
    by_doc = held.groupBy("template", "class", "doc", "rows").agg((F.count("*") / F.col("rows")).alias("n"))
    by_class = by_doc.groupBy("template", "class").agg(F.max("n").alias("n"))
    recurring = by_class.groupBy("template").agg(F.count("*").alias("docs"), F.sum("n").alias("n")).where(f"docs >= {DOCUMENTS} and {SHARE} * docs >= n")
    recurring = scratch.write(recurring.select("template"), "recurring")
    gone = held.join(recurring.hint("merge"), "template", "left_semi").groupBy("doc").agg(F.collect_set("pos").alias("dropped"))
    gone = scratch.write(gone, "gone")
    scratch.drop(cand, leaves, common, held, recurring)
    return gone


def _rest(text: Column, dropped: Column) -> Column:
    places = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
    kept = let(F.split(text, "\n"), lambda lines: F.transform(places(lines), lambda i: F.get(lines, i)))
    return F.when(dropped.isNull(), text).otherwise(F.array_join(kept, "\n"))


def without_templates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the columns it has and ``kept_text``, ``n_lines`` (with words) and ``n_dropped``, under names not taken."""
    scratch, key = Scratch(docs.sparkSession, "templates"), row_key(docs, id_col, text_col)
    doc, dropped = fresh(docs, "template_doc"), fresh(docs, "template_dropped")
    gone = dropped_lines(docs, scratch, key, text_col).select(F.col("doc").alias(doc), F.col("dropped").alias(dropped))
    # Sorted on both sides whatever the size: what is lost grows with the documents, so it is never sent whole to an executor.
    joined = docs.join(gone.hint("merge"), key == F.col(doc), "left")
    lines = F.size(F.filter(F.coalesce(F.split(F.col(text_col), "\n"), F.array().cast("array<string>")), lambda x: x.rlike(WORD)))
    return joined.select(
        *(docs[c] for c in docs.columns),
        _rest(docs[text_col], F.col(dropped)).alias(fresh(docs, "kept_text")),
        lines.cast("long").alias(fresh(docs, "n_lines")),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias(fresh(docs, "n_dropped")),
    )


def drop_templates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text that is left; documents of which nothing with a word is left, though they had words, go."""
    out = without_templates(docs, id_col, text_col)
    text, n = fresh(docs, "kept_text"), fresh(docs, "n_dropped")
    out = out.where((F.col(n) == 0) | F.col(text).rlike(WORD))
    return out.select(*(F.col(text).alias(c) if c == text_col else F.col(c) for c in docs.columns))
