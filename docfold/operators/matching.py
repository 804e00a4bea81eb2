"""Obligations against libraries and chunks: candidate search, verdicts, links and gaps.

What a model would decide comes from a provider: any object with the methods below whose results have the named columns.
The default is lexical and deterministic, and claims no likeness to a model's verdicts.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfold.functions.text import let
from docfold.operators.relational import first_by
from docfold.schemas import COVERAGE
from docfold.scratch import Scratch


class Provider(Protocol):
    def extract(self, docs: DataFrame) -> DataFrame:
        """(regulation_id, requirement_id, requirement_title, obligations) of (regulation_id, content_text)."""

    def match(self, obligations: DataFrame, library: DataFrame) -> DataFrame:
        """(id, match_status, matched_id) of obligations (id, text) against a library (item_id, text)."""

    def normalize(self, requirements: DataFrame) -> DataFrame:
        """(regulation_id, requirement_id, normalized_obligations) of what ``extract`` gives."""

    def controls(self, obligations: DataFrame) -> DataFrame:
        """(regulation_id, requirement_id, obligation_id, control) of obligations (the first three and obligation_text)."""

    def coverage(self, obligations: DataFrame, chunks: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
        """(id, chunk_num, coverage_status) of obligations (id, text) against chunks (chunk_num, text), where ``within`` agrees; missing ones may be left out."""

    def evidence(self, verdicts: DataFrame, chunks: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
        """``verdicts`` with evidence_text, from the chunk of each."""

    def translate(self, texts: DataFrame) -> DataFrame:
        """(source, target) of (source)."""


def shingles(text: Column, k: int = 3) -> Column:
    """Hashes of the distinct k-word shingles of a text in lower case."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")

    def hashed(h: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - k, F.lit(0))), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(k))))
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(F.size(h) < k, F.array(F.xxhash64(h))).otherwise(F.array_distinct(each))  # a shorter text is one shingle

    return let(F.transform(words, lambda w: F.xxhash64(w)), hashed)


def containment(items: DataFrame, item_id: str, texts: DataFrame, text_id: str, text: str = "text", k: int = 3, within: tuple[str, ...] = (), least: int | None = None) -> DataFrame:
    """(item_id, text_id, n_common, n_items): shared shingles of short items and long texts, by an inverted index.

    Both sides have the columns ``within``, which must agree and are returned.

    The join is on shingles, never on all pairs.  Where the items are small or their scan is selective, Spark broadcasts
    them or filters the texts' shingles by a Bloom filter at run time, so foreign shingles are not shuffled.

    With ``least``, only pairs that share so many percent of the item are wanted.  A text that shares m of an item's n shingles misses
    n - m, so it has one of any n - m + 1 of them: only the n - m + 1 that are in fewest texts look for candidates, and a shingle
    that is in all texts pairs nothing.  Candidates are then counted by all their shingles, found by text and shingle.
    """
    i = items.select(*within, item_id, shingles(F.col(text), k).alias("g"))
    left = i.select(*within, item_id, F.size("g").cast("long").alias("n_items"), F.explode("g").alias("g"))
    right = texts.select(*within, text_id, F.explode(shingles(F.col(text), k)).alias("g"))
    if least is None:
        return left.join(right, [*within, "g"]).groupBy(*within, item_id, text_id).agg(F.count("*").alias("n_common"), F.first("n_items").alias("n_items"))
    scratch = Scratch(items.sparkSession, "containment")
    held = scratch.write(right.join(left.select(*within, "g").distinct(), [*within, "g"], "left_semi"), "held")
    known = left.join(held.groupBy(*within, "g").agg(F.count("*").alias("n_texts")), [*within, "g"], "left")
    rarest = F.row_number().over(Window.partitionBy(*within, item_id).orderBy(F.coalesce("n_texts", F.lit(0)), "g"))
    enough = F.greatest(F.ceil(F.lit(least) * F.col("n_items") / 100), F.lit(1))
    probes = known.withColumn("place", rarest).where((F.col("place") <= F.col("n_items") - enough + 1) & F.col("n_texts").isNotNull())
    found = scratch.write(probes.select(*within, item_id, "g").join(held, [*within, "g"]).select(*within, item_id, text_id).distinct(), "candidates")
    counted = found.join(left, [*within, item_id]).join(held, [*within, text_id, "g"]).groupBy(*within, item_id, text_id)
    return counted.agg(F.count("*").alias("n_common"), F.first("n_items").alias("n_items")).where(100 * F.col("n_common") >= least * F.col("n_items"))


def best_matches(obligations: DataFrame, library: DataFrame, full: int = 90, partial: int = 30, below: bool = False) -> DataFrame:
    """Of each obligation (id, text) the library item with most of its shingles, the smaller id on ties; thresholds in percent.

    How many shingles a new obligation shares is counted only if ``below`` asks for it, as that holds every item with any of them.
    """
    shared = containment(obligations, "id", library, "item_id", least=None if below else partial)
    best = shared.groupBy("id").agg(F.max_by(F.struct("item_id", "n_common", "n_items"), F.struct(F.col("n_common"), -F.col("item_id"))).alias("b"))
    percent = 100 * F.col("b.n_common")
    status = F.when(percent >= full * F.col("b.n_items"), "fully_matched").when(percent >= partial * F.col("b.n_items"), "partially_matched").otherwise("new")
    out = obligations.select("id").join(best, "id", "left").withColumn("match_status", F.coalesce(status, F.lit("new")))
    return out.select("id", "match_status", F.when(F.col("match_status") != "new", F.col("b.item_id")).alias("matched_id"), F.coalesce("b.n_common", F.lit(0)).cast("long").alias("n_common"))


def titles_match(a: Column, b: Column) -> Column:
    """One title within the other, whatever the case; an empty title matches nothing."""
    a, b = F.lower(F.trim(a)), F.lower(F.trim(b))
    return (F.length(a) > 0) & (F.length(b) > 0) & (F.contains(a, b) | F.contains(b, a))


def title_pairs(left: DataFrame, left_id: str, right: DataFrame, right_id: str, title: str = "title") -> DataFrame:
    """(left_id, right_id) of titles within one another, by an equi-join: a piece of the shorter, three characters of it and those that are
    in fewest of the longer ones, occurs in the longer.  A title of under three characters is its own piece.
    """
    clean = F.lower(F.trim(F.col(title)))
    a = left.select(left_id, clean.alias("a")).where(F.length("a") > 0)
    b = right.select(right_id, clean.alias("b")).where(F.length("b") > 0)

    def pieces(t: str, sizes: tuple[int, ...]) -> Column:
        of = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - n + 1, F.lit(1))), lambda i: F.substr(F.col(t), i, F.lit(n)))
        return F.array_distinct(F.flatten(F.array(*map(of, sizes))))

    def held(long: DataFrame, t: str) -> DataFrame:
        return long.withColumn("g", F.explode(pieces(t, (1, 2, 3))))

    def rarest(short: DataFrame, key: str, t: str, index: DataFrame) -> DataFrame:
        """Each short title with the piece that fewest of the longer titles hold; titles with a piece in none of them go."""
        asked = short.withColumn("all", pieces(t, (3,))).select(key, t, F.size("all").alias("m"), F.explode("all").alias("g"))
        known = asked.join(index.groupBy("g").agg(F.count("*").alias("n")), "g")
        return known.groupBy(key, t).agg(F.min(F.struct("n", "g"))["g"].alias("g"), F.count("*").alias("hit"), F.max("m").alias("m")).where("hit = m").select(key, t, "g")

    in_b, in_a = held(b, "b"), held(a, "a")
    inner = rarest(a, left_id, "a", in_b).join(in_b, "g").where(F.contains("b", "a"))
    outer = rarest(b, right_id, "b", in_a).join(in_a, "g").where(F.contains("a", "b"))
    return inner.select(left_id, right_id).unionByName(outer.select(left_id, right_id)).distinct()


def new_links(found: DataFrame, linked: DataFrame, keys: list[str]) -> DataFrame:
    return found.select(*keys).distinct().join(linked.select(*keys), keys, "left_anti")


def link_outcome(found: DataFrame, linked: DataFrame, keys: list[str]) -> DataFrame:
    """``outcome`` of verdicts: a new item, a link that exists, or a link to make."""
    old = linked.select(*keys).distinct().withColumn("__old", F.lit(True))
    outcome = F.when(F.col("match_status") == "new", "new_item").when(F.col("__old"), "already_linked").otherwise("new_link")
    return found.join(old, keys, "left").withColumn("outcome", outcome).drop("__old")


def merge_gaps(obligations: DataFrame, verdicts: DataFrame, key: list[str]) -> DataFrame:
    """The best verdict of each obligation over all chunks, the first chunk on ties; ``missing`` without evidence if there is none."""
    rank = F.when(F.col("coverage_status") == COVERAGE[0], 2).when(F.col("coverage_status") == COVERAGE[1], 1).otherwise(0)
    tie = [F.col("evidence_text").asc_nulls_last()] if "evidence_text" in verdicts.columns else []
    best = first_by(verdicts.withColumn("__r", rank), key, F.col("__r").desc(), F.col("chunk_num"), *tie).drop("__r")
    return obligations.join(best, key, "left").withColumn("coverage_status", F.coalesce("coverage_status", F.lit("missing")))


def fallback_mapping(obligations: DataFrame, mappings: DataFrame) -> DataFrame:
    """Mapping of each obligation by its id, else by its text; the last mapping of a key wins.

    ``obligations`` has obligation_id and obligation_text; ``mappings`` these, ``position`` and ``matched_id``.
    """
    last = lambda k, name: mappings.where(F.col(k).isNotNull()).groupBy(k).agg(F.max_by("matched_id", "position").alias(name))
    return obligations.join(last("obligation_id", "by_id"), "obligation_id", "left").join(last("obligation_text", "by_text"), "obligation_text", "left").withColumn("matched_id", F.coalesce("by_id", "by_text"))


#: How obligations read, by the word found first: pattern, type, criticality, execution category.
RULES = (
    (r"(?i)\b(report|submit|notify)", "Reporting", "High", "One_Off_Reporting"),
    (r"(?i)\b(board|approv)", "Governance", "High", "Governance_Approval"),
    (r"(?i)\b(monitor|maintain|keep|review|ensure)", "Detective", "Medium", "Ongoing_Control"),
    (r"(?i)\b(establish|implement|appoint)", "Preventive", "Medium", "One_Time_Implementation"),
)


class LexicalProvider:
    """Sentences with a modal verb are obligations, told apart by ``rules``; verdicts go by shared shingles; translation is the identity."""

    def __init__(self, modal: str = r"(?i)\b(shall|must|should|is required to|are required to)\b", rules: tuple[tuple[str, str, str, str], ...] = RULES):
        self.modal, self.rules = modal, rules

    def _by_rule(self, text: Column, field: int, default: str) -> Column:
        out = F.lit(default)
        for rule in reversed(self.rules):
            out = F.when(text.rlike(rule[0]), rule[field]).otherwise(out)
        return out

    def normalize(self, requirements: DataFrame) -> DataFrame:
        def one(o: Column) -> Column:
            text = o["obligation_text"]
            return F.struct(
                o["obligation_id"].alias("obligation_id"), text.alias("obligation_text"), self._by_rule(text, 1, "Documentation").alias("obligation_type"),
                self._by_rule(text, 2, "Low").alias("criticality"), self._by_rule(text, 3, "Informational_No_Action").alias("execution_category"),
            )

        return requirements.select("regulation_id", "requirement_id", F.transform("obligations", one).alias("normalized_obligations"))

    def controls(self, obligations: DataFrame) -> DataFrame:
        title = F.concat(F.lit("Control of "), F.col("obligation_id"))
        control = F.struct(title.alias("control_title"), F.col("obligation_text").alias("control_description"), F.lit("Monthly").alias("frequency"))
        return obligations.select("regulation_id", "requirement_id", "obligation_id", control.alias("control"))

    def extract(self, docs: DataFrame) -> DataFrame:
        sentence = F.explode(F.split("content_text", r"(?<=[.!?])\s+"))
        rows = docs.select("regulation_id", sentence.alias("s")).where(F.col("s").rlike(self.modal))
        number = F.row_number().over(Window.partitionBy("regulation_id").orderBy("s"))
        rows = rows.distinct().withColumn("n", number)
        one = F.struct(F.concat(F.lit("OBL-"), F.lpad(F.col("n").cast("string"), 3, "0")).alias("obligation_id"), F.col("s").alias("obligation_text"), F.lit(None).cast("string").alias("source_reference"))
        return rows.groupBy("regulation_id").agg(F.sort_array(F.collect_list(one)).alias("obligations")).select("regulation_id", F.lit("REQ-001").alias("requirement_id"), F.lit("Obligations").alias("requirement_title"), "obligations")

    def match(self, obligations: DataFrame, library: DataFrame) -> DataFrame:
        return best_matches(obligations, library)

    def coverage(self, obligations: DataFrame, chunks: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
        shared = containment(obligations, "id", chunks, "chunk_num", within=within, least=30)
        status = F.when(100 * F.col("n_common") >= 80 * F.col("n_items"), "covered").otherwise("partial")
        return shared.select(*within, "id", "chunk_num", status.alias("coverage_status"))

    def evidence(self, verdicts: DataFrame, chunks: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
        return verdicts.join(chunks.select(*within, "chunk_num", F.substring("text", 1, 200).alias("evidence_text")), [*within, "chunk_num"], "left")

    def translate(self, texts: DataFrame) -> DataFrame:
        return texts.select("source", F.col("source").alias("target")).distinct()
