"""Mixing sources to target weights.

Words are counted per source; a source's repetition rate is its target over its size; each document is emitted
floor(rate) times, and once more with a probability equal to the fraction, decided by a hash of its id.

Definitions.  A null text has no words.  A null source is a source, ranked last.  Rows that repeat an id are decided
alike.  A source without words has target 0 and its documents are not taken.  An empty table gives an empty result.
Reruns agree, as nothing but the rows and the seed decides.  Sources are joined by value; the small table of sources is
broadcast only if its written size is under the session's threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docfold.llm.columns import fresh, uniform, word_count
from docfold.scratch import Scratch

WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2.0, "mix-1"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source: size, weight and target; sizes has the columns source and size.

    Targets are the level that fills ``share`` of all words by weight where no source takes more than ``most`` times
    its size; resharing the excess until none is above ends at just this level.  Windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.array(*map(F.lit, weights))[(rank % len(weights)).cast("int")].cast("double")
    cap = F.lit(most) * F.col("source_size")
    ordered = Window.orderBy("full", F.col("source").asc_nulls_last())
    level = (F.lit(share) * F.sum("source_size").over(every) - (F.sum("cap").over(ordered) - F.col("cap"))) / (F.sum("weight").over(every) - F.sum("weight").over(ordered) + F.col("weight"))
    filled = (
        per.withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("full", F.col("cap") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("full"), F.struct("full", "source", "level"))).over(every)["level"])
    )
    target = F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("weight")), F.col("cap"))
    return filled.select("source", "source_size", "weight", target.alias("target"))


def copies(rate: Column, key: Column, seed: str = SEED) -> Column:
    """floor(rate), and one more with the probability of the fraction."""
    whole = F.floor(rate)
    return (whole + (uniform(key, seed) < rate - whole).cast("long")).cast("long")


def _rates(sizes: DataFrame, scratch: Scratch, **shares) -> DataFrame:
    targets = source_targets(sizes, **shares)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return scratch.write(targets.withColumn("rate", F.least(rate, F.lit(float(shares.get("most", MOST))))), "targets")


def _sized(docs: DataFrame, text_col: str, source_col: str, id_col: str | None = None) -> DataFrame:
    return docs.select(*([F.col(id_col)] if id_col else []), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))


def mixed_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, **shares) -> DataFrame:
    """Per row what the mix takes of it: size, source_size, target, taken and copies."""
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = scratch.write(_sized(docs, text_col, source_col, id_col), "sizes")
    rates = _rates(sizes, scratch, **shares).withColumnRenamed("source", "of")
    n = copies(F.col("rate"), F.col(id_col), seed)
    joined = sizes.join(rates, F.col("source").eqNullSafe(F.col("of")))
    return joined.select(id_col, "source", "size", "source_size", "target", (n * F.col("size")).alias("taken"), n.alias("copies"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, **shares) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the columns of ``docs``."""
    rates = _rates(_sized(docs, text_col, source_col), Scratch(docs.sparkSession, "mixing"), **shares)
    of, rate, copy = (fresh(docs, x) for x in ("mix_of", "mix_rate", "mix_copy"))
    rates = rates.select(F.col("source").alias(of), F.col("rate").alias(rate))
    joined = docs.join(rates, docs[source_col].eqNullSafe(F.col(of)))
    repeated = F.explode(F.array_repeat(F.lit(1), copies(F.col(rate), F.col(id_col), seed).cast("int")))
    return joined.select(*(docs[c] for c in docs.columns), repeated.alias(copy)).drop(copy)
