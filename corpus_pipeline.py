"""From raw documents to packed training sequences.

Each stage takes the documents that the one before it left and returns them with the same columns; the last returns the
pieces of documents with their bins.

Every stage takes nulls in any column, empty and very long texts, repeated rows, empty tables and more columns than it
reads, whatever their names; an empty table gives an empty table of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docfold.llm import mixing, neardup, packing, quality, templates


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table rejects go.  A null or empty text has no words and goes; repeated rows are judged alike."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go; a document goes only if nothing is left of it.

    A null text stays null, and a text without words as it is; equal rows are one document and lose the same lines.
    """
    return templates.drop_templates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8) the document with the smallest id stays.

    Texts without words are no copies and stay.  Equal rows stay once.  Where ids are missing or repeated, rows are told apart by a hash of
    id and text, and which of a group stays is decided by that hash, the same in every run.
    """
    return neardup.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes as often as the mix takes it: floor(rate) times and once more by a hash of its id.

    A null source is a source, ranked last; a source without words is not taken; rows of one id are decided alike.
    """
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces with their places in sequences of permitted lengths.

    A document without words comes once, in no bin; rows of one id and length are copies, numbered from 0; a missing id is an id.
    """
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: SQL expresses neither the chosen-path join nor best-fit packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
