"""One query per operator over its whole table, with production parameters, and the SQL that must agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docfold.llm import extraction, langid, lattice, manifest, maxscore, mixing, neardup, packing, quality, repeats, templates, trie, vptree

TABLES = ("documents", "embeddings", "pages")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=3, threshold=85)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.held_out_languages(table(spark, sf_dir, "documents"))


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = templates.without_templates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.md5("kept_text").alias("kept_md5"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op6_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_bytes")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op8_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score_texts(table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_vantage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_max_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_language_id, op3_line_templates, op4_best_fit_packing, op5_main_text, op6_remove_repeats, op7_quality_rules, op8_lattice_scores, op9_mix_sources, op10_vantage_search, op11_prefix_trie, op12_max_score, op13_merkle_manifest)}
