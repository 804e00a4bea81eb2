"""The tables of a folder, and how they stand for domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a task nests, sorts and counts at once.
ROWS_A_TASK = 250_000


class Tables:
    """Parquet tables of one folder; reading is lazy, so columns and filters reach the scan."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self(name)

    def stream(self, name: str) -> DataFrame:
        """The table as a stream of its files; the braces make a pattern of the name, as a stream takes no single file."""
        return self.spark.readStream.schema(self(name).schema).parquet(f"{self.path}/{{{name}}}.parquet")

    def parts(self, *names: str) -> int:
        """Partitions for the rows of these tables, so many that what a task holds stays the same as they grow; a count reads no columns."""
        rows = sum(self(name).count() for name in names)
        return max(self.spark.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK))

    def requirements(self) -> DataFrame:
        """Orders as requirements: criticality from priority, empty where the priority says nothing."""
        level = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "High").when(F.col("o_orderpriority") == "3-MEDIUM", "Medium").when(F.col("o_orderpriority") == "5-LOW", "Low")
        return self.orders.select(F.col("o_custkey").alias("regulation_id"), F.col("o_orderkey").alias("requirement_id"), level.alias("criticality"))

    def obligations(self) -> DataFrame:
        """Line items as obligations: match and coverage status from the return flag."""
        flag = F.col("l_returnflag")
        match = F.when(flag == "A", "fully_matched").when(flag == "N", "partially_matched").otherwise("new")
        cover = F.when(flag == "A", "covered").when(flag == "N", "partial").otherwise("missing")
        return self.lineitem.select(
            F.col("l_orderkey").alias("requirement_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
            F.col("l_quantity").alias("quantity"), match.alias("match_status"), cover.alias("coverage_status"),
        )

    def stored_snapshot(self) -> DataFrame:
        """Labelled documents as those stored before; where quality is 0 the stored hash differs."""
        return self.labels.join(self.documents, "doc_id").select(F.col("doc_id").alias("id"), F.md5(F.when(F.col("quality") == 0, F.concat("text", F.lit("~"))).otherwise(F.col("text"))).alias("content_hash"))

    def snapshot(self) -> DataFrame:
        return self.documents.select(F.col("doc_id").alias("id"), "text", F.md5("text").alias("content_hash"))
