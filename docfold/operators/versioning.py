"""Change detection by hash and version history with one active version a document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docfold.operators.relational import first_by


def change_detect(incoming: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """``monitoring_status`` new, modified or unchanged, by the hashes of two snapshots; both have ``content_hash``."""
    old = stored.select(key, F.col("content_hash").alias("stored_hash"))
    status = F.when(F.col("stored_hash").isNull(), "new").when(F.col("stored_hash") != F.col("content_hash"), "modified").otherwise("unchanged")
    return incoming.join(old, key, "left").withColumn("monitoring_status", status)


def next_versions(changed: DataFrame, versions: DataFrame, at) -> DataFrame:
    """The version table after a batch: every change gets a new active version and deactivates the one before.

    ``changed`` has regulation_id, content_text, content_hash and monitoring_status; unchanged rows do nothing.  The result replaces the
    table in one write, so no reader sees two active versions.
    """
    last = versions.groupBy("regulation_id").agg(F.max("version_no").alias("last"))
    added = added_versions(changed, last, at)
    hit = added.select("regulation_id", F.lit(True).alias("__hit")).distinct()
    old = versions.join(hit, "regulation_id", "left").withColumn("status", F.when(F.col("__hit") & (F.col("status") == "active"), "inactive").otherwise(F.col("status"))).drop("__hit")
    return old.select(added.columns).unionByName(added)


def added_versions(changed: DataFrame, last: DataFrame, at) -> DataFrame:
    """The new active versions that a batch makes, numbered after ``last`` (regulation_id, last)."""
    new = changed.where("monitoring_status in ('new', 'modified')")
    return new.join(last, "regulation_id", "left").select(
        "regulation_id",
        (F.coalesce("last", F.lit(0)) + 1).cast("long").alias("version_no"),
        "content_text",
        "content_hash",
        F.lit("active").alias("status"),
        F.when(F.col("monitoring_status") == "new", "Initial crawl").otherwise("Content changed").alias("change_summary"),
        F.lit(at).cast("timestamp").alias("created_at"),
    )


def latest_active(versions: DataFrame) -> DataFrame:
    """The newest active version of each document."""
    return first_by(versions.where("status = 'active'"), ["regulation_id"], F.col("created_at").desc(), F.col("version_no").desc())


def history(versions: DataFrame, analysis: DataFrame) -> DataFrame:
    """Versions newest first, each with how many analysis rows it has and when the first was made."""
    per = analysis.groupBy("regulation_id", "version_no").agg(F.count("*").alias("n_rows"), F.min("created_at").alias("analysed_at"))
    out = versions.join(per, ["regulation_id", "version_no"], "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    newest = Window.partitionBy("regulation_id").orderBy(F.col("version_no").desc())
    return out.withColumn("age", F.row_number().over(newest) - 1)


def initial_versions(documents: DataFrame, at) -> DataFrame:
    """First versions of documents that have none."""
    base = documents.withColumn("monitoring_status", F.lit("new"))
    empty = documents.sparkSession.createDataFrame([], "regulation_id long, version_no long, content_text string, content_hash string, status string, change_summary string, created_at timestamp")
    return next_versions(base, empty, at)
