"""Structured Streaming jobs; each runs all that is there and stops, for an outside scheduler to start again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docfold.operators.relational import first_by
from docfold.operators.versioning import added_versions, change_detect

VERSIONS = "regulation_id long, version_no long, content_text string, content_hash string, status string, change_summary string, created_at timestamp"


def _folders(spark: SparkSession, root: str, kind: str) -> list[int]:
    """The numbers of the folders ``kind=number`` below ``root`` that were written to their end."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/_SUCCESS")))


def _appended(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """The versions that batches before ``batch`` have added: those of the last folder of gathered ones, and of each batch since."""
    until = [n for n in _folders(spark, root, "until") if n < batch]
    gathered = max(until, default=-1)  # until=-1 has what there was before the first batch
    paths = [f"{root}/until={gathered}"] * bool(until) + [f"{root}/batch={b}" for b in _folders(spark, root, "batch") if gathered < b < batch]
    return spark.read.schema(VERSIONS).parquet(*paths) if paths else spark.createDataFrame([], VERSIONS)


def gather_versions(spark: SparkSession, root: str) -> None:
    """Gathers what all batches so far have added in one folder, for later reads; folders of before may then be deleted."""
    if done := _folders(spark, root, "batch"):
        _appended(spark, root, done[-1] + 1).write.mode("overwrite").parquet(f"{root}/until={done[-1]}")


def versions_at(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """The version table as it was before a batch: of each document the newest version is the active one."""
    rows = _appended(spark, root, batch)
    newest = F.max("version_no").over(Window.partitionBy("regulation_id"))
    return rows.withColumn("status", F.when(F.col("version_no") == newest, "active").otherwise("inactive"))


def version_stream(docs: DataFrame, root: str, checkpoint: str, at: Column | str) -> StreamingQuery:
    """Keeps one active version a document: a stream of (id, text, seen) against the versions below ``root``.

    A batch writes what it adds to a folder of its own, so a batch that is run again reads and writes the same, and reads no more of the
    history than numbers and hashes.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now = _appended(spark, root, number).groupBy("regulation_id").agg(F.max_by("content_hash", "version_no").alias("content_hash"), F.max("version_no").alias("last"))
        last = first_by(batch, ["id"], F.col("seen").desc(), F.col("text")).withColumn("content_hash", F.md5("text"))
        stored = now.select(F.col("regulation_id").alias("id"), "content_hash")
        found = change_detect(last, stored).select(F.col("id").alias("regulation_id"), F.col("text").alias("content_text"), "content_hash", "monitoring_status")
        added_versions(found, now.select("regulation_id", "last"), at).write.mode("overwrite").parquet(f"{root}/batch={number}")

    return docs.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _marked(events: DataFrame, late: str) -> DataFrame:
    """A stream with a watermark, which asks for a timestamp with a zone; a table as it is."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def event_counts(events: DataFrame, every: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Events per type and window; works on streams and tables."""
    e = _marked(events, late)
    return e.groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("n"))


def event_sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    e = _marked(events, late)
    return e.groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n"))


def current_status(log: DataFrame, keys: list[str], expected: DataFrame) -> DataFrame:
    """The last status of each expected key, ``NOT_STARTED`` where there is none."""
    last = first_by(log, keys, F.col("id").desc())
    return expected.join(last, keys, "left").withColumn("status", F.coalesce("status", F.lit("NOT_STARTED")))


def due_jobs(schedule: DataFrame, running: DataFrame, now: Column, grace: str = "INTERVAL 6 HOURS") -> DataFrame:
    """The earliest pending job of each source that is due, unless the source runs already; ``missed`` if it is later than the grace."""
    due = schedule.where((F.col("status") == "PENDING") & (F.col("run_at") <= now)).join(running.select("source").distinct(), "source", "left_anti")
    late = F.col("run_at") < now - F.expr(grace)
    return due.groupBy("source").agg(F.min(F.struct("run_at", "job_id", late.alias("missed"))).alias("x")).select("source", "x.job_id", "x.run_at", "x.missed")


def stale_runs(log: DataFrame, now: Column, beat: str = "INTERVAL 15 MINUTES") -> DataFrame:
    """Runs that say RUNNING but whose heartbeat is older than three beats."""
    return log.where((F.col("status") == "RUNNING") & (F.col("last_heartbeat") < now - F.expr(beat)))
