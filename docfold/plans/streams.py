"""Streams over the driver's tables, run to their end, and the tables that they have written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.plans.catalog import query
from docfold.plans.changes import AT, _CHANGES, _STORED, _versions
from docfold.scratch import Scratch
from docfold.sources.tables import Tables
from docfold.streaming import jobs, keyed

_SILENCE = 6 * 3_600_000


@query("Q5 Q4 N2 N3", f"""SELECT id AS regulation_id, CASE monitoring_status WHEN 'new' THEN 1 ELSE 2 END::BIGINT AS version_no, h AS content_hash, 'active' AS status, CASE monitoring_status WHEN 'new' THEN 'Initial crawl' ELSE 'Content changed' END AS change_summary
  FROM {_CHANGES} WHERE monitoring_status <> 'unchanged'
  UNION ALL SELECT s.id, 1, stored_hash, CASE c.monitoring_status WHEN 'modified' THEN 'inactive' ELSE 'active' END, 'Initial crawl' FROM {_STORED} s JOIN {_CHANGES} c ON c.id = s.id""")  # fmt: skip
def version_state(t: Tables) -> DataFrame:
    """Documents as a stream against versions in the state store, which starts from those stored before."""
    scratch = Scratch(t.spark, "version-state")
    docs = t.stream("documents").select(F.col("doc_id").alias("id"), "text", F.lit(AT).cast("timestamp").alias("seen"))
    root = scratch.path("versions")
    keyed.versions_by_state(docs, root, scratch.path("checkpoint"), _versions(t)).awaitTermination()
    return jobs.versions_at(t.spark, root, 1 << 31).select("regulation_id", "version_no", "content_hash", "status", "change_summary")


@query("Q3", f"""WITH b AS (SELECT user_id AS run, epoch_us(ts) // 1000 AS ms, event_type = 'purchase' AS done FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
  n AS (SELECT *, lag(ms) OVER w AS before, lag(done) OVER w AS ended FROM b WINDOW w AS (PARTITION BY run ORDER BY ms, done)),
  s AS (SELECT *, sum(CASE WHEN before IS NULL OR ended OR ms >= before + {_SILENCE} THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY ms, done ROWS UNBOUNDED PRECEDING) AS k FROM n),
  r AS (SELECT run, min(ms) AS started, max(ms) AS last, count(*) AS beats, bool_or(done) AS done FROM s GROUP BY run, k)
  SELECT run, started, last, beats, CASE WHEN done THEN last ELSE last + {_SILENCE} END AS ended, CASE WHEN done THEN 'DONE' ELSE 'FAILED' END AS status
  FROM r WHERE done OR last + {_SILENCE} <= (SELECT max(ms) FROM b)""")  # fmt: skip
def silent_runs(t: Tables) -> DataFrame:
    """Users as runs and their events as heartbeats: a run ends with a purchase, or is given up when a timer finds it silent."""
    scratch = Scratch(t.spark, "silent-runs")
    beats = t.stream("events").select(F.col("user_id").alias("run"), "ts", (F.col("event_type") == "purchase").alias("done"))
    outcomes, path = keyed.run_outcomes(beats, _SILENCE), scratch.path("outcomes")
    outcomes.writeStream.format("parquet").option("path", path).option("checkpointLocation", scratch.path("checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.schema(outcomes.schema).parquet(path)
