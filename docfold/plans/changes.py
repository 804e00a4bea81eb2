"""Versions, change detection and table mutations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.functions import structured, text
from docfold.operators import mutations as M
from docfold.operators import versioning as V
from docfold.operators.relational import first_by
from docfold.plans.catalog import query
from docfold.sources.tables import Tables
from docfold.streaming import jobs

AT = "2024-01-01 00:00:00"
_STORED = "(SELECT doc_id AS id, md5(CASE WHEN quality = 0 THEN text || '~' ELSE text END) AS stored_hash FROM labels JOIN documents USING (doc_id))"
_CHANGES = f"(SELECT doc_id AS id, text, md5(text) AS h, CASE WHEN stored_hash IS NULL THEN 'new' WHEN stored_hash <> md5(text) THEN 'modified' ELSE 'unchanged' END AS monitoring_status FROM documents LEFT JOIN {_STORED} ON id = doc_id)"


@query("N1 D22 H8 U2", f"SELECT id, monitoring_status FROM {_CHANGES}")
def change_detect(t: Tables) -> DataFrame:
    return V.change_detect(t.snapshot(), t.stored_snapshot()).select("id", "monitoring_status")


def _versions(t: Tables) -> DataFrame:
    return t.stored_snapshot().select(
        F.col("id").alias("regulation_id"), F.lit(1).cast("long").alias("version_no"), F.lit(None).cast("string").alias("content_text"), "content_hash",
        F.lit("active").alias("status"), F.lit("Initial crawl").alias("change_summary"), F.lit("2023-01-01").cast("timestamp").alias("created_at"),
    )


@query("N2 N3 B5 Q5", f"""SELECT id AS regulation_id, CASE monitoring_status WHEN 'new' THEN 1 ELSE 2 END::BIGINT AS version_no, h AS content_hash, 'active' AS status, CASE monitoring_status WHEN 'new' THEN 'Initial crawl' ELSE 'Content changed' END AS change_summary
  FROM {_CHANGES} WHERE monitoring_status <> 'unchanged'
  UNION ALL SELECT s.id, 1, stored_hash, CASE c.monitoring_status WHEN 'modified' THEN 'inactive' ELSE 'active' END, 'Initial crawl' FROM {_STORED} s JOIN {_CHANGES} c ON c.id = s.id""")  # fmt: skip
def scd2_apply(t: Tables) -> DataFrame:
    changed = V.change_detect(t.snapshot(), t.stored_snapshot()).select(F.col("id").alias("regulation_id"), F.col("text").alias("content_text"), "content_hash", "monitoring_status")
    return V.next_versions(changed, _versions(t), AT).select("regulation_id", "version_no", "content_hash", "status", "change_summary")


@query("F1 D5 N4", f"SELECT id AS regulation_id, CASE monitoring_status WHEN 'modified' THEN 2 ELSE 1 END::BIGINT AS version_no, h AS content_hash FROM {_CHANGES}")
def active_versions(t: Tables) -> DataFrame:
    changed = V.change_detect(t.snapshot(), t.stored_snapshot()).select(F.col("id").alias("regulation_id"), F.col("text").alias("content_text"), "content_hash", "monitoring_status")
    return V.latest_active(V.next_versions(changed, _versions(t), AT)).select("regulation_id", "version_no", "content_hash")


@query("B6", "SELECT doc_id, CASE WHEN source = 'src1' AND lang = 'en' THEN 'inactive' WHEN lang = 'en' THEN 'active' ELSE 'draft' END AS status FROM documents")
def deactivate_versions(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "source", F.when(F.col("lang") == "en", "active").otherwise("draft").alias("status"))
    return M.set_status(rows, F.col("source") == "src1", "active", "inactive").select("doc_id", "status")


@query("B7", "SELECT CASE WHEN o_orderstatus = 'O' THEN 'history' ELSE 'head' END AS place, o_orderkey, o_custkey FROM orders")
def archive_current(t: Tables) -> DataFrame:
    head, history = M.archived(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), F.col("o_orderstatus") == "O")
    return head.select(F.lit("head").alias("place"), "o_orderkey", "o_custkey").unionByName(history.select(F.lit("history").alias("place"), "o_orderkey", "o_custkey"))


@query("B2 B3 B4", "SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'xx' ELSE d.lang END AS lang, coalesce('src' || l.quality, d.source) AS source FROM documents d LEFT JOIN labels l USING (doc_id)")
def patch_update(t: Tables) -> DataFrame:
    changes = t.labels.select("doc_id", F.when(F.col("toxic") == 1, "xx").alias("lang"), F.concat(F.lit("src"), "quality").alias("source"))
    return M.patch(t.documents.select("doc_id", "lang", "source"), changes, "doc_id")


@query("B12 B13", """SELECT c_custkey, c_name, 'PENDING' AS status FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT c_custkey, c_name, 'DONE' FROM customer WHERE c_mktsegment <> 'BUILDING'
  UNION ALL SELECT -1 - s_suppkey, s_name, 'PENDING' FROM supplier""")  # fmt: skip
def merge_upsert(t: Tables) -> DataFrame:
    base = t.customer.select("c_custkey", "c_name", F.lit("DONE").alias("status"))
    changes = t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name", F.lit("PENDING").alias("status"))
    changes = changes.unionByName(t.supplier.select((-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit("PENDING").alias("status")))
    return M.upsert(base, changes, ["c_custkey"])


@query("B14 P4", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def delete_by_keys(t: Tables) -> DataFrame:
    gone = t.customer.where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return M.delete(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), gone, ["o_custkey"])


@query("B15", """SELECT 'orders' AS "table", count(*) AS deleted FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
  UNION ALL SELECT 'customer', count(*) FROM customer WHERE c_acctbal < 0""")  # fmt: skip
def delete_counts(t: Tables) -> DataFrame:
    gone = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("k"))
    tables = {"orders": t.orders.withColumn("k", F.col("o_custkey")), "customer": t.customer.withColumn("k", F.col("c_custkey"))}
    return M.delete_counted(tables, gone, ["k"])[1]


@query("B10", "SELECT p_partkey, CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'N') THEN 1 ELSE 0 END AS is_suggested FROM part")
def flag_partial(t: Tables) -> DataFrame:
    ids = t.lineitem.where("l_returnflag = 'N'").select(F.col("l_partkey").alias("p_partkey"))
    return M.mark(t.part.select("p_partkey", F.lit(0).alias("is_suggested")), ids, "p_partkey", "is_suggested")


@query("B1 B8 B9 B11", "SELECT count(*) AS n, min(id) AS first_id, max(id) AS last_id, count(DISTINCT id) AS n_ids, max(length(title))::BIGINT AS longest FROM (SELECT 1000 + row_number() OVER () AS id, left(text, 500) AS title FROM benchmark)")
def insert_with_keys(t: Tables) -> DataFrame:
    new = t.benchmark.select(F.substring("text", 1, 500).alias("title"), F.coalesce(F.lit(None).cast("string"), F.lit("R")).alias("type"), "item_id")
    made = M.with_keys(new, "id", 1000, F.col("item_id"))
    return made.agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.countDistinct("id").alias("n_ids"), F.max(F.length("title")).cast("long").alias("longest"))


@query("B21", "SELECT DISTINCT path, title, depth FROM (SELECT source AS path, source AS title, 1 AS depth FROM documents UNION ALL SELECT source || '/' || lang, lang, 2 FROM documents) WHERE path <> 'src0'")
def category_paths(t: Tables) -> DataFrame:
    docs = t.documents.select(F.array("source", "lang").alias("doc_path"))
    there = t.spark.createDataFrame([(["src0"],)], "path array<string>")
    new = M.missing_categories(docs, "doc_path", there)
    return new.select(F.array_join("path", "/").alias("path"), "title", "depth")


@query("C13 C23", """SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL AND quality = 0 THEN 'update' WHEN l.doc_id IS NOT NULL THEN 'existing' WHEN lang = 'es' THEN 'exempt' WHEN length(text) < 200 THEN 'skipped' ELSE 'new' END AS route,
  len(string_split(source || '/' || lang, '/')) >= 2 AS deep_enough FROM documents d LEFT JOIN labels l USING (doc_id)""")  # fmt: skip
def route_documents(t: Tables) -> DataFrame:
    known = t.labels.select("doc_id", "quality", F.lit(True).alias("known"))
    path = F.array("source", "lang")
    route = F.when(F.col("known") & (F.col("quality") == 0), "update").when(F.col("known"), "existing").when(F.col("lang") == "es", "exempt").when(~text.at_least(F.col("text"), 200), "skipped").otherwise("new")
    return t.documents.join(known, "doc_id", "left").select("doc_id", route.alias("route"), (F.size(path) >= 2).alias("deep_enough"))


@query("H3 F9", r"SELECT min(doc_id) AS doc_id, md5(trim(regexp_replace(lower(text), '\s+', ' ', 'g'), ' .,:;!?')) AS h FROM documents GROUP BY 2")
def dedup_normalized(t: Tables) -> DataFrame:
    keyed = t.documents.select("doc_id", F.md5(text.normalize_text(F.col("text"))).alias("h"))
    return first_by(keyed, ["h"], F.col("doc_id"))


@query("Q6", "SELECT user_id, count(*) AS n, count(*) FILTER (value < 50) AS errors, max(event_id) AS last_id FROM events GROUP BY 1")
def processing_log(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("value") < 50).alias("errors"), F.max("event_id").alias("last_id"))


@query("B1 B8 K2 K7", """SELECT doc_id, 'Titre é ' || doc_id AS title, '["' || source || '","' || lang || '"]' AS doc_path_json, '{"content_text":"t' || doc_id || '"}' AS extra_meta_json, CASE WHEN doc_id % 2 = 0 THEN 'u' || doc_id END AS urdu_url,
  true AS keyed FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL""")  # fmt: skip
def insert_documents(t: Tables) -> DataFrame:
    """Documents with keys, paths and extra fields as JSON, and the local address in a column of its own."""
    k = F.col("doc_id").cast("string")
    meta = F.struct(F.concat(F.lit("t"), k).alias("content_text"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("u"), k)).alias("urdu_url"))
    docs = t.documents.where("source is not null and lang is not null").select("doc_id", F.concat(F.lit("Titre é "), k).alias("title"), F.array("source", "lang").alias("doc_path"), meta.alias("extra_meta"))
    made = M.insert_documents(docs, 500, F.col("doc_id"))
    return made.select("doc_id", "title", "doc_path_json", "extra_meta_json", "urdu_url", (F.col("id") > 500).alias("keyed"))


@query("B17", "SELECT count(*) AS rows_affected FROM orders WHERE o_custkey = 7 AND o_orderstatus = 'O'")
def status_rows_affected(t: Tables) -> DataFrame:
    """How many rows a change of status finds."""
    return M.set_status_counted(t.orders, F.col("o_custkey") == 7, "O", "F", "o_orderstatus")[1]


@query("P3 P1 U22", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'cached ' ELSE 'made ' END || lang AS answer FROM documents")
def cache_read_through(t: Tables) -> DataFrame:
    """Answers from the cache, and for the rest made once for each key."""
    asked = t.documents.select("doc_id", (F.col("doc_id") % 3).alias("part"), "lang")
    cache = t.documents.where("doc_id % 3 = 0").select(F.lit(0).cast("long").alias("part"), "lang", F.concat(F.lit("cached "), "lang").alias("answer")).distinct()
    answers, _ = structured.read_through(asked, cache, ["part", "lang"], lambda rest: rest.withColumn("answer", F.concat(F.lit("made "), "lang")))
    return answers.select("doc_id", "answer")


@query("P2 K14 P1", "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'BÂTIMENT' ELSE c_mktsegment END AS category, c_name AS title, ' ' AS department, c_mktsegment AS status FROM customer")
def translate_records(t: Tables) -> DataFrame:
    """What people read of a record is translated, codes and blanks are not."""
    dictionary = t.spark.createDataFrame([("BUILDING", "BÂTIMENT"), (" ", "x")], "source string, target string")
    docs = t.customer.select("c_custkey", F.col("c_mktsegment").alias("category"), F.col("c_name").alias("title"), F.lit(" ").alias("department"), F.col("c_mktsegment").alias("status"))
    return structured.translated(docs, "regulation", "c_custkey", dictionary)


@query("Q1 Q2 G6", """WITH n AS (SELECT max(ts) - INTERVAL 12 HOUR AS now FROM events), r AS (SELECT DISTINCT event_type FROM events WHERE event_type = (SELECT min(event_type) FROM events)),
  d AS (SELECT event_type, min((ts, event_id)) AS x FROM events, n WHERE value >= 50 AND ts <= now AND event_type NOT IN (SELECT event_type FROM r) GROUP BY 1)
  SELECT event_type AS source, x[2] AS job_id, x[1] < now - INTERVAL 6 HOUR AS missed FROM d, n""")  # fmt: skip
def due_jobs(t: Tables) -> DataFrame:
    """The next job of each source that is due and not running, and whether it comes too late."""
    now = t.events.agg((F.max("ts").cast("timestamp") - F.expr("INTERVAL 12 HOURS")).alias("now"))
    schedule = t.events.select(F.col("event_type").alias("source"), F.col("event_id").alias("job_id"), F.col("ts").cast("timestamp").alias("run_at"), F.when(F.col("value") < 50, "DONE").otherwise("PENDING").alias("status"))
    running = t.events.agg(F.min("event_type").alias("source"))
    return jobs.due_jobs(schedule.join(F.broadcast(now)), running, F.col("now")).select("source", "job_id", "missed")  # one row
