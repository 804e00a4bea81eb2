"""Jobs that store what they make, over the given tables; the queries read it back."""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.operators import workflows as W
from docfold.plans.catalog import query
from docfold.plans.changes import AT
from docfold.plans.relational import STAMP, stamp
from docfold.plans.workflows import PROVIDER, _sentences
from docfold.scratch import Scratch
from docfold.sources import stored, uploads
from docfold.sources.tables import Tables

HOST = "https://regulator.example"
_CAME = f"""(SELECT *, usable AND NOT late AS first, CASE WHEN late THEN changed ELSE text END AS stored_text, usable AND NOT late AND mine AND changed <> text AS again
  FROM (SELECT doc_id, coalesce(text, '') AS text, coalesce(text || CASE WHEN doc_id % 6 = 1 THEN '~' ELSE '' END, '') AS changed, doc_id % 4 < 2 AS mine, doc_id % 7 = 0 AS returns, doc_id % 3 = 0 AS late,
    CASE WHEN doc_id % 4 < 2 THEN doc_id % 13 <> 0 ELSE doc_id % 5 <> 0 OR doc_id % 7 = 0 END AS usable, coalesce(source, '-') AS source, coalesce(lang, '-') AS lang FROM documents))"""


@query("O11 N2 N3 B1 B5 B18 B21 C13 Q6", f"""WITH c AS {_CAME}, v AS (SELECT doc_id, 1 AS n, stored_text AS text FROM c WHERE usable AND mine AND NOT returns UNION ALL SELECT doc_id, CASE WHEN returns THEN 1 ELSE 2 END, changed FROM c WHERE again)
  SELECT 'document' AS kind, 'T' || doc_id AS a, md5(stored_text) AS b, 1 AS n FROM c WHERE usable
  UNION ALL SELECT DISTINCT 'category', source, '1', 1 FROM c WHERE usable UNION ALL SELECT DISTINCT 'category', source || '/' || lang, '2', 1 FROM c WHERE usable
  UNION ALL SELECT 'version', 'T' || doc_id, CASE WHEN n = max(n) OVER (PARTITION BY doc_id) THEN 'active ' ELSE 'inactive ' END || md5(text), n FROM v
  UNION ALL SELECT 'log', batch::VARCHAR, action, count(*) FROM (
    SELECT 1 AS batch, CASE WHEN NOT usable THEN 'skip' WHEN returns THEN 'insert_only' WHEN mine THEN 'insert_version' ELSE 'insert' END AS action FROM c WHERE NOT late
    UNION ALL SELECT 2, CASE WHEN NOT usable THEN 'skip' WHEN again THEN 'update_version' WHEN first THEN 'existing' WHEN returns THEN 'insert_only' WHEN mine THEN 'insert_version' ELSE 'insert' END FROM c) GROUP BY 2, 3""")  # fmt: skip
def ingest_tables(t: Tables) -> DataFrame:
    """Two batches of crawled documents, the second with texts that have changed, and all tables that they leave."""
    k = F.col("doc_id")
    name = F.concat(F.lit("T"), k.cast("string"))
    record = [
        F.when(k % 4 < 2, "R1").otherwise("R2").alias("regulator"), F.when(k % 7 == 0, "Regulatory Returns").otherwise("Circular").alias("category"), F.lit("TABLES").alias("source_system"), F.when(k % 5 != 0, "01/02/2020").alias("published_date"),
        name.alias("title"), F.array(F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-"))).alias("doc_path"), F.when(k % 13 != 0, F.concat(F.lit(HOST + "/"), k.cast("string"))).alias("source_page_url"),
    ]
    store = stored.Batches(t.spark, Scratch(t.spark, "ingest").path("tables"))
    W.ingest_batch(store, 1, t.documents.where(k % 3 != 0).select(*record, F.col("text").alias("content_text")), "R1", AT)
    W.ingest_batch(store, 2, t.documents.select(*record, F.concat("text", F.when(k % 6 == 1, "~").otherwise("")).alias("content_text")), "R1", AT)
    docs, categories, versions, log = (store.read(table, schema) for table, schema in W.STORED.items())
    newest = versions.groupBy("regulation_id").agg(F.max("version_no").alias("newest"))
    named = versions.join(newest, "regulation_id").join(docs.select(F.col("id").alias("regulation_id"), "title"), "regulation_id")
    status = F.when(F.col("version_no") == F.col("newest"), "active ").otherwise("inactive ")
    one = F.lit(1).cast("long")
    parts = [
        docs.select(F.lit("document").alias("kind"), F.col("title").alias("a"), F.col("content_hash").alias("b"), one.alias("n")),
        categories.select(F.lit("category").alias("kind"), F.array_join("path", "/").alias("a"), F.col("depth").cast("string").alias("b"), one.alias("n")),
        named.select(F.lit("version").alias("kind"), F.col("title").alias("a"), F.concat(status, "content_hash").alias("b"), F.col("version_no").alias("n")),
        log.groupBy(F.lit("log").alias("kind"), F.col("batch").cast("string").alias("a"), F.get_json_object("details", "$.action").alias("b")).agg(F.count("*").alias("n")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("B12 B13 B14", """SELECT c_custkey, c_name, 'PENDING' AS status FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 10 <> 3 UNION ALL SELECT c_custkey, c_name, 'DONE' FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_custkey % 10 <> 3
  UNION ALL SELECT -1 - s_suppkey, s_name, 'PENDING' FROM supplier""")  # fmt: skip
def bucketed_merge(t: Tables) -> DataFrame:
    """A stored schedule that is merged into, and of which keys are deleted, bucket by bucket."""
    table = stored.Buckets(t.spark, Scratch(t.spark, "schedule").path("table"), "c_custkey long, c_name string, status string", ["c_custkey"], 16)
    table.upsert(t.customer.select("c_custkey", "c_name", F.lit("DONE").alias("status")))
    changes = t.customer.where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name", F.lit("PENDING").alias("status"))
    table.upsert(changes.unionByName(t.supplier.select((-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"), F.lit("PENDING").alias("status"))))
    table.remove(t.customer.where("c_custkey % 10 = 3").select("c_custkey"))
    return table.read()


_TEXTS = "(SELECT doc_id, text || ' with that one. with them.' AS text FROM documents WHERE doc_id % 5 = 0)"


@query("N6 B16 O18", f"""SELECT doc_id AS regulation_id, 2 AS version_no, 'REQ-001' AS requirement_id, count(*) AS n_obligations FROM {_sentences(_TEXTS, least=100)} GROUP BY 1
  UNION ALL SELECT doc_id, v, 'old', 0 FROM documents, (VALUES (1), (2)) AS w(v) WHERE NOT (v = 2 AND doc_id % 5 = 0 AND doc_id IN (SELECT doc_id FROM {_sentences(_TEXTS, least=100)}))""")  # fmt: skip
def analysed_version(t: Tables) -> DataFrame:
    """The rows of one version of some documents are made again by an analysis; those of other versions and documents stay."""
    table = stored.Buckets(t.spark, Scratch(t.spark, "analysis").path("table"), "regulation_id long, version_no long, requirement_id string, n_obligations long", ["regulation_id", "version_no"], 16)
    old = t.documents.select(F.col("doc_id").alias("regulation_id"), F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("version_no"), F.lit("old").alias("requirement_id"), F.lit(0).cast("long").alias("n_obligations"))
    table.upsert(old)
    versions = t.documents.where("doc_id % 5 = 0").select(F.col("doc_id").alias("regulation_id"), F.lit(2).alias("version_no"), F.concat("text", F.lit(" with that one. with them.")).alias("content_text"))
    W.analyse_version(table, versions, 2, PROVIDER)
    return table.read()


@query("A12 F7 J7", f"SELECT event_id, {STAMP.format('ts')} AS ts FROM events WHERE events.ts >= (SELECT date_trunc('day', max(ts)) - INTERVAL 1 DAY FROM events)")
def incremental_days(t: Tables) -> DataFrame:
    """What came since the day before the newest, of a table kept by days; folders of older days are not read."""
    root = Scratch(t.spark, "days").path("events")
    stored.write_days(t.events.select("event_id", "ts"), root, "ts")
    return stored.since_mark(t.spark, root, "event_id long, ts timestamp_ntz").select("event_id", stamp("ts").alias("ts"))


def _write_uploads(root: str):
    """Writes a file for each row (filename, kind, text) and gives its name: DOCX, one that is cut off, or plain text."""

    def write(batches):
        system, folder = fs.FileSystem.from_uri(root)
        system.create_dir(folder, recursive=True)
        for batch in batches:
            for name, kind, text in zip(*(batch[c].to_pylist() for c in ("filename", "kind", "text")), strict=True):
                content = uploads.docx_bytes(text.split("\n")) if kind != "txt" else text.encode()
                with system.open_output_stream(f"{folder}/{name}") as f:
                    f.write(content[: len(content) // 2] if kind == "cut" else content)
            yield pa.RecordBatch.from_arrays([batch["filename"]], ["filename"])

    return write


_PLAIN = r"regexp_replace(coalesce(text, ''), '[\x00-\x09\x0B-\x1F]', ' ', 'g')"
_ROWS = f"(SELECT doc_id, 'file_' || doc_id || CASE doc_id % 4 WHEN 2 THEN '.txt' WHEN 3 THEN '.bin' ELSE '.DOCX' END AS filename, doc_id % 4 AS kind, {_PLAIN} AS t FROM documents)"


@query("A16 O12", f"""SELECT filename, CASE WHEN kind = 3 THEN 'unsupported' WHEN kind = 1 THEN 'failed' ELSE 'read' END AS status, kind = 1 AS has_error,
  CASE kind WHEN 0 THEN md5(array_to_string(list_filter(string_split(t, chr(10)), lambda x: trim(x) <> ''), chr(10) || chr(10))) WHEN 2 THEN md5(t) END AS content_md5 FROM {_ROWS}""")  # fmt: skip
def uploaded_files(t: Tables) -> DataFrame:
    """Files of several kinds, some of them damaged, read as a data source."""
    k = F.col("doc_id")
    kind = F.get(F.array(*map(F.lit, ("docx", "cut", "txt", "txt"))), (k % 4).cast("int"))
    ending = F.get(F.array(*map(F.lit, (".DOCX", ".DOCX", ".txt", ".bin"))), (k % 4).cast("int"))
    rows = t.documents.select(F.concat(F.lit("file_"), k.cast("string"), ending).alias("filename"), kind.alias("kind"), F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x00-\x09\x0B-\x1F]", " ").alias("text"))
    root = Scratch(t.spark, "uploads").path("files")
    rows.mapInArrow(_write_uploads(root), "filename string").write.format("noop").mode("overwrite").save()
    uploads.register(t.spark)
    found = t.spark.read.format("uploads").load(root)
    return found.select("filename", "status", F.col("error").isNotNull().alias("has_error"), F.md5("content_text").alias("content_md5"))
