"""Scans, joins, aggregates, windows, paging and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.operators import relational as R
from docfold.operators import trees
from docfold.operators.matching import new_links
from docfold.operators.versioning import history
from docfold.plans.catalog import query
from docfold.schemas import CRITICALITY
from docfold.sources.tables import Tables

LEVEL = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'High' WHEN o_orderpriority = '3-MEDIUM' THEN 'Medium' WHEN o_orderpriority = '5-LOW' THEN 'Low' END"
MATCHED = "CASE l_returnflag WHEN 'A' THEN 'fully_matched' WHEN 'N' THEN 'partially_matched' ELSE 'new' END"


def stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"


@query("A1 C1 C6", "SELECT item_id, text FROM benchmark WHERE text IS NOT NULL")
def scan_library(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", "text").where(F.col("text").isNotNull())


@query("A2 C4", "SELECT doc_id, text, lang, source, n_chars FROM documents WHERE doc_id = 42")
def doc_by_id(t: Tables) -> DataFrame:
    return t.documents.where(F.col("doc_id").eqNullSafe(42))


@query("C7 G1", "SELECT doc_id, lang, source, n_chars FROM documents WHERE source = 'src3' ORDER BY n_chars DESC, doc_id LIMIT 10 OFFSET 20")
def list_documents(t: Tables) -> DataFrame:
    found = R.optional_filters(t.documents.select("doc_id", "lang", "source", "n_chars"), source="src3", lang=None)
    return R.page_of(found, [F.col("n_chars").desc(), F.col("doc_id")], limit=10, offset=20)


@query("E3 G2", "SELECT source, count(*) AS total, 30 < count(*) AS has_more, 3::BIGINT AS current_page, ceil(count(*) / 10.0)::BIGINT AS total_pages FROM documents GROUP BY 1")
def page_with_total(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg(F.count("*").alias("total")).select("source", "total", *R.paging(F.col("total"), 10, 20))


@query("G3 G4", f"SELECT event_id, {STAMP.format('ts')} AS ts, user_id, event_type FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 10")
def top_recent(t: Tables) -> DataFrame:
    top = t.events.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(10)
    return top.select("event_id", stamp("ts").alias("ts"), "user_id", "event_type")


@query("G6", f"""SELECT event_type, {STAMP.format('min(ts)')} AS due, arg_min(event_id, (ts, event_id)) AS event_id
  FROM events WHERE ts >= (SELECT date_trunc('day', min(ts)) + INTERVAL 10 DAY FROM events) GROUP BY 1""")  # fmt: skip
def next_due(t: Tables) -> DataFrame:
    now = t.events.agg((F.date_trunc("day", F.min("ts")).cast("timestamp_ntz") + F.expr("INTERVAL 10 DAY")).alias("now"))
    due = t.events.join(F.broadcast(now), F.col("ts") >= F.col("now"))  # one row
    return due.groupBy("event_type").agg(stamp(F.min("ts")).alias("due"), F.min_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


@query("D1", "SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def doc_category(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "c_name", "n_name")


@query("D20", """SELECT r_regionkey, r_name, count(n_nationkey) AS n_children, coalesce(string_agg(n_name, ', ' ORDER BY n_name), '') AS children
  FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY 1, 2""")  # fmt: skip
def category_children(t: Tables) -> DataFrame:
    kids = t.nation.groupBy("n_regionkey").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("n_name")), ", ").alias("kids"))
    joined = t.region.join(kids, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return joined.select("r_regionkey", "r_name", F.coalesce("n", F.lit(0)).cast("long").alias("n_children"), F.coalesce("kids", F.lit("")).alias("children"))


@query("K12 A13", """WITH RECURSIVE n AS (SELECT 'R' || r_regionkey AS id, NULL AS parent, r_name AS title FROM region
    UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name FROM nation
    UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey, c_name FROM customer),
  t AS (SELECT id, parent AS parent_id, 0 AS lvl, title AS path FROM n WHERE parent IS NULL
    UNION ALL SELECT n.id, n.parent, t.lvl + 1, t.path || ' > ' || n.title FROM n JOIN t ON n.parent = t.id) SELECT * FROM t""")  # fmt: skip
def category_tree(t: Tables) -> DataFrame:
    node = lambda df, mark, key, up, parent, title: df.select(F.concat(F.lit(mark), key).alias("id"), (F.concat(F.lit(up), parent) if parent else F.lit(None).cast("string")).alias("parent"), F.col(title).alias("title"))
    nodes = node(t.region, "R", "r_regionkey", "", None, "r_name").unionByName(node(t.nation, "N", "n_nationkey", "R", "n_regionkey", "n_name")).unionByName(node(t.customer, "C", "c_custkey", "N", "c_nationkey", "c_name"))
    nodes.createOrReplaceTempView("docfold_category_nodes")
    return R.tree_paths(t.spark, "docfold_category_nodes", "id", "parent", "title")


@query("D2", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, p_name, p_brand FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 10")
def mapping_detail(t: Tables) -> DataFrame:
    found = t.lineitem.join(t.part, (F.col("l_partkey") == F.col("p_partkey")) & (F.col("p_size") > 10), "left")
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "p_name", "p_brand")


@query("D3 D4", "SELECT DISTINCT l_orderkey AS requirement_id, s_suppkey AS control_id, s_name AS control_title FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
def control_links(t: Tables) -> DataFrame:
    links = t.lineitem.select(F.col("l_orderkey").alias("requirement_id"), F.col("l_suppkey").alias("control_id")).distinct()
    return links.join(t.supplier.select(F.col("s_suppkey").alias("control_id"), F.col("s_name").alias("control_title")), "control_id")


@query("D3 D4 C5", """SELECT DISTINCT l_orderkey AS requirement_id, p_partkey AS kpi_id, p_name AS kpi_title FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE p_brand IN (SELECT p_brand FROM part WHERE p_size = 50)""")  # fmt: skip
def kpi_links(t: Tables) -> DataFrame:
    wanted = t.part.join(t.part.where("p_size = 50").select("p_brand"), "p_brand", "left_semi")
    links = t.lineitem.select(F.col("l_orderkey").alias("requirement_id"), F.col("l_partkey").alias("kpi_id")).distinct()
    return links.join(wanted.select(F.col("p_partkey").alias("kpi_id"), F.col("p_name").alias("kpi_title")), "kpi_id")


@query("D5", "SELECT d.doc_id, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id AND l.quality = 1")
def active_version_join(t: Tables) -> DataFrame:
    good = t.labels.where("quality = 1")
    return t.documents.select("doc_id", "source").join(good, "doc_id", "left").select("doc_id", "source", "quality", "toxic")


@query("D6 E21 C9", "SELECT doc_id, CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) THEN 1 ELSE 0 END AS has_analysis FROM documents d")
def has_analysis(t: Tables) -> DataFrame:
    done = t.labels.select("doc_id").distinct().withColumn("hit", F.lit(1))
    return t.documents.select("doc_id").join(done, "doc_id", "left").select("doc_id", F.when(F.col("hit").isNotNull(), 1).otherwise(0).alias("has_analysis"))


@query("D9 C4", "SELECT doc_id, source, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id IS NOT DISTINCT FROM d.doc_id)")
def new_docs_anti(t: Tables) -> DataFrame:
    return R.missing(t.documents.select("doc_id", "source", "lang"), t.labels, ["doc_id"])


@query("D9 D10 C4", "SELECT doc_id, source, lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id IS NOT DISTINCT FROM d.doc_id)")
def existing_docs_semi(t: Tables) -> DataFrame:
    return R.existing(t.documents.select("doc_id", "source", "lang"), t.labels, ["doc_id"])


@query("D10 D11", """SELECT d.doc_id, k.doc_id AS existing_id, k.lang AS existing_lang FROM documents d LEFT JOIN (SELECT page_id, url FROM pages) p ON p.page_id = d.doc_id LEFT JOIN (SELECT url, max(page_id) AS last FROM pages WHERE page_id % 3 <> 0 GROUP BY 1) s ON s.url = p.url
  LEFT JOIN documents k ON k.doc_id = s.last AND k.source = 'src1'""")
def lookup_by_url(t: Tables) -> DataFrame:
    """The stored document of each page address and one regulator: its id and fields, null where there is none."""
    stored = t.pages.where("page_id % 3 <> 0").select("url", F.col("page_id").alias("position"), F.col("page_id").alias("last"))
    asked = t.documents.select("doc_id").join(t.pages.select(F.col("page_id").alias("doc_id"), "url"), "doc_id", "left")
    found = R.lookup_last(asked, stored, "url", "position")
    known = t.documents.where("source = 'src1'").select(F.col("doc_id").alias("last"), F.col("doc_id").alias("existing_id"), F.col("lang").alias("existing_lang"))
    return found.join(known, "last", "left").select("doc_id", "existing_id", "existing_lang")


@query("H7", "SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(text)) AS first_id FROM documents QUALIFY doc_id > first_id")
def dup_check(t: Tables) -> DataFrame:
    keyed = t.documents.select("doc_id", F.md5("text").alias("h"))
    first = keyed.groupBy("h").agg(F.min("doc_id").alias("first_id"))
    return keyed.join(first, "h").where("doc_id > first_id").select("doc_id", "first_id")


@query("D19 O4", """SELECT DISTINCT l_partkey AS part, l_suppkey AS supp FROM lineitem l WHERE l_linestatus = 'O'
  AND NOT EXISTS (SELECT 1 FROM lineitem f WHERE f.l_linestatus = 'F' AND f.l_partkey = l.l_partkey AND f.l_suppkey = l.l_suppkey)""")  # fmt: skip
def new_links_anti(t: Tables) -> DataFrame:
    pairs = t.lineitem.select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), "l_linestatus")
    return new_links(pairs.where("l_linestatus = 'O'"), pairs.where("l_linestatus = 'F'"), ["part", "supp"])


@query("E6", """SELECT l_linestatus, count(*) FILTER (l_returnflag = 'A') AS fully_matched, count(*) FILTER (l_returnflag = 'N') AS partially_matched,
  count(*) FILTER (l_returnflag = 'R') AS new FROM lineitem GROUP BY 1""")  # fmt: skip
def match_summary(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    status = F.when(flag == "A", "fully_matched").when(flag == "N", "partially_matched").when(flag == "R", "new")
    return t.lineitem.groupBy("l_linestatus").agg(*R.counts_of(status, ("fully_matched", "partially_matched", "new")))


@query("E12", f"""SELECT o_orderkey, CASE WHEN coalesce(bool_or(s = 'new'), false) THEN 'new' WHEN coalesce(bool_or(s = 'partially_matched'), false) THEN 'partially_matched' ELSE 'fully_matched' END AS status,
  count(s) AS n FROM orders LEFT JOIN (SELECT l_orderkey, {MATCHED} AS s FROM lineitem) ON l_orderkey = o_orderkey GROUP BY 1""")  # fmt: skip
def status_rollup(t: Tables) -> DataFrame:
    per = t.obligations().groupBy("requirement_id").agg(R.worst_status(F.col("match_status")).alias("status"), F.count("*").alias("n"))
    joined = t.orders.select("o_orderkey").join(per, F.col("o_orderkey") == F.col("requirement_id"), "left")
    return joined.select("o_orderkey", F.coalesce("status", F.lit("fully_matched")).alias("status"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("E10", f"""SELECT regulation_id, CASE min(CASE c WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END) WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS dominant
  FROM (SELECT o_custkey AS regulation_id, {LEVEL} AS c FROM orders) GROUP BY 1""")  # fmt: skip
def dominant_criticality(t: Tables) -> DataFrame:
    return t.requirements().groupBy("regulation_id").agg(R.dominant(F.col("criticality"), CRITICALITY).alias("dominant"))


@query("E11", "SELECT source, string_agg(DISTINCT lang, ', ' ORDER BY lang) AS langs FROM documents GROUP BY 1")
def distinct_types(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("lang")), ", ").alias("langs"))


@query("E9 H6", "SELECT l_partkey AS part, string_agg(DISTINCT l_suppkey::VARCHAR, ',' ORDER BY l_suppkey::VARCHAR) AS controls, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1")
def linked_controls(t: Tables) -> DataFrame:
    ids = F.array_sort(F.collect_set(F.col("l_suppkey").cast("string")))
    return t.lineitem.groupBy(F.col("l_partkey").alias("part")).agg(F.array_join(ids, ",").alias("controls"), F.size(ids).cast("long").alias("n"))


@query("E5", f"SELECT coalesce(c, 'Unknown') AS category, count(*) AS n FROM (SELECT nullif({LEVEL}, '') AS c FROM orders) GROUP BY 1")
def count_by_category(t: Tables) -> DataFrame:
    return t.requirements().groupBy(F.coalesce(F.nullif("criticality", F.lit("")), F.lit("Unknown")).alias("category")).agg(F.count("*").alias("n"))


@query("E7", f"""SELECT regulation_id, count(*) FILTER (c = 'High') AS high, count(*) FILTER (c = 'Medium') AS medium, count(*) FILTER (c = 'Low') AS low
  FROM (SELECT o_custkey AS regulation_id, {LEVEL} AS c FROM orders) GROUP BY 1""")  # fmt: skip
def criticality_pivot(t: Tables) -> DataFrame:
    wide = t.requirements().groupBy("regulation_id").pivot("criticality", list(CRITICALITY)).count().na.fill(0)
    return wide.select("regulation_id", *(F.col(c).alias(c.lower()) for c in CRITICALITY))


@query("E8", "SELECT lang AS kind, count(*) AS n FROM documents GROUP BY 1")
def dynamic_histogram(t: Tables) -> DataFrame:
    return t.documents.groupBy(F.col("lang").alias("kind")).agg(F.count("*").alias("n")).orderBy("kind")


@query("C8", f"""SELECT regulation_id, count(*) FILTER (c = 'High') AS filtered_total, count(*) AS total
  FROM (SELECT o_custkey AS regulation_id, {LEVEL} AS c FROM orders) GROUP BY 1""")  # fmt: skip
def requirements_filtered(t: Tables) -> DataFrame:
    return t.requirements().groupBy("regulation_id").agg(F.count_if(F.coalesce(F.col("criticality") == "High", F.lit(False))).alias("filtered_total"), F.count("*").alias("total"))


@query("E14 K13", """SELECT o_custkey AS regulation_id, count(l_orderkey) AS obligations, count(*) FILTER (l_returnflag = 'R') AS open_obligations
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")  # fmt: skip
def control_totals(t: Tables) -> DataFrame:
    lists = t.lineitem.groupBy("l_orderkey").agg(F.collect_list("l_returnflag").alias("flags"))
    nested = t.orders.join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("flags", F.coalesce("flags", F.array().cast("array<string>")))
    return nested.groupBy(F.col("o_custkey").alias("regulation_id")).agg(F.sum(F.size("flags")).alias("obligations"), F.sum(F.size(F.filter("flags", lambda x: x == "R"))).alias("open_obligations"))


@query("E17", "SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2")
def source_breakdown(t: Tables) -> DataFrame:
    return t.documents.groupBy("source", "lang").agg(F.count("*").alias("n"))


@query("E20", "SELECT event_type, count(*) FILTER (value >= 50) AS succeeded, count(*) FILTER (value < 50) AS failed FROM events GROUP BY 1")
def batch_tally(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count_if(F.col("value") >= 50).alias("succeeded"), F.count_if(F.col("value") < 50).alias("failed"))


@query("E1", f"SELECT {STAMP.format('max(ts)')} AS last_crawl FROM events")
def last_crawl(t: Tables) -> DataFrame:
    return t.events.agg(stamp(F.max("ts")).alias("last_crawl"))


@query("E4", "SELECT source, count(*) > 0 AS any_rows FROM documents GROUP BY 1")
def any_rows(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg((F.count("*") > 0).alias("any_rows"))


@query("F1", f"SELECT user_id, event_id, {STAMP.format('ts')} AS ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id DESC) = 1")
def latest_version(t: Tables) -> DataFrame:
    return R.first_by(t.events, ["user_id"], F.col("ts").desc(), F.col("event_id").desc()).select("user_id", "event_id", stamp("ts").alias("ts"))


@query("F2 Q3", """WITH k AS (SELECT DISTINCT event_type AS regulator FROM events UNION SELECT 'never_run'),
  e AS (SELECT event_type, event_id, CASE WHEN value < 50 THEN 'FAILED' ELSE 'DONE' END AS status FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) = 1)
  SELECT regulator, coalesce(status, 'NOT_STARTED') AS status, event_id FROM k LEFT JOIN e ON event_type = regulator""")  # fmt: skip
def latest_status(t: Tables) -> DataFrame:
    from docfold.streaming.jobs import current_status

    log = t.events.select(F.col("event_type").alias("regulator"), F.col("event_id").alias("id"), F.when(F.col("value") < 50, "FAILED").otherwise("DONE").alias("status"))
    expected = log.select("regulator").distinct().unionByName(t.spark.createDataFrame([("never_run",)], "regulator string"))
    return current_status(log, ["regulator"], expected).select("regulator", "status", F.col("id").alias("event_id"))


@query("D7 E2 N5", f"""SELECT c_custkey, c_name, {STAMP.format('min(ts)')} AS first_seen, count(event_id) AS n FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1, 2""")
def version_history(t: Tables) -> DataFrame:
    per = t.events.groupBy("user_id").agg(F.min("ts").alias("first"), F.count("*").alias("n"))
    out = t.customer.join(per, F.col("user_id") == F.col("c_custkey"), "left")
    return out.select("c_custkey", "c_name", stamp("first").alias("first_seen"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query("N4 N5", """SELECT v.user_id AS regulation_id, v.event_id AS version_no, row_number() OVER (PARTITION BY v.user_id ORDER BY v.event_id DESC) - 1 AS age, CASE WHEN value < 50 THEN 1 ELSE 0 END::BIGINT AS n_rows FROM events v""")
def version_list(t: Tables) -> DataFrame:
    """Versions of each document, newest first, with the analysis rows they have."""
    versions = t.events.select(F.col("user_id").alias("regulation_id"), F.col("event_id").alias("version_no"))
    analysis = t.events.where("value < 50").select(F.col("user_id").alias("regulation_id"), F.col("event_id").alias("version_no"), F.col("ts").alias("created_at"))
    return history(versions, analysis).select("regulation_id", "version_no", F.col("age").cast("long").alias("age"), "n_rows")


@query("D8 E18", """WITH r AS (SELECT o_custkey, o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
  SELECT o_custkey AS regulation_id, count(*) AS n_requirements, sum(n)::BIGINT AS n_obligations, string_agg(o_orderkey || ':' || n, ',' ORDER BY o_orderkey) AS shape FROM r GROUP BY 1""")  # fmt: skip
def analysis_versions(t: Tables) -> DataFrame:
    per = t.orders.join(t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n")), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    one = F.struct("o_orderkey", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    nested = per.groupBy(F.col("o_custkey").alias("regulation_id")).agg(F.sort_array(F.collect_list(one)).alias("r"))
    shape = F.array_join(F.transform("r", lambda x: F.concat_ws(":", x["o_orderkey"].cast("string"), x["n"].cast("string"))), ",")
    return nested.select("regulation_id", F.size("r").cast("long").alias("n_requirements"), F.aggregate("r", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_obligations"), shape.alias("shape"))


@query("F4", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, CASE WHEN row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1
  THEN 'summary of ' || l_orderkey END AS summary FROM lineitem""")  # fmt: skip
def first_row_marker(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    first = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order)) == 1
    return t.lineitem.select("l_orderkey", *order, F.when(first, F.concat(F.lit("summary of "), "l_orderkey")).alias("summary"))


@query("F5", """SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS header_id FROM events""")  # fmt: skip
def carry_forward(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", R.carry_forward(F.col("event_id"), F.col("event_type") == "signup", ["user_id"], F.col("ts"), F.col("event_id")).alias("header_id"))


@query("F6", """SELECT event_id, user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session_no FROM (
  SELECT event_id, user_id, ts, CASE WHEN epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) > 1800 THEN 1 ELSE 0 END AS new FROM events)""")  # fmt: skip
def gap_sessions(t: Tables) -> DataFrame:
    e = t.events.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    return R.gap_sessions(e, ["user_id"], F.col("at"), F.lit(1800 * 10**6), F.col("event_id")).select("event_id", "user_id", "session_no")


@query("H1 A11", """SELECT 'documents' AS source_system, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents UNION ALL SELECT 'pages', count(*), sum(length(html))::BIGINT FROM pages
  UNION ALL SELECT 'conversations', count(*), sum(length(text))::BIGINT FROM conversations""")  # fmt: skip
def union_sources(t: Tables) -> DataFrame:
    parts = {"documents": t.documents.select("text"), "pages": t.pages.select(F.col("html").alias("text")), "conversations": t.conversations.select("text")}
    return R.union_sources(parts).groupBy("source_system").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query("H2", """WITH u AS (SELECT l_partkey AS part, l_suppkey AS supp, 0 AS s, l_quantity AS q FROM lineitem WHERE l_returnflag = 'A' UNION ALL SELECT l_partkey, l_suppkey, 1, l_quantity FROM lineitem WHERE l_returnflag = 'R')
  SELECT part, supp, CASE s WHEN 0 THEN 'existing_db' ELSE 'stage3' END AS origin, q AS quantity FROM u QUALIFY row_number() OVER (PARTITION BY part, supp ORDER BY s, q) = 1""")  # fmt: skip
def links_union_dedupe(t: Tables) -> DataFrame:
    side = lambda flag, origin: t.lineitem.where(F.col("l_returnflag") == flag).select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.lit(origin).alias("origin"), F.col("l_quantity").alias("quantity"))
    return R.union_first([side("A", "existing_db"), side("R", "stage3")], ["part", "supp"], F.col("quantity"), deal=(t.parts("lineitem"), "part", "supp"))


@query("A6 H4", "SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_quantity FROM lineitem")
def dedupe_composite(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity"]
    return t.lineitem.select(*keys).dropDuplicates(keys)


@query("E19", """SELECT l_orderkey, first(l_quantity ORDER BY l_linenumber, l_partkey, l_quantity) FILTER (l_discount > 0.05) AS first_discounted,
  string_agg(l_partkey::VARCHAR, ',' ORDER BY l_linenumber, l_partkey) AS parts, last(l_shipdate::DATE::VARCHAR ORDER BY l_linenumber, l_partkey, l_quantity, l_shipdate) AS last_ship FROM lineitem GROUP BY 1""")  # fmt: skip
def row_fold(t: Tables) -> DataFrame:
    row = F.struct("l_linenumber", "l_partkey", "l_quantity", "l_shipdate", "l_discount")
    folded = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(row)).alias("r"))
    return folded.select(
        "l_orderkey",
        F.get(F.filter("r", lambda x: x["l_discount"] > 0.05), F.lit(0))["l_quantity"].alias("first_discounted"),
        F.array_join(F.transform("r", lambda x: x["l_partkey"].cast("string")), ",").alias("parts"),
        F.element_at("r", -1)["l_shipdate"].cast("date").cast("string").alias("last_ship"),
    )


@query("F7 A12 J7", f"SELECT event_id, {STAMP.format('ts')} AS ts FROM events WHERE events.ts >= (SELECT date_trunc('day', max(ts)) - INTERVAL 1 DAY FROM events)")
def incremental_since(t: Tables) -> DataFrame:
    mark = t.events.agg((F.date_trunc("day", F.max("ts")).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY")).alias("since"))
    return t.events.join(F.broadcast(mark), F.col("ts") >= F.col("since")).select("event_id", stamp("ts").alias("ts"))  # one row


@query("extension Q6", f"SELECT {STAMP.format('time_bucket(INTERVAL 6 HOUR, ts)')} AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def events_tumbling(t: Tables) -> DataFrame:
    from docfold.streaming.jobs import event_counts

    return event_counts(t.events).select(stamp(F.col("window.start")).alias("start"), "event_type", "n")


@query("extension Q6", f"""WITH s AS (SELECT user_id, ts, sum(CASE WHEN gap IS NULL OR gap >= 1800 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k
    FROM (SELECT user_id, ts, epoch(ts) - lag(epoch(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events))
  SELECT user_id, {STAMP.format('min(ts)')} AS start, count(*) AS n FROM s GROUP BY user_id, k""")  # fmt: skip
def events_sessions(t: Tables) -> DataFrame:
    from docfold.streaming.jobs import event_sessions

    return event_sessions(t.events).select("user_id", stamp(F.col("session_window.start")).alias("start"), "n")


@query("K12 D20", """WITH c AS (SELECT c_nationkey, string_agg('{"id":"c' || c_custkey || '","title":"' || c_name || '","children":[]}', ',' ORDER BY c_name, 'c' || c_custkey) AS x FROM customer GROUP BY 1),
  n AS (SELECT n_regionkey, string_agg('{"id":"n' || n_nationkey || '","title":"' || n_name || '","children":[' || coalesce(c.x, '') || ']}', ',' ORDER BY n_name, 'n' || n_nationkey) AS x FROM nation LEFT JOIN c ON c_nationkey = n_nationkey GROUP BY 1)
  SELECT 'r' || r_regionkey AS id, '{"id":"r' || r_regionkey || '","title":"' || r_name || '","children":[' || coalesce(n.x, '') || ']}' AS tree FROM region LEFT JOIN n ON n_regionkey = r_regionkey""")  # fmt: skip
def nested_tree(t: Tables) -> DataFrame:
    """Regions with their nations and customers, one JSON text for each root."""
    key = lambda letter, c: F.concat(F.lit(letter), F.col(c).cast("string"))
    nodes = t.region.select(key("r", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("title"))
    nodes = nodes.unionByName(t.nation.select(key("n", "n_nationkey").alias("id"), key("r", "n_regionkey").alias("parent_id"), F.col("n_name").alias("title")))
    nodes = nodes.unionByName(t.customer.select(key("c", "c_custkey").alias("id"), key("n", "c_nationkey").alias("parent_id"), F.col("c_name").alias("title")))
    return trees.nested_json(nodes, "id", "parent_id", "title")
