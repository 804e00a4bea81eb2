"""Responses made of several operators: stage assembly, matching, gaps, full analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.functions import dates, text
from docfold.operators import matching as X
from docfold.operators import relational as R
from docfold.plans.catalog import query
from docfold.plans.relational import LEVEL, MATCHED
from docfold.schemas import CRITICALITY, DOCUMENT_STATUS
from docfold.sources.tables import Tables

_RANK = "CASE c WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END"


@query("O2", f"""SELECT o_orderkey AS requirement_id, coalesce({LEVEL}, 'Low') AS criticality, coalesce(n, 0) AS n_obligations, types, nullif(r, 0) AS n_controls
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, string_agg(DISTINCT l_linestatus, ', ' ORDER BY l_linestatus) AS types, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")  # fmt: skip
def stage_assemble(t: Tables) -> DataFrame:
    """Stage 1 rows with stage 2 aggregates, and stage 3 only for those with an ongoing control."""
    stage2 = t.lineitem.groupBy(F.col("l_orderkey").alias("requirement_id")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("l_linestatus")), ", ").alias("types"))
    stage3 = t.lineitem.where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("requirement_id")).agg(F.count("*").alias("n_controls"))
    joined = t.requirements().join(stage2, "requirement_id", "left").join(stage3, "requirement_id", "left")
    return joined.select("requirement_id", F.coalesce("criticality", F.lit("Low")).alias("criticality"), F.coalesce("n", F.lit(0)).cast("long").alias("n_obligations"), "types", "n_controls")


@query("D13", """SELECT l_orderkey AS requirement_id, l_linenumber AS line, l_partkey AS part, CASE WHEN s_acctbal > 0 THEN s_name END AS control_title, count(*) AS n
  FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL""")  # fmt: skip
def obligation_controls(t: Tables) -> DataFrame:
    controls = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("supp"), F.col("s_name").alias("control_title"))
    return t.obligations().join(controls, "supp", "left").groupBy("requirement_id", "line", "part", "control_title").agg(F.count("*").alias("n"))


@query("D14", """SELECT o.doc_id, coalesce(i.doc_id, max(o.doc_id) OVER (PARTITION BY o.text)) AS matched_id FROM documents o LEFT JOIN documents i ON i.doc_id = o.doc_id * 2""")
def mapping_fallback_join(t: Tables) -> DataFrame:
    keyed = t.documents.select("doc_id", F.md5("text").alias("obligation_text"))
    obligations = keyed.withColumn("obligation_id", (F.col("doc_id") * 2).cast("string"))
    mappings = keyed.select(F.col("doc_id").cast("string").alias("obligation_id"), "obligation_text", F.col("doc_id").alias("position"), F.col("doc_id").alias("matched_id"))
    return X.fallback_mapping(obligations, mappings).select("doc_id", "matched_id")


@query("D15", "SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS last_id FROM documents")
def gap_enrich(t: Tables) -> DataFrame:
    verdicts = t.documents.select("doc_id", F.md5("text").alias("h"))
    meta = verdicts.select("h", F.col("doc_id").alias("position"), F.col("doc_id").alias("last_id"))
    return R.lookup_last(verdicts, meta, "h", "position").select("doc_id", "last_id")


@query("D16", """WITH a AS (SELECT DISTINCT p_name AS control FROM part), b AS (SELECT p_type AS extracted FROM part UNION SELECT p_type || ' ' || p_name FROM part UNION SELECT 'the ' || p_brand FROM part)
  SELECT control, extracted FROM a JOIN b ON contains(lower(trim(control)), lower(trim(extracted))) OR contains(lower(trim(extracted)), lower(trim(control)))""")  # fmt: skip
def title_substring_match(t: Tables) -> DataFrame:
    controls = t.part.select(F.col("p_name").alias("control")).distinct()
    extracted = t.part.select(F.explode(F.array("p_type", F.concat_ws(" ", "p_type", "p_name"), F.concat(F.lit("the "), "p_brand"))).alias("extracted")).distinct()
    return X.title_pairs(controls.withColumn("title", F.col("control")), "control", extracted.withColumn("title", F.col("extracted")), "extracted")


_SHINGLES = r"(SELECT DISTINCT {id}, list_slice(w, i, i + 2) AS g FROM (SELECT {id}, w, unnest(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 1, 2) END)) AS i FROM (SELECT {id}, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM {table})))"
_BENCH, _DOCS = _SHINGLES.format(id="item_id", table="benchmark"), _SHINGLES.format(id="doc_id", table="documents")


@query("D17 O4 U17", f"""WITH b AS (SELECT *, count(*) OVER (PARTITION BY item_id) AS n_items FROM {_BENCH}), p AS (SELECT item_id, doc_id, count(*) AS n_common, any_value(n_items) AS n_items FROM b JOIN {_DOCS} USING (g) GROUP BY 1, 2),
  m AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY n_common DESC, doc_id) = 1)
  SELECT item_id, CASE WHEN 100 * n_common >= 90 * n_items THEN 'fully_matched' WHEN 100 * n_common >= 30 * n_items THEN 'partially_matched' ELSE 'new' END AS match_status,
    CASE WHEN 100 * n_common >= 30 * n_items THEN doc_id END AS matched_id, coalesce(n_common, 0) AS n_common FROM benchmark LEFT JOIN m USING (item_id)""")  # fmt: skip
def match_requirements(t: Tables) -> DataFrame:
    library = t.documents.select(F.col("doc_id").alias("item_id"), "text")
    return X.best_matches(t.benchmark.select(F.col("item_id").alias("id"), "text"), library, below=True).withColumnRenamed("id", "item_id")


@query("D17 O4 U17", f"""WITH b AS (SELECT *, count(*) OVER (PARTITION BY item_id) AS n_items FROM {_BENCH}), p AS (SELECT item_id, doc_id, count(*) AS n_common, any_value(n_items) AS n_items FROM b JOIN {_DOCS} USING (g) GROUP BY 1, 2)
  SELECT item_id, doc_id, n_common, n_items, CASE WHEN 100 * n_common >= 90 * n_items THEN 'fully_matched' ELSE 'partially_matched' END AS match_status FROM p WHERE 100 * n_common >= 30 * n_items""")  # fmt: skip
def matches_over_threshold(t: Tables) -> DataFrame:
    """All pairs over the partial threshold, looked for by the rarest shingles of each requirement only."""
    library = t.documents.select("doc_id", "text")
    found = X.containment(t.benchmark.select("item_id", "text"), "item_id", library, "doc_id", least=30)
    status = F.when(100 * F.col("n_common") >= 90 * F.col("n_items"), "fully_matched").otherwise("partially_matched")
    return found.withColumn("match_status", status)


@query("D18 E13 O7", """WITH v AS (SELECT l_orderkey AS requirement_id, l_partkey AS part, l_linenumber, CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 1 ELSE 0 END AS r, l_suppkey::VARCHAR AS evidence FROM lineitem)
  SELECT requirement_id, part, CASE r WHEN 2 THEN 'covered' WHEN 1 THEN 'partial' ELSE 'missing' END AS coverage_status, evidence AS evidence_text FROM v
  QUALIFY row_number() OVER (PARTITION BY requirement_id, part ORDER BY r DESC, l_linenumber, evidence) = 1""")  # fmt: skip
def gap_merge(t: Tables) -> DataFrame:
    verdicts = t.obligations().select("requirement_id", "part", F.col("line").alias("chunk_num"), "coverage_status", F.col("supp").cast("string").alias("evidence_text"))
    obligations = verdicts.select("requirement_id", "part").distinct()
    return X.merge_gaps(obligations, verdicts, ["requirement_id", "part"]).select("requirement_id", "part", "coverage_status", "evidence_text")


@query("O8 E6 E7 E8", f"""SELECT o_custkey AS regulation_id, count(*) AS total, count(*) FILTER (l_returnflag = 'A') AS covered, count(*) FILTER (l_returnflag = 'N') AS partial, count(*) FILTER (l_returnflag = 'R') AS missing,
  count(*) FILTER (c = 'High') AS high, count(*) FILTER (c = 'Medium') AS medium, count(*) FILTER (c = 'Low') AS low FROM (SELECT *, {LEVEL} AS c FROM orders) JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")  # fmt: skip
def gap_summary(t: Tables) -> DataFrame:
    rows = t.obligations().join(t.requirements(), "requirement_id")
    return rows.groupBy("regulation_id").agg(F.count("*").alias("total"), *R.counts_of(F.col("coverage_status"), ("covered", "partial", "missing")), *R.counts_of(F.col("criticality"), CRITICALITY))


@query("K3", """SELECT o_custkey AS regulation_id, o_orderkey AS requirement_id, l_linenumber AS line, l_partkey AS part, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""")
def explode_obligations(t: Tables) -> DataFrame:
    """Obligations go through JSON and are counted in the partitions that they are dealt to before they are nested."""
    one = F.struct("line", "part")
    dealt = t.obligations().select("requirement_id", "line", "part").repartition(t.parts("orders", "lineitem"), "requirement_id")
    blobs = dealt.groupBy("requirement_id").agg(F.to_json(F.collect_list(one)).alias("stage2_json"))
    read = F.explode(F.from_json("stage2_json", "array<struct<line:int,part:long>>"))
    rows = t.requirements().join(blobs, "requirement_id").select("regulation_id", "requirement_id", read.alias("o"))
    return rows.select("regulation_id", "requirement_id", "o.line", "o.part").groupBy("regulation_id", "requirement_id", "line", "part").agg(F.count("*").alias("n"))


@query("K4", "SELECT DISTINCT l_orderkey AS requirement_id FROM lineitem WHERE l_returnflag = 'R'")
def ongoing_filter(t: Tables) -> DataFrame:
    nested = t.lineitem.groupBy(F.col("l_orderkey").alias("requirement_id")).agg(F.collect_list(F.struct("l_linenumber", "l_returnflag")).alias("o"))
    return nested.where(F.exists("o", lambda x: x["l_returnflag"] == "R")).select("requirement_id")


@query("O13 C21", f"""SELECT page_id, coalesce(nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''), 'Untitled') AS title, CASE WHEN lang IN ({', '.join(repr(s) for s in DOCUMENT_STATUS)}) THEN lang ELSE 'active' END AS status, (2000 + page_id % 25)::VARCHAR AS year
  FROM pages LEFT JOIN documents ON doc_id = page_id""")  # fmt: skip
def metadata_normalize(t: Tables) -> DataFrame:
    both = t.pages.join(t.documents.select(F.col("doc_id").alias("page_id"), "lang"), "page_id", "left")
    title = text.or_else(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("Untitled"))
    issued = F.concat(F.lit("01/02/"), (2000 + F.col("page_id") % 25).cast("string"))
    return both.select("page_id", title.alias("title"), text.one_of(F.col("lang"), DOCUMENT_STATUS, "active").alias("status"), dates.extract_year(dates.validate_date(issued)).alias("year"))


@query("O9 D2 D3 H2", f"""WITH l AS (SELECT DISTINCT l_orderkey, l_suppkey, CASE WHEN bool_or(l_returnflag = 'A') OVER (PARTITION BY l_orderkey, l_suppkey) THEN 'existing_db' ELSE 'stage3_llm' END AS source FROM lineitem)
  SELECT o_custkey AS regulation_id, o_orderkey AS requirement_id, s_name AS control_title, source, {LEVEL} AS criticality FROM orders LEFT JOIN l ON l_orderkey = o_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey""")  # fmt: skip
def full_mapping(t: Tables) -> DataFrame:
    """Requirements with their controls, those of the database before those of the model."""
    parts = t.parts("orders", "lineitem")
    side = lambda found, source: t.obligations().where(found).select("requirement_id", "supp", F.lit(source).alias("source"))
    known = F.col("match_status") == "fully_matched"
    links = R.union_first([side(known, "existing_db"), side(~known, "stage3_llm")], ["requirement_id", "supp"], F.col("source"), deal=(parts, "requirement_id"))
    named = links.join(t.supplier.select(F.col("s_suppkey").alias("supp"), F.col("s_name").alias("control_title")), "supp", "left")
    return t.requirements().join(named, "requirement_id", "left").select("regulation_id", "requirement_id", "control_title", "source", "criticality")


@query("O10 K3 D13 D14 E12", f"""WITH r AS (SELECT o_custkey, o_orderkey, any_value({LEVEL}) AS c, count(l_orderkey) AS n, count(*) FILTER (l_returnflag = 'A') AS fully, count(*) FILTER (l_returnflag = 'N') AS partially, count(*) FILTER (l_returnflag = 'R') AS fresh,
    count(DISTINCT p_brand) AS controls, CASE WHEN coalesce(bool_or({MATCHED} = 'new' AND l_orderkey IS NOT NULL), false) THEN 0 WHEN coalesce(bool_or({MATCHED} = 'partially_matched'), false) THEN 1 ELSE 2 END AS s
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
  SELECT o_custkey AS regulation_id, count(*) AS total_requirements, sum(n)::BIGINT AS total_obligations, sum(controls)::BIGINT AS total_controls, sum(fully)::BIGINT AS fully_matched, sum(partially)::BIGINT AS partially_matched, sum(fresh)::BIGINT AS new,
    CASE min({_RANK}) WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END AS criticality, CASE min(s) WHEN 0 THEN 'new' WHEN 1 THEN 'partially_matched' ELSE 'fully_matched' END AS status FROM r GROUP BY 1""")  # fmt: skip
def full_analysis(t: Tables) -> DataFrame:
    """Per document: its requirements with their obligations matched, rolled up to the worst status and the highest criticality."""
    controls = t.part.select(F.col("p_partkey").alias("part"), "p_brand")
    named = t.obligations().join(controls, "part", "left").select("requirement_id", "match_status", "p_brand")
    per = named.repartition(t.parts("orders", "lineitem"), "requirement_id").groupBy("requirement_id").agg(
        F.count("*").alias("n"), *R.counts_of(F.col("match_status"), ("fully_matched", "partially_matched", "new")), F.countDistinct("p_brand").alias("controls"), R.worst_status(F.col("match_status")).alias("status")
    )
    rows = t.requirements().join(per, "requirement_id", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return rows.groupBy("regulation_id").agg(
        F.count("*").alias("total_requirements"), total("n").alias("total_obligations"), total("controls").alias("total_controls"), total("fully_matched").alias("fully_matched"),
        total("partially_matched").alias("partially_matched"), total("new").alias("new"), R.dominant(F.col("criticality"), CRITICALITY).alias("criticality"), R.worst_status(F.col("status")).alias("status"),
    )
