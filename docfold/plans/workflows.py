"""Jobs made of several operators, over the given tables: analysis, matching, gaps, ingest, upload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.functions import structured
from docfold.operators import mutations as M
from docfold.operators import workflows as W
from docfold.operators.matching import LexicalProvider
from docfold.plans.catalog import query
from docfold.scratch import Scratch
from docfold.sources.tables import Tables

#: Words of the tables' prose that stand for modal verbs, and what other words make of an obligation.
MODAL = r"(?:^|[ \n])(?:with|avec|mit|con)[ .,\n]"
RULES = (
    (r"(?:^|[ \n])(?:that|dans)[ .,\n]", "Reporting", "High", "One_Off_Reporting"),
    (r"(?:^|[ \n])(?:the|le|der|que)[ .,\n]", "Detective", "Medium", "Ongoing_Control"),
    (r"(?:^|[ \n])(?:and|et|und)[ .,\n]", "Preventive", "Medium", "One_Time_Implementation"),
)
PROVIDER = LexicalProvider(MODAL, RULES)


def _rule(field: int, default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(s, '{r[0]}') THEN '{r[field]}'" for r in RULES) + f" ELSE '{default}' END"


def _sentences(source: str, key: str = "doc_id", text: str = "text", least: int = 200) -> str:
    """Distinct sentences with a modal word, with type, criticality and category."""
    split = rf"string_split(regexp_replace({text}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"
    return f"""(SELECT *, {_rule(1, "Documentation")} AS type, {_rule(2, "Low")} AS crit, {_rule(3, "Informational_No_Action")} AS exec
      FROM (SELECT DISTINCT {key}, unnest({split}) AS s FROM {source} WHERE length({text}) >= {least}) WHERE regexp_matches(s, '{MODAL}'))"""


_CRIT = "CASE min(CASE crit WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END) WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' ELSE 'Low' END"
_EXEC = "CASE min(CASE exec WHEN 'Ongoing_Control' THEN 0 WHEN 'One_Time_Implementation' THEN 1 WHEN 'One_Off_Reporting' THEN 2 ELSE 4 END) WHEN 0 THEN 'Ongoing_Control' WHEN 1 THEN 'One_Time_Implementation' WHEN 2 THEN 'One_Off_Reporting' ELSE 'Informational_No_Action' END"


@query("O1 O2 U16 F4", rf"""SELECT doc_id AS regulation_id, 'REQ-001' AS requirement_id, {_EXEC} AS execution_category, {_CRIT} AS criticality, string_agg(DISTINCT type, ', ' ORDER BY type) AS obligation_type,
  count(*) AS n_obligations, count(*) FILTER (exec = 'Ongoing_Control') AS n_controls, md5(min(s)) AS first_obligation, '# Analysis' || chr(10) || '- Obligations: ' || count(*) AS stage4_md
  FROM {_sentences("documents")} GROUP BY 1""")  # fmt: skip
def staged_analysis(t: Tables) -> DataFrame:
    """Extract, normalise, controls for ongoing obligations only, report; then the rows."""
    rows = W.staged_analysis(t.documents.select(F.col("doc_id").alias("regulation_id"), F.col("text").alias("content_text")), PROVIDER)
    first = F.md5(F.get_json_object("analysis_json", "$.obligations[0].obligation_text"))
    return rows.select("regulation_id", "requirement_id", "execution_category", "criticality", "obligation_type", "n_obligations", "n_controls", first.alias("first_obligation"), "stage4_md")


@query("D12 E10 E11", """WITH s2 AS (SELECT l_orderkey, max(l_linenumber * 1000000 + l_suppkey) AS last FROM lineitem GROUP BY 1)
  SELECT o_custkey AS regulation_id, o_orderkey AS requirement_id, CASE WHEN last IS NULL THEN 'Low' ELSE ['High', 'Medium', 'Low'][last % 1000000 % 3 + 1] END AS criticality,
    coalesce(1, 1)::BIGINT AS n_obligations, CASE WHEN last % 2 = 0 THEN 1 ELSE 0 END::BIGINT AS n_controls, CASE WHEN o_orderkey = min(o_orderkey) OVER (PARTITION BY o_custkey) THEN 'report' END AS stage4_md
  FROM orders LEFT JOIN s2 ON l_orderkey = o_orderkey""")  # fmt: skip
def assembled_last_wins(t: Tables) -> DataFrame:
    """Of several answers of a later stage to one requirement the last counts."""
    one = lambda text: F.array(F.struct(F.lit("OBL-001").alias("obligation_id"), F.lit(text).alias("obligation_text")))
    keys = [F.col("o_custkey").alias("regulation_id"), F.col("o_orderkey").alias("requirement_id")]
    stage1 = t.orders.select(*keys, F.col("o_orderkey").alias("position"), F.lit("R").alias("requirement_title"), one("first").alias("obligations"))
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    position = F.col("l_linenumber") * 1_000_000 + F.col("l_suppkey")
    level = F.get(F.array(F.lit("High"), F.lit("Medium"), F.lit("Low")), (F.col("l_suppkey") % 3).cast("int"))
    normal = F.array(F.struct(F.lit("OBL-001").alias("obligation_id"), F.lit("second").alias("obligation_text"), F.lit(None).cast("string").alias("obligation_type"), level.alias("criticality"), F.lit("Ongoing_Control").alias("execution_category")))
    stage2 = lines.select(*keys, position.alias("position"), normal.alias("normalized_obligations"))
    control = F.when(position % 2 == 0, F.struct(F.concat(F.lit("C"), "l_suppkey").alias("control_title")))
    stage3 = lines.select(*keys, position.alias("position"), F.lit("OBL-001").alias("obligation_id"), control.alias("control"))
    report = t.orders.select(F.col("o_custkey").alias("regulation_id")).distinct().withColumn("stage4_md", F.lit("report"))
    rows = W.assembled(stage1, stage2, stage3, report)
    return rows.select("regulation_id", "requirement_id", "criticality", "n_obligations", "n_controls", "stage4_md")


_GREEDY = """p AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i, t
    FROM (SELECT doc_id, trim(unnest(string_split(x, chr(10) || chr(10)))) AS t, generate_subscripts(string_split(x, chr(10) || chr(10)), 1) AS k FROM d) WHERE length(t) > 0),
  r AS (SELECT doc_id, i, 1::BIGINT AS c, length(t) AS n FROM p WHERE i = 1
    UNION ALL SELECT p.doc_id, p.i, r.c + CASE WHEN r.n + length(t) <= 1500 THEN 0 ELSE 1 END, CASE WHEN r.n + length(t) <= 1500 THEN r.n ELSE 0 END + length(t) FROM r JOIN p ON p.doc_id = r.doc_id AND p.i = r.i + 1),
  g AS (SELECT doc_id, c, string_agg(t, chr(10) || chr(10) ORDER BY i) AS x FROM r JOIN p USING (doc_id, i) GROUP BY 1, 2)"""


@query("O3 M1 H3 K3", rf"""WITH RECURSIVE d AS (SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS x FROM documents), {_GREEDY},
  w AS (SELECT doc_id, c, x FROM g JOIN (SELECT doc_id FROM d WHERE length(x) > 1500) USING (doc_id) UNION ALL SELECT doc_id, 1, x FROM d WHERE length(x) BETWEEN 300 AND 1500),
  s AS (SELECT doc_id, c, s FROM {_sentences("w", "doc_id, c", "x", 0)}),
  k AS (SELECT *, trim(regexp_replace(lower(s), '\s+', ' ', 'g'), ' .,:;!?') AS key FROM s)
  SELECT doc_id AS regulation_id, c AS source_chunk, md5(s) AS requirement FROM k WHERE length(key) > 0 QUALIFY row_number() OVER (PARTITION BY doc_id, key ORDER BY c, s) = 1""")  # fmt: skip
def chunked_requirements(t: Tables) -> DataFrame:
    """Long texts are read chunk by chunk; of requirements that are the same but for case and marks the first stays."""
    docs = t.documents.select(F.col("doc_id").alias("regulation_id"), F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("content_text"))
    return W.chunked_requirements(docs, PROVIDER, most=1500).select("regulation_id", "source_chunk", F.md5("requirement_text").alias("requirement"))


_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'fully_matched' WHEN 'P' THEN 'partially_matched' ELSE 'new' END"
_APPLIED = f"""WITH v AS (SELECT o_custkey AS reg, o_orderkey AS pos, 'Requirement ' || o_orderkey || repeat(' text', (o_orderkey % 40)::INT) AS t, {_STATUS} AS s, o_orderkey % 97 AS m FROM orders),
  f AS (SELECT *, row_number() OVER (PARTITION BY reg ORDER BY pos) - 1 AS n FROM v WHERE s = 'new'),
  i AS (SELECT v.reg, v.pos, l_linenumber, l_partkey AS part, CASE WHEN v.s <> 'new' THEN v.m END AS req, CASE l_returnflag WHEN 'A' THEN 'fully_matched' WHEN 'N' THEN 'partially_matched' ELSE 'new' END AS s FROM lineitem JOIN v ON v.pos = l_orderkey),
  o AS (SELECT DISTINCT pos % 97 AS req, part FROM i WHERE l_linenumber = 1),
  e AS (SELECT req, part, min((reg, s)) AS x FROM i WHERE s <> 'new' AND req IS NOT NULL AND NOT EXISTS (SELECT 1 FROM o WHERE o.req = i.req AND o.part = i.part) GROUP BY 1, 2),
  a AS (SELECT i.reg, i.part, coalesce(i.req::VARCHAR, 'AUTO-' || i.reg || '-0') AS req, i.req IS NOT NULL OR i.reg IN (SELECT reg FROM f) AS placed FROM i WHERE s = 'new')
  SELECT 'mapping' AS kind, reg AS regulation_id, s AS a, CASE WHEN s <> 'new' THEN m::VARCHAR END AS b, count(*) AS n FROM v GROUP BY ALL
  UNION ALL SELECT DISTINCT 'flagged', NULL, NULL, m::VARCHAR, 1 FROM v WHERE s = 'partially_matched'
  UNION ALL SELECT 'requirement', reg, 'AUTO-' || reg || '-' || n, CASE WHEN length(t) > 100 THEN left(t, 100) || '...' ELSE t END, 1 FROM f
  UNION ALL SELECT 'item', reg, 'C' || part, NULL, count(*) FROM a GROUP BY ALL
  UNION ALL SELECT 'link', x[1], req::VARCHAR, x[2], 1 FROM e
  UNION ALL SELECT 'link', reg, req, 'new', count(*) FROM a WHERE placed GROUP BY ALL"""


@query("O6 O4 B8 B9 B10 B11 D19", _APPLIED)
def apply_matches(t: Tables) -> DataFrame:
    """Mappings stored, partial ones flagged, new requirements and items inserted with keys, items without one hung on the first new requirement, links made."""
    key, status = F.col("o_orderkey"), F.when(F.col("o_orderstatus") == "F", "fully_matched").when(F.col("o_orderstatus") == "P", "partially_matched").otherwise("new")
    words = F.concat(F.lit("Requirement "), key.cast("string"), F.expr("repeat(' text', int(o_orderkey % 40))"))
    verdicts = t.orders.select(F.col("o_custkey").alias("regulation_id"), key.alias("position"), words.alias("requirement_text"), status.alias("match_status"), (key % 97).alias("matched_id"), F.lit("why").alias("explanation"))
    lines = t.obligations().join(verdicts.select("regulation_id", F.col("position").alias("requirement_id"), F.col("match_status").alias("s"), F.col("matched_id").alias("m")), "requirement_id")
    items = lines.select(
        "regulation_id", (F.col("requirement_id") * 10 + F.col("line")).alias("position"), F.concat(F.lit("C"), "part").alias("title"), F.lit("d").alias("description"),
        F.when(F.col("s") != "new", F.col("m")).alias("requirement_id"), "match_status", F.col("part").alias("matched_id"),
    )
    linked = lines.where("line = 1").select(F.col("m").alias("requirement_id"), F.col("part").alias("item_id")).distinct()
    out = W.apply_matches(verdicts, linked, items, 1_000_000, 5_000_000, Scratch(t.spark, "matches").write)
    text = lambda c: F.col(c).cast("string")
    named = out["requirements"].select("requirement_id", "ref_key")
    links = out["links"].join(named, "requirement_id", "left").select("regulation_id", F.coalesce("ref_key", text("requirement_id")).alias("a"), F.col("match_status").alias("b"))
    nothing = F.lit(None).cast("string")
    parts = {
        "mapping": out["mappings"].select("regulation_id", F.col("match_status").alias("a"), text("matched_requirement_id").alias("b")),
        "flagged": out["flagged"].select(F.lit(None).cast("long").alias("regulation_id"), nothing.alias("a"), text("requirement_id").alias("b")),
        "requirement": out["requirements"].select("regulation_id", F.col("ref_key").alias("a"), F.col("title").alias("b")),
        "item": out["items"].select("regulation_id", F.col("title").alias("a"), nothing.alias("b")),
        "old": links.where("b <> 'new'"),
        "new": links.where("b = 'new'"),
    }
    whole = None
    for kind, df in parts.items():
        one = df.withColumn("kind", F.lit("link" if kind in ("old", "new") else kind))
        one = one.withColumn("one", F.monotonically_increasing_id()) if kind == "old" else one.withColumn("one", F.lit(0).cast("long"))
        whole = one if whole is None else whole.unionByName(one)
    return whole.groupBy("kind", "regulation_id", "a", "b", "one").agg(F.count("*").alias("n")).drop("one")


_SHINGLED = r"(SELECT DISTINCT {keys}, list_slice(w, i, i + 2) AS g FROM (SELECT {keys}, w, unnest(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 1, 2) END)) AS i FROM (SELECT {keys}, list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM {table})))"


@query("O7 D18 E13", f"""WITH u AS (SELECT doc_id AS upload_id, doc_id % 10 AS reg, text, CASE WHEN length(text) < 50 THEN 'refused' WHEN length(text) > 2000 THEN 'chunked' ELSE 'single' END AS mode FROM documents WHERE text IS NOT NULL),
  c AS (SELECT upload_id, reg, k + 1 AS chunk_num, substr(text, k * 2000 + 1, 2000) AS t FROM (SELECT *, unnest(range(0, greatest(ceil(length(text) / 2000.0), 1)::BIGINT)) AS k FROM u WHERE mode <> 'refused')),
  b AS (SELECT item_id, item_id % 10 AS reg, text FROM benchmark),
  bs AS (SELECT *, count(*) OVER (PARTITION BY item_id) AS n_items FROM {_SHINGLED.format(keys="item_id, reg", text="text", table="b")}),
  p AS (SELECT item_id, upload_id, chunk_num, count(*) AS n, any_value(n_items) AS n_items FROM bs JOIN {_SHINGLED.format(keys="upload_id, reg, chunk_num", text="t", table="c")} USING (reg, g) GROUP BY 1, 2, 3),
  m AS (SELECT *, CASE WHEN 100 * n >= 80 * n_items THEN 2 WHEN 100 * n >= 30 * n_items THEN 1 ELSE 0 END AS r FROM p QUALIFY row_number() OVER (PARTITION BY item_id, upload_id ORDER BY r DESC, chunk_num) = 1)
  SELECT u.upload_id, mode, u.reg AS regulation_id, b.item_id AS id, ['missing', 'partial', 'covered'][coalesce(r, 0) + 1] AS coverage_status, CASE WHEN r > 0 THEN md5(left(c.t, 200)) END AS evidence,
    CASE WHEN coalesce(r, 0) = 0 THEN 'Obligation not found in uploaded document.' END AS gap_description
  FROM u JOIN b USING (reg) LEFT JOIN m ON m.upload_id = u.upload_id AND m.item_id = b.item_id LEFT JOIN c ON c.upload_id = m.upload_id AND c.chunk_num = m.chunk_num WHERE mode <> 'refused'
  UNION ALL SELECT upload_id, mode, NULL, NULL, NULL, NULL, NULL FROM u WHERE mode = 'refused' OR reg NOT IN (SELECT reg FROM b)""")  # fmt: skip
def gap_modes(t: Tables) -> DataFrame:
    """Uploads refused, read at once or in chunks; the best verdict over chunks, missing where there is none."""
    obligations = t.benchmark.select((F.col("item_id") % 10).alias("regulation_id"), F.col("item_id").alias("id"), "text")
    uploads = t.documents.where("text is not null").select(F.col("doc_id").alias("upload_id"), (F.col("doc_id") % 10).alias("regulation_id"), "text")
    found = W.gap_analysis(obligations, uploads, PROVIDER, most=2000)
    return found.select("upload_id", "mode", "regulation_id", "id", "coverage_status", F.md5("evidence_text").alias("evidence"), "gap_description")


_RECORD = """doc_id, CASE WHEN doc_id % 3 = 0 THEN 'R1' ELSE 'R2' END AS regulator, CASE WHEN doc_id % 7 = 0 THEN 'Regulatory Returns' ELSE 'Circular' END AS category, CASE WHEN doc_id % 11 = 0 THEN 'UNDATED' ELSE 'TABLES' END AS source_system,
  CASE WHEN doc_id % 5 <> 0 THEN '01/02/2020' END AS published_date, 'T' || doc_id % 500 AS title, [source, lang] AS doc_path, CASE WHEN doc_id % 13 <> 0 THEN 'https://regulator.example/' || doc_id % 600 END AS source_page_url"""


@query("O11 C13 D9 D10 D11 H8", f"""WITH i AS (SELECT {_RECORD}, CASE WHEN quality = 0 THEN 'modified' ELSE 'unchanged' END AS monitoring_status FROM documents LEFT JOIN labels USING (doc_id)),
  s AS (SELECT {_RECORD} FROM documents WHERE doc_id % 2 = 0)
  SELECT doc_id, CASE WHEN NOT usable THEN 'skip' WHEN regulator = 'R1' AND old AND monitoring_status = 'modified' THEN 'update_version' WHEN old THEN 'existing' WHEN category = 'Regulatory Returns' THEN 'insert_only' WHEN regulator = 'R1' THEN 'insert_version' ELSE 'insert' END AS action
  FROM (SELECT *, CASE WHEN regulator = 'R1' THEN source_page_url IS NOT NULL ELSE published_date IS NOT NULL OR category = 'Regulatory Returns' OR source_system = 'UNDATED' END AS usable,
    CASE WHEN regulator = 'R1' THEN EXISTS (SELECT 1 FROM s WHERE s.regulator = 'R1' AND s.source_page_url = i.source_page_url)
      ELSE EXISTS (SELECT 1 FROM s WHERE s.title = i.title AND s.published_date IS NOT DISTINCT FROM i.published_date AND s.doc_path = i.doc_path) END AS old FROM i)""")  # fmt: skip
def ingest_actions(t: Tables) -> DataFrame:
    """What happens to each crawled document: skipped, known, inserted with or without a version, or given a new version."""
    k = F.col("doc_id")
    record = [
        k, F.when(k % 3 == 0, "R1").otherwise("R2").alias("regulator"), F.when(k % 7 == 0, "Regulatory Returns").otherwise("Circular").alias("category"), F.when(k % 11 == 0, "UNDATED").otherwise("TABLES").alias("source_system"),
        F.when(k % 5 != 0, "01/02/2020").alias("published_date"), F.concat(F.lit("T"), (k % 500).cast("string")).alias("title"), F.array("source", "lang").alias("doc_path"),
        F.when(k % 13 != 0, F.concat(F.lit("https://regulator.example/"), (k % 600).cast("string"))).alias("source_page_url"),
    ]
    changed = t.labels.select("doc_id", F.when(F.col("quality") == 0, "modified").otherwise("unchanged").alias("monitoring_status"))
    incoming = t.documents.select(*record).join(changed, "doc_id", "left")
    stored = t.documents.where(k % 2 == 0).select(*record)
    return W.ingest(incoming, stored, "R1").select("doc_id", "action")


_UPLOADS = r"""(SELECT doc_id, 'my_file-' || doc_id || '.' || ['pdf', 'docx', 'PDF', 'exe'][doc_id % 4 + 1] AS filename, trim(regexp_replace(text, '\s+', ' ', 'g')) AS x, length(text) AS n,
  CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE 'Title ' || doc_id END AS raw, CASE doc_id % 3 WHEN 0 THEN '02/01/2020' WHEN 1 THEN '1447/07/09' END AS published_date, CASE doc_id % 3 WHEN 0 THEN '2020' END AS year FROM documents)"""


@query("O12 A16 O13 I7 U19 E5", f"""WITH u AS (SELECT *, CASE WHEN doc_id % 4 = 3 THEN 'unsupported' WHEN coalesce(n, 0) < 100 THEN 'too_short' ELSE 'accepted' END AS status FROM {_UPLOADS}),
  ok AS (SELECT filename, x FROM u WHERE status = 'accepted'),
  s AS (SELECT filename, count(*) AS n_obligations, count(*) FILTER (exec = 'Ongoing_Control') AS n_controls, min(s) AS first, {_CRIT} AS crit FROM {_sentences("ok", "filename", "x", 100)} GROUP BY 1),
  sg AS (SELECT *, count(*) OVER (PARTITION BY filename) AS n_items FROM {_SHINGLED.format(keys="filename", text="first", table="s")}),
  m AS (SELECT filename, CASE WHEN 100 * max(c) >= 90 * any_value(n_items) THEN 'fully_matched' WHEN 100 * max(c) >= 30 * any_value(n_items) THEN 'partially_matched' ELSE 'new' END AS status
    FROM (SELECT filename, item_id, count(*) AS c, any_value(n_items) AS n_items FROM sg JOIN {_SHINGLED.format(keys="item_id", text="text", table="benchmark")} USING (g) GROUP BY 1, 2) GROUP BY 1)
  SELECT u.filename, u.status, CASE WHEN u.status = 'accepted' THEN coalesce(raw, 'my file ' || doc_id) END AS title, CASE WHEN u.status = 'accepted' THEN published_date END AS published_date, CASE WHEN u.status = 'accepted' THEN year END AS year,
    CASE WHEN s.filename IS NOT NULL THEN 1::BIGINT END AS n_requirements, n_obligations, n_controls, (crit = 'High')::BIGINT AS high, (crit = 'Medium')::BIGINT AS medium, (crit = 'Low')::BIGINT AS low,
    CASE WHEN s.filename IS NOT NULL THEN (coalesce(m.status, 'new') = 'fully_matched')::BIGINT END AS fully_matched, CASE WHEN s.filename IS NOT NULL THEN (coalesce(m.status, 'new') = 'partially_matched')::BIGINT END AS partially_matched,
    CASE WHEN s.filename IS NOT NULL THEN (coalesce(m.status, 'new') = 'new')::BIGINT END AS new
  FROM u LEFT JOIN s USING (filename) LEFT JOIN m ON m.filename = u.filename""")  # fmt: skip
def upload_summary(t: Tables) -> DataFrame:
    """Uploads refused by type or length, the rest read, named, stored with keys, analysed and matched."""
    k = F.col("doc_id")
    ending = F.get(F.array(*map(F.lit, ("pdf", "docx", "PDF", "exe"))), (k % 4).cast("int"))
    pick = lambda *v: F.get(F.array(*(x if not isinstance(x, str) else F.lit(x) for x in v)), (k % 3).cast("int"))
    uploads = t.documents.select(
        F.concat(F.lit("my_file-"), k.cast("string"), F.lit("."), ending).alias("filename"), F.lit(" r1 ").alias("regulator"), F.col("text").alias("content_text"),
        pick("", "null", F.concat(F.lit("Title "), k.cast("string"))).alias("title"), pick("2020-01-02", "1447/07/09", "January").alias("published_date"),
    )
    out = W.upload_pipeline(uploads, PROVIDER, t.benchmark, 1000, Scratch(t.spark, "upload").write)
    return out["summary"].drop("regulation_id")


@query("B16 N6 O18", """WITH n AS (SELECT doc_id % 50 AS regulation_id, 2 AS version_no, doc_id AS row_id FROM documents WHERE doc_id % 50 < 20)
  SELECT regulation_id, version_no, row_id, 'new' AS made FROM n
  UNION ALL SELECT o_orderkey % 50, 1 + o_orderkey % 3, o_orderkey, 'old' FROM orders WHERE NOT (1 + o_orderkey % 3 = 2 AND o_orderkey % 50 IN (SELECT regulation_id FROM n))""")  # fmt: skip
def backfill_version(t: Tables) -> DataFrame:
    """All analysis rows of the versions that were analysed again are replaced; those of other versions stay."""
    key = F.col("o_orderkey")
    old = t.orders.select((key % 50).alias("regulation_id"), (1 + key % 3).cast("int").alias("version_no"), key.alias("row_id"), F.lit("old").alias("made"))
    new = t.documents.select((F.col("doc_id") % 50).alias("regulation_id"), F.lit(2).alias("version_no"), F.col("doc_id").alias("row_id"), F.lit("new").alias("made")).where("regulation_id < 20")
    return M.replace_rows(old, new, ["regulation_id", "version_no"])


@query("K5 K6 K7 K2", """WITH c AS (SELECT l_orderkey, l_linenumber, max(l_suppkey) AS supp FROM lineitem WHERE l_suppkey % 3 <> 0 GROUP BY 1, 2)
  SELECT l_orderkey AS requirement_id, l_linenumber AS line, l_partkey AS part, 'Contrôle ' || supp AS control_title, false AS has_internal, count(*) AS n FROM lineitem LEFT JOIN c USING (l_orderkey, l_linenumber) GROUP BY ALL""")  # fmt: skip
def struct_merge(t: Tables) -> DataFrame:
    """Each obligation of a nested row gets the control of its number from a map, loses an internal field, and goes through JSON."""
    dealt = t.obligations().select("requirement_id", "line", "part", "supp").repartition(t.parts("lineitem"), "requirement_id")
    nested = dealt.groupBy("requirement_id").agg(F.collect_list(F.struct("line", "part", F.lit("x").alias("internal"))).alias("obligations"))
    last = dealt.where("supp % 3 <> 0").groupBy("requirement_id", "line").agg(F.max("supp").alias("supp"))
    named = F.struct("line", F.struct(F.concat(F.lit("Contrôle "), F.col("supp").cast("string")).alias("control_title")).alias("control"))
    maps = last.groupBy("requirement_id").agg(F.map_from_entries(F.collect_list(named)).alias("controls"))
    both = nested.join(maps, "requirement_id", "left")

    def one(o):
        kept = structured.without(o, "internal")
        return structured.merged(kept, F.struct(F.try_element_at("controls", o["line"]).alias("control")), fields=[["line", "part"], ["control"]])

    text = structured.encoded(F.transform("obligations", one))
    read = F.explode(F.from_json(text, "array<struct<line:int,part:long,control:struct<control_title:string>,internal:string>>"))
    rows = both.select("requirement_id", read.alias("o")).select("requirement_id", "o.line", "o.part", F.col("o.control.control_title").alias("control_title"), F.col("o.internal").isNotNull().alias("has_internal"))
    return rows.groupBy("requirement_id", "line", "part", "control_title", "has_internal").agg(F.count("*").alias("n"))
