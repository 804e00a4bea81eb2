"""Text, date, JSON and markup scalars, and chunking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.functions import dates, markup, structured, text
from docfold.operators import chunking, language
from docfold.plans.catalog import query
from docfold.scratch import Scratch
from docfold.sources.tables import Tables

HOST = "https://regulator.example"
#: The regular-expression form of HTML to text, in SQL.
_STRIP = "html"
for _name in ("script", "style", "noscript", "header", "footer", "svg"):
    _STRIP = rf"regexp_replace({_STRIP}, '(?is)<{_name}\b[^>]*>.*?</{_name}>', ' ', 'g')"
HTML_SQL = rf"trim(regexp_replace(regexp_replace(regexp_replace({_STRIP}, '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"


def n(c):
    return F.length(c).cast("long")


@query("I1", r"SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS h FROM documents")
def normalize_ws(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(text.clean(F.col("text"))).alias("h"))


@query("I2", r"SELECT doc_id, md5(trim(regexp_replace(lower(text), '\s+', ' ', 'g'), ' .,:;!?')) AS h FROM documents")
def normalize_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(text.normalize_text(F.col("text"))).alias("h"))


@query("I3", r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]{2,}', ' ', 'g'))) AS h FROM documents")
def post_clean(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(text.post_clean(F.col("text"))).alias("h"))


@query("I4", rf"""SELECT 'document' AS kind, doc_id AS id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS h FROM documents
  UNION ALL SELECT 'page', page_id, md5(CASE WHEN contains(left(html, 300), 'PAGE') AND contains(left(html, 300), repeat('=', 60)) THEN trim(regexp_replace(html, '\s+', ' ', 'g')) ELSE {HTML_SQL} END) FROM pages""")  # fmt: skip
def normalize_input(t: Tables) -> DataFrame:
    rows = t.documents.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("c"), F.lit("pdf_text").alias("type"))
    rows = rows.unionByName(t.pages.select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("c"), F.lit("html").alias("type")))
    return rows.select("kind", "id", F.md5(text.normalize_input(F.col("c"), F.col("type"), markup.html_to_text)).alias("h"))


@query("I12 U6", "SELECT doc_id, md5(coalesce(nullif(text, ''), source)) AS h FROM documents")
def content_hash(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.content_hash(F.col("text"), F.col("source")).alias("h"))


_HITS = ", ".join(f"[len(list_filter(w, lambda x: x IN ({', '.join(repr(m) for m in ms)}))), {-i}]" for i, ms in enumerate(text.MARKERS.values()))
_LANG = " ".join(f"WHEN {-i} THEN '{k}'" for i, k in enumerate(text.MARKERS))


@query("M7", rf"""SELECT doc_id, CASE WHEN length(trim(text)) < 20 THEN 'unknown' WHEN ar > 0.2 THEN 'ar' ELSE CASE greatest({_HITS})[2] {_LANG} END END AS detected FROM (
  SELECT doc_id, text, string_split(lower(text), ' ') AS w, length(regexp_replace(regexp_replace(left(text, 500), '\s', '', 'g'), '[^\x{{0600}}-\x{{06FF}}]', '', 'g')) / greatest(length(regexp_replace(left(text, 500), '\s', '', 'g')), 1) AS ar FROM documents)""")  # fmt: skip
def lang_rule(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.language(F.col("text")).alias("detected"))


@query("E16 I18", "SELECT doc_id, length(text)::BIGINT AS chars, length(text) // 4 AS est_tokens, length(text) > 12000 AS needs_chunking, length(text) >= 300 AS sufficient FROM documents")
def text_stats(t: Tables) -> DataFrame:
    c = F.col("text")
    return t.documents.select("doc_id", n(c).alias("chars"), text.tokens(c).alias("est_tokens"), (F.length(c) > chunking.CHUNK).alias("needs_chunking"), text.at_least(c, text.V1_MIN).alias("sufficient"))


@query("C22", "SELECT doc_id, length(text) >= 50 AS gap, length(text) >= 100 AS upload, length(text) >= 200 AS analysis, length(text) >= 300 AS v1 FROM documents")
def length_gates(t: Tables) -> DataFrame:
    gates = {"gap": text.UPLOAD_GAP_MIN, "upload": text.UPLOAD_MIN, "analysis": text.ANALYSIS_MIN, "v1": text.V1_MIN}
    return t.documents.select("doc_id", *(text.at_least(F.col("text"), k).alias(name) for name, k in gates.items()))


@query("C14", r"""SELECT doc_id, length(trim(text)) < 200 OR len(regexp_extract_all(text, '[^ \t\n\r\f\x0B]{4,}')) < 30 OR (length(text) - length(regexp_replace(text, '[0-9]', '', 'g'))) * 2 > length(text)
  OR NOT regexp_matches(text, '[A-Za-z]{3}') AS bad FROM documents""")  # fmt: skip
def bad_page(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.bad_page(F.col("text")).alias("bad"))


@query("C15", r"""SELECT doc_id, coalesce(length(regexp_replace(left(text, 500), '[^\p{L}\p{M}\p{N}\p{P}\p{S} \n\r\t]', '', 'g')) < 0.7 * length(left(text, 500)) OR (length(text) - length(replace(text, '\u', ''))) / 2 > 15, false) AS broken FROM documents""")
def broken_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.broken_text(F.col("text")).alias("broken"))


@query("C16", """SELECT doc_id, avg(length(l)) FILTER (i <= 3) < 100 AS scanned FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents) GROUP BY 1""")
def scanned_docs(t: Tables) -> DataFrame:
    head = F.slice(F.split("text", "\n"), 1, 3)
    total = F.aggregate(head, F.lit(0), lambda a, x: a + F.length(x))
    return t.documents.select("doc_id", (total / F.size(head) < 100).alias("scanned"))


@query("C17", "SELECT doc_id FROM documents WHERE NOT (contains(lower(text), 'licensed under') OR contains(lower(text), 'stupid') OR contains(lower(text), '***'))")
def blocklist_filter(t: Tables) -> DataFrame:
    return t.documents.where(~text.blocked(F.col("text"), ["licensed under", "stupid", "***"])).select("doc_id")


@query("C19 C20 C21 U19", """SELECT doc_id, length(text) > 0 AND length(source) > 0 AS complete, CASE WHEN lang IN ('en', 'fr') THEN lang ELSE 'en' END AS lang, starts_with(lower(trim(text)), 'annex') AND len(string_split(trim(text), ' ')) <= 3 AS annexure FROM documents""")
def field_checks(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.complete(F.col("text"), F.col("source")).alias("complete"), text.one_of(F.col("lang"), ("en", "fr"), "en").alias("lang"), text.is_annexure(F.col("text")).alias("annexure"))


def _tiers(t: Tables, strict: bool) -> DataFrame:
    both = t.documents.select("doc_id", "text", "source").join(t.pages.select(F.col("page_id").alias("doc_id"), "html"), "doc_id", "left")
    pdf = F.when(F.substring("source", -1, 1) == "3", F.col("text"))  # of some sources only the extracted PDF text is there
    tiers = [(pdf, "pdf_text"), (F.col("html"), "html"), (F.col("text"), "raw")]
    found = text.first_tier(tiers, text.INGEST_MIN, strict, strict_from=0)
    return both.select("doc_id", found.alias("f")).select("doc_id", F.col("f.content_type").alias("content_type"), n("f.content").alias("chars"))


def _tier_sql(op: str) -> str:
    pdf = "CASE WHEN right(source, 1) = '3' THEN text END"
    case = lambda a, b, c: f"CASE WHEN length(trim({pdf})) {op} 200 THEN {a} WHEN length(trim(html)) {op} 200 THEN {b} WHEN length(trim(text)) {op} 200 THEN {c} END"
    return f"""SELECT doc_id, {case("'pdf_text'", "'html'", "'raw'")} AS content_type, {case("length(text)", "length(html)", "length(text)")}::BIGINT AS chars FROM documents LEFT JOIN pages ON page_id = doc_id"""


@query("C11", _tier_sql(">="))
def content_tiers(t: Tables) -> DataFrame:
    return _tiers(t, strict=False)


@query("C12", _tier_sql(">"))
def content_tiers_strict(t: Tables) -> DataFrame:
    return _tiers(t, strict=True)


@query("C10", "SELECT doc_id, coalesce(nullif(lang, ''), nullif(source, ''), 'none') AS v FROM documents")
def falsy_default(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.or_else(F.col("lang"), F.col("source"), F.lit("none")).alias("v"))


@query("L1", f"SELECT page_id, md5({HTML_SQL}) AS h, length({HTML_SQL})::BIGINT AS chars FROM pages")
def html_to_text(t: Tables) -> DataFrame:
    return t.pages.select("page_id", markup.html_to_text(F.col("html")).alias("x")).select("page_id", F.md5("x").alias("h"), n("x").alias("chars"))


_LINKS = "(SELECT page_id, u, i FROM (SELECT page_id, unnest(l) AS u, generate_subscripts(l, 1) - 1 AS i FROM (SELECT page_id, regexp_extract_all(html, 'href=\"([^\"]*)\"', 1) AS l FROM pages)))"


def _links(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.posexplode(markup.hrefs(F.col("html"))).alias("i", "u")).withColumn("i", F.col("i").cast("long"))


@query("L2 U9", f"SELECT page_id, i, u FROM {_LINKS}")
def extract_links(t: Tables) -> DataFrame:
    return _links(t)


_KIND = r"CASE WHEN regexp_matches(lower(u), '\.pdf($|[?#])') THEN 'pdf' WHEN contains(lower(u), 'faq') THEN 'faq' ELSE 'other' END"


@query("L3 U7", f"SELECT page_id, {_KIND} AS kind, count(*) AS n, arg_min(u, i) AS primary_link FROM {_LINKS} GROUP BY 1, 2")
def link_types(t: Tables) -> DataFrame:
    return _links(t).groupBy("page_id", markup.link_kind(F.col("u")).alias("kind")).agg(F.count("*").alias("n"), F.min_by("u", "i").alias("primary_link"))


@query("I9", f"SELECT DISTINCT CASE WHEN regexp_matches(u, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN u WHEN starts_with(u, '/') THEN '{HOST}' || u ELSE '{HOST}/' || u END AS link FROM {_LINKS}")
def absolute_links(t: Tables) -> DataFrame:
    return _links(t).select(text.absolute_link(F.col("u"), F.lit(HOST)).alias("link")).distinct()


@query("H5", f"SELECT u AS link, min(page_id) AS first_page, count(*) AS n FROM {_LINKS} GROUP BY 1")
def dedup_links(t: Tables) -> DataFrame:
    return _links(t).groupBy(F.col("u").alias("link")).agg(F.min("page_id").alias("first_page"), F.count("*").alias("n"))


@query("L9", r"SELECT page_id, len(l) AS n_nodes, md5(array_to_string(l, '|')) AS h FROM (SELECT page_id, list_filter(regexp_extract_all(html, '>([^<]+)<', 1), lambda x: regexp_matches(x, '\S')) AS l FROM pages)")
def text_nodes(t: Tables) -> DataFrame:
    nodes = t.pages.select("page_id", markup.text_nodes(F.col("html")).alias("l"))
    return nodes.select("page_id", F.size("l").cast("long").alias("n_nodes"), F.md5(F.array_join("l", "|")).alias("h"))


@query("L10", r"""SELECT page_id, md5(regexp_replace(html, '(?is)^(.*?)<(div|p|section|article|table|ul|ol|h[1-6])\b', '\1<\2 dir="rtl"')) AS h FROM pages""")
def inject_rtl(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.md5(markup.right_to_left(F.col("html"))).alias("h"))


@query("I8", r"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,
  nullif(lower(regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '\.([A-Za-z0-9]+)$', 1)), '') AS extension FROM pages""")  # fmt: skip
def url_parts(t: Tables) -> DataFrame:
    u = F.col("url")
    return t.pages.select("page_id", text.url_host(u).alias("host"), text.url_path(u).alias("path"), text.url_extension(u).alias("extension"))


@query("I11", "SELECT page_id, CASE WHEN regexp_matches(url, '/(fr|de)/') THEN 'circular' WHEN contains(url, 'page=') THEN 'listing' ELSE 'letter' END AS kind FROM pages")
def classify_url(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.classify_url(F.col("url"), [("/(fr|de)/", "circular"), ("page=", "listing")], "letter").alias("kind"))


@query("U4", r"SELECT page_id, nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS node_id FROM pages")
def node_id(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.nullif(F.regexp_extract("url", "/([0-9]+)", 1), F.lit("")).alias("node_id"))


@query("M1 F3", """WITH RECURSIVE p AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i, t
    FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents) WHERE length(t) > 0),
  r AS (SELECT doc_id, i, 1::BIGINT AS c, length(t) AS n FROM p WHERE i = 1
    UNION ALL SELECT p.doc_id, p.i, r.c + CASE WHEN r.n + length(t) <= 1000 THEN 0 ELSE 1 END, CASE WHEN r.n + length(t) <= 1000 THEN r.n ELSE 0 END + length(t) FROM r JOIN p ON p.doc_id = r.doc_id AND p.i = r.i + 1)
  SELECT doc_id, c AS chunk_num, string_agg(t, chr(10) ORDER BY i) AS chunk_text FROM r JOIN p USING (doc_id, i) GROUP BY 1, 2""")
def chunk_greedy(t: Tables) -> DataFrame:
    chunks = t.documents.select("doc_id", F.posexplode(chunking.greedy(F.col("text"), 1000, "\n")).alias("i", "chunk_text"))
    return chunks.select("doc_id", (F.col("i") + 1).cast("long").alias("chunk_num"), "chunk_text")


def _fixed(t: Tables) -> DataFrame:
    return chunking.fixed(t.documents, "doc_id", "text", 500)


_FIXED = """(SELECT doc_id, k + 1 AS chunk_num, greatest(ceil(length(text) / 500.0), 1)::BIGINT AS total_chunks, k * 500 AS char_start, least(k * 500 + 500, length(text)) AS char_end, substring(text, k * 500 + 1, 500) AS chunk_text
  FROM (SELECT doc_id, text, unnest(range(0, greatest(ceil(length(text) / 500.0), 1)::BIGINT)) AS k FROM documents))"""


@query("M5 F3", f"SELECT * FROM {_FIXED}")
def chunk_fixed(t: Tables) -> DataFrame:
    return _fixed(t)


@query("M6 F8", f"""SELECT doc_id, chunk_num, 'Document: ' || source || ' | Chunk ' || chunk_num || ' of ' || total_chunks || CASE WHEN chunk_num > 1 THEN ' | Continuation' ELSE '' END
  || CASE WHEN chunk_num < total_chunks THEN ' | Continues' ELSE '' END AS header FROM {_FIXED} JOIN documents USING (doc_id)""")  # fmt: skip
def chunk_context(t: Tables) -> DataFrame:
    chunks = chunking.fixed(t.documents.withColumn("key", F.struct("doc_id", "source")), "key", "text", 500)
    return chunks.select("key.doc_id", "chunk_num", chunking.context(F.col("key.source"), F.col("chunk_num"), F.col("total_chunks")).alias("header"))


@query("E15", f"""SELECT doc_id, count(*) AS n_chunks, sum(n)::BIGINT AS total_chars, (sum(n) // count(*))::BIGINT AS avg_chars, min(n) AS min_chars, max(n) AS max_chars, (sum(n) // 4)::BIGINT AS est_tokens
  FROM (SELECT doc_id, length(chunk_text) AS n FROM {_FIXED}) GROUP BY 1""")  # fmt: skip
def chunk_stats(t: Tables) -> DataFrame:
    return chunking.chunk_stats(_fixed(t), "doc_id")


@query("M6", r"SELECT doc_id, len(s) AS n_sections, length(s[1])::BIGINT AS first_length FROM (SELECT doc_id, string_split(regexp_replace(text, '\n([A-Z])', chr(1) || '\1', 'g'), chr(1)) AS s FROM documents)")
def line_sections(t: Tables) -> DataFrame:
    s = t.documents.select("doc_id", chunking.line_sections(F.col("text")).alias("s"))
    return s.select("doc_id", F.size("s").cast("long").alias("n_sections"), n(F.get("s", F.lit(0))).alias("first_length"))


def _back(mark: str) -> str:
    """Where a mark occurs last in the window w, after its half; the window then ends behind it."""
    cut = f"length(w) - strpos(reverse(w), reverse({mark})) - length({mark}) + 1"
    return f"CASE WHEN contains(w, {mark}) AND {cut} > 1000 THEN {cut} + length({mark}) END"


@query("M3 M4", f"""WITH RECURSIVE c AS (SELECT doc_id, text, 0 AS pos, 1::BIGINT AS chunk_num, substr(text, 1, 2000) AS w, length(text) > 2000 AS more FROM documents WHERE length(text) > 0
    UNION ALL SELECT doc_id, text, nxt, chunk_num + 1, substr(text, nxt + 1, 2000), length(text) > nxt + 2000
    FROM (SELECT *, greatest(pos + 1, pos + coalesce({_back("chr(10) || chr(10)")}, {_back("'. '")}, {_back("chr(10)")}, 2000) - 200) AS nxt FROM c) WHERE more)
  SELECT doc_id, chunk_num, pos::BIGINT AS char_start, CASE WHEN more THEN substr(w, 1, coalesce({_back("chr(10) || chr(10)")}, {_back("'. '")}, {_back("chr(10)")}, 2000)) ELSE w END AS chunk_text FROM c""")  # fmt: skip
def chunk_overlap(t: Tables) -> DataFrame:
    chunks = t.documents.select("doc_id", F.posexplode(chunking.overlapping(F.col("text"), 2000, 200)).alias("i", "c"))
    return chunks.select("doc_id", (F.col("i") + 1).cast("long").alias("chunk_num"), "c.char_start", "c.chunk_text")


@query("I20", r"""SELECT doc_id, i, CASE WHEN regexp_matches(l, '^([-*•]|[0-9]+[.)])\s') THEN 'list' WHEN length(l) < 80 AND (upper(l) = l OR NOT regexp_matches(l, '[.,;:!?]$')) AND regexp_matches(l, '[A-Za-z]') THEN 'heading' ELSE 'paragraph' END AS kind
  FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS l, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)""")  # fmt: skip
def classify_lines(t: Tables) -> DataFrame:
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "l"))
    return lines.select("doc_id", F.col("i").cast("long").alias("i"), text.line_kind(F.col("l")).alias("kind"))


@query("I6", r"""SELECT page_id, left(trim(regexp_replace(regexp_replace(url, '[\\/*?:"<>|\x00-\x1F]', '_', 'g'), ' +', ' ', 'g')), 200) AS name FROM pages""")
def sanitize_name(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.sanitize_name(F.col("url")).alias("name"))


@query("G7 B11", "SELECT doc_id, CASE WHEN length(text) > 100 THEN left(text, 100) || '...' ELSE text END AS title FROM documents")
def title_truncate(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.truncated(F.col("text"), 100).alias("title"))


@query("C2 C3 J1", """SELECT event_id, strftime(try_strptime(s, '%d/%m/%Y'), '%Y-%m-%d') AS day, try_cast(v AS BIGINT) AS k FROM (
  SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'not a date' ELSE strftime(ts, '%d/%m/%Y') END AS s, CASE WHEN event_id % 7 = 0 THEN 'x' ELSE event_id::VARCHAR END AS v FROM events)""")  # fmt: skip
def try_parse_dates(t: Tables) -> DataFrame:
    raw = F.when(F.col("event_id") % 5 == 0, "not a date").otherwise(F.date_format("ts", "dd/MM/yyyy"))
    v = F.when(F.col("event_id") % 7 == 0, "x").otherwise(F.col("event_id").cast("string"))
    return t.events.select("event_id", F.date_format(dates.day_first(raw), "yyyy-MM-dd").alias("day"), v.try_cast("long").alias("k"))


@query("J2", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%d/%m/%Y') WHEN 1 THEN strftime(ts, '%d/%m/%Y')
  WHEN 2 THEN CASE WHEN event_id % 5 IN (1, 2, 3) THEN (12 + event_id % 5)::VARCHAR || strftime(ts, '%y/%m/%d') END END AS day FROM events""")  # fmt: skip
def validate_date(t: Tables) -> DataFrame:
    k = F.col("event_id") % 4
    raw = F.when(k == 0, F.date_format("ts", "dd/MM/yyyy")).when(k == 1, F.date_format("ts", "yyyy-MM-dd")).when(k == 2, F.concat((12 + F.col("event_id") % 5).cast("string"), F.date_format("ts", "yy/MM/dd"))).otherwise(F.date_format("ts", "MMM yyyy"))
    return t.events.select("event_id", dates.validate_date(raw).alias("day"))


@query("J3 J4 J5 J6", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y') WHEN 2 THEN '1447' END AS year, strftime(ts, '%Y-%m-%d') AS day FROM events")
def extract_year(t: Tables) -> DataFrame:
    k = F.col("event_id") % 4  # two digits are no year, nor is the end of four parts
    raw = F.when(k == 0, F.date_format("ts", "'issued' d MMMM yyyy")).when(k == 1, F.date_format("ts", "dd/MM/yy")).when(k == 2, "09/07/1447").otherwise(F.date_format("ts", "d/M/yy/'1447'"))
    return t.events.select("event_id", dates.extract_year(raw).alias("year"), F.date_format(dates.date_in_cell(F.concat(F.lit("dated ‎"), F.date_format("ts", "d MMM yyyy"))), "yyyy-MM-dd").alias("day"))


@query("K1", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE (props->>'k')::BIGINT END AS k FROM events")
def json_tolerant(t: Tables) -> DataFrame:
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("{{"), "props")).otherwise(F.col("props"))
    return t.events.select("event_id", F.from_json(raw, "k long")["k"].alias("k"))


@query("K8", "SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def fence_strip(t: Tables) -> DataFrame:
    body = F.regexp_replace("props", r"\}$", ",}")
    fenced = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    return t.events.select("event_id", F.from_json(structured.unfenced(fenced), "k long")["k"].alias("k"))


@query("K9", """SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE (props->>'k')::BIGINT END AS k, event_id % 4 = 1 AS listed, CASE WHEN event_id % 4 = 3 THEN '[]' END AS none FROM events""")
def json_salvage(t: Tables) -> DataFrame:
    """Trailing commas and prose, an object before the one with the requirements, whole JSON, and no JSON."""
    k = F.col("event_id") % 4
    broken = F.regexp_replace("props", r"\}$", ",}")
    noisy = (
        F.when(k == 0, F.concat(F.lit("Here you are: "), broken, F.lit(" Anything else?")))
        .when(k == 1, F.concat(F.lit('Note {"k": -1}. Answer: ```json\n{"about": {"k": -2}, "requirements": ['), broken, F.lit(",]}\n```")))
        .when(k == 2, F.col("props"))
        .otherwise("I found nothing {to list")
    )
    read = t.events.select("event_id", (k == 1).alias("listed"), structured.salvage_json(noisy).alias("j"))
    value = F.coalesce(F.get_json_object("j", "$.requirements[0].k"), F.get_json_object("j", "$.k")).cast("long")
    return read.select("event_id", value.alias("k"), "listed", F.when(F.get_json_object("j", "$.requirements") == "[]", "[]").alias("none"))


@query("O5 C21", """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'fully_matched' WHEN 1 THEN 'partially_matched' ELSE 'new' END AS match_status, CASE WHEN event_id % 4 < 2 THEN event_id END AS matched_id,
  CASE WHEN event_id % 4 = 3 THEN 'Parsing failed.' ELSE 'why' END AS explanation FROM events""")  # fmt: skip
def verdict_parse(t: Tables) -> DataFrame:
    status = F.get(F.array(*map(F.lit, ("fully_matched", "partially_matched", "new", "maybe"))), (F.col("event_id") % 4).cast("int"))
    raw = F.concat(F.lit("```json\n"), F.to_json(F.struct(status.alias("match_status"), F.col("event_id").alias("matched_id"), F.lit("why").alias("explanation"))), F.lit("\n```"))
    return t.events.select("event_id", structured.verdict(raw).alias("v")).select("event_id", "v.*")


@query("K15", "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' ELSE o_orderpriority END AS label FROM orders")
def enum_translate(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", structured.enum_value(F.col("o_orderpriority"), {"1-URGENT": "urgent", "2-HIGH": "high"}).alias("label"))


@query("K14 P1 P2", """SELECT n_nationkey, coalesce(lower(r.r_name), n_name) AS n_name, lower(q.r_name) AS r_name FROM (SELECT n_nationkey, n_name, n_regionkey FROM nation) n LEFT JOIN region r ON r.r_name = n_name JOIN region q ON q.r_regionkey = n_regionkey""")
def scatter_gather(t: Tables) -> DataFrame:
    dictionary = t.region.select(F.col("r_name").alias("source"), F.lower("r_name").alias("target"))
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    return structured.scatter_gather(rows, "n_nationkey", ["n_name", "r_name"], dictionary)


@query("I14 I15 I16 I17 I19", """SELECT page_id, array_to_string([host, nullif(ext, '')], ' - ') AS title, printf('%02d:%02d', (page_id % 24)::INT, (page_id % 60)::INT) AS at, [page_id, page_id + 1]::VARCHAR AS ids, 'page?' || page_id || '|en' AS cache_key
  FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, '' AS ext FROM pages)""")  # fmt: skip
def string_building(t: Tables) -> DataFrame:
    p = F.col("page_id")
    ids = text.csv_ids(F.concat(p.cast("string"), F.lit(", x,"), (p + 1).cast("string")))
    return t.pages.select(
        "page_id", F.concat_ws(" - ", text.url_host(F.col("url")), F.lit(None)).alias("title"), text.clock((p % 24).cast("int"), (p % 60).cast("int")).alias("at"),
        F.concat(F.lit("["), F.array_join(ids.cast("array<string>"), ", "), F.lit("]")).alias("ids"), F.concat(F.lit("page?"), p.cast("string"), F.lit("|en")).alias("cache_key"),
    )


_GRAMS = r"(SELECT doc_id, lang, text, unnest(list_transform(range(1, greatest(len(x) - 1, 1)), lambda i: substr(x, i, 3))) AS gram FROM (SELECT *, ' ' || trim(regexp_replace(lower(text), '[^\p{L}]+', ' ', 'g')) || ' ' AS x FROM documents WHERE text IS NOT NULL))"
_ARABIC = r"length(regexp_replace(regexp_replace(left(text, 500), '\s', '', 'g'), '[^\x{0600}-\x{06FF}]', '', 'g')) / greatest(length(regexp_replace(left(text, 500), '\s', '', 'g')), 1)"


@query("M7", f"""WITH g AS {_GRAMS}, c AS (SELECT lang, gram, count(*) AS n FROM g WHERE lang IS NOT NULL AND doc_id % 4 <> 0 AND length(gram) = 3 GROUP BY 1, 2),
  z AS (SELECT lang, sum(n) AS total, (SELECT count(DISTINCT gram) FROM c) AS kinds FROM c GROUP BY 1),
  m AS (SELECT lang, gram, round(10000 * ln((n + 0.5::DOUBLE) / (total + 0.5::DOUBLE * kinds)))::BIGINT AS w FROM c JOIN z USING (lang)),
  b AS (SELECT lang, round(10000 * ln(0.5::DOUBLE / (total + 0.5::DOUBLE * kinds)))::BIGINT AS base FROM z),
  t AS (SELECT doc_id, gram, count(*) AS n FROM g WHERE gram IN (SELECT gram FROM m) GROUP BY 1, 2),
  k AS (SELECT doc_id, sum(n) AS known FROM t GROUP BY 1),
  s AS (SELECT doc_id, lang, sum(n * (w - base)) AS x FROM t JOIN m USING (gram) JOIN b USING (lang) GROUP BY 1, 2),
  r AS (SELECT doc_id, lang FROM s JOIN b USING (lang) JOIN k USING (doc_id) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY x + known * base DESC, lang) = 1)
  SELECT doc_id, doc_id % 4 = 0 AS held_out, CASE WHEN length(trim(coalesce(text, ''))) < 20 THEN 'unknown' WHEN {_ARABIC} > 0.2 THEN 'ar' ELSE coalesce(r.lang, 'unknown') END AS detected FROM documents LEFT JOIN r USING (doc_id)""")  # fmt: skip
def learned_languages(t: Tables) -> DataFrame:
    """Languages by trigrams learned from three quarters of the labelled documents."""
    docs = t.documents.select("doc_id", "text", "lang")
    store = Scratch(t.spark, "learned-languages").write
    model = store(language.learned(docs.where("doc_id % 4 <> 0"), store=store), "model")
    return language.detected(docs, model, "doc_id").select("doc_id", (F.col("doc_id") % 4 == 0).alias("held_out"), "detected")


@query("U1", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'en' WHEN lang IN ('en', 'ar') THEN lang END AS code FROM documents")
def language_params(t: Tables) -> DataFrame:
    """Language parameters in any case, with blanks, empty or missing."""
    k = F.col("doc_id") % 6
    given = F.when(k == 0, "").when(k == 3, F.lit(None)).when(k < 3, F.concat(F.lit(" "), F.upper("lang"), F.lit(" "))).otherwise(F.col("lang"))
    return t.documents.select("doc_id", text.language_param(given).alias("code"))
