"""Jobs made of several operators: staged and chunked analysis, applying matches, gap modes, ingest and upload.

Each is one declarative plan over sets of documents.  A service that works on one document at a time becomes the same
job over one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docfold.functions import dates, structured, text
from docfold.operators import chunking
from docfold.operators.matching import Provider, merge_gaps, new_links
from docfold.operators.mutations import missing_categories, with_keys
from docfold.operators.relational import first_by, rank_of, value_of
from docfold.operators.versioning import added_versions
from docfold.schemas import CRITICALITY, EXECUTION
from docfold.sources.stored import Batches, Buckets

REQ = ["regulation_id", "requirement_id"]


def last_of(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Of each key the row with the largest position: the last duplicate wins."""
    rest = [c for c in df.columns if c not in (*keys, position)]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), position).alias("__last")).select(*keys, "__last.*")


def dominant_of(items: Column, order: tuple[str, ...]) -> Column:
    """The most important value of an array; the last of the order if there is none."""
    return value_of(F.array_min(F.transform(items, lambda v: rank_of(v, order))), order)


def assembled(stage1: DataFrame, stage2: DataFrame, stage3: DataFrame, report: DataFrame) -> DataFrame:
    """Analysis rows: requirements with normalised obligations, controls, rollups and the stages as JSON.

    ``stage1`` has the keys, position, requirement_title and obligations; ``stage2`` the keys, position and
    normalized_obligations; ``stage3`` the keys, position, obligation_id and control; ``report`` regulation_id and stage4_md, which
    only the first row of a document gets.
    """
    s2 = last_of(stage2, REQ, "position")
    s3 = last_of(stage3, [*REQ, "obligation_id"], "position").groupBy(*REQ).agg(F.sort_array(F.collect_list(F.struct("obligation_id", "control"))).alias("controlled"))
    first = stage1.groupBy("regulation_id").agg(F.min("position").alias("__first"))
    rows = stage1.join(s2, REQ, "left").join(s3, REQ, "left").join(first, "regulation_id").join(report, "regulation_id", "left")
    plain = F.transform("obligations", lambda o: F.struct(*(o[c].alias(c) if c in ("obligation_id", "obligation_text") else F.lit(None).cast("string").alias(c) for c in ("obligation_id", "obligation_text", "obligation_type", "criticality", "execution_category"))))
    obligations = F.coalesce("normalized_obligations", plain)
    field = lambda name: F.transform(obligations, lambda o: o[name])
    types = F.array_sort(F.array_distinct(F.filter(field("obligation_type"), lambda v: F.length(v) > 0)))
    controls = F.coalesce(F.transform(F.filter("controlled", lambda c: c["control"].isNotNull()), lambda c: c["control"]["control_title"]), F.array().cast("array<string>"))
    return rows.select(
        *REQ, "position", "requirement_title",
        dominant_of(field("execution_category"), EXECUTION).alias("execution_category"), dominant_of(field("criticality"), CRITICALITY).alias("criticality"), F.array_join(types, ", ").alias("obligation_type"),
        F.size(obligations).cast("long").alias("n_obligations"), F.size(controls).cast("long").alias("n_controls"),
        structured.encoded(F.struct("requirement_id", "requirement_title", obligations.alias("obligations"), controls.alias("controls"))).alias("analysis_json"),
        structured.encoded(F.struct("requirement_id", "requirement_title", "obligations")).alias("stage1_json"),
        F.coalesce(structured.encoded(F.struct("requirement_id", "normalized_obligations")), F.lit("{}")).alias("stage2_json"),
        F.coalesce(structured.encoded(F.struct("requirement_id", "controlled")), F.lit("{}")).alias("stage3_json"),
        F.when(F.col("position") == F.col("__first"), F.col("stage4_md")).alias("stage4_md"), F.lit("v2").alias("schema_version"),
    )


def staged_analysis(docs: DataFrame, provider: Provider, least: int = text.ANALYSIS_MIN) -> DataFrame:
    """Four stages over documents (regulation_id, content_text) of at least ``least`` characters; controls only for ongoing obligations."""
    found = provider.extract(docs.where(text.at_least(F.col("content_text"), least)))
    stage1 = found.withColumn("position", F.row_number().over(Window.partitionBy("regulation_id").orderBy("requirement_id")))
    stage2 = provider.normalize(stage1)
    ongoing = stage2.select(*REQ, F.explode("normalized_obligations").alias("o")).where(F.col("o.execution_category") == EXECUTION[0])
    stage3 = provider.controls(ongoing.select(*REQ, "o.obligation_id", "o.obligation_text"))
    lines = F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("- "), "requirement_title", F.lit(": "), F.size("obligations").cast("string")))), "\n")
    report = stage1.groupBy("regulation_id").agg(F.concat(F.lit("# Analysis\n"), lines).alias("stage4_md"))
    return assembled(stage1, stage2.withColumn("position", F.lit(0)), stage3.withColumn("position", F.lit(0)), report)


def chunked_requirements(docs: DataFrame, provider: Provider, most: int = chunking.CHUNK, least: int = text.V1_MIN) -> DataFrame:
    """(regulation_id, source_chunk, requirement_text): texts over ``most`` characters are read in chunks; the first of equal texts stays.

    A chunk of which nothing is read adds nothing; the others stand.
    """
    whole = F.array(F.col("content_text"))
    parts = F.when(F.length("content_text") > most, chunking.greedy(F.col("content_text"), most)).otherwise(whole)
    chunks = docs.where(text.at_least(F.col("content_text"), least)).select("regulation_id", F.posexplode(parts).alias("i", "content_text"))
    keyed = chunks.select(F.struct("regulation_id", (F.col("i") + 1).cast("long").alias("source_chunk")).alias("regulation_id"), "content_text")
    rows = provider.extract(keyed).select("regulation_id.*", "requirement_id", F.posexplode("obligations").alias("at", "o"))
    normal = text.normalize_text(F.col("o.obligation_text"))
    first = rows.where(F.length(normal) > 0).groupBy("regulation_id", normal.alias("key")).agg(F.min(F.struct("source_chunk", "requirement_id", "at", F.col("o.obligation_text").alias("requirement_text"))).alias("x"))
    return first.select("regulation_id", "x.source_chunk", "x.requirement_text")


def apply_matches(verdicts: DataFrame, linked: DataFrame, items: DataFrame, last_requirement: int, last_item: int, store: Callable[[DataFrame, str], DataFrame] = lambda df, _: df) -> dict[str, DataFrame]:
    """What matching changes, as tables to append and ids to flag.

    ``verdicts`` has regulation_id, position, requirement_text, match_status, matched_id and explanation; ``items``, the controls
    (or indicators) judged for them, regulation_id, position, title, description, requirement_id (null if its requirement is new), match_status
    and matched_id; ``linked`` the pairs requirement_id, item_id there are.  New requirements get keys after ``last_requirement``; a new item
    without requirement hangs on the first new requirement of its document.  ``store`` writes a table under a name and reads it again, so that
    tables made of one another are made once.
    """
    verdicts, items = store(verdicts, "judged"), store(items, "judged_items")
    mappings = verdicts.select("regulation_id", "requirement_text", F.when(F.col("match_status") != "new", F.col("matched_id")).alias("matched_requirement_id"), "match_status", "explanation")
    flagged = verdicts.where("match_status = 'partially_matched' and matched_id is not null").select(F.col("matched_id").alias("requirement_id")).distinct()
    number = F.row_number().over(Window.partitionBy("regulation_id").orderBy("position")) - 1
    fresh = verdicts.where("match_status = 'new'").withColumn("n", number)
    ref = F.concat(F.lit("AUTO-"), F.col("regulation_id").cast("string"), F.lit("-"), F.col("n").cast("string"))
    title = text.truncated(F.col("requirement_text"), 100)
    made = fresh.select("regulation_id", "n", title.alias("title"), F.col("requirement_text").alias("description"), ref.alias("ref_key"), F.concat(F.lit("REG-"), F.col("regulation_id").cast("string")).alias("ref_no"), F.lit(1).alias("is_suggested"))
    requirements = store(with_keys(made, "requirement_id", last_requirement, F.col("regulation_id"), F.col("n")), "requirements")
    heads = requirements.where("n = 0").select("regulation_id", F.col("requirement_id").alias("first_new"))

    known = items.where("match_status <> 'new' and requirement_id is not null").select("regulation_id", "requirement_id", F.col("matched_id").alias("item_id"), "match_status")
    pair = ["requirement_id", "item_id"]
    links = known.join(new_links(known, linked, pair), pair, "left_semi").groupBy(*pair).agg(F.min(F.struct("regulation_id", "match_status")).alias("x")).select(*pair, "x.*")
    suggested = items.where("match_status = 'new'").select("regulation_id", "position", "title", "description", "requirement_id")
    placed = suggested.join(heads, "regulation_id", "left").withColumn("requirement_id", F.coalesce("requirement_id", "first_new")).drop("first_new")
    added = store(with_keys(placed, "item_id", last_item, F.col("regulation_id"), F.col("position")), "items")
    new = added.where("requirement_id is not null").select("regulation_id", "requirement_id", "item_id", F.lit("new").alias("match_status"))
    return {"mappings": mappings, "flagged": flagged, "requirements": requirements.drop("n"), "items": added.drop("requirement_id", "position"), "links": links.select(new.columns).unionByName(new)}


def gap_analysis(obligations: DataFrame, uploads: DataFrame, provider: Provider, most: int = chunking.TEXT_CHUNK, least: int = text.UPLOAD_GAP_MIN) -> DataFrame:
    """The coverage of each obligation (regulation_id, id, text) in each upload (upload_id, regulation_id, text) for its document.

    ``mode`` tells uploads of which too little could be read (``refused``, without verdicts), those read at once and those read in chunks; of chunks
    the best verdict counts, the first on ties.  What no chunk covers is missing.
    """
    n = F.length(F.coalesce("text", F.lit("")))
    mode = F.when(n < least, "refused").when(n > most, "chunked").otherwise("single")
    told = uploads.select("upload_id", "regulation_id", "text", mode.alias("mode"))
    read = told.where("mode <> 'refused'")
    chunks = chunking.fixed(read.select(F.struct("upload_id", "regulation_id").alias("key"), "text"), "key", "text", most)
    chunks = chunks.select("key.regulation_id", F.struct("key.upload_id", "chunk_num").alias("chunk_num"), F.col("chunk_text").alias("text"))
    asked = obligations.select("regulation_id", "id").join(read.select("upload_id", "regulation_id"), "regulation_id")
    found = provider.coverage(obligations, chunks, within=("regulation_id",)).select("regulation_id", "id", "chunk_num", F.col("chunk_num.upload_id").alias("upload_id"), "coverage_status")
    # texts are fetched for the verdicts that count only
    merged = provider.evidence(merge_gaps(asked, found.drop("regulation_id"), ["upload_id", "id"]), chunks, ("regulation_id",))
    status = F.col("coverage_status")
    gap = F.when(status == "missing", "Obligation not found in uploaded document.")
    known = merged.select("upload_id", "regulation_id", "id", status, F.when(status != "missing", F.col("evidence_text")).alias("evidence_text"), gap.alias("gap_description"))
    return told.select("upload_id", "mode").join(known, "upload_id", "left")


def ingest(incoming: DataFrame, stored: DataFrame, versioned: str) -> DataFrame:
    """``action`` for each incoming document: skip, existing, insert_only, insert, insert_version or update_version.

    Documents of the regulator ``versioned`` are known by source_page_url, others by title, date and path; those without a date only
    if their category or source tells them apart.  ``monitoring_status`` says which of the known have changed.  Returns need no analysis.
    """
    mine = F.col("regulator") == versioned
    returns = F.lower(F.coalesce("category", F.lit(""))) == "regulatory returns"
    undated = returns | F.coalesce(F.col("source_system") == "UNDATED", F.lit(False))
    dated = F.length(F.coalesce("published_date", F.lit(""))) > 0
    known_url = stored.where(mine & F.col("source_page_url").isNotNull()).select("source_page_url").distinct().withColumn("__url", F.lit(True))
    path = F.md5(F.to_json(F.struct(F.col("title"), F.col("published_date"), F.col("doc_path")), {"ignoreNullFields": "false"}))
    known_key = stored.select(path.alias("__key")).distinct().withColumn("__same", F.lit(True))
    date = F.when(dated, F.col("published_date"))
    seen = incoming.withColumn("published_date", date).withColumn("__key", path).join(known_url, "source_page_url", "left").join(known_key, "__key", "left")
    old = F.coalesce(F.when(mine, F.col("__url")).otherwise(F.col("__same")), F.lit(False))
    usable = F.when(mine, F.length(F.coalesce("source_page_url", F.lit(""))) > 0).otherwise(dated | undated)
    action = (
        F.when(~usable, "skip")
        .when(mine & old & (F.col("monitoring_status") == "modified"), "update_version")
        .when(old, "existing")
        .when(returns, "insert_only")
        .when(mine, "insert_version")
        .otherwise("insert")
    )
    return seen.withColumn("action", action).select(*incoming.columns, "action")


def upload_pipeline(
    uploads: DataFrame, provider: Provider, library: DataFrame, last_key: int, store: Callable[[DataFrame, str], DataFrame] = lambda df, _: df, accepted: tuple[str, ...] = ("pdf", "docx", "doc")
) -> dict[str, DataFrame]:
    """Uploads (filename, regulator, content_text, raw metadata) to documents, analysis rows, verdicts and a summary of each upload.

    ``store`` writes a table under a name and reads it again, so that what follows does not make it anew.
    """
    short = F.length(F.coalesce("content_text", F.lit(""))) < text.UPLOAD_MIN
    status = F.when(~F.coalesce(text.url_extension(F.col("filename")).isin(*accepted), F.lit(False)), "unsupported").when(short, "too_short").otherwise("accepted")
    judged = uploads.withColumn("status", status)
    title = text.or_else(text.null_string(F.col("title")), text.filename_title(F.col("filename")))
    meta = judged.where("status = 'accepted'").select(
        "filename", F.upper(F.trim("regulator")).alias("regulator"), title.alias("title"), dates.validate_date(F.col("published_date")).alias("published_date"),
        dates.extract_year(F.col("published_date")).alias("year"), F.md5("content_text").alias("content_hash"), text.clean(F.col("content_text")).alias("content_text"),
    )
    documents = store(with_keys(meta, "regulation_id", last_key, F.col("filename")), "documents")
    rows = store(staged_analysis(documents.select("regulation_id", "content_text"), provider, text.UPLOAD_MIN), "analysis")
    asked = rows.select(F.struct(*REQ).alias("id"), F.get_json_object("analysis_json", "$.obligations[0].obligation_text").alias("text"))
    verdicts = provider.match(asked, library).select("id.*", "match_status", "matched_id")
    counts = lambda c, values: [F.count_if(F.col(c) == v).alias(v.lower()) for v in values]
    found = rows.groupBy("regulation_id").agg(F.count("*").alias("n_requirements"), F.sum("n_obligations").alias("n_obligations"), F.sum("n_controls").alias("n_controls"), *counts("criticality", CRITICALITY))
    matched = verdicts.groupBy("regulation_id").agg(*counts("match_status", ("fully_matched", "partially_matched", "new")))
    per = documents.select("filename", "regulation_id", "title", "published_date", "year").join(found, "regulation_id", "left").join(matched, "regulation_id", "left")
    return {"documents": documents, "analysis": rows, "verdicts": verdicts, "summary": judged.select("filename", "status").join(per, "filename", "left")}


#: Tables that an ingest batch writes.
STORED = {
    "documents": "id long, regulator string, category string, source_system string, published_date string, title string, doc_path array<string>, source_page_url string, content_hash string",
    "categories": "path array<string>, title string, depth int",
    "versions": "regulation_id long, version_no long, content_text string, content_hash string, status string, change_summary string, created_at timestamp",
    "log": "regulation_id long, title string, step string, status string, details string",
}


def ingest_batch(store: Batches, batch: int, incoming: DataFrame, versioned: str, at) -> bool:
    """Ingests crawled documents (the columns of stored ones without id and hash, and content_text): inserts, versions, categories and a log, as one.

    What batches before stored decides what is new, so a batch that was stopped and is run again does the same.  Documents are told apart as in
    ``ingest``; of several of one batch that are the same document the first by title, address and hash is taken.  A document of the regulator
    ``versioned`` gets a first version when it is inserted, returns excepted, and a further one when its text changes; the newest version is the active one.
    """

    def work(store: Batches, batch: int) -> None:
        old = {name: store.read(name, schema, batch).drop("batch") for name, schema in STORED.items()}
        newest = old["versions"].groupBy("regulation_id").agg(F.max("version_no").alias("last"), F.max_by("content_hash", "version_no").alias("newest"))
        known = old["documents"].join(newest, F.col("id") == F.col("regulation_id"), "left").withColumn("stored_hash", F.coalesce("newest", "content_hash"))
        mine = known.where(F.col("regulator") == versioned).groupBy("source_page_url").agg(F.min(F.struct("id", "stored_hash", "last")).alias("k"))
        came = incoming.withColumn("content_hash", F.md5(F.coalesce("content_text", F.lit(""))))
        named = F.concat(F.lit("t:"), F.to_json(F.struct("title", "published_date", "doc_path"), {"ignoreNullFields": "false"}))
        same = F.coalesce(F.when(F.col("regulator") == versioned, F.concat(F.lit("u:"), "source_page_url")), named)
        came = first_by(came.withColumn("__same", same), ["regulator", "__same"], F.col("title"), F.col("source_page_url"), F.col("content_hash")).drop("__same")
        came = came.join(mine, "source_page_url", "left").withColumn("monitoring_status", F.when(F.col("k.stored_hash") == F.col("content_hash"), "unchanged").otherwise("modified"))
        told = store.put("_actions", batch, ingest(came, old["documents"], versioned))
        new = told.where("action like 'insert%'")
        last = old["documents"].agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        columns = [c for c in StructType.fromDDL(STORED["documents"]).names if c != "id"]
        keyed = with_keys(new.select(*columns, "content_text", "action"), "id", last, F.col("title"), F.col("source_page_url"), F.col("content_hash"))
        keyed = store.put("_inserted", batch, keyed)
        store.put("documents", batch, keyed.select("id", *columns))
        store.put("categories", batch, missing_categories(new, "doc_path", old["categories"]))
        first = keyed.where("action = 'insert_version'").select(F.col("id").alias("regulation_id"), "content_text", "content_hash", F.lit("new").alias("monitoring_status"))
        again = told.where("action = 'update_version'").select(F.col("k.id").alias("regulation_id"), "content_text", "content_hash", F.lit("modified").alias("monitoring_status"))
        store.put("versions", batch, added_versions(first.unionByName(again), newest.select("regulation_id", "last"), at))
        ids = keyed.select(F.col("id").alias("regulation_id"), "title", "action").unionByName(told.where("action not like 'insert%'").select(F.col("k.id").alias("regulation_id"), "title", "action"))
        done = F.when(F.col("action") == "skip", "SKIPPED").otherwise("DONE")
        store.put("log", batch, ids.select("regulation_id", "title", F.lit("ingest").alias("step"), done.alias("status"), F.to_json(F.struct("action")).alias("details")))

    return store.run(batch, work)


def analyse_version(table: Buckets, versions: DataFrame, version_no: int, provider: Provider) -> list[int]:
    """Analyses one version of each document again (regulation_id, version_no, content_text) and replaces that version's rows; others stay as they are.

    ``table`` is kept by regulation_id and version_no.  A version in which nothing is found keeps its rows.
    """
    asked = versions.where(F.col("version_no") == version_no).select("regulation_id", "content_text")
    rows = staged_analysis(asked, provider, text.UPLOAD_MIN).withColumn("version_no", F.lit(version_no).cast("long"))
    return table.replace(rows.select(*table.kinds.names), ["regulation_id", "version_no"])
