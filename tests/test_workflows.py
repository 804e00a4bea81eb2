"""Composite jobs and page sources at their edges; their queries are compared with SQL in test_queries."""

import pytest
from pyspark.sql import functions as F

from docfold.functions import structured, text
from docfold.operators import layout, matching, mutations, workflows
from docfold.schemas import DOCUMENT
from docfold.sources import pages

P = matching.LexicalProvider()


def test_staged_analysis(spark):
    long = "It rains. " * 30
    docs = spark.createDataFrame([(1, long + "Banks shall keep records. The board must approve it. They should smile."), (2, "Banks shall keep records."), (3, long), (4, None)], "regulation_id long, content_text string")
    rows = workflows.staged_analysis(docs, P).collect()  # too short, without obligations, or without text: no rows
    assert [(r.regulation_id, r.criticality, r.execution_category, r.obligation_type, r.n_obligations, r.n_controls) for r in rows] == [(1, "High", "Ongoing_Control", "Detective, Documentation, Governance", 3, 1)]
    assert rows[0].stage4_md == "# Analysis\n- Obligations: 3" and '"control_title":"Control of OBL-001"' in rows[0].stage3_json


def test_chunks_without_requirements_add_nothing(spark):
    parts = ["Banks shall keep records.", "Nothing to do here at all.", "BANKS SHALL KEEP RECORDS!", "They must report."]
    docs = spark.createDataFrame([(1, "\n\n".join(p + " " + "x" * 100 for p in parts))], "regulation_id long, content_text string")
    got = workflows.chunked_requirements(docs, P, most=130).orderBy("source_chunk").collect()
    assert [(r.source_chunk, r.requirement_text) for r in got] == [(1, "Banks shall keep records."), (4, "They must report.")]


def test_apply_matches(spark):
    verdicts = spark.createDataFrame([(1, 1, "keep", "fully_matched", 10, "e"), (1, 2, "n" * 101, "new", 99, "e"), (1, 3, "second", "new", None, "e"), (1, 4, "part", "partially_matched", 11, "e"), (2, 1, "part", "partially_matched", None, "e")], "regulation_id long, position int, requirement_text string, match_status string, matched_id long, explanation string")
    items = spark.createDataFrame([(1, 1, "a", "d", 10, "fully_matched", 5), (1, 2, "b", "d", 10, "fully_matched", 6), (1, 3, "c", "d", None, "new", None), (2, 1, "f", "d", None, "new", None), (2, 2, "g", "d", 12, "new", None)], "regulation_id long, position int, title string, description string, requirement_id long, match_status string, matched_id long")
    linked = spark.createDataFrame([(10, 5)], "requirement_id long, item_id long")
    out = workflows.apply_matches(verdicts, linked, items, 100, 200)
    assert {(r.requirement_text[:4], r.matched_requirement_id) for r in out["mappings"].collect()} == {("keep", 10), ("nnnn", None), ("seco", None), ("part", 11), ("part", None)}
    assert [r.requirement_id for r in out["flagged"].collect()] == [11]
    new = {r.ref_key: r for r in out["requirements"].collect()}
    assert set(new) == {"AUTO-1-0", "AUTO-1-1"} and new["AUTO-1-0"].title == "n" * 100 + "..." and {r.requirement_id for r in new.values()} == {101, 102}
    ids = {r.title: r.item_id for r in out["items"].collect()}
    assert set(ids) == {"c", "f", "g"} and set(ids.values()) == {201, 202, 203}
    links = {(r.requirement_id, r.item_id, r.match_status) for r in out["links"].collect()}
    assert links == {(10, 6, "fully_matched"), (new["AUTO-1-0"].requirement_id, ids["c"], "new"), (12, ids["g"], "new")}


def test_gap_modes(spark):
    words = "banks keep records of all payments "
    obligations = spark.createDataFrame([(1, 7, words), (1, 8, "something else entirely is asked here"), (2, 9, words)], "regulation_id long, id long, text string")
    uploads = spark.createDataFrame([("short", 1, "x"), ("null", 1, None), ("one", 1, words * 3), ("long", 1, "pad " * 60 + words)], "upload_id string, regulation_id long, text string")
    got = {(r.upload_id, r.id): (r.mode, r.coverage_status, r.gap_description is None) for r in workflows.gap_analysis(obligations, uploads, P, most=150).collect()}
    assert got[("short", None)][0] == got[("null", None)][0] == "refused"
    assert got[("one", 7)] == ("single", "covered", True) and got[("one", 8)] == ("single", "missing", False)
    assert got[("long", 7)][:2] == ("chunked", "covered") and ("one", 9) not in got and len(got) == 6


def test_a_failing_source_takes_no_other(spark, tmp_path):
    html = spark.createDataFrame([("u", "<ul><li><a href=/a>A</a></li></ul>")], "url string, html string")

    def broken():
        raise RuntimeError("site is down")

    def late():
        return pages.as_documents(html.select(F.raise_error(F.lit("bad row")).cast("string").alias("title")), "R", "S")

    docs, runs = pages.isolated(spark, {"tree": lambda: pages.tree_documents(html, "R", "Menu", "https://h"), "broken": broken, "late": late}, str(tmp_path / "s"))
    assert docs.schema.fieldNames()[: len(DOCUMENT)] == DOCUMENT.fieldNames() and [(d.title, d.document_url) for d in docs.collect()] == [("A", "https://h/a")]
    assert {r.source: r.status for r in runs.collect()} == {"tree": "DONE", "broken": "FAILED", "late": "FAILED"}
    assert pages.isolated(spark, {"broken": broken}, str(tmp_path / "t"))[0].count() == 0


def test_first_rows_and_annexures(spark):
    html = "<table><tr><td>2020</td></tr><tr><td>1</td><td>d</td><td><a href=a.pdf>Annexure A</a><a href=u.pdf>Urdu</a></td></tr><tr><td>2</td><td>d</td><td><a href=x.exe>no</a></td></tr></table>"
    docs = pages.circulars(spark.createDataFrame([("u", html), ("v", None)], "url string, html string"), "R", ("C",), "https://h")
    assert [(d.title, d.extra_meta.urdu_url, len(d.extra_meta.annexures)) for d in docs.collect()] == [("Annexure A", "https://h/u.pdf", 1)]
    assert pages.first_rows(docs, None).count() == pages.first_rows(docs, 5, F.col("title")).count() == 1 and pages.first_rows(docs, 0, F.col("title")).count() == 0


def test_language_parameter():
    assert [text.language_code(x) for x in (None, "", " AR ", "en")] == ["en", "en", "ar", "en"]
    with pytest.raises(ValueError):
        text.language_code("fr")


def test_log_and_counts(spark, tmp_path):
    path = str(tmp_path / "log")
    for step in ("insert", "analyse"):
        mutations.append_log(spark.range(1).select(F.lit(step).alias("step"), F.struct(F.lit("é").alias("a"), F.lit(None).cast("string").alias("b")).alias("details")), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("step", "details").collect()) == [("analyse", '{"a":"é","b":null}'), ("insert", '{"a":"é","b":null}')]
    base = spark.createDataFrame([(1, "active"), (1, "draft")], "k int, status string")
    assert mutations.set_status_counted(base, F.col("k") == 2, "active", "inactive")[1].first().rows_affected == 0


def test_read_through_computes_once(spark):
    asked = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "i int, k string")
    cache = spark.createDataFrame([("b", "old")], "k string, answer string")
    answers, made = structured.read_through(asked, cache, ["k"], lambda rest: rest.withColumn("answer", F.lit("new")))
    assert made.count() == 1 and sorted((r.i, r.answer) for r in answers.collect()) == [(1, "new"), (2, "new"), (3, "old")]


def test_recognised_without_reader(spark):
    pages_ = spark.createDataFrame([(1, "x"), (2, None)], "k int, text string")
    assert {r.by for r in layout.recognised(pages_, None, ["k"]).collect()} == {"text"}
    read = spark.createDataFrame([(1, "a longer text"), (2, "b")], "k int, text string")
    assert sorted((r.k, r.text, r.by) for r in layout.recognised(pages_, read, ["k"]).collect()) == [(1, "a longer text", "recognised"), (2, "b", "recognised")]
