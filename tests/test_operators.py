import pytest
from pyspark.sql import functions as F

from docfold.functions import markup, structured
from docfold.operators import chunking, matching, mutations, relational, versioning
from docfold.schemas import CRITICALITY, EXECUTION
from docfold.sources import files
from docfold.streaming import jobs


def values(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_dominant_defaults(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "Low"), (2, "High")], "k int, c string")
    assert values(df.groupBy("k").agg(relational.dominant(F.col("c"), CRITICALITY).alias("d"))) == [(1, "Low"), (2, "High")]
    assert values(df.groupBy("k").agg(relational.dominant(F.col("c"), EXECUTION).alias("d")))[0] == (1, "Informational_No_Action")


def test_worst_status_of_nothing(spark):
    df = spark.createDataFrame([], "s string")
    assert df.agg(relational.worst_status(F.col("s")).alias("s")).first().s == "fully_matched"


def test_null_safe_existence(spark):
    new = spark.createDataFrame([("t", None), ("u", None)], "title string, path string")
    old = spark.createDataFrame([("t", None)], "title string, path string")
    assert values(relational.existing(new, old, ["title", "path"])) == [("t", None)]
    assert values(relational.missing(new, old, ["title", "path"])) == [("u", None)]


def test_greedy_chunks(spark):
    df = spark.createDataFrame([(1, "aaaa\n\nbb\n\n\n\ncccccccccccc\n\ndd"), (2, ""), (3, None)], "i int, t string")
    got = values(df.select("i", chunking.greedy(F.col("t"), 6).alias("c")), "i")
    assert got == [(1, ["aaaa\n\nbb", "cccccccccccc", "dd"]), (2, []), (3, None)]


def test_overlapping_chunks(spark):
    text = "Article 1 aaa\nArticle 2 bbb\nArticle 3 ccc"
    df = spark.createDataFrame([(text,), ("x" * 25,), (None,)], "t string")
    got = [r.c for r in df.select(chunking.overlapping(F.col("t"), 20, 4).alias("c")).collect()]
    assert [c.chunk_text for c in got[0]] == ["Article 1 aaa", " aaa\nArticle 2 bbb", " bbb\nArticle 3 ccc"]
    assert [(c.char_start, len(c.chunk_text)) for c in got[1]] == [(0, 20), (16, 9)] and got[2] == []


def test_sections(spark):
    df = spark.createDataFrame([("a\nArticle 1 b\nChapter 2 c",), ("p\n\nq",)], "t string")
    assert [r.s for r in df.select(chunking.sections(F.col("t")).alias("s")).collect()] == [["a", "Article 1 b", "Chapter 2 c"], ["p", "q"]]


def test_gaps_keep_the_first_of_equals(spark):
    obligations = spark.createDataFrame([(1,), (2,)], "o int")
    verdicts = spark.createDataFrame([(1, 2, "partial", "later"), (1, 1, "partial", "first"), (1, 3, "missing", None)], "o int, chunk_num int, coverage_status string, evidence_text string")
    got = values(matching.merge_gaps(obligations, verdicts, ["o"]).select("o", "coverage_status", "evidence_text"))
    assert got == [(1, "partial", "first"), (2, "missing", None)]


def test_fallback_mapping(spark):
    o = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "obligation_id string, obligation_text string")
    m = spark.createDataFrame([("1", "z", 1, 10), ("1", "z", 2, 11), (None, "b", 3, 12)], "obligation_id string, obligation_text string, position int, matched_id long")
    assert values(matching.fallback_mapping(o, m).select("obligation_id", "matched_id")) == [("1", 11), ("2", 12), ("3", None)]


def test_titles_and_links(spark):
    df = spark.createDataFrame([("Access Control", "access"), ("", "x"), ("a", "b")], "a string, b string")
    assert [r.m for r in df.select(matching.titles_match(F.col("a"), F.col("b")).alias("m")).collect()] == [True, False, False]
    a = spark.createDataFrame([(1, "Access"), (2, "ab"), (3, "")], "i int, title string")
    b = spark.createDataFrame([(7, "user access control"), (8, "B"), (9, "zz")], "j int, title string")
    assert values(matching.title_pairs(a, "i", b, "j")) == [(1, 7), (2, 8)]
    found = spark.createDataFrame([(1, 5, "new"), (1, 6, "fully_matched"), (2, 6, "fully_matched")], "r int, c int, match_status string")
    linked = spark.createDataFrame([(1, 6)], "r int, c int")
    assert values(matching.link_outcome(found, linked, ["r", "c"]).select("r", "c", "outcome")) == [(1, 5, "new_item"), (1, 6, "already_linked"), (2, 6, "new_link")]


def test_provider(spark):
    p = matching.LexicalProvider()
    docs = spark.createDataFrame([(1, "Banks shall keep records. It rains. They must report."), (2, "Nothing here.")], "regulation_id long, content_text string")
    got = p.extract(docs).collect()
    assert [[o.obligation_text for o in r.obligations] for r in got] == [["Banks shall keep records.", "They must report."]]
    o = spark.createDataFrame([(1, "banks keep records of all payments")], "id long, text string")
    chunks = spark.createDataFrame([(1, "banks keep records of all payments daily"), (2, "none of it")], "chunk_num int, text string")
    assert values(p.coverage(o, chunks).select("id", "chunk_num", "coverage_status"))[0] == (1, 1, "covered")


def test_mutations(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, s string, n int")
    assert values(mutations.patch(base, spark.createDataFrame([(1, None, 9)], "k int, s string, n int"), "k")) == [(1, "a", 9), (2, "b", 2)]
    assert values(mutations.upsert(base, spark.createDataFrame([(2, "c", 3), (3, "d", 4)], "k int, s string, n int"), ["k"])) == [(1, "a", 1), (2, "c", 3), (3, "d", 4)]
    keys = mutations.with_keys(spark.range(100).select("id"), "key", 50, F.col("id"))
    assert sorted(r.key for r in keys.collect()) == list(range(51, 151))
    rest, lost = mutations.delete_counted({"base": base}, spark.createDataFrame([(1,)], "k int"), ["k"])
    assert values(rest["base"]) == [(2, "b", 2)] and values(lost) == [("base", 1)]
    docs = spark.createDataFrame([(["a", "b"],), (["a", "c"],), ([],)], "p array<string>")
    new = mutations.missing_categories(docs, "p", spark.createDataFrame([(["a"],)], "path array<string>"))
    assert values(new.select("title", "depth")) == [("b", 2), ("c", 2)]


def test_versions(spark):
    first = spark.createDataFrame([(1, "x", "h1", "new")], "regulation_id long, content_text string, content_hash string, monitoring_status string")
    none = spark.createDataFrame([], jobs.VERSIONS)
    v1 = versioning.next_versions(first, none, "2024-01-01")
    changed = spark.createDataFrame([(1, "y", "h2", "modified"), (2, "z", "h3", "new"), (3, "q", "h4", "unchanged")], first.schema)
    v2 = versioning.next_versions(changed, v1, "2024-01-02")
    assert values(v2.select("regulation_id", "version_no", "status")) == [(1, 1, "inactive"), (1, 2, "active"), (2, 1, "active")]
    assert values(versioning.latest_active(v2).select("regulation_id", "content_hash")) == [(1, "h2"), (2, "h3")]
    analysis = spark.createDataFrame([(1, 2, "2024-01-03 00:00:00")], "regulation_id long, version_no long, created_at string")
    assert values(versioning.history(v2, analysis).select("regulation_id", "version_no", "n_rows", "age")) == [(1, 1, 0, 1), (1, 2, 1, 0), (2, 1, 0, 0)]
    assert versioning.initial_versions(spark.createDataFrame([(7, "t", "h")], "regulation_id long, content_text string, content_hash string"), "2024-01-01").count() == 1


def test_version_stream(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "versions")
    schema = "id long, text string, seen long"

    def run(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        q = jobs.version_stream(spark.readStream.schema(schema).parquet(source), root, str(tmp_path / "check"), "2024-01-01")
        q.awaitTermination(120)
        assert q.exception() is None

    run([(1, "a", 1), (1, "b", 2), (2, "c", 1)])
    jobs.gather_versions(spark, root)
    run([(1, "b", 3), (2, "d", 3), (3, "e", 3)])
    final = jobs.versions_at(spark, root, 99)
    assert values(final.select("regulation_id", "version_no", "content_text", "status")) == [(1, 1, "b", "active"), (2, 1, "c", "inactive"), (2, 2, "d", "active"), (3, 1, "e", "active")]


def test_event_windows_stream(spark):
    events = spark.readStream.schema(spark.read.parquet("/root/testdata/sf0.001/events.parquet").schema).parquet("/root/testdata/sf0.001/", pathGlobFilter="events.parquet")
    q = jobs.event_counts(events).writeStream.outputMode("complete").format("memory").queryName("docfold_windows").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("docfold_windows").agg(F.sum("n")).first()[0] == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()


def test_stale_runs(spark):
    log = spark.createDataFrame([(1, "RUNNING", "2024-01-01 00:00:00"), (2, "RUNNING", "2024-01-01 00:59:00"), (3, "DONE", "2024-01-01 00:00:00")], "id int, status string, b string").withColumn("last_heartbeat", F.to_timestamp("b"))
    assert [r.id for r in jobs.stale_runs(log, F.lit("2024-01-01 01:00:00").cast("timestamp")).collect()] == [1]


def test_files(spark, tmp_path):
    spark.range(1).select(markup.page_text(F.lit("<p>a</p>")), markup.breadcrumb(F.lit("")), structured.salvage_json(F.lit("{}"))).collect()  # UDFs that ran before are not sent along
    (tmp_path / "a.txt").write_text("plain text")
    (tmp_path / "b.html").write_text("<p>hyper</p><script>x</script>")
    (tmp_path / "c.exe").write_bytes(b"\0")
    got = values(files.extracted(files.uploads(spark, str(tmp_path))).select("extension", "accepted", "content_text"))
    assert got == [("exe", False, None), ("html", True, "hyper"), ("txt", True, "plain text")]
    page = "<table><tr><td colspan=3>2021</td></tr><tr><td>12/01/2021</td><td>Rule one</td><td><a href='/x.pdf'>pdf</a></td></tr><tr><td></td><td></td><td></td></tr></table>"
    docs = files.table_documents(spark.createDataFrame([("u", page)], "url string, html string"), {"published_date": 0, "title": 1}, "circulars", "https://h")
    assert [(r.category, r.title, r.document_url, str(r.published)) for r in docs.collect()] == [("2021", "Rule one", "https://h/x.pdf", "2021-01-12")]
    pages = spark.createDataFrame([("d", 2, "valuable words " * 40), ("d", 1, "x"), ("e", 1, "short")], "k string, page_no int, text string")
    got = values(files.assembled_pages(pages, ["k"]).select("k", "total_pages", "good_pages", "scanned"))
    assert got == [("d", 2, 1, False), ("e", 1, 0, True)]
    files.export_json(docs, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1
    assert files.query(spark, "SELECT :a AS a", a=3).first().a == 3
    both = files.union_modes({"one": docs.select("title"), "two": docs.select("title")})
    assert both.count() == 2 and files.union_modes({"one": docs.select("title"), "two": docs.select("title")}, "two").first().source_system == "two"


def test_replace_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (2, "b")], "r int, s string").write.partitionBy("r").parquet(path)
    mutations.replace_partition(spark.createDataFrame([(1, "c")], "r int, s string"), path, ["r"])
    assert values(spark.read.parquet(path).select("r", "s")) == [(1, "c"), (2, "b")]


@pytest.mark.parametrize("strict", [True, False])
def test_carry_forward_and_union(spark, strict):
    df = spark.createDataFrame([(1, "h", True), (2, "x", False), (3, "i", True), (4, "y", False)], "i int, v string, head boolean").withColumn("k", F.lit(1))
    got = [r.c for r in df.withColumn("c", relational.carry_forward(F.col("v"), F.col("head"), ["k"], F.col("i"))).orderBy("i").collect()]
    assert got == ["h", "h", "i", "i"]
