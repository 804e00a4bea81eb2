"""Stored tables: a batch that is killed between two writes, buckets that stay as they are, days that are not read."""

import os

import pytest

from docfold.operators import workflows
from docfold.sources import stored

IN = "regulator string, category string, source_system string, published_date string, title string, doc_path array<string>, source_page_url string, content_text string"


def row(title, url="u", text="x", regulator="R1", date="01/01/2020", path=("a", "b"), category="Circular"):
    return (regulator, category, "T", date, title, list(path), url, text)


def tables(store):
    return {name: sorted(map(str, store.read(name, schema).collect())) for name, schema in workflows.STORED.items()}


def test_a_batch_killed_between_two_writes(spark, tmp_path, monkeypatch):
    """Whatever was written, readers see whole batches only, and a batch that is run again leaves what one that was not killed leaves."""
    first = spark.createDataFrame([row("A", "u1"), row("B", "u2"), row("C", None), row("R", regulator="R2"), row("R", regulator="R2")], IN)
    second = spark.createDataFrame([row("A", "u1", "new"), row("B", "u2"), row("D", "u4", path=("a", "c"))], IN)
    whole = stored.Batches(spark, str(tmp_path / "whole"))
    for n, rows in enumerate((first, second)):
        assert workflows.ingest_batch(whole, n, rows, "R1", "2024-01-01")
    assert not workflows.ingest_batch(whole, 1, first, "R1", "2024-01-01")  # it counts already
    want = tables(whole)
    docs = {r.title: r for r in whole.read("documents", workflows.STORED["documents"]).collect()}
    assert set(docs) == {"A", "B", "R", "D"} and sorted(r.id for r in docs.values()) == [1, 2, 3, 4]
    versions = sorted((r.regulation_id, r.version_no, r.content_text) for r in whole.read("versions", workflows.STORED["versions"]).collect())
    assert versions == sorted([(docs["A"].id, 1, "x"), (docs["A"].id, 2, "new"), (docs["B"].id, 1, "x"), (docs["D"].id, 1, "x")])

    part, put = stored.Batches(spark, str(tmp_path / "part")), stored.Batches.put
    workflows.ingest_batch(part, 0, first, "R1", "2024-01-01")
    before = tables(part)
    for table in ("categories", "log"):

        def killed(self, name, batch, rows, table=table):
            if name == table:
                raise InterruptedError
            return put(self, name, batch, rows)

        monkeypatch.setattr(stored.Batches, "put", killed)
        with pytest.raises(InterruptedError):
            workflows.ingest_batch(part, 1, second, "R1", "2024-01-01")
        assert tables(part) == before
    monkeypatch.setattr(stored.Batches, "put", put)
    assert workflows.ingest_batch(part, 1, second, "R1", "2024-01-01")
    assert tables(part) == want


def files(root):
    return {os.path.relpath(os.path.join(d, f), root): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_untouched_buckets_stay(spark, tmp_path):
    root = str(tmp_path / "t")
    table = stored.Buckets(spark, root, "k long, v string", ["k"], 8)
    assert table.read().count() == 0
    table.upsert(spark.range(100).selectExpr("id as k", "'old' as v"))
    before = files(root)
    hit = table.upsert(spark.createDataFrame([(3, "new"), (1000, "added")], "k long, v string"))
    after = files(root)
    mine = lambda f: any(f.startswith(f"bucket={b}/") for b in hit)
    assert 1 <= len(hit) <= 2 and {f: t for f, t in before.items() if not mine(f)} == {f: t for f, t in after.items() if not mine(f)}
    assert sorted((r.k, r.v) for r in table.read().collect()) == sorted([(k, "new" if k == 3 else "old") for k in range(100)] + [(1000, "added")])
    table.replace(spark.createDataFrame([(5, "a"), (5, "b")], "k long, v string"), ["k"])
    assert sorted(r.v for r in table.read().where("k = 5").collect()) == ["a", "b"]
    table.remove(spark.range(2000).withColumnRenamed("id", "k"))
    assert table.read().count() == 0 and table.names() in ([], ["_SUCCESS"])
    assert table.upsert(spark.createDataFrame([], "k long, v string")) == []


def test_days_before_the_mark_are_not_read(spark, tmp_path):
    """The scan has the mark as a filter of partitions and the folders of two days only; late rows of old days stay out, appended days move the mark."""
    root, kinds = str(tmp_path / "days"), "id long, ts timestamp_ntz"
    rows = spark.range(240).select("id", F.expr("timestampadd(HOUR, id, timestamp_ntz'2024-01-01 00:00:00')").alias("ts"))
    assert stored.since_mark(spark, root, kinds, default="2024-01-01").count() == 0
    stored.write_days(rows, root, "ts")
    found = stored.since_mark(spark, root, kinds)
    assert sorted(r.id for r in found.collect()) == list(range(192, 240))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-09" in plan and "day=2024-01-08" not in str(found.inputFiles())
    assert {f.split("day=")[1][:10] for f in found.inputFiles()} == {"2024-01-09", "2024-01-10"}
    stored.write_days(rows.limit(1).selectExpr("1000L as id", "timestamp_ntz'2024-01-12 05:00:00' as ts"), root, "ts", "append")
    assert [r.id for r in stored.since_mark(spark, root, kinds).collect()] == [1000]


def test_analysis_of_one_version(spark, tmp_path):
    """Rows of the version that is analysed again are replaced; a version in which nothing is found keeps its own."""
    from docfold.operators.matching import LexicalProvider

    table = stored.Buckets(spark, str(tmp_path / "t"), "regulation_id long, version_no long, requirement_id string, n_obligations long", ["regulation_id", "version_no"], 4)
    table.upsert(spark.createDataFrame([(1, 1, "old", 0), (1, 2, "old", 0), (2, 2, "old", 0)], table.kinds))
    text = "Banks shall keep records of all payments. " * 4 + "They must report."
    versions = spark.createDataFrame([(1, 1, text), (1, 2, text), (2, 2, "Nothing at all. " * 20)], "regulation_id long, version_no long, content_text string")
    workflows.analyse_version(table, versions, 2, LexicalProvider())
    assert sorted(map(tuple, table.read().collect())) == [(1, 1, "old", 0), (1, 2, "REQ-001", 2), (2, 2, "old", 0)]
