import collections
import random

import corpus_pipeline
from docfold.llm import mixing, neardup, packing, quality, templates
from tests.llm.test_neardup import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(SF + "/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = seen[name] = spark.read.parquet(str(tmp_path / name))
        if name != "best_fit_packing":
            assert docs.columns == columns
        if name == "near_dedup":
            links = brute([(r.doc_id, r.text) for r in before.collect()], neardup.SHINGLE, neardup.THRESHOLD)
            assert sorted(r.doc_id for r in docs.collect()) == sorted(i for i, (_, c) in links.items() if c == i)
    passed = quality.judged(spark.read.parquet(SF + "/documents.parquet")).where("kept").select("doc_id")
    assert sorted(r.doc_id for r in seen["quality_rules"].collect()) == sorted(r.doc_id for r in passed.collect())
    lost = templates.without_templates(seen["quality_rules"])
    assert sorted((r.doc_id, r.kept_text) for r in lost.collect()) == sorted((r.doc_id, r.text) for r in seen["line_dedup"].collect())
    copies = {r.doc_id: r.copies for r in mixing.mixed_sizes(seen["near_dedup"]).collect() if r.copies}
    assert collections.Counter(r.doc_id for r in seen["mix_sources"].collect()) == copies
    words = collections.Counter()
    for r in docs.collect():
        words[r.doc_id] += r.n_words
        assert r.bin_size in packing.SIZES
    assert words == {r.doc_id: r.taken for r in mixing.mixed_sizes(seen["near_dedup"]).collect() if r.copies}


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_odd_rows_and_columns(spark, tmp_path):
    """Every stage takes nulls in any column, empty and long texts, repeated rows and clashing columns, and loses no column."""
    r = random.Random(3)
    good = lambda n: " ".join(r.choice("the of and to a in is that it was for on with as".split()) + r.choice(["", " tree", " river", " stone", " letter", " evening"]) for _ in range(n))
    rows = [(i, good(120) + "\n" + good(60), "en", f"s{i % 3}", 1) for i in range(12)]
    rows += [rows[0], rows[0], (3, good(200), None, None, None), (None, good(150), "en", "s0", 3), (None, None, None, None, None), (90, "", "en", "s1", 0), (91, " \n ", "en", "s1", 3), (92, good(30_000), "en", "s2", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "doc_id as id", "text as row", "source as row_key", "1 as kept", "2 as template_doc", "3 as mix_rate", "4 as n", "5 as bin")
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, SF)
            path = str(tmp_path / f"{name}-{empty}")
            out.write.parquet(path)
            if name != "best_fit_packing":
                assert out.columns == docs.columns, name
            now = spark.read.schema(out.schema).parquet(path)
            assert (now.count() == 0) == empty, name
    assert {x.doc_id for x in now.collect()} <= {i for i, *_ in rows}
