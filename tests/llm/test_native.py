"""Quality rules, line templates and mixing."""

import re

import pytest
from pyspark.sql import functions as F

from docfold.llm import mixing, oracle, quality, queries, templates
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_sql(spark, name):
    same(spark, connect(SF), queries.QUERIES[name], oracle.ORACLE[name], SF)


def test_native_plans(spark):
    for name in ("op3_line_templates", "op7_quality_rules", "op9_mix_sources"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


def test_quality_counts(spark):
    texts = ["a b c a b c", "a a a a", "x\nx\n\n \ny", "", None, "#1 *bold* | <td>", "a b c d a b c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("m", F.lit("clash"))
    got = {r.doc_id: r for r in quality.judged(df).collect()}
    assert [got[i].n_repeat_words for i in range(7)] == [6, 4, 0, 0, 0, 0, 6]
    assert (got[2].n_words, got[2].n_dup_lines, got[2].n_lines) == (3, 1, 3)
    assert got[5].n_symbols == 6 and got[5].word_chars == 13
    assert all(r.base_failed and not r.kept for r in got.values())
    assert quality.keep_good(df).columns == df.columns and quality.keep_good(df.limit(0)).count() == 0


def test_quality_keeps_prose(spark):
    words = [f"{a}{b}" for a in ("the", "of", "and", "stone", "river", "cloud") for b in ("", "s", "er", "ing", "ly", "ed", "y", "al", "ic", "en")]
    good, bad = " ".join(words), " ".join(w + "###" for w in words)
    df = spark.createDataFrame([(1, good), (2, bad), (3, good.replace(" ", " | "))], "doc_id long, text string")
    assert [r.doc_id for r in quality.keep_good(df).collect()] == [1]


def test_templates(spark):
    boiler = "Page {} of this book was printed in the town of {} by hand"
    docs = [(i, f"text {'abcdefghij'[i]} alone here\n{boiler.format(i, 'XY' + 'klmnopqrst'[i])}\nend {'abcdefghij'[i] * 3}", "s") for i in range(8)]
    docs += [(100 + i, "same first line\nsame second line\nsame third line", None) for i in range(9)]  # copies are left alone
    docs += [(200, None, "t"), (201, "", "t"), (200, None, "t"), (None, "one line", "t")]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_dropped string")
    got = templates.without_templates(df).collect()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert len(got) == len(docs) and all("printed" not in by[i].kept_text and by[i].kept_text.count("\n") == 1 for i in range(8))
    assert by[104].kept_text == by[104].text and by[200].kept_text is None and by[201].kept_text == ""
    out = templates.drop_templates(df)
    assert out.columns == df.columns and out.count() == len(docs)
    assert templates.drop_templates(df.limit(0)).count() == 0
    only = spark.createDataFrame([(i, f"{'abcdefg'[i]}\nAll rights reserved by us here" if i else "All rights reserved by us here") for i in range(7)], "doc_id long, text string")
    assert sorted(r.doc_id for r in templates.drop_templates(only).collect()) == list(range(1, 7))


def own_line(i):
    letters = "abcdefghijklmnopqrstuvwxyz"
    return " ".join(f"{x}{y}{letters[i // 26]}{letters[i % 26]}" for x in "abcdef" for y in "uvwxyz")


def test_variable_fields_wherever_they_stand(spark):
    """Neighbouring variable words, variables at odd and even places, and short lines generalise; lines that merely begin alike stay."""
    a, b = "anna ben cleo dora emil finn gina hugo".split(), "adler beck corda drew egger falk grant holm".split()
    lines = lambda i: [f"This article was written by {a[i]} {b[i]} for us", f"Sent on {a[i]} from the {b[i]} of our own post", f"Posted by {a[i]}", f"The end of {a[i]} {b[i]} {a[-i - 1]} {own_line(i)[:4]} tale{'xyzuvwrs'[i]}"]
    df = spark.createDataFrame([(i, "\n".join([own_line(i), *lines(i)])) for i in range(8)], "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in templates.without_templates(df).collect()}
    for i in range(8):
        # In the second line the leading words hold a variable, so no two of its lines share a leaf.
        assert got[i] == "\n".join([own_line(i), lines(i)[1], lines(i)[3]])


def test_constants_grow_with_the_leaf(spark):
    """A word in five of two hundred lines of a leaf is a variable; in five of ten it is not, and keeps templates apart."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = [(i, f"{own_line(i)}\nSee our page on {letters[i // 26]}{letters[i % 26]} for the {'red' if i < 5 else letters[i % 26] + letters[i // 26]} thing") for i in range(200)]
    few = [(1000 + i, f"{own_line(300 + i)}\nAsk the shop for a {'blue' if i < 5 else 'green' if i < 9 else 'grey'} coat") for i in range(10)]
    got = {r.doc_id: r.n_dropped for r in templates.without_templates(spark.createDataFrame(many + few, "doc_id long, text string")).collect()}
    assert all(got[i] == 1 for i in range(200))
    assert [got[1000 + i] for i in range(10)] == [1] * 10  # five blue coats, and five of any other colour


def test_crowded_leaves(spark):
    """Thirty lines of one leaf, each in eight documents, all go, and documents that crowd the leaf further bring none of them back."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda i: letters[i // 26] + letters[i % 26]
    line = lambda k: f"All our pages {word(k)}x {word(k + 7)}y {word(k + 3)}z"
    rows = [(8 * k + j, f"{own_line(8 * k + j)}\n{line(k)}") for k in range(30) for j in range(8)]
    crowd = [(1000 + i, f"{own_line(300 + i)}\nAll our pages {word(i)}u {word(i)}v {word(i)}w") for i in range(300)]
    for extra in ([], crowd):
        got = templates.without_templates(spark.createDataFrame(rows + extra, "doc_id long, text string")).where("doc_id < 1000")
        assert [r.n_dropped for r in got.collect()] == [1] * 240
        left = templates.without_templates(spark.createDataFrame(rows + extra, "doc_id long, text string")).where("doc_id >= 1000 and n_dropped > 0")
        assert left.count() == 0


def test_templates_of_blocks(spark):
    letters = "abcdefghijklmnopqrst"
    own = lambda i, n: " ".join(f"{x}{letters[i]}" for x in letters[:n])
    framed = [(i, f"{own(i, 9)}\n\nAll rights reserved\n\n{own(i, 12)}") for i in range(20)]
    block = [(100 + i, f"Top of site\nSecond of top\n{own(i, 14)}\nFooter one here\nFooter two here\nFooter three here") for i in range(20)]
    base = [f"{x}{y}" for x in letters for y in letters[:15]]
    near = [(200 + i, "\n".join([" ".join(base[:100]), "clean line of copies", " ".join([*base[100:200], letters[i]]), " ".join(base[200:])])) for i in range(20)]
    df = spark.createDataFrame(framed + block + near, "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in templates.without_templates(df).collect()}
    assert all(got[i] == f"{own(i, 9)}\n\n\n{own(i, 12)}" and got[100 + i] == own(i, 14) for i in range(20))
    assert all(got[i] == text for i, text in near)  # near copies are left alone


def test_templates_with_copies(spark):
    own = lambda i: " ".join(f"{x}{y}{'abcdefghij'[i]}" for x in "abcdef" for y in "uvwxyz")
    docs = [(i, f"{own(i)}\nAll rights reserved by us") for i in range(10)]
    copied = docs + [(100 + i, docs[3][1]) for i in range(90)] + [docs[4]] * 90
    refrain = [(1000 + i, "\n".join([own(i).upper(), *["Yes he said"] * 9])) for i in range(10)]
    for rows in (docs, copied):
        df = spark.createDataFrame(rows + refrain, "doc_id long, text string")
        got = {r.doc_id: r.kept_text for r in templates.without_templates(df).collect()}
        assert all(got[i] == own(i) for i in range(10)) and got.get(189, own(3)) == own(3)
        assert all(got[i] == text for i, text in refrain)


def level(sizes, weights, share=1.5, most=2.0):
    """Targets by resharing the excess until none is above."""
    total, capped = share * sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        left = total - sum(most * sizes[i] for i in capped)
        part = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if part[i] > most * sizes[i]}
        if not over:
            return [most * sizes[i] if i in capped else part[i] for i in range(len(sizes))]
        capped |= over


def test_mixing(spark):
    rows = []
    sizes = {"a": 40, "b": 300, "c": 7, "d": 90, None: 50}
    for s, n in sizes.items():
        rows += [(len(rows) + i, "w " * 10, s) for i in range(n)]
    rows.append((9999, None, "a"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("rate", F.lit(1)).withColumn("size", F.lit("x"))
    got = mixing.mixed_sizes(df).collect()
    want = dict(zip(["a", "b", "c", "d", None], level([10 * n for n in sizes.values()], [3, 1, 2, 3, 1]), strict=True))
    target = {r.source: r.target for r in got}
    assert all(abs(target[s] - want[s]) < 1e-6 for s in want)
    assert all(r.taken <= 2 * r.size for r in got)
    for s in ("b", "d"):
        assert abs(sum(r.taken for r in got if r.source == s) - want[s]) < 0.2 * want[s] + 30
    mix = mixing.mixed(df)
    assert mix.columns == df.columns and mix.count() == sum(r.copies for r in got)
    assert sorted(r.doc_id for r in mix.collect()) == sorted(r.doc_id for r in mixing.mixed(df.repartition(5)).collect())
    assert mixing.mixed(df.limit(0)).count() == 0 and mixing.mixed_sizes(df.limit(0)).count() == 0
