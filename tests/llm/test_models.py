"""Language identification, lattice scores, extraction, packing and search."""

import collections
import math
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docfold.llm import extraction, langid, lattice, packing, queries, vptree

SF = "/root/testdata/sf0.001"


def test_languages(spark):
    rows = queries.op2_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    share = rows.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.98
    odd = spark.createDataFrame([(1, None, "en", 0), (2, "123 !!", "en", 0), (3, "the cat and the dog", "en", 0), (3, "the cat and the dog", None, 0), (None, "le chat et le chien", "fr", 0)], "doc_id long, text string, lang string, score int")
    got = {(r.doc_id, r.lang_pred) for r in langid.held_out_languages(odd).collect()}
    assert {(1, "und"), (2, "und"), (None, "fr")} <= got
    assert langid.held_out_languages(odd.limit(0)).count() == 0


def test_languages_by_brute_force(spark, tmp_path):
    """The query against profiles and distances written out, with ties, unknown letters and texts longer than a profile."""
    r, rows = random.Random(5), []
    for i in range(120):
        lang = ("en", "fr", "de", None)[i % 4]
        pool = {"en": "the of and house", "fr": "le la été maison", "de": "der die über haus"}.get(lang, "xyz zyx yy").split()
        rows.append((i, " ".join(r.choice(pool) + r.choice(["", "s", "er", "12", "!"]) for _ in range(r.choice([1, 3, 40, 900]))), lang))
    rows += [(200, "abab", "aa"), (203, "abab", "zz"), (204, None, "en"), (205, "12 34", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))

    def profile(texts):
        n = collections.Counter()
        for t in texts:
            b = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in t.encode())
            n.update(g for k in range(1, langid.LONGEST + 1) for g in (b[i : i + k] for i in range(len(b) - k + 1)) if g != b" " and b"  " not in g)
        return [g for g, _ in sorted(n.items(), key=lambda x: (-x[1], len(x[0]), x[0]))[: langid.PROFILE]]

    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows}
    known = {lang: profile([t for i, t, x in rows if x == lang and t and not held[i]]) for lang in sorted({x for i, t, x in rows if x and t is not None and not held[i]})}
    for got in queries.op2_language_id(spark, str(tmp_path)).collect():
        text = rows[[x[0] for x in rows].index(got.doc_id)][1]
        assert got.held_out == held[got.doc_id]
        if not text or not any(c.isalpha() for c in text):
            assert (got.lang_pred, got.score) == ("und", 0.0)
            continue
        mine = profile([text])
        apart = {lang: sum(abs(theirs.index(g) - i) if g in theirs else langid.PROFILE for i, g in enumerate(mine)) for lang, theirs in known.items()}
        best = min(apart, key=lambda x: (apart[x], x))
        assert got.lang_pred == best and abs(got.score - (1 - apart[best] / (langid.PROFILE * len(mine)))) < 1e-12


def test_grams_of_long_texts(monkeypatch):
    r = random.Random(1)
    text = np.frombuffer("".join(r.choice("abc  ") for _ in range(999)).encode(), np.uint8)
    whole = langid.text_grams(text)
    monkeypatch.setattr(langid, "PIECE", 100)
    assert all((a == b).all() for a, b in zip(whole, langid.text_grams(text), strict=True))


def test_grams_at_word_starts():
    text = b"a  the de"
    want = {text[i : i + n] for n in range(1, langid.LONGEST + 1) for i in range(len(text) - n + 1)}
    want = {g for g in want if g != b" " and b"  " not in g}
    got = {int(x & np.uint64(2**56 - 1)).to_bytes(int(x >> np.uint64(56)), "big") for x in langid.grams(np.frombuffer(text, np.uint8))}
    assert got == want and b" th" in got and b" de" in got


def test_scores(spark):
    texts = {i: t for i, t in enumerate(["the cat sat on the mat", "the dog ###", None, "", "Ünïcode the CAT", "x" * 100 + " the"] * 4)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("word", F.lit(1))
    got = {r.doc_id: r for r in lattice.score_texts(df).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    tokens = {i: [w for w in "".join(c.lower() if c.isascii() else c for c in t or "").split()] for i, t in texts.items()}
    counts = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    ends = sum(not h for h in held.values())
    n, v = sum(counts.values()) + ends, len(counts) + 1
    ranks = lattice.load_ranks(lattice.VOCABULARY)
    pieces = collections.Counter()
    cutter = lattice.tokenizer(ranks)
    for w, c in counts.items():
        for p in cutter.encode_ordinary(" " + w):
            pieces[p] += c
    below = sum(pieces.values()) + ends + 0.1 * (len(ranks) + 1)
    score = {p: math.log10((pieces[r] + 0.1) / below) for p, r in ranks.items()}

    def marginal(word):
        b, a = (" " + word).encode(), [1.0]
        for j in range(1, len(b) + 1):
            a.append(sum(a[i] * 10 ** score[b[i:j]] for i in range(j) if b[i:j] in score))
        return math.log10(a[-1])

    for i, ws in tokens.items():
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*(counts[w] for w in ws), ends])
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws) + 1, sum(counts[w] > 0 for w in ws) + 1, n)
        assert abs(r.base_score - base) < 1e-6 * max(1, -base)
        want = sum(marginal(w) for w in ws) + math.log10((ends + 0.1) / below)
        assert abs(r.score - want) < 1e-6 * max(1, -want)
    assert lattice.score_texts(df.limit(0)).count() == 0


def test_names_of_what_a_text_is_about():
    """Ids and classes that tell the subject of a heading, section or paragraph drop nothing, nor do words in other attributes."""
    tree, long = extraction.train(), " ".join(f"word{i}" for i in range(70))
    for inner in (
        '<h2 id="related-work">Related work</h2>', '<h2 id="search-and-side-effects">Search and side effects</h2>', f'<section id="discussion"><h2>Discussion</h2><p>{long}</p></section>', f'<p id="footer-design">{long}</p>',
        f'<section id="advertising-in-the-19th-century"><p>{long}</p></section>', f'<div class="social history"><p>{long}</p></div>', f'<div class="copyright-law"><p>{long}</p></div>', f'<p class="share-of-income">{long}</p>',
        f'<p title="The hidden cost of war">{long}</p>', f'<section aria-label="a hidden gem"><p>{long}</p></section>', f'<div class="comment-on-the-war">{long}</div>', f'<div data-x="hidden" class="share"><p>{long}</p></div>',
    ):
        got = extraction.main_text(f"<article><p>{long} a</p>{inner}<p>{long} z</p></article>", tree)
        body = extraction.re.sub("<[^>]*>", " ", inner).split()
        assert got.split() == [*long.split(), "a", *body, *long.split(), "z"], inner
    for inner in (
        f'<div class="comment-list"><p>{long}</p></div>', f'<div id="comments"><p>{long}</p></div>', f'<div class="ad-slot-2"><p>{long}</p></div>', f'<p hidden>{long}</p>', f'<p hidden="until-found" title="x">{long}</p>', f'<div class="x cookie-notice">{long}</div>',
        f'<div role="complementary">{long}</div>', '<div class="share"><a href=x>Share</a> <a href=y>this</a></div>', '<div class="social-links">Follow us</div>', "<div class=copyright>All rights reserved</div>",
    ):
        assert extraction.main_text(f"<article><p>{long} a</p>{inner}<p>{long} z</p></article>", tree) == f"{long} a\n\n{long} z", inner


def test_long_pieces():
    """Pieces of up to 128 bytes are in the lattice: runs of one symbol have the probability of all their segmentations."""
    ranks = lattice.load_ranks(lattice.VOCABULARY)
    scores = np.log10(np.random.default_rng(3).random(max(ranks.values()) + 1) * 1e-3)
    model = lattice.Lattice(ranks, scores)
    assert model.longest == max(map(len, ranks)) > 64 and any(len(p) == 64 for p in ranks)
    for piece in [p for p in ranks if len(p) >= 32]:
        for word in (piece, b" " + piece + piece[:7], piece * 2):
            a = [1.0]
            for j in range(1, len(word) + 1):
                a.append(sum(a[i] * 10 ** scores[ranks[word[i:j]]] for i in range(max(0, j - 128), j) if word[i:j] in ranks))
            rows = np.frombuffer(word, np.uint8)
            for got in (model.score(rows[None])[0], model.score_long(rows)):
                assert abs(got - math.log10(a[-1])) < 1e-9 * max(1, -math.log10(a[-1]))


def test_long_words():
    """One walk or a table: the same probability; a word of a megabyte takes seconds."""
    ranks = lattice.load_ranks(lattice.VOCABULARY)
    r = np.random.default_rng(1)
    model = lattice.Lattice(ranks, np.log10(r.random(max(ranks.values()) + 1) * 1e-4))
    for n in (1, 2, 7, 33, 64, 65, 300):
        word = np.concatenate([[32], r.integers(97, 123, n)]).astype(np.uint8)
        assert abs(model.score(word[None])[0] - model.score_long(word)) < 1e-8
    began = time.time()
    score = model.score_long(np.resize(np.frombuffer(b"aGVsbG8gd29ybGQ" + "语言".encode(), np.uint8), 1 << 20))
    assert -np.inf < score < -(1 << 18) and time.time() - began < 30


def test_words_of_one_count_are_not_gathered(spark, monkeypatch):
    """More words in the highest bin of counts than may be sent: all of them are joined instead."""
    df = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(40))) for i in range(30)], "doc_id long, text string")
    want = {x.doc_id: x for x in lattice.score_texts(df).collect()}
    monkeypatch.setattr(lattice, "FREQUENT", 20)
    made = []
    batches = lattice.score_batches
    monkeypatch.setattr(lattice, "score_batches", lambda ranks, scores, end, keys, terms: made.append(len(keys)) or batches(ranks, scores, end, keys, terms))
    got = {x.doc_id: x for x in lattice.score_texts(df).collect()}
    assert made == [0] and all(abs(got[i].base_score - want[i].base_score) < 1e-9 and got[i].n_known == want[i].n_known for i in want)


def test_rare_words_are_joined(spark, monkeypatch):
    df = spark.read.parquet(SF + "/documents.parquet")
    want = {r.doc_id: r for r in lattice.score_texts(df).collect()}
    monkeypatch.setattr(lattice, "FREQUENT", 5)
    for r in lattice.score_texts(df).collect():
        assert (r.n_known, r.n_tokens) == (want[r.doc_id].n_known, want[r.doc_id].n_tokens) and abs(r.base_score - want[r.doc_id].base_score) < 1e-6


def test_unread_without_end_tag():
    tree, body = extraction.train(), " ".join(f"word{i}" for i in range(60))
    article = f"<article><p>{body}</p></article>"
    for page in (
        f"<html><head><title>T</title><meta charset=x><body>{article}",
        f"<head><title>T</title><noscript><style>p</style></noscript>{article}",
        f"<head><title>T</title></head><body><div><button>Go</div>{article}",
        f"<body><ul><li><select><option>One<li>Two</ul>{article}</body>",
        f"<body><div><object data=x></div>{article}<div><object></object></div>",
        f"<body><embed src=x>{article}",
        f"<body><svg width=1 />{article}<svg><title/><path/></svg>",
        f"<body><div><svg><title/><style/><g></svg></div>{article}",
        f"<body><svg-icon name=x></svg-icon><button-group>{article}",
    ):
        assert extraction.main_text(page, tree) == body, page
    hidden = "<template><div><template>a</template>b</div></template><svg><svg></svg><text>c</text></svg><button><p>d</p></button><script>'</div>'"
    assert extraction.main_text(f"<body>{article}<div>{hidden}", tree) == body
    assert extraction.blocks(f"<body>{hidden}") == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site name</h1></header>
<nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav><div class="cookie-notice">We use cookies, which is a long sentence that you must read before all else.</div>
<article><h1>A &amp; B</h1><p>First   paragraph has <b>bold</b> and <a href=/x>a link</a> in it,<br>and runs on.<p>Tiny.</p><script>var x = "<p>no</p>";</script>
<div class="ad">Buy this fine thing now for only nine coins, it is really good.</div><p>Last&nbsp;one &eacute;nds here with more words than before.</p></article>
<aside>Related story of some length that is not part of the article itself.</aside><form><label>Your name please</label><input></form>
<section id="comments"><h2>Comments</h2><article class="comment"><p>I liked this text a lot and say so in a long comment.</p></article></section>
<footer>&copy; Site</footer></body></html>"""


def test_extraction(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "z"), (1, "u", PAGE, "z"), (2, None, None, None), (3, "v", "", None), (4, "w", "plain text only, but long enough to count as an article in itself I hope", None)], "page_id long, url string, html string, text string")
    got = extraction.extract(df).collect()
    want = "A & B\n\nFirst paragraph has bold and a link in it, and runs on.\n\nTiny.\n\nLast one énds here with more words than before."
    assert [(r.page_id, r.text, r.n_chars) for r in got if r.page_id == 1] == [(1, want, len(want))] * 2
    assert {r.page_id: r.text for r in got if r.page_id in (2, 3)} == {2: "", 3: ""}
    assert next(r.text for r in got if r.page_id == 4).startswith("plain text")
    assert extraction.extract(df.limit(0)).count() == 0
    tree = extraction.train()
    assert all(tree(row[:-1]) == bool(row[-1]) for row in extraction.LABELLED)


def test_extraction_without_article_tags():
    long = "Several words make a paragraph of running text that any reader would take for the article. " * 2
    page = f"<div id=top-menu><a href=/>Home</a> <a href=/n>News</a></div><div><p>{long}</p><p>{long}</p></div><div><a href=/1>More stories</a> <a href=/2>Even more</a></div>"
    assert extraction.main_text(page, extraction.train()) == "\n\n".join([long.strip()] * 2)


def test_text_features_separate_without_place(spark):
    """With the place withheld, words and link densities of neighbours still tell nearly all blocks; every feature is in use."""
    tree, right, total = extraction.train(), 0, 0
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        found = extraction.blocks(r.html)
        words, links = [0, *(b[1] for b in found), 0], [0, *(b[2] for b in found), 0]
        for i, b in enumerate(found):
            total += 1
            right += tree((*words[i : i + 3], *links[i : i + 3], 0, b[4])) == (b[3] == 1)
    assert right > 0.95 * total
    used, left = set(), [tree.root]
    while left:
        node = left.pop()
        if isinstance(node, tuple):
            used.add(node[0])
            left += node[2:]
    assert used == set(range(8))


def test_place_is_not_all():
    """Within an article link lists go and linked lines between paragraphs stay; running text in a form that holds the page stays."""
    tree, long = extraction.train(), " ".join(f"word{i}" for i in range(70))
    links = "".join(f"<li><a href=/{i}>Other story {i}</a></li>" for i in range(4))
    page = f"<form id=page><input name=q><label>Search</label><div><p>{long}</p><p>{long} b</p><p>{long} c</p></div></form>"
    assert extraction.main_text(page, tree) == "\n\n".join([long, long + " b", long + " c"])
    page = f"<article><p>{long}</p><p><a href=/x>See the whole decision of the court here</a></p><p>{long} b</p><ul>{links}</ul></article>"
    assert extraction.main_text(page, tree) == "\n\n".join([long, "See the whole decision of the court here", long + " b"])
    for name in ("commentary", "shareholders", "searchlight", "promoter", "page-responders"):
        assert extraction.main_text(f"<article><div class={name}><p>{long}</p></div></article>", tree) == long
    assert extraction.main_text(f"<article><p>{long} <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p></article>", tree).endswith(" x=2")


def test_malformed_pages_take_linear_time():
    tree, began = extraction.train(), time.time()
    for part, before in (("<div>x", ""), ("<b>x", ""), ("<a>x", ""), ("<p><b>", ""), ("<li><ul>", ""), ("</i>", "<b>" * 50_000), ("<g/>", "<svg>"), ("<b>y", "<button>"), ('<a b="', "")):
        extraction.main_text(before + part * 50_000, tree)
    assert time.time() - began < 60


def test_driver_pages(spark):
    pages = spark.read.parquet(SF + "/pages.parquet")
    for r in extraction.extract(pages, ("page_id", "html")).collect():
        body = r.html.split("<article>")[1].split("</article>")[0]
        assert r.text.replace("\n\n", " ").split() == extraction.html.unescape(extraction.re.sub("<[^>]*>", " ", body)).split()


def test_packing(spark):
    r = random.Random(4)
    rows = [(i, "w " * r.choice([1, 3, 40, 300, 700, 2500, 9000])) for i in range(300)]
    rows += [(7, "same words here")] * 200 + [(None, "lost"), (500, None), (501, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bin", F.lit(1))
    got = packing.pack(df, group=60).collect()
    words = collections.Counter()
    for x in got:
        words[x.doc_id] += x.n_words
    want = collections.Counter()
    for i, t in rows:
        want[i] += len((t or "").split())
    assert words == want
    bins = collections.defaultdict(list)
    for x in got:
        if x.bin:
            bins[x.bin].append(x)
    for members in bins.values():
        members.sort(key=lambda x: x.bin_offset)
        at = 0
        for x in members:
            assert x.bin_offset == at
            at += x.n_words
        smaller = [s for s in packing.SIZES if s < members[0].bin_size]
        assert at <= members[0].bin_size and (not smaller or at > smaller[-1])
    assert {(x.doc_id, x.bin) for x in got if x.n_words == 0} == {(500, None), (501, None)}
    assert len({(x.doc_id, x.n_words, x.copy) for x in got if x.doc_id == 7 and x.n_words == 3}) == 200 + (len(rows[7][1].split()) == 3)
    assert packing.pack(df.limit(0)).count() == 0


def test_pieces_hold_all_words(spark):
    text = " ".join(f"w{i}" for i in range(9000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    parts = packing.pack(df).join(df, "doc_id").orderBy("start").select(packing.piece_text(F.col("text"), F.col("start"), F.col("n_words")).alias("p"))
    assert " ".join(x.p for x in parts.collect()) == text


def naive_best_fit(lengths, sizes):
    """Every open bin is looked at for every piece."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    bins, place = [], {}  # a bin: [capacity, filled]
    for turn, k in enumerate(order):
        n = lengths[k]
        fits = [(cap - full - n, b) for b, (cap, full) in enumerate(bins) if cap - full >= n]
        if fits:
            b = min(fits)[1]
        else:
            if len(bins) % 64 == 0:
                waiting = [lengths[i] for i in order[turn:]]
            cost = lambda c: c * (1 + c / packing.STEEP) / (n + min(c - n, sum(x for x in waiting if x <= min(c - n, n))))  # noqa: E731, B023
            b = len(bins)
            bins.append([min((c for c in sizes if c >= n), key=cost), 0])
        place[k] = (b, bins[b][1])
        bins[b][1] += n
    return [place[i] for i in range(len(lengths))], [min(s for s in sizes if s >= full) for _, full in bins]


def test_best_fit_against_all_bins(spark):
    r = random.Random(8)
    for _ in range(30):
        lengths = [r.choice([1, 2, 7, 100, 255, 256, 257, 900, 2049, 4096, r.randint(1, 4096)]) for _ in range(r.choice([0, 1, 5, 400]))]
        where, offset, final = packing.best_fit(np.array(lengths, np.int64))
        want, sizes = naive_best_fit(lengths, packing.SIZES)
        assert list(zip(where.tolist(), offset.tolist(), strict=True)) == want and final == sizes
    docs = spark.read.parquet(SF + "/documents.parquet").select("doc_id", "text")
    got = packing.pack(docs).where("bin is not null").collect()  # one packing group
    n = sorted((x.doc_id, len(x.text.split())) for x in docs.collect() if x.text and x.text.split())
    pieces = [(i, start, min(packing.SIZES[-1], k - start)) for i, k in n for start in range(0, k, packing.SIZES[-1])]
    want, sizes = naive_best_fit([k for _, _, k in pieces], packing.SIZES)
    assert {(x.doc_id, x.start, x.n_words, int(x.bin.split("-")[1]), x.bin_size, x.bin_offset) for x in got} == {(*p, b, sizes[b], at) for p, (b, at) in zip(pieces, want, strict=True)}


def test_best_fit_is_tight():
    r = np.random.default_rng(3)
    lengths = np.minimum(4096, r.lognormal(5.5, 1.2, 5000).astype(int) + 1)
    where, offset, sizes = packing.best_fit(lengths)
    assert lengths.sum() / sum(sizes) > 0.97
    assert len(set(zip(where.tolist(), offset.tolist(), strict=True))) == len(lengths)


@pytest.mark.parametrize(("factor", "least"), [(1.0, 1.0), (vptree.FACTOR, 0.9)])
def test_search(spark, factor, least):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, m = np.array([x.vec_id for x in rows]), np.array([x.embedding for x in rows], np.float64)
    norm = np.sqrt((m * m).sum(axis=1))
    got = collections.defaultdict(dict)
    for x in vptree.nearest(df, lambda i: i % 50 == 0, factor=factor, shard_bytes=150 * 64 * 8).collect():
        got[x.query_id][x.rank] = (x.vec_id, x.score)
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        score = (m * m[q]).sum(axis=1) / (norm * norm[q])
        best = [i for i in np.lexsort((ids, -score)) if i != q][:5]
        assert sorted(got[ids[q]]) == [1, 2, 3, 4, 5]
        assert all(abs(s - score[v]) < 1e-12 for v, s in got[ids[q]].values())
        hits += len({int(ids[i]) for i in best} & {v for v, _ in got[ids[q]].values()})
    assert hits >= least * 5 * (ids % 50 == 0).sum()


def test_search_leaves_out_leaves():
    """Over clustered vectors well under half of the leaves are visited at a recall of 0.9 and more; factor one is exact."""
    r = np.random.default_rng(3)
    v = (r.normal(size=(40, 32))[r.integers(40, size=4000)] + 0.35 * r.normal(size=(4000, 32))).astype(np.float64)
    ids = np.arange(4000)
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    cosine = unit[::50] @ unit.T
    cosine[np.arange(80), ids[::50]] = -2
    want = np.argsort(-cosine, axis=1)[:, :5]
    for factor, least in ((1.0, 1.0), (vptree.FACTOR, 0.9)):
        tree = vptree.VantageTree(ids, v, 5)
        q, found, _ = tree.search(ids[::50], v[::50], 5, factor)
        hits = sum(len(set(found[q == i]) & set(want[i])) for i in range(80))
        assert len(tree.leaves) > 100 and hits >= least * 400
        if factor > 1:
            assert tree.visited < 0.5 * tree.offered


def test_search_edges(spark):
    same = [(i, [1.0, 2.0]) for i in range(400)]
    odd = [(400, None), (401, [0.0, 0.0]), (402, [1.0, None]), (403, [float("nan"), 1.0]), (404, [float("inf"), 1.0]), (None, [1.0, 1.0]), (0, [1.0, 2.0]), (405, [1.0]), (450, [-1.0, 0.5])]
    df = spark.createDataFrame(same + odd, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("id", F.lit(1))
    got = collections.defaultdict(list)
    for x in vptree.nearest(df, lambda i: i % 50 == 0).orderBy("query_id", "rank").collect():
        got[x.query_id].append(x.vec_id)
    assert got[0] == [1, 2, 3, 4, 5] and got[50] == [0, 1, 2, 3, 4] and got[450] == [0, 1, 2, 3, 4] and len(got) == 9
    assert vptree.nearest(df.limit(0), lambda i: i % 50 == 0).count() == 0
