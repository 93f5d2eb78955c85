"""Main-text extraction, ranked lexical search and embedding whitening:
brute force, planted cases, odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import bag_search, html_extract, whitening
from salesmart.llm.dom import Page

SF = "/root/testdata/sf0.001"


# -- op12 ---------------------------------------------------------------------

def _terms(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def _ranked(docs, items, k=10):
    bags = [(d, Counter(_terms(t)), len(_terms(t))) for d, t in docs]
    n_docs, total = sum(n > 0 for _, _, n in bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    queries = {}
    for i, t in items:
        queries.setdefault(i, []).extend(_terms(t))
    out = []
    for item, words in queries.items():
        found = []
        for doc, bag, n in bags:
            if n:
                m = 25 + 75 * n * n_docs // total
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                        * (1_000_000_000 * bag[w] // (1000 * bag[w] + 8 * m)) for w in words if bag[w])
                if s > 0:
                    found.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


DOCS = [(7, "The cat sat. THE CAT sat"), (3, "the cat sat the cat sat"), (5, "the cat sat the cat sat"), (5, "the cat sat the cat sat"),
        (None, "the cat sat the cat sat"), (9, None), (11, ""), (12, "?!"), (13, "éclair Éclair 42 x" * 50),
        (14, "dog " * 30000 + "cat"), (20, "unrelated words only"), (21, "cat")] + [(100 + i, "hot copy of a cat") for i in range(40)]
ITEMS = [(1, "cat the cat"), (2, None), (3, "nothing here matches zzz"), (4, "Éclair éclair 42"), (5, "dog"), (5, "copy"), (None, "sat")]


@pytest.mark.parametrize("block_terms", [1 << 20, 3])
def test_search_equals_brute_force(spark, block_terms):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("score", F.lit(1)).withColumn("vec", F.lit("x"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("n", F.lit(1))
    got = bag_search.search(docs.repartition(5), items, k=4, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _ranked(DOCS, ITEMS, 4)


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert bag_search.search(docs, items.limit(0)).collect() == []
    assert bag_search.search(docs.limit(0), items).collect() == []


def test_classes_fold_copies_and_are_scored_once(spark):
    docs = spark.createDataFrame([(i, "hot copy") for i in range(500)] + [(900, "cold copy")], "doc_id long, text string")
    vocab = np.sort(np.concatenate([h for *_, h in bag_search._words(__import__("pyarrow").array(["hot copy cold"]))]))
    vectors = bag_search.document_vectors(docs, spark.sparkContext.broadcast(vocab))
    rows = bag_search.bag_classes(vectors, 501, 1002, 10).collect()
    assert sorted(len(r.members) for r in rows) == [1, 10]
    assert sorted(m.doc_id for r in rows for m in r.members) == [*range(10), 900]


# -- op13 ---------------------------------------------------------------------

def _plain_whitening(vectors, k):
    x = np.floor(256 * np.array(vectors, float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    cov = centred.T @ centred / n
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ basis / np.sqrt(values), values / np.trace(cov)


def test_whitening_equals_eigh(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(12, 12)) * np.geomspace(3, 0.05, 12)
    vectors = (rng.normal(size=(400, 12)) @ mix + 1000).astype(np.float32).astype(float).tolist()
    vectors += vectors[:150] + [vectors[0]] * 200
    bad = [None, [float("nan")] + [0.0] * 11, [None] + [0.0] * 11, [float("inf")] + [1.0] * 11, [1.0, 2.0], []]
    rows = [(i, v) for i, v in enumerate(vectors + bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit(1)).repartition(7)
    got = {(r.vec_id, r.component): r for r in whitening.whiten(df).collect()}
    assert len(got) == len(vectors) * 4
    n, deviation, white, explained = _plain_whitening(vectors, 4)
    for c in range(4):
        mine = np.array([got[i, c + 1].whitened for i in range(len(vectors))])
        assert min(abs(mine - white[:, c]).max(), abs(mine + white[:, c]).max()) < 1e-8
        assert math.isclose(got[0, c + 1].explained, explained[c], rel_tol=1e-10)
    assert all(got[i, 1].deviation == deviation[i] and got[i, 1].n == n for i in range(len(vectors)))
    assert got[0, 1].identity_error < 1e-9


def test_whitening_without_variance(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    rows = whitening.whiten(one).collect()
    assert [(r.vec_id, r.component) for r in sorted(rows)] == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in rows)
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(5)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(line).collect()
    assert {r.component: r.whitened is None for r in rows} == {1: False, 2: True, 3: True}
    assert whitening.whiten(one.limit(0)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).collect() == []


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [3, 3, 3, 1, 1], [1e6, 1, 1e-6, 1e-12, 0], [2, 2, 2, 2, 2], [1, 1 - 1e-9, 1 - 2e-9, 0, 0]])
def test_components_of_known_spectra(values):
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(5, 5)))[0]
    cov = q @ np.diag(np.array(values, float)) @ q.T
    got, basis = whitening.components(cov, 5)
    assert np.allclose(got, sorted(values, reverse=True), atol=1e-13 * max(values))
    assert np.allclose(basis.T @ basis, np.eye(5), atol=1e-12)
    assert np.linalg.norm(cov @ basis - basis * got) < 1e-12 * max(values)


def test_polar_factor_is_orthogonal_and_symmetric_part_positive():
    a = np.random.default_rng(2).normal(size=(20, 20))
    u = whitening.polar_factor(a)
    assert np.allclose(u.T @ u, np.eye(20), atol=1e-13)
    assert np.linalg.eigvalsh((u.T @ a + a.T @ u) / 2).min() > -1e-12


def test_deviation_beyond_64_bits_is_null():
    import pyarrow as pa

    state = whitening.Whitening(10 ** 9, np.array([0, 0]), np.zeros(0), np.zeros((2, 0)), 0.0)
    assert state.deviation(np.array([[1, 2], [4, 0]])).to_pylist() == [5 * 10 ** 18, None]
    assert isinstance(state.deviation(np.array([[0, 0]])), pa.Array)


# -- op11 ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def extractor(spark):
    return html_extract.fit_extractor(spark)


def test_blocks_of_a_page_with_implied_ends():
    page = Page('<title>x</title><ul><li><a>A</a><li>B</ul>t0<p><b>Hi<br>there<p class="fooBar x">&amp;b <i>c</i>'
                '<div>d<button>zz</button>e</div><script>"</p>"</script>tail &am<a href="')
    assert [t for t in page.text if t] == ["A", "B", "t0", "Hi there", "&b c", "d", "e", "tail &am"]
    assert ("foo", "bar", "x") in page.tokens


@pytest.mark.parametrize("html", ["<div>" * 50000 + "</section>" * 50000, "<a " * 90000 + '"', "<section><td>" + "<div>" * 30000
                                  + "</section>" * 30000, "<!--" * 90000, "<p>" * 90000, "x" * 3_000_000])
def test_long_odd_pages_take_linear_time(html, extractor):
    assert len(extractor.blocks([Page(html)])) == 1


def test_held_out_pages(extractor):
    hit = missed = wrong = 0
    for number in range(5000, 5200):
        page, label = html_extract._labelled(number, 9)
        want = Counter(t for t, main in zip(page.text, label) if t and main)
        got = Counter(extractor.blocks([page])[0])
        hit += sum((want & got).values())
        missed += sum((want - got).values())
        wrong += sum((got - want).values())
    assert hit / (hit + missed) > 0.97 and hit / (hit + wrong) > 0.97


def test_decoding_keeps_no_block_of_a_dropped_ancestor():
    parent = np.array([-1, 0, 1, 1, 0, 4])
    score = np.array([0, -3.0, 2, 2, -3, 2])
    assert html_extract.decode(parent, score).tolist() == [True, True, True, True, False, False]


def _article(html):
    """The article element's blocks, by plain text replacement."""
    from html import unescape

    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner.replace("<br>", " "))
    texts = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_tables_pages(spark, extractor):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in html_extract.extract_text(pages, extractor).collect()}
    for row in pages.collect():
        assert got[row.page_id].text == _article(row.html)
        assert got[row.page_id].n_chars == len(got[row.page_id].text)


def test_odd_pages(spark, extractor):
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, "v", "<nav>"), (3, "w", "<p>" + "word " * 200000),
            (4, "x", "<article><p>A &lt;b&gt; c.&nbsp; d</p><div class='ad'>Buy this now</div></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.withColumn("text", F.lit("clash")).withColumn("size", F.lit(1)).withColumn("n_chars", F.lit(2))
    got = html_extract.extract_text(df, extractor)
    assert got.columns[:4] == ["page_id", "url", "text", "n_chars"]
    by = Counter((r.page_id, r.text[:40], r.n_chars) for r in got.collect())
    assert by[(1, "", 0)] == 2 and by[(None, "", 0)] == 1 and by[(2, "", 0)] == 1
    assert by[(4, "A <b> c. d", 10)] == 1
    assert html_extract.extract_text(df.limit(0), extractor).collect() == []
