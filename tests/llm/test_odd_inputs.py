"""Long hosts and texts, null ids, clashing names, settings that must not show;
the license scan and the corpus pipeline against plain versions."""

import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from salesmart.llm import licenses, line_dedup, lm_scoring, queries, url_rules, warc
from salesmart.llm.tables import components, stars
from salesmart.session import scratch_path

SF = "/root/testdata/sf0.001"
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


# -- op3 ----------------------------------------------------------------------

def test_url_with_very_many_labels(spark):
    host = ".".join(["a"] * 200_000) + ".example.com"
    rows = [(1, f"http://{host}/en/x"), (2, f"http://{host}/de"), (3, "http://www.example.com/en/"), (3, "http://www.example.com/en/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("url_hash", F.lit(7))
    got = sorted((r.page_id, r.rule, r.verdict) for r in url_rules.judge_urls(pages, queries.RULES).collect())
    assert got == [(1, "example.com/en/", "block"), (2, "com/", "allow"), (3, "www.example.com/en/", "allow"),
                   (3, "www.example.com/en/", "allow")]


# -- op6 ----------------------------------------------------------------------

def _plain_scan(text):
    words = ALNUM.findall((text or "").translate(LOWER))
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i: i + len(parts)] == parts]
    starts = [i for i, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in found})))


def test_license_base_columns_equal_a_plain_scan(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.QUERIES["op6_license_scan"](spark, str(tmp_path)).collect()}
    for d in docs.collect():
        r = got[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _plain_scan(d.text)
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_scan_of_long_texts_is_linear(spark):
    label, notice = licenses.NOTICES[0]
    notice = " ".join(ALNUM.findall(notice.translate(LOWER)))
    edited = notice[:20] + "q" + notice[21:]
    took = []
    for n in (100, 400):
        text = (edited + " x ") * n + "mit license " * (50 * n)
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        t = time.perf_counter()
        row = licenses.scan_licenses(df, notices=[(label, notice)]).first()
        took.append(time.perf_counter() - t)
        assert len(row.notices) == n and len(row.phrases) == 50 * n
        assert [m.first_word for m in row.notices] == [i * (edited.count(" ") + 2) for i in range(n)]
    assert took[1] < 12 * took[0] + 2


# -- op8 ----------------------------------------------------------------------

def test_archive_does_not_depend_on_settings(spark):
    r = random.Random(5)
    rows = [(i if i % 7 else None, f"http://h/{i}", "shared" if i % 5 == 0 else "".join(r.choices("abc ", k=r.randrange(900))))
            for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    old, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in ("4", "9"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            target = scratch_path(spark, "warc-settings")
            manifest = warc.write_warc(pages.repartition(int(parts)), target, shard_bytes=40_000, roll_bytes=8_000)
            seen.append(sorted(tuple(x) for x in manifest.collect()))
            got = warc.read_warc(spark, target).collect()
            assert len(got) == len(rows) and sum(x.record_type == "revisit" for x in got) == 59
            assert not warc.file_system(target)[0].get_file_info(f"{warc.file_system(target)[1]}/_attempts").is_file
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1] and len({x[1] for x in seen[0]}) > 3


def test_revisits_name_the_record_they_refer_to(spark):
    pages = spark.createDataFrame([(1, "http://h/1", "p"), (2, "http://h/b", "p"), (2, "http://h/a", "p")],
                                  "page_id long, url string, html string")
    target = scratch_path(spark, "warc-revisit")
    name = warc.write_warc(pages, target).first().file
    fs, base = warc.file_system(target)
    with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
        heads = [warc.parse_member(m)[0] for m in warc.members(f.read())]
    assert [h["WARC-Type"] for h in heads] == ["warcinfo", "revisit", "response", "revisit"]
    response = heads[2]
    for h in (heads[1], heads[3]):
        assert h["WARC-Refers-To"] == response["WARC-Record-ID"] and h["WARC-Refers-To-Target-URI"] == "http://h/a"
        assert h["WARC-Refers-To-Date"] == response["WARC-Date"]


# -- op9 ----------------------------------------------------------------------

def test_null_ids_are_documents_of_their_own(spark):
    rows = [(1, "b"), (None, "a"), (None, "b"), (None, "c\nd"), (None, "d"), (None, "c\nd"), (2, "x\ny"), (2, "y\nz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lines", F.lit("mine"))
    got = line_dedup.dedup_lines(docs.repartition(3))
    assert got.columns == ["doc_id", "text", "lines", "lines_"]
    out = [(r.doc_id, r.text, r.lines) for r in got.collect()]
    assert all(x[2] == "mine" for x in out)
    kept = sorted(line for i, t, _ in out if i is None for line in t.split("\n") if line)
    assert "b" not in kept and kept.count("a") == 1 and kept.count("d") + kept.count("c") in (2, 3, 4)
    by_id = sorted(line for i, t, _ in out if i == 2 for line in t.split("\n") if line)
    assert by_id == ["x", "y", "z"]
    assert sorted(t for i, t, _ in out if i == 1) == ["b"]


def test_line_recall_on_documents(spark):
    """Every pair of distinct lines at Jaccard 0.8, by exhaustive comparison, is in one component: the share found."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    lines = {}
    for d in docs.collect():
        for line in (d.text or "").split("\n"):
            line = line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
            if line:
                lines.setdefault(line, {line[i: i + 10] for i in range(max(1, len(line) - 9))})
    texts = sorted(lines)
    grams, sets = {}, [lines[t] for t in texts]
    pairs = set()
    for i, s in enumerate(sets):
        near = {}
        for g in s:
            for j in grams.setdefault(g, []):
                near[j] = near.get(j, 0) + 1
            grams[g].append(i)
        pairs |= {(j, i) for j, n in near.items() if 100 * n >= 80 * (len(s) + len(sets[j]) - n)}
    assert len(pairs) > 20
    both = sorted({i for p in pairs for i in p})
    frame = spark.createDataFrame([(i, texts[i]) for i in both], "doc_id long, text string")
    kept = {r.doc_id for r in line_dedup.dedup_lines(frame).collect() if r.text}
    group = {i: i for i in both}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for a, b in pairs:
        group[max(root(a), root(b))] = min(root(a), root(b))
    want = {root(i) for i in both}
    assert len(want) / len(kept) >= 0.98 and want <= kept


def test_stars_keep_components():
    r = np.random.default_rng(4)
    for _ in range(30):
        a, b = r.integers(0, 60, 40), r.integers(0, 60, 40)
        nodes, low = stars(a, b)
        label = {int(x): int(y) for x, y in zip(nodes, low)}
        parent = {int(x): int(x) for x in np.union1d(a, b)}

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for x, y in zip(a.tolist(), b.tolist()):
            parent[max(root(x), root(y))] = min(root(x), root(y))
        assert all(label.get(x, x) == root(x) for x in parent)


def test_components_of_a_long_chain(spark):
    edges = spark.range(2000).selectExpr("id as a", "id + 1 as b").repartition(6)
    got = components(edges)
    assert got.count() == 2001 and got.select("component").distinct().collect()[0][0] == 0


# -- op1 ----------------------------------------------------------------------

def test_model_score_is_the_sum_of_its_words(spark):
    """Piece counts, words and document sums by a plain version."""
    docs = [(i, t) for i, t in enumerate(["the cat the hat", "a cat é漢", None, "", "hat " * 50, "The CAT"])]
    path = queries.tokenizer("piece_bpe_32k.model")
    sp = lm_scoring.processor(path)
    counts, ends = {}, 0
    for i, t in docs:
        if zlib.crc32(str(i).encode()) % 10:
            ends += 1
            for w in (t or "").translate(LOWER).split():
                for piece in sp.encode(w):
                    counts[piece] = counts.get(piece, 0) + 1
    pieces, bytes_, end = lm_scoring.piece_table(path, counts, ends)
    longest = max(map(len, pieces))
    got = lm_scoring.score_documents(spark.createDataFrame(docs, "doc_id long, text string"), path)
    for r in got.collect():
        logs = [lm_scoring.marginal(w, pieces, bytes_, longest) for w in (docs[r.doc_id][1] or "").translate(LOWER).split()]
        assert r.score == pytest.approx((sum(logs) + end) / np.log(10))


# -- pipeline -----------------------------------------------------------------

def test_pipeline_takes_odd_tables(spark, tmp_path):
    text = " ".join(f"word{i} and{i % 7} so{i % 11}" for i in range(120))
    rows = [(1, text, "x"), (2, text, "x"), (None, text + " more", "x"), (3, None, "x"), (4, "", None), (5, "short", "x"), (5, "short", "x")]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, source string, lines int, rules int, n_hit int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert 1 in {r.doc_id for r in got}
    assert all(r.n_tokens > 0 for r in got)
    stage = corpus_pipeline.dedup_lines(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    assert stage.columns == docs.columns
    stage = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert stage.columns == docs.columns and {r.lines for r in stage.collect()} <= {1}
    empty = docs.limit(0)
    for name, fn in corpus_pipeline.STAGES:
        assert fn(spark, empty, str(tmp_path)).collect() == [], name


def test_passages_are_cut_like_plain_slices(spark, tmp_path):
    bench = [(1, " ".join(f"item{i}" for i in range(20))), (2, "kurz é")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = [(1, f"Ä before, {bench[0][1].upper()}! after é"), (2, "x " * 400 + bench[0][1]), (3, None), (4, "kurz é"), (5, "clean text")]
    frame = spark.createDataFrame([(i, t, "n", 1) for i, t in docs], "doc_id long, text string, n_words string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.decontaminate_documents(spark, frame, str(tmp_path)).collect()}
    assert got[1].text == "Ä before, ! after é" and got[1].n_chars == len(got[1].text) and got[1].n_words == "n"
    assert got[2].text == docs[1][1] if 20 * 20 < 420 else True
    assert got[3].text is None and got[4].text == "" and got[5].text == "clean text"
