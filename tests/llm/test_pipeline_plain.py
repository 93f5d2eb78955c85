"""The corpus pipeline against a plain version: every stage on what its
predecessor stored, and the whole run, by rows and texts."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from salesmart.llm import bpe, queries
from test_text_operators import ALNUM, LOWER, SPACED, plain_quality, shingles

SF = "/root/testdata/sf0.001"


def components(sets, percent):
    """{key: smallest key} of the sets linked where 100 * intersection >= percent * union."""
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = {}
    for k in sorted(sets):
        shared = Counter(j for g in sets[k] for j in holders.get(g, ()))
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[k]) + len(sets[j]) - n):
                a, b = sorted((root(j), root(k)))
                parent[b] = a
        for g in sets[k]:
            holders.setdefault(g, []).append(k)
    return {k: root(k) for k in sets}


def with_text(row, text):
    return {**row, "text": text, "n_chars": None if text is None else len(text)}


def quality_rules(rows, labels, bench):
    by_score = plain_quality([(r["doc_id"], r["text"]) for r in rows], labels)

    def failed(text):
        w = SPACED.findall(text or "")
        grams = [tuple(w[i: i + 5]) for i in range(len(w) - 4)]
        often = Counter(grams)
        repeated = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
        return len(w) < 10 or 100 * len(repeated) > 20 * len(w)

    return [r for r in rows if by_score[r["doc_id"]][1] and not failed(r["text"])]


def folded(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def line_dedup(rows, labels, bench):
    places = {}
    for r in rows:
        for i, line in enumerate((r["text"] or "").split("\n")):
            if folded(line):
                places.setdefault(folded(line), []).append((r["doc_id"], i))
    first = {min(at): line for line, at in places.items()}
    sets = {at: {line[i: i + 10] for i in range(max(1, len(line) - 9))} for at, line in first.items()}
    kept = {at for at, least in components(sets, 80).items() if at == least}
    out = []
    for r in rows:
        lines = (r["text"] or "").split("\n")
        left = [x for i, x in enumerate(lines) if not folded(x) or (r["doc_id"], i) in kept]
        if not any(map(folded, lines)) or any(map(folded, left)):
            out.append(with_text(r, None if r["text"] is None else "\n".join(left)))
    return out


def near_dedup(rows, labels, bench):
    least = components({r["doc_id"]: shingles(r["text"]) for r in rows}, 80)
    return [r for r in rows if least[r["doc_id"]] == r["doc_id"]]


def decontamination(rows, labels, bench):
    windows = set()
    for t in bench:
        w = ALNUM.findall((t or "").translate(LOWER))
        windows |= {tuple(w[i: i + 13]) for i in range(max(1, len(w) - 12) if w else 0)}
    out = []
    for r in rows:
        text = r["text"] or ""
        found = list(ALNUM.finditer(text.translate(LOWER)))
        w = [m.group() for m in found]
        hit = set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i: i + n]) in windows:
                    hit.update(range(i, i + n))
        if hit and 20 * len(hit) >= len(w):
            left, at = [], 0
            for i in sorted(hit):
                if i - 1 not in hit:
                    left.append(text[at: found[i].start()])
                at = found[i].end()
            r = with_text(r, "".join(left) + text[at:])
        else:
            r = with_text(r, r["text"])
        out.append(r)
    return out


def byte_bpe(rows, labels, bench):
    enc = bpe.encoder(queries.tokenizer("byte_bpe_50k.tiktoken"), queries.pre_token_pattern())
    out = []
    for r in rows:
        raw = (r["text"] or "").encode()
        ids = enc.encode_ordinary(r["text"] or "")
        out.append({"doc_id": r["doc_id"], "n_tokens": len(ids), "ids": ids,
                    "ids_sha256": hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    "decoded_sha256": hashlib.sha256(raw).hexdigest()})
    return out


PLAIN = [quality_rules, line_dedup, near_dedup, decontamination, byte_bpe]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The documents and, under other line breaks and with one word changed,
    more copies of some: whole documents are near copies, their lines are not."""
    target = tmp_path_factory.mktemp("plain")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    more = []
    long = [r for r in docs.orderBy("doc_id").collect() if r.doc_id in good and 150 <= len((r.text or "").split()) < 1500]
    for k, r in enumerate(long[:12]):
        w = r.text.split()
        w[70] = "changed"
        text = "\n".join(" ".join(w[i: i + 12]) for i in range(0, len(w), 12))
        more.append({**r.asDict(), "doc_id": 10 ** 6 + k, "text": text, "n_chars": len(text)})
    docs.union(spark.createDataFrame(more, docs.schema).select(docs.columns)).write.parquet(str(target / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(target / f"{name}.parquet"))
    return str(target)


def as_dicts(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: r["doc_id"])


def test_pipeline_equals_a_plain_version(spark, folder):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    bench = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows, changed = as_dicts(docs), {}
    for (name, stage), plain in zip(corpus_pipeline.STAGES, PLAIN, strict=True):
        assert plain.__name__ == name
        stored = f"{folder}/stage-{name}"
        stage(spark, docs, folder).write.parquet(stored)
        docs = spark.read.parquet(stored)
        want = plain(rows, labels, bench)
        got = as_dicts(docs)
        assert [r["doc_id"] for r in got] == [r["doc_id"] for r in want], name
        for a, b in zip(got, want):
            assert a == b, (name, a["doc_id"])
        before = {r["doc_id"]: r.get("text") for r in rows}
        changed[name] = (len(rows) - len(got), sum(r.get("text") != before[r["doc_id"]] for r in got))
        rows = got
    # Every stage has something to do here: (documents gone, texts changed).
    assert changed["quality_rules"][0] and changed["line_dedup"][0] and changed["line_dedup"][1], changed
    assert changed["near_dedup"][0] and changed["decontamination"][1], changed
    assert as_dicts(corpus_pipeline.run(spark, folder)) == rows
