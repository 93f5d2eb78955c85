"""Language-model scores from a subword lattice.

The pieces of an existing vocabulary weigh all segmentations of a word: a
forward recursion in log space over the lattice of pieces gives the word's
marginal probability, and a text's is the product over its words and one end
symbol.  The vocabulary's own scores (merge ranks) choose the segmentation
from which the pieces' log probabilities are counted, over all training
tokens; characters without a piece go through the vocabulary's byte pieces, so
every text has a probability.

Plan: tasks cut documents into chunks of bounded size and write, once, the
chunk's distinct words with their training counts, its documents as arrays of
word numbers, and piece counts.  Words are counted in one aggregation, each
distinct word is weighed once, a join by word and a shuffle by chunk bring
counts and probabilities back, and each chunk sums its documents with array
lookups.
The driver receives one count per piece (bounded by the vocabulary) and three
totals.

Training rows are those whose crc32 of the id as text is not 0 modulo
``folds``; a null id counts as the empty text.  Null and empty texts consist
of the end symbol.  Repeated rows count as often as they stand there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import textops as T
from salesmart.llm.tables import only
from salesmart.session import materialize

U64 = np.uint64
START = "▁"  # the vocabulary's mark of a word's start


@lru_cache(maxsize=2)
def processor(model_path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path)


def piece_table(model_path: str, counts: dict[int, int], ends: int) -> tuple[dict[str, float], list[float], float]:
    """Log probabilities of the pieces, of the 256 byte pieces, of the end."""
    sp = processor(model_path)
    usable = [i for i in range(sp.get_piece_size()) if not sp.is_control(i) and not sp.is_unknown(i)]
    total = sum(counts.get(i, 0) for i in usable) + ends + 0.1 * (len(usable) + 1)
    log = {i: math.log((counts.get(i, 0) + 0.1) / total) for i in usable}
    pieces = {sp.id_to_piece(i): log[i] for i in usable if not sp.is_byte(i)}
    bytes_ = [log[sp.piece_to_id(f"<0x{b:02X}>")] for b in range(256)]
    return pieces, bytes_, math.log((ends + 0.1) / total)


def marginal(word: str, pieces: dict[str, float], bytes_: list[float], longest: int) -> float:
    """Log probability of a word: all segmentations, by forward recursion."""
    text = START + word
    n = len(text)
    alpha = [-math.inf] * (n + 1)
    alpha[0] = 0.0
    get, exp, log1p = pieces.get, math.exp, math.log1p
    for i in range(n):
        a = alpha[i]
        if text[i] not in pieces:
            x = a + sum(bytes_[b] for b in text[i].encode("utf-8", "surrogatepass"))
            y = alpha[i + 1]
            alpha[i + 1] = max(x, y) + log1p(exp(-abs(x - y))) if y > -math.inf else x
        for j in range(i + 1, min(n, i + longest) + 1):
            p = get(text[i:j])
            if p is not None:
                x, y = a + p, alpha[j]
                alpha[j] = x if y == -math.inf else (x + log1p(exp(y - x)) if x > y else y + log1p(exp(x - y)))
    return alpha[n]


def chunk_words(docs: DataFrame, model_path: str, chunk_bytes: int) -> DataFrame:
    """Rows of three kinds per chunk: words, piece counts, documents."""
    kind = ("chunk bigint, word string, local int, n bigint, piece int, "
            "doc_ids array<bigint>, held binary, lengths binary, ids binary")
    names = ("chunk", "word", "local", "n", "piece", "doc_ids", "held", "lengths", "ids")
    types = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())

    def rows(k: int, **given) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [given[c].cast(t) if c in given else pa.nulls(k, t) for c, t in zip(names, types)], names=list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, part, no = processor(model_path), TaskContext.get().partitionId(), 0
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            offs_all = T.text_buffer(b["text"])[1]
            for lo, hi in T.row_blocks(offs_all, chunk_bytes):
                chunk, no = (part << 32) + no, no + 1
                own = b.slice(lo, hi - lo)
                data, offs = T.text_buffer(own["text"])
                starts, ends = T.word_spans(data, offs, T.NOT_SPACE)
                hashes = T.span_hashes(data, starts, ends)
                _, first, local = np.unique(hashes, return_index=True, return_inverse=True)
                lengths = np.diff(np.searchsorted(starts, offs)).astype(np.int64)
                held = own["held_out"].to_numpy(zero_copy_only=False).astype(bool)
                train = np.bincount(local[np.repeat(~held, lengths)], minlength=len(first)).astype(np.int64)
                # Frequent words get small numbers: their upper bytes vanish.
                order = np.argsort(-np.bincount(local, minlength=len(first)), kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                raw = data.tobytes()
                words = [raw[s:e].decode().translate(_LOWER) for s, e in zip(starts[first[order]].tolist(), ends[first[order]].tolist())]
                train = train[order]
                counts: dict[int, int] = {}
                for k in range(0, len(words), 1 << 14):
                    for ids, n in zip(sp.encode(words[k: k + (1 << 14)], num_threads=1), train[k: k + (1 << 14)].tolist()):
                        if n:
                            for i in ids:
                                counts[i] = counts.get(i, 0) + n
                for k in range(0, len(words), 1 << 16):
                    m = len(words[k: k + (1 << 16)])
                    yield rows(m, chunk=pa.array(np.full(m, chunk)), word=pa.array(words[k: k + m], pa.string()),
                               local=pa.array(np.arange(k, k + m)), n=pa.array(train[k: k + m]))
                if counts:
                    yield rows(len(counts), piece=pa.array(list(counts)), n=pa.array(list(counts.values())))
                planes = place[local].astype("<u4").view(np.uint8).reshape(-1, 4).T
                yield rows(1, chunk=pa.array([chunk]), doc_ids=pa.array([own["doc_id"].to_pylist()], types[5]),
                           held=pa.array([held.tobytes()], pa.binary()), lengths=pa.array([lengths.tobytes()], pa.binary()),
                           ids=pa.array([pack.compress(np.ascontiguousarray(planes).tobytes())], pa.binary()))

    return docs.mapInArrow(T.freed(run), kind)


_LOWER = {i: i + 32 for i in range(0x41, 0x5B)}


def score_documents(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                    folds: int = 10, chunk_bytes: int = 8 << 20) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    rows = only(docs, id_col, text_col).select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
        (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == 0).alias("held_out"))
    chunks = materialize(chunk_words(rows, model_path, chunk_bytes), "chunks")

    counts = {r.piece: r.n for r in chunks.where("piece is not null").groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    ends = rows.agg(F.count_if(~F.col("held_out"))).first()[0]
    pieces, bytes_, end_log = piece_table(model_path, counts, ends)
    longest = max(map(len, pieces))

    # Every distinct word once: its total count and its lattice probability.
    words = chunks.where("word is not null").select("word", "chunk", "local", "n")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            logs = [marginal(w, pieces, bytes_, longest) for w in b["word"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["word"], b["c"], pa.array(logs, pa.float64())], names=["word", "c", "log"])

    totals = words.groupBy("word").agg(F.sum("n").alias("c"))
    weighed = materialize(totals.mapInArrow(T.freed(weigh), "word string, c bigint, log double"), "words")
    seen = weighed.agg(F.count_if(F.col("c") > 0).alias("v"), F.sum("c").alias("n")).first()
    train_tokens, types = (seen.n or 0) + ends, (seen.v or 0) + (1 if ends else 0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One row per chunk in the batch, its words as packed arrays.
        for b in batches:
            if not b.num_rows:
                continue
            chunk, local, c, log = (b[n].to_numpy() for n in ("chunk", "local", "c", "log"))
            by = np.argsort(chunk, kind="stable")
            cuts = np.flatnonzero(np.concatenate(([True], np.diff(chunk[by]) != 0)))
            parts = np.split(by, cuts[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk[by[cuts]]), *(pa.array([x[k].tobytes() for k in parts], pa.binary()) for x in (local, c, log))],
                names=["chunk", "locals", "cs", "logs"])

    # The words return to their chunks; a frequent word's rows are a hot key of
    # this join only, which adaptive execution may split.
    returned = materialize(words.join(weighed, "word").select("chunk", "local", "c", "log").mapInArrow(
        T.freed(pack), "chunk bigint, locals binary, cs binary, logs binary"), "returned")
    floor = train_tokens + 0.1 * (types + 1)
    log_end = math.log10((ends + 0.1) / floor)

    both = returned.unionByName(
        chunks.where("ids is not null").select("chunk", "doc_ids", "held", "lengths", "ids"), allowMissingColumns=True)
    # Words first, then the chunk's documents.
    both = both.withColumn("last", F.col("ids").isNotNull()).repartition("chunk").sortWithinPartitions("chunk", "last")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        for b in batches:
            for k, last in enumerate(b["last"].to_pylist()):
                if last:
                    yield documents({n: b[n][k].as_py() for n in ("doc_ids", "held", "lengths", "ids")}, parts)
                    parts = []
                else:
                    parts.append((np.frombuffer(b["locals"][k].as_py(), np.int32),
                                  np.frombuffer(b["cs"][k].as_py(), np.int64), np.frombuffer(b["logs"][k].as_py())))

    def documents(row: dict, parts: list[tuple]) -> pa.RecordBatch:
        size = sum(len(x[0]) for x in parts)
        c, log_p = np.zeros(size, np.int64), np.zeros(size)
        for local, own_c, own_log in parts:
            c[local], log_p[local] = own_c, own_log
        base = np.log10((c + 0.1) / floor)
        lengths = np.frombuffer(row["lengths"], np.int64)
        raw = zstandard.ZstdDecompressor().decompress(row["ids"], max_output_size=max(1, int(lengths.sum()) * 4))
        ids = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()

        def per_doc(values: np.ndarray) -> np.ndarray:
            out = np.zeros(len(lengths), values.dtype)
            full = lengths > 0
            if full.any():
                out[full] = np.add.reduceat(values[ids], (np.cumsum(lengths) - lengths)[full])
            return out

        n = len(lengths)
        return pa.RecordBatch.from_arrays(
            [pa.array(row["doc_ids"], pa.int64()), pa.array(np.frombuffer(row["held"], bool)), pa.array(lengths + 1),
             pa.array(per_doc((c > 0).astype(np.int64)) + (1 if ends else 0)), pa.array(np.full(n, train_tokens, np.int64)),
             pa.array(per_doc(base) + log_end), pa.array((per_doc(log_p) + end_log) / math.log(10))],
            names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return both.mapInArrow(T.freed(add_up), f"`{id_col}` bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                                   "train_tokens bigint, base_score double, score double")
