"""Ranked lexical search with bag deduplication.

All documents are ranked for each item of a stated query set:

1. every document is restricted to the items' vocabulary: its vector holds
   (term, occurrences) pairs of that vocabulary, and its length n counts all
   of its terms;
2. documents with equal vector and equal length factor m form a class; rows
   are dealt by the vector's hash and grouped by the vector itself, so equal
   hashes of unequal vectors never meet in a class;
3. a class is scored once, against all items (exact 64-bit integers);
4. its members are expanded by ascending doc_id.  A class keeps its ``k``
   smallest members only: no later one can stand among the best ``k`` of an
   item.  The window cuts a class to ``k`` rows before the shuffle, so a class
   of a third of all documents is as cheap as any other.

Score: sum over the item's terms, repeats included, of
``w * ((1000000000*tf) div (1000*tf + 8*m))`` with
``w = floor(1000*ln((2*N+2)/(2*df+1)))`` and
``m = 100-75 + ((75*n*N) div L)``; N documents with a term, L their terms.

Defined results: documents with null or empty text have no term and no score;
repeated rows are documents of their own; a null doc_id sorts last; rows under
one item_id are one item; an item without terms, or without a document above
0, has no row; other columns of the inputs are not read.  Words are identified
by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.tables import only
from salesmart.llm.textops import ALNUM, concat_ranges, freed, row_blocks, span_hashes, text_buffer, word_spans
from salesmart.session import materialize

#: Item terms that are searched for at once.  More items are searched in
#: several passes over the documents, each over a block of whole items.
BLOCK_TERMS = 1 << 21
#: (class, item) products of one step inside a task.
STEP = 1 << 21


def _words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row of each word, hash of each word) by blocks."""
    data, offsets = text_buffer(column)
    for lo, hi in row_blocks(offsets):
        part, at = data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        starts, ends = word_spans(part, at, ALNUM)
        rows = np.searchsorted(at, starts, side="right") - 1
        yield lo, hi, rows, span_hashes(part, starts, ends)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, n): occurrences of each term hash in each item."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, rows, hashes in _words(b["text"]):
                order = np.lexsort((hashes, rows))
                rows, hashes = rows[order], hashes[order]
                new = np.ones(len(rows), bool)
                new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
                at = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays(
                    [b["item_id"].take(pa.array(rows[at] + lo)), pa.array(hashes[at].view(np.int64)),
                     pa.array(np.diff(np.append(at, len(rows))))], names=["item_id", "term", "n"])

    kind = items.schema["item_id"].dataType.simpleString()
    found = only(items, "item_id", "text").mapInArrow(freed(count), f"item_id {kind}, term long, n long")
    return found.groupBy("item_id", "term").agg(F.sum("n").alias("n"))


def document_vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, vec): terms of the whole document, and its occurrences of
    the vocabulary (a broadcast ascending array of hashes) as pairs of 32-bit
    numbers (position in the vocabulary, occurrences), by ascending position."""
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary.value
        for b in batches:
            for lo, hi, rows, hashes in _words(b["text"]):
                place = np.searchsorted(vocab, hashes)
                place[place == len(vocab)] = 0
                known = vocab[place] == hashes
                keys, times = np.unique(rows[known] * len(vocab) + place[known], return_counts=True)
                pairs = np.empty((len(keys), 2), np.int32)
                pairs[:, 0], pairs[:, 1] = keys % len(vocab), times
                ends = np.searchsorted(keys, np.arange(hi - lo + 1) * len(vocab)) * 8
                vec = pa.Array.from_buffers(pa.binary(), hi - lo, [
                    None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(pairs.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [b["doc_id"].slice(lo, hi - lo), pa.array(np.bincount(rows, minlength=hi - lo)), vec],
                    names=["doc_id", "n", "vec"])

    return only(docs, "doc_id", "text").mapInArrow(freed(vectors), "doc_id long, n long, vec binary")


def _pairs(vec: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The (term, occurrences) pairs of all rows, and the rows' offsets in them."""
    _, offsets, data = vec.buffers()
    at = np.frombuffer(offsets, np.int32)[vec.offset: vec.offset + len(vec) + 1].astype(np.int64) // 8
    pairs = np.frombuffer(data, np.int32).reshape(-1, 2) if data is not None else np.zeros((0, 2), np.int32)
    return pairs[at[0]: at[-1]], at - at[0]


def document_frequencies(vectors: DataFrame, size: int) -> DataFrame:
    """(term, df) over all rows, added up inside each task first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(_pairs(b["vec"])[0][:, 0], minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["term", "df"])

    return vectors.select("vec").mapInArrow(freed(count), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def bag_classes(vectors: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(vec, m, members): classes of equal vector and m, each with its ``k``
    smallest doc_ids."""
    m = F.expr(f"100 - 75 + ((75L * n * {n_docs}L) div {n_terms}L)")
    bags = vectors.where("length(vec) > 0").select(F.xxhash64("vec").alias("h"), "vec", m.alias("m"), "doc_id")
    # Null ids stand last; inside a struct they are collected like others.
    order = Window.partitionBy("h", "vec", "m").orderBy(F.col("doc_id").asc_nulls_last())
    first = bags.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return first.groupBy("h", "vec", "m").agg(F.collect_list(F.struct("doc_id")).alias("members")).drop("h")


def _sums(keys: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Exact 64-bit sums by key: both halves are added as doubles below 2^53."""
    high = np.bincount(keys, weights=values >> 26, minlength=size)
    low = np.bincount(keys, weights=values & ((1 << 26) - 1), minlength=size)
    return (high.astype(np.int64) << 26) + low.astype(np.int64)


def score_classes(classes: DataFrame, query, k: int) -> DataFrame:
    """(item, doc_id, score): the best ``k`` of each task's classes per item.

    ``query`` is a broadcast (term weights, offsets of the terms' postings,
    posting items, posting repeats, number of items)."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, posting_at, posting_item, repeats, n_items = query.value
        fan = np.diff(posting_at)
        best: list[list[tuple]] = [[] for _ in range(n_items)]
        least = np.ones(n_items, np.int64)  # scores below cannot enter

        def enter(scores: np.ndarray, members: list) -> None:
            row, item = np.nonzero(scores >= least)
            order = np.argsort(item, kind="stable")
            row, item = row[order], item[order]
            heads = np.flatnonzero(np.append(True, item[1:] != item[:-1])) if len(item) else []
            for lo, hi in zip(heads, [*heads[1:], len(item)]):
                i, rows = int(item[lo]), row[lo:hi]
                points = scores[rows, i]
                smallest = np.array([min(members[r][0], (1 << 63) - 1) for r in rows], np.int64)
                for j in np.lexsort((smallest, -points))[:k]:
                    best[i] += [(-int(points[j]), d) for d in members[rows[j]]]
                best[i] = sorted(best[i])[:k]
                if len(best[i]) == k:
                    least[i] = -best[i][-1][0]

        for b in batches:
            pairs, at = _pairs(b["vec"])
            term, tf = pairs[:, 0], pairs[:, 1].astype(np.int64)
            m = np.repeat(b["m"].to_numpy(), np.diff(at))
            points = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            # A null id stands above all others.
            members = [sorted(float("inf") if d["doc_id"] is None else d["doc_id"] for d in row)
                       for row in b["members"].to_pylist()]
            work = np.append(0, np.cumsum(fan[term]))[at] + np.arange(len(at)) * n_items
            lo = 0
            while lo < len(at) - 1:
                hi = max(lo + 1, int(np.searchsorted(work, work[lo] + STEP, side="right")) - 1)
                here = slice(at[lo], at[hi])
                t = term[here]
                post = concat_ranges(posting_at[t], fan[t])
                rows = np.repeat(np.arange(hi - lo), np.diff(at[lo: hi + 1]))
                keys = np.repeat(rows * n_items, fan[t]) + posting_item[post]
                sums = _sums(keys, np.repeat(points[here], fan[t]) * repeats[post], (hi - lo) * n_items)
                enter(sums.reshape(hi - lo, n_items), members[lo:hi])
                lo = hi
        rows = [(i, None if d == float("inf") else d, -s) for i, kept in enumerate(best) for s, d in kept]
        item, doc, got = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(got, pa.int64())],
            names=["item", "doc_id", "score"])

    return classes.mapInArrow(freed(score), "item long, doc_id long, score long")


def _search_block(docs: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    sc = spark.sparkContext
    table = terms.orderBy("item_id", "term").toArrow()
    ids = table["item_id"].combine_chunks()
    hashes = table["term"].to_numpy().view(np.uint64)
    repeats = table["n"].to_numpy()
    vocab, term = np.unique(hashes, return_inverse=True)
    distinct = ids.unique()
    item = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
    vectors = materialize(document_vectors(docs, sc.broadcast(vocab)), "search-vectors")
    n_docs, n_terms = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    weight = np.zeros(len(vocab), np.int64)
    for row in document_frequencies(vectors, len(vocab)).collect():
        weight[row.term] = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * row.df + 1)))
    order = np.argsort(term, kind="stable")
    posting_at = np.searchsorted(term[order], np.arange(len(vocab) + 1))
    query = sc.broadcast((weight, posting_at, item[order].astype(np.int64), repeats[order], len(distinct)))
    classes = bag_classes(vectors, n_docs or 0, n_terms or 1, k)
    names = spark.createDataFrame(
        pa.table({"item": pa.array(range(len(distinct)), pa.int64()), "item_id": distinct}))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = score_classes(classes, query, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item,
    equal scores by ascending doc_id.

    The item side of one pass (vocabulary and postings) is broadcast; it holds
    at most about ``block_terms`` (item, term) pairs.  More items than that are
    dealt over several passes by a hash of item_id.
    """
    terms = materialize(item_terms(items), "search-items")
    blocks = -(-terms.count() // block_terms)
    found = None
    for i in range(blocks):
        block = terms if blocks == 1 else terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i)
        if blocks > 1 and block.isEmpty():
            continue
        part = _search_block(docs, block, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        kind = items.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return found
