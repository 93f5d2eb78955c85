"""Benchmark decontamination with one FM-index per shard of documents.

A benchmark window is ``width`` consecutive words of an item (an item of
fewer words is one window).  Each Spark task gathers documents into shards of
a bounded number of words, writes them as symbols of the benchmark's
vocabulary (a word outside it ends a run, and a run shorter than the shortest
window cannot hold one), builds an FM-index over the runs, searches all
windows backwards at once, locates their occurrences from sampled suffix
positions and merges them into removal spans per document.

The benchmark is a stated query set: it goes to the tasks in blocks of at
most ``block_words`` words, one pass over the documents per block, so what a
task is sent is bounded whatever the benchmark's size.

A word is a run of letters a-z (A-Z folded), digits and non-ASCII characters.
Null or empty texts have no words and no hits; null ids, tied ids and repeated
rows give one result row per input row.  Repeated items are searched once and
all their ids reported.  An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import textops as T
from salesmart.llm.fm_index import FMIndex
from salesmart.llm.tables import only


def hashed_words(texts: pa.Array):
    """(data, offsets, starts, ends, hashes, first word of each row)."""
    data, offs = T.text_buffer(texts)
    starts, ends = T.word_spans(data, offs, T.ALNUM)
    return data, offs, starts, ends, T.span_hashes(data, starts, ends), np.searchsorted(starts, offs)


class Phrases:
    """Windows of a block of items as rows of vocabulary symbols."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        _, _, _, _, words, rows = hashed_words(pa.array([t for _, t in items], pa.string()))
        self.vocabulary = np.unique(words)
        symbols = np.searchsorted(self.vocabulary, words) + 1
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for k, (item, _) in enumerate(items):
            own = symbols[rows[k]: rows[k + 1]].tolist()
            for i in range(max(1, len(own) - width + 1) if own else 0):
                owners[tuple(own[i: i + width])].add(item)
        windows = sorted(owners)
        self.owners = [sorted(owners[w]) for w in windows]
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.rows = np.zeros((len(windows), width), np.int64)
        for i, w in enumerate(windows):
            self.rows[i, : len(w)] = w
        self.shortest = int(self.lengths.min()) if windows else 0


def search_shard(phrases: Phrases, words: np.ndarray, rows: np.ndarray, step: int):
    """Occurrences in one shard: (window numbers, word positions)."""
    none = np.zeros(0, np.int64)
    if not phrases.shortest or not len(words):
        return none, none
    at = np.searchsorted(phrases.vocabulary, words)
    at[at == len(phrases.vocabulary)] = 0
    known = phrases.vocabulary[at] == words
    begin = known.copy()
    begin[1:] &= ~known[:-1]
    edges = rows[(rows > 0) & (rows < len(words))]
    begin[edges] = known[edges]
    end = known.copy()
    end[:-1] &= ~known[1:]
    end[edges - 1] = known[edges - 1]
    starts, sizes = np.flatnonzero(begin), np.flatnonzero(end) + 1
    sizes = sizes - starts
    long = sizes >= phrases.shortest
    starts, sizes = starts[long], sizes[long]
    if not len(starts):
        return none, none
    # Each run with the place of its terminator after it.
    places = T.concat_ranges(starts, sizes + 1)
    text = at[np.minimum(places, len(words) - 1)] + 1
    text[np.cumsum(sizes + 1) - 1] = 0
    index = FMIndex(text, len(phrases.vocabulary), step)
    lo, hi = index.search(phrases.rows, phrases.lengths)
    found = np.flatnonzero(hi > lo)
    n = (hi - lo)[found]
    return np.repeat(found, n), places[index.locate(T.concat_ranges(lo[found], n))]


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, touching ones joined."""
    by = np.argsort(starts, kind="stable")
    starts, ends = starts[by], np.maximum.accumulate(ends[by])
    first = np.concatenate(([True], starts[1:] > ends[:-1]))
    return starts[first], ends[np.concatenate((first[1:], [True]))]


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int):
    """Lists of (item_id, text) of at most ``block_words`` words (one item at
    least), in item order; one block at a time reaches the driver."""
    items = only(benchmark, item_col, text_col).select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    block: list[tuple[str, str]] = []
    size = 0
    for r in items.orderBy("item", "text").toLocalIterator():
        n = len(r.text) // 2 + 1
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((r.item, r.text))
        size += n
    if block:
        yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", width: int = 13, shard_words: int = 1 << 20,
                       block_words: int = 1 << 21, sample_step: int = 16,
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, n_words, n_hit, items, spans, byte_spans) per document.

    ``spans`` are merged [first, last + 1) word ranges, ``byte_spans`` the
    same in bytes of the UTF-8 text, ``items`` the sorted ids of the items
    with occurring windows, as strings.
    """
    rows = only(docs, id_col, text_col, *[k for k in keep if k not in (id_col, text_col)])
    names = [n for n in rows.columns if n == id_col or n in keep]
    types = dict(rows.dtypes)
    span = "array<struct<first:bigint,last:bigint>>"
    extra = {"n_words": "bigint", "n_hit": "bigint", "items": "array<string>", "spans": span, "byte_spans": span}
    pair = pa.struct([("first", pa.int64()), ("last", pa.int64())])
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pair), pa.list_(pair)]

    def one_block(frame: DataFrame, items: list[tuple[str, str]], carry: list[str]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = Phrases(items, width)
            for b in batches:
                data_offs = T.text_buffer(b[text_col])[1]
                for lo, hi in T.row_blocks(data_offs, shard_words * 6):
                    yield shard(b.slice(lo, hi - lo), phrases)

        def shard(b: pa.RecordBatch, phrases: Phrases) -> pa.RecordBatch:
            _, offs, starts, ends, words, first = hashed_words(b[text_col])
            which, at = search_shard(phrases, words, first, sample_step)
            found: dict[int, list] = {}
            owner = np.searchsorted(first, at, side="right") - 1
            by = np.lexsort((at, owner))
            which, at, owner = which[by], at[by], owner[by]
            cut = np.flatnonzero(np.concatenate(([True], np.diff(owner) != 0))) if len(owner) else []
            for i, j in zip(cut, [*cut[1:], len(owner)]):
                k = int(owner[i])
                a, z = merged(at[i:j], at[i:j] + phrases.lengths[which[i:j]])
                ids = sorted({x for w in np.unique(which[i:j]).tolist() for x in phrases.owners[w]})
                s, e = starts[a] - offs[k], ends[z - 1] - offs[k]
                found[k] = [int((z - a).sum()), ids,
                            [{"first": int(x - first[k]), "last": int(y - first[k])} for x, y in zip(a, z)],
                            [{"first": int(x), "last": int(y)} for x, y in zip(s, e)]]
            empty = [0, [], [], []]
            cells = [found.get(k, empty) for k in range(b.num_rows)]
            cols = [pa.array(np.diff(first)), *(pa.array([c[j] for c in cells], t) for j, t in enumerate(kinds[1:]))]
            return pa.RecordBatch.from_arrays([*(b[n] for n in carry), *cols], names=[*carry, *extra])

        return frame.mapInArrow(T.freed(run), ", ".join(f"`{n}` {t}" for n, t in ({n: dict(frame.dtypes)[n] for n in carry} | extra).items()))

    blocks = benchmark_blocks(benchmark, item_col, item_text_col, block_words)
    head = next(blocks, [])
    second = next(blocks, None)
    if second is None:
        return one_block(rows, head, names)
    # Several blocks: per-block results meet by row (id, text digest); spans are merged.
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    keyed = rows.withColumn("row_key", digest)
    part = one_block(keyed, head, [id_col, "row_key"])
    while second is not None:
        part = part.unionByName(one_block(keyed, second, [id_col, "row_key"]))
        second = next(blocks, None)

    def union(name: str):
        ordered = F.array_sort(F.array_distinct(F.flatten(F.collect_list(name))))
        step = ("aggregate({0}, cast(array() as array<struct<first:bigint,last:bigint>>), (acc, x) -> "
                "if(size(acc) > 0 and x.first <= element_at(acc, -1).last, "
                "concat(slice(acc, 1, size(acc) - 1), array(named_struct('first', element_at(acc, -1).first, "
                "'last', greatest(element_at(acc, -1).last, x.last)))), concat(acc, array(x))))")
        return ordered, step

    spans, step = union("spans")
    byte_spans, _ = union("byte_spans")
    grouped = part.groupBy(F.col(id_col).alias("gid"), F.col("row_key").alias("gkey")).agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        spans.alias("s"), byte_spans.alias("bs"))
    grouped = grouped.withColumn("spans", F.expr(step.format("s"))).withColumn("byte_spans", F.expr(step.format("bs")))
    grouped = grouped.withColumn("n_hit", F.expr("aggregate(spans, 0L, (acc, x) -> acc + x.last - x.first)"))
    return keyed.join(grouped, F.col(id_col).eqNullSafe(F.col("gid")) & (F.col("row_key") == F.col("gkey"))).select(
        *[F.col(f"`{n}`") for n in names], *extra)
