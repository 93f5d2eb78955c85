"""Byte-level BPE encoding and decoding with an existing rank file.

Every text is cut into overlapping chunks that are pre-tokenised one by one.
The chunks are stitched at the first pre-token boundary that both neighbours
have in their overlap, and the pieces between those points are encoded.  Where
an overlap has no common boundary (a run of one class longer than the overlap)
the next chunk is pre-tokenised again from the last sure boundary, so the ids
are those of the whole text in every case.

Chunks of a text of at most ``spread_chars`` characters stay in the task that
read it: nothing is shuffled.  Chunks of a longer one are rows that all tasks
share, and meet again by document.  Both ways run the same steps.

Null texts count as empty: no ids.  Null ids, repeated rows and tied ids stay
as they are, one result row per input row; a long text that stands in several
rows of one id is encoded once.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import textops as T
from salesmart.llm.tables import only

#: Text bytes that a task turns into ids before it passes them on.
BLOCK_BYTES = 1 << 22


@lru_cache(maxsize=4)
def encoder(ranks_path: str, pattern: str):
    """The encoding of a rank file, read once per Python worker."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(ranks_path: str, pattern: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens by id, one after another, with their starts and
    lengths (-1: no such id)."""
    enc = encoder(ranks_path, pattern)
    raw = {enc.encode_single_token(t): t for t in enc.token_byte_values()}
    sizes = np.array([len(raw[i]) if i in raw else -1 for i in range(max(raw) + 1)], np.int64)
    return np.frombuffer(b"".join(raw[i] for i in sorted(raw)), np.uint8), np.cumsum(sizes.clip(0)) - sizes.clip(0), sizes


def boundaries(text: str, pattern: str) -> np.ndarray:
    """Starts of the pre-tokens of ``text`` (the pattern's matches leave no
    character out)."""
    import regex

    sizes = np.fromiter(map(len, regex.findall(pattern, text)), np.int64)
    return np.cumsum(sizes) - sizes


def sync_points(starts: list[int], texts: list[str], found: list[np.ndarray], pattern: str) -> list[int]:
    """Positions at which the document may be cut into pieces.

    ``found`` holds the chunks' boundaries as positions in the document.  A
    cut needs a boundary of both chunks, past a character that is no white
    space (a piece that ends in white space would merge it differently).
    """
    starts, texts = list(starts), list(texts)
    cuts, sure = [0], found[0]
    for i in range(len(texts) - 1):
        end, begin, right = starts[i] + len(texts[i]), starts[i + 1], found[i + 1]
        mine = sure[np.searchsorted(sure, max(begin, cuts[-1]), "right"): np.searchsorted(sure, end)].tolist()
        both = set(right[: np.searchsorted(right, end)].tolist())
        common = next((p for p in mine if p in both and not texts[i][p - starts[i] - 1].isspace()), None)
        if common is not None:
            cuts.append(common)
            sure = right[np.searchsorted(right, common):]
        else:
            last = int(sure[np.searchsorted(sure, end) - 1])
            head = texts[i][last - starts[i]: begin - starts[i]] if last < begin else ""
            text = head + (texts[i + 1] if last < begin else texts[i + 1][last - begin:])
            sure = boundaries(text, pattern) + last
            if last < begin:
                starts[i + 1], texts[i + 1] = last, text
    return cuts


def piece_ids(enc, text: str, cuts: list[int]) -> np.ndarray:
    """Token ids of the pieces of ``text`` that begin at ``cuts``."""
    parts = [enc.encode_to_numpy(text[a:b], disallowed_special=()) for a, b in zip(cuts, [*cuts[1:], len(text)])]
    return np.concatenate(parts).astype(np.int32)


def stitched_ids(enc, text: str, pattern: str, chunk_chars: int, overlap: int) -> np.ndarray:
    """Token ids of a text by way of its chunks, in one task.  Chunk ``i``
    reaches ``overlap`` characters beyond its share on both sides."""
    starts = [max(0, at - overlap) for at in range(0, max(len(text), 1), chunk_chars)]
    if len(starts) == 1:  # one chunk has no neighbour to meet
        return piece_ids(enc, text, [0])
    texts = [text[s: (i + 1) * chunk_chars + overlap] for i, s in enumerate(starts)]
    found = [boundaries(t, pattern) + s for t, s in zip(texts, starts)]
    return piece_ids(enc, text, sync_points(starts, texts, found, pattern))


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id",
           text_col: str = "text", chunk_chars: int = 1 << 11, overlap: int = 1 << 7,
           spread_chars: int = 1 << 17) -> DataFrame:
    """(id, n_tokens, ids): token ids of every whole text."""
    rows = only(docs, id_col, text_col).withColumnRenamed(text_col, "text")
    size = F.length(F.coalesce("text", F.lit("")))
    id_type = dict(rows.dtypes)[id_col]
    out = f"`{id_col}` {id_type}, n_tokens bigint, ids array<int>"

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks_path, pattern)
        for b in batches:
            for lo, hi in T.row_blocks(T.text_buffer(b.column(1))[1], BLOCK_BYTES):
                part = b.slice(lo, hi - lo)
                ids = [stitched_ids(enc, t.as_py() or "", pattern, chunk_chars, overlap) for t in part.column(1)]
                n = np.fromiter(map(len, ids), np.int64, len(ids))
                offs = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(ids)))],
                    names=[id_col, "n_tokens", "ids"])

    near = rows.where(size <= spread_chars).mapInArrow(T.freed(here), out)

    # Long texts: larger chunks, as each is a row of a shuffle.
    share, reach = max(chunk_chars, spread_chars // 4), max(overlap, spread_chars // 128)
    chunks = (
        rows.where(size > spread_chars)
        .withColumn(id_col, F.col(id_col).cast("string"))  # pandas would make longs with nulls floats
        .withColumn("digest", F.sha2("text", 256))
        .groupBy(id_col, "digest").agg(F.any_value("text").alias("text"), F.count(F.lit(1)).alias("times"))
        .withColumn("no", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / share).cast("int"))))
        .withColumn("start", F.greatest(F.lit(0), F.col("no") * share - reach))
        .withColumn("text", F.substring("text", F.col("start") + 1, (F.col("no") + 1) * share + reach - F.col("start")))
        .repartition(F.col(id_col), "digest", "no")
    )

    def pretokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["found"] = [(boundaries(t, pattern) + s).astype(np.int64).tobytes()
                            for t, s in zip(pdf["text"], pdf["start"])]
            yield pdf[[id_col, "digest", "times", "no", "start", "text", "found"]]

    cut = chunks.mapInPandas(
        pretokenise, f"`{id_col}` string, digest string, times bigint, no int, start int, text string, found binary")

    def stitch(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("no")
        starts, texts = pdf["start"].astype(int).tolist(), pdf["text"].tolist()
        parts, end = [], 0
        for s, t in zip(starts, texts):
            parts.append(t[end - s:])
            end = s + len(t)
        text = "".join(parts)
        found = [np.frombuffer(x, np.int64) for x in pdf["found"]]
        ids = piece_ids(encoder(ranks_path, pattern), text, sync_points(starts, texts, found, pattern))
        return pd.DataFrame({id_col: [pdf[id_col].iloc[0]], "n_tokens": [len(ids)], "ids": [ids],
                             "times": [pdf["times"].iloc[0]]})

    far = (cut.groupBy(id_col, "digest")
           .applyInPandas(stitch, f"`{id_col}` string, n_tokens bigint, ids array<int>, times bigint")
           .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
           .select(F.col(id_col).cast(id_type).alias(id_col), "n_tokens", "ids"))
    return near.unionByName(far)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, *, ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for, concatenated (null ids: empty)."""
    names, types = list(encoded.columns), dict(encoded.dtypes)
    schema = ", ".join(f"`{n}` {types[n]}" for n in names) + f", `{out_col}` binary"
    at = names.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blob, starts, lengths = token_bytes(ranks_path, pattern)
        for b in batches:
            sizes = b.column(at).value_lengths().fill_null(0).to_numpy()
            for lo, hi in T.row_blocks(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))), BLOCK_BYTES // 4):
                part = b.slice(lo, hi - lo)
                ids = part.column(at).flatten().to_numpy(zero_copy_only=False)
                n = lengths[ids]
                if len(n) and (n.min() < 0 or ids.min() < 0):
                    raise ValueError("an id that the ranks do not have")
                raw = blob[T.concat_ranges(starts[ids], n)]
                ends = np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum(sizes[lo:hi], dtype=np.int64)))]
                decoded = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(ends), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([*part.columns, decoded.cast(pa.binary())], names=[*names, out_col])

    return encoded.mapInArrow(T.freed(run), schema)
