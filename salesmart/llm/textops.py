"""Array helpers over Arrow text columns, used inside Spark tasks.

A text column is one byte buffer plus offsets; words are found and hashed on
that buffer with numpy, so no Python object exists per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_MULT = 0x9E3779B97F4A7C15


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (splitmix finaliser)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=U64) * U64(_MULT) + U64(salt * 7919 + 1))


def freed(run: Callable) -> Callable:
    """``run`` (a function over Arrow batches) that gives its memory back when
    its task ends: Python workers live on between tasks, and what an allocator
    holds counts against the executor."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            _powers.clear()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return whole


def _byte_table() -> np.ndarray:
    t = seeds(256, 1)
    t[ord("A"): ord("Z") + 1] = t[ord("a"): ord("z") + 1]
    return t


_FOLDED = _byte_table()
_PLAIN = seeds(256, 1)
_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True


def powers(base: int, n: int) -> np.ndarray:
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(n, 1 << 16)
        got = np.full(size, base, dtype=U64)
        got[0] = 1
        got = np.cumprod(got, dtype=U64)
        if size <= 1 << 22:
            _powers[base] = got
    return got


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; nulls are empty rows."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offs = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0]: offs[-1]]
    return raw, offs - offs[0]


def row_blocks(offsets: np.ndarray, size: int = 1 << 22):
    """Row ranges of at most ``size`` bytes (a longer row stands alone)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield lo, hi
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """(starts, ends) of the words; no word crosses a row boundary.

    ``offsets`` may begin above 0; positions are relative to ``data``."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    w = is_word[data]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first = w.copy()
    first[1:] &= ~w[:-1]
    first[edge] = w[edge]
    last = w.copy()
    last[:-1] &= ~w[1:]
    last[edge - 1] = w[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, slice_bytes: int = 1 << 20,
                fold: bool = True) -> np.ndarray:
    """64-bit hashes of byte spans (A-Z folded by default); starts and ends
    ascend, spans may overlap.

    A prefix sum of byte values times powers gives every span's polynomial by
    one difference; memory is bounded by ``slice_bytes`` or the longest span.
    """
    out = np.empty(len(starts), U64)
    table = _FOLDED if fold else _PLAIN
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(ends, base + slice_bytes, side="right")))
        seg = data[base: int(ends[hi - 1])]
        p = powers(_BASE, len(seg) + 1)
        q = powers(_BASE_INVERSE, len(seg) + 1)
        sums = np.zeros(len(seg) + 1, U64)
        np.cumsum(table[seg] * p[: len(seg)], out=sums[1:])
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        out[lo:hi] = mix64((sums[e] - sums[s]) * q[s] + (e - s).astype(U64))
        lo = hi
    return out


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every run of ``width`` consecutive word hashes; a shorter
    non-empty sequence is one shingle."""
    if len(words) == 0:
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, U64)
    for j in range(width):
        total = total * U64(_BASE) + words[j: j + n]
    return mix64(total)


def minhash_params(n: int, salt: int = 11) -> tuple[np.ndarray, np.ndarray]:
    return seeds(n, salt) | U64(1), seeds(n, salt + 1)


def concat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, ... for each range, all in one array."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    step = np.ones(total, np.int64)
    keep = lengths > 0
    s, n = starts[keep], lengths[keep]
    heads = np.concatenate(([0], np.cumsum(n)[:-1]))
    step[heads] = s
    step[heads[1:]] -= s[:-1] + n[:-1] - 1
    return np.cumsum(step)
