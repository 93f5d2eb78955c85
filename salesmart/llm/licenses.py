"""License scans: exact phrases, and short notices found with bounded errors.

Every text is reduced to its words joined by single spaces.  A notice of n
characters that occurs with at most k edits has one of k + 1 pieces intact
(pigeonhole), so an Aho-Corasick pass over all pieces gives candidate places;
around each, the regex library's bounded-error matching verifies the edits and
gives the span, reported in words.

Null or empty texts have no words, labels or spans.  Null ids, ties and
repeated rows stay, one result row per input row.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesmart.llm.tables import only
from salesmart.llm.textops import freed

#: Exact phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Wordings that the licenses themselves prescribe, as words without marks.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "under the terms of the gnu general public license as published by"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("cc", "licensed under a creative commons attribution"),
    ("unlicense", "free and unencumbered software released into the public domain"),
]

_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def normal(text: str | None) -> bytes:
    return b" ".join((text or "").encode().translate(_WORDS).split())


@lru_cache(maxsize=8)
def matcher(notices: tuple[tuple[str, str], ...], rate: float):
    """Automaton over the pieces, and each notice's pattern and error bound."""
    import ahocorasick
    import regex

    pieces: dict[str, list[tuple[int, int]]] = {}
    patterns = []
    for i, (_, text) in enumerate(notices):
        k = max(1, int(len(text) * rate))
        cuts = [len(text) * j // (k + 1) for j in range(k + 2)]
        for a, b in zip(cuts, cuts[1:]):
            pieces.setdefault(text[a:b], []).append((i, a))
        patterns.append((regex.compile(f"(?b)(?:{regex.escape(text, literal_spaces=True)}){{e<={k}}}"), k))
    seeds = ahocorasick.Automaton()
    for piece, places in pieces.items():
        seeds.add_word(piece, (len(piece), places))
    seeds.make_automaton()
    return seeds, patterns


def phrase_places(text: bytes, phrase: bytes) -> list[int]:
    """Character starts of ``phrase`` between word ends in ``text``, which
    begins and ends with a space."""
    out, needle = [], b" " + phrase + b" "
    at = text.find(needle)
    while at >= 0:
        out.append(at)
        at = text.find(needle, at + 1)
    return out


def fuzzy_matches(text: str, notices: tuple[tuple[str, str], ...], rate: float) -> list[tuple[int, int, int, int]]:
    """(notice, start, end, errors) in characters, without repeats."""
    seeds, patterns = matcher(notices, rate)
    windows: dict[int, list[tuple[int, int]]] = {}
    for last, (size, places) in seeds.iter(text):
        start = last - size + 1
        for i, offset in places:
            k = patterns[i][1]
            lo = max(0, start - offset - k)
            windows.setdefault(i, []).append((lo, start - offset + len(notices[i][1]) + k))
    out = []
    for i, spans in windows.items():
        size, k = len(notices[i][1]), patterns[i][1]
        # Seeds of one place lie within k of each other: one search for them,
        # in a window too short for a second notice.
        found: set[tuple[int, int, int]] = set()
        first = upto = None
        for lo, hi in [*sorted(set(spans)), (len(text) + k + 1, 0)]:
            if first is not None and lo > first + k:
                m = patterns[i][0].search(text, first, min(upto, len(text)))
                if m:
                    found.add((sum(m.fuzzy_counts), m.start(), m.end()))
                first = None
            if first is None:
                first = upto = lo
            upto = max(upto, hi)
        # The best ones first; what overlaps a better one is no match.
        starts: list[int] = []
        ends: dict[int, int] = {}
        for errors, start, end in sorted(found):
            at = bisect_left(starts, start)
            if (at and ends[starts[at - 1]] > start) or (at < len(starts) and starts[at] < end):
                continue
            starts.insert(at, start)
            ends[start] = end
            out.append((i, start, end, errors))
    return sorted(out, key=lambda x: (x[1], x[0]))


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  notices: list[tuple[str, str]] | None = None, rate: float = 0.08) -> DataFrame:
    """(id, n_words, phrases, notices, base_labels, labels, score).

    ``phrases`` / ``notices`` list (label, first_word, last_word, errors);
    ``rate`` is the share of a notice's characters that may be edited; the
    score is 1 for an exact phrase, else 1 - errors / length of the best
    notice, else 0.
    """
    known = tuple(notices if notices is not None else NOTICES)
    rows = only(docs, id_col, text_col)
    place = "array<struct<label:string,first_word:bigint,last_word:bigint,errors:int>>"
    schema = (f"`{id_col}` {dict(rows.dtypes)[id_col]}, n_words bigint, phrases {place}, notices {place}, "
              "base_labels array<string>, labels array<string>, score double")
    kind = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("errors", pa.int32())])
    types = [pa.int64(), pa.list_(kind), pa.list_(kind), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64()]

    def scan(text: str | None) -> tuple:
        words = normal(text)
        if not words:
            return 0, [], [], [], [], 0.0
        closed = b" " + words + b" "
        places = [(at, phrase, label) for phrase, label in PHRASES.items()
                  for at in phrase_places(closed, phrase.encode())]
        exact, fuzzy = [], []
        if places:
            # Word numbers: the spaces before a place, found once per text.
            spaces = np.flatnonzero(np.frombuffer(closed, np.uint8) == 0x20)
            for (_, phrase, label), first in zip(places, np.searchsorted(spaces, [x[0] for x in places]).tolist()):
                exact.append({"label": label, "first_word": first, "last_word": first + phrase.count(" "), "errors": 0})
        exact.sort(key=lambda x: (x["first_word"], x["label"]))
        plain, best = words.decode(), 1.0 if exact else 0.0
        matches = fuzzy_matches(plain, known, rate)
        if matches:
            spaces = np.flatnonzero(np.frombuffer(plain.encode("utf-32-le"), np.uint32) == 0x20)
            firsts = np.searchsorted(spaces, [m[1] for m in matches]).tolist()
            lasts = np.searchsorted(spaces, [m[2] for m in matches]).tolist()
            for (i, _, _, errors), first, last in zip(matches, firsts, lasts):
                fuzzy.append({"label": known[i][0], "first_word": first, "last_word": last, "errors": errors})
                best = max(best, 1 - errors / len(known[i][1]))
        base = sorted({x["label"] for x in exact})
        return (words.count(b" ") + 1, exact, fuzzy, base, sorted({*base, *(x["label"] for x in fuzzy)}), best)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [scan(t.as_py()) for t in b[text_col]]
            cols = [pa.array([f[j] for f in found], t) for j, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays(
                [b[id_col], *cols], names=[id_col, "n_words", "phrases", "notices", "base_labels", "labels", "score"])

    return rows.mapInArrow(freed(run), schema)
