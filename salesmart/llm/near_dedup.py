"""MinHash near-duplicates by a chosen-path set similarity join.

A document's set is its distinct 5-word shingles.  Equal sets are one record.
Independent trees branch the records by selected minwise values: a tree starts
with two coordinates (one path per record), records with equal values share a
node, and a node of more than ``node_limit`` records branches again by two
coordinates that its path selects.  Small nodes are compared exhaustively on
the 64 minwise values; everything similar enough there is a loose link.  Loose
groups are then verified on full sets.

A large node first compares ``node_limit`` of its records with all that no
link has reached yet, or, where those not reached are fewer than those that
wait for their turn, the former with the latter.  Records that have met all
others are settled and do not branch; of a group of near copies a few reach all
others, and the few strangers among them meet the group, so nothing is left to
branch.

Recall: a pair at similarity s meets in a tree with probability s^2 and is
lost by 6 trees with (1 - s^2)^6, i.e. 0.0005 at 0.85; the loose test at 0.66
on 64 values loses 1 in 100,000 of them.  A node that is still large after
``max_depth`` branchings is compared exhaustively.  A node of more than
``hold_limit`` records (136 bytes each) is not held by a task: its rows are
dealt to parts, every part meets leaders of the node's main group, and what
that group does not reach meets all parts (``settle_hot``).  Only if more than
``node_limit`` records are not reached does such a node branch, at any depth,
and its groups part.  Nothing is dropped.

Texts without words (null, empty) are linked with nothing and kept.  Repeated
rows share a doc_id and its verdict; rows with a null doc_id never lead a
component.  Ties: the smallest doc_id is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import textops as T
from salesmart.llm.set_verify import exact_components
from salesmart.llm.tables import only
from salesmart.session import materialize

U64 = np.uint64
VALUES = 64


def shingle_sets(texts: pa.Array, width: int):
    """The sorted distinct shingle hashes of every text, in order."""
    offs = T.text_buffer(texts)[1]
    for lo, hi in T.row_blocks(offs):
        data, rel = T.text_buffer(texts.slice(lo, hi - lo))
        starts, ends = T.word_spans(data, rel, T.NOT_SPACE)
        words = T.span_hashes(data, starts, ends)
        first = np.searchsorted(starts, rel)
        for a, b in zip(first, first[1:]):
            yield np.unique(T.shingle_hashes(words[a:b], width))


def set_id(hashes: np.ndarray) -> str:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).hexdigest()


def minwise(hashes: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """High 32 bits of the smallest value under each hash function."""
    out = np.full(len(mult), np.iinfo(np.uint64).max, U64)
    for i in range(0, len(hashes), 1024):
        np.minimum(out, (hashes[i: i + 1024][None, :] * mult[:, None] + add[:, None]).min(axis=1), out=out)
    return (out >> U64(32)).astype(np.uint32)


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, values) per row."""
    rows = only(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mult, add = T.minhash_params(VALUES)
        for b in batches:
            n, ids, values = [], [], []
            for s in shingle_sets(b[text_col], width):
                n.append(len(s))
                ids.append(set_id(s) if len(s) else None)
                values.append(minwise(s, mult, add).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b[id_col].cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(values, pa.binary())],
                names=["doc_id", "n_shingles", "set_id", "values"])

    return rows.mapInArrow(T.freed(run), "doc_id bigint, n_shingles bigint, set_id string, values binary")


def start_paths(records: DataFrame, trees: int) -> DataFrame:
    """(node, depth, unit, sketch): one start per record and tree."""
    coords = (T.seeds(trees * 2, 23) % U64(VALUES)).astype(np.int64).reshape(trees, 2)
    coords[:, 1] = np.where(coords[:, 0] == coords[:, 1], (coords[:, 1] + 1) % VALUES, coords[:, 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            values = np.frombuffer(b"".join(b["values"].to_pylist()), np.uint32).reshape(-1, VALUES).astype(U64)
            sketch = pa.array([r.tobytes() for r in values.astype(np.uint16)], pa.binary())
            for t, (i, j) in enumerate(coords):
                node = T.mix64(values[:, i] * U64(0x9E3779B97F4A7C15) + values[:, j] * U64(0xC2B2AE3D27D4EB4F) + U64(t + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.view(np.int64)), pa.array(np.full(len(node), 2, np.int32)), b["unit"], sketch],
                    names=["node", "depth", "unit", "sketch"])

    return records.mapInArrow(T.freed(run), "node bigint, depth int, unit bigint, sketch binary")


def similar_groups(sketches: np.ndarray, least: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Component (index of its first member) of rows that agree in at least
    ``least`` values, by comparing rows reached with all not reached, from
    the side that has fewer rows; and the rows that remain open when ``most``
    rows have been compared: a row that is not open has met, or is linked to,
    every row like it."""
    n = len(sketches)
    label = np.full(n, -1, np.int64)
    met = np.zeros(n, bool)
    rest = np.arange(n)
    done = 0
    for seed in range(n):
        if label[seed] >= 0:
            continue
        if done == most:
            break
        label[seed] = seed
        frontier = np.array([seed])
        rest = rest[rest != seed]
        pool = sketches[rest]
        while len(frontier) and len(rest) and done != most:
            if len(rest) < len(frontier) and (most is None or len(rest) <= most - done):
                # Every row not reached meets the whole frontier; those that
                # are linked to it are the next one.
                edge = sketches[frontier]
                linked = np.array([((edge == x).sum(axis=1) >= least).any() for x in pool])
                met[frontier] = True
                done += len(rest)
                frontier = rest[linked]
            else:
                x, frontier = frontier[-1], frontier[:-1]
                linked = (pool == sketches[x]).sum(axis=1) >= least
                met[x] = True
                done += 1
                if linked.any():
                    frontier = np.append(frontier, rest[linked])
            if linked.any():
                label[rest[linked]] = seed
                rest, pool = rest[~linked], pool[~linked]
        if not len(rest):
            met[:] = True
            break
    label = np.where(label < 0, np.arange(n), label)
    return label, np.flatnonzero(~met)


def branch(node: int, depth: int, units: np.ndarray, sketches: np.ndarray) -> pa.RecordBatch:
    """Children of a large node: two coordinates selected by its path."""
    parts = []
    pick = T.mix64(np.array([node, node], np.int64).view(U64) + np.array([1, 2], U64) * U64(depth + 1))
    coords = [int(pick[0] % U64(VALUES)), int(pick[1] % U64(VALUES - 1))]
    coords[1] += coords[1] >= coords[0]
    for c in coords:
        child = T.mix64(np.uint64(pick[0]) + sketches[:, c].astype(U64) * U64(0x9E3779B97F4A7C15) + U64(c))
        parts.append(child.view(np.int64))
    k = len(units)
    return level_rows(np.concatenate(parts), depth + 1, np.concatenate((units, units)), np.concatenate((sketches, sketches)))


LEVEL = "a bigint, b bigint, node bigint, depth int, unit bigint, sketch binary, part int"


def level_rows(node: np.ndarray, depth: int, units: np.ndarray, sketches: np.ndarray, part: int | None = None) -> pa.RecordBatch:
    """Records of ``LEVEL`` that are no links: children (part null), rows of
    parts of a hot node, or its leaders (part: minus the number of parts)."""
    k = len(units)
    return pa.RecordBatch.from_arrays(
        [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(node), pa.array(np.full(k, depth, np.int32)),
         pa.array(units), pa.array([r.tobytes() for r in sketches], pa.binary()), pa.array([part] * k, pa.int32())],
        names=["a", "b", "node", "depth", "unit", "sketch", "part"])


def to_sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, VALUES)


def node_runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows with equal keys."""
    cuts = np.flatnonzero(np.concatenate(([True], np.any([k[1:] != k[:-1] for k in keys], axis=0))))
    return list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys[0])]))


class HotNode:
    """A node too large to be held: deals its rows to parts in the order of
    the stream and keeps those with the smallest hashes as leaders."""

    def __init__(self, node: int, depth: int, part_rows: int, n_leaders: int):
        self.node, self.depth, self.n = node, depth, 0
        self.part_rows, self.n_leaders = part_rows, n_leaders
        self.units, self.sketches = np.zeros(0, np.int64), np.zeros((0, VALUES), np.uint16)

    def add(self, units: np.ndarray, sketches: np.ndarray) -> Iterator[pa.RecordBatch]:
        at = 0
        while at < len(units):
            part = self.n // self.part_rows
            upto = min(len(units), at + self.part_rows - self.n % self.part_rows)
            yield level_rows(np.full(upto - at, self.node), self.depth, units[at:upto], sketches[at:upto], part)
            self.n += upto - at
            at = upto
        units, sketches = np.concatenate((self.units, units)), np.concatenate((self.sketches, sketches))
        first = np.argsort(T.mix64(units.view(U64)), kind="stable")[:self.n_leaders]
        self.units, self.sketches = units[first], sketches[first]

    def leaders(self, least: int) -> pa.RecordBatch:
        """The largest group among the leaders, by rising unit."""
        label, _ = similar_groups(self.sketches, least)
        main = np.flatnonzero(label == np.bincount(label).argmax())
        main = main[np.argsort(self.units[main])]
        parts = -(-self.n // self.part_rows)
        return level_rows(np.full(len(main), self.node), self.depth, self.units[main], self.sketches[main], -parts)


def walk_level(paths: DataFrame, node_limit: int, max_depth: int, least: int, hold_limit: int = 1 << 20,
               part_rows: int = 1 << 16, n_leaders: int = 256) -> DataFrame:
    """Loose links (a, b, node) of the nodes, rows of the children of large
    ones, and hot nodes in parts (``LEVEL``), from one sorted stream."""

    def links(node: int, units: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(label != np.arange(len(label)))
        k = len(at)
        return pa.RecordBatch.from_arrays(
            [pa.array(units[at]), pa.array(units[label[at]]), pa.array(np.full(k, node, np.int64)),
             pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int32())],
            names=["a", "b", "node", "depth", "unit", "sketch", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = depth = hot = None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def close():
            if hot is not None:
                yield hot.leaders(least)
            elif size > 1:
                units, sketches = (np.concatenate(c) for c in zip(*held))
                most = node_limit if size > node_limit and depth < max_depth else None
                label, unmet = similar_groups(sketches, least, most)
                if (label != np.arange(len(label))).any():
                    yield links(node, units, label)
                if len(unmet) > 1:
                    yield branch(node, depth, units[unmet], sketches[unmet])

        for b in batches:
            if not b.num_rows:
                continue
            nodes, depths = b["node"].to_numpy(), b["depth"].to_numpy()
            own, sk = b["unit"].to_numpy(), to_sketches(b["sketch"])
            for lo, hi in node_runs(nodes):
                if nodes[lo] != node:
                    yield from close()
                    node, depth, hot, held, size = int(nodes[lo]), int(depths[lo]), None, [], 0
                if hot is None:
                    held.append((own[lo:hi], sk[lo:hi]))
                    size += hi - lo
                    if size > hold_limit:
                        hot = HotNode(node, depth, part_rows, n_leaders)
                        for units, sketches in held:
                            yield from hot.add(units, sketches)
                        held = []
                else:
                    yield from hot.add(own[lo:hi], sk[lo:hi])
        yield from close()

    return (paths.repartition("node").sortWithinPartitions("node", "unit")
            .select("node", "depth", "unit", "sketch").mapInArrow(T.freed(run), LEVEL))


def by_part(first: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of the parts of hot nodes, each part after ``first`` (one row per
    part and record: few)."""
    names = ["node", "depth", "part", "unit", "sketch", "rep"]
    both = first.select(*names, F.lit(0).alias("late")).union(rows.select(*names, F.lit(1).alias("late")))
    return both.repartition("node", "part").sortWithinPartitions("node", "part", "late", "unit").select(*names, "late")


def settle_hot(hot: DataFrame, node_limit: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(loose links, children) of hot nodes, from their parts and leaders.

    The main group of a node is what agrees with one of its leaders.  If at
    most ``node_limit`` records are outside, each meets all records of the
    main group and the others outside, and the node has no children."""

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leaders, rep = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            nodes, parts, late = (b[c].to_numpy() for c in ("node", "part", "late"))
            units, sketches = b["unit"].to_numpy(), to_sketches(b["sketch"])
            for lo, hi in node_runs(nodes, parts, late):
                if (nodes[lo], parts[lo]) != key:
                    key, leaders, rep = (nodes[lo], parts[lo]), [], None
                if not late[lo]:
                    leaders.extend(sketches[lo:hi])
                    rep = int(units[lo]) if rep is None else rep
                    continue
                out = np.arange(lo, hi)
                for x in leaders:
                    out = out[(sketches[out] == x).sum(axis=1) < least]
                    if not len(out):
                        break
                outside = np.zeros(hi - lo, bool)
                outside[out - lo] = True
                yield pa.RecordBatch.from_arrays(
                    [*(b[c].slice(lo, hi - lo) for c in ("node", "depth", "part", "unit", "sketch")),
                     pa.array(np.full(hi - lo, rep), mask=outside)], names=["node", "depth", "part", "unit", "sketch", "rep"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, units, sketches, rep = None, [], [], None
        found: set[int] = set()

        def pairs(a, b, node):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                               pa.array([node] * len(a), pa.int64())], names=["a", "b", "node"])

        def close():
            if key is not None and key[1] == 0 and len(units) > 1:
                label, _ = similar_groups(np.array(sketches), least)
                at = [i for i in range(len(units)) if label[i] != i]
                yield pairs([units[i] for i in at], [units[label[i]] for i in at], key[0])
            if found:
                yield pairs([units[i] for i in sorted(found)], [rep] * len(found), key[0])

        for b in batches:
            if not b.num_rows:
                continue
            nodes, parts, late = (b[c].to_numpy() for c in ("node", "part", "late"))
            own, sk = b["unit"].to_numpy(), to_sketches(b["sketch"])
            for lo, hi in node_runs(nodes, parts, late):
                if (int(nodes[lo]), int(parts[lo])) != key:
                    yield from close()
                    key, units, sketches, found = (int(nodes[lo]), int(parts[lo])), [], [], set()
                if not late[lo]:
                    units.extend(own[lo:hi].tolist())
                    sketches.extend(sk[lo:hi])
                    continue
                rep = b["rep"][lo].as_py()
                found |= {i for i, x in enumerate(sketches)
                          if i not in found and ((sk[lo:hi] == x).sum(axis=1) >= least).any()}
                linked = own[lo:hi][own[lo:hi] != rep]
                yield pairs(linked, np.full(len(linked), rep), key[0])
        yield from close()

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                nodes, depths = b["node"].to_numpy(), b["depth"].to_numpy()
                own, sk = b["unit"].to_numpy(), to_sketches(b["sketch"])
                for lo, hi in node_runs(nodes):
                    yield branch(int(nodes[lo]), int(depths[lo]), own[lo:hi], sk[lo:hi])

    hot = hot.withColumn("rep", F.lit(None).cast("bigint"))
    leaders = hot.where("part < 0").withColumn("parts", -F.col("part"))
    spread = F.explode(F.expr("sequence(0, parts - 1)")).alias("part")
    sides = materialize(by_part(
        leaders.select("node", "depth", spread, "unit", "sketch", "rep"), hot.where("part >= 0")).mapInArrow(
        T.freed(reached), "node bigint, depth int, part int, unit bigint, sketch binary, rep bigint"), "sides")
    outside = sides.where("rep is null")
    crowded = materialize(outside.groupBy("node").count().where(F.col("count") > node_limit).select("node"), "crowded")
    settled = sides.where("rep is not null").join(crowded, "node", "left_anti")
    strangers = outside.join(crowded, "node", "left_anti").drop("part").join(
        leaders.select("node", "parts").distinct(), "node").select("node", "depth", spread, "unit", "sketch", "rep")
    links = materialize(by_part(strangers, settled).mapInArrow(T.freed(met), "a bigint, b bigint, node bigint"), "met")
    more = sides.join(crowded, "node").select("node", "depth", "unit", "sketch").mapInArrow(T.freed(children), LEVEL)
    return links, more.select("node", "depth", "unit", "sketch")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 85, trees: int = 6, node_limit: int = 2000, max_depth: int = 16,
                    max_hashes: int = 1 << 24, hold_limit: int = 1 << 20) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    least = int(VALUES * (percent / 100 - 0.19))
    signed = materialize(signatures(docs, id_col, text_col, width), "signatures")
    records = materialize(
        signed.where("n_shingles > 0 and doc_id is not null").groupBy("set_id").agg(
            F.min("doc_id").alias("unit"), F.min("n_shingles").alias("n"), F.min("values").alias("values")), "records")
    paths, loose = start_paths(records.select("unit", "values"), trees), None
    while paths is not None:
        found = materialize(walk_level(paths, node_limit, max_depth, least, hold_limit), "level")
        links = found.where("a is not null").select("a", "b", "node")
        children = found.where("a is null and part is null").select("node", "depth", "unit", "sketch")
        hot = found.where("part is not null").drop("a", "b")
        if not hot.isEmpty():
            more_links, more = settle_hot(hot, node_limit, least)
            links, children = links.unionByName(more_links), children.unionByName(more)
        loose = links if loose is None else loose.unionByName(links)
        paths = None if children.isEmpty() else children

    text = only(docs, id_col, text_col).select(F.col(id_col).cast("bigint").alias("unit"), F.col(text_col).alias("text"))

    def load_texts(members: DataFrame, small: bool) -> DataFrame:
        return text.join(F.broadcast(members) if small else members, "unit").select("key", "unit", "text")

    def to_sets(texts: pa.Array):
        return shingle_sets(texts, width)

    joined = exact_components(loose, records.select("unit", "n"), load_texts, to_sets, percent, max_hashes)
    labels = materialize(
        records.select("set_id", "unit").join(joined, "unit", "left").select(
            "set_id", F.coalesce("component", "unit").alias("component_id")), "labels")
    return signed.select("doc_id", "n_shingles", "set_id").join(labels, "set_id", "left").select(
        F.col("doc_id").alias(id_col), "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(False)).alias("kept"))
