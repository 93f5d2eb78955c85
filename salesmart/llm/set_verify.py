"""Exact verification of near-duplicate candidates on full sets.

Candidates come as loose groups: everything inside a group may be linked,
nothing across groups is.  A group is read as one stream of its members' full
sets (sorted 64-bit hashes) and split into the components of the links whose
Jaccard similarity reaches the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.tables import components
from salesmart.llm.textops import freed
from salesmart.session import materialize

U64 = np.uint64


def link_components(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the index of its component's first member; sets are linked
    where 100 * intersection >= percent * union.  Breadth first: every member
    reached is compared once with all that are not yet reached."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([0, 0 if 100 * both >= percent * (len(sets[0]) + len(sets[1]) - both) else 1])
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    _, ids = np.unique(flat, return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    label = np.full(n, -1, np.int64)
    mark = np.zeros(int(ids.max()) + 1, bool)
    rest = np.arange(n)
    for seed in range(n):
        if label[seed] >= 0:
            continue
        label[seed] = seed
        frontier = [seed]
        rest = rest[label[rest] < 0]
        if len(rest):
            places = [ids[starts[r]: ends[r]] for r in rest]
            pool = np.concatenate(places)
            heads = np.concatenate(([0], np.cumsum(sizes[rest])[:-1]))
        while frontier and len(rest):
            x = frontier.pop()
            own = ids[starts[x]: ends[x]]
            mark[own] = True
            both = np.add.reduceat(mark[pool], heads, dtype=np.int64)
            mark[own] = False
            linked = 100 * both >= percent * (sizes[x] + sizes[rest] - both)
            if linked.any():
                new = rest[linked]
                label[new] = seed
                frontier.extend(new.tolist())
                rest = rest[~linked]
                if len(rest):
                    pool = np.concatenate([ids[starts[r]: ends[r]] for r in rest])
                    heads = np.concatenate(([0], np.cumsum(sizes[rest])[:-1]))
    return label


def verified_components(members: DataFrame, to_sets, percent: int) -> DataFrame:
    """``members(key, unit, text)`` -> (a, b): each unit with the first unit
    of its verified component inside the group ``key``, if not itself.

    ``to_sets`` gives the sets of a text column.  Texts are shuffled, not
    their sets, which are several times larger."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: list[int] = []
        sets: list[np.ndarray] = []
        key = None

        def flush():
            if len(units) > 1:
                label = link_components(sets, percent)
                moved = [i for i in range(len(units)) if label[i] != i]
                return pa.RecordBatch.from_arrays(
                    [pa.array([units[i] for i in moved], pa.int64()), pa.array([units[label[i]] for i in moved], pa.int64())],
                    names=["a", "b"])
            return None

        for b in batches:
            for k, u, own in zip(b["key"].to_pylist(), b["unit"].to_pylist(), to_sets(b["text"])):
                if not len(own):
                    continue
                if k != key:
                    out = flush()
                    if out is not None and out.num_rows:
                        yield out
                    key, units, sets = k, [], []
                if not units or units[-1] != u:
                    units.append(u)
                    sets.append(own)
        out = flush()
        if out is not None and out.num_rows:
            yield out

    return (members.repartition("key").sortWithinPartitions("key", "unit")
            .select("key", "unit", "text").mapInArrow(freed(run), "a bigint, b bigint"))


def split_keys(rows: DataFrame, sizes: DataFrame, max_hashes: int) -> DataFrame:
    """``rows(key, unit)`` with every key of more than ``max_hashes`` hashes
    dealt to one key per pair of its parts, of two thirds of that on average:
    any two units of a key still meet."""
    parts = materialize(rows.join(sizes, "unit").groupBy("key").agg(F.sum("n").alias("n")).where(
        F.col("n") > max_hashes).select("key", F.ceil(3 * F.col("n") / max_hashes).cast("int").alias("parts")), "parts")
    dealt = rows.join(parts, "key").withColumn("part", F.expr("cast(pmod(xxhash64(unit), parts) as int)")).withColumn(
        "other", F.explode(F.expr("sequence(0, parts - 1)"))).where("part != other")
    return rows.join(parts, "key", "left_anti").select("key", "unit").unionByName(dealt.select(
        F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("key"), "unit"))


def exact_components(loose: DataFrame, sizes: DataFrame, load_texts, to_sets, percent: int,
                     max_hashes: int, max_broadcast: int = 64 << 20) -> DataFrame:
    """(unit, component) of every unit that has a verified link.

    ``loose(a, b, node)``: candidate links, once per node that proposed them;
    ``sizes(unit, n)``: set sizes; ``load_texts(members, small)`` adds the
    column ``text`` to ``members(key, unit)``; ``small`` says that the
    members may be broadcast (their measured size is below ``max_broadcast``).

    Groups are the components of the loose links.  A group with more than
    ``max_hashes`` hashes in all is dealt by node instead, and a node's group
    that is still larger by pairs of its parts (bounded groups); the verified
    links of all kinds are joined to components.
    """
    groups = materialize(components(loose.select("a", "b")), "loose")
    weighed = groups.join(sizes.withColumnRenamed("unit", "node"), "node")
    large = materialize(weighed.groupBy("component").agg(F.sum("n").alias("n"))
                        .where(F.col("n") > max_hashes).select("component"), "large")
    inside = groups.join(large, "component", "left_anti").select(
        F.col("component").alias("key"), F.col("node").alias("unit"))
    oversize = not large.isEmpty()
    if oversize:
        hot = groups.join(large, "component").select(F.col("node").alias("a"))
        dealt = loose.join(hot, "a").withColumn("key", F.xxhash64("node", "b"))
        rows = materialize(dealt.select("key", F.col("a").alias("unit")).unionByName(
            dealt.select("key", F.col("b").alias("unit"))).distinct(), "dealt")
        inside = inside.unionByName(split_keys(rows, sizes, max_hashes))
    members = materialize(inside.distinct(), "members")
    links = materialize(verified_components(
        load_texts(members, members.count() * 32 <= max_broadcast), to_sets, percent), "links")
    if oversize:
        return components(links).select(F.col("node").alias("unit"), "component")
    # Each group is whole: its labels are final, but for the smallest member,
    # which the stream's order (by unit) makes the label.
    return links.select(F.col("a").alias("unit"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("unit"), F.col("b").alias("component")).distinct())
