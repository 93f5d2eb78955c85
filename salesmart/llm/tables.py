"""DataFrame helpers of the text operators: stored steps and components."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm.textops import freed
from salesmart.session import materialize

_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and nothing else, so that further columns of the
    input never clash with those that an operator adds."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def bound_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Python tasks get batches of about ``size`` bytes (one row at least), where
    the session has no limit of its own: by rows alone, a batch of texts or of
    packed rows, held by the JVM and the worker, has a size that the data choose."""
    if spark.conf.get(_BATCH) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, f"{size}b")


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """``materialize``, then a garbage collection on the driver: Spark's cleaner
    removes the shuffle files of a finished step once the driver's collector
    has found its plan unreachable, which may otherwise take half an hour."""
    spark = df.sparkSession
    out = materialize(df, name, **options)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def drop_stored(df: DataFrame) -> None:
    """Deletes the folder of a ``stored`` table that nothing reads any more."""
    files = df.inputFiles()
    if files:
        context = df.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with ``_`` appended until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as the edges (a, b) as one star each: (node, smallest
    node of its component), for the nodes that are not the smallest.  Labels
    sink along the edges and jump to their label's label until nothing moves."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        for side in (u, v, label[u], label[v]):
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def contracted(edges: DataFrame, block: int = 1 << 20) -> DataFrame:
    """(u, v), u > v: blocks of at most ``block`` edges of each task, each
    replaced by stars with the same components.  Rounds over all edges then
    start from fewer and shorter ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            u, v = stars(np.concatenate([x["a"].to_numpy() for x in held]), np.concatenate([x["b"].to_numpy() for x in held]))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for b in batches:
            if b.num_rows:
                held.append(b)
            if sum(x.num_rows for x in held) >= block:
                yield close()
        if held:
            yield close()

    return edges.where("a != b").select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).mapInArrow(
        freed(run), "u bigint, v bigint")


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node of ``edges(u, v)`` is a ``u`` once at most, and no
    node is both a ``u`` and a ``v``."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("root")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    roles = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("root").alias("root"))
    return roles.agg(F.max(F.col("child") + F.col("root"))).first()[0] in (None, 1)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: (node, component), with the
    smallest node as component; nodes without an edge do not appear.

    Every task first replaces its edges by stars.  Then alternating large-star
    and small-star rounds: each round joins edges
    with the minimum of each node's neighbours.  They end when every node is
    either a root or the child of one root.  Every step is stored in the
    shared folder, so both join sides are plain shuffles that adaptive
    execution can split at a hub, and a lost executor repeats one round only.
    """
    e = materialize(contracted(edges).distinct(), "uf-edges")
    for _ in range(max_rounds):
        if _are_stars(e):
            break
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m"))
                          .select("u", F.least("u", "m").alias("m")), "uf-low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u != v").distinct(), "uf-large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "uf-low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v")))
        e = materialize(small.where("u != v").distinct(), "uf-edges")
    else:
        raise RuntimeError("components did not settle")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
