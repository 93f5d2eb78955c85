"""Distributed ordinal numbering: RANK() and dense surrogate keys.

``RANK() OVER (ORDER BY v)`` with no PARTITION BY makes Spark move every row
into one task (``Exchange SinglePartition``).  The functions here compute the
same numbers with every step partitioned:

1. collapse the input to distinct ``(partition keys, v)`` with a multiplicity
   (map-side partial aggregation, so a value shared by a third of the rows
   becomes one row before any shuffle);
2. cut the value domain into ``n`` buckets at sampled quantiles — ``n``
   boundary values reach the driver, nothing else — so ``bucket(v)`` is a
   deterministic function of the value (a recomputed task after an executor
   loss lands every row in the same bucket again);
3. rows above a value = rows in higher buckets (a window over at most ``n``
   bucket totals per partition key) + rows above it inside its own bucket
   (a window over one bucket of one partition key);
4. join the rank back on ``(partition keys, v)`` (null-safe).

Equal values always share a bucket, so ties get equal ranks and the next
rank leaves the usual gap.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
SAMPLE_PER_BUCKET = 16


def _n_buckets(df: DataFrame, n: int | None) -> int:
    if n is None:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(1, int(n))


def _sort_domain(df: DataFrame, col: str) -> tuple[Column, str]:
    """A column whose natural order equals the order of ``col``.

    Numbers compare as DOUBLE and dates as day numbers (both valid inputs to
    ``approxQuantile``); everything else keeps its own type.
    """
    dt = df.schema[col].dataType
    if isinstance(dt, _NUMERIC):
        return F.col(col).cast("double"), "numeric"
    if isinstance(dt, T.DateType):
        return F.unix_date(F.col(col)).cast("double"), "numeric"
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(F.col(col)).cast("double"), "numeric"
    return F.col(col), "other"


def _boundaries(df: DataFrame, col: str, n: int) -> tuple[list, Column]:
    """``n - 1`` sorted cut points of ``col`` and the domain expression."""
    dom, kind = _sort_domain(df, col)
    if n <= 1:
        return [], dom
    probs = [i / n for i in range(1, n)]
    vals = df.select(dom.alias("__d")).where(F.col("__d").isNotNull())
    if kind == "numeric":
        cuts = vals.approxQuantile("__d", probs, 1.0 / (4 * n))
    else:
        # Non-numeric: the values with the smallest hashes, a uniform sample
        # whose size follows the number of buckets, sorted on the driver.
        sample = sorted(r[0] for r in vals.orderBy(F.xxhash64("__d"), "__d").limit(SAMPLE_PER_BUCKET * n).collect())
        if not sample:
            return [], dom
        cuts = [sample[min(len(sample) - 1, int(p * len(sample)))] for p in probs]
    return sorted(set(cuts)), dom


def _bucket(dom: Column, cuts: list) -> Column:
    if not cuts:
        return F.lit(0)
    # Two levels: the group of cuts, then the place inside it, so that a row
    # is compared with about 2 * sqrt(n) of n cuts.
    width = max(1, math.isqrt(len(cuts)))
    groups = [cuts[i: i + width] for i in range(0, len(cuts), width)]
    tops = F.array(*[F.lit(g[-1]) for g in groups])
    nested = F.array(*[F.array(*[F.lit(c) for c in g]) for g in groups])
    above = F.size(F.filter(tops, lambda b: b < dom))
    inside = F.coalesce(F.size(F.filter(F.get(nested, above), lambda b: b < dom)), F.lit(0))
    return above * width + F.greatest(inside, F.lit(0))


def _ordered(c: str, descending: bool, nulls_first: bool) -> Column:
    col = F.col(c)
    if descending:
        return col.desc_nulls_first() if nulls_first else col.desc_nulls_last()
    return col.asc_nulls_first() if nulls_first else col.asc_nulls_last()


def value_cuts(df: DataFrame, value: str, n_buckets: int | None = None) -> list:
    """Cut points of ``value`` that several ranks of the same value can share
    (one sampling pass instead of one per rank)."""
    return _boundaries(df, value, _n_buckets(df, n_buckets))[0]


def _rank_distinct(dist: DataFrame, value: str, parts: Sequence[str], weight: str,
                   descending: bool, nulls_first: bool, n: int,
                   cuts: list | None = None) -> DataFrame:
    """``dist`` holds distinct (parts, value) with a row count ``weight``;
    adds ``__rank`` = 1 + rows ordered strictly before it."""
    if cuts is None:
        cuts, dom = _boundaries(dist, value, n)
    else:
        dom = _sort_domain(dist, value)[0]
    nb = len(cuts) + 1
    null_bucket = (nb if descending else -1) if nulls_first else (-1 if descending else nb)
    bucket = F.when(F.col(value).isNull(), F.lit(null_bucket)).otherwise(_bucket(dom, cuts))
    b = dist.withColumn("__b", bucket)
    bucket_order = F.col("__b").desc() if descending else F.col("__b").asc()
    totals = b.groupBy(*parts, "__b").agg(F.sum(weight).alias("__bt"))
    w_off = (Window.partitionBy(*parts).orderBy(bucket_order)
             .rowsBetween(Window.unboundedPreceding, -1))
    # Renamed copies of the join keys: both sides derive from ``b``.
    offsets = totals.select(
        *[F.col(p).alias(f"__o{i}") for i, p in enumerate(parts)],
        F.col("__b").alias("__ob"),
        F.coalesce(F.sum("__bt").over(w_off), F.lit(0)).alias("__off"),
    )
    w_in = (Window.partitionBy(*parts, "__b").orderBy(_ordered(value, descending, nulls_first))
            .rowsBetween(Window.unboundedPreceding, -1))
    inside = b.withColumn("__above", F.coalesce(F.sum(weight).over(w_in), F.lit(0)))
    cond = [F.col("__b") == F.col("__ob")]
    cond += [F.col(p).eqNullSafe(F.col(f"__o{i}")) for i, p in enumerate(parts)]
    return (
        inside.join(offsets, cond)
        .select(*[F.col(c) for c in dist.columns],
                (F.col("__off") + F.col("__above") + 1).cast("bigint").alias("__rank"))
    )


def rank_over(df: DataFrame, value: str, out: str, partition_by: Sequence[str] = (),
              descending: bool = True, nulls_first: bool | None = None,
              n_buckets: int | None = None, cuts: list | None = None) -> DataFrame:
    """``RANK() OVER (PARTITION BY partition_by ORDER BY value [DESC])``.

    ``nulls_first`` defaults to PostgreSQL order (NULLs first on DESC, last
    on ASC).  Every input row is kept; ``out`` is BIGINT.  ``cuts`` (from
    :func:`value_cuts`) skips the sampling pass.
    """
    return ranks_over(df, value, {out: partition_by}, descending, nulls_first, n_buckets, cuts)


def ranks_over(df: DataFrame, value: str, ranks: dict[str, Sequence[str]],
               descending: bool = True, nulls_first: bool | None = None,
               n_buckets: int | None = None, cuts: list | None = None) -> DataFrame:
    """:func:`rank_over` for several partitionings of the same value, as
    ``{out: partition_by}``.  Every rank is computed from ``df`` itself, not
    from the output of the rank before it."""
    if nulls_first is None:
        nulls_first = descending
    n = _n_buckets(df, n_buckets)
    ranked = df
    for out, partition_by in ranks.items():
        keys = [*partition_by, value]
        dist = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__w"))
        table = _rank_distinct(dist, value, list(partition_by), "__w", descending, nulls_first, n, cuts)
        table = table.select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__rank").alias(out))
        cond = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
        ranked = ranked.join(table, cond).drop(*[f"__k{i}" for i in range(len(keys))])
    return ranked


#: Radix buckets per power of two of the value.
RADIX = 4096


def _radix_order(df: DataFrame, col: str, descending: bool, nulls_first: bool) -> Column:
    """A BIGINT that never falls in the order of the rank: the value's image on
    a logarithmic scale, with 4096 steps per power of two on either side of 0.
    At most some 8 million different numbers exist, and a data set has few
    thousands of them, whatever its size."""
    dom, kind = _sort_domain(df, col)
    if kind != "numeric":
        raise TypeError(f"{col} is neither a number nor a date")
    image = (F.signum(dom) * F.floor(F.log2(F.abs(dom) + 1) * RADIX)).cast("bigint")
    step = -image if descending else image
    edge = F.lit(-(1 << 40) if nulls_first else 1 << 40)
    return F.when(F.col(col).isNull(), edge).otherwise(step)


def radix_ranks(df: DataFrame, value: str, ranks: dict[str, Sequence[str]],
                descending: bool = True, nulls_first: bool | None = None) -> DataFrame:
    """:func:`ranks_over` as a lazy plan: no sampling job and no stored table,
    so the result follows its tables.

    Rows fold to distinct (partition keys, value) with a count; their radix
    buckets give, by a window over the bucket totals, the rows above a bucket;
    a window inside each bucket gives the rest.  Equal values share a bucket.
    """
    if nulls_first is None:
        nulls_first = descending
    every = list(dict.fromkeys(k for parts in ranks.values() for k in parts))
    folded = df.groupBy(*every, value).agg(F.count(F.lit(1)).alias("__w"))
    folded = folded.withColumn("__o", _radix_order(df, value, descending, nulls_first))
    ranked = df
    for out, parts in ranks.items():
        d = folded if set(parts) == set(every) else folded.groupBy(*parts, value, "__o").agg(
            F.sum("__w").alias("__w"))
        before = Window.partitionBy(*parts).orderBy("__o").rowsBetween(Window.unboundedPreceding, -1)
        above = d.groupBy(*parts, "__o").agg(F.sum("__w").alias("__t")).select(
            *[F.col(p).alias(f"__p{i}") for i, p in enumerate(parts)], F.col("__o").alias("__b"),
            F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__off"))
        inside = (Window.partitionBy(*parts, "__o").orderBy(_ordered(value, descending, nulls_first))
                  .rowsBetween(Window.unboundedPreceding, -1))
        cond = [F.col("__o") == F.col("__b")] + [
            F.col(p).eqNullSafe(F.col(f"__p{i}")) for i, p in enumerate(parts)]
        table = d.withColumn("__in", F.coalesce(F.sum("__w").over(inside), F.lit(0))).join(above, cond).select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate([*parts, value])],
            (F.col("__off") + F.col("__in") + 1).cast("bigint").alias(out))
        keys = [*parts, value]
        ranked = ranked.join(table, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]).drop(
            *[f"__k{i}" for i in range(len(keys))])
    return ranked


def dense_row_keys(df: DataFrame, out: str, start: int = 0, order_by: Sequence[str] | None = None,
                   n_rows: int | None = None, rows_per_shard: int = 1 << 21) -> DataFrame:
    """Keys ``start+1, start+2, ...`` for all rows of a multiset, in the order
    of ``order_by`` (default: all columns): ``row_number()`` over that order,
    without a one-task sort.

    Equal rows get an occurrence number as the last sort column, so that a row
    repeated over a third of the table spreads over shards too.  The rows are
    range-partitioned and sorted, and written once together with their shard
    and their place in it; the shards' row counts (one number per shard reach
    the driver) then give every shard its first key.  ``df`` should read stored
    rows: a lost task then finds the same occurrence numbers again.

    The result is sorted by its key, so its files hold narrow ranges of the
    leading columns.
    """
    from salesmart.session import materialize

    spark = df.sparkSession
    order = [F.col(c).asc_nulls_last() for c in (order_by or df.columns)]
    shards = max(_n_buckets(df, None), -(-n_rows // rows_per_shard) if n_rows else 1)
    occurring = df.withColumn("__occurrence", F.monotonically_increasing_id())
    order = [*order, F.col("__occurrence")]
    placed = (occurring.repartitionByRange(shards, *order).sortWithinPartitions(*order)
              .drop("__occurrence").withColumn("__at", F.monotonically_increasing_id()))
    rows = materialize(placed, "row-keys", compression="zstd")
    shard = F.shiftright("__at", 33)
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    first, at = [], start
    for s, n in sorted((r["s"], r["n"]) for r in rows.groupBy(shard.alias("s")).agg(
            F.count(F.lit(1)).alias("n")).collect()):
        first.append((s, at))
        at += n
    offsets = spark.createDataFrame(first, "__s bigint, __first bigint")
    return rows.join(F.broadcast(offsets), shard == F.col("__s")).select(
        (F.col("__first") + place + 1).alias(out), *[F.col(c) for c in df.columns])


def dense_keys(df: DataFrame, natural_key: str, out: str, start: Column | int = 0,
               n_buckets: int | None = None, materialize_input: bool = True) -> DataFrame:
    """Surrogate keys ``start+1, start+2, ...`` in natural-key order.

    ``df`` must hold one row per natural key (a dimension).  The numbering is
    a deterministic function of the data — no partition ids, no
    ``monotonically_increasing_id`` — so re-running a lost task reproduces
    the same keys.  ``start`` may be a scalar-subquery Column (the current
    maximum key of an existing dimension).

    The rows are read three times (cut-point sample, in-bucket window, bucket
    totals), so unless ``materialize_input`` is off they are first written
    once below the shared checkpoint folder: the upstream aggregation (e.g.
    the item mode) then runs once.
    """
    if materialize_input:
        from salesmart.session import materialize

        df = materialize(df, "dense-keys")
    n = _n_buckets(df, n_buckets)
    weighted = df.withColumn("__w", F.lit(1))
    ranked = _rank_distinct(weighted, natural_key, [], "__w", False, False, n)
    base = start if isinstance(start, Column) else F.lit(start)
    return ranked.select(
        (F.col("__rank") + F.coalesce(base, F.lit(0))).cast("bigint").alias(out),
        *[F.col(c) for c in df.columns],
    )
