"""Distributed RANK and dense keys against the single-partition window."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from salesmart.operators.keys import dense_keys, rank_over


def _data(spark, n=600, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = None if rnd.random() < 0.05 else rnd.choice([rnd.randint(0, 40), 7, 7, 7])
        cat = rnd.choice(["a", "b", "c", None])
        rows.append((i, cat, v, None if v is None else v / 3.0))
    return spark.createDataFrame(rows, "id int, cat string, v int, d double")


def test_rank_matches_window_desc_nulls_first(spark):
    df = _data(spark)
    ours = rank_over(df, "v", "r", n_buckets=5)
    ref = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_first())))
    assert sorted(ours.select("id", "r").collect()) == sorted(ref.select("id", "r").collect())


def test_rank_partitioned_matches_window(spark):
    df = _data(spark)
    for col, desc in (("v", True), ("d", False)):
        ours = rank_over(df, col, "r", partition_by=["cat"], descending=desc, n_buckets=4)
        order = F.col(col).desc_nulls_first() if desc else F.col(col).asc_nulls_last()
        ref = df.withColumn("r", F.rank().over(Window.partitionBy("cat").orderBy(order)))
        assert sorted(ours.select("id", "r").collect()) == sorted(ref.select("id", "r").collect())


def test_hot_value_collapses_to_one_rank(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 5)
                                  .otherwise(F.col("id")).alias("v"))
    ours = {r.id: r.r for r in rank_over(df, "v", "r", n_buckets=8).collect()}
    ref = {r.id: r.r for r in df.withColumn(
        "r", F.rank().over(Window.orderBy(F.col("v").desc()))).collect()}
    assert ours == ref


def test_dense_keys_strings_and_offset(spark):
    codes = [f"I{i:06d}" for i in random.Random(3).sample(range(10**6), 300)]
    df = spark.createDataFrame([(c,) for c in codes], "item_code string")
    keyed = dense_keys(df, "item_code", "k", start=100, n_buckets=6)
    got = sorted((r.item_code, r.k) for r in keyed.collect())
    assert got == [(c, 101 + i) for i, c in enumerate(sorted(codes))]
