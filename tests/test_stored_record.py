"""The sales record is joined, cleaned and stored once; rows built here."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from salesmart.config import DEFAULT_COLUMN_MAP, CanonicalizeConfig
from salesmart.functions.text import PANDAS_NA_TOKENS
from salesmart.operators.dims import item_attributes
from salesmart.operators.keys import dense_row_keys
from salesmart.plans import catalog
from salesmart.session import SMALL_FUNCTIONS, conf_for
from salesmart.sources.raw import clean_raw
from salesmart.sources.tables import item_code


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(k, f"name {k}", "BIG" if k % 2 else "SMALL", k % 5) for k in range(20)],
                          "p_partkey bigint, p_name string, p_type string, p_size int").write.parquet(f"{d}/part.parquet")
    spark.createDataFrame([(k, k % 7, datetime(1998, 1, 1 + k % 20)) for k in range(400)],
                          "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp").write.parquet(f"{d}/orders.parquet")
    # Order 130, line 140: the transaction id of the raw text is 'N/A'.
    lines = [(k, k % 20, n, 5.0, 100.0 + k, 0.1, 0.05, "R" if k % 9 == 0 else "N")
             for k in range(400) for n in ((140,) if k == 130 else (4,)) if (k * 31 + n * 7) % 1000 not in (0, 1, 2, 3)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string"
                          ).write.parquet(f"{d}/lineitem.parquet")
    return d


def test_orphans_read_the_stored_record(spark, tables):
    orphans = catalog.QUERIES["fact_orphans"](spark, tables)
    read = orphans.inputFiles()
    assert read and not any("lineitem" in f or "orders.parquet" in f for f in read)
    lost = [(r.missing, r.transaction_id) for r in orphans.collect()]
    hashes = [(k * 31 + (140 if k == 130 else 4) * 7) % 1000 for k in range(400)]
    assert len(lost) == sum(h in (10, 11) for h in hashes) > 0


def test_every_table_of_a_warehouse_reads_one_record(spark, tables):
    wh = catalog.messy_wh(spark, tables)
    assert not any("lineitem" in f for f in wh.rejected.inputFiles())
    assert wh.fact.count() + wh.orphans.count() == catalog._messy(spark, tables).count()


def test_items_are_folded_before_their_attributes_are_listed(spark):
    rows = [("I1", 2, "b", "x", "v1", 5), ("I1", 1, "a", "x", "v1", 3), ("I1", 1, "a", None, "v2", 9),
            ("I2", None, "c", "y", "v1", 1), (None, 4, "d", "y", "v1", 2), ("I3", 7, None, None, "v1", 4)]
    df = spark.createDataFrame(rows, "item_code string, item_id bigint, item_name string, category string, "
                               "version string, _seq bigint")
    out = item_attributes(df)
    assert {tuple(r) for r in out.collect()} == {("I1", 1, "a", "X", "v1"), ("I3", 7, None, None, "v1")}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan.split("Generate explode")[1]


def test_a_category_is_canonicalised_once_per_folded_row(spark):
    rows = [("I1", 1, "a", c, "v1", n) for n, c in enumerate(["  big box", "BIG BOX", "small", "small"] * 2 + ["Big  Box "])]
    rows += [("I2", 2, "b", None, "v1", 50), ("I3", 3, "c", " ", "v1", 51)]
    df = spark.createDataFrame(rows, "item_code string, item_id bigint, item_name string, category string, "
                               "version string, _seq bigint")
    # Five texts of one category win over four times another text.
    out = item_attributes(df)
    assert {(r.item_code, r.category) for r in out.collect()} == {("I1", "Big Box"), ("I2", None), ("I3", "")}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Generate explode"):].split("Aggregate", 1)[1]
    assert "regexp_replace" in plan and "regexp_replace" not in below
    distinct = item_attributes(df, CanonicalizeConfig(item_attributes="distinct"))
    assert sorted((r.item_code, r.category) for r in distinct.where("item_id < 2 OR item_id = 3").collect()) == [
        ("I1", "Big Box"), ("I1", "Small"), ("I3", "")]


def test_numbers_need_no_token_list(spark):
    texts = [(t,) * 17 for t in (*PANDAS_NA_TOKENS, "12")]
    out = clean_raw(spark.createDataFrame(texts, ", ".join(f"{c} string" for c in DEFAULT_COLUMN_MAP)))
    left = out.where("item_name IS NOT NULL").collect()
    assert len(left) == 1 and left[0].final_revenue == 12 and left[0].final_quantity == 12
    assert out.where("final_revenue IS NOT NULL OR final_quantity IS NOT NULL OR buyer_id IS NOT NULL").count() == 1
    plan = out.select("final_revenue", "final_quantity")._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" not in plan.upper() and "#N/A" not in plan


def test_scratch_tables_are_packed(spark, tables):
    assert all(".zstd." in f for f in catalog._messy(spark, tables).inputFiles())
    keyed = dense_row_keys(spark.range(5).withColumn("b", F.col("id") % 2), "k", order_by=["b", "id"])
    assert [(r.k, r.id) for r in keyed.orderBy("k").collect()] == [(1, 0), (2, 2), (3, 4), (4, 1), (5, 3)]
    assert all(".zstd." in f for f in keyed.inputFiles() if "row-keys" in f) and keyed.inputFiles()


def test_landed_files_are_packed(spark, tables):
    catalog.QUERIES["dry_run_counts"](spark, tables)
    path = catalog.scratch_path(spark, "landed")
    catalog._land(spark.range(10).select(F.col("id").cast("string").alias("a")).write, path)
    back = spark.read.option("header", True).csv(path)
    assert back.count() == 10 and all(f.endswith(".csv.gz") for f in back.inputFiles())


def test_item_code_is_the_formatters(spark):
    keys = spark.createDataFrame([(k,) for k in (0, 7, 999999, 1000000, 12345678, -5)], "k bigint")
    same = keys.where(item_code(F.col("k")) != F.format_string("I%06d", F.col("k")))
    assert same.count() == 0


def test_settings_come_back(spark):
    key = next(iter(SMALL_FUNCTIONS))
    before = spark.conf.get(key)
    with pytest.raises(KeyError), conf_for(spark, SMALL_FUNCTIONS):
        assert spark.conf.get(key) == "8000"
        raise KeyError
    assert spark.conf.get(key) == before
