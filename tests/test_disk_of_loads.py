"""What a load keeps on disk: its outputs, not its shuffles and scratch tables; rows built here."""

import glob
import os
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from salesmart.config import DEFAULT_COLUMN_MAP, EtlConfig, SourceConfig
from salesmart.plans import catalog
from salesmart.plans.warehouse import read_warehouse, run_pipeline
from salesmart.session import checkpoint_dir, conf_for, scratch_dropped, scratch_path
from salesmart.sources.raw import load_raw_data

GOOD = {"item_name": "Lamp", "category": "home", "version": "A", "item_code": "L-1", "item_id": "5",
        "buyer_id": "9", "transaction_id": "1", "date": "3/4/2021", "final_quantity": "1",
        "total_revenue": "10.00", "price_reductions": "0", "refunds": "0", "final_revenue": "10.00",
        "sales_tax": "1.00", "overall_revenue": "11.00", "refunded_item_count": "0", "purchased_item_count": "1"}
LARGE = {c: "5000000000000.00" for c in ("total_revenue", "final_revenue", "overall_revenue")} | {"sales_tax": "0"}


def _file(spark, path, rows):
    names = list(DEFAULT_COLUMN_MAP)
    df = spark.createDataFrame([tuple((GOOD | r)[n] for n in names) for r in rows],
                               ", ".join(f"`{DEFAULT_COLUMN_MAP[n]}` string" for n in names))
    df.coalesce(2).write.option("header", True).csv(path)
    return EtlConfig(source=SourceConfig(path=path))


def _load(spark, cfg, out):
    return run_pipeline(spark, load_raw_data(spark, cfg.source), out, cfg)


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.toString()}/**/shuffle_*.data", recursive=True)}


def _scratch(spark):
    return set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))


def test_a_load_leaves_no_shuffle_and_no_scratch_table(spark, tmp_path):
    cfg = _file(spark, str(tmp_path / "raw"), [{"transaction_id": str(i), "buyer_id": str(i % 5)} for i in range(50)])
    shuffles, scratch = _shuffle_files(spark), _scratch(spark)
    with conf_for(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        run = _load(spark, cfg, str(tmp_path / "out"))
    assert _scratch(spark) == scratch
    until = time.time() + 20  # the files go in the background
    while (left := _shuffle_files(spark) - shuffles) and time.time() < until:
        time.sleep(0.2)
    assert not left
    # Tables of as many rows as the record are packed; dimensions are not.
    for name in ("processed/orders_cleaned", "processed/validated_fact_data", "warehouse/fact_sales"):
        files = spark.read.parquet(f"{tmp_path}/out/{name}").inputFiles()
        assert files and all(".zstd." in f for f in files), name
    wh = read_warehouse(spark, run.warehouse_dir)
    assert not any(".zstd." in f for f in wh.dim_item.inputFiles())
    assert [r.fact_key for r in wh.fact.orderBy("fact_key").collect()] == list(range(1, 51))


def test_settings_and_scratch_come_back_after_a_refused_load(spark, tmp_path):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, scratch = spark.conf.get(key), _scratch(spark)
    cfg = _file(spark, str(tmp_path / "raw"), [{"final_revenue": "99.00"}, {}])
    with pytest.raises(ValueError):
        _load(spark, cfg, str(tmp_path / "out"))
    assert spark.conf.get(key) == before and _scratch(spark) == scratch
    with scratch_dropped(spark):
        inner = scratch_path(spark, "inner")
        spark.range(1).write.parquet(inner)
        assert os.path.isdir(inner.removeprefix("file:"))
    outer = scratch_path(spark, "outer")
    spark.range(1).write.parquet(outer)
    assert _scratch(spark) - scratch == {os.path.basename(outer)}


@pytest.mark.parametrize(("fmt", "threshold"), [("parquet", "-1"), ("csv", "10MB")])
def test_orphans_are_whole_though_the_lookup_is_narrow(spark, tmp_path, fmt, threshold):
    rows = [{"transaction_id": str(i)} for i in range(4)]
    rows += [{"transaction_id": "N/A", "version": v} for v in ("B", "B", "C")]   # a row that comes twice
    rows += [{"date": "31/2/2021", "item_name": "Gone"}, {"buyer_id": "", "item_code": "L-1"},
             {"item_code": "L-2", "item_id": "", "category": "odd"}, {"item_code": "NA", "buyer_id": "8"},
             {"date": "31/2/2021", "item_code": "", "buyer_id": "", "transaction_id": ""}]
    rows += [{"date": "", "item_name": "Dear"} | LARGE]  # too large for the fact, which it does not reach
    cfg = _file(spark, str(tmp_path / "raw"), rows)
    cfg = EtlConfig(source=cfg.source, output_format=fmt)
    with conf_for(spark, {"spark.sql.autoBroadcastJoinThreshold": threshold}):
        run = _load(spark, cfg, str(tmp_path / "out"))
    assert run.counts["n_orphans"] == 9
    lost = spark.read.parquet(f"{run.processed_dir}/fact_orphans")
    assert lost.columns == [*DEFAULT_COLUMN_MAP, "date_key", "item_key", "buyer_key", "missing"]
    seen = sorted((r.item_name, r.category, r.version, r.transaction_id or 0, r.date_key or 0, r.item_key or 0,
                   r.buyer_key or 0, ",".join(r.missing)) for r in lost.collect())
    assert seen == sorted([
        *[("Lamp", "home", v, 0, 1, 1, 2, "transaction_id") for v in ("B", "B", "C")],
        ("Gone", "home", "A", 1, 0, 1, 2, "date_key"), ("Lamp", "home", "A", 1, 1, 1, 0, "buyer_key"),
        ("Lamp", "odd", "A", 1, 1, 0, 2, "item_key"), ("Lamp", "home", "A", 1, 1, 0, 1, "item_key"),
        ("Lamp", "home", "A", 0, 0, 0, 0, "date_key,item_key,buyer_key,transaction_id"),
        ("Dear", "home", "A", 1, 0, 1, 2, "date_key")])
    assert [r.total_revenue for r in lost.where("item_name = 'Dear'").collect()] == [5 * 10**12]
    wh = read_warehouse(spark, run.warehouse_dir)
    assert sorted(r.transaction_id for r in wh.fact.collect()) == [0, 1, 2, 3]


def test_a_value_too_large_for_the_fact_refuses_the_load(spark, tmp_path):
    cfg = _file(spark, str(tmp_path / "raw"), [{}, LARGE])
    with pytest.raises(ValueError, match="Values of 1 rows"):
        _load(spark, cfg, str(tmp_path / "out"))
    assert not os.path.exists(tmp_path / "out" / "warehouse" / "fact_sales")


def test_the_lookup_shuffles_the_facts_columns_only(spark, tmp_path, monkeypatch):
    from salesmart.plans import warehouse

    carried = []

    def lookup(sales, *dims):
        carried.append(sales.columns)
        return real(sales, *dims)

    real = warehouse.lookup_keys
    monkeypatch.setattr(warehouse, "lookup_keys", lookup)
    _load(spark, _file(spark, str(tmp_path / "raw"), [{}, {"transaction_id": ""}]), str(tmp_path / "out"))
    assert len(carried) == 1 and not {"item_name", "category", "version", "item_id"} & set(carried[0])


def test_landed_files_go_when_their_loads_are_done(spark, tmp_path):
    d = str(tmp_path / "tables")
    spark.createDataFrame([(k, f"name {k}", "BIG", k) for k in range(5)],
                          "p_partkey bigint, p_name string, p_type string, p_size int").write.parquet(f"{d}/part.parquet")
    spark.createDataFrame([(k, k % 7, datetime(1998, 1, 1 + k % 20)) for k in range(40)],
                          "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp").write.parquet(f"{d}/orders.parquet")
    lines = [(k, k % 5, 4, 5.0, 100.0 + k, 0.1, 0.05, "N") for k in range(40) if (k * 31 + 28) % 1000 > 11]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string"
                          ).write.parquet(f"{d}/lineitem.parquet")
    rows = catalog.QUERIES["pipeline_two_loads"](spark, d)
    top = os.path.dirname(catalog._landed_loads(spark, d)[1].removeprefix("file:"))
    assert not glob.glob(f"{top}/raw/file=*")
    for name in ("a", "b"):
        for kept in ("orders_cleaned", "validated_fact_data", "dim_item", "new_dim_item", "fact_orphans"):
            assert os.path.isdir(f"{top}/runs/{name}/processed/{kept}")
    got = sorted((r.transaction_id, r.item_code, r.buyer_id, r.full_date, r.total_revenue) for r in rows.collect())
    assert got == sorted((k, f"I{k % 5:06d}", k % 7, date(1998, 1, 1 + k % 20), 100.0 + k) for k, *_ in lines)
    keys = catalog.QUERIES["fact_keys_two_loads"](spark, d).orderBy("fact_key")
    late = [r.transaction_id % 2 for r in keys.collect()]
    assert late == sorted(late) and keys.agg(F.max("fact_key")).first()[0] == len(lines)
