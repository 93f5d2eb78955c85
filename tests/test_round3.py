"""Fact keys, lazy ranks, observed counts, one-scan measures and constraints,
published views, file order."""


import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from salesmart.config import DEFAULT_COLUMN_MAP, EtlConfig, SourceConfig
from salesmart.operators.constraints import constraint_report
from salesmart.operators.dims import item_attributes, most_frequent
from salesmart.operators.keys import dense_row_keys, radix_ranks
from salesmart.plans import catalog, cube
from salesmart.plans import measures as M
from salesmart.plans import views as V
from salesmart.plans.catalog_views import VIEW_NAMES, publish_views
from salesmart.plans.warehouse import read_warehouse, run_pipeline
from salesmart.sources.raw import load_raw_data

SF = "/root/testdata/sf0.001"


def _scans(df, column):
    """Scans of the table with this column in the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().rsplit("== Initial Plan ==", 1)[0]
    return sum("FileScan" in line and f"{column}#" in line for line in plan.splitlines())


def _land(spark, path, rows):
    base = {"item_name": "Lamp", "category": "home", "version": "A", "item_code": "L-1", "item_id": "5",
            "buyer_id": "9", "transaction_id": "1", "date": "3/4/2021", "final_quantity": "1",
            "total_revenue": "10.00", "price_reductions": "0", "refunds": "0", "final_revenue": "10.00",
            "sales_tax": "1.00", "overall_revenue": "11.00", "refunded_item_count": "0", "purchased_item_count": "1"}
    df = spark.createDataFrame([tuple((base | r)[n] for n in DEFAULT_COLUMN_MAP) for r in rows],
                               ", ".join(f"`{h}` string" for h in DEFAULT_COLUMN_MAP.values()))
    df.coalesce(1).write.option("header", True).csv(path)
    return EtlConfig(source=SourceConfig(path=path))


def _load(spark, cfg, out, **kw):
    return run_pipeline(spark, load_raw_data(spark, cfg.source), out, cfg, **kw)


# -- K1 -----------------------------------------------------------------------

def test_row_keys_number_a_multiset_with_a_hot_row(spark, tmp_path):
    r = random.Random(1)
    rows = [(r.randrange(5), r.choice([None, "a", "b"]), 1.5) for _ in range(300)] + [(2, "hot", 0.0)] * 400
    df = spark.createDataFrame(rows, "a int, b string, c double").repartition(7)
    df.write.parquet(str(tmp_path / "rows"))
    stored = spark.read.parquet(str(tmp_path / "rows"))
    got = dense_row_keys(stored, "k", start=50).collect()
    order = Window.orderBy(*[F.col(c).asc_nulls_last() for c in ("a", "b", "c")])
    want = df.select((F.row_number().over(order) + 50).cast("bigint").alias("k"), "*").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    # The repeated row does not end in one shard.
    hot = dense_row_keys(stored, "k").where("b = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot > 1


def test_fact_keys_go_on_and_a_load_keeps_its_range(spark, tmp_path):
    out = str(tmp_path / "out")
    one = _land(spark, str(tmp_path / "one"), [{"transaction_id": str(i)} for i in range(4)])
    two = _land(spark, str(tmp_path / "two"), [{"transaction_id": str(i), "date": "9/4/2021"} for i in range(3)])
    for cfg in (one, two, two, one):
        _load(spark, cfg, out)
    fact = read_warehouse(spark, f"{out}/warehouse").fact
    keys = sorted((r.fact_key, r.date_key) for r in fact.collect())
    assert [k for k, _ in keys] == list(range(1, 8))
    assert [d for _, d in keys] == [1] * 4 + [2] * 3


# -- W4, V8 -------------------------------------------------------------------

def test_radix_ranks_equal_window_ranks(spark):
    r = random.Random(3)
    values = [None, 0, 0, -5, 5, 10 ** 12, -10 ** 12] + [r.randrange(-3000, 3000) / 4 for _ in range(300)] + [
        7777.0 + i / 1e6 for i in range(50)] + [42.0] * 60
    df = spark.createDataFrame([(i, None if v is None else float(v), r.choice(["x", "y", None])) for i, v in enumerate(values)],
                               "id int, v double, g string").repartition(5)
    for descending in (True, False):
        ordered = F.col("v").desc_nulls_first() if descending else F.col("v").asc_nulls_last()
        want = df.select("*", F.rank().over(Window.orderBy(ordered)).cast("bigint").alias("r"),
                         F.rank().over(Window.partitionBy("g").orderBy(ordered)).cast("bigint").alias("rg"))
        got = radix_ranks(df, "v", {"r": [], "rg": ["g"]}, descending=descending)
        key = lambda x: x[0]
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


def test_item_view_is_lazy_and_follows_an_appended_load(spark, tmp_path):
    out = str(tmp_path / "out")
    cfg = _land(spark, str(tmp_path / "one"), [{"item_code": "L-1"}, {"item_code": "L-2", "item_id": "6", "total_revenue": "20",
                                               "final_revenue": "20", "overall_revenue": "21"}])
    _load(spark, cfg, out)
    wh = read_warehouse(spark, f"{out}/warehouse")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("views", "views")
    wh.register_views("lazy_")
    assert len(tracker.getJobIdsForGroup("views")) == 0
    spark.sparkContext.setJobGroup("", "")
    names = publish_views(spark, f"{out}/warehouse", "follows")
    assert len(names) == 9
    best = lambda t: {r.item_code: r.revenue_rank for r in spark.table(t).collect()}
    assert best("follows.vw_item_performance") == best("lazy_vw_item_performance") == {"L-2": 1, "L-1": 2}
    more = _land(spark, str(tmp_path / "two"), [{"transaction_id": "77", "total_revenue": "50", "final_revenue": "50",
                                                "overall_revenue": "51"}])
    _load(spark, more, out)
    assert best("follows.vw_item_performance") == {"L-1": 1, "L-2": 2}
    again = read_warehouse(spark, f"{out}/warehouse")
    assert {r.item_code: r.revenue_rank for r in again.views()["vw_item_performance"].collect()} == {"L-1": 1, "L-2": 2}


# -- S11 ----------------------------------------------------------------------

def test_another_session_reads_the_nine_views_by_name(spark):
    wh = catalog.messy_wh(spark, SF)
    publish_views(spark, wh.stats["dir"], "shared_sales")
    publish_views(spark, wh.stats["dir"], "shared_sales")  # dropped and made again
    other = spark.newSession()
    lazy = wh.views()
    for name in VIEW_NAMES:
        there = other.table(f"shared_sales.{name}")
        assert there.dtypes == lazy[name].dtypes, name
        assert sorted(map(str, there.collect())) == sorted(map(str, lazy[name].collect())), name


# -- P16, C2, C3 --------------------------------------------------------------

def test_kpis_scan_the_fact_once_and_equal_the_views(spark):
    wh = catalog.messy_wh(spark, SF)
    v = wh.views()
    total = cube.total_kpis(wh.dim_date, wh.dim_buyer, wh.fact)
    plain = M.total_kpis(v["vw_sales_daily"], wh.dim_buyer, v["vw_churn_summary"],
                         V.item_metrics(wh.dim_item, wh.fact), v["vw_promo_revenue_daily"], v["vw_return_rates_item"])
    assert total.dtypes == plain.dtypes and total.first() == plain.first()
    assert _scans(total, "final_revenue") == 1
    rows = cube.exec_kpis(wh.dim_date, wh.fact)
    old = M.exec_kpis(wh.dim_date, v["vw_sales_daily"], v["vw_clv_per_buyer"])
    assert rows.dtypes == old.dtypes and sorted(rows.collect(), key=str) == sorted(old.collect(), key=str)
    assert _scans(rows, "final_revenue") == 1


def test_kpis_of_an_empty_fact(spark):
    wh = catalog.messy_wh(spark, SF)
    row = cube.total_kpis(wh.dim_date, wh.dim_buyer, wh.fact.limit(0)).first()
    assert row.total_buyers > 0 and row.total_revenue is None and row.churned_buyers_30d is None
    assert all(r.orders_7d in (None, 0) for r in cube.exec_kpis(wh.dim_date, wh.fact.limit(0)).collect())


def test_constraints_scan_the_fact_once(spark):
    wh = catalog.messy_wh(spark, SF)
    report = constraint_report(wh.dim_date, wh.dim_item, wh.dim_buyer, wh.fact)
    assert _scans(report, "sales_tax") == 1
    few = constraint_report(wh.dim_date, wh.dim_item.where("item_key > 3"), wh.dim_buyer,
                            wh.fact.withColumn("buyer_key", F.when(F.col("buyer_key") > 5, F.col("buyer_key"))))
    got = {(r.table_name, r.constraint_name): r.violations for r in few.collect()}
    assert len(got) == 41
    assert got["fact_sales", "fk_item_key"] == wh.fact.where("item_key <= 3").count() > 0
    assert got["fact_sales", "fk_buyer_key"] == got["fact_sales", "not_null_buyer_key"] == wh.fact.where("buyer_key <= 5").count()


# -- A19, A10 -----------------------------------------------------------------

def test_item_attributes_in_one_pass(spark, tmp_path):
    rows = [("c1", None, "n", "b  B", "v", 1), ("c1", 9, "m", " B b", "v", 3), ("c1", 4, "m", "x", None, 2), ("c2", None, "q", "q", "q", 4),
            (None, 1, "n", "n", "n", 5), ("c3", 7, None, None, None, 6), ("c4", 2, "z", "z", "z", 8), ("c4", 3, "a", "a", "a", 7)]
    df = spark.createDataFrame(rows, "item_code string, item_id long, item_name string, category string, version string, _seq long")
    df.write.parquet(str(tmp_path / "rec"))
    df = spark.read.parquet(str(tmp_path / "rec"))
    got = item_attributes(df)
    assert sorted(map(tuple, got.collect())) == [
        ("c1", 4, "m", "B B", "v"), ("c3", 7, None, None, None), ("c4", 3, "a", "A", "a")]
    assert _scans(got, "item_name") == 1
    assert dict(got.dtypes)["item_id"] == "bigint"
    names = {r.item_code: r.item_name for r in most_frequent(df, "item_code", ["item_name"]).collect()}
    assert names["c1"] == "m" and names["c4"] == "a"


def test_file_order_does_not_rest_on_the_splits(spark, tmp_path):
    path = tmp_path / "long.csv"
    lines = [",".join(DEFAULT_COLUMN_MAP.values())]
    n = 4000
    for i in range(n):
        lines.append(f"Lamp,home,A,L-{i % 50},{i + 1},9,{i},3/4/2021,1,10,0,0,10,1,11,0,1")
    path.write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = load_raw_data(spark, SourceConfig(path=str(path)))
        starts = df.select("_seq.b").distinct().count()
        in_order = [r.transaction_id for r in df.orderBy("_seq").collect()]
        first = {r.item_code: r.item_id for r in item_attributes(df).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert starts > 3
    assert in_order == list(range(n))
    assert first == {f"L-{i}": i + 1 for i in range(50)}


# -- S9, S10, E14 -------------------------------------------------------------

def test_counts_of_a_run_come_with_its_writes(spark, tmp_path):
    rows = [{"transaction_id": str(i)} for i in range(8)] + [
        {"item_code": "", "transaction_id": "20"}, {"buyer_id": "x", "transaction_id": "21"},
        {"item_code": "L-9", "item_id": "", "transaction_id": "22"}]
    cfg = _land(spark, str(tmp_path / "raw"), rows)
    dry = run_pipeline(spark, load_raw_data(spark, cfg.source), str(tmp_path / "dry"),
                       EtlConfig(source=cfg.source, dry_run=True))
    want = {"n_rows": 11, "n_valid": 11, "n_rejected": 0, "drop_rate": 0.0, "null_buyer_id_rows": 1, "null_item_code_rows": 1,
            "items_without_id": 1, "dim_date_rows": 1, "dim_item_rows": 1, "dim_buyer_rows": 1}
    assert dry.counts == want and dry.warehouse_dir is None
    wet = _load(spark, cfg, str(tmp_path / "wet"))
    assert {k: wet.counts[k] for k in want} == want and wet.counts["n_orphans"] == 3


def test_a_copy_of_a_file_is_the_same_load_by_content(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = [{"transaction_id": str(i)} for i in range(5)]
    for name in ("one", "copy"):
        cfg = _land(spark, str(tmp_path / name), rows)
        _load(spark, EtlConfig(source=cfg.source, load_id_from="content"), out)
    assert read_warehouse(spark, f"{out}/warehouse").fact.count() == 5


def test_a_calendar_needs_a_date(spark, tmp_path):
    cfg = _land(spark, str(tmp_path / "raw"), [{"date": "x"}])
    with pytest.raises(ValueError, match="no date"):
        _load(spark, cfg, str(tmp_path / "out"))


def test_entry_survives_a_missing_library(monkeypatch):
    def fail(name):
        raise ImportError(name)

    monkeypatch.setattr(E, "import_module", fail)
    assert set(E.queries()) == set(catalog.QUERIES)
