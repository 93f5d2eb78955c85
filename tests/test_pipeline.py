"""End-to-end run with file sinks (E18, S5–S9) and the driver contract."""

import os

from pyspark.sql import functions as F

from salesmart.config import EtlConfig, SourceConfig
from salesmart.plans.warehouse import read_warehouse, run_pipeline
from salesmart.sources.raw import load_raw_data
from salesmart.sources.tables import raw_sales_text

SF = "/root/testdata/sf0.001"


def _raw_file(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_sales_text(spark, SF).drop("_seq").write.option("header", True).csv(path)
    return path


def test_dry_run_then_runs_are_idempotent_for_dimensions(spark, tmp_path):
    raw_path = _raw_file(spark, tmp_path)
    out = str(tmp_path / "out")
    cfg = EtlConfig(source=SourceConfig(path=raw_path), dry_run=True)
    res = run_pipeline(spark, load_raw_data(spark, cfg.source), out, cfg)
    assert res.warehouse_dir is None
    for name in ("orders_cleaned", "dim_date", "dim_item", "dim_buyer", "validated_fact_data",
                 "rejected_rows"):
        assert os.path.isdir(os.path.join(res.processed_dir, name)), name
    assert not os.path.exists(os.path.join(out, "warehouse"))
    assert res.counts["n_rejected"] == 18 and res.counts["n_rows"] == 6000
    assert res.counts["null_buyer_id_rows"] == 0

    cfg = EtlConfig(source=SourceConfig(path=raw_path))
    res = run_pipeline(spark, load_raw_data(spark, cfg.source), out, cfg)
    assert res.counts["n_orphans"] == 12  # null transaction ids and impossible dates
    wh1 = read_warehouse(spark, f"{out}/warehouse")
    sizes = [wh1.dim_date.count(), wh1.dim_item.count(), wh1.dim_buyer.count(), wh1.fact.count()]
    run_pipeline(spark, load_raw_data(spark, cfg.source), out, cfg)
    wh2 = read_warehouse(spark, f"{out}/warehouse")
    assert [wh2.dim_date.count(), wh2.dim_item.count(), wh2.dim_buyer.count(),
            wh2.fact.count()] == sizes
    assert wh2.fact.where(F.col("transaction_id").isNull()).count() == 0
    assert os.path.isdir(os.path.join(out, "processed", "fact_orphans"))


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert "sales_daily" in E.oracle_sql()


def test_csv_outputs(spark, tmp_path):
    raw_path = _raw_file(spark, tmp_path)
    out = str(tmp_path / "out_csv")
    cfg = EtlConfig(source=SourceConfig(path=raw_path), output_format="csv")
    res = run_pipeline(spark, load_raw_data(spark, cfg.source), out, cfg)
    rejected = spark.read.option("header", True).csv(f"{res.processed_dir}/rejected_rows")
    assert rejected.count() == 18
    assert "reject_reasons" in rejected.columns
    dims = spark.read.option("header", True).csv(f"{res.processed_dir}/dim_buyer")
    wh = read_warehouse(spark, res.warehouse_dir)
    assert dims.count() == wh.dim_buyer.count()
    assert wh.fact.count() == 6000 - 18 - 12


def test_fact_partitioned_by_day_prunes_through_calendar(spark, tmp_path):
    from salesmart.plans import views as V

    raw_path = _raw_file(spark, tmp_path)
    plain_cfg = EtlConfig(source=SourceConfig(path=raw_path))
    part_cfg = EtlConfig(source=SourceConfig(path=raw_path), partition_fact_by_date=True)
    plain = run_pipeline(spark, load_raw_data(spark, plain_cfg.source), str(tmp_path / "a"),
                         plain_cfg)
    part = run_pipeline(spark, load_raw_data(spark, part_cfg.source), str(tmp_path / "b"),
                        part_cfg)
    wa, wb = read_warehouse(spark, plain.warehouse_dir), read_warehouse(spark, part.warehouse_dir)
    assert wa.fact.columns == wb.fact.columns
    da = V.sales_daily(wa.dim_date, wa.fact).where("year_month = '1998-02'")
    db = V.sales_daily(wb.dim_date, wb.fact).where("year_month = '1998-02'")
    assert sorted(da.collect()) == sorted(db.collect())
    ra = V.return_rates_item(wa.dim_date, wa.dim_item, wa.fact).where("year_month = '1998-02'")
    rb = V.return_rates_item(wb.dim_date, wb.dim_item, wb.fact).where("year_month = '1998-02'")
    assert sorted(ra.collect()) == sorted(rb.collect())
    plans = {}
    for name, df in (("daily", db), ("returns", rb)):
        df.collect()
        plans[name] = df._jdf.queryExecution().executedPlan().toString().lower()
    # The month filter moves below the join into the calendar, so the fact
    # scan is pruned by day.  The return-rate view keeps a window over all of
    # an item's months, which a month filter must not cross: no pruning there.
    assert "dynamicpruning" in plans["daily"]


def _csv(spark, path, rows, **changes):
    """A small order file; ``changes`` replaces cells of its first row."""
    from salesmart.config import DEFAULT_COLUMN_MAP

    base = {"item_name": "Lamp", "category": "home", "version": "A", "item_code": "L-1", "item_id": "5",
            "buyer_id": "9", "transaction_id": "1", "date": "3/4/2021", "final_quantity": "1",
            "total_revenue": "10.00", "price_reductions": "0", "refunds": "0", "final_revenue": "10.00",
            "sales_tax": "1.00", "overall_revenue": "11.00", "refunded_item_count": "0",
            "purchased_item_count": "1"}
    made = []
    for i in range(rows):
        row = base | {"transaction_id": str(i + 1), "item_code": f"L-{i % 2}"}
        made.append(row | (changes if i == 0 else {}))
    names = list(DEFAULT_COLUMN_MAP)
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in made],
                               ", ".join(f"`{DEFAULT_COLUMN_MAP[n]}` string" for n in names))
    df.coalesce(1).write.option("header", True).csv(path)
    return EtlConfig(source=SourceConfig(path=path))


def test_another_file_adds_and_the_same_file_replaces(spark, tmp_path):
    out = str(tmp_path / "out")
    one, two = _csv(spark, str(tmp_path / "one"), 4), _csv(spark, str(tmp_path / "two"), 3, date="9/4/2021")
    for cfg in (one, two, two):
        run_pipeline(spark, load_raw_data(spark, cfg.source), out, cfg)
    wh = read_warehouse(spark, f"{out}/warehouse")
    assert wh.fact.count() == 7
    assert wh.dim_item.count() == 2 and wh.dim_buyer.count() == 1


def test_a_load_that_breaks_a_rule_leaves_the_warehouse_as_it_was(spark, tmp_path):
    import pytest

    from salesmart.config import CanonicalizeConfig

    out = str(tmp_path / "out")
    good = _csv(spark, str(tmp_path / "good"), 4)
    run_pipeline(spark, load_raw_data(spark, good.source), out, good)
    # 0.015 off passes the tolerance of 0.02 but not the warehouse's rule.
    off = _csv(spark, str(tmp_path / "off"), 4, final_revenue="10.015", overall_revenue="11.015")
    with pytest.raises(ValueError, match="ck_revenue_1"):
        run_pipeline(spark, load_raw_data(spark, off.source), out, off)
    # Two versions of one item, passed through: a lookup would double its rows.
    twice = _csv(spark, str(tmp_path / "twice"), 4, version="B")
    through = EtlConfig(source=twice.source, canonicalize=CanonicalizeConfig(item_attributes="distinct"))
    with pytest.raises(ValueError, match="not unique"):
        run_pipeline(spark, load_raw_data(spark, twice.source), out, through)
    wh = read_warehouse(spark, f"{out}/warehouse")
    assert (wh.fact.count(), wh.dim_date.count(), wh.dim_item.count()) == (4, 1, 2)


def test_columns_are_bound_by_header_name(spark, tmp_path):
    import pytest

    path = str(tmp_path / "mixed")
    cfg = _csv(spark, str(tmp_path / "plain"), 2)
    df = spark.read.option("header", True).csv(cfg.source.path).withColumn("Note", F.lit("z"))
    df.select(*reversed(df.columns)).coalesce(1).write.option("header", True).csv(path)
    rows = load_raw_data(spark, SourceConfig(path=path)).drop("_seq")
    same = load_raw_data(spark, cfg.source).drop("_seq")
    assert sorted(rows.collect()) == sorted(same.collect())
    df.drop("Note", df.columns[0]).coalesce(1).write.option("header", True).csv(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="not in the file"):
        load_raw_data(spark, SourceConfig(path=str(tmp_path / "short")))
