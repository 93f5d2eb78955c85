"""Validation checks, error-rate gate, split, fact build, constraints."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.config import ValidationConfig
from salesmart.operators.constraints import assert_constraints, constraint_report
from salesmart.operators.fact import FACT_COLUMNS, lookup_keys, split_fact
from salesmart.operators.validate import apply_validations, check_failures, drop_rate, flag_rows

SCHEMA = ("total_revenue decimal(18,4), price_reductions decimal(18,4), refunds decimal(18,4), "
          "final_revenue decimal(18,4), sales_tax decimal(18,4), overall_revenue decimal(18,4), "
          "final_quantity int, purchased_item_count int, refunded_item_count int")


def _df(spark, rows):
    conv = [tuple(Decimal(str(v)) if i < 6 and v is not None else v for i, v in enumerate(r))
            for r in rows]
    return spark.createDataFrame(conv, SCHEMA)


def test_rows_that_break_rules_are_split_off_with_reasons(spark):
    df = _df(spark, [("59.90", "-4.90", "-20", 35, "2.80", "37.80", 3, 4, -1),
                     ("12.50", 0, 0, "12.50", 1, "13.50", 4, 2, 1)])
    valid, rejected = apply_validations(df, ValidationConfig(tolerance=0.01, max_error_rate=0.5))
    assert valid.count() == 1 and rejected.count() == 1
    assert valid.first().total_revenue == Decimal("59.90")
    assert sorted(rejected.first().reject_reasons) == ["quantity_balance", "refunded_nonpositive"]


def test_too_many_rejected_rows_stop_the_load(spark):
    good = (8, 0, 0, 8, 0, 8, 1, 1, 0)
    df = _df(spark, [good] * 3 + [(8, 0, 0, 9, 0, 9, 1, 1, 0)])
    with pytest.raises(ValueError):
        apply_validations(df, ValidationConfig(tolerance=0.01, max_error_rate=0.1))


def test_tolerance_boundary_and_nulls(spark):
    df = _df(spark, [
        (100, 0, 0, "100.02", 0, "100.02", 1, 1, 0),  # difference == tolerance -> valid
        (100, 0, 0, "100.03", 0, "100.03", 1, 1, 0),  # above -> rejected
        (100, 0, None, 100, 0, 100, 1, 1, 0),          # null input -> rejected
    ])
    flagged = flag_rows(df, ValidationConfig(tolerance=0.02)).collect()
    assert [r.is_valid for r in flagged] == [True, False, False]
    stats = drop_rate(flag_rows(df)).first()
    assert (stats.n_rows, stats.n_valid, stats.n_rejected) == (3, 1, 2)
    fails = {r.check_name: r.n_failed for r in check_failures(df).collect()}
    assert fails == {"revenue_balance": 2, "overall_balance": 0, "quantity_balance": 0,
                     "refunded_nonpositive": 0}


def test_rate_equal_to_max_passes_and_empty_is_zero(spark):
    df = _df(spark, [(100, 0, 0, 100, 0, 100, 1, 1, 0), (100, 0, 0, 100, 0, 100, 2, 1, 0)])
    valid, _ = apply_validations(df, ValidationConfig(max_error_rate=0.5))
    assert valid.count() == 1
    empty = _df(spark, [])
    assert drop_rate(flag_rows(empty)).first().drop_rate == 0.0


def test_disabled_checks_are_skipped(spark):
    df = _df(spark, [(100, 0, 0, 100, 0, 100, 2, 1, 0)])
    cfg = ValidationConfig(checks={"quantity_balance": False, "revenue_balance": True})
    assert flag_rows(df, cfg).first().is_valid


def _sales(spark):
    return spark.createDataFrame(
        [(dt.date(2022, 6, 30), "K1", 51, 7001, 3, Decimal(45), Decimal(-5), Decimal(0), Decimal(40),
          Decimal(4), Decimal(44), 0, 3),
         (dt.date(2022, 7, 1), "K2", 52, 7002, 1, Decimal(18), Decimal(0), Decimal(-9), Decimal(9),
          Decimal(1), Decimal(10), -1, 2),
         (dt.date(2022, 8, 1), "K3", 52, None, 1, Decimal(7), Decimal(0), Decimal(0), Decimal(7),
          Decimal(0), Decimal(7), 0, 1)],
        "date date, item_code string, buyer_id bigint, transaction_id bigint, final_quantity int, "
        "total_revenue decimal(18,4), price_reductions decimal(18,4), refunds decimal(18,4), "
        "final_revenue decimal(18,4), sales_tax decimal(18,4), overall_revenue decimal(18,4), "
        "refunded_item_count int, purchased_item_count int",
    )


def _dims(spark):
    dd = spark.createDataFrame([(1, dt.date(2022, 6, 30)), (2, dt.date(2022, 7, 1))],
                               "date_key int, full_date date")
    di = spark.createDataFrame([(10, "K1"), (20, "K2")], "item_key bigint, item_code string")
    db = spark.createDataFrame([(100, 51), (200, 52)], "buyer_key bigint, buyer_id bigint")
    return dd, di, db


def test_fact_load_keys_and_orphans(spark):
    dd, di, db = _dims(spark)
    fact, orphans = split_fact(lookup_keys(_sales(spark), dd, di, db))
    assert fact.columns[:4] == ["date_key", "item_key", "buyer_key", "transaction_id"]
    assert tuple(fact.columns) == FACT_COLUMNS
    assert fact.count() == 2
    assert dict(fact.dtypes)["total_revenue"] == "decimal(14,2)"
    o = orphans.first()
    assert sorted(o.missing) == ["date_key", "item_key", "transaction_id"]


def test_constraint_report_counts_violations(spark):
    dd, di, db = _dims(spark)
    dd = dd.select("*", F.year("full_date").alias("year"), F.lit(3).alias("quarter"),
                   F.lit(7).alias("month"), F.lit(2).alias("day"), F.lit(False).alias("is_weekend"))
    di = di.select("*", F.lit(1).cast("bigint").alias("item_id"), F.lit("n").alias("item_name"),
                   F.lit("c").alias("category"), F.lit("v").alias("version"))
    dd_, di_, db_ = _dims(spark)
    fact, _ = split_fact(lookup_keys(_sales(spark), dd_, di_, db_))
    bad = fact.unionByName(fact.limit(1).withColumn("refunded_item_count", F.lit(1))
                           .withColumn("item_key", F.lit(99).cast("bigint")))
    rep = {(r.table_name, r.constraint_name): r.violations
           for r in constraint_report(dd, di, db, bad).collect()}
    assert rep[("fact_sales", "ck_refunded")] == 1
    assert rep[("fact_sales", "fk_item_key")] == 1
    assert rep[("dim_item", "unique_item_code")] == 0
    assert sum(rep.values()) >= 2
    with pytest.raises(ValueError):
        assert_constraints(constraint_report(dd, di, db, bad))
    assert_constraints(constraint_report(dd, di, db, fact))
