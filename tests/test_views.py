"""Views and measures on a hand-made warehouse (FIXTURES §C edge cases)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesmart.operators.constraints import constraint_report
from salesmart.operators.dims import build_date_dimension
from salesmart.plans import measures as M
from salesmart.plans import views as V

D0 = dt.date(2019, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def wh(spark):
    dim_date = build_date_dimension(spark.createDataFrame([(day(0),), (day(40),)], "date date"))
    dim_item = spark.createDataFrame(
        [(1, "A", 1, "a", "Cat1", "v"), (2, "B", 2, "b", "Cat1", "v"),
         (3, "C", 3, "c", None, "v"), (4, "D", 4, "d", "Cat2", "v")],
        "item_key bigint, item_code string, item_id bigint, item_name string, category string, "
        "version string")
    dim_buyer = spark.createDataFrame([(1, 11), (2, 22), (3, 33), (4, 44)],
                                      "buyer_key bigint, buyer_id bigint")
    m = lambda v: Decimal(str(v))
    # date_key, item_key, buyer_key, txn, fq, total, disc, refunds, final, tax, overall, rq, pq
    rows = [
        (1, 1, 1, 100, 2, m(100), m(-10), m(0), m(90), m(9), m(99), 0, 2),
        (1, 2, 1, 100, 1, m(50), m(0), m(0), m(50), m(5), m(55), 0, 1),
        (10, 1, 2, 101, 0, m(100), m(0), m(-100), m(0), m(0), m(0), -1, 1),
        (41, 2, 2, 102, 1, m(50), m(0), m(0), m(50), m(5), m(55), 0, 1),
        (41, 3, 3, 103, -1, m(0), m(0), m(-20), m(-20), m(0), m(-20), -1, 0),
        (11, 4, 3, 104, 1, m(90), m(0), m(0), m(90), m(0), m(90), 0, 1),
    ]
    fact = spark.createDataFrame(
        rows, "date_key int, item_key bigint, buyer_key bigint, transaction_id bigint, "
              "final_quantity int, total_revenue decimal(14,2), price_reductions decimal(14,2), "
              "refunds decimal(14,2), final_revenue decimal(14,2), sales_tax decimal(14,2), "
              "overall_revenue decimal(14,2), refunded_item_count int, purchased_item_count int")
    return dim_date, dim_item, dim_buyer, fact


def test_vw_date_attributes(spark, wh):
    r = V.vw_date(wh[0]).where("full_date = DATE'2019-01-31'").first()
    assert (r.month_start, r.month_end, r.year_month) == (D0, dt.date(2019, 1, 31), "2019-01")
    assert (r.is_month_start, r.is_month_end, r.day_of_week) == (False, True, 4)
    assert (r.day_name_short, r.day_name, r.month_name, r.week_of_year) == ("Thu", "Thursday", "Jan", 5)


def test_sales_daily_fills_days_without_sales(spark, wh):
    rows = {r.full_date: r for r in V.sales_daily(wh[0], wh[3]).collect()}
    assert len(rows) == 41
    assert rows[day(1)].daily_revenue == 0.0 and rows[day(1)].daily_orders == 0
    assert rows[day(0)].daily_revenue == 140.0 and rows[day(0)].daily_orders == 1


def test_clv_and_churn(spark, wh):
    clv = {r.buyer_id: r for r in V.clv_per_buyer(wh[0], wh[2], wh[3]).collect()}
    assert clv[44].is_never_purchased and clv[44].total_orders == 0
    assert clv[44].avg_order_value is None and clv[44].total_revenue == 0.0
    # as-of = 2019-02-10; buyer 11 last bought 2019-01-01 (40 days), buyer 33 on as-of
    assert clv[11].days_since_last_purchase == 40 and not clv[11].is_active_30d
    assert clv[33].days_since_last_purchase == 0 and clv[33].is_active_30d
    assert clv[22].total_orders == 2 and clv[22].avg_order_value == 25.0
    churn = {r.buyer_id: r for r in V.churn_summary(V.clv_per_buyer(wh[0], wh[2], wh[3])).collect()}
    assert churn[11].is_churned_30d and not churn[11].is_churned_60d
    assert not churn[44].is_churned_30d and churn[44].is_never_purchased


def test_return_rates(spark, wh):
    rri = {(r.item_code, r.month): r for r in V.return_rates_item(wh[0], wh[1], wh[3]).collect()}
    a = rri[("A", 1)]
    assert (a.purchased_qty, a.refunded_qty, a.return_rate) == (3, 1, 1 / 3)
    c = rri[("C", 2)]
    assert c.return_rate is None and c.item_return_rate_overall is None  # refunds only
    rrc = {(r.category, r.month): r for r in V.return_rates_category(wh[0], wh[1], wh[3]).collect()}
    assert (None, 2) in rrc and rrc[(None, 2)].refunded_qty == 1


def test_item_performance_ranks_and_shares(spark, wh):
    perf = {r.item_code: r for r in V.item_performance(wh[1], wh[3]).collect()}
    # net revenue: A 90, B 100, C -20, D 90 -> ranks B1, A2, D2, C4
    assert {k: v.revenue_rank for k, v in perf.items()} == {"B": 1, "A": 2, "D": 2, "C": 4}
    assert perf["A"].revenue_rank_in_category == 2 and perf["D"].revenue_rank_in_category == 1
    assert perf["A"].discount_share == pytest.approx(10 / 90)
    assert perf["C"].discount_share == 0.0


def test_cohorts_and_promo(spark, wh):
    coh = {(r.cohort_month.month, r.activity_month.month): r
           for r in V.churn_cohorts(wh[0], wh[3]).collect()}
    assert coh[(1, 1)].cohort_size == 3 and coh[(1, 2)].active_buyers == 2
    assert coh[(1, 2)].retention_rate == pytest.approx(2 / 3)
    promo = V.promo_revenue_daily(wh[0], wh[3])
    assert promo.count() == 82
    p0 = {r.is_promo: r for r in promo.where(f"full_date = DATE'{D0}'").collect()}
    assert p0[True].revenue == 90.0 and p0[False].revenue == 50.0
    assert p0[True].orders == 1 and p0[False].orders == 1


def test_rolling_and_active_buyer_windows(spark, wh):
    daily = V.sales_daily(wh[0], wh[3])
    roll = {r.full_date: r for r in M.rolling_7d(daily).collect()}
    assert roll[day(0)].revenue_prior_7d is None          # empty frame
    assert roll[day(6)].revenue_7d == 140.0 and roll[day(7)].revenue_7d == 0.0
    assert roll[day(13)].revenue_prior_7d == 140.0 and roll[day(13)].revenue_7d == 90.0
    assert roll[day(14)].revenue_prior_7d == 0.0
    assert roll[day(9)].aov_7d == 0.0 and roll[day(7)].aov_7d is None
    clv = V.clv_per_buyer(wh[0], wh[2], wh[3])
    act = {r.full_date: r for r in M.active_buyers(wh[0], clv).collect()}
    # last purchases: buyer 11 on day 0, 22 and 33 on day 40
    assert act[day(7)].active_buyers_7d == 1 and act[day(8)].active_buyers_7d is None
    assert act[day(14)].active_buyers_prior_7d == 1  # window [day0, day7]


def test_rolling_totals_end_on_the_last_day_of_their_context(spark, wh):
    daily, clv = V.sales_daily(wh[0], wh[3]), V.clv_per_buyer(wh[0], wh[2], wh[3])
    got = {r.year_month: r for r in M.rolling_totals(wh[0], daily, clv).collect()}
    assert {k: r.full_date for k, r in got.items()} == {
        "2019-01": day(30), "2019-02": day(40), None: day(40)}
    assert got[None].revenue_7d == 30.0 and got[None].orders_7d == 2 and got[None].aov_7d == 15.0
    assert got["2019-01"].revenue_7d == 0.0 and got["2019-01"].aov_7d is None
    assert got[None].active_buyers_7d == 2 and got["2019-01"].active_buyers_7d is None
    cut = M.rolling_totals(wh[0], daily, clv, where=F.col("full_date") <= F.lit(day(13)))
    assert {r.year_month: r.revenue_7d for r in cut.collect()} == {"2019-01": 90.0, None: 90.0}


def test_buyer_view_follows_its_tables_and_stores_nothing(spark, wh, monkeypatch):
    monkeypatch.setattr("salesmart.session.materialize", None)  # a call would fail
    later = wh[3].where("date_key <= 11")
    rows = {r.buyer_id: r for r in V.clv_per_buyer(wh[0], wh[2], later).collect()}
    assert rows[11].days_since_last_purchase == 10 and rows[44].is_never_purchased


def test_measure_totals(spark, wh):
    dim_date, dim_item, dim_buyer, fact = wh
    clv = V.clv_per_buyer(dim_date, dim_buyer, fact)
    t = M.total_kpis(V.sales_daily(dim_date, fact), dim_buyer, V.churn_summary(clv),
                     V.item_performance(dim_item, fact), V.promo_revenue_daily(dim_date, fact),
                     V.return_rates_item(dim_date, dim_item, fact)).first()
    assert t.total_revenue == 260.0 and t.total_orders == 5 and t.total_buyers == 4
    assert t.churned_buyers_30d == 1 and t.churn_rate_30d == 0.25
    assert t.promo_revenue == 90.0 and t.promo_share == pytest.approx(90 / 260)
    split = {r.status: r.n_buyers for r in M.buyer_status_split(V.churn_summary(clv)).collect()}
    assert split == {"active": 2, "churned": 1, "never_purchased": 1}
    hist = M.clv_histogram(clv, 10).collect()
    assert sum(r.n_buyers for r in hist) == 4


def test_generic_measure_filter_context(spark, wh):
    dim_date, dim_item, _, fact = wh
    daily = V.sales_daily(dim_date, fact)
    whole = M.measure(daily, M.sales_measures()).first()
    assert (whole.total_revenue, whole.total_orders) == (260.0, 5)
    feb = M.measure(daily, M.sales_measures(), by=["year_month"],
                    where=daily.year_month == "2019-02").collect()
    assert [(r.year_month, r.total_revenue, r.total_orders) for r in feb] == [("2019-02", 30.0, 2)]
    rr = M.measure(V.return_rates_item(dim_date, dim_item, fact), M.return_measures(),
                   by=["category"])
    by_cat = {r.category: r for r in rr.collect()}
    assert by_cat["Cat1"].return_rate == 1 / 5 and by_cat[None].return_rate is None
    pm = M.measure(V.promo_revenue_daily(dim_date, fact), M.promo_measures()).first()
    assert pm.promo_revenue == 90.0 and pm.promo_share == pytest.approx(90 / 260)


def test_constraint_report_counts_every_broken_row(spark, wh):
    dim_date, dim_item, dim_buyer, fact = wh
    stray = fact.where("transaction_id = 100").withColumns({
        "item_key": F.lit(99).cast("bigint"), "buyer_key": F.lit(None).cast("bigint"),
        "final_quantity": F.lit(7), "refunded_item_count": F.lit(1)})
    twice = dim_buyer.unionByName(dim_buyer.where("buyer_id = 44"))
    got = {(r.table_name, r.constraint_name): r.violations
           for r in constraint_report(dim_date, dim_item, twice, fact.unionByName(stray)).collect()}
    broken = {k: v for k, v in got.items() if v}
    assert broken == {
        ("dim_buyer", "unique_buyer_id"): 1, ("dim_buyer", "unique_buyer_key"): 1,
        ("fact_sales", "fk_item_key"): 2, ("fact_sales", "fk_buyer_key"): 2,
        ("fact_sales", "not_null_buyer_key"): 2, ("fact_sales", "ck_qty"): 2,
        ("fact_sales", "ck_refunded"): 2}
