"""Measures (M1–M22) and dashboard derivations.

A BI measure is evaluated per visual cell; here each function returns the
measure for the natural cells of its dashboard visual (per calendar day, per
item, per category, per month) or for the whole model (one row).

Rolling windows run over the gap-free daily view: one row per calendar day,
so the frame is a RANGE of day numbers and the window input is bounded by
the date span (a single ordered partition of a few thousand rows), never by
the fact size.

Money measures are sums of cent amounts; they are rounded back to cents so
that the floating-point summation order cannot show.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.numeric import ratio
from salesmart.plans.views import vw_date


def _money(c: Column) -> Column:
    return F.round(c, 2)


def _blank_if_zero(c: Column) -> Column:
    """DISTINCTCOUNT / COUNTROWS over an empty filter is BLANK, not 0."""
    return F.when(c > 0, c)


def _day_range(lo: int, hi: int) -> Window:
    return Window.orderBy(F.unix_date("full_date")).rangeBetween(lo, hi)


def measure(view: DataFrame, measures: dict[str, Column],
            by: Sequence[str | Column] = (), where: Column | None = None) -> DataFrame:
    """Evaluate measures in a filter context (§2.10): ``where`` is the
    slicer / CALCULATE filter, ``by`` the visual's cells; one row per cell
    (one row in total without ``by``).  Measures are aggregate Columns and
    may combine aggregates (a ratio of sums)."""
    df = view if where is None else view.where(where)
    aggs = [expr.alias(name) for name, expr in measures.items()]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


# Core measures, by the view they are defined on (functions: a Column needs
# an active session).
def sales_measures() -> dict[str, Column]:
    """M1, M4 over the daily sales view."""
    return {
        "total_revenue": _money(F.sum("daily_revenue")),
        "total_orders": F.sum("daily_orders"),
    }


def return_measures() -> dict[str, Column]:
    """M14–M16 / M17–M19 over the item or category return-rate view."""
    return {
        "purchased_qty": F.sum("purchased_qty"),
        "returned_qty": F.sum("refunded_qty"),
        "return_rate": ratio(F.sum("refunded_qty"), F.sum("purchased_qty")),
    }


def promo_measures() -> dict[str, Column]:
    """M20–M22 over the promo view."""
    promo = _money(F.sum(F.when(F.col("is_promo"), F.col("revenue"))))
    non_promo = _money(F.sum(F.when(~F.col("is_promo"), F.col("revenue"))))
    return {
        "promo_revenue": promo,
        "non_promo_revenue": non_promo,
        "promo_share": ratio(promo, promo + non_promo),
    }


def active_windows(n: str) -> list[Column]:
    """M10, M11 over a gap-free daily frame that counts the buyers last seen
    on each day: the 8 days up to the day, and the 8 that end a week before."""
    cur, prior = _day_range(-7, 0), _day_range(-14, -7)
    return [_blank_if_zero(F.sum(n).over(cur)).alias("active_buyers_7d"),
            _blank_if_zero(F.sum(n).over(prior)).alias("active_buyers_prior_7d")]


def rolling_7d(sales_daily: DataFrame, more: Sequence[Column] = ()) -> DataFrame:
    """M2, M3, M5, M6, M7 per calendar day (and further daily windows).

    Current window = the 7 days ending on the day; prior window = the 7 days
    ending 7 days earlier.  An empty frame (before the calendar starts) is
    NULL; AOV = revenue / orders, NULL on zero orders.
    """
    cur, prior = _day_range(-6, 0), _day_range(-13, -7)
    out = sales_daily.select(
        "full_date",
        _money(F.sum("daily_revenue").over(cur)).alias("revenue_7d"),
        _money(F.sum("daily_revenue").over(prior)).alias("revenue_prior_7d"),
        F.sum("daily_orders").over(cur).alias("orders_7d"),
        F.sum("daily_orders").over(prior).alias("orders_prior_7d"),
        *more,
    )
    return out.select(
        "*",
        ratio("revenue_7d", "orders_7d").alias("aov_7d"),
        ratio("revenue_prior_7d", "orders_prior_7d").alias("aov_prior_7d"),
    )


def active_buyers(dim_date: DataFrame, clv: DataFrame) -> DataFrame:
    """M10, M11 per calendar day D: buyers whose last purchase falls in
    [D-7, D] (8 days) and in [D-14, D-7].

    Buyers are counted per last-purchase day first (one row per day), then
    summed over RANGE frames of the calendar."""
    per_day = clv.where(F.col("last_purchase_date").isNotNull()).groupBy(
        F.col("last_purchase_date").alias("full_date")
    ).agg(F.count(F.lit(1)).alias("n"))
    spine = dim_date.select("full_date").join(per_day, "full_date", "left").fillna(0, ["n"])
    return spine.select("full_date", *active_windows("n"))


def exec_kpis(dim_date: DataFrame, sales_daily: DataFrame, clv: DataFrame) -> DataFrame:
    """B1: executive KPI row per day — revenue, orders, AOV and active
    buyers against the prior period, change = current / prior - 1."""
    return kpi_changes(rolling_7d(sales_daily).join(active_buyers(dim_date, clv), "full_date"))


def kpi_changes(kpis: DataFrame) -> DataFrame:
    """Current and prior values of the rolling measures with their change."""
    change = lambda cur, pri: (ratio(cur, pri) - 1).alias(f"{cur}_change")
    return kpis.select(
        "full_date", "revenue_7d", "revenue_prior_7d", change("revenue_7d", "revenue_prior_7d"),
        "orders_7d", "orders_prior_7d", change("orders_7d", "orders_prior_7d"),
        "aov_7d", "aov_prior_7d", change("aov_7d", "aov_prior_7d"),
        "active_buyers_7d", "active_buyers_prior_7d",
        change("active_buyers_7d", "active_buyers_prior_7d"),
    )


def rolling_totals(dim_date: DataFrame, sales_daily: DataFrame, clv: DataFrame,
                   by: str = "year_month", where: Column | None = None) -> DataFrame:
    """M2, M3, M5–M7, M10, M11 in the context of each calendar period ``by``
    and in total (``by`` NULL): the windows end on the context's last day,
    and reach beyond the period where it is shorter than they are.

    ``where`` is a filter on the calendar (a slicer): it moves the last day,
    but not the days that a window covers."""
    days = vw_date(dim_date) if where is None else vw_date(dim_date).where(where)
    kpis = exec_kpis(dim_date, sales_daily, clv)
    at_end = F.max_by(F.struct(*kpis.columns), "full_date").alias("kpis")
    return (kpis.join(days.select("full_date", by), "full_date")
            .rollup(by).agg(at_end).select(by, "kpis.*"))


def total_kpis(sales_daily: DataFrame, dim_buyer: DataFrame, churn: DataFrame,
               item_perf: DataFrame, promo: DataFrame, returns_item: DataFrame) -> DataFrame:
    """Whole-model values of M1, M4, M8, M9, M12–M16, M20–M22 (one row).

    ``item_perf`` may be V8 or :func:`views.item_metrics` (same
    ``discount_share`` values without the ranking work).

    Each measure is a scalar subquery over its own view — every view is
    aggregated once, in parallel, and no cross join is needed."""
    def scalar(df: DataFrame, expr: Column) -> Column:
        return df.select(expr).scalar()

    one = sales_daily.sparkSession.range(1)
    promo_rev = F.sum(F.when(F.col("is_promo"), F.col("revenue")))
    non_promo_rev = F.sum(F.when(~F.col("is_promo"), F.col("revenue")))
    cols = {
        "total_revenue": scalar(sales_daily, _money(F.sum("daily_revenue"))),
        "total_orders": scalar(sales_daily, F.sum("daily_orders")),
        "discount_share": scalar(item_perf, F.round(F.avg("discount_share"), 9)),
        "total_buyers": scalar(dim_buyer, F.count_distinct("buyer_id")),
        "churned_buyers_30d": scalar(churn, _blank_if_zero(F.count_if("is_churned_30d"))),
        "purchased_qty": scalar(returns_item, F.sum("purchased_qty")),
        "returned_qty": scalar(returns_item, F.sum("refunded_qty")),
        "promo_revenue": scalar(promo, _money(promo_rev)),
        "non_promo_revenue": scalar(promo, _money(non_promo_rev)),
    }
    row = one.select(*[v.alias(k) for k, v in cols.items()])
    return row.select(
        "*",
        ratio("churned_buyers_30d", "total_buyers").alias("churn_rate_30d"),
        ratio("returned_qty", "purchased_qty").alias("return_rate"),
        ratio("promo_revenue", F.col("promo_revenue") + F.col("non_promo_revenue"))
        .alias("promo_share"),
    ).drop("id")


def return_rate_by_item(returns_item: DataFrame) -> DataFrame:
    """M14–M16 per item (sum over the item's months, ratio of sums)."""
    return returns_item.groupBy("item_key", "item_code", "item_name", "category").agg(
        F.sum("purchased_qty").alias("purchased_qty"),
        F.sum("refunded_qty").alias("returned_qty"),
    ).withColumn("return_rate", ratio("returned_qty", "purchased_qty"))


def return_rate_by_category(returns_cat: DataFrame) -> DataFrame:
    """M17–M19 per category."""
    return returns_cat.groupBy("category").agg(
        F.sum("purchased_qty").alias("purchased_qty"),
        F.sum("refunded_qty").alias("returned_qty"),
    ).withColumn("return_rate", ratio("returned_qty", "purchased_qty"))


def promo_share_by_month(promo: DataFrame) -> DataFrame:
    """M20–M22 per calendar month."""
    agg = promo.groupBy("year_month").agg(
        _money(F.sum(F.when(F.col("is_promo"), F.col("revenue")))).alias("promo_revenue"),
        _money(F.sum(F.when(~F.col("is_promo"), F.col("revenue")))).alias("non_promo_revenue"),
    )
    return agg.withColumn(
        "promo_share",
        ratio("promo_revenue", F.col("promo_revenue") + F.col("non_promo_revenue")),
    )


def discount_share_by_category(item_perf: DataFrame) -> DataFrame:
    """M8 per category: unweighted mean of the items' discount shares."""
    return item_perf.groupBy("category").agg(
        F.round(F.avg("discount_share"), 9).alias("discount_share"),
        F.count(F.lit(1)).alias("n_items"),
    )


def churn_rate(dim_buyer: DataFrame, churn: DataFrame) -> DataFrame:
    """M9, M12, M13 (one row); never-purchased buyers are in the
    denominator but never churned."""
    total = dim_buyer.select(F.count_distinct("buyer_id")).scalar()
    churned = churn.agg(F.count_if("is_churned_30d").alias("churned_buyers_30d"))
    return churned.select(
        total.alias("total_buyers"),
        _blank_if_zero(F.col("churned_buyers_30d")).alias("churned_buyers_30d"),
        ratio(_blank_if_zero(F.col("churned_buyers_30d")), total).alias("churn_rate_30d"),
    )


def top_items(item_perf: DataFrame, n: int = 10) -> DataFrame:
    """O2: the items ranked 1..n by revenue (ties at n all kept)."""
    return item_perf.where(F.col("revenue_rank") <= n)


def clv_histogram(clv: DataFrame, bins: int = 10) -> DataFrame:
    """B2: equal-width histogram of buyer lifetime revenue.

    Bounds are scalar subqueries; bin = floor((v - lo) * bins / (hi - lo))
    + 1, the maximum going into the last bin."""
    lo = clv.select(F.min("total_revenue")).scalar()
    hi = clv.select(F.max("total_revenue")).scalar()
    v = F.col("total_revenue")
    raw = F.floor((v - lo) * F.lit(float(bins)) / (hi - lo)).cast("bigint") + 1
    b = F.when(hi == lo, F.lit(1).cast("bigint")).otherwise(F.least(raw, F.lit(bins).cast("bigint")))
    counted = clv.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n_buyers"))
    width = (hi - lo) / F.lit(float(bins))
    return counted.select(
        "bin",
        (lo + (F.col("bin") - 1) * width).alias("bin_low"),
        (lo + F.col("bin") * width).alias("bin_high"),
        "n_buyers",
    )


def buyer_status_split(churn: DataFrame) -> DataFrame:
    """Buyers by status — active (≤ 30 days), churned (> 30 days),
    never purchased."""
    status = (
        F.when(F.col("is_never_purchased"), F.lit("never_purchased"))
        .when(F.col("is_churned_30d"), F.lit("churned"))
        .otherwise(F.lit("active"))
    )
    return churn.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n_buyers"))


def cohort_matrix(cohorts: DataFrame, n_months: int) -> DataFrame:
    """Cohorts as rows, months since cohort (0 .. n_months - 1, the months
    of the calendar) as columns, retention as values."""
    cell = lambda k: F.max(F.when(F.col("months_since_cohort") == k, F.col("retention_rate")))
    return cohorts.groupBy("cohort_month").agg(*[cell(k).alias(str(k)) for k in range(n_months)])


def calendar_months(dim_date: DataFrame) -> int:
    """Months from the first to the last of the calendar (one row)."""
    months = F.col("year") * 12 + F.col("month")
    return dim_date.agg((F.max(months) - F.min(months) + 1).cast("int")).first()[0] or 0
