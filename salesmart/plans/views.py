"""The nine analytics views (V1–V9) as DataFrame functions.

Each function takes the warehouse tables and returns a lazy DataFrame; views
built on views are plain function calls, so Catalyst sees one tree and prunes
the calendar view's columns to those used.

Plan shape used throughout:

* the calendar (one row per day of the span — bounded by the span, not by
  the data) is broadcast into the fact;
* the fact is aggregated **before** any outer join to a spine or dimension,
  so the big side never enters an outer join and partial (map-side)
  aggregation collapses hot dates, items and buyers before the shuffle;
* item / buyer dimensions join the aggregated rows (AQE decides broadcast
  from runtime size);
* money is summed exactly as decimal(14,2) and exposed as DOUBLE; ratios are
  DOUBLE and NULL where the reference divides by zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions import dates as D
from salesmart.functions.numeric import as_double, ratio, ratio_or_zero
from salesmart.operators.keys import radix_ranks


def vw_date(dim_date: DataFrame) -> DataFrame:
    """V1: calendar attributes (English month / day names, ISO week,
    Sunday = 0)."""
    d = F.col("full_date")
    return dim_date.select(
        "date_key", "full_date", "year", "quarter", "month", "day", "is_weekend",
        D.month_start(d).alias("month_start"),
        D.month_end(d).alias("month_end"),
        D.year_month(d).alias("year_month"),
        D.month_name(d).alias("month_name"),
        D.iso_week(d).alias("week_of_year"),
        (d == D.month_start(d)).alias("is_month_start"),
        (d == D.month_end(d)).alias("is_month_end"),
        D.day_of_week_sun0(d).alias("day_of_week"),
        D.day_name_short(d).alias("day_name_short"),
        D.day_name(d).alias("day_name"),
    )


def _dates(dim_date: DataFrame, *cols: str) -> DataFrame:
    """Slice of the calendar view; adaptive execution broadcasts it if small."""
    return vw_date(dim_date).select("date_key", *cols)


def sales_daily(dim_date: DataFrame, fact: DataFrame) -> DataFrame:
    """V2: every calendar day with net revenue and distinct orders (0 on days
    without sales)."""
    daily = fact.groupBy("date_key").agg(
        F.sum("final_revenue").alias("daily_revenue"),
        F.countDistinct("transaction_id").alias("daily_orders"),
    )
    spine = vw_date(dim_date).select(
        "date_key", "full_date", "year", "month", "year_month", "month_start", "month_end"
    )
    return spine.join(daily, "date_key", "left").select(
        "full_date", "year", "month", "year_month", "month_start", "month_end",
        as_double(F.coalesce("daily_revenue", F.lit(0))).alias("daily_revenue"),
        F.coalesce("daily_orders", F.lit(0)).cast("bigint").alias("daily_orders"),
    )


def clv_per_buyer(dim_date: DataFrame, dim_buyer: DataFrame, fact: DataFrame) -> DataFrame:
    """V3: lifetime value per buyer, every buyer present.

    The as-of date is the last calendar day that the fact has: a scalar
    subquery that reads only the fact's ``date_key``.  Nothing is stored, so
    the view follows the tables it reads.
    """
    per = (
        fact.join(_dates(dim_date, "full_date"), "date_key")
        .groupBy("buyer_key")
        .agg(
            F.sum("final_revenue").alias("rev"),
            F.countDistinct("transaction_id").alias("orders"),
            F.min("full_date").alias("first_purchase_date"),
            F.max("full_date").alias("last_purchase_date"),
        )
    )
    sold = fact.select("date_key").distinct().join(_dates(dim_date, "full_date"), "date_key")
    as_of = sold.select(F.max("full_date")).scalar()
    orders = F.coalesce(F.col("orders"), F.lit(0))
    last = F.col("last_purchase_date")
    return dim_buyer.select("buyer_key", "buyer_id").join(per, "buyer_key", "left").select(
        "buyer_key", "buyer_id",
        as_double(F.coalesce("rev", F.lit(0))).alias("total_revenue"),
        orders.cast("bigint").alias("total_orders"),
        F.when(orders > 0, ratio("rev", "orders")).alias("avg_order_value"),
        "first_purchase_date",
        "last_purchase_date",
        F.when(last.isNotNull(), D.days_between(as_of, last)).alias("days_since_last_purchase"),
        F.when(orders == 0, F.lit(False))
        .when(last >= F.date_sub(as_of, 30), F.lit(True))
        .otherwise(F.lit(False)).alias("is_active_30d"),
        (orders == 0).alias("is_never_purchased"),
    )


def churn_summary(clv: DataFrame) -> DataFrame:
    """V7: churn flags from V3 (never-purchased buyers are not churned)."""
    days = F.col("days_since_last_purchase")
    return clv.select(
        "buyer_key", "buyer_id", "last_purchase_date", "days_since_last_purchase",
        (days.isNotNull() & (days > 30)).alias("is_churned_30d"),
        (days.isNotNull() & (days > 60)).alias("is_churned_60d"),
        F.col("last_purchase_date").isNull().alias("is_never_purchased"),
    )


def _item_months(dim_date: DataFrame, fact: DataFrame) -> DataFrame:
    """Fact aggregated to (item_key, year, month, year_month)."""
    return (
        fact.join(_dates(dim_date, "year", "month", "year_month"), "date_key")
        .groupBy("item_key", "year", "month", "year_month")
        .agg(
            F.sum("purchased_item_count").alias("purchased_qty"),
            F.sum("refunded_item_count").alias("refunded_qty_raw"),
            F.sum("refunds").alias("refunded_revenue"),
        )
    )


def return_rates_item(dim_date: DataFrame, dim_item: DataFrame, fact: DataFrame) -> DataFrame:
    """V4: monthly return metrics per item plus the item's all-time rate.

    The all-time rate is a window over one item's months (bounded by the
    number of months in the span)."""
    agg = _item_months(dim_date, fact).join(
        dim_item.select("item_key", "item_code", "item_name", "category"), "item_key"
    )
    refunded = F.abs("refunded_qty_raw")
    w = Window.partitionBy("item_key")
    return agg.select(
        "item_key", "item_code", "item_name", "category", "year", "month", "year_month",
        F.col("purchased_qty").cast("bigint").alias("purchased_qty"),
        refunded.cast("bigint").alias("refunded_qty"),
        as_double("refunded_revenue").alias("refunded_revenue"),
        ratio(refunded, "purchased_qty").alias("return_rate"),
        ratio(F.sum(refunded).over(w), F.sum("purchased_qty").over(w))
        .alias("item_return_rate_overall"),
    )


def return_rates_category(dim_date: DataFrame, dim_item: DataFrame,
                          fact: DataFrame) -> DataFrame:
    """V5: monthly return metrics per category (NULL category is a group).

    Rolled up from the item-month aggregate, so the fact is shuffled once,
    already partially aggregated, and the item dimension joins item-months
    rather than fact rows."""
    agg = (
        _item_months(dim_date, fact)
        .join(dim_item.select("item_key", "category"), "item_key")
        .groupBy("category", "year", "month", "year_month")
        .agg(
            F.sum("purchased_qty").alias("purchased_qty"),
            F.sum("refunded_qty_raw").alias("refunded_qty_raw"),
            F.sum("refunded_revenue").alias("refunded_revenue"),
        )
    )
    refunded = F.abs("refunded_qty_raw")
    return agg.select(
        "category", "year", "month", "year_month",
        F.col("purchased_qty").cast("bigint").alias("purchased_qty"),
        refunded.cast("bigint").alias("refunded_qty"),
        as_double("refunded_revenue").alias("refunded_revenue"),
        ratio(refunded, "purchased_qty").alias("return_rate"),
    )


def churn_cohorts(dim_date: DataFrame, fact: DataFrame) -> DataFrame:
    """V6: cohort (month of first purchase) x activity month retention.

    One shuffle by buyer collects the set of active months per buyer
    (partial ``collect_set`` map-side; at most one entry per month of the
    span, so bounded even for the heaviest buyer).  The cohort is the
    earliest month of that set.  Cohort size = active buyers in the cohort's
    own month; a month without activity has no row.
    Every fact row references a buyer (foreign key), so the buyer dimension
    is not needed here.
    """
    months = (
        fact.select("buyer_key", "date_key")
        .join(_dates(dim_date, "month_start"), "date_key")
        .groupBy("buyer_key")
        .agg(F.collect_set("month_start").alias("months"))
    )
    cohorted = months.select(
        F.array_min("months").alias("cohort_month"),
        F.explode("months").alias("activity_month"),
    )
    # One row per (buyer, activity month): counting rows = distinct buyers.
    ca = cohorted.groupBy("cohort_month", "activity_month").agg(
        F.count(F.lit(1)).alias("active_buyers")
    )
    since = (D.month_index("activity_month") - D.month_index("cohort_month")).cast("int")
    w = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col("months_since_cohort") == 0, F.col("active_buyers"))).over(w)
    return (
        ca.select("cohort_month", "activity_month", since.alias("months_since_cohort"),
                  F.col("active_buyers").cast("bigint").alias("active_buyers"))
        .withColumn("cohort_size", size)
        .withColumn("retention_rate",
                    F.when(F.col("cohort_size") > 0, ratio("active_buyers", "cohort_size")))
    )


def _item_totals(dim_item: DataFrame, fact: DataFrame) -> DataFrame:
    """Fact aggregated per item (exact decimal sums) with the item's labels."""
    return fact.groupBy("item_key").agg(
        F.sum("final_revenue").alias("total_revenue"),
        F.sum("final_quantity").alias("total_quantity"),
        F.sum("purchased_item_count").alias("total_purchased_qty"),
        F.sum("refunded_item_count").alias("total_refunded_qty"),
        F.sum("price_reductions").alias("total_discounts"),
    ).join(dim_item.select("item_key", "item_code", "item_name", "category"), "item_key")


def _item_metric_columns():
    return [
        "item_key", "item_code", "item_name", "category",
        as_double("total_revenue").alias("total_revenue"),
        F.col("total_quantity").cast("bigint").alias("total_quantity"),
        F.col("total_refunded_qty").cast("bigint").alias("total_refunded_qty"),
        as_double("total_discounts").alias("total_discounts"),
        ratio(F.abs("total_refunded_qty"), "total_purchased_qty").alias("return_rate"),
        ratio_or_zero(F.abs("total_discounts"), "total_revenue").alias("discount_share"),
    ]


def item_metrics(dim_item: DataFrame, fact: DataFrame) -> DataFrame:
    """V8 without the two ranks: what the discount-share and return
    measures read (one fact aggregation, no ranking work)."""
    return _item_totals(dim_item, fact).select(*_item_metric_columns())


def item_performance(dim_item: DataFrame, fact: DataFrame) -> DataFrame:
    """V8: per-item revenue, quantities, return rate, discount share, overall
    and in-category revenue rank (RANK, gaps on ties, NULLs first).

    Ranks use :func:`radix_ranks`: lazy, without a single-partition sort, a
    sampling job or a stored table, so the view follows its tables."""
    ranked = radix_ranks(_item_totals(dim_item, fact), "total_revenue", {
        "revenue_rank": [], "revenue_rank_in_category": ["category"]})
    return ranked.select(*_item_metric_columns(), "revenue_rank", "revenue_rank_in_category")


def promo_revenue_daily(dim_date: DataFrame, fact: DataFrame) -> DataFrame:
    """V9: two rows per calendar day (promo / not promo).

    The spine is the calendar with each day repeated for both flags
    (``explode`` of a 2-element array, no join); the fact is aggregated by
    (date_key, price_reductions <> 0) before the outer join."""
    agg = fact.groupBy(
        "date_key", (F.col("price_reductions") != 0).alias("is_promo")
    ).agg(
        F.sum("final_revenue").alias("revenue"),
        F.countDistinct("transaction_id").alias("orders"),
        F.sum("purchased_item_count").alias("purchased_qty"),
        F.abs(F.sum("refunded_item_count")).alias("refunded_qty"),
    )
    spine = vw_date(dim_date).select(
        "date_key", "full_date", "year", "month", "year_month", "month_start", "month_end",
        F.explode(F.array(F.lit(True), F.lit(False))).alias("is_promo"),
    )
    return spine.join(agg, ["date_key", "is_promo"], "left").select(
        "date_key", "full_date", "year", "month", "year_month", "month_start", "month_end",
        "is_promo",
        as_double(F.coalesce("revenue", F.lit(0))).alias("revenue"),
        F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"),
        F.coalesce("purchased_qty", F.lit(0)).cast("bigint").alias("purchased_qty"),
        F.coalesce("refunded_qty", F.lit(0)).cast("bigint").alias("refunded_qty"),
    )
