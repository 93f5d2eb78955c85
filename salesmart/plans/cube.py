"""Measures of several grains from one scan of the fact.

The views aggregate the fact at different grains (day and promo flag, day and
order, item and month, buyer).  A visual that needs several of them would scan
the fact once per view; here one grouping-sets aggregation (one scan, one
Expand, folded map-side) gives all grains, and the measures are small
aggregations over its rows.

Fact rows are expected to meet the warehouse's foreign keys, as stored ones do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.numeric import as_double, ratio, ratio_or_zero
from salesmart.plans import measures as M

#: Grain name -> grouping columns.
GRAINS: dict[str, tuple[str, ...]] = {
    "promo_day": ("full_date", "is_promo"),
    "order": ("full_date", "transaction_id"),
    "item_month": ("item_key", "in_month"),
    "buyer": ("buyer_key",),
}


def fact_cube(dim_date: DataFrame, fact: DataFrame, grains: tuple[str, ...] = tuple(GRAINS)) -> DataFrame:
    """The fact at the named grains: column ``grain``, the grouping columns
    (NULL where a grain lacks them) and the sums every grain shares."""
    days = dim_date.select("date_key", F.col("full_date").alias("day"), (F.col("year") * 12 + F.col("month")).alias("in_month"))
    rows = fact.join(days, "date_key").select(
        F.col("day").alias("full_date"), "day", "in_month", "item_key", "buyer_key", "transaction_id",
        (F.col("price_reductions") != 0).alias("is_promo"),
        "final_revenue", "price_reductions", "purchased_item_count", "refunded_item_count")
    sets = {g: GRAINS[g] for g in grains}
    columns = list(dict.fromkeys(c for s in sets.values() for c in s))
    # Each grain is told by the columns that it groups by.
    name = F.lit(None).cast("string")
    for g, cols in sets.items():
        here = F.lit(True)
        for c in columns:
            here = here & (F.grouping(c) == (0 if c in cols else 1))
        name = F.when(here, F.lit(g)).otherwise(name)
    return rows.groupingSets([[F.col(c) for c in s] for s in sets.values()], *columns).agg(
        name.alias("grain"),
        F.sum("final_revenue").alias("revenue"),
        F.sum("price_reductions").alias("discounts"),
        F.sum("purchased_item_count").alias("purchased"),
        F.sum("refunded_item_count").alias("refunded"),
        F.max("day").alias("last_day"),
    )


def total_kpis(dim_date: DataFrame, dim_buyer: DataFrame, fact: DataFrame) -> DataFrame:
    """Whole-model values of M1, M4, M8, M9, M12–M16, M20–M22 (one row), as
    :func:`measures.total_kpis` has them, from one scan of the fact."""
    def at(grain: str, value: Column) -> Column:
        return F.when(F.col("grain") == grain, value)

    cube = fact_cube(dim_date, fact)
    # Items fold over their months, buyers over their last day.
    part = F.when(F.col("grain") == "item_month", F.col("item_key")).when(
        F.col("grain") == "buyer", F.unix_date("last_day").cast("bigint"))
    folded = cube.groupBy("grain", part.alias("part")).agg(
        F.sum("revenue").alias("revenue"),
        F.sum(F.when(F.col("is_promo"), F.col("revenue"))).alias("promo"),
        F.sum(F.when(~F.col("is_promo"), F.col("revenue"))).alias("plain"),
        F.sum("discounts").alias("discounts"),
        F.sum("purchased").alias("purchased"),
        F.sum(F.abs("refunded")).alias("returned"),
        F.count("transaction_id").alias("orders"),
        F.count(F.lit(1)).alias("n"),
    )
    share = ratio_or_zero(F.abs("discounts"), "revenue")
    cents = lambda c: F.round(as_double(c), 2)
    one = folded.agg(
        cents(F.sum(at("promo_day", F.col("revenue")))).alias("total_revenue"),
        F.sum(at("order", F.col("orders"))).alias("total_orders"),
        F.round(F.avg(at("item_month", share)), 9).alias("discount_share"),
        # One entry per day on which a buyer was seen last.
        F.collect_list(at("buyer", F.struct(F.col("part").alias("day"), "n"))).alias("last_seen"),
        F.sum(at("item_month", F.col("purchased"))).alias("purchased_qty"),
        F.sum(at("item_month", F.col("returned"))).alias("returned_qty"),
        cents(F.sum(at("promo_day", F.col("promo")))).alias("promo_revenue"),
        cents(F.sum(at("promo_day", F.col("plain")))).alias("non_promo_revenue"),
    )
    as_of = F.array_max(F.transform("last_seen", lambda x: x["day"]))
    churned = F.aggregate(F.filter("last_seen", lambda x: x["day"] < as_of - 30), F.lit(0).cast("bigint"),
                          lambda acc, x: acc + x["n"])
    one = one.withColumn("churned", churned).select(
        "total_revenue", "total_orders", "discount_share",
        dim_buyer.select(F.count_distinct("buyer_id")).scalar().alias("total_buyers"),
        F.when(F.col("churned") > 0, F.col("churned")).alias("churned_buyers_30d"),
        "purchased_qty", "returned_qty", "promo_revenue", "non_promo_revenue",
    )
    return one.select(
        "*",
        ratio("churned_buyers_30d", "total_buyers").alias("churn_rate_30d"),
        ratio("returned_qty", "purchased_qty").alias("return_rate"),
        ratio("promo_revenue", F.col("promo_revenue") + F.col("non_promo_revenue")).alias("promo_share"),
    )


def daily_activity(dim_date: DataFrame, fact: DataFrame) -> DataFrame:
    """One row per calendar day: revenue and distinct orders (as V2 has them)
    and the buyers who bought last on that day, from one scan of the fact."""
    cube = fact_cube(dim_date, fact, ("order", "buyer"))
    day = F.when(F.col("grain") == "order", F.col("full_date")).otherwise(F.col("last_day"))
    is_order = F.col("grain") == "order"
    per_day = cube.groupBy(day.alias("full_date")).agg(
        F.sum(F.when(is_order, F.col("revenue"))).alias("revenue"),
        F.count(F.when(is_order, F.col("transaction_id"))).alias("orders"),
        F.count_if(~is_order).alias("last_buyers"))
    return dim_date.select("full_date").join(per_day, "full_date", "left").select(
        "full_date", as_double(F.coalesce("revenue", F.lit(0))).alias("daily_revenue"),
        F.coalesce("orders", F.lit(0)).cast("bigint").alias("daily_orders"),
        F.coalesce("last_buyers", F.lit(0)).cast("bigint").alias("last_buyers"))


def exec_kpis(dim_date: DataFrame, fact: DataFrame) -> DataFrame:
    """B1: the executive row per day of :func:`measures.exec_kpis`, from one
    scan of the fact and without a join of rolling views."""
    days = daily_activity(dim_date, fact)
    return M.kpi_changes(M.rolling_7d(days, M.active_windows("last_buyers")))
