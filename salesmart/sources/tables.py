"""Adapter: the driver's TPC-H-style tables -> the 17-column sales record.

``sales`` = lineitem ⋈ orders (order key) ⋈ part (part key).  One output row
per line item, the grain of the reference's raw retail file.  Three shapes:

* :func:`sales_record` — typed, already clean (logical column names);
* :func:`raw_sales_text` — all-text with the raw file's headers and injected
  defects (bad ids/dates, mixed-case categories, unbalanced rows), to drive
  cleaning, canonicalisation and validation exactly like a raw file would;
* ``since``/``until`` bounds — restricted fact window (buyers without facts).

Both joins are equi-joins on keys; Catalyst prunes the scans to the columns
used and AQE picks broadcast vs shuffle from runtime sizes (``part`` grows
with the data, so it is not force-broadcast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.config import DEFAULT_COLUMN_MAP
from salesmart.functions.numeric import MONEY

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _joined_lines(spark: SparkSession, sf_dir: str, since: str | None,
                  until: str | None) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    )
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_date")
    )
    if since is not None:
        od = od.filter(F.col("o_date") >= F.lit(since).cast("date"))
    if until is not None:
        od = od.filter(F.col("o_date") <= F.lit(until).cast("date"))
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    return (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .join(pt, F.col("l_partkey") == pt.p_partkey)
    )


def _money_parts(df: DataFrame) -> DataFrame:
    """Quantities and money columns of the record, decimal(14,2)."""
    returned = F.col("l_returnflag") == "R"
    purchased = F.col("l_quantity").cast("int")
    total = F.col("l_extendedprice").cast(MONEY)
    # decimal(13,2) x decimal(4,2) has precision 18: Spark keeps the product
    # on its long-backed fast path (19 digits would switch to BigDecimal).
    # Prices stay far below 10^11, so no value changes.
    reduction = (-F.round(total.cast("decimal(13,2)") * F.col("l_discount").cast("decimal(4,2)"), 2)).cast(MONEY)
    refunds = F.when(returned, -(total + reduction)).otherwise(F.lit(0)).cast(MONEY)
    final = (total + reduction + refunds).cast(MONEY)
    tax = F.round(final.cast("decimal(13,2)") * F.col("l_tax").cast("decimal(4,2)"), 2).cast(MONEY)
    refunded_cnt = F.when(returned, -purchased).otherwise(F.lit(0)).cast("int")
    return df.select(
        "*",
        purchased.alias("purchased_item_count"),
        refunded_cnt.alias("refunded_item_count"),
        total.alias("total_revenue"),
        reduction.alias("price_reductions"),
        refunds.alias("refunds"),
        final.alias("final_revenue"),
        tax.alias("sales_tax"),
    )


def item_code(partkey: Column) -> Column:
    # Six digits at least; the formatter only for what has a sign.
    digits = partkey.cast("string")
    padded = F.concat(F.lit("I"), F.repeat(F.lit("0"), 6 - F.length(digits)), digits)
    return F.when(partkey >= 0, padded).otherwise(F.format_string("I%06d", partkey))


def sales_record(spark: SparkSession, sf_dir: str, since: str | None = None,
                 until: str | None = None) -> DataFrame:
    """Typed, clean sales lines with logical column names."""
    df = _money_parts(_joined_lines(spark, sf_dir, since, until))
    return df.select(
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("v"), F.col("p_size").cast("string")).alias("version"),
        item_code(F.col("l_partkey")).alias("item_code"),
        F.col("l_partkey").alias("item_id"),
        F.col("o_custkey").alias("buyer_id"),
        F.col("l_orderkey").alias("transaction_id"),
        F.col("o_date").alias("date"),
        (F.col("purchased_item_count") + F.col("refunded_item_count")).alias("final_quantity"),
        "total_revenue",
        "price_reductions",
        "refunds",
        "final_revenue",
        "sales_tax",
        (F.col("final_revenue") + F.col("sales_tax")).cast(MONEY).alias("overall_revenue"),
        "refunded_item_count",
        "purchased_item_count",
    )


def raw_sales_text(spark: SparkSession, sf_dir: str, since: str | None = None,
                   until: str | None = None,
                   column_map: dict[str, str] | None = None) -> DataFrame:
    """All-text raw record with the raw file's headers and injected defects.

    ``h = (l_orderkey*31 + l_linenumber*7) % 1000`` selects the defect:
    0 revenue_balance fails, 1 overall_balance fails, 2 quantity_balance
    fails, 3 refunded_nonpositive fails, 10 transaction id 'N/A',
    11 impossible date '31/02/2019'.  Categories cycle through upper case,
    lower case with outer blanks and as-is; every fourth line's item name is
    upper case.  Every row also gets a ``_seq`` file-order column.
    """
    cmap = dict(column_map or DEFAULT_COLUMN_MAP)
    df = _money_parts(_joined_lines(spark, sf_dir, since, until))
    h = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 7) % 1000
    ln = F.col("l_linenumber")
    txt = lambda c: c.cast("string")
    purchased = F.col("purchased_item_count")
    refunded = F.when(h == 3, F.lit(1)).otherwise(F.col("refunded_item_count"))
    final_qty = purchased + refunded + F.when(h == 2, F.lit(1)).otherwise(F.lit(0))
    one = F.lit(1).cast(MONEY)
    final_rev = F.col("final_revenue") + F.when(h == 0, one).otherwise(F.lit(0))
    overall = (
        F.col("final_revenue") + F.col("sales_tax")
        + F.when(h.isin(0, 1), one).otherwise(F.lit(0))
    )
    category = (
        F.when(ln % 3 == 0, F.upper("p_type"))
        .when(ln % 3 == 1, F.concat(F.lit("  "), F.lower("p_type"), F.lit(" ")))
        .otherwise(F.col("p_type"))
    )
    out = {
        "item_name": F.when(ln % 4 == 0, F.upper("p_name")).otherwise(F.col("p_name")),
        "category": category,
        "version": F.concat(F.lit("v"), txt(F.col("p_size"))),
        "item_code": item_code(F.col("l_partkey")),
        "item_id": F.concat(F.lit("i-"), txt(F.col("l_partkey"))),
        "buyer_id": F.concat(F.lit("b-"), txt(F.col("o_custkey"))),
        "transaction_id": F.when(h == 10, F.lit("N/A")).otherwise(
            F.concat(F.lit("#"), txt(F.col("l_orderkey")))),
        "date": F.when(h == 11, F.lit("31/02/2019")).otherwise(
            F.date_format("o_date", "dd/MM/yyyy")),
        "final_quantity": txt(final_qty),
        "total_revenue": txt(F.col("total_revenue")),
        "price_reductions": txt(F.col("price_reductions")),
        "refunds": txt(F.col("refunds")),
        "final_revenue": txt(final_rev.cast(MONEY)),
        "sales_tax": txt(F.col("sales_tax")),
        "overall_revenue": txt(overall.cast(MONEY)),
        "refunded_item_count": txt(refunded),
        "purchased_item_count": txt(purchased),
    }
    cols = [out[k].alias(cmap[k]) for k in DEFAULT_COLUMN_MAP]
    # File order of a raw file = (order key, line number) here.
    seq = (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("_seq")
    return df.select(*cols, seq)
