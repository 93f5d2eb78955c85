"""Fact build: surrogate-key lookups, orphan split, warehouse types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.config import MONEY_COLUMNS
from salesmart.functions.numeric import MONEY, money

FACT_COLUMNS = (
    "date_key", "item_key", "buyer_key", "transaction_id", "final_quantity",
    "total_revenue", "price_reductions", "refunds", "final_revenue", "sales_tax",
    "overall_revenue", "refunded_item_count", "purchased_item_count",
)


#: Told apart by these, rows without a natural key are spread.  All are columns
#: that a fact row needs, so that a lookup for the fact carries no others.
SALT_COLUMNS = ("date", "item_code", "buyer_id", "transaction_id", "total_revenue")


#: By these a row finds its keys.
NATURAL_COLUMNS = ("date", "item_code", "buyer_id")


def same_natural(prefix: str):
    """Two rows find the same keys, and both or none have a transaction id; the
    other side's columns carry ``prefix`` (and ``no_id``)."""
    same = F.col("transaction_id").isNull() == F.col(f"{prefix}no_id")
    for c in NATURAL_COLUMNS:
        same = same & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return same


def fact_source(sales: DataFrame) -> DataFrame:
    """What the fact takes of the record, in the warehouse's types: the rows
    that the lookups shuffle are then narrow."""
    return sales.select(*NATURAL_COLUMNS, "transaction_id", *_fact_values())


def staged_source(sales: DataFrame) -> DataFrame:
    """:func:`fact_source` for rows that may turn out to be orphans, whose values
    need not fit the warehouse's types: one that does not is NULL here and the
    row's ``fits`` is false."""
    kinds = {c: MONEY if c in MONEY_COLUMNS else "int" for c in FACT_COLUMNS[4:]}
    values = {c: F.col(c).try_cast(kind) for c, kind in kinds.items()}
    fits = F.lit(True)
    for c, value in values.items():
        fits = fits & (value.isNotNull() | F.col(c).isNull())
    return sales.select(*NATURAL_COLUMNS, "transaction_id", *[v.alias(c) for c, v in values.items()], fits.alias("fits"))


def _fact_values() -> list:
    """Quantities and money in the warehouse's types."""
    return [money(c).alias(c) if c in MONEY_COLUMNS else F.col(c).cast("int").alias(c) for c in FACT_COLUMNS[4:]]


def lookup_keys(sales: DataFrame, dim_date: DataFrame, dim_item: DataFrame,
                dim_buyer: DataFrame) -> DataFrame:
    """Three left lookups adding date_key / item_key / buyer_key.

    No broadcast is forced: adaptive execution broadcasts a dimension whose
    measured size is under the threshold and otherwise plans a shuffle join.
    Rows with a NULL natural key can match nothing; a NULL takes a random
    negative salt on the join key, so that such rows are spread instead of
    meeting in one task.
    """
    out = sales
    for dim, natural, key in ((dim_date, "date", "date_key"), (dim_item, "item_code", "item_key"),
                              (dim_buyer, "buyer_id", "buyer_key")):
        source = "full_date" if natural == "date" else natural
        side = dim.select(F.col(source).alias("__k"), F.lit(0).alias("__s"), F.col(key))
        salt = F.when(F.col(natural).isNull(), -1 - F.pmod(F.xxhash64(*SALT_COLUMNS), F.lit(4096))).otherwise(0)
        out = out.withColumn("__salt", salt.cast("int")).join(
            side, (F.col(natural) == F.col("__k")) & (F.col("__salt") == F.col("__s")), "left"
        ).drop("__k", "__s", "__salt")
    return out


def complete_keys():
    """A fact row needs its three keys and a transaction id."""
    return (F.col("date_key").isNotNull() & F.col("item_key").isNotNull()
            & F.col("buyer_key").isNotNull() & F.col("transaction_id").isNotNull())


def _orphan_reasons():
    missing = F.array(
        F.when(F.col("date_key").isNull(), F.lit("date_key")),
        F.when(F.col("item_key").isNull(), F.lit("item_key")),
        F.when(F.col("buyer_key").isNull(), F.lit("buyer_key")),
        F.when(F.col("transaction_id").isNull(), F.lit("transaction_id")),
    )
    return F.filter(missing, lambda x: x.isNotNull())


def split_fact(looked_up: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(fact, orphans)``.  Fact rows need all three keys and a transaction
    id; the rest are returned with the missing pieces named (the reference
    drops them, counting only missing keys)."""
    complete = complete_keys()
    cols = [F.col(c).cast("int" if c == "date_key" else "bigint").alias(c) for c in FACT_COLUMNS[:4]]
    cols += _fact_values()
    fact = looked_up.where(complete).select(*cols)
    orphans = looked_up.where(~complete).select(
        *[c for c in looked_up.columns if not c.startswith("_")],
        _orphan_reasons().alias("missing"),
    )
    return fact, orphans

