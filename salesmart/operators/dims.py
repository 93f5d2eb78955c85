"""Dimension builders (E3–E8), surrogate keys (K1), incremental loads."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from salesmart.config import CanonicalizeConfig
from salesmart.functions.dates import is_weekend
from salesmart.functions.text import canonical_category
from salesmart.operators.keys import dense_keys

log = logging.getLogger("salesmart")

DATE_DIM_COLUMNS = ("date_key", "full_date", "year", "quarter", "month", "day", "is_weekend")
ITEM_DIM_COLUMNS = ("item_key", "item_code", "item_id", "item_name", "category", "version")
BUYER_DIM_COLUMNS = ("buyer_key", "buyer_id")


def date_bounds(df: DataFrame, date_col: str = "date") -> tuple[date, date]:
    """Min and max valid date (one 1-row aggregate)."""
    row = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    if row is None or row["lo"] is None:
        raise ValueError(f"Column {date_col!r} holds no date, so there is no calendar.")
    return row["lo"], row["hi"]


def calendar(spark, lo: date, hi: date) -> DataFrame:
    """Dense daily calendar lo..hi with its attributes (no keys)."""
    n_days = (hi - lo).days + 1
    full_date = F.date_add(F.lit(lo), F.col("id").cast("int"))
    return spark.range(0, n_days).select(full_date.alias("full_date")).select(
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day"),
        is_weekend("full_date").alias("is_weekend"),
    )


def build_date_dimension(df: DataFrame, date_col: str = "date",
                         bounds: tuple[date | None, date | None] | None = None) -> DataFrame:
    """Every day between the first and the last valid date.

    Raises ``ValueError`` when the column holds no valid date.  The first
    load's key is ``days since the first date + 1`` — dense, in date order,
    and computed without any shuffle.  ``bounds`` (min, max) may come from an
    aggregate the caller runs anyway, saving a scan.
    """
    if bounds is None:
        lo, hi = date_bounds(df, date_col)
    else:
        lo, hi = bounds
        if lo is None:
            raise ValueError(
                f"Column {date_col!r} holds no date, so there is no calendar.")
    cal = calendar(df.sparkSession, lo, hi)
    key = (F.datediff("full_date", F.lit(lo)) + 1).cast("int").alias("date_key")
    return cal.select(key, *cal.columns)


def most_frequent(df: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Per ``key``, the most frequent non-null value of each string
    attribute; ties -> the smallest value; all-null -> NULL.

    Values are counted per (key, attribute, value) first — that shuffle is
    spread by value, so a key holding a third of the rows is split across
    tasks — and each key then keeps one fixed-size ``min_by`` buffer per
    attribute (ordering ``(-count, value)``).  The built-in ``mode`` gives the
    same answer but holds a map of every distinct value of a key in one
    buffer.
    """
    long = df.select(
        key,
        F.explode(F.array(*[
            F.struct(F.lit(a).alias("attr"), F.col(a).alias("value")) for a in attrs
        ])).alias("kv"),
    ).select(key, "kv.attr", "kv.value").where(F.col("value").isNotNull())
    counts = long.groupBy(key, "attr", "value").agg(F.count(F.lit(1)).alias("n"))
    best = [
        F.min_by(F.col("value"), F.when(F.col("attr") == a, F.struct(-F.col("n"), F.col("value"))))
        .alias(a)
        for a in attrs
    ]
    return counts.groupBy(key).agg(*best)


def item_attributes(df: DataFrame, canon: CanonicalizeConfig | None = None,
                    observation: Observation | None = None) -> DataFrame:
    """One row per item (mode strategy) or distinct rows.

    mode strategy: group by ``item_code`` (NULL codes dropped); ``item_id`` =
    first non-null in file order; name / category / version = most frequent
    non-null value, ties -> smallest (as :func:`most_frequent`).
    Category is canonicalised before the mode is taken.  Groups whose
    ``item_id`` is NULL are dropped; ``observation`` counts them
    (``items_without_id``) in the same pass.

    One scan and no join: a first aggregation folds rows of equal attributes
    to one with their count and first position, so that rows are shuffled once
    and not once per attribute, and a category text is canonicalised once per
    folded row; each of these then gives its four attributes
    as (attribute, value) pairs, whose counts are spread by value; a last one
    keeps one fixed-size buffer per item and attribute.
    """
    canon = canon or CanonicalizeConfig()
    category = canonical_category("category", canon.category)
    if canon.item_attributes == "mode":
        modes = ("item_name", "category", "version")
        pairs = F.array(*[
            F.struct(F.lit(a).alias("attr"), (category if a == "category" else F.col(a)).cast("string").alias("value"))
            for a in ("item_id", *modes)])
        # Without an order the smallest id counts as the first.
        at = F.col("_seq") if "_seq" in df.columns else F.col("item_id")
        folded = df.where(F.col("item_code").isNotNull()).groupBy("item_code", "item_id", *modes).agg(
            F.count(F.lit(1)).alias("rows"), F.min(at).alias("at"))
        long = folded.select("item_code", "rows", "at", F.explode(pairs).alias("kv")).select(
            "item_code", "rows", "at", "kv.*")
        # Null values go, but for the ids: their group says that the code exists.
        long = long.where(F.col("value").isNotNull() | (F.col("attr") == "item_id"))
        counts = long.groupBy("item_code", "attr", "value").agg(
            F.sum("rows").alias("n"), F.min("at").alias("first"))
        an_id = (F.col("attr") == "item_id") & F.col("value").isNotNull()
        grouped = counts.groupBy("item_code").agg(
            F.min_by("value", F.when(an_id, F.col("first"))).cast(df.schema["item_id"].dataType).alias("item_id"),
            *[F.min_by("value", F.when(F.col("attr") == a, F.struct(-F.col("n"), F.col("value")))).alias(a)
              for a in modes])
        if observation is not None:
            grouped = grouped.observe(observation, F.count_if(F.col("item_id").isNull()).alias("items_without_id"))
        return grouped.where(F.col("item_id").isNotNull()).select(
            "item_code", "item_id", "item_name", "category", "version")
    return (
        df.where(F.col("item_id").isNotNull())
        .select("item_code", "item_id", "item_name", "category", "version").distinct()
        .withColumn("category", category).distinct()
    )


def build_item_dimension(df: DataFrame, canon: CanonicalizeConfig | None = None,
                         start: Column | int = 0, observation: Observation | None = None) -> DataFrame:
    """Item dimension with ``item_key`` in ``item_code`` order."""
    canon = canon or CanonicalizeConfig()
    attrs = item_attributes(df, canon, observation)
    if canon.item_attributes == "mode":
        keyed = dense_keys(attrs, "item_code", "item_key", start)
    else:
        # Pass-through may hold several rows per code (a UNIQUE violation the
        # constraint report flags); order by code, then the other attributes.
        sort_key = F.concat_ws(
            "\u0000",
            # A value is marked, so that NULL and an empty text are told apart.
            *[F.coalesce(F.concat(F.lit("\u0001"), F.col(c).cast("string")), F.lit("")) for c in ITEM_DIM_COLUMNS[1:]],
        )
        keyed = dense_keys(attrs.withColumn("__sk", sort_key), "__sk", "item_key", start)
    return keyed.select(*ITEM_DIM_COLUMNS)


def buyer_ids(df: DataFrame) -> DataFrame:
    """Distinct non-null buyer ids."""
    return df.select("buyer_id").where(F.col("buyer_id").isNotNull()).distinct()


def build_buyer_dimension(df: DataFrame, start: Column | int = 0) -> DataFrame:
    return dense_keys(buyer_ids(df), "buyer_id", "buyer_key", start).select(*BUYER_DIM_COLUMNS)


def load_dimension_table(df: DataFrame, dim: str,
                         canon: CanonicalizeConfig | None = None) -> DataFrame:
    """Dispatch by dimension name; anything else is an error."""
    if dim == "item":
        return build_item_dimension(df, canon)
    if dim == "buyer":
        return build_buyer_dimension(df)
    raise ValueError(f"No dimension {dim!r}: item and buyer are known")


def dropped_row_counts() -> dict[str, Column]:
    """Row-level counts of what a dimension build drops (aggregate Columns,
    to be evaluated in a pass the caller makes anyway)."""
    return {
        "null_buyer_id_rows": F.count_if(F.col("buyer_id").isNull()),
        "null_item_code_rows": F.count_if(F.col("item_code").isNull()),
    }


def items_without_id(df: DataFrame) -> Column:
    """Scalar subquery: item codes whose item id is NULL on every row."""
    per_item = df.groupBy("item_code").agg(F.count("item_id").alias("n_ids"))
    none = per_item.where(F.col("item_code").isNotNull() & (F.col("n_ids") == 0))
    return none.select(F.count(F.lit(1))).scalar()


def dropped_counts(df: DataFrame) -> DataFrame:
    """Rows a dimension build drops: null buyer ids, null item codes, and
    item codes whose item id is null everywhere (one row)."""
    base = df.agg(*[c.alias(k) for k, c in dropped_row_counts().items()])
    return base.select("*", items_without_id(df).alias("items_without_id"))


# --------------------------------------------------------------------------
# Incremental dimension loads (insert only unseen natural keys).
# --------------------------------------------------------------------------

def _max_key(existing: DataFrame, key: str) -> Column:
    return existing.select(F.max(key)).scalar()


def new_dates(candidate_dates: DataFrame, existing: DataFrame) -> DataFrame:
    """Calendar days not yet in ``existing``; keys continue after its max in
    date order (dense for the new rows)."""
    fresh = candidate_dates.select(*DATE_DIM_COLUMNS[1:]).join(
        existing.select("full_date"), "full_date", "left_anti"
    )
    keyed = dense_keys(fresh, "full_date", "date_key", _max_key(existing, "date_key"))
    return keyed.select(F.col("date_key").cast("int").alias("date_key"), *DATE_DIM_COLUMNS[1:])


def new_items(candidate_items: DataFrame, existing: DataFrame) -> DataFrame:
    """Items whose ``item_code`` is not in ``existing``; attributes of
    known codes are not updated (no history)."""
    attrs = candidate_items.select(*ITEM_DIM_COLUMNS[1:]).join(
        existing.select("item_code"), "item_code", "left_anti"
    )
    keyed = dense_keys(attrs, "item_code", "item_key", _max_key(existing, "item_key"))
    return keyed.select(*ITEM_DIM_COLUMNS)


def new_buyers(candidate_buyers: DataFrame, existing: DataFrame) -> DataFrame:
    ids = candidate_buyers.select("buyer_id").join(
        existing.select("buyer_id"), "buyer_id", "left_anti"
    )
    keyed = dense_keys(ids, "buyer_id", "buyer_key", _max_key(existing, "buyer_key"))
    return keyed.select(*BUYER_DIM_COLUMNS)
