"""Raw delimited-file scan and cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.config import (
    DEFAULT_COLUMN_MAP,
    ID_COLUMNS,
    MONEY_COLUMNS,
    QUANTITY_COLUMNS,
    TEXT_COLUMNS,
    SourceConfig,
)
from salesmart.functions.dates import parse_date
from salesmart.functions.text import clean_id, null_na_tokens

# Parsed money keeps the file's decimals, so that the tolerance checks see its
# values; the fact rounds to decimal(14,2).
PARSED_MONEY = "decimal(28,10)"


def read_raw_csv(spark: SparkSession, cfg: SourceConfig,
                 headers: list[str] | None = None) -> DataFrame:
    """Header + delimiter + encoding, every column read as text.

    Columns are bound by name: the names come from the file's header, in
    whatever order, and columns beyond the map are ignored.  Files of one load
    must agree in their header (a differing one is an error, not a mix-up).
    Quoted line breaks need ``cfg.multiline``, which makes a file unsplittable.
    A ``_seq`` column records file order (:func:`file_position`) for "first
    value in the file" aggregates.
    """
    options = {"header": True, "sep": cfg.delimiter, "encoding": cfg.encoding, "quote": '"',
               "escape": '"', "enforceSchema": False, "multiLine": cfg.multiline}
    names = headers or spark.read.options(**options).csv(cfg.path).columns
    missing = set(cfg.column_map.values()) - set(names)
    if missing:
        raise ValueError(f"Columns not in the file: {sorted(missing)}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = spark.read.schema(schema).options(**options).csv(cfg.path)
    return df.withColumn("_seq", file_position())


def file_position() -> Column:
    """A row's place in its input: file path, then the start of its block in
    the file, then the row's number inside the task that reads the block.
    Only rows of one block are compared by the number, so the order does not
    rest on how blocks are packed into tasks."""
    return F.struct(
        F.col("_metadata.file_path").alias("f"),
        F.col("_metadata.file_block_start").alias("b"),
        F.monotonically_increasing_id().alias("i"),
    )


def map_columns(raw: DataFrame, column_map: dict[str, str]) -> DataFrame:
    """Source headers -> logical names (only mapped columns survive)."""
    cols = [raw[f"`{src}`"].alias(dst) for dst, src in column_map.items()]
    if "_seq" in raw.columns:
        cols.append(F.col("_seq"))
    return raw.select(*cols)


def _to_int(c):
    # Plain integers take the fast cast; "12.0" is a whole number and is
    # accepted through the decimal path; "12.5" or text becomes NULL.
    d = c.try_cast("decimal(18,4)")
    return F.coalesce(c.try_cast("int"), F.when(d == F.floor(d), d.try_cast("int")))


def clean_raw(raw: DataFrame, cfg: SourceConfig | None = None,
              na_tokens: bool = True) -> DataFrame:
    """Typed sales record from the text record (logical names).

    * date: parsed with the configured pattern, bad -> NULL (E1);
    * transaction/buyer/item id: digits only, empty -> NULL, BIGINT (E2);
    * quantities and money: ``try_cast``; bad text -> NULL (rejected later);
    * text: pandas' default NA tokens -> NULL (trap 29).
    """
    cfg = cfg or SourceConfig()
    mapped = map_columns(raw, cfg.column_map) if _needs_mapping(raw, cfg) else raw
    src = (lambda c: null_na_tokens(F.col(c))) if na_tokens else F.col
    cols = []
    for name in DEFAULT_COLUMN_MAP:
        if name not in mapped.columns:
            continue
        if name == "date":
            cols.append(parse_date(src(name), cfg.date_format).alias(name))
        elif name in ID_COLUMNS:
            cols.append(clean_id(src(name)).alias(name))
        # No NA token is a number: the casts make NULL of them by themselves.
        elif name in QUANTITY_COLUMNS:
            cols.append(_to_int(F.col(name)).alias(name))
        elif name in MONEY_COLUMNS:
            cols.append(F.col(name).try_cast(PARSED_MONEY).alias(name))
        elif name in TEXT_COLUMNS:
            cols.append(src(name).alias(name))
    if "_seq" in mapped.columns:
        cols.append(F.col("_seq"))
    return mapped.select(*cols)


def _needs_mapping(raw: DataFrame, cfg: SourceConfig) -> bool:
    logical = set(cfg.column_map)
    return not logical.issubset(set(raw.columns))


def load_raw_data(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    """S1 + S2 + cleaning in one lazy plan."""
    return clean_raw(read_raw_csv(spark, cfg), cfg)


def null_counts(df: DataFrame) -> dict[str, Column]:
    """One aggregate per data column, for a pass the caller makes anyway."""
    return {c: F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns if not c.startswith("_")}


def profile(df: DataFrame) -> DataFrame:
    """One row per column — name, type, row count, null count.

    A single aggregate pass computes every null count; the result is
    reshaped with ``stack`` so no per-column job or driver loop runs.
    """
    nulls = null_counts(df)
    dtypes = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [n.alias(f"n{i}") for i, n in enumerate(nulls.values())]
    wide = df.agg(*aggs)
    pairs = ", ".join(
        f"'{c.replace(chr(39), chr(39) * 2)}', '{dtypes[c]}', n{i}" for i, c in enumerate(nulls)
    )
    return wide.selectExpr(
        f"stack({len(nulls)}, {pairs}) AS (column_name, data_type, n_nulls)", "__n AS n_rows"
    ).select("column_name", "data_type", "n_rows", F.col("n_nulls").cast("bigint"))
