"""Run settings as plain dataclasses (replaces the YAML file + dict lookups)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the reference's defaults.
# Logical column name -> header in the raw retail file, in file order.
DEFAULT_COLUMN_MAP: dict[str, str] = {
    "item_name": "Item Name",
    "category": "Category",
    "version": "Version",
    "item_code": "Item Code",
    "item_id": "Item ID",
    "buyer_id": "Buyer ID",
    "transaction_id": "Transaction ID",
    "date": "Date",
    "final_quantity": "Final Quantity",
    "total_revenue": "Total Revenue",
    "price_reductions": "Price Reductions",
    "refunds": "Refunds",
    "final_revenue": "Final Revenue",
    "sales_tax": "Sales Tax",
    "overall_revenue": "Overall Revenue",
    "refunded_item_count": "Refunded Item Count",
    "purchased_item_count": "Purchased Item Count",
}

# Default tolerance, gate and date format of the reference run.
DEFAULT_TOLERANCE = 0.02
DEFAULT_MAX_ERROR_RATE = 0.01
DEFAULT_DATE_FORMAT = "d/M/yyyy"  # Spark pattern for strptime "%d/%m/%Y"
WAREHOUSE_TOLERANCE = 0.01  # CHECK ck_revenue_2 of the warehouse table

ID_COLUMNS = ("transaction_id", "buyer_id", "item_id")
MONEY_COLUMNS = (
    "total_revenue",
    "price_reductions",
    "refunds",
    "final_revenue",
    "sales_tax",
    "overall_revenue",
)
QUANTITY_COLUMNS = ("final_quantity", "refunded_item_count", "purchased_item_count")
TEXT_COLUMNS = ("item_name", "category", "version", "item_code")
CHECK_NAMES = (
    "revenue_balance",
    "overall_balance",
    "quantity_balance",
    "refunded_nonpositive",
)


@dataclass(frozen=True)
class SourceConfig:
    """Where and how the raw delimited file is read."""

    path: str = ""
    delimiter: str = ","
    encoding: str = "utf-8"
    multiline: bool = False  # quoted line breaks; such files cannot be split
    date_format: str = DEFAULT_DATE_FORMAT
    column_map: dict[str, str] = field(default_factory=lambda: dict(DEFAULT_COLUMN_MAP))


@dataclass(frozen=True)
class ValidationConfig:
    tolerance: float = DEFAULT_TOLERANCE
    max_error_rate: float = DEFAULT_MAX_ERROR_RATE
    checks: dict[str, bool] = field(
        default_factory=lambda: {name: True for name in CHECK_NAMES}
    )

    def enabled(self, name: str) -> bool:
        return bool(self.checks.get(name, False))


@dataclass(frozen=True)
class CanonicalizeConfig:
    item_attributes: str = "mode"  # "mode" or anything else = pass-through
    category: bool = True


@dataclass(frozen=True)
class EtlConfig:
    source: SourceConfig = field(default_factory=SourceConfig)
    validation: ValidationConfig = field(default_factory=ValidationConfig)
    canonicalize: CanonicalizeConfig = field(default_factory=CanonicalizeConfig)
    dry_run: bool = False
    output_format: str = "parquet"
    # JDBC writer batch size when the warehouse is a database.
    chunk_size: int = 5000
    # Store the fact in one folder per calendar day (date_key).  Date filters
    # on the calendar then prune fact files through dynamic partition
    # pruning.  Worth it when each day holds large files.
    partition_fact_by_date: bool = False
    # Refuse a load that breaks the warehouse constraints.
    enforce_constraints: bool = True
    # What names a load that is given no id: its files' names, or its rows.
    load_id_from: str = "files"
