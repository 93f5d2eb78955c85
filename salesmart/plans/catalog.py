"""Registry of runnable queries: ``name -> (spark, sf_dir) -> DataFrame`` and
the matching DuckDB oracle SQL (where one exists).

Each query builds the warehouse from the whole driver tables and runs one
operator, view or measure.  The warehouse tables are computed once per Spark
application and input folder, written below the shared checkpoint folder
and read back, so every query reads stored tables the way a user of the
views does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from salesmart.config import DEFAULT_DATE_FORMAT, CanonicalizeConfig, EtlConfig, SourceConfig
from salesmart.functions.dates import parse_date
from salesmart.functions.text import canonical_category, clean_id
from salesmart.operators.constraints import constraint_report
from salesmart.operators.dims import (
    build_buyer_dimension,
    build_date_dimension,
    build_item_dimension,
    buyer_ids,
    item_attributes,
    new_buyers,
    new_dates,
    new_items,
)
from salesmart.operators.fact import FACT_COLUMNS
from salesmart.operators.validate import (
    check_expressions,
    check_failures,
    drop_rate,
    flag_rows,
)
from salesmart.plans import cube
from salesmart.plans import oracle as O
from salesmart.plans import measures as M
from salesmart.plans import views as V
from salesmart.plans.catalog_views import VIEW_NAMES, publish_views
from salesmart.plans.warehouse import (
    Warehouse,
    build_warehouse,
    dry_run_counts,
    read_warehouse,
    run_pipeline,
    with_fact_key,
)
from salesmart.session import (
    DROP_SHUFFLES,
    OPEN_FOLDERS,
    PACKED,
    SMALL_FUNCTIONS,
    conf_for,
    drop_path,
    materialize,
    scratch_path,
)
from salesmart.sources.raw import PARSED_MONEY, clean_raw, load_raw_data, profile
from salesmart.sources.tables import raw_sales_text, sales_record

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

_CACHE: dict[tuple, object] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _memo(spark: SparkSession, key: tuple, build):
    k = (spark.sparkContext.applicationId,) + key
    if k not in _CACHE:
        _CACHE[k] = build()
    return _CACHE[k]


def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_record(spark, sf_dir)


def messy_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw-text record, cleaned the way a raw file is."""
    return clean_raw(raw_sales_text(spark, sf_dir))


def _record(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The sales record of the tables, joined (and cleaned) once and stored:
    dimensions, checks and fact then read columns, where a lazy record would
    be joined and parsed again in each of them."""
    def build():
        make = {"clean": clean_sales, "messy": messy_sales}[kind]
        with conf_for(spark, SMALL_FUNCTIONS):
            return materialize(make(spark, sf_dir), f"{kind}-record", **PACKED)

    return _memo(spark, (kind, "record", sf_dir), build)


def _warehouse(spark: SparkSession, sf_dir: str, kind: str, cfg: EtlConfig | None = None) -> Warehouse:
    """The four tables computed once into one folder (``stats["dir"]``) and
    read back, as a user queries a stored warehouse; rejected rows and orphans
    stay lazy."""
    def build():
        folder = scratch_path(spark, kind)
        wh = build_warehouse(_record(spark, sf_dir, kind), cfg, folder=folder)
        wh.stats["dir"] = folder
        return wh

    return _memo(spark, (kind, sf_dir), build)


def clean_wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return _warehouse(spark, sf_dir, "clean")


def messy_wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return _warehouse(spark, sf_dir, "messy", EtlConfig())


# ----------------------------------------------------------------------------
# Warehouse tables
# ----------------------------------------------------------------------------

@register("dim_date", O.clean(" SELECT * FROM dim_date"))
def q_dim_date(spark, sf_dir):
    return clean_wh(spark, sf_dir).dim_date


@register("dim_item", O.clean(" SELECT * FROM dim_item"))
def q_dim_item(spark, sf_dir):
    return clean_wh(spark, sf_dir).dim_item


@register("dim_buyer", O.clean(" SELECT * FROM dim_buyer"))
def q_dim_buyer(spark, sf_dir):
    return clean_wh(spark, sf_dir).dim_buyer


_FACT_OUT = """
SELECT date_key, item_key, buyer_key, transaction_id, final_quantity,
       CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(price_reductions AS DOUBLE) AS price_reductions,
       CAST(refunds AS DOUBLE) AS refunds,
       CAST(final_revenue AS DOUBLE) AS final_revenue,
       CAST(sales_tax AS DOUBLE) AS sales_tax,
       CAST(overall_revenue AS DOUBLE) AS overall_revenue,
       refunded_item_count, purchased_item_count
FROM fact"""


def _money_double(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
        for c, t in df.dtypes
    ])


@register("fact_sales", O.clean(_FACT_OUT))
def q_fact_sales(spark, sf_dir):
    return _money_double(clean_wh(spark, sf_dir).fact)


# ----------------------------------------------------------------------------
# V1–V9 analytics views
# ----------------------------------------------------------------------------

def _view_sql(cte: str) -> str:
    return O.compose(O.CLEAN, [cte], f"SELECT * FROM {cte}")


@register("vw_date", O.clean(" SELECT * FROM vw_date"))
def q_vw_date(spark, sf_dir):
    return V.vw_date(clean_wh(spark, sf_dir).dim_date)


@register("sales_daily", _view_sql("daily"))
def q_sales_daily(spark, sf_dir):
    wh = clean_wh(spark, sf_dir)
    return V.sales_daily(wh.dim_date, wh.fact)


def _clv(spark, sf_dir):
    wh = clean_wh(spark, sf_dir)
    return V.clv_per_buyer(wh.dim_date, wh.dim_buyer, wh.fact)


@register("clv_per_buyer", _view_sql("clv"))
def q_clv(spark, sf_dir):
    return _clv(spark, sf_dir)


@register("churn_summary", _view_sql("churn"))
def q_churn_summary(spark, sf_dir):
    return V.churn_summary(_clv(spark, sf_dir))


@register("return_rates_item", _view_sql("rri"))
def q_return_item(spark, sf_dir):
    wh = clean_wh(spark, sf_dir)
    return V.return_rates_item(wh.dim_date, wh.dim_item, wh.fact)


@register("return_rates_category", _view_sql("rrc"))
def q_return_cat(spark, sf_dir):
    wh = clean_wh(spark, sf_dir)
    return V.return_rates_category(wh.dim_date, wh.dim_item, wh.fact)


@register("churn_cohorts", _view_sql("coh"))
def q_cohorts(spark, sf_dir):
    wh = clean_wh(spark, sf_dir)
    return V.churn_cohorts(wh.dim_date, wh.fact)


@register("item_performance", _view_sql("perf"))
def q_item_perf(spark, sf_dir):
    wh = clean_wh(spark, sf_dir)
    return V.item_performance(wh.dim_item, wh.fact)


@register("promo_revenue_daily", _view_sql("promo"))
def q_promo(spark, sf_dir):
    wh = clean_wh(spark, sf_dir)
    return V.promo_revenue_daily(wh.dim_date, wh.fact)


# ----------------------------------------------------------------------------
# Measures M1–M22 and dashboard derivations B1–B5, O2
# ----------------------------------------------------------------------------

class _Views:
    """Views of the clean warehouse, each built only when first used."""

    def __init__(self, spark, sf_dir):
        self.wh = clean_wh(spark, sf_dir)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name == "wh":
            return self.wh
        if name not in self._built:
            wh = self.wh
            make = {
                "daily": lambda: V.sales_daily(wh.dim_date, wh.fact),
                "clv": lambda: V.clv_per_buyer(wh.dim_date, wh.dim_buyer, wh.fact),
                "churn": lambda: V.churn_summary(self["clv"]),
                "rri": lambda: V.return_rates_item(wh.dim_date, wh.dim_item, wh.fact),
                "rrc": lambda: V.return_rates_category(wh.dim_date, wh.dim_item, wh.fact),
                "coh": lambda: V.churn_cohorts(wh.dim_date, wh.fact),
                "perf": lambda: V.item_performance(wh.dim_item, wh.fact),
                "metrics": lambda: V.item_metrics(wh.dim_item, wh.fact),
                "promo": lambda: V.promo_revenue_daily(wh.dim_date, wh.fact),
            }
            self._built[name] = make[name]()
        return self._built[name]


def _views(spark, sf_dir) -> _Views:
    return _Views(spark, sf_dir)


_MONTHLY = """
SELECT year, month, year_month, ROUND(SUM(daily_revenue), 2) AS total_revenue,
       CAST(SUM(daily_orders) AS BIGINT) AS total_orders
FROM daily GROUP BY year, month, year_month"""


@register("monthly_sales", O.compose(O.CLEAN, ["daily"], _MONTHLY))
def q_monthly(spark, sf_dir):
    """M1 / M4 per month through the generic filter-context evaluator."""
    return M.measure(_views(spark, sf_dir)["daily"], M.sales_measures(),
                     by=["year", "month", "year_month"])


@register("rolling_7d", O.compose(O.CLEAN, ["roll"], "SELECT * FROM roll"))
def q_rolling(spark, sf_dir):
    return M.rolling_7d(_views(spark, sf_dir)["daily"])


@register("active_buyers", O.compose(O.CLEAN, ["act"], "SELECT * FROM act"))
def q_active(spark, sf_dir):
    v = _views(spark, sf_dir)
    return M.active_buyers(v["wh"].dim_date, v["clv"])


def _chg(cur: str, pri: str) -> str:
    return (f"CASE WHEN CAST({pri} AS DOUBLE) <> 0 THEN CAST({cur} AS DOUBLE) / CAST({pri} AS DOUBLE)"
            f" END - 1 AS {cur}_change")


_EXEC = f"""
SELECT r.full_date, revenue_7d, revenue_prior_7d, {_chg('revenue_7d', 'revenue_prior_7d')},
       orders_7d, orders_prior_7d, {_chg('orders_7d', 'orders_prior_7d')},
       aov_7d, aov_prior_7d, {_chg('aov_7d', 'aov_prior_7d')},
       active_buyers_7d, active_buyers_prior_7d,
       {_chg('active_buyers_7d', 'active_buyers_prior_7d')}
FROM roll r JOIN act a ON a.full_date = r.full_date"""


@register("exec_kpis", O.compose(O.CLEAN, ["roll", "act"], _EXEC))
def q_exec(spark, sf_dir):
    wh = clean_wh(spark, sf_dir)
    return cube.exec_kpis(wh.dim_date, wh.fact)


_ROLLING_TOTALS = f""",
ends AS (SELECT year_month, MAX(full_date) AS last_day FROM daily GROUP BY ROLLUP (year_month)),
sums AS (
  SELECT e.year_month, e.last_day AS full_date,
         ROUND(SUM(daily_revenue) FILTER (WHERE d.full_date > last_day - 7), 2) AS revenue_7d,
         ROUND(SUM(daily_revenue) FILTER (WHERE d.full_date <= last_day - 7), 2) AS revenue_prior_7d,
         CAST(SUM(daily_orders) FILTER (WHERE d.full_date > last_day - 7) AS BIGINT) AS orders_7d,
         CAST(SUM(daily_orders) FILTER (WHERE d.full_date <= last_day - 7) AS BIGINT) AS orders_prior_7d
  FROM ends e JOIN daily d ON d.full_date BETWEEN last_day - 13 AND last_day
  GROUP BY e.year_month, e.last_day),
buyers AS (
  SELECT e.year_month, e.last_day AS full_date,
         NULLIF(COUNT(*) FILTER (WHERE last_purchase_date >= last_day - 7), 0) AS active_buyers_7d,
         NULLIF(COUNT(*) FILTER (WHERE last_purchase_date <= last_day - 7), 0) AS active_buyers_prior_7d
  FROM ends e JOIN clv ON last_purchase_date BETWEEN last_day - 14 AND last_day
  GROUP BY e.year_month, e.last_day),
vals AS (
  SELECT s.*, CASE WHEN orders_7d <> 0 THEN revenue_7d / CAST(orders_7d AS DOUBLE) END AS aov_7d,
         CASE WHEN orders_prior_7d <> 0 THEN revenue_prior_7d / CAST(orders_prior_7d AS DOUBLE) END AS aov_prior_7d,
         active_buyers_7d, active_buyers_prior_7d
  FROM sums s LEFT JOIN buyers b
    ON b.full_date = s.full_date AND b.year_month IS NOT DISTINCT FROM s.year_month)
SELECT *, {_chg('revenue_7d', 'revenue_prior_7d')}, {_chg('orders_7d', 'orders_prior_7d')},
       {_chg('aov_7d', 'aov_prior_7d')}, {_chg('active_buyers_7d', 'active_buyers_prior_7d')}
FROM vals"""


@register("rolling_totals", O.compose(O.CLEAN, ["daily", "clv"], _ROLLING_TOTALS))
def q_rolling_totals(spark, sf_dir):
    """Rolling measures at the last day of each month and of the calendar."""
    v = _views(spark, sf_dir)
    return M.rolling_totals(v["wh"].dim_date, v["daily"], v["clv"])


_TOTALS = """,
tk AS (
  SELECT
    (SELECT ROUND(SUM(daily_revenue), 2) FROM daily) AS total_revenue,
    (SELECT CAST(SUM(daily_orders) AS BIGINT) FROM daily) AS total_orders,
    (SELECT ROUND(AVG(discount_share), 9) FROM perf) AS discount_share,
    (SELECT COUNT(DISTINCT buyer_id) FROM dim_buyer) AS total_buyers,
    (SELECT CASE WHEN COUNT(*) FILTER (WHERE is_churned_30d) > 0
                 THEN COUNT(*) FILTER (WHERE is_churned_30d) END FROM churn) AS churned_buyers_30d,
    (SELECT CAST(SUM(purchased_qty) AS BIGINT) FROM rri) AS purchased_qty,
    (SELECT CAST(SUM(refunded_qty) AS BIGINT) FROM rri) AS returned_qty,
    (SELECT ROUND(SUM(revenue) FILTER (WHERE is_promo), 2) FROM promo) AS promo_revenue,
    (SELECT ROUND(SUM(revenue) FILTER (WHERE NOT is_promo), 2) FROM promo) AS non_promo_revenue
)
SELECT *,
  CASE WHEN total_buyers <> 0 THEN CAST(churned_buyers_30d AS DOUBLE) / CAST(total_buyers AS DOUBLE) END
    AS churn_rate_30d,
  CASE WHEN purchased_qty <> 0 THEN CAST(returned_qty AS DOUBLE) / CAST(purchased_qty AS DOUBLE) END
    AS return_rate,
  CASE WHEN promo_revenue + non_promo_revenue <> 0
       THEN promo_revenue / (promo_revenue + non_promo_revenue) END AS promo_share
FROM tk"""


@register("total_kpis", O.compose(O.CLEAN, ["daily", "perf", "churn", "rri", "promo"], _TOTALS))
def q_totals(spark, sf_dir):
    wh = clean_wh(spark, sf_dir)
    return cube.total_kpis(wh.dim_date, wh.dim_buyer, wh.fact)


_RR_ITEM = """
SELECT item_key, item_code, item_name, category,
       CAST(SUM(purchased_qty) AS BIGINT) AS purchased_qty,
       CAST(SUM(refunded_qty) AS BIGINT) AS returned_qty,
       CASE WHEN SUM(purchased_qty) <> 0
            THEN CAST(SUM(refunded_qty) AS DOUBLE) / CAST(SUM(purchased_qty) AS DOUBLE) END
         AS return_rate
FROM rri GROUP BY item_key, item_code, item_name, category"""


@register("return_rate_item", O.compose(O.CLEAN, ["rri"], _RR_ITEM))
def q_rr_item(spark, sf_dir):
    return M.return_rate_by_item(_views(spark, sf_dir)["rri"])


_RR_CAT = """
SELECT category, CAST(SUM(purchased_qty) AS BIGINT) AS purchased_qty,
       CAST(SUM(refunded_qty) AS BIGINT) AS returned_qty,
       CASE WHEN SUM(purchased_qty) <> 0
            THEN CAST(SUM(refunded_qty) AS DOUBLE) / CAST(SUM(purchased_qty) AS DOUBLE) END
         AS return_rate
FROM rrc GROUP BY category"""


@register("return_rate_category", O.compose(O.CLEAN, ["rrc"], _RR_CAT))
def q_rr_cat(spark, sf_dir):
    return M.return_rate_by_category(_views(spark, sf_dir)["rrc"])


_PROMO_SHARE = """,
ps AS (
  SELECT year_month, ROUND(SUM(revenue) FILTER (WHERE is_promo), 2) AS promo_revenue,
         ROUND(SUM(revenue) FILTER (WHERE NOT is_promo), 2) AS non_promo_revenue
  FROM promo GROUP BY year_month
)
SELECT *, CASE WHEN promo_revenue + non_promo_revenue <> 0
               THEN promo_revenue / (promo_revenue + non_promo_revenue) END AS promo_share
FROM ps"""


@register("promo_share", O.compose(O.CLEAN, ["promo"], _PROMO_SHARE))
def q_promo_share(spark, sf_dir):
    return M.promo_share_by_month(_views(spark, sf_dir)["promo"])


_DISC = """
SELECT category, ROUND(AVG(discount_share), 9) AS discount_share, COUNT(*) AS n_items
FROM perf GROUP BY category"""


@register("discount_share", O.compose(O.CLEAN, ["perf"], _DISC))
def q_discount(spark, sf_dir):
    return M.discount_share_by_category(_views(spark, sf_dir)["metrics"])


_CHURN_RATE = """,
cr AS (
  SELECT (SELECT COUNT(DISTINCT buyer_id) FROM dim_buyer) AS total_buyers,
         CASE WHEN COUNT(*) FILTER (WHERE is_churned_30d) > 0
              THEN COUNT(*) FILTER (WHERE is_churned_30d) END AS churned_buyers_30d
  FROM churn
)
SELECT total_buyers, churned_buyers_30d,
       CASE WHEN total_buyers <> 0
            THEN CAST(churned_buyers_30d AS DOUBLE) / CAST(total_buyers AS DOUBLE) END
         AS churn_rate_30d
FROM cr"""


@register("churn_rate", O.compose(O.CLEAN, ["churn"], _CHURN_RATE))
def q_churn_rate(spark, sf_dir):
    v = _views(spark, sf_dir)
    return M.churn_rate(v["wh"].dim_buyer, v["churn"])


@register("top_items", O.compose(O.CLEAN, ["perf"], "SELECT * FROM perf WHERE revenue_rank <= 10"))
def q_top_items(spark, sf_dir):
    return M.top_items(_views(spark, sf_dir)["perf"], 10)


_HIST = """,
hb AS (SELECT MIN(total_revenue) AS lo, MAX(total_revenue) AS hi FROM clv),
hx AS (
  SELECT CASE WHEN hi = lo THEN CAST(1 AS BIGINT)
              ELSE LEAST(CAST(floor((total_revenue - lo) * 10.0 / (hi - lo)) AS BIGINT) + 1,
                         CAST(10 AS BIGINT)) END AS bin
  FROM clv, hb
)
SELECT bin, lo + (bin - 1) * ((hi - lo) / 10.0) AS bin_low, lo + bin * ((hi - lo) / 10.0) AS bin_high,
       n_buyers
FROM (SELECT bin, COUNT(*) AS n_buyers FROM hx GROUP BY bin), hb"""


@register("clv_histogram", O.compose(O.CLEAN, ["clv"], _HIST))
def q_hist(spark, sf_dir):
    return M.clv_histogram(_views(spark, sf_dir)["clv"], 10)


_STATUS = """
SELECT CASE WHEN is_never_purchased THEN 'never_purchased'
            WHEN is_churned_30d THEN 'churned' ELSE 'active' END AS status,
       COUNT(*) AS n_buyers
FROM churn GROUP BY 1"""


@register("buyer_status_split", O.compose(O.CLEAN, ["churn"], _STATUS))
def q_status(spark, sf_dir):
    return M.buyer_status_split(_views(spark, sf_dir)["churn"])


#: Months of the test tables' calendar, 1992-01 to 1998-08.
_TABLE_MONTHS = 80


@register("cohort_matrix", O.compose(
    O.CLEAN, ["coh"],
    "SELECT cohort_month, " + ", ".join(
        f'MAX(retention_rate) FILTER (WHERE months_since_cohort = {k}) AS "{k}"' for k in range(_TABLE_MONTHS))
    + " FROM coh GROUP BY cohort_month"))
def q_cohort_matrix(spark, sf_dir):
    months = M.calendar_months(clean_wh(spark, sf_dir).dim_date)
    return M.cohort_matrix(_views(spark, sf_dir)["coh"], months)


# ----------------------------------------------------------------------------
# ETL stages on the raw-text record (cleaning, dimensions, validation, fact)
# ----------------------------------------------------------------------------

_REC_COLS = ("item_name", "category", "version", "item_code", "item_id", "buyer_id",
             "transaction_id", "date", "final_quantity", "total_revenue", "price_reductions",
             "refunds", "final_revenue", "sales_tax", "overall_revenue", "refunded_item_count",
             "purchased_item_count")
_MONEY = ("total_revenue", "price_reductions", "refunds", "final_revenue", "sales_tax",
          "overall_revenue")


def _rec_select(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return ", ".join(
        f"CAST({p}{c} AS DOUBLE) AS {c}" if c in _MONEY else f"{p}{c}" for c in _REC_COLS
    )


def _messy(spark, sf_dir) -> DataFrame:
    return _record(spark, sf_dir, "messy")


@register("clean_record", O.messy(f" SELECT {_rec_select()} FROM rec"))
def q_clean_record(spark, sf_dir):
    return _money_double(_messy(spark, sf_dir).drop("_seq"))


# Spark type names of the cleaned record (the profile reports them).
_REC_TYPES = dict(
    [(c, "string") for c in ("item_name", "category", "version", "item_code")]
    + [(c, "bigint") for c in ("item_id", "buyer_id", "transaction_id")]
    + [("date", "date")]
    + [(c, "int") for c in ("final_quantity", "refunded_item_count", "purchased_item_count")]
    + [(c, PARSED_MONEY) for c in _MONEY]
)
_PROFILE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{_REC_TYPES[c]}' AS data_type, CAST(COUNT(*) AS BIGINT) AS n_rows,"
    f" CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS n_nulls FROM rec"
    for c in _REC_COLS
)


@register("profile_raw", O.messy(" " + _PROFILE))
def q_profile(spark, sf_dir):
    return profile(_messy(spark, sf_dir))


@register("canonical_category", O.messy(
    " SELECT DISTINCT \"Category\" AS raw_category, " + O._CANON.format(c='"Category"')
    + " AS category FROM raw"))
def q_canon(spark, sf_dir):
    raw = raw_sales_text(spark, sf_dir)
    return raw.select(
        F.col("Category").alias("raw_category"),
        canonical_category(F.col("Category")).alias("category"),
    ).distinct()


@register("dim_item_mode", O.messy(" SELECT * FROM dim_item"))
def q_dim_item_mode(spark, sf_dir):
    return messy_wh(spark, sf_dir).dim_item


_PASSTHROUGH = """,
pt AS (
  SELECT DISTINCT item_code, item_id, item_name, """ + O._CANON.format(c="category") + """ AS category,
         version
  FROM rec WHERE item_id IS NOT NULL
)
SELECT row_number() OVER (ORDER BY item_code, CAST(item_id AS VARCHAR), item_name, category, version)
         AS item_key, item_code, item_id, item_name, category, version
FROM pt"""


@register("dim_item_passthrough", O.messy(_PASSTHROUGH))
def q_dim_item_pt(spark, sf_dir):
    return build_item_dimension(_messy(spark, sf_dir),
                                CanonicalizeConfig(item_attributes="distinct"))


@register("dim_buyer_raw", O.messy(" SELECT * FROM dim_buyer"))
def q_dim_buyer_raw(spark, sf_dir):
    return messy_wh(spark, sf_dir).dim_buyer


@register("dim_date_raw", O.messy(" SELECT * FROM dim_date"))
def q_dim_date_raw(spark, sf_dir):
    return messy_wh(spark, sf_dir).dim_date


_FAILS = " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, CAST(COUNT(*) FILTER (WHERE NOT ok_{n}) AS BIGINT) AS n_failed"
    f" FROM flagged"
    for n in ("revenue_balance", "overall_balance", "quantity_balance", "refunded_nonpositive")
)


@register("validation_failures", O.messy(" " + _FAILS))
def q_fails(spark, sf_dir):
    return check_failures(_messy(spark, sf_dir))


@register("validated_rows", O.messy(f" SELECT {_rec_select()} FROM valid"))
def q_valid(spark, sf_dir):
    flagged = flag_rows(_messy(spark, sf_dir))
    return _money_double(flagged.where("is_valid").select(*_REC_COLS))


_REJECTED = f"""
SELECT {_rec_select()},
       concat_ws(',', CASE WHEN NOT ok_revenue_balance THEN 'revenue_balance' END,
                      CASE WHEN NOT ok_overall_balance THEN 'overall_balance' END,
                      CASE WHEN NOT ok_quantity_balance THEN 'quantity_balance' END,
                      CASE WHEN NOT ok_refunded_nonpositive THEN 'refunded_nonpositive' END)
         AS reject_reasons
FROM flagged
WHERE NOT (ok_revenue_balance AND ok_overall_balance AND ok_quantity_balance
           AND ok_refunded_nonpositive)"""


@register("rejected_rows", O.messy(_REJECTED))
def q_rejected(spark, sf_dir):
    flagged = flag_rows(_messy(spark, sf_dir))
    return _money_double(flagged.where(~F.col("is_valid")).select(
        *_REC_COLS, F.array_join("reject_reasons", ",").alias("reject_reasons")))


_DROP = """,
dr AS (SELECT CAST(COUNT(*) AS BIGINT) AS n_rows,
              CAST(COUNT(*) FILTER (WHERE ok_revenue_balance AND ok_overall_balance
                                    AND ok_quantity_balance AND ok_refunded_nonpositive) AS BIGINT)
                AS n_valid
       FROM flagged)
SELECT n_rows, n_valid, n_rows - n_valid AS n_rejected,
       CAST(n_rows - n_valid AS DOUBLE) / GREATEST(n_rows, 1) AS drop_rate
FROM dr"""


@register("drop_rate", O.messy(_DROP))
def q_drop(spark, sf_dir):
    return drop_rate(flag_rows(_messy(spark, sf_dir)))


@register("fact_sales_raw", O.messy(_FACT_OUT))
def q_fact_raw(spark, sf_dir):
    return _money_double(messy_wh(spark, sf_dir).fact)


def _land(writer: DataFrameWriter, path: str) -> None:
    """Raw CSV files with a header, packed, and of a bounded number of rows, as
    a packed file is read by one task."""
    writer.options(header=True, compression="gzip", maxRecordsPerFile=1_000_000).csv(path)


def _landed_loads(spark, sf_dir) -> tuple[Warehouse, str]:
    """Two CSV files, their columns in another order and one more, loaded one
    after the other by ``run_pipeline``; the second load runs twice.  A file
    that no load needs any more goes; what the runs wrote stays."""
    def build():
        raw = raw_sales_text(spark, sf_dir).drop("_seq").withColumn("Remark", F.lit("x, y"))
        raw = raw.select(*reversed(raw.columns))
        out = scratch_path(spark, "two-loads")
        late = F.coalesce(F.pmod(clean_id("Transaction ID"), F.lit(2)) == 1, F.lit(False))
        with conf_for(spark, {**SMALL_FUNCTIONS, **OPEN_FOLDERS, **DROP_SHUFFLES}):
            _land(raw.withColumn("file", F.when(late, F.lit("b")).otherwise(F.lit("a"))).write.partitionBy("file"),
                  f"{out}/raw")
        for name, times in (("a", 1), ("b", 2)):
            cfg = EtlConfig(source=SourceConfig(path=f"{out}/raw/file={name}"))
            for _ in range(times):
                run_pipeline(spark, load_raw_data(spark, cfg.source), f"{out}/runs/{name}", cfg,
                             warehouse_dir=f"{out}/warehouse")
            drop_path(spark, cfg.source.path)
        return f"{out}/warehouse"

    path = _memo(spark, ("two-loads", sf_dir), build)
    return read_warehouse(spark, path), path


_TWO_LOADS = f"""
SELECT d.full_date, i.item_code, b.buyer_id, f.* EXCLUDE (date_key, item_key, buyer_key)
FROM ({_FACT_OUT}) f JOIN dim_date d USING (date_key) JOIN dim_item i USING (item_key)
JOIN dim_buyer b USING (buyer_key)"""


_KEY_ORDER = ", ".join(FACT_COLUMNS)


@register("fact_keys", O.clean(f",\nout AS ({_FACT_OUT}) SELECT row_number() OVER (ORDER BY {_KEY_ORDER}) AS fact_key, * FROM out"))
def q_fact_keys(spark, sf_dir):
    """K1: the fact numbered without gaps, by date, item, buyer and all other columns."""
    return _money_double(with_fact_key(clean_wh(spark, sf_dir).fact))


# Both loads number what the one before did not have; the fact's rows are
# numbered load by load.
_TWO_LOAD_KEYS = f""",
part AS (SELECT *, COALESCE(transaction_id % 2 = 1, false) AS late FROM rec),
span AS (SELECT late, MIN(date) AS lo, MAX(date) AS hi FROM part GROUP BY late),
span_day AS (
  SELECT late, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
  FROM span
),
day_no AS (
  SELECT date, CAST(row_number() OVER (ORDER BY bool_and(late), date) AS INTEGER) AS date_key FROM span_day GROUP BY date
),
item_no AS (
  SELECT item_code, row_number() OVER (ORDER BY bool_and(late), item_code) AS item_key
  FROM part WHERE item_code IS NOT NULL AND item_id IS NOT NULL GROUP BY item_code
),
buyer_no AS (
  SELECT buyer_id, row_number() OVER (ORDER BY bool_and(late), buyer_id) AS buyer_key
  FROM part WHERE buyer_id IS NOT NULL GROUP BY buyer_id
),
loaded AS (
  SELECT transaction_id % 2 = 1 AS late, date_key, item_key, buyer_key, transaction_id, final_quantity,
         CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(price_reductions AS DOUBLE) AS price_reductions,
         CAST(refunds AS DOUBLE) AS refunds, CAST(final_revenue AS DOUBLE) AS final_revenue,
         CAST(sales_tax AS DOUBLE) AS sales_tax, CAST(overall_revenue AS DOUBLE) AS overall_revenue,
         refunded_item_count, purchased_item_count
  FROM valid JOIN day_no USING (date) JOIN item_no USING (item_code) JOIN buyer_no USING (buyer_id)
  WHERE transaction_id IS NOT NULL
)
SELECT row_number() OVER (ORDER BY late, {_KEY_ORDER}) AS fact_key, {_KEY_ORDER} FROM loaded"""


@register("fact_keys_two_loads", O.messy(_TWO_LOAD_KEYS))
def q_fact_keys_two_loads(spark, sf_dir):
    """K1 over the two landed loads: the second goes on where the first ends,
    and keeps its numbers when it runs again."""
    return _money_double(_landed_loads(spark, sf_dir)[0].fact.select("fact_key", *FACT_COLUMNS))


_DRY_RUN = """,
code AS (SELECT item_code, COUNT(item_id) AS n_ids FROM rec WHERE item_code IS NOT NULL GROUP BY item_code),
seen AS (
  SELECT (SELECT COUNT(*) FROM rec) AS n_rows, (SELECT COUNT(*) FROM valid) AS n_valid,
         (SELECT COUNT(*) FROM rec WHERE buyer_id IS NULL) AS null_buyer_id_rows,
         (SELECT COUNT(*) FROM rec WHERE item_code IS NULL) AS null_item_code_rows,
         (SELECT COUNT(*) FROM code WHERE n_ids = 0) AS items_without_id,
         (SELECT COUNT(*) FROM dim_date) AS dim_date_rows, (SELECT COUNT(*) FROM code WHERE n_ids > 0) AS dim_item_rows,
         (SELECT COUNT(DISTINCT buyer_id) FROM rec) AS dim_buyer_rows
),
full_row AS (SELECT *, n_rows - n_valid AS n_rejected FROM seen)
SELECT metric, CAST(value AS DOUBLE) AS value FROM (UNPIVOT full_row ON COLUMNS(*) INTO NAME metric VALUE value)
UNION ALL SELECT 'drop_rate', CAST(n_rejected AS DOUBLE) / GREATEST(n_rows, 1) FROM full_row"""


@register("dry_run_counts", O.messy(_DRY_RUN))
def q_dry_run(spark, sf_dir):
    """The counts of a dry run over a landed raw file."""
    out = scratch_path(spark, "dry-run-raw")
    with conf_for(spark, SMALL_FUNCTIONS):
        _land(raw_sales_text(spark, sf_dir).drop("_seq").write, out)
    cfg = EtlConfig(source=SourceConfig(path=out))
    return dry_run_counts(spark, load_raw_data(spark, cfg.source), cfg)


@register("pipeline_two_loads", O.messy(_TWO_LOADS))
def q_pipeline_two_loads(spark, sf_dir):
    wh = _landed_loads(spark, sf_dir)[0]
    # The item's code is text: it comes last, so that no shuffle of the fact carries it.
    rows = (wh.fact.join(wh.dim_date.select("date_key", "full_date"), "date_key")
            .join(wh.dim_buyer.select("buyer_key", "buyer_id"), "buyer_key")
            .join(wh.dim_item.select("item_key", "item_code"), "item_key"))
    return _money_double(rows.select("full_date", "item_code", "buyer_id",
                                     *[c for c in wh.fact.columns if not c.endswith("_key")]))


_ORPHANS = f"""
SELECT {_rec_select()}, date_key, item_key, buyer_key,
       concat_ws(',', CASE WHEN date_key IS NULL THEN 'date_key' END,
                      CASE WHEN item_key IS NULL THEN 'item_key' END,
                      CASE WHEN buyer_key IS NULL THEN 'buyer_key' END,
                      CASE WHEN transaction_id IS NULL THEN 'transaction_id' END) AS missing
FROM looked
WHERE date_key IS NULL OR item_key IS NULL OR buyer_key IS NULL OR transaction_id IS NULL"""


@register("fact_orphans", O.messy(_ORPHANS))
def q_orphans(spark, sf_dir):
    orphans = messy_wh(spark, sf_dir).orphans
    return _money_double(orphans.select(*_REC_COLS, "date_key", "item_key", "buyer_key",
                                        F.array_join("missing", ",").alias("missing")))


# ----------------------------------------------------------------------------
# Constraint report (C1–C5) and incremental dimension loads
# ----------------------------------------------------------------------------

def _rule(table: str, name: str, pred: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{name}' AS constraint_name, "
            f"CAST(COUNT(*) FILTER (WHERE NOT COALESCE({pred}, false)) AS BIGINT) AS violations "
            f"FROM {table}")


def _uniq(table: str, key: str) -> str:
    return (f"SELECT '{table}' AS table_name, 'unique_{key}' AS constraint_name, "
            f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS violations FROM "
            f"(SELECT {key}, COUNT(*) AS n FROM {table} GROUP BY {key} HAVING COUNT(*) > 1)")


def _fk(key: str, dim: str) -> str:
    return (f"SELECT 'fact_sales' AS table_name, 'fk_{key}' AS constraint_name, "
            f"CAST(COUNT(*) AS BIGINT) AS violations FROM fact f "
            f"WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = f.{key})")


_FACT_NOT_NULL = ("date_key", "item_key", "buyer_key", "transaction_id", "final_quantity",
                  "total_revenue", "price_reductions", "refunds", "final_revenue", "sales_tax",
                  "overall_revenue", "refunded_item_count", "purchased_item_count")
_CONSTRAINTS = ",\nfact_sales AS (SELECT * FROM fact)\n" + "\nUNION ALL\n".join(
    [_rule("dim_date", f"not_null_{c}", f"{c} IS NOT NULL")
     for c in ("full_date", "year", "quarter", "month", "day", "is_weekend")]
    + [_rule("dim_date", "check_quarter", "quarter BETWEEN 1 AND 4"),
       _rule("dim_date", "check_month", "month BETWEEN 1 AND 12"),
       _rule("dim_date", "check_day", "day BETWEEN 1 AND 31"),
       _uniq("dim_date", "full_date"), _uniq("dim_date", "date_key")]
    + [_rule("dim_item", f"not_null_{c}", f"{c} IS NOT NULL")
       for c in ("item_code", "item_id", "item_name", "version")]
    + [_uniq("dim_item", "item_code"), _uniq("dim_item", "item_key"),
       _rule("dim_buyer", "not_null_buyer_id", "buyer_id IS NOT NULL"),
       _uniq("dim_buyer", "buyer_id"), _uniq("dim_buyer", "buyer_key")]
    + [_rule("fact_sales", f"not_null_{c}", f"{c} IS NOT NULL") for c in _FACT_NOT_NULL]
    + [_rule("fact_sales", "check_purchased_nonnegative", "purchased_item_count >= 0"),
       _rule("fact_sales", "ck_revenue_1",
             "final_revenue = total_revenue + price_reductions + refunds"),
       _rule("fact_sales", "ck_revenue_2",
             "abs(overall_revenue - (final_revenue + sales_tax)) <= 0.01"),
       _rule("fact_sales", "ck_qty",
             "final_quantity = purchased_item_count + refunded_item_count"),
       _rule("fact_sales", "ck_refunded", "refunded_item_count <= 0"),
       _fk("date_key", "dim_date"), _fk("item_key", "dim_item"), _fk("buyer_key", "dim_buyer")]
)


@register("constraint_report", O.messy(_CONSTRAINTS))
def q_constraints(spark, sf_dir):
    wh = messy_wh(spark, sf_dir)
    return constraint_report(wh.dim_date, wh.dim_item, wh.dim_buyer, wh.fact)


# First load = orders up to this date; the second load brings the rest.
FIRST_LOAD_UNTIL = "1997-12-31"


def _first_load(spark, sf_dir) -> DataFrame:
    return _record(spark, sf_dir, "clean").where(F.col("date") <= F.lit(FIRST_LOAD_UNTIL).cast("date"))


_FIRST = f""",
rec1 AS (SELECT * FROM rec WHERE date <= DATE '{FIRST_LOAD_UNTIL}'),"""

_NEW_DATES = _FIRST + """
d1 AS (
  SELECT CAST(unnest(generate_series(CAST(MIN(date) AS TIMESTAMP), CAST(MAX(date) AS TIMESTAMP),
                                     INTERVAL 1 DAY)) AS DATE) AS full_date
  FROM rec1
)
SELECT CAST((SELECT COUNT(*) FROM d1) + row_number() OVER (ORDER BY full_date) AS INTEGER)
         AS date_key, full_date, year, quarter, month, day, is_weekend
FROM dim_date WHERE full_date NOT IN (SELECT full_date FROM d1)"""


@register("new_dim_dates", O.clean(_NEW_DATES))
def q_new_dates(spark, sf_dir):
    existing = build_date_dimension(_first_load(spark, sf_dir))
    return new_dates(clean_wh(spark, sf_dir).dim_date, existing)


# Items come in two deliveries: every third number with the second.
_NEW_ITEMS = """,
i1 AS (SELECT DISTINCT item_code FROM rec WHERE item_code IS NOT NULL AND item_id % 3 <> 0)
SELECT (SELECT COUNT(*) FROM i1) + row_number() OVER (ORDER BY item_code) AS item_key,
       item_code, item_id, item_name, category, version
FROM dim_item WHERE item_code NOT IN (SELECT item_code FROM i1)"""


@register("new_dim_items", O.clean(_NEW_ITEMS))
def q_new_items(spark, sf_dir):
    sales = _record(spark, sf_dir, "clean")
    existing = build_item_dimension(sales.where("item_id % 3 <> 0"))
    return new_items(item_attributes(sales), existing)


_NEW_BUYERS = _FIRST + """
b1 AS (SELECT DISTINCT buyer_id FROM rec1 WHERE buyer_id IS NOT NULL)
SELECT (SELECT COUNT(*) FROM b1) + row_number() OVER (ORDER BY buyer_id) AS buyer_key, buyer_id
FROM dim_buyer WHERE buyer_id NOT IN (SELECT buyer_id FROM b1)"""


@register("new_dim_buyers", O.clean(_NEW_BUYERS))
def q_new_buyers(spark, sf_dir):
    existing = build_buyer_dimension(_first_load(spark, sf_dir))
    return new_buyers(buyer_ids(_record(spark, sf_dir, "clean")), existing)


# ----------------------------------------------------------------------------
# Single-operator views of the cleaning and validation steps
# ----------------------------------------------------------------------------

_ID_PAIRS = (("Transaction ID", "transaction_id"), ("Buyer ID", "buyer_id"),
             ("Item ID", "item_id"))


@register("clean_ids", O.messy(
    " SELECT DISTINCT " + ", ".join(
        f'"{raw}" AS raw_{name}, '
        f"TRY_CAST(NULLIF(regexp_replace(\"{raw}\", '[^0-9]', '', 'g'), '') AS BIGINT) AS {name}"
        for raw, name in _ID_PAIRS) + " FROM raw"))
def q_clean_ids(spark, sf_dir):
    """The three id columns, raw text next to the cleaned BIGINT."""
    raw = raw_sales_text(spark, sf_dir)
    cols = []
    for src, name in _ID_PAIRS:
        cols += [F.col(f"`{src}`").alias(f"raw_{name}"), clean_id(F.col(f"`{src}`")).alias(name)]
    return raw.select(*cols).distinct()


@register("parse_dates", O.messy(
    ' SELECT DISTINCT "Date" AS raw_date, '
    "CAST(try_strptime(ltrim(\"Date\"), '%d/%m/%Y') AS DATE) AS date FROM raw"))
def q_parse_dates(spark, sf_dir):
    """Raw date text and the parsed DATE (NULL when impossible)."""
    raw = raw_sales_text(spark, sf_dir)
    return raw.select(F.col("Date").alias("raw_date"),
                      parse_date(F.col("Date"), DEFAULT_DATE_FORMAT).alias("date")).distinct()


def _failing(check: str):
    def q(spark, sf_dir):
        expr = check_expressions()[check]
        return _money_double(_messy(spark, sf_dir).where(~expr).select(*_REC_COLS))
    q.__doc__ = f"Rows failing the {check} check (E9–E12)."
    return q


for _name, _check in (("validate_revenue", "revenue_balance"),
                      ("validate_overall", "overall_balance"),
                      ("validate_quantity", "quantity_balance"),
                      ("validate_refunded", "refunded_nonpositive")):
    register(_name, O.messy(f" SELECT {_rec_select()} FROM flagged WHERE NOT ok_{_check}"))(
        _failing(_check))


@register("aov_7d", O.compose(O.CLEAN, ["roll"], "SELECT full_date, aov_7d, aov_prior_7d FROM roll"))
def q_aov(spark, sf_dir):
    """M7: average order value over the rolling 7 days (and the prior 7)."""
    return M.rolling_7d(_views(spark, sf_dir)["daily"]).select("full_date", "aov_7d",
                                                                "aov_prior_7d")


# ----------------------------------------------------------------------------
# Views over the warehouse the ETL builds from the raw-text record
# (cleaning, validation and orphan removal upstream of the view)
# ----------------------------------------------------------------------------

@register("sales_daily_raw", O.compose(O.MESSY, ["daily"], "SELECT * FROM daily"))
def q_sales_daily_raw(spark, sf_dir):
    wh = messy_wh(spark, sf_dir)
    return V.sales_daily(wh.dim_date, wh.fact)


@register("clv_per_buyer_raw", O.compose(O.MESSY, ["clv"], "SELECT * FROM clv"))
def q_clv_raw(spark, sf_dir):
    wh = messy_wh(spark, sf_dir)
    return V.clv_per_buyer(wh.dim_date, wh.dim_buyer, wh.fact)


@register("item_performance_raw", O.compose(O.MESSY, ["perf"], "SELECT * FROM perf"))
def q_item_perf_raw(spark, sf_dir):
    wh = messy_wh(spark, sf_dir)
    return V.item_performance(wh.dim_item, wh.fact)


# ----------------------------------------------------------------------------
# The views published in the session catalog, read by name
# ----------------------------------------------------------------------------

def _published(spark, sf_dir) -> str:
    def build():
        publish_views(spark, clean_wh(spark, sf_dir).stats["dir"], name := f"sales_{len(_CACHE)}")
        return name

    return _memo(spark, ("published", sf_dir), build)


def _by_name(view: str):
    def q(spark, sf_dir):
        return spark.table(f"{_published(spark, sf_dir)}.{view}")
    q.__doc__ = f"{view}, published in the session catalog and read by name."
    return q


for _view, _cte in VIEW_NAMES.items():
    register(f"published_{_view}", O.clean(" SELECT * FROM vw_date") if _view == "vw_date" else _view_sql(_cte))(
        _by_name(_view))
