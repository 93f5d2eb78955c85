"""Warehouse assembly (E18) and publication."""

from __future__ import annotations

import hashlib
import logging
import time
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesmart.config import EtlConfig
from salesmart.operators import dims as dims_op
from salesmart.operators.constraints import assert_constraints, constraint_report
from salesmart.operators.fact import (
    FACT_COLUMNS,
    NATURAL_COLUMNS,
    complete_keys,
    fact_source,
    lookup_keys,
    same_natural,
    split_fact,
    staged_source,
)
from salesmart.operators.keys import dense_row_keys
from salesmart.operators.validate import check_expressions, drop_rate, flag_rows, gate
from salesmart.session import (
    DROP_SHUFFLES,
    OPEN_FOLDERS,
    PACKED,
    SMALL_FUNCTIONS,
    conf_for,
    materialize,
    scratch_dropped,
    scratch_path,
)
from salesmart.sources.raw import null_counts

log = logging.getLogger("salesmart")

TABLE_NAMES = ("dim_date", "dim_item", "dim_buyer", "fact_sales")


@dataclass
class Warehouse:
    dim_date: DataFrame
    dim_item: DataFrame
    dim_buyer: DataFrame
    fact: DataFrame
    rejected: DataFrame | None = None
    orphans: DataFrame | None = None
    stats: dict = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_date": self.dim_date, "dim_item": self.dim_item,
                "dim_buyer": self.dim_buyer, "fact_sales": self.fact}

    def views(self) -> dict[str, DataFrame]:
        """The nine analytics views over these tables (lazy)."""
        from salesmart.plans import views as V

        clv = V.clv_per_buyer(self.dim_date, self.dim_buyer, self.fact)
        return {
            "vw_date": V.vw_date(self.dim_date),
            "vw_sales_daily": V.sales_daily(self.dim_date, self.fact),
            "vw_clv_per_buyer": clv,
            "vw_return_rates_item": V.return_rates_item(self.dim_date, self.dim_item, self.fact),
            "vw_return_rates_category": V.return_rates_category(
                self.dim_date, self.dim_item, self.fact),
            "vw_churn_cohorts": V.churn_cohorts(self.dim_date, self.fact),
            "vw_churn_summary": V.churn_summary(clv),
            "vw_item_performance": V.item_performance(self.dim_item, self.fact),
            "vw_promo_revenue_daily": V.promo_revenue_daily(self.dim_date, self.fact),
        }

    def register_views(self, prefix: str = "") -> None:
        """Publish the tables and the nine views as temp views."""
        for name, df in {**self.tables(), **self.views()}.items():
            df.createOrReplaceTempView(prefix + name)


def build_warehouse(sales: DataFrame, cfg: EtlConfig | None = None,
                    enforce_gate: bool = True, folder: str | None = None) -> Warehouse:
    """Dimensions from all (unvalidated) rows, fact from validated rows.

    Actions triggered here: the calendar bounds (1 row), the validation
    gate (1 row) and the key boundaries (a bounded sample) — everything else
    stays lazy.  With a ``folder`` the four tables are written there and read
    back, the dimensions before the fact looks its keys up in them; ``sales``
    should then read stored rows, as every table scans it.
    """
    cfg = cfg or EtlConfig()

    def keep(df: DataFrame, name: str) -> DataFrame:
        if folder is None:
            return df
        df.write.parquet(f"{folder}/{name}")
        return df.sparkSession.read.parquet(f"{folder}/{name}")

    dim_date = keep(dims_op.build_date_dimension(sales), "dim_date")
    dim_item = keep(dims_op.build_item_dimension(sales, cfg.canonicalize), "dim_item")
    dim_buyer = keep(dims_op.build_buyer_dimension(sales), "dim_buyer")
    flagged = flag_rows(sales, cfg.validation)
    stats = {}
    if enforce_gate:
        row = drop_rate(flagged).first()
        stats = row.asDict()
        gate(row, cfg.validation)
    valid = flagged.where("is_valid").drop("is_valid", "reject_reasons")
    rejected = flagged.where(~F.col("is_valid")).drop("is_valid")
    fact = split_fact(lookup_keys(fact_source(valid), dim_date, dim_item, dim_buyer))[0]
    orphans = split_fact(lookup_keys(valid, dim_date, dim_item, dim_buyer))[1]
    return Warehouse(dim_date, dim_item, dim_buyer, keep(fact, "fact_sales"), rejected, orphans, stats)


def read_warehouse(spark: SparkSession, path: str) -> Warehouse:
    """S3: the four tables back from Parquet (a fact stored per day gets its
    columns back in the usual order; ``date_key`` is then the partition
    column, so calendar filters prune fact folders)."""
    t = {n: spark.read.parquet(f"{path.rstrip('/')}/{n}") for n in TABLE_NAMES}
    fact = t["fact_sales"]
    extra = [c for c in fact.columns if c not in (*FACT_COLUMNS, "load_id")]
    fact = fact.select(*FACT_COLUMNS, *extra)
    return Warehouse(t["dim_date"], t["dim_item"], t["dim_buyer"], fact)


#: Order in which fact rows are numbered (K1).
FACT_KEY_ORDER = FACT_COLUMNS


def with_fact_key(fact: DataFrame, start: int = 0, n_rows: int | None = None) -> DataFrame:
    """K1: ``fact_key`` = start+1, start+2, ... in the order of all columns,
    by date first (``row_number()`` over that order)."""
    return dense_row_keys(fact.select(*FACT_COLUMNS), "fact_key", start, FACT_KEY_ORDER, n_rows).select(
        *FACT_COLUMNS, "fact_key")


def next_fact_key(spark: SparkSession, path: str, load_id: str, n_rows: int) -> int:
    """The number that the keys of a load start above.

    A new load goes on after the largest stored key.  A load that runs again
    keeps its range if it has as many rows as before or is the last; else it
    moves behind all others and its old range stays unused."""
    if not _exists(spark, path):
        return 0
    stored = spark.read.parquet(path)
    own = F.col("load_id").cast("string") == load_id
    row = stored.agg(
        F.max(F.when(~own, F.col("fact_key"))).alias("others"), F.min(F.when(own, F.col("fact_key"))).alias("first"),
        F.count_if(own).alias("n")).first()
    others = row["others"] or 0
    if row["first"] is not None and (row["n"] == n_rows or row["first"] > others):
        return row["first"] - 1
    return others


# ----------------------------------------------------------------------------
# End-to-end run with sinks
# ----------------------------------------------------------------------------

@dataclass
class RunResult:
    processed_dir: str
    warehouse_dir: str | None
    counts: dict


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def _write(df: DataFrame, path: str, fmt: str, mode: str = "overwrite", packed: bool = False) -> None:
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.options(**(PACKED if packed and fmt == "parquet" else {})).format(fmt).save(path)


def default_load_id(raw: DataFrame) -> str:
    """An id of the input files' names: the same files load as the same load,
    and a copy of a file under another name is another load (with
    ``EtlConfig.load_id_from = "content"`` it is the same one).
    Rows that come from no file are a load of their own."""
    files = sorted(raw.inputFiles())
    text = "\n".join(files) if files else uuid.uuid4().hex
    return "l" + hashlib.sha1(text.encode()).hexdigest()[:16]


def assert_unique(df: DataFrame, key: str, name: str) -> None:
    """Each non-null natural key once, or the key lookup would multiply rows."""
    bad = df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").limit(5).collect()
    if bad:
        raise ValueError(f"{name}.{key} is not unique, e.g. {', '.join(str(r[0]) for r in bad)}")


NATURAL_KEYS = {"dim_date": "full_date", "dim_item": "item_code", "dim_buyer": "buyer_id"}


def _observed_record(raw: DataFrame, cfg: EtlConfig, seen: Observation) -> DataFrame:
    """``raw`` with what its write observes (S9, S10, A11-A13, E14): row and
    valid-row counts, calendar bounds, nulls per column, and, for load ids by
    content, a digest of all rows that does not depend on their order."""
    valid = F.lit(True)
    for expr in check_expressions(cfg.validation).values():
        valid = valid & expr
    columns = [c for c in raw.columns if not c.startswith("_")]
    return raw.observe(
        seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(valid).alias("n_valid"),
        F.min("date").alias("lo"), F.max("date").alias("hi"),
        F.bit_xor(F.xxhash64(F.xxhash64(*columns), F.lit(1))).alias("content"),
        *[n.alias(f"null_{c}") for c, n in null_counts(raw).items()])


def _whole_orphans(validated: DataFrame, lost: DataFrame) -> DataFrame:
    """All columns of the orphans, which the lookup did not carry.

    Whether a row is one rests on its natural keys and on the presence of a
    transaction id, so these of the lost rows, each once, find the rows among
    the validated ones.  They are stored first: few of them are then broadcast,
    where a lazy side would have the validated rows shuffled before its size is
    known."""
    keys = lost.groupBy(*NATURAL_COLUMNS, F.col("transaction_id").isNull().alias("no_id")).agg(
        *[F.first(c).alias(c) for c in ("date_key", "item_key", "buyer_key")])
    keys = materialize(keys, "lost-keys")
    found = keys.select(*[F.col(c).alias(f"__{c}") for c in (*NATURAL_COLUMNS, "no_id")],
                        "date_key", "item_key", "buyer_key")
    return split_fact(validated.join(found, same_natural("__")).drop(*[c for c in found.columns if c.startswith("__")]))[1]


def run_pipeline(spark: SparkSession, raw: DataFrame, out_dir: str,
                 cfg: EtlConfig | None = None, load_id: str | None = None,
                 warehouse_dir: str | None = None) -> RunResult:
    """Raw text record -> processed files -> warehouse tables.

    Order of effects (nothing reaches the warehouse before step 6):

    1. S5 ``processed/orders_cleaned``: the typed record, written once; every
       later step reads this file instead of re-running the raw scan.  Counts
       of the whole record (gate, profile, calendar bounds, dropped rows) are
       observed metrics of this write; the dimensions' are of theirs.
    2. S6 ``processed/dim_*``: calendar, items, buyers from all rows.
    3. E14 gate on the observed counts; ValueError if too many rows
       are rejected.  S7 ``validated_fact_data`` and, only when some rows
       fail, ``rejected_rows``.
    4. S9 dry run stops here.
    5. E16/E17: unseen natural keys get keys after the current maximum and are
       staged below ``processed``; the rows are looked up against stored plus
       new dimension rows and staged in a scratch table.  Natural keys must be
       unique, a fact row's values must fit the warehouse's types, and (unless
       ``cfg.enforce_constraints`` is off) the staged load must meet the
       warehouse constraints; else ValueError and an unchanged warehouse.
    6. New dimension rows are appended, and the fact rows, numbered by
       ``fact_key`` after the stored ones (K1), written to the
       folder ``fact_sales/load_id=<load_id>``: another load adds, the same
       load (by default: the same input files) replaces its own rows.  Rows
       without a key or a transaction id go to ``processed/fact_orphans``.

    On disk are, beside these outputs, the shuffles of one step and scratch
    tables of the fact's columns; the latter go when the run ends.
    """
    with conf_for(spark, DROP_SHUFFLES), scratch_dropped(spark):
        return _run_steps(spark, raw, out_dir.rstrip("/"), cfg or EtlConfig(), load_id, warehouse_dir)


def _run_steps(spark: SparkSession, raw: DataFrame, base: str, cfg: EtlConfig, load_id: str | None,
               warehouse_dir: str | None) -> RunResult:
    fmt = cfg.output_format
    timings: dict[str, float] = {}
    clock = [time.perf_counter()]

    def lap(name: str) -> None:
        now = time.perf_counter()
        timings[name] = round(now - clock[0], 3)
        clock[0] = now

    proc = f"{base}/processed"
    wdir = (warehouse_dir or f"{base}/warehouse").rstrip("/")

    # The write of the cleaned record observes what later steps need of it as
    # a whole: calendar bounds, validation totals, nulls, dropped rows.
    cleaned_path = f"{proc}/orders_cleaned"
    seen = Observation("cleaned")
    with conf_for(spark, SMALL_FUNCTIONS):
        _write(_observed_record(raw, cfg, seen), cleaned_path, "parquet", packed=True)  # lineage cut: one raw scan
    cleaned = spark.read.parquet(cleaned_path)
    one = seen.get
    if load_id is None and cfg.load_id_from == "content":
        load_id = "c" + hashlib.sha1(f"{one['n_rows']} {one['content']}".encode()).hexdigest()[:16]
    load_id = load_id or default_load_id(raw)
    for name, kind in cleaned.dtypes:
        if not name.startswith("_"):
            log.info("%s (%s): %d of %d values missing", name, kind, one[f"null_{name}"], one["n_rows"])
    lap("cleaned")
    if fmt != "parquet":
        _write(cleaned.drop("_seq"), f"{proc}/orders_cleaned_{fmt}", fmt)

    flagged = flag_rows(cleaned, cfg.validation)
    n_rows, n_ok = one["n_rows"], one["n_valid"]
    stats = {"n_rows": n_rows, "n_valid": n_ok, "n_rejected": n_rows - n_ok,
             "drop_rate": (n_rows - n_ok) / max(n_rows, 1)}

    by_mode = cfg.canonicalize.item_attributes == "mode"
    no_id = Observation("items") if by_mode else None
    dims = {
        "dim_date": dims_op.build_date_dimension(cleaned, bounds=(one["lo"], one["hi"])),
        "dim_item": dims_op.build_item_dimension(cleaned, cfg.canonicalize, observation=no_id),
        "dim_buyer": dims_op.build_buyer_dimension(cleaned),
    }
    dim_rows = {}
    for name, df in dims.items():
        written = Observation(name)
        _write(df.observe(written, F.count(F.lit(1)).alias("n")), f"{proc}/{name}", fmt)
        dim_rows[f"{name}_rows"] = written.get["n"]
        lap(name)
    dropped = {
        "null_buyer_id_rows": one["null_buyer_id"], "null_item_code_rows": one["null_item_code"],
        "items_without_id": no_id.get["items_without_id"] if by_mode
        else cleaned.select(dims_op.items_without_id(cleaned).alias("n")).agg(F.max("n")).first()[0] or 0,
    }
    for what, n in dropped.items():
        if n:
            log.warning("Dimension build dropped %d (%s).", n, what)

    gate(stats, cfg.validation)
    lap("gate")
    valid = flagged.where("is_valid").drop("is_valid", "reject_reasons")
    _write(valid.drop("_seq"), f"{proc}/validated_fact_data", fmt, packed=True)
    if stats["n_rejected"] > 0:
        rejected = flagged.where(~F.col("is_valid")).drop("is_valid", "_seq")
        if fmt == "csv":
            rejected = rejected.withColumn("reject_reasons",
                                           F.array_join("reject_reasons", ","))
        _write(rejected, f"{proc}/rejected_rows", fmt, packed=True)
    lap("validated_rejected")

    counts = dict(stats)
    counts.update(dropped)
    counts.update(dim_rows)
    if cfg.dry_run:
        log.info("Dry run, warehouse untouched: %s.", counts)
        return RunResult(proc, None, counts)

    # Unseen natural keys, staged; the warehouse is not touched yet.
    staged = {n: spark.read.parquet(f"{proc}/{n}") for n in dims} if fmt == "parquet" else dims
    incremental = {
        "dim_date": dims_op.new_dates,
        "dim_item": dims_op.new_items,
        "dim_buyer": dims_op.new_buyers,
    }
    full, fresh = {}, {}
    for name, add in incremental.items():
        assert_unique(staged[name], NATURAL_KEYS[name], name)
        stored = spark.read.parquet(f"{wdir}/{name}") if _exists(spark, f"{wdir}/{name}") else None
        rows = staged[name] if stored is None else add(staged[name], stored)
        rows.write.mode("overwrite").parquet(f"{proc}/new_{name}")
        fresh[name] = spark.read.parquet(f"{proc}/new_{name}")
        full[name] = fresh[name] if stored is None else stored.unionByName(fresh[name])
    lap("new_dims")

    # The lookup joins run once, over the fact's columns; rows that find all
    # keys and orphans are two folders of one write.
    validated = spark.read.parquet(f"{proc}/validated_fact_data") if fmt == "parquet" else valid.drop("_seq")
    looked = lookup_keys(staged_source(validated), full["dim_date"], full["dim_item"], full["dim_buyer"])
    lost = ~complete_keys()
    halves, looked_path = Observation("looked up"), scratch_path(spark, "looked-up")
    looked = looked.observe(
        halves, F.count_if(~lost).alias("fact"), F.count_if(lost).alias("orphans"),
        F.count_if(~lost & ~F.col("fits")).alias("too_large"),
    ).select(*FACT_COLUMNS, *[F.when(lost, F.col(c)).alias(c) for c in NATURAL_COLUMNS], lost.cast("int").alias("is_orphan"))
    with conf_for(spark, OPEN_FOLDERS):
        looked.write.partitionBy("is_orphan").options(**PACKED).parquet(looked_path)
    n_fact, n_orphans = halves.get["fact"], halves.get["orphans"]
    if n := halves.get["too_large"]:
        raise ValueError(f"Values of {n} rows are too large for the types of fact_sales.")
    looked = spark.read.schema(looked.schema).parquet(looked_path)
    fact = split_fact(looked.where("is_orphan = 0"))[0]
    orphans = _whole_orphans(validated, looked.where("is_orphan = 1"))
    lap("lookup")
    if cfg.enforce_constraints:
        assert_constraints(constraint_report(full["dim_date"], full["dim_item"], full["dim_buyer"], fact))
        lap("constraints")
    # K1: numbered and sorted by date, item and buyer, staged below the checkpoint folder.
    keyed = with_fact_key(fact, next_fact_key(spark, f"{wdir}/fact_sales", load_id, n_fact), n_fact)
    lap("fact_keys")

    for name, df in fresh.items():
        df.write.mode("append").parquet(f"{wdir}/{name}")
    if cfg.partition_fact_by_date:
        # REBALANCE: AQE splits a hot day over several writers and packs
        # small days together, so files stay near the advisory size.
        writer = keyed.hint("rebalance", "date_key").write.partitionBy("date_key")
    else:
        writer = keyed.write
    writer.mode("overwrite").options(**PACKED).parquet(f"{wdir}/fact_sales/load_id={load_id}")
    counts["n_orphans"] = n_orphans
    _write(orphans, f"{proc}/fact_orphans", "parquet", packed=True)
    if n_orphans:
        log.warning("%d validated rows have no key or transaction id (fact_orphans).", n_orphans)
    lap("fact")
    counts["timings"] = timings
    counts["load_id"] = load_id
    log.info("run_pipeline timings: %s", timings)
    return RunResult(proc, wdir, counts)


def dry_run_counts(spark: SparkSession, raw: DataFrame, cfg: EtlConfig | None = None) -> DataFrame:
    """What a dry run counts, as rows (metric, value): all rows, valid and
    rejected ones, the rejected share, rows and items that the dimensions
    drop, and the dimensions' sizes.  Nothing reaches a warehouse."""
    run = run_pipeline(spark, raw, scratch_path(spark, "dry-run"), replace(cfg or EtlConfig(), dry_run=True))
    return spark.createDataFrame([(k, float(v)) for k, v in sorted(run.counts.items())], "metric string, value double")


def publish_jdbc(wh: Warehouse, url: str, schema: str, properties: dict[str, str],
                 cfg: EtlConfig | None = None, mode: str = "append") -> None:
    """S8, database variant: append the four tables through Spark's JDBC
    writer in batches of ``cfg.chunk_size`` rows, one connection per task.

    Not exercised by the tests: no database server may run in this
    environment.  Keys are already assigned, so the target tables must not
    generate their own identity values.
    """
    cfg = cfg or EtlConfig()
    props = {"batchsize": str(cfg.chunk_size), **properties}
    for name, df in wh.tables().items():
        df.write.mode(mode).jdbc(url, f"{schema}.{name}", properties=props)
