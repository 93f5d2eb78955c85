"""Session helpers: local session for tests/bench, checkpoint directory."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "salesmart") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be a folder that driver and executors share.  Only a
    local-mode session in which nothing is set gets a folder below its own
    warehouse folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; a cluster run needs a shared folder")
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_dir(spark)


#: Scratch paths made inside the innermost ``scratch_dropped`` block.
_MADE: ContextVar[list[str] | None] = ContextVar("scratch paths", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder; the writer creates it."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this code wrote, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch_dropped(spark: SparkSession):
    """Scratch tables made inside a ``with`` block are deleted after it, so
    nothing that reads them may leave it."""
    made: list[str] = []
    outer = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(outer)
        for path in made:
            drop_path(spark, path)


def materialize(df, name: str, **options):
    """Compute ``df`` once into a Parquet table below the shared checkpoint
    folder and return a DataFrame reading it (``options`` of the writer).

    Used where a plan is referenced several times (a scalar subquery plus the
    main plan, a rank's sampling pass plus its join-back): every reference
    then reads the stored rows instead of re-scanning the fact.  This also
    cuts the lineage, so a lost executor never re-runs the upstream shuffle.
    One job; unlike ``Dataset.checkpoint`` it needs no extra persist to
    avoid computing the plan twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.parquet(path)


#: HotSpot compiles no method above 8000 bytes of bytecode.  One generated
#: function over that is interpreted row by row; with this limit Spark cuts the
#: expressions of such a stage into small functions instead.
SMALL_FUNCTIONS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


#: A write into few folders keeps one file open for each, in place of sorting
#: its rows by folder.
OPEN_FOLDERS = {"spark.sql.maxConcurrentOutputFileWriters": "4"}


#: Shuffle files go when the action that wrote them ends.  Else they stay until
#: the driver's garbage collector finds their plans, and a job of many steps
#: has the shuffles of all of them on disk.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


#: Tables of as many rows as the record stay on disk while others are made; zstd
#: makes them smaller than the default codec does, at no more time.  Dimensions
#: keep the default: their size on disk decides whether they are broadcast.
PACKED = {"compression": "zstd"}


@contextmanager
def conf_for(spark: SparkSession, conf: dict[str, str]):
    """Settings for the actions inside a ``with`` block; the session's own
    come back after it."""
    before = {k: spark.conf.get(k, None) for k in conf}
    apply_conf(spark, conf)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings for a large run, sized from the raw input size.

    * initial shuffle partitions ≈ input / 256 MiB (AQE then coalesces small
      ones and splits skewed ones), so a shuffle partition fits an executor
      core's memory share without spilling much;
    * scan splits of 512 MiB (fewer tasks for large Parquet/CSV files);
    * broadcast of a join side only when its measured runtime size is under
      64 MiB (dimension tables of moderate size; a larger side is joined by
      shuffle, with skew-join splitting for hot keys).
    """
    parts = max(200, input_bytes // target_partition_bytes)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
