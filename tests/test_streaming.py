"""File-source micro-batches load the warehouse incrementally."""

from pyspark.sql import functions as F

from salesmart.streaming import start_ingest
from salesmart.sources.tables import raw_sales_text

SF = "/root/testdata/sf0.001"


def test_two_files_two_batches_match_one_batch(spark, tmp_path):
    raw = raw_sales_text(spark, SF).drop("_seq")
    in_dir = tmp_path / "in"
    date = F.try_to_date(F.col("Date"), "dd/MM/yyyy")
    first = raw.where(date < F.lit("1998-01-01").cast("date"))
    second = raw.where(~(date < F.lit("1998-01-01").cast("date")) | date.isNull())
    first.coalesce(1).write.option("header", True).csv(str(in_dir / "a"))
    second.coalesce(1).write.option("header", True).csv(str(in_dir / "b"))
    out = str(tmp_path / "out")
    q = start_ingest(spark, str(in_dir / "*"), out, checkpoint=str(tmp_path / "ckpt"),
                     max_files_per_trigger=1)
    q.awaitTermination(300)
    assert q.exception() is None
    fact = spark.read.parquet(f"{out}/warehouse/fact_sales")
    assert fact.select("load_id").distinct().count() == 2
    assert fact.count() == 6000 - 18 - 12  # rejected rows and orphans excluded
    buyers = spark.read.parquet(f"{out}/warehouse/dim_buyer")
    assert buyers.count() == buyers.select("buyer_id").distinct().count()
    assert buyers.agg(F.max("buyer_key")).first()[0] == buyers.count()
