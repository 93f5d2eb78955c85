"""Property: the distributed RANK equals Spark's window RANK on any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesmart.operators.keys import rank_over

rows = st.lists(
    st.tuples(st.sampled_from(["x", "y", None]),
              st.one_of(st.none(), st.integers(min_value=-5, max_value=5))),
    min_size=1, max_size=40,
)


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows, buckets=st.integers(min_value=1, max_value=6), desc=st.booleans(),
       partitioned=st.booleans())
def test_rank_over_equals_window_rank(spark, data, buckets, desc, partitioned):
    df = spark.createDataFrame([(i, c, v) for i, (c, v) in enumerate(data)],
                               "id int, cat string, v int")
    parts = ["cat"] if partitioned else []
    ours = rank_over(df, "v", "r", partition_by=parts, descending=desc, n_buckets=buckets)
    order = F.col("v").desc_nulls_first() if desc else F.col("v").asc_nulls_last()
    w = Window.partitionBy(*parts).orderBy(order) if parts else Window.orderBy(order)
    ref = df.withColumn("r", F.rank().over(w))
    assert sorted(ours.select("id", "r").collect()) == sorted(ref.select("id", "r").collect())
