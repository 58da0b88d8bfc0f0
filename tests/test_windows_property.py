"""Property test: the skew-tolerant window operators equal plain windows on random
inputs with NULL keys, repeated order values and one dominant key."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators.windows import row_number_by, with_running_and_previous, with_running_total

row = st.tuples(st.sampled_from(["HOT", "HOT", "HOT", "a", "b", None]),
                st.integers(min_value=0, max_value=6),
                st.integers(min_value=-50, max_value=50))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=60))
def test_operators_equal_plain_windows(spark, rows):
    data = [(k, d, i, Decimal(v)) for i, (k, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, d int, id int, v decimal(10,0)").repartition(3)

    rt = with_running_total(df, ["k"], "d", "v", "x")
    exp = df.withColumn("x", F.sum("v").over(Window.partitionBy("k").orderBy("d")))
    assert dict(rt.select("id", "x").collect()) == dict(exp.select("id", "x").collect())

    rn = row_number_by(df, ["k"], [F.col("v").desc(), "id"], "x")
    exp = df.withColumn("x", F.row_number().over(
        Window.partitionBy("k").orderBy(F.col("v").desc(), "id")))
    assert dict(rn.select("id", "x").collect()) == dict(exp.select("id", "x").collect())

    lg = with_running_and_previous(df, ["k"], "d", "id", "v", "rt", "x")
    exp = df.withColumn("x", F.lag("v").over(Window.partitionBy("k").orderBy("d", "id")))
    assert dict(lg.select("id", "x").collect()) == dict(exp.select("id", "x").collect())
