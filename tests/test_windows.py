"""Skew-tolerant window operators equal plain windows, on input where one key holds
a third of all rows (brute force on a small fixture derived from the test tables)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators.windows import (materialize, row_number_by, with_running_and_previous,
                                          with_running_total)


@pytest.fixture(scope="module")
def skewed(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit("HOT")).otherwise(
        F.concat(F.lit("K"), (F.col("l_orderkey") % 50).cast("string")))
    key = F.when(F.col("l_orderkey") % 97 == 0, F.lit(None)).otherwise(key)
    df = li.select(key.alias("k"), F.to_date("l_shipdate").alias("d"),
                   F.monotonically_increasing_id().alias("id"),
                   F.col("l_extendedprice").cast("decimal(12,2)").alias("v"))
    return materialize(df, "test-skewed")      # fixes the generated ids


def rows(df, cols):
    out = {r[0]: r[1] for r in df.select(*cols).collect()}
    assert len(out) == df.count()
    return out


def test_running_total_equals_range_window(spark, skewed):
    w = Window.partitionBy("k").orderBy("d")
    plain = skewed.withColumn("rt", F.sum("v").over(w))
    ours = with_running_total(skewed, ["k"], "d", "v", "rt")
    assert rows(ours, ["id", "rt"]) == rows(plain, ["id", "rt"])


def test_row_number_equals_window(spark, skewed):
    w = Window.partitionBy("k").orderBy(F.col("v").desc(), "id")
    plain = skewed.withColumn("rn", F.row_number().over(w))
    ours = row_number_by(skewed, ["k"], [F.col("v").desc(), "id"], "rn")
    assert rows(ours, ["id", "rn"]) == rows(plain, ["id", "rn"])


def test_lag_equals_window(spark, skewed):
    w = Window.partitionBy("k").orderBy("d", "id")
    plain = skewed.withColumn("p", F.lag("v").over(w))
    ours = with_running_and_previous(skewed, ["k"], "d", "id", "v", "rt", "p")
    assert rows(ours, ["id", "p"]) == rows(plain, ["id", "p"])
    plain = skewed.withColumn("rt", F.sum("v").over(Window.partitionBy("k").orderBy("d")))
    assert rows(ours, ["id", "rt"]) == rows(plain, ["id", "rt"])


def test_a_value_may_be_an_expression(spark):
    rows = spark.createDataFrame([("a", 1, "x", 2, True), ("a", 1, "y", 3, False), ("a", 2, "z", 4, True), (None, 1, "w", 5, True)], "k string, d int, id string, v int, on boolean")
    value = F.when(F.col("on"), F.col("v")).otherwise(F.lit(0))
    got = with_running_and_previous(rows, ["k"], "d", "id", value, "rt", "p")
    assert {r.id: (r.rt, r.p) for r in got.collect()} == {"x": (2, None), "y": (2, 2), "z": (6, 0), "w": (5, None)}


def test_keys_with_few_rows_are_dealt_once_and_hot_ones_by_steps(spark, skewed, monkeypatch):
    import re

    from ledgerlake.operators import windows
    few = with_running_and_previous(skewed, ["k"], "d", "id", "v", "rt", "p")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\((\w+)#", plan) == ["k"] and plan.count("hashpartitioning") == 1
    monkeypatch.setattr(windows, "HOT_ROWS", 200)
    hot = windows.hot_keys(skewed, ["k"])
    assert 0 < hot.count() < skewed.select("k").distinct().count()
    both = with_running_and_previous(skewed, ["k"], "d", "id", "v", "rt", "p").select(*few.columns)
    assert sorted(map(tuple, both.collect()), key=str) == sorted(map(tuple, few.collect()), key=str)
