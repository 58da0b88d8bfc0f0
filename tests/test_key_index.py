"""The key index: what an upsert searches, and that no filter is ever believed wrongly."""

import random

from pyspark.sql import functions as F

from ledgerlake.operators import incremental, key_index
from ledgerlake.operators.dedup import latest_per_key
from ledgerlake.session import scratch_dir
from ledgerlake.sources.tables import read_table, write_table

SCHEMA = "k string, p string, t int, v int"
ORDER = ["t", "p", "v"]


def deliver(spark, rows, target, index=True, schema=SCHEMA):
    return incremental.incremental_load(spark, spark.createDataFrame(rows, schema), target, keys=["k"], ts_col="t",
                                        order=ORDER, partition_by=["p"], key_index=index)


def content(spark, target):
    return sorted(map(repr, (tuple(r) for r in read_table(spark, target).select("k", "p", "t", "v").collect())))


def parts(result):
    return sorted(result.searched_partitions)


def test_only_partitions_that_may_hold_a_key_are_searched(spark):
    target = scratch_dir(spark, "t-index")
    assert deliver(spark, [(f"{p}{i:03}", p, 1, i) for p in "abcdef" for i in range(200)], target).searched_partitions is None
    res = deliver(spark, [("c007", "f", 2, 0), ("zzz", "f", 2, 1)], target)   # c007 moves, zzz is new
    assert parts(res) == ['{"p":"c"}']
    assert sorted(res.rewritten_partitions) == ['{"p":"c"}', '{"p":"f"}']
    res = deliver(spark, [("c007", "a", 3, 0)], target)                        # the filter of f was renewed
    assert parts(res) == ['{"p":"f"}']
    rows = read_table(spark, target)
    assert rows.count() == 1201 and rows.where("k = 'c007'").first()["p"] == "a"


def test_a_partition_written_otherwise_is_searched(spark):
    target = scratch_dir(spark, "t-index-stale")
    deliver(spark, [("a1", "a", 1, 1), ("b1", "b", 1, 1)], target)
    write_table(spark.createDataFrame([("x1", "b", 1, 1)], SCHEMA), target, mode="append", partition_by=["p"])
    res = deliver(spark, [("x1", "a", 2, 2)], target)
    assert '{"p":"b"}' in parts(res) and content(spark, target) == sorted(map(repr, [("a1", "a", 1, 1), ("b1", "b", 1, 1), ("x1", "a", 2, 2)]))


def test_a_failed_run_leaves_no_filter_that_is_believed(spark, monkeypatch):
    target = scratch_dir(spark, "t-index-fail")
    deliver(spark, [("a1", "a", 1, 1), ("b1", "b", 1, 1)], target)
    with monkeypatch.context() as m:
        m.setattr(key_index, "update", lambda *a: None)                        # lost after the table was written
        deliver(spark, [("q1", "b", 1, 1)], target)
    res = deliver(spark, [("q1", "a", 2, 2)], target)
    assert '{"p":"b"}' in parts(res) and read_table(spark, target).where("k = 'q1'").count() == 1


def test_any_deliveries_give_the_table_of_one(spark):
    """NULL keys, NULL partitions and names that need escaping, against a dedup of all rows."""
    rng = random.Random(5)
    names = ["a:b", "c%d/e", "f g=h", None, "+é\"'", "1"]
    rows = [(rng.choice([None, *(f"k{i}" for i in range(12))]), rng.choice(names), rng.randrange(9), rng.randrange(9)) for _ in range(60)]
    target = scratch_dir(spark, "t-index-split")
    searched = [deliver(spark, rows[i:i + 15], target).searched_partitions for i in range(0, 60, 15)]
    assert searched[0] is None and all(s is not None for s in searched[1:])
    want = latest_per_key(spark.createDataFrame(rows, SCHEMA), ["k"], ORDER).select("k", "p", "t", "v").collect()
    assert content(spark, target) == sorted(map(repr, map(tuple, want)))


def test_keys_without_filters_are_searched_as_before(spark):
    for kind, a, b in (("double", 0.0, -0.0), ("int", 1, 2)):
        target = scratch_dir(spark, "t-index-kind")
        schema = f"k {kind}, p string, t int, v int"
        deliver(spark, [(a, "x", 1, 1)], target, schema=schema)
        res = deliver(spark, [(b, "y", 2, 2)], target, schema=schema)
        assert (res.searched_partitions is None) == (kind == "double")
        assert read_table(spark, target).count() == (1 if kind == "double" else 2)


def test_a_delivery_of_another_key_type(spark):
    target = scratch_dir(spark, "t-index-type")
    deliver(spark, [(1, "x", 1, 1)], target, schema="k int, p string, t int, v int")
    existing = read_table(spark, target)
    longs = spark.createDataFrame([(1,)], "k long")
    name = F.to_json(F.struct("p"))
    assert key_index.may_hold(spark, existing, longs, target, ["k"], ["p"], name, "parquet") is None
