
import datetime as dt

from ledgerlake.operators.incremental import incremental_load
from ledgerlake.plans import silver
from ledgerlake.schemas import RAW_SCHEMAS
from ledgerlake.session import scratch_dir
from ledgerlake.sources.tables import read_table

AS_OF = "2001-06-30"
PART = ["txn_year", "txn_month"]


def txn(spark, rows):
    full = [(i, "A", "M", ts, amt, "USD", "debit", "success", "pos", "c", "k", "d")
            for i, ts, amt in rows]
    return spark.createDataFrame(full, RAW_SCHEMAS["transactions"])


def load(spark, df, target, late):
    return incremental_load(spark, df, target, keys=["txn_id"], ts_col="timestamp",
                            order=silver.total_order_for("transactions"), late=late,
                            transform=lambda d: silver.to_silver("transactions", d, AS_OF),
                            partition_by=PART)


def snapshot(spark, target):
    return sorted(((r.txn_id, r.timestamp, float(r.amount))
                   for r in read_table(spark, target).collect()), key=lambda t: (t[0] is not None, t))


def test_drop_skips_rows_at_the_mark_and_empty_loads(spark):
    target = scratch_dir(spark, "t-drop")
    d1, d2 = dt.datetime(2000, 1, 1), dt.datetime(2000, 2, 1)
    r1 = load(spark, txn(spark, [("T1", d1, 1.0), ("T2", d2, 2.0)]), target, "drop")
    assert r1.written_rows == 2
    r2 = load(spark, txn(spark, [("T3", d2, 3.0), ("T4", d1, 4.0)]), target, "drop")
    assert r2.skipped and r2.high_water_mark == d2          # equal to the mark: skipped
    assert r2.late_rows == 2
    assert [t for t, *_ in snapshot(spark, target)] == ["T1", "T2"]


def test_upsert_keeps_late_rows_and_newest_versions(spark):
    target = scratch_dir(spark, "t-upsert")
    d1, d2, d3 = dt.datetime(2000, 1, 1), dt.datetime(2000, 2, 1), dt.datetime(2000, 3, 1)
    load(spark, txn(spark, [("T1", d2, 1.0), ("T2", d2, 2.0)]), target, "upsert")
    # late new key T3 (before the mark), an older version of T1, a newer version of T2
    load(spark, txn(spark, [("T3", d1, 3.0), ("T1", d1, 9.0), ("T2", d3, 5.0)]), target, "upsert")
    assert snapshot(spark, target) == [("T1", d2, 1.0), ("T2", d3, 5.0), ("T3", d1, 3.0)]


def test_upsert_removes_a_key_from_the_partition_it_left(spark):
    target = scratch_dir(spark, "t-move")
    jan, mar = dt.datetime(2000, 1, 5), dt.datetime(2000, 3, 5)
    load(spark, txn(spark, [("T1", jan, 1.0)]), target, "upsert")
    res = load(spark, txn(spark, [("T1", mar, 2.0)]), target, "upsert")
    assert '{"txn_year":2000,"txn_month":1}' in res.rewritten_partitions
    assert snapshot(spark, target) == [("T1", mar, 2.0)]


def test_rerun_changes_nothing(spark):
    target = scratch_dir(spark, "t-rerun")
    rows = [("T1", dt.datetime(2000, 1, 1), 1.0), ("T2", dt.datetime(2000, 5, 1), 2.0)]
    load(spark, txn(spark, rows), target, "upsert")
    before = snapshot(spark, target)
    res = load(spark, txn(spark, rows), target, "upsert")
    assert res.skipped and res.written_rows == 0 and not res.rewritten_partitions
    assert snapshot(spark, target) == before


def test_upsert_merges_a_new_column(spark):
    from pyspark.sql import functions as F
    target = scratch_dir(spark, "t-schema")
    d1 = dt.datetime(2000, 1, 1)
    load(spark, txn(spark, [("T1", d1, 1.0)]), target, "upsert")
    newer = lambda d: silver.to_silver("transactions", d, AS_OF).withColumn("fee", F.lit(0.5))
    incremental_load(spark, txn(spark, [("T2", d1, 2.0)]), target, keys=["txn_id"],
                     ts_col="timestamp", order=silver.total_order_for("transactions"),
                     transform=newer, partition_by=PART)
    got = {r.txn_id: r.fee for r in read_table(spark, target, merge_schema=True).collect()}
    assert got == {"T1": None, "T2": 0.5}


def plain_load(spark, rows, target, late="upsert", part=None, ts="t"):
    df = spark.createDataFrame(rows, "k string, p string, t int, v int")
    return incremental_load(spark, df, target, keys=["k"], ts_col=ts, order=["t", "p", "v"], late=late, partition_by=part)


def content(spark, target):
    return sorted(tuple(r) for r in read_table(spark, target).select("k", "p", "t", "v").collect())


def test_copies_in_the_first_delivery_are_merged(spark):
    target = scratch_dir(spark, "t-first")
    plain_load(spark, [("a", "x", 1, 1), ("a", "x", 2, 2)], target)
    assert content(spark, target) == [("a", "x", 2, 2)]
    res = plain_load(spark, [("b", "x", 1, 1)], target)          # unpartitioned: whole table replaced
    assert res.written_rows == 2 and content(spark, target) == [("a", "x", 2, 2), ("b", "x", 1, 1)]


def test_drop_keeps_keys_unique(spark):
    target = scratch_dir(spark, "t-drop-keys")
    plain_load(spark, [("a", "x", 1, 1), ("b", "x", 1, 1)], target, "drop")
    res = plain_load(spark, [("a", "x", 5, 2), ("b", "x", 1, 9)], target, "drop")
    assert res.late_rows == 1 and content(spark, target) == [("a", "x", 5, 2), ("b", "x", 1, 1)]


def test_a_table_without_event_time_is_upserted_under_either_policy(spark):
    for late in ("drop", "upsert"):
        target = scratch_dir(spark, "t-no-ts")
        for _ in range(2):
            plain_load(spark, [("a", "x", 1, 1), ("b", "x", 1, 1)], target, late, ts=None)
        assert len(content(spark, target)) == 2


def test_partition_values_that_need_escaping(spark):
    """Keys that leave such a partition, or one without a value, leave nothing behind."""
    target = scratch_dir(spark, "t-escape")
    names = ["a:b", "c%d/e", "f g=h", None, "é\"'", "plain"]
    plain_load(spark, [(f"k{i}", p, 1, 1) for i, p in enumerate(names)], target, part=["p"])
    plain_load(spark, [(f"k{i}", "moved", 2, 2) for i in range(len(names))], target, part=["p"])
    assert content(spark, target) == sorted((f"k{i}", "moved", 2, 2) for i in range(len(names)))


def test_thousands_of_partitions_in_one_filter(spark):
    from pyspark.sql import functions as F

    from ledgerlake.operators.incremental import partition_name
    df = spark.range(4000).select(F.col("id").cast("string").alias("p"))
    names = [r[0] for r in df.select(partition_name(["p"])).collect()]
    assert df.where(partition_name(["p"]).isin(names)).count() == 4000


def test_formats_with_their_own_merge_are_refused(spark):
    import pytest
    df = spark.createDataFrame([("a", "x", 1, 1)], "k string, p string, t int, v int")
    with pytest.raises(ValueError):
        incremental_load(spark, df, scratch_dir(spark, "t-fmt") + "/none", keys=["k"], ts_col=None, order=["t"], fmt="csv")


def test_null_keys_are_one_key_in_any_split(spark):
    rows = [(None, dt.datetime(2019 - 20, 1, 1), 1.0), (None, dt.datetime(2000, 3, 1), 2.0), ("T1", dt.datetime(2000, 1, 1), 3.0), (None, dt.datetime(2000, 2, 1), 4.0)]
    once, split = scratch_dir(spark, "t-null"), scratch_dir(spark, "t-null")
    load(spark, txn(spark, rows), once, "upsert")
    for row in rows:
        load(spark, txn(spark, [row]), split, "upsert")
    assert snapshot(spark, split) == snapshot(spark, once) and len(snapshot(spark, split)) == 2


def test_append_knows_a_null_key(spark):
    from ledgerlake.operators.incremental import append_new_rows
    target = scratch_dir(spark, "t-append-null")
    rows = [(None, dt.datetime(2000, 1, 1), 1.0), ("T1", dt.datetime(2000, 1, 1), 2.0)]
    counts = [append_new_rows(spark, txn(spark, rows), target, keys=["txn_id"], order=["timestamp"]).written_rows for _ in range(3)]
    assert counts == [2, 0, 0]


def test_a_delivery_is_written_aside_only_where_it_is_read_again(spark, monkeypatch):
    from ledgerlake.operators import incremental
    aside, real = [], incremental.materialize
    monkeypatch.setattr(incremental, "materialize", lambda df, purpose: aside.append(purpose) or real(df, purpose))
    target = scratch_dir(spark, "t-aside")
    rows = lambda data: real(spark.createDataFrame(data, "k string, p string, t int, v int"), "t-rows")
    load = lambda data: incremental.upsert(spark, rows(data), target, keys=["k"], order=["t", "p", "v"], partition_by=["p"], stored=True)
    load([("a", "x", 1, 1), ("a", "y", 2, 2), ("b", "x", 1, 1), (None, "x", 1, 1)])
    assert aside == [] and read_table(spark, target).count() == 3
    # Two versions of a key within the delivery, one of them older than the stored one.
    res = load([("b", "y", 3, 3), ("b", "z", 2, 9), ("a", "x", 1, 7), (None, "y", 4, 4)])
    got = {tuple(r) for r in read_table(spark, target).select("k", "p", "t", "v").collect()}
    assert aside == ["upsert"] and got == {("a", "y", 2, 2), ("b", "y", 3, 3), (None, "y", 4, 4)}
    assert not any("z" in part for part in res.rewritten_partitions)


def test_partitions_are_copied_where_they_lie(spark, monkeypatch):
    """Only delivered rows and those whose key is delivered meet by key; any size of a broadcast and
    any number of files give the same table."""
    from ledgerlake.operators import incremental
    first = [(f"k{i}", p, 1, i) for i, p in enumerate("xyz" * 5)] + [(None, "x", 1, 99)]
    second = [("k0", "y", 2, 0), ("k4", "y", 0, 5), (None, "z", 3, 1), ("new", "w", 1, 1)]
    third = [(f"k{i}", "x", 9, i) for i in range(0, 15, 3)]                       # every key of a partition but k0's
    seen, real = [], incremental._in_place
    monkeypatch.setattr(incremental, "_in_place", lambda *a: seen.append(real(*a)) or seen[-1])
    tables = []
    for keys, files in ((1_000_000, 8), (1, 8), (1_000_000, 0)):
        monkeypatch.setattr(incremental, "KEYS_AT_ONCE", keys)
        monkeypatch.setattr(incremental, "MOST_FILES", files)
        target = scratch_dir(spark, "t-in-place")
        results = [plain_load(spark, rows, target, part=["p"]) for rows in (first, second, third)]
        tables.append((sorted(map(tuple, read_table(spark, target).select("k", "p", "t", "v").collect()), key=str), [r.written_rows for r in results], [sorted(r.rewritten_partitions) for r in results]))
        assert not [f for f in read_table(spark, target).inputFiles() if "_staged" in f]
    expect = {k: (k, *rest) for k, *rest in first}
    for k, p, t, v in second + third:
        if k not in expect or expect[k][2] < t:
            expect[k] = (k, p, t, v)
    assert tables[0][0] == sorted(expect.values(), key=str) and tables[1:] == [tables[0]] * 2
    assert seen[0] and seen[4:] == [[], []]


def test_an_upsert_leaves_no_copies(spark):
    from ledgerlake import session
    target = scratch_dir(spark, "t-copies")
    plain_load(spark, [("a", "x", 1, 1), ("b", "y", 1, 1)], target, part=["p"])
    before = list(session._SCRATCH)
    plain_load(spark, [("a", "y", 2, 2)], target, part=["p"])
    assert session._SCRATCH == before and content(spark, target) == [("a", "y", 2, 2), ("b", "y", 1, 1)]
