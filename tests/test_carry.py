"""Running sums carried over deliveries equal the windows over all rows."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators import carry
from ledgerlake.session import scratch_dir

SCHEMA = "customer_id string, txn_date date, txn_id string, spend decimal(10,2)"
ARGS = {"key": "customer_id", "order_col": "txn_date", "tie_col": "txn_id", "value_col": "spend", "buckets": 3}


def whole(rows):
    w = Window.partitionBy("customer_id").orderBy("txn_date")
    out = rows.withColumn("running", F.sum("spend").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    return out.withColumn("previous", F.lag("spend").over(Window.partitionBy("customer_id").orderBy("txn_date", "txn_id")))


def collected(df):
    return sorted((tuple(r) for r in df.select("customer_id", "txn_date", "txn_id", "spend", "running", "previous").collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(2)


def some(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        who = rng.choice(["A"] * 10 + ["B", "C", "D", None])
        out.append((who, dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(75)), f"T{i}", rng.choice([None, Decimal(rng.randrange(1000)) / 4])))
    return out


def test_any_split_equals_the_windows_over_all_rows(spark, seed=1):
    rows, path = some(240, seed), scratch_dir(spark, "t-carry")
    rng, done = random.Random(seed), []
    rows.sort(key=lambda r: r[1])
    for part in (rows[:100], rows[100:180], sorted(rows[180:], key=lambda r: rng.random())[:30]):
        done += part
        carry.extend(spark, frame(spark, part), path, **ARGS)
    rest = [r for r in rows if r not in done]
    carry.extend(spark, frame(spark, rest), path, **ARGS)
    assert collected(carry.read_carried(spark, path)) == collected(whole(frame(spark, rows)))


def test_on_time_rows_touch_no_older_partition_and_repeats_change_nothing(spark):
    path = scratch_dir(spark, "t-carry")
    d = lambda m, day=1: dt.date(2000, m, day)
    first = [("A", d(1), "1", Decimal(1)), ("A", d(2), "2", Decimal(2)), ("B", d(1), "3", Decimal(4)), ("B", d(5), "4", Decimal(8))]
    assert carry.extend(spark, frame(spark, first), path, **ARGS).partitions == 4
    second = [("A", d(3), "5", Decimal(16)), ("A", d(3), "6", Decimal(32)), ("C", d(3), "7", None)]
    done = carry.extend(spark, frame(spark, second), path, **ARGS)
    assert (done.new_rows, done.late_keys, done.rewritten_rows) == (3, 0, 0) and done.partitions <= 2
    late = [("B", d(2), "8", Decimal(64)), ("A", d(4), "9", Decimal(128))]
    done = carry.extend(spark, frame(spark, late), path, **ARGS)
    assert (done.late_keys, done.rewritten_rows) == (1, 1)                 # B's row of May follows the late one
    expect = collected(whole(frame(spark, first + second + late)))
    assert collected(carry.read_carried(spark, path)) == expect
    for again in (second, late, first):                                     # deliveries repeated
        carry.extend(spark, frame(spark, again), path, **ARGS)
        assert collected(carry.read_carried(spark, path)) == expect
    assert carry.extend(spark, frame(spark, []), path, **ARGS) == carry.CarryResult()


def test_the_first_delivery_is_written_once(spark, monkeypatch):
    aside, real = [], carry.materialize
    monkeypatch.setattr(carry, "materialize", lambda df, purpose: aside.append(purpose) or real(df, purpose))
    rows = frame(spark, [("a", dt.date(2000, 1, d), f"t{d}", Decimal(d)) for d in (1, 2, 3)])
    path = scratch_dir(spark, "t-carry-once")
    carry.extend(spark, rows, path, **ARGS)
    assert aside == ["carry-new"] and collected(carry.read_carried(spark, path)) == collected(whole(rows))


def test_a_delivery_leaves_no_copies(spark):
    from ledgerlake import session
    path = scratch_dir(spark, "t-carry-copies")
    before = list(session._SCRATCH)
    for m in (1, 3, 2):
        carry.extend(spark, frame(spark, [("a", dt.date(2000, m, 1), f"t{m}", Decimal(m)), ("b", dt.date(2000, m, 2), f"u{m}", Decimal(1))]), path, **ARGS)
        assert session._SCRATCH == before
    assert {r.txn_id: r.running for r in carry.read_carried(spark, path).collect()} == {"t1": 1, "t2": 3, "t3": 6, "u1": 1, "u2": 2, "u3": 3}
