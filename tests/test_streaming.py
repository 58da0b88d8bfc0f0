"""Streaming silver load: restart from checkpoint adds nothing; late rows dropped."""

import datetime as dt

from ledgerlake.schemas import RAW_SCHEMAS
from ledgerlake.session import scratch_dir
from ledgerlake.streaming.silver_stream import run_silver_stream

AS_OF = "2001-06-30"


def rows(ids_ts):
    return [(i, "A", "M", ts, 1.0, "USD", "debit", "success", "pos", "c", "k", "d")
            for i, ts in ids_ts]


def test_restart_adds_no_duplicates_and_late_rows_are_dropped(spark):
    src, sink, ckpt = (scratch_dir(spark, p) for p in ("s-src", "s-sink", "s-ckpt"))
    t0 = dt.datetime(2000, 1, 1, 12, 0)
    first = rows([("T1", t0), ("T1", t0), ("T2", t0 + dt.timedelta(minutes=5))])
    spark.createDataFrame(first, RAW_SCHEMAS["transactions"]).write.parquet(src)
    run_silver_stream(spark, src, sink, ckpt, as_of=AS_OF)
    assert sorted(r.txn_id for r in spark.read.parquet(sink).collect()) == ["T1", "T2"]

    run_silver_stream(spark, src, sink, ckpt, as_of=AS_OF)          # nothing new
    assert spark.read.parquet(sink).count() == 2

    # T1 in a newer version: replaces the older one; T3 a day before the watermark: late,
    # dropped and counted; T4 new: kept.
    second = rows([("T1", t0 + dt.timedelta(minutes=3)), ("T3", t0 - dt.timedelta(days=1)),
                   ("T4", t0 + dt.timedelta(hours=1))])
    spark.createDataFrame(second, RAW_SCHEMAS["transactions"]).write.mode("append").parquet(src)
    done = run_silver_stream(spark, src, sink, ckpt, as_of=AS_OF)
    got = {r.txn_id: r.timestamp for r in spark.read.parquet(sink).collect()}
    assert got == {"T1": t0 + dt.timedelta(minutes=3), "T2": t0 + dt.timedelta(minutes=5), "T4": t0 + dt.timedelta(hours=1)}
    assert done.late_rows == 1 and done.read_rows == 3


def test_csv_deliveries_and_rerun_without_new_files(spark):
    from ledgerlake.sources.tables import write_raw_csv
    src, sink, ckpt = (scratch_dir(spark, p) for p in ("c-src", "c-sink", "c-ckpt"))
    t0 = dt.datetime(2000, 3, 1, 8, 0)
    write_raw_csv(spark.createDataFrame(rows([("T1", t0), ("T1", t0), ("T2", t0)]),
                                        RAW_SCHEMAS["transactions"]), src, "append")
    run_silver_stream(spark, src, sink, ckpt, as_of=AS_OF, fmt="csv")
    run_silver_stream(spark, src, sink, ckpt, as_of=AS_OF, fmt="csv")
    got = spark.read.parquet(sink)
    assert sorted(r.txn_id for r in got.collect()) == ["T1", "T2"]
    assert {(r.txn_year, r.txn_month) for r in got.collect()} == {(2000, 3)}


def test_a_commit_writes_the_changes_of_the_state(spark):
    import pathlib

    from ledgerlake.session import local_path
    src, sink, ckpt = (scratch_dir(spark, p) for p in ("l-src", "l-sink", "l-ckpt"))
    t0 = dt.datetime(2000, 1, 1, 12, 0)
    spark.createDataFrame(rows([("T1", t0), ("T1", t0), ("T2", t0)]), RAW_SCHEMAS["transactions"]).write.parquet(src)
    run_silver_stream(spark, src, sink, ckpt, as_of=AS_OF)
    assert list(pathlib.Path(local_path(ckpt)).rglob("*.changelog"))
    assert sorted(r.txn_id for r in spark.read.parquet(sink).collect()) == ["T1", "T2"]


def test_batches_of_an_interrupted_run_are_merged_by_the_next(spark, monkeypatch):
    import pytest

    from ledgerlake.sources.tables import path_exists
    from ledgerlake.streaming import silver_stream
    src, sink, ckpt = (scratch_dir(spark, p) for p in ("i-src", "i-sink", "i-ckpt"))
    t0 = dt.datetime(2000, 1, 1, 12, 0)
    spark.createDataFrame(rows([("T1", t0), ("T2", t0)]), RAW_SCHEMAS["transactions"]).write.parquet(src)

    def stopped(*a, **k):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:
        m.setattr(silver_stream, "upsert", stopped)
        with pytest.raises(RuntimeError):
            run_silver_stream(spark, src, sink, ckpt, as_of=AS_OF)
    assert path_exists(spark, f"{ckpt}-pending") and not path_exists(spark, sink)
    run_silver_stream(spark, src, sink, ckpt, as_of=AS_OF)                # no new file
    assert sorted(r.txn_id for r in spark.read.parquet(sink).collect()) == ["T1", "T2"]
    assert not path_exists(spark, f"{ckpt}-pending")


def test_rejects_and_batches_leave_no_copies_and_derived_columns_stay_out_of_the_state(spark):
    from ledgerlake import session
    from ledgerlake.streaming.silver_stream import raw_transaction_stream, silver_transaction_stream
    src, sink, ckpt, kept = (scratch_dir(spark, p) for p in ("n-src", "n-sink", "n-ckpt", "n-kept"))
    t0 = dt.datetime(2000, 1, 1, 12, 0)
    raw = rows([("T1", t0), ("T1", t0)]) + [("T2", "A", "M", t0, 1.0, "USD", "debit", "failed", "pos", "c", "k", "d")]
    spark.createDataFrame(raw, RAW_SCHEMAS["transactions"]).write.parquet(src)
    before = list(session._SCRATCH)
    done = run_silver_stream(spark, src, sink, ckpt, as_of=AS_OF, quarantine_dir=kept)
    assert done.rejected == {"not_successful": 1} and session._SCRATCH == before
    got = spark.read.parquet(sink).first()
    assert (got.txn_date, got.txn_year, got.txn_month, got.is_debit) == (t0.date(), 2000, 1, True)
    plan = silver_transaction_stream(raw_transaction_stream(spark, src), AS_OF)._jdf.queryExecution().analyzed().toString().split("\n")
    below = plan[next(i for i, line in enumerate(plan) if "Deduplicate" in line) + 1].split("unhex")[0]
    assert "txn_type" in below and "is_debit" not in below and "txn_date" not in below
