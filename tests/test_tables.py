"""Table I/O helpers: existence checks, catalog tables at a path, CSV with schema."""

import datetime as dt

from ledgerlake.schemas import RAW_SCHEMAS
from ledgerlake.session import scratch_dir
from ledgerlake.sources import tables


def test_path_exists_and_catalog_table_round_trip(spark):
    root = scratch_dir(spark, "tables")
    assert not tables.path_exists(spark, f"{root}/missing")
    db = "t_" + root.rsplit("-", 1)[-1][:8]
    tables.create_database(spark, db, f"{root}/db")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.save_as_table(df, f"{db}.t", f"{root}/t")
    assert tables.table_exists(spark, f"{db}.t") and tables.path_exists(spark, f"{root}/t")
    tables.save_as_table(df.withColumn("w", df.k * 2), f"{db}.t", f"{root}/t")   # schema changes
    assert spark.table(f"{db}.t").columns == ["k", "v", "w"]
    assert len(tables.preview(spark.table(f"{db}.t"), 1)) == 1


def test_raw_csv_keeps_declared_types_and_nulls_bad_fields(spark):
    path = scratch_dir(spark, "csv")
    rows = [("T1", "A", None, dt.datetime(2000, 1, 1, 12), -5.5, "USD", "debit", "success",
             "pos", "c", "k", "d")]
    tables.write_raw_csv(spark.createDataFrame(rows, RAW_SCHEMAS["transactions"]), path, "overwrite")
    back = tables.read_raw_csv(spark, path, "transactions")
    assert back.schema == RAW_SCHEMAS["transactions"]
    r = back.first()
    assert r.merchant_id is None and r.amount == -5.5 and r.timestamp == dt.datetime(2000, 1, 1, 12)


def test_a_failed_write_leaves_the_published_table(spark):
    from pyspark.sql import functions as F
    root = scratch_dir(spark, "publish")
    db = "p_" + root.rsplit("-", 1)[-1][:8]
    tables.create_database(spark, db, f"{root}/db")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.save_as_table(df, f"{db}.t", f"{root}/t")
    reader = spark.table(f"{db}.t")
    bad = df.withColumn("v", F.when(F.col("k") < 2, F.col("v")).otherwise(F.raise_error("half way")))
    try:
        tables.save_as_table(bad, f"{db}.t", f"{root}/t")
        raise AssertionError("the write must fail")
    except Exception as e:
        assert "half way" in str(e)
    assert sorted(map(tuple, spark.table(f"{db}.t").collect())) == [(1, "a"), (2, "b")]
    tables.save_as_table(df.where("k = 1"), f"{db}.t", f"{root}/t")
    assert spark.table(f"{db}.t").count() == 1 and reader.count() == 2     # the version before is kept for its readers
    for _ in range(3):
        tables.save_as_table(df, f"{db}.t", f"{root}/t")
    p, fs = tables._file_system(spark, f"{root}/t")
    assert len([x for x in fs.listStatus(p)]) == 2                        # older ones are gone
    tables.save_as_table(df.select("v"), f"{db}.t", f"{root}/t")           # a column is lost
    assert spark.table(f"{db}.t").columns == ["v"] and spark.table(f"{db}.t").count() == 2


def test_hidden_files_are_no_table(spark):
    root = scratch_dir(spark, "hidden")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    df.write.parquet(f"{root}/_staging")
    df.write.parquet(f"{root}/.tmp")
    assert not tables.path_exists(spark, root)
    df.write.partitionBy("v").parquet(f"{root}/t")
    assert tables.path_exists(spark, f"{root}/t") and tables.path_exists(spark, root)


def test_a_declared_schema_grows_without_a_footer_merge(spark):
    from pyspark.sql import functions as F

    from ledgerlake.operators.incremental import incremental_load
    root = scratch_dir(spark, "declared")
    db = "d_" + root.rsplit("-", 1)[-1][:8]
    tables.create_database(spark, db, f"{root}/db")
    name, path = f"{db}.t", f"{root}/t"

    def deliver(rows, **more):
        df = spark.createDataFrame(rows, "k string, t int, p string").withColumns(more)
        return incremental_load(spark, df, path, keys=["k"], ts_col="t", order=["t", "p"], partition_by=["p"], declared=name)

    deliver([("a", 1, "x"), ("b", 1, "y")])
    assert spark.table(name).columns == ["k", "t", "p"] and spark.table(name).count() == 2
    deliver([("b", 2, "z"), ("c", 2, "x")], fee=F.lit(0.5))                    # a column more, a partition less
    read = {r["k"]: (r["t"], r["p"], r["fee"]) for r in tables.read_declared(spark, name, path).collect()}
    assert read == {"a": (1, "x", None), "b": (2, "z", 0.5), "c": (2, "x", 0.5)}
    assert {r["k"]: (r["t"], r["p"], r["fee"]) for r in spark.table(name).collect()} == read
    assert deliver([("a", 1, "x")]).skipped                                    # the narrower rows again
    sc = spark.sparkContext
    jobs = {}
    for kind, open_table in (("declared", lambda: tables.read_declared(spark, name, path)), ("merged", lambda: tables.read_table(spark, path, merge_schema=True))):
        sc.setJobGroup(f"{db}-{kind}", kind)
        assert set(open_table().columns) == {"k", "t", "p", "fee"}
        jobs[kind] = len(sc.statusTracker().getJobIdsForGroup(f"{db}-{kind}"))
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == {"declared": 0, "merged": 1}                                # a merge of footers is a job
    try:
        tables.declare_table(spark, name, path, spark.createDataFrame([], "k int").schema)
        raise AssertionError("a column cannot change its type")
    except ValueError as e:
        assert "['k']" in str(e)


def test_raw_csv_is_compressed_and_read_back_whole(spark, monkeypatch):
    monkeypatch.setattr(tables, "CSV_ROWS_PER_FILE", 40)
    path, t = scratch_dir(spark, "csv-gz"), dt.datetime(2000, 1, 1, 12)
    rows = [(f"T{i}", None, "", t, 1.0, "U,S", 'a"b', "ok", "pos", "c", "k", "d") for i in range(100)]
    df = spark.createDataFrame(rows, RAW_SCHEMAS["transactions"]).coalesce(1)
    tables.write_raw_csv(df, path)
    back = tables.read_raw_csv(spark, path, "transactions")
    names = {r[0] for r in back.select("_metadata.file_name").distinct().collect()}
    assert len(names) == 3 and all(n.endswith(".csv.gz") for n in names)
    assert back.count() == 100 and {(r.currency, r.txn_type) for r in back.collect()} == {("U,S", 'a"b')}


def test_rows_of_one_partition_are_written_without_a_shuffle(spark):
    path = scratch_dir(spark, "one-partition")
    df = spark.range(40, numPartitions=4).selectExpr("id", "7 AS p")
    for _ in range(2):
        tables.write_table(df, path, mode="overwrite", partition_by=["p"], dynamic_overwrite=True, one_partition=True)
    back = tables.read_table(spark, path)
    assert back.count() == 40 and back.select("_metadata.file_name").distinct().count() == 4
