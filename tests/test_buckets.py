"""Bucketed copies: joins without a shuffle of their rows, kept bucketed over loads."""

from pyspark.sql import functions as F

from ledgerlake.operators.buckets import bucket_sizes, is_hot, joinable, refresh_bucketed, save_bucketed
from ledgerlake.operators.incremental import incremental_load
from ledgerlake.plans import facts, silver
from ledgerlake.session import scratch_dir
from ledgerlake.sources.bridge import AS_OF, raw_table
from ledgerlake.sources.tables import create_database, read_table
from tests.test_skew import _hot_inputs, _with_conf

N, PART = 16, ["txn_year", "txn_month"]
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def new_table(spark):
    root = scratch_dir(spark, "buckets")
    db = "b_" + root.rsplit("-", 1)[-1][:10]
    create_database(spark, db, f"{root}/db")
    return f"{db}.t", f"{root}/t"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def content(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def above_fact_scan(text):
    """Lines of the plan from the fact's scan up to the join that reads it."""
    lines = text.split("+- == Initial Plan ==")[0].splitlines()
    at = next(i for i, x in enumerate(lines) if "Scan parquet" in x and "txn_id" in x)
    top = max(i for i, x in enumerate(lines[:at]) if "SortMergeJoin" in x)
    return lines[top:at + 1]


def test_account_join_does_not_shuffle_the_fact_rows(spark, sf_dir):
    def run():
        t, a, c = (silver.to_silver(n, raw_table(spark, sf_dir, n), AS_OF) for n in ("transactions", "accounts", "customers"))
        name, path = new_table(spark)
        save_bucketed(t, name, path, "account_id", N, PART)
        joined = facts.joined_transactions(joinable(spark, name, N), a, c)
        assert not [x for x in above_fact_scan(plan(joined)) if "Exchange" in x] and "Bucketed: true" in plan(joined)
        plain = facts.joined_transactions(t, a, c)
        assert content(joined, plain.columns) == content(plain, plain.columns)
    _with_conf(spark, NO_BROADCAST, run)


def test_a_hot_account_is_read_as_plain_files(spark, sf_dir):
    def run():
        t, a, c = _hot_inputs(spark, sf_dir)
        name, path = new_table(spark)
        save_bucketed(t, name, path, "account_id", N)
        sizes = {r["bucket"]: r["bytes"] for r in bucket_sizes(spark, name).collect()}
        assert set(sizes) <= set(range(N)) and max(sizes, key=sizes.get) == t.select(F.pmod(F.hash(F.lit("ACCT1")), F.lit(N))).first()[0]
        assert not is_hot(spark, name, N) and is_hot(spark, name, N, 2.0, 1)          # small tables have no hot bucket
        joined = facts.joined_transactions(joinable(spark, name, N, 2.0, 1), a, c)
        assert any("Exchange" in x for x in above_fact_scan(plan(joined)))
        plain = facts.joined_transactions(t, a, c)
        assert content(joined, plain.columns) == content(plain, plain.columns)
    _with_conf(spark, NO_BROADCAST, run)


def test_loads_keep_the_copy_bucketed_and_equal(spark):
    target = scratch_dir(spark, "buckets-silver")
    name, path = new_table(spark)

    def deliver(rows):
        df = spark.createDataFrame(rows, "k string, account_id string, t int, p string")
        done = incremental_load(spark, df, target, keys=["k"], ts_col="t", order=["t", "p", "account_id"], partition_by=["p"])
        first = not spark.catalog.tableExists(name)
        refresh_bucketed(spark, read_table(spark, target), name, path, "account_id", N, ["p"], None if first else done.rewritten_partitions)
        cols = ["k", "account_id", "t", "p"]
        assert content(spark.table(name), cols) == content(read_table(spark, target), cols)
        assert "Exchange" not in plan(spark.table(name).groupBy("account_id").count())
        return done.rewritten_partitions

    deliver([(f"k{i}", f"a{i % 9}", 1, "xyz"[i % 3]) for i in range(60)] + [("n", None, 1, None), ("q", "a1", 1, "it's")])
    untouched = {r[0] for r in spark.table(name).where("p = 'x'").select("_metadata.file_path").distinct().collect()}
    assert len(deliver([("k1", "a5", 2, "z"), ("k61", None, 2, "w")])) == 3
    assert {r[0] for r in spark.table(name).where("p = 'x'").select("_metadata.file_path").distinct().collect()} == untouched
    deliver([("n", "a2", 3, "w"), ("q", "a1", 3, "w")])                                # two partitions lose their last row
    assert spark.table(name).where("p IS NULL OR p = 'it''s'").count() == 0
    assert deliver([("n", "a2", 3, "w")]) == []


def test_empty_table(spark):
    name, path = new_table(spark)
    save_bucketed(spark.createDataFrame([], "account_id string, v int"), name, path, "account_id", 4)
    assert joinable(spark, name, 4).count() == 0 and not is_hot(spark, name, 4)
