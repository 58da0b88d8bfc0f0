"""Physical plan checks: pushdown, partition pruning, map-side limits, no
single-partition window over raw rows."""

from pyspark.sql import functions as F

from ledgerlake.operators.windows import global_position
from ledgerlake.plans import dims, silver
from ledgerlake.session import scratch_dir
from ledgerlake.sources.bridge import AS_OF, raw_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_transactions_pushes_filter_and_prunes_columns(spark, sf_dir):
    df = silver.to_silver("transactions", raw_table(spark, sf_dir, "transactions"), AS_OF)
    p = plan(df.select("txn_id", "amount"))
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in p
    assert "l_quantity" not in p and "l_tax" not in p


def test_dedup_limits_before_the_shuffle(spark, sf_dir):
    df = silver.to_silver("transactions", raw_table(spark, sf_dir, "transactions"), AS_OF)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert p.count("WindowGroupLimit") >= 2        # partial (map side) + final


def test_top_merchants_uses_window_group_limit(spark, sf_dir):
    m = silver.to_silver("merchants", raw_table(spark, sf_dir, "merchants"), AS_OF)
    p = dims.top_merchants_by_category(m)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in p


def test_partitioned_silver_prunes_partitions(spark, sf_dir):
    path = scratch_dir(spark, "prune")
    df = silver.to_silver("transactions", raw_table(spark, sf_dir, "transactions"), AS_OF)
    df.write.partitionBy("txn_year", "txn_month").parquet(path)
    q = spark.read.parquet(path).filter((F.col("txn_year") == 1997) & (F.col("txn_month") == 3))
    p = plan(q)
    assert "PartitionFilters: [isnotnull(txn_year" in p and "(txn_month" in p
    assert q.count() == df.filter("txn_year = 1997 and txn_month = 3").count()


def test_global_position_has_no_single_partition_raw_window(spark, sf_dir):
    t = silver.to_silver("transactions", raw_table(spark, sf_dir, "transactions"), AS_OF)
    pos = global_position(t.select("txn_id", "amount"), [F.col("amount").desc(), "txn_id"])
    p = plan(pos)
    # The only single-partition step is the offsets window over one row per partition.
    assert p.count("SinglePartition") == 1
    single = p[:p.index("SinglePartition")]
    assert "_pid" in single[single.rindex("Window ["):]
    assert "HashAggregate(keys=[_pid" in p[p.index("SinglePartition"):]       # what it receives
    got = [r._pos for r in pos.orderBy("_pos").select("_pos").collect()]
    assert got == list(range(t.count()))


def test_fact_rows_shuffle_once_per_join_key_without_broadcasts(spark, sf_dir):
    """With every join a sort-merge join (as at scale), the transaction rows are
    shuffled by txn_id (dedup), account_id and merchant key - never by customer_id:
    the customer dimension is joined to accounts first."""
    import re

    import ledgerlake.queries as Q
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        p = Q.joined_fact_rows(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    top = [ln for ln in p.splitlines() if "SortMergeJoin" in ln]
    assert len(top) == 3
    # NULL merchant ids are spread by txn_id rather than hashed to one task.
    assert re.search(r"SortMergeJoin \[coalesce\(merchant_id#\d+, txn_id#\d+\)\]", top[0])
    assert re.search(r"SortMergeJoin \[account_id#\d+\]", top[1])
    assert re.search(r"SortMergeJoin \[customer_id#\d+\]", top[2])


def test_one_chart_needs_no_customer_rows(spark, sf_dir):
    import ledgerlake.queries as Q
    p = plan(Q.fact_spend(spark, sf_dir).groupBy("category").agg(F.sum("total_spend")))
    assert "txn_date" not in p.split("HashAggregate")[1] and "Window" not in p.split("SortMergeJoin")[0]
    assert "percentile" not in p and "max_running_spend" not in p


def test_a_dedup_for_some_columns_shuffles_no_later_ones(spark, sf_dir):
    raw = raw_table(spark, sf_dir, "transactions")
    columns = ["txn_id", "merchant_id", "txn_date", "amount", "is_debit"]
    some = silver.to_silver("transactions", raw.unionByName(raw.withColumn("city", F.lit("z")).withColumn("txn_type", F.lit("credit"))), AS_OF, columns)
    whole = silver.to_silver("transactions", raw.unionByName(raw.withColumn("city", F.lit("z")).withColumn("txn_type", F.lit("credit"))), AS_OF)
    assert sorted(map(tuple, some.collect()), key=str) == sorted(map(tuple, whole.select(*columns).collect()), key=str)
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    assert not any(c in plan[:plan.index("Relation")] for c in (" city#", "l_suppkey % 25", "description#"))
