"""A hot key holding a third of the rows: AQE splits it in the fact's account join."""

from pyspark.sql import functions as F

from ledgerlake.plans import silver
from ledgerlake.sources.bridge import AS_OF, raw_table

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _hot_inputs(spark, sf_dir):
    t = silver.to_silver("transactions", raw_table(spark, sf_dir, "transactions"), AS_OF)
    hot = F.when(F.abs(F.hash("txn_id")) % 3 == 0, F.lit("ACCT1")).otherwise(F.col("account_id"))
    a = silver.to_silver("accounts", raw_table(spark, sf_dir, "accounts"), AS_OF)
    c = silver.to_silver("customers", raw_table(spark, sf_dir, "customers"), AS_OF)
    return t.withColumn("account_id", hot), a, c


def test_hot_account_is_split_in_the_fact_join(spark, sf_dir):
    from ledgerlake.plans import facts

    def run():
        t, a, c = _hot_inputs(spark, sf_dir)
        joined = facts.joined_transactions(t, a, c)
        rows = joined.collect()
        assert len(rows) == t.count()                     # a left join keeps every row
        return joined._jdf.queryExecution().executedPlan().toString()
    plan = _with_conf(spark, SKEW_CONF, run)
    assert "SortMergeJoin(skew=true) [account_id" in plan


def test_customer_spend_collapses_a_hot_account_before_joining(spark, sf_dir):
    from ledgerlake.plans import facts

    def run():
        t, a, _ = _hot_inputs(spark, sf_dir)
        got = facts.customer_spend_by_account(t, a)
        exp = facts.customer_spend(facts.joined_transactions(t, a))
        assert {r[0]: tuple(r) for r in got.collect()} == {r[0]: tuple(r) for r in exp.collect()}
        return got._jdf.queryExecution().executedPlan().toString()
    plan = _with_conf(spark, SKEW_CONF, run)
    join_at = plan.index("SortMergeJoin")
    below = plan[join_at:]
    assert "HashAggregate(keys=[account_id" in below     # per-account partial sums feed the join


def test_hot_merchant_is_split_in_the_merchant_join(spark, sf_dir):
    from ledgerlake.plans import facts

    def run():
        t, a, c = _hot_inputs(spark, sf_dir)
        hot = F.when(F.abs(F.hash("txn_id")) % 3 == 1, F.lit("M1")).otherwise(F.col("merchant_id"))
        t = t.withColumn("merchant_id", hot)
        m = silver.to_silver("merchants", raw_table(spark, sf_dir, "merchants"), AS_OF)
        joined = facts.joined_transactions(t, a, c, m)
        assert len(joined.collect()) == t.count()
        return joined._jdf.queryExecution().executedPlan().toString()
    plan = _with_conf(spark, SKEW_CONF, run)
    assert "SortMergeJoin(skew=true) [coalesce(merchant_id" in plan


def test_hot_customer_is_split_when_accounts_meet_customers(spark, sf_dir):
    from ledgerlake.plans import facts

    def run():
        t, a, c = _hot_inputs(spark, sf_dir)
        a = a.withColumn("customer_id", F.when(F.abs(F.hash("account_id")) % 3 == 0, F.lit("CUST1")).otherwise(F.col("customer_id")))
        joined = facts.joined_transactions(t, a, c)
        assert len(joined.collect()) == t.count()
        return joined._jdf.queryExecution().executedPlan().toString()
    plan = _with_conf(spark, SKEW_CONF, run)
    assert "SortMergeJoin(skew=true) [customer_id" in plan


def test_hot_parent_keys_are_split_in_the_orphan_checks(spark, sf_dir):
    from ledgerlake.operators.joins import join_spreading_nulls

    def run():
        t, a, _ = _hot_inputs(spark, sf_dir)
        orphans = join_spreading_nulls(t, a.select("account_id").hint("rebalance"), "account_id", "txn_id", "left_anti")
        orphans.collect()
        return orphans._jdf.queryExecution().executedPlan().toString()
    plan = _with_conf(spark, SKEW_CONF, run)
    assert "SortMergeJoin(skew=true) [coalesce(account_id" in plan


def test_a_name_of_a_third_of_all_merchants(spark):
    """Counted before ranking: one row per name reaches the ranking window, and a group's
    lists have at most five names."""
    from ledgerlake.plans import dims
    rows = spark.range(3000).select(
        F.concat(F.lit("M"), F.col("id").cast("string")).alias("merchant_id"),
        F.when(F.col("id") % 3 == 0, F.lit("Zed")).otherwise(F.concat(F.lit("n"), (F.col("id") % 40).cast("string"))).alias("merchant_name"),
        F.lit("Cat").alias("category"), F.lit("City").alias("city"), F.concat(F.lit("C"), (F.col("id") % 2).cast("string")).alias("country"))
    got = {r.country: r for r in dims.merchants_enhanced(rows, with_load_ts=False).collect()}
    assert sum(r.top_merchant_counts[r.top_merchants.index("Zed")] if "Zed" in r.top_merchants else 0 for r in got.values()) == 0
    first = dims.top_merchants_by_category(rows)
    assert first.where("merchant_rank_category = 1").select("merchant_name").distinct().collect()[0][0] == "n9"
    assert all(len(r.top_merchants) <= 5 and r.merchant_count == sum(r.top_merchant_counts) for r in got.values())
    top = rows.withColumn("merchant_name", F.when(F.col("merchant_name") == "Zed", F.lit("zz")).otherwise(F.col("merchant_name")))
    got = dims.merchants_enhanced(top, with_load_ts=False).collect()
    assert sum(r.top_merchant_counts[-1] for r in got) == 1000
