"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the given test tables through the raw mapping, so its work grows
with the data.  Outputs use plain types for comparison with the DuckDB oracle:
decimals become DOUBLE (or BIGINT at scale 0); the library functions themselves keep
the exact decimal types.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import buckets, carry, incremental
from ledgerlake.operators.footers import stored_extremes
from ledgerlake.operators.joins import join_spreading_nulls
from ledgerlake.operators.metrics import load_counts, reject_counts
from ledgerlake.operators.windows import materialize
from ledgerlake.plans import dashboard, dims, facts, jobs, quarantine, silver
from ledgerlake.session import scratch_dir
from ledgerlake.sources import tables
from ledgerlake.sources.bridge import AS_OF, raw_table
from ledgerlake.streaming import silver_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def plain(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("bigint" if f.dataType.scale == 0 else "double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def silver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return silver.to_silver(name, raw_table(spark, sf_dir, name), AS_OF)


@query("silver_customers")
def q_silver_customers(spark, sf_dir):
    df = silver_table(spark, sf_dir, "customers")
    return plain(df.withColumn("age", F.col("age").cast("bigint")))


@query("silver_merchants")
def q_silver_merchants(spark, sf_dir):
    return silver_table(spark, sf_dir, "merchants")


@query("silver_accounts")
def q_silver_accounts(spark, sf_dir):
    return plain(silver_table(spark, sf_dir, "accounts"))


@query("silver_transactions")
def q_silver_transactions(spark, sf_dir):
    return plain(silver_table(spark, sf_dir, "transactions"))


# --------------------------------------------------------------------------- gold


def silver_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: silver_table(spark, sf_dir, n)
            for n in ("customers", "merchants", "accounts", "transactions")}


#: What the fact takes from a silver transaction.
FACT_INPUT = ["txn_id", "account_id", "merchant_id", "txn_date", "amount", "is_debit"]


def joined_fact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = silver_all(spark, sf_dir)
    s["transactions"] = silver.to_silver("transactions", raw_table(spark, sf_dir, "transactions"), AS_OF, FACT_INPUT)
    return facts.joined_transactions(s["transactions"], s["accounts"], s["customers"],
                                     s["merchants"])


def fact_monthly_mart(spark: SparkSession, sf_dir: str, measures=facts.MEASURES) -> DataFrame:
    return facts.transactions_enhanced(joined_fact_rows(spark, sf_dir), with_load_ts=False, measures=measures)


def fact_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly fact with the one measure that the spend charts need."""
    return fact_monthly_mart(spark, sf_dir, ["total_spend"])


@query("age_rank_by_gender")
def q_age_rank_by_gender(spark, sf_dir):
    df = dims.age_rank_by_gender(silver_table(spark, sf_dir, "customers"))
    return df.withColumn("age", F.col("age").cast("bigint"))


@query("dim_customers")
def q_dim_customers(spark, sf_dir):
    df = dims.customers_enhanced(silver_table(spark, sf_dir, "customers"), with_load_ts=False)
    return df.withColumn("max_age", F.col("max_age").cast("bigint"))


@query("top_merchants_by_category")
def q_top_merchants_by_category(spark, sf_dir):
    df = dims.top_merchants_by_category(silver_table(spark, sf_dir, "merchants"))
    return df.withColumn("merchant_rank_category", F.col("merchant_rank_category").cast("bigint"))


@query("dim_merchants")
def q_dim_merchants(spark, sf_dir):
    return dims.merchants_enhanced(silver_table(spark, sf_dir, "merchants"), with_load_ts=False)


@query("running_balance")
def q_running_balance(spark, sf_dir):
    df = dims.running_balance(silver_table(spark, sf_dir, "accounts"))
    return plain(df.select("account_id", "customer_id", "opened_date", "balance",
                           "running_balance"))


@query("dim_accounts")
def q_dim_accounts(spark, sf_dir):
    return plain(dims.accounts_enhanced(silver_table(spark, sf_dir, "accounts"),
                                        with_load_ts=False))


ENRICHED_COLUMNS = ["txn_id", "customer_id", "merchant_id", "txn_date", "transaction_month",
                    "age_group", "category", "amount", "balance", "spend_amount",
                    "income_amount", "running_spend", "prev_txn_spend", "spend_growth", "amount_rank"]


@query("fact_enriched")
def q_fact_enriched(spark, sf_dir):
    df = facts.enriched_transactions(joined_fact_rows(spark, sf_dir))
    df = plain(df.select(*ENRICHED_COLUMNS))
    return df.withColumn("spend_growth", F.round("spend_growth", 6))


@query("running_spend_carried")
def q_running_spend_carried(spark, sf_dir):
    """W3, W4, W6 over three deliveries, the last of them out of order: rows of all days that
    come too late.  Equal to the windows over all rows."""
    rows = materialize(joined_fact_rows(spark, sf_dir).select("txn_id", "customer_id", "txn_date", "spend_amount"), "carry-input")
    path, straggler = scratch_dir(spark, "carry"), F.pmod(F.xxhash64("txn_id"), F.lit(60)) == 0
    early = F.col("txn_date") < F.to_date(F.lit(FIRST_LOAD_BEFORE))
    for part in (rows.where(early & ~straggler), rows.where(~early & ~straggler), rows.where(straggler)):
        carry.extend(spark, part, path, key="customer_id", order_col="txn_date", tie_col="txn_id", value_col="spend_amount",
                     running_col="running_spend", previous_col="prev_txn_spend", buckets=1)
    return plain(carry.read_carried(spark, path).select("txn_id", "customer_id", "txn_date", "spend_amount", "running_spend", "prev_txn_spend"))


@query("amount_rank")
def q_amount_rank(spark, sf_dir):
    return plain(facts.amount_rank(silver_table(spark, sf_dir, "transactions")))


@query("fact_monthly")
def q_fact_monthly(spark, sf_dir):
    df = plain(fact_monthly_mart(spark, sf_dir))
    return df.withColumn("amount_balance_corr", F.round("amount_balance_corr", 6))


def customer_spend_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer spend needs only the accounts (the customer_id comes from them)."""
    t, a = silver_table(spark, sf_dir, "transactions"), silver_table(spark, sf_dir, "accounts")
    return facts.customer_spend_by_account(t, a)


@query("customer_spend")
def q_customer_spend(spark, sf_dir):
    return plain(customer_spend_mart(spark, sf_dir))


@query("customer_spend_top10")
def q_customer_spend_top10(spark, sf_dir):
    return plain(facts.top_customers(customer_spend_mart(spark, sf_dir), 10))


@query("spend_by_category")
def q_spend_by_category(spark, sf_dir):
    return plain(facts.spend_by_category(fact_spend(spark, sf_dir)))


@query("monthly_spend")
def q_monthly_spend(spark, sf_dir):
    return plain(facts.monthly_spend(fact_spend(spark, sf_dir)))


# ------------------------------------------------------------ sources and loads

# Where the test input is split into two deliveries.  The deliveries
# overlap for one year, so the second repeats keys of the first.
FIRST_LOAD_BEFORE = "1998-01-01 00:00:00"
SECOND_LOAD_FROM = "1997-01-01 00:00:00"


def _two_deliveries(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without an event time come with the first delivery."""
    ts = F.col("timestamp")
    return (raw.filter((ts < F.to_timestamp(F.lit(FIRST_LOAD_BEFORE))) | ts.isNull()),
            raw.filter(ts >= F.to_timestamp(F.lit(SECOND_LOAD_FROM))))


@query("raw_csv_transactions")
def q_raw_csv_transactions(spark, sf_dir):
    """Raw transactions written as headered CSV, read back with the declared schema."""
    path = scratch_dir(spark, "raw-csv")
    tables.write_raw_csv(raw_table(spark, sf_dir, "transactions"), path, "overwrite")
    return tables.read_raw_csv(spark, path, "transactions")


def _silver_load(spark, sf_dir, late: str, **how) -> DataFrame:
    first, second = _two_deliveries(raw_table(spark, sf_dir, "transactions"))
    target = scratch_dir(spark, f"silver-{late}")
    for delivery in (first, second):
        incremental.incremental_load(
            spark, delivery, target, keys=["txn_id"], ts_col="timestamp",
            order=silver.total_order_for("transactions"), late=late,
            transform=lambda d: silver.valid("transactions", d, AS_OF),
            partition_by=silver_stream.PARTITION_COLS, **how)
    return plain(tables.read_table(spark, target).select(*silver.SILVER_COLUMNS["transactions"]))


@query("bronze_drop_transactions")
def q_bronze_drop(spark, sf_dir):
    """S1 + S5/S6/S9 at the bronze layer: two CSV deliveries appended under the
    high-water-mark policy (rows at or below the bronze mark are skipped)."""
    first, second = _two_deliveries(raw_table(spark, sf_dir, "transactions"))
    target = scratch_dir(spark, "bronze-drop")
    for i, delivery in enumerate((first, second)):
        path = scratch_dir(spark, f"raw-delivery-{i}")
        tables.write_raw_csv(delivery, path, "overwrite")
        incremental.incremental_load(
            spark, tables.read_raw_csv(spark, path, "transactions"), target,
            keys=["txn_id"], ts_col="timestamp", order=["timestamp"], late="drop", write="append")
    return tables.read_table(spark, target)


@query("reload_merchants")
def q_reload_merchants(spark, sf_dir):
    """A table without event time is delivered in full on every run; the upsert by
    key makes the second full delivery change nothing."""
    target = scratch_dir(spark, "silver-merchants")
    for _ in range(2):
        incremental.incremental_load(
            spark, raw_table(spark, sf_dir, "merchants"), target, keys=["merchant_id"],
            ts_col=None, order=silver.total_order_for("merchants"), late="upsert",
            transform=lambda d: silver.to_silver("merchants", d, AS_OF))
    return tables.read_table(spark, target).select(*silver.SILVER_COLUMNS["merchants"])


@query("incremental_upsert_transactions")
def q_incremental_upsert(spark, sf_dir):
    """S4-S10 with the upsert policy: two overlapping deliveries == one full load."""
    return _silver_load(spark, sf_dir, "upsert")


@query("incremental_upsert_indexed")
def q_incremental_upsert_indexed(spark, sf_dir):
    """The same loads, where a key index tells which partitions may hold a delivered key."""
    return _silver_load(spark, sf_dir, "upsert", key_index=True)


@query("incremental_drop_transactions")
def q_incremental_drop(spark, sf_dir):
    """S4-S10 with the high-water-mark policy: of the second delivery only rows after the
    mark are read; what is read is upserted by key."""
    return _silver_load(spark, sf_dir, "drop", day_col="txn_date")


@query("incremental_upsert_declared")
def q_incremental_upsert_declared(spark, sf_dir):
    """The same loads into a table whose schema the catalog holds; read by its name."""
    root = scratch_dir(spark, "declared")
    database = "silver_" + root.rsplit("-", 1)[-1]
    tables.create_database(spark, database, f"{root}/db")
    _silver_load(spark, sf_dir, "upsert", declared=f"{database}.transactions")
    return plain(spark.table(f"{database}.transactions").select(*silver.SILVER_COLUMNS["transactions"]))


@query("stored_partition_metrics")
def q_stored_partition_metrics(spark, sf_dir):
    """Rows, first and last day of each partition of stored silver transactions,
    answered by the footers of its files."""
    target = scratch_dir(spark, "stored-silver")
    tables.write_table(silver_table(spark, sf_dir, "transactions"), target, partition_by=silver_stream.PARTITION_COLS)
    rows = stored_extremes(spark, target, ["txn_date"], silver_stream.PARTITION_COLS)
    return spark.createDataFrame([(r["txn_year"], r["txn_month"], r["n"], r["min_txn_date"], r["max_txn_date"]) for r in rows],
                                 "txn_year int, txn_month int, silver_rows long, first_day date, last_day date")


@query("account_join_bucketed")
def q_account_join_bucketed(spark, sf_dir):
    """Silver transactions kept as a table bucketed by account over two overlapping
    deliveries, and joined to accounts and customers without a shuffle of their rows."""
    root = scratch_dir(spark, "bucketed")
    database, target = "bucketed_" + root.rsplit("-", 1)[-1], f"{root}/silver"
    tables.create_database(spark, database, f"{root}/db")
    name, by, n = f"{database}.transactions", silver_stream.PARTITION_COLS, int(spark.conf.get("spark.sql.shuffle.partitions"))
    for delivery in _two_deliveries(raw_table(spark, sf_dir, "transactions")):
        done = incremental.incremental_load(
            spark, delivery, target, keys=["txn_id"], ts_col="timestamp", order=silver.total_order_for("transactions"),
            transform=lambda d: silver.valid("transactions", d, AS_OF), partition_by=by)
        changed = done.rewritten_partitions if tables.table_exists(spark, name) else None
        buckets.refresh_bucketed(spark, tables.read_table(spark, target), name, f"{root}/bucketed", "account_id", n, by, changed)
    joined = facts.joined_transactions(buckets.joinable(spark, name, n), silver_table(spark, sf_dir, "accounts"), silver_table(spark, sf_dir, "customers"))
    return plain(joined.select("txn_id", "account_id", "customer_id", "age_group", "balance", "amount", "transaction_month"))


@query("append_dedup_transactions")
def q_append_dedup(spark, sf_dir):
    """Raw CSV append; in-batch first row (earliest) wins, known keys skipped."""
    first, second = _two_deliveries(raw_table(spark, sf_dir, "transactions"))
    path = scratch_dir(spark, "raw-append")
    tables.write_raw_csv(first, path, "overwrite")
    cols = [c for c in second.columns if c not in ("txn_id", "timestamp")]
    order = [F.col(c).asc_nulls_first() for c in ["timestamp", *cols]]
    incremental.append_new_rows(spark, second, path, keys=["txn_id"], order=order)
    return tables.read_raw_csv(spark, path, "transactions")


@query("job_silver_transactions")
def q_job_silver(spark, sf_dir):
    """The job's bronze and silver stages after each of two overlapping CSV
    deliveries and once more without a new one equal one full load."""
    raw_dir, lake = scratch_dir(spark, "job-raw"), scratch_dir(spark, "job-lake")
    first, second = _two_deliveries(raw_table(spark, sf_dir, "transactions"))
    for delivery in (first, second, None):
        if delivery is not None:
            tables.write_raw_csv(delivery, f"{raw_dir}/transactions", "append")
        jobs.ingest_bronze(spark, raw_dir, lake, names=["transactions"])
        jobs.build_silver(spark, lake, as_of=AS_OF, names=["transactions"])
    out = tables.read_table(spark, f"{lake}/silver/transactions", merge_schema=True)
    return plain(out.select(*silver.SILVER_COLUMNS["transactions"]))


@query("job_bronze_transactions")
def q_job_bronze(spark, sf_dir):
    """Bronze keeps every delivered row, those of repeated keys too."""
    raw_dir, lake = scratch_dir(spark, "job-raw"), scratch_dir(spark, "job-lake")
    for delivery in _two_deliveries(raw_table(spark, sf_dir, "transactions")):
        tables.write_raw_csv(delivery, f"{raw_dir}/transactions", "append")
        jobs.ingest_bronze(spark, raw_dir, lake, names=["transactions"])
    return tables.read_table(spark, f"{lake}/bronze/transactions").drop(tables.CORRUPT_COLUMN)


# Fixed value: a date that lies within the deliveries, so that rows after it are rejected at first.
EARLY_AS_OF = "1999-06-30"


def _drop_loads(spark, sf_dir, as_of) -> str:
    """Two deliveries loaded under the drop policy; the lake they are in."""
    raw_dir, lake = scratch_dir(spark, "job-raw"), scratch_dir(spark, "job-lake")
    for delivery in _two_deliveries(raw_table(spark, sf_dir, "transactions")):
        tables.write_raw_csv(delivery, f"{raw_dir}/transactions", "append")
        jobs.ingest_bronze(spark, raw_dir, lake, late="drop", names=["transactions"])
        jobs.build_silver(spark, lake, as_of=as_of, names=["transactions"])
    return lake


@query("quarantine_balance")
def q_quarantine_balance(spark, sf_dir):
    """T-4, T5, S20: per load, delivered rows = late + rejected + valid rows."""
    return jobs.load_balance(spark, _drop_loads(spark, sf_dir, EARLY_AS_OF), "transactions")


@query("quarantine_rows")
def q_quarantine_rows(spark, sf_dir):
    """T-4, T5: the rows left out, as delivered, with the reason and the load."""
    kept = quarantine.read(spark, f"{_drop_loads(spark, sf_dir, EARLY_AS_OF)}/quarantine/transactions", "transactions")
    return kept.select("txn_id", "account_id", "merchant_id", "timestamp", "amount", "status", "reject_reason", "stage", "load_id")


@query("quarantine_replay")
def q_quarantine_replay(spark, sf_dir):
    """T-4: late rows and rows of the future are replayed under a later date and a policy that
    admits late rows; silver is then that of one full load."""
    lake = _drop_loads(spark, sf_dir, EARLY_AS_OF)
    jobs.replay_quarantine(spark, lake, as_of=AS_OF, admit_late=True, names=["transactions"])
    out = tables.read_table(spark, f"{lake}/silver/transactions", merge_schema=True)
    return plain(out.select(*silver.SILVER_COLUMNS["transactions"]))


@query("stream_rejects")
def q_stream_rejects(spark, sf_dir):
    """T-1, T5: the rows that the streaming load leaves out, with their reasons."""
    src, kept = scratch_dir(spark, "stream-src"), scratch_dir(spark, "stream-rejects")
    tables.write_raw_csv(raw_table(spark, sf_dir, "transactions"), src, "append")
    silver_stream.run_silver_stream(spark, src, scratch_dir(spark, "stream-sink"), scratch_dir(spark, "stream-ckpt"), as_of=AS_OF, fmt="csv", quarantine_dir=kept)
    return quarantine.read(spark, kept, "transactions").select("txn_id", "timestamp", "amount", "status", "reject_reason", "stage")


@query("gold_catalog_tables")
def q_gold_catalog(spark, sf_dir):
    """The gold marts written as tables of a database, and the monthly fact read
    back through its view."""
    lake = scratch_dir(spark, "gold-lake")
    for name, df in silver_all(spark, sf_dir).items():
        tables.write_table(df, f"{lake}/silver/{name}", partition_by=jobs.PARTITIONS.get(name))
    database = "gold_" + lake.rsplit("-", 1)[-1]
    jobs.build_gold(spark, lake, database=database)
    df = plain(spark.table(f"{database}.fact_transaction_summary").drop("load_ts"))
    return df.withColumn("amount_balance_corr", F.round("amount_balance_corr", 6))


@query("incremental_gold")
def q_incremental_gold(spark, sf_dir):
    """The monthly fact kept up to date over two overlapping deliveries of
    transactions and merchants; months without changes are not read again."""
    lake, raw_dir = scratch_dir(spark, "gold-lake"), scratch_dir(spark, "gold-raw")
    database = "gold_" + lake.rsplit("-", 1)[-1]
    for name in ("customers", "accounts"):
        tables.write_table(silver_table(spark, sf_dir, name), f"{lake}/silver/{name}")
    merchants = raw_table(spark, sf_dir, "merchants")
    # Merchants with these last digits come with the second delivery only.
    deliveries = zip(_two_deliveries(raw_table(spark, sf_dir, "transactions")), (merchants.where("NOT merchant_id LIKE '%77'"), merchants))
    for rows, some in deliveries:
        tables.write_raw_csv(rows, f"{raw_dir}/transactions", "append")
        tables.write_raw_csv(some, f"{raw_dir}/merchants", "append")
        jobs.ingest_bronze(spark, raw_dir, lake, names=["transactions", "merchants"])
        jobs.build_silver(spark, lake, as_of=AS_OF, names=["transactions", "merchants"])
        jobs.update_gold(spark, lake, database=database)
    df = plain(spark.table(f"{database}.fact_transaction_summary").drop("load_ts"))
    return df.withColumn("amount_balance_corr", F.round("amount_balance_corr", 6))


@query("upsert_null_keys")
def q_upsert_null_keys(spark, sf_dir):
    """Transactions some of whose keys are NULL, in two deliveries that overlap.
    All rows without a key are versions of one key, whatever delivery they come with."""
    raw = raw_table(spark, sf_dir, "transactions").withColumn("txn_id", F.when(~F.col("txn_id").like("%7-_"), F.col("txn_id")))
    target, appended = scratch_dir(spark, "null-keys"), scratch_dir(spark, "null-keys-raw")
    order = [F.col(c).asc_nulls_first() for c in ["timestamp", *[c for c in raw.columns if c not in ("txn_id", "timestamp")]]]
    for delivery in _two_deliveries(raw):
        incremental.incremental_load(
            spark, delivery, target, keys=["txn_id"], ts_col="timestamp", order=silver.total_order_for("transactions"),
            transform=lambda d: silver.valid("transactions", d, AS_OF), partition_by=silver_stream.PARTITION_COLS)
        incremental.append_new_rows(spark, delivery, appended, keys=["txn_id"], order=order)
    merged = tables.read_table(spark, target).select("txn_id", "account_id", "timestamp", F.col("amount").cast("double").alias("amount"), F.lit("upsert").alias("how"))
    return merged.unionByName(tables.read_raw_csv(spark, appended, "transactions").select("txn_id", "account_id", "timestamp", "amount", F.lit("append").alias("how")))


@query("fact_report")
def q_fact_report(spark, sf_dir):
    """O1: the fact in report order."""
    return plain(facts.fact_report_order(fact_monthly_mart(spark, sf_dir, ["total_spend", "transaction_count"])))


@query("fk_orphans")
def q_fk_orphans(spark, sf_dir):
    """Silver rows whose foreign key has no parent row (left anti joins).  The
    parents are dealt anew before the joins, so Spark can split a hot parent key."""
    s = silver_all(spark, sf_dir)
    acc = (join_spreading_nulls(s["accounts"], s["customers"].select("customer_id").hint("rebalance"),
                                "customer_id", "account_id", "left_anti")
           .select(F.lit("accounts").alias("child_table"), F.col("account_id").alias("child_key"),
                   F.col("customer_id").alias("parent_key")))
    txn = (join_spreading_nulls(s["transactions"], s["accounts"].select("account_id").hint("rebalance"),
                                "account_id", "txn_id", "left_anti")
           .select(F.lit("transactions").alias("child_table"), F.col("txn_id").alias("child_key"),
                   F.col("account_id").alias("parent_key")))
    return acc.unionByName(txn)


@query("high_water_marks")
def q_high_water_marks(spark, sf_dir):
    """The event-time mark of each silver table with one.  The newest version of a
    key survives, so the dedup cannot change the largest event time."""
    out = None
    for name in ("customers", "accounts", "transactions"):
        ts = silver.TS_COLUMNS[name]
        one = (silver.valid(name, raw_table(spark, sf_dir, name), AS_OF)
               .agg(F.max(F.col(ts).cast("timestamp")).alias("high_water_mark"))
               .select(F.lit(name).alias("table_name"), "high_water_mark"))
        out = one if out is None else out.unionByName(one)
    return out


def _per_table(spark, sf_dir, count) -> DataFrame:
    out = None
    for name in ("customers", "merchants", "accounts", "transactions"):
        one = count(silver.graded(name, raw_table(spark, sf_dir, name), AS_OF), name)
        out = one if out is None else out.unionByName(one)
    return out


@query("load_metrics")
def q_load_metrics(spark, sf_dir):
    """Raw, valid, rejected and silver row counts, one scan per table."""
    return _per_table(spark, sf_dir, lambda df, name: load_counts(df, silver.KEYS[name], name))


@query("load_rejects")
def q_load_rejects(spark, sf_dir):
    """T5: rejected rows per table and reason."""
    return _per_table(spark, sf_dir, reject_counts)


# The dashboard filters the registered queries exercise.
DASHBOARD_CATEGORY = "Econ"
DASHBOARD_START, DASHBOARD_END = "1996-01-01", "1999-12-01"
DASHBOARD_CLICK = "1997-03-01"


DASHBOARD = {"charts": [
    {"id": "by_month", "type": "line", "title": "Spend per month",
     "sql": "SELECT transaction_month, SUM(total_spend) AS total_spend FROM {df_facts} GROUP BY transaction_month"},
    {"id": "by_category", "type": "pie", "title": "Spend per category",
     "sql": "SELECT category, SUM(total_spend) AS spend FROM {df_facts} GROUP BY category"},
]}
CUSTOMER_DASHBOARD = {"charts": [
    {"id": "top_customers", "type": "bar", "title": "Ten customers with the highest spend",
     "sql": "SELECT customer_id, total_spend FROM {df_facts} ORDER BY total_spend DESC, customer_id LIMIT 10"},
]}


@query("dashboard_filtered")
def q_dashboard_filtered(spark, sf_dir):
    """F9/F10 + G7: spend by category chart with category and date filters."""
    charts = dashboard.run_dashboard(
        spark, fact_spend(spark, sf_dir), DASHBOARD, category=DASHBOARD_CATEGORY,
        start=dt.date.fromisoformat(DASHBOARD_START), end=dt.date.fromisoformat(DASHBOARD_END))
    return plain(charts["by_category"])


@query("dashboard_drilldown")
def q_dashboard_drilldown(spark, sf_dir):
    """F11 + G7: monthly trend chart drilled down to one clicked month."""
    charts = dashboard.run_dashboard(spark, fact_spend(spark, sf_dir), DASHBOARD, clicked=DASHBOARD_CLICK)
    return plain(charts["by_month"])


@query("dashboard_customers")
def q_dashboard_customers(spark, sf_dir):
    """G7 over the customer-spend mart; it has no category to filter by."""
    charts = dashboard.run_dashboard(spark, customer_spend_mart(spark, sf_dir), CUSTOMER_DASHBOARD, category=DASHBOARD_CATEGORY)
    return plain(charts["top_customers"])


# Event-time boundaries of the deliveries fed to the streaming load.
STREAM_DELIVERY_BOUNDS = ["1996-01-01 00:00:00", "1998-01-01 00:00:00", "2000-01-01 00:00:00"]


@query("stream_silver_transactions")
def q_stream_silver_transactions(spark, sf_dir):
    """T-1..T-3: file stream with watermark, drop of copies and upsert by key.

    Input: every raw transaction, delivered twice (copies in the same delivery).
    Deliveries arrive in event-time order; after each one the job runs with
    ``availableNow`` and resumes from its checkpoint, as a scheduled job would.
    """
    raw = raw_table(spark, sf_dir, "transactions")
    src = scratch_dir(spark, "stream-src")
    sink, ckpt = scratch_dir(spark, "stream-sink"), scratch_dir(spark, "stream-ckpt")
    bounds = [None, *STREAM_DELIVERY_BOUNDS, None]
    ts = F.col("timestamp")
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        part = raw.unionByName(raw)
        if lo is not None:
            part = part.filter(ts >= F.to_timestamp(F.lit(lo)))
        if hi is not None:
            inside = ts < F.to_timestamp(F.lit(hi))
            part = part.filter(inside if lo is not None else inside | ts.isNull())
        tables.write_raw_csv(part, src, "append")          # raw deliveries are CSV files
        silver_stream.run_silver_stream(spark, src, sink, ckpt, as_of=AS_OF, fmt="csv")
    return plain(tables.read_table(spark, sink, merge_schema=True).select(*silver.SILVER_COLUMNS["transactions"]))
