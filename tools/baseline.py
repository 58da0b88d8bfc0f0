"""Times of the marts written as plain Spark: windows over raw rows, one join after the other,

    python tools/baseline.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.functions import rules
from ledgerlake.plans import silver
from ledgerlake.sources.bridge import AS_OF, raw_table


def marts(spark, sf_dir):
    s = {n: silver.to_silver(n, raw_table(spark, sf_dir, n), AS_OF) for n in silver.KEYS}
    cust = s["customers"].withColumn("age_group", rules.age_group("age"))
    by_category = Window.partitionBy("category").orderBy(F.col("merchant_name").desc_nulls_last())
    top = s["merchants"].withColumn("r", F.dense_rank().over(by_category)).where("r <= 5")
    balance = F.sum("balance").over(Window.partitionBy("customer_id").orderBy("opened_date"))
    accounts = s["accounts"].withColumn("running_balance", balance)
    rows = (s["transactions"].join(s["accounts"].select("account_id", "customer_id", "balance"), "account_id", "left")
            .join(cust.select("customer_id", "age_group"), "customer_id", "left")
            .join(s["merchants"].select("merchant_id", "category"), "merchant_id", "left")
            .withColumn("transaction_month", rules.month_start("txn_date"))
            .withColumn("spend_amount", rules.spend_amount("is_debit", "amount")))
    spend = Window.partitionBy("customer_id").orderBy("txn_date")
    rows = rows.withColumn("running_spend", F.sum("spend_amount").over(spend))
    enriched = (rows.withColumn("prev", F.lag("spend_amount").over(Window.partitionBy("customer_id").orderBy("txn_date", "txn_id")))
                .withColumn("amount_rank", F.row_number().over(Window.orderBy(F.col("amount").desc(), "txn_id"))))
    fact = rows.groupBy("transaction_month", "age_group", "category").agg(
        F.sum("spend_amount").alias("total_spend"), F.count("txn_id").alias("n"), F.avg("amount").alias("a"), F.count_distinct("customer_id").alias("c"),
        F.percentile_approx("amount", 0.95).alias("p"), F.max("running_spend").alias("m"))
    return {
        "silver_transactions": s["transactions"],
        "dim_customers": cust.groupBy("age_group", "gender").agg(F.count("customer_id").alias("n"), F.avg("age").alias("a")),
        "dim_merchants": top.groupBy("category", "country").agg(F.count("merchant_id").alias("n"), F.sort_array(F.collect_list("merchant_name")).alias("l")),
        "dim_accounts": accounts.withColumn("b", rules.balance_bucket("balance")).groupBy("account_type", "status", "b").agg(F.avg("balance").alias("a"), F.sum("running_balance").alias("r")),
        "running_balance": accounts,
        "age_rank_by_gender": s["customers"].withColumn("r", F.row_number().over(Window.partitionBy("gender").orderBy(F.col("age").desc(), "customer_id"))),
        "amount_rank": s["transactions"].select("txn_id", "amount", F.row_number().over(Window.orderBy(F.col("amount").desc(), "txn_id")).alias("r")),
        "fact_monthly": fact,
        "fact_enriched": enriched,
        "customer_spend_top10": rows.groupBy("customer_id").agg(F.sum("spend_amount").alias("t")).orderBy(F.col("t").desc()).limit(10),
        "dashboard_filtered": fact.where(F.col("category").contains("Econ")).groupBy("category").agg(F.sum("total_spend").alias("s")),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]").config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    marts(spark, sf_dir)["dim_customers"].write.format("noop").mode("overwrite").save()
    times = {}
    for name in marts(spark, sf_dir):
        t0 = time.perf_counter()
        marts(spark, sf_dir)[name].write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps(times))


if __name__ == "__main__":
    main()
