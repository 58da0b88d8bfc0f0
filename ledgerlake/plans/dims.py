"""Gold dimension marts (customers, merchants, accounts) and their window queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import rules
from ledgerlake.operators.windows import join_null_safe, row_number_by, with_running_total

TOP_MERCHANT_RANKS = rules.TOP_MERCHANT_RANKS


def customers_with_group(customers: DataFrame) -> DataFrame:
    return customers.withColumn("age_group", rules.age_group("age"))


def age_rank_by_gender(customers: DataFrame) -> DataFrame:
    """row_number by gender, oldest first, customer_id breaking ties."""
    ranked = row_number_by(customers.select("customer_id", "gender", "age"),
                           ["gender"], [F.col("age").desc_nulls_last(), "customer_id"],
                           "age_rank_gender")
    return ranked


def customers_enhanced(customers: DataFrame, with_load_ts: bool = True) -> DataFrame:
    """G1: count, average and maximum age per (age_group, gender)."""
    out = (customers_with_group(customers)
           .groupBy("age_group", "gender")
           .agg(F.count("customer_id").alias("customer_count"),
                F.avg("age").alias("avg_age"),
                F.max("age").alias("max_age")))
    return out.withColumn("load_ts", F.current_timestamp()) if with_load_ts else out


def _ranked_names(merchants: DataFrame, top: int) -> DataFrame:
    """The ``top`` names of each category (names descending, NULL last) and their ranks.

    Names are made distinct first, so ranking sees a name once however many merchants
    bear it, and ``row_number() <= top`` limits each category before the shuffle.
    """
    w = Window.partitionBy("category").orderBy(F.col("merchant_name").desc_nulls_last())
    names = merchants.select("category", "merchant_name").distinct()
    return (names.withColumn("merchant_rank_category", F.row_number().over(w))
                 .filter(F.col("merchant_rank_category") <= top))


def top_merchants_by_category(merchants: DataFrame, top: int = TOP_MERCHANT_RANKS) -> DataFrame:
    """W2 + F8: merchants whose name is among the ``top`` names (dense_rank, name
    descending, NULL names last) of their category.  The ranks are dealt anew before the
    join, so Spark can split a name that very many merchants bear."""
    ranks = _ranked_names(merchants, top).hint("rebalance")
    return join_null_safe(merchants, ranks, ["category", "merchant_name"], "inner")


def merchants_enhanced(merchants: DataFrame, top: int = TOP_MERCHANT_RANKS,
                       with_load_ts: bool = True) -> DataFrame:
    """Per (category, country): merchant count and the names of the top-ranked
    merchants, each once, with how many merchants bear it in ``top_merchant_counts``.

    Rows are counted per name before anything else, so a group's lists have at most
    ``top`` elements.
    """
    per_name = (merchants.groupBy("category", "country", "merchant_name")
                         .agg(F.count("merchant_id").alias("_ids"), F.count(F.lit(1)).alias("_rows")))
    per_name = join_null_safe(per_name, _ranked_names(merchants, top), ["category", "merchant_name"], "inner")
    named = F.col("merchant_name").isNotNull()
    lists = F.sort_array(F.collect_list(F.when(named, F.struct("merchant_name", F.col("_rows").alias("n")))))
    out = (per_name.groupBy("category", "country")
                   .agg(F.sum("_ids").cast("bigint").alias("merchant_count"), lists.alias("_lists"))
                   .select("category", "country", "merchant_count",
                           F.transform("_lists", lambda x: x["merchant_name"]).alias("top_merchants"),
                           F.transform("_lists", lambda x: x["n"]).alias("top_merchant_counts")))
    return out.withColumn("load_ts", F.current_timestamp()) if with_load_ts else out


def running_balance(accounts: DataFrame) -> DataFrame:
    """Running sum of balance per customer by opened_date, RANGE frame (accounts
    opened the same day share one value)."""
    return with_running_total(accounts, ["customer_id"], "opened_date", "balance",
                              "running_balance")


def accounts_enhanced(accounts: DataFrame, with_load_ts: bool = True) -> DataFrame:
    """Per (account_type, status, balance_bucket): average balance, account count
    and the sum of the per-account running balances."""
    out = (running_balance(accounts)
           .withColumn("balance_bucket", rules.balance_bucket("balance"))
           .groupBy("account_type", "status", "balance_bucket")
           .agg(F.avg("balance").alias("avg_balance"),
                F.count("account_id").alias("account_count"),
                F.sum("running_balance").alias("total_running_balance")))
    return out.withColumn("load_ts", F.current_timestamp()) if with_load_ts else out
