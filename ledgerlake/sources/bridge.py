"""Raw banking tables derived from the TPC-H-like test tables.

The same SQL text serves both engines: Spark runs it with the source tables bound as
DataFrame parameters (``spark.sql(text, customer=df)``), the DuckDB oracle runs it as
CTEs over views of the same parquet files.  Only the columns a query needs are read:
Catalyst prunes the parquet scans through these projections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.session import table_path, use_utc

# The date that stands in for "today" wherever a rule compares with the
# current date or time, so results do not depend on the wall clock.
AS_OF = "2001-06-30"

RAW_SQL = {
    "customers": """
SELECT concat('CUST', c_custkey) AS customer_id,
       concat(c_mktsegment, ' mc-', c_name) AS name,
       date '1920-01-01' + cast((c_custkey * 7919) % 26000 AS int) AS dob,
       CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'O' END AS gender,
       concat('ADDR ', c_nationkey) AS address,
       concat('+', c_nationkey, '-', c_custkey) AS phone,
       CASE WHEN c_custkey % 23 = 0 THEN concat('bad', c_custkey)
            ELSE concat('c', c_custkey, '@example.com') END AS email,
       timestamp '1995-01-01 00:00:00' + c_custkey * interval '1' hour AS created_at
FROM {customer}""",
    "merchants": """
SELECT concat('M', p_partkey) AS merchant_id,
       CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE p_name END AS merchant_name,
       lower(p_type) AS category,
       lower(p_brand) AS city,
       concat('country_', p_size % 5) AS country
FROM {part}""",
    "accounts": """
SELECT concat('ACCT', o_orderkey) AS account_id,
       concat('CUST', o_custkey) AS customer_id,
       CASE WHEN o_orderkey % 20 < 10 THEN 'savings'
            WHEN o_orderkey % 20 < 17 THEN 'checking'
            WHEN o_orderkey % 20 < 19 THEN 'credit_card' ELSE 'loan' END AS account_type,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL
            WHEN o_orderkey % 20 = 19 THEN cast(-o_totalprice AS decimal(12,2))
            WHEN o_orderkey % 20 >= 17 THEN cast(o_totalprice - 250000 AS decimal(12,2))
            ELSE cast(o_totalprice AS decimal(12,2)) END AS balance,
       cast(o_orderdate AS date) AS opened_date,
       CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'P' THEN 'inactive' ELSE 'closed' END AS status
FROM {orders}""",
    "transactions": """
SELECT concat('TXN', l_orderkey, '-', l_linenumber) AS txn_id,
       concat('ACCT', l_orderkey) AS account_id,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('M', l_partkey) END AS merchant_id,
       l_shipdate AS timestamp,
       CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount,
       CASE l_suppkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'INR'
                          WHEN 3 THEN 'GBP' ELSE 'JPY' END AS currency,
       CASE WHEN l_returnflag IN ('N', 'R') THEN 'debit'
            WHEN l_linestatus = 'O' THEN 'credit'
            WHEN l_linenumber % 2 = 0 THEN 'transfer' ELSE 'payment' END AS txn_type,
       CASE l_suppkey % 20 WHEN 0 THEN 'failed' WHEN 1 THEN 'pending' ELSE 'success' END AS status,
       CASE l_suppkey % 4 WHEN 0 THEN 'online' WHEN 1 THEN 'pos' WHEN 2 THEN 'atm' ELSE 'mobile' END AS channel,
       concat('city_', l_suppkey) AS city,
       concat('country_', l_suppkey % 25) AS country,
       concat('line ', l_linenumber) AS description
FROM {lineitem}""",
}

SOURCE_TABLE = {"customers": "customer", "merchants": "part",
                "accounts": "orders", "transactions": "lineitem"}


def raw_sql_for_duckdb(name: str) -> str:
    """The mapping SQL with plain table names, for the DuckDB oracle."""
    src = SOURCE_TABLE[name]
    return RAW_SQL[name].replace("{" + src + "}", src)


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw banking table (customers, merchants, accounts, transactions)."""
    use_utc(spark)
    src = SOURCE_TABLE[name]
    df = spark.sql(RAW_SQL[name], **{src: spark.read.parquet(table_path(sf_dir, src))})
    if name == "transactions":
        # Test parquet stores wall-clock timestamps (TIMESTAMP_NTZ); event time must be
        # a TIMESTAMP for watermarks, read in the UTC session zone.
        from pyspark.sql import functions as F
        df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return df

