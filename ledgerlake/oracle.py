"""DuckDB oracle SQL for every registered query.

The raw tables come from the same mapping text as the Spark side
(``ledgerlake.sources.bridge``).  Parity rules: decimals are cast to DOUBLE, averages
and correlations rounded (6 digits), months are DATEs, arrays sorted.
"""

from __future__ import annotations

from ledgerlake.sources.bridge import AS_OF, RAW_SQL, raw_sql_for_duckdb

AS_OF_DATE = f"DATE '{AS_OF}'"
AS_OF_TS = f"TIMESTAMP '{AS_OF} 00:00:00'"


def initcap(x: str) -> str:
    """Spark's initcap: lower-case, then upper-case the first letter after each blank."""
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def desc_all(cols) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


RAW_CTES = ",\n".join(f"raw_{n} AS ({raw_sql_for_duckdb(n)})" for n in RAW_SQL)

SILVER_CTES = f"""
typed_customers AS (
  SELECT customer_id,
         regexp_replace({initcap('name')}, '[^a-zA-Z\\s]', '', 'g') AS name_clean,
         CAST(dob AS DATE) AS dob,
         CASE WHEN gender = 'O' THEN 'Other' ELSE gender END AS gender,
         address, phone, email, CAST(created_at AS TIMESTAMP) AS created_at,
         round(date_diff('day', dob, {AS_OF_DATE}) / 365.25::DOUBLE, 0) AS age
  FROM raw_customers),
silver_customers AS (
  SELECT customer_id, name_clean, dob, gender, address, phone, email, created_at, age
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY
          {desc_all(['created_at', 'name_clean', 'dob', 'gender', 'address', 'phone', 'email', 'age'])}) AS rn
        FROM typed_customers WHERE age >= 18 AND regexp_matches(email, '@'))
  WHERE rn = 1),
typed_merchants AS (
  SELECT merchant_id, merchant_name, {initcap('category')} AS category,
         {initcap('city')} AS city, upper(country) AS country
  FROM raw_merchants WHERE merchant_name IS NOT NULL),
silver_merchants AS (
  SELECT merchant_id, merchant_name, category, city, country
  FROM (SELECT *, row_number() OVER (PARTITION BY merchant_id ORDER BY
          {desc_all(['merchant_name', 'category', 'city', 'country'])}) AS rn
        FROM typed_merchants)
  WHERE rn = 1),
typed_accounts AS (
  SELECT account_id, customer_id, account_type,
         TRY_CAST(balance AS DECIMAL(12,2)) AS balance,
         CAST(opened_date AS DATE) AS opened_date,
         CASE WHEN status = 'closed' THEN 'inactive' ELSE status END AS status
  FROM raw_accounts),
silver_accounts AS (
  SELECT account_id, customer_id, account_type, balance, opened_date, status
  FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY
          {desc_all(['opened_date', 'customer_id', 'account_type', 'balance', 'status'])}) AS rn
        FROM typed_accounts WHERE opened_date < {AS_OF_DATE} AND balance IS NOT NULL)
  WHERE rn = 1),
typed_transactions AS (
  SELECT txn_id, account_id, merchant_id, CAST(timestamp AS TIMESTAMP) AS timestamp,
         TRY_CAST(abs(amount) AS DECIMAL(10,2)) AS amount, currency, txn_type, status,
         channel, city, country, description,
         CAST(timestamp AS DATE) AS txn_date,
         CAST(year(timestamp) AS INTEGER) AS txn_year,
         CAST(month(timestamp) AS INTEGER) AS txn_month,
         txn_type = 'debit' AS is_debit
  FROM raw_transactions),
silver_transactions AS (
  SELECT txn_id, account_id, merchant_id, timestamp, amount, currency, txn_type, status,
         channel, city, country, description, txn_date, txn_year, txn_month, is_debit
  FROM (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY
          {desc_all(['timestamp', 'amount', 'merchant_id', 'account_id', 'currency', 'txn_type',
                     'status', 'channel', 'city', 'country', 'description', 'txn_date',
                     'txn_year', 'txn_month', 'is_debit'])}) AS rn
        FROM typed_transactions WHERE status = 'success' AND timestamp < {AS_OF_TS})
  WHERE rn = 1)"""


ORACLE: dict[str, str] = {}


def register(name: str, select_sql: str, ctes: str = "") -> None:
    extra = f",\n{ctes}" if ctes else ""
    ORACLE[name] = f"WITH {RAW_CTES},\n{SILVER_CTES}{extra}\n{select_sql}"


register("silver_customers", """
SELECT customer_id, name_clean, dob, gender, address, phone, email, created_at,
       CAST(age AS BIGINT) AS age
FROM silver_customers""")

register("silver_merchants", "SELECT * FROM silver_merchants")

register("silver_accounts", """
SELECT account_id, customer_id, account_type, CAST(balance AS DOUBLE) AS balance,
       opened_date, status
FROM silver_accounts""")

register("silver_transactions", """
SELECT txn_id, account_id, merchant_id, timestamp, CAST(amount AS DOUBLE) AS amount,
       currency, txn_type, status, channel, city, country, description, txn_date,
       txn_year, txn_month, is_debit
FROM silver_transactions""")


# --------------------------------------------------------------------------- gold
AGE_GROUP = "CASE WHEN age < 30 THEN 'Young' WHEN age < 60 THEN 'Middle' ELSE 'Senior' END"
BUCKET = ("CASE WHEN balance < 0 THEN 'Negative' WHEN balance < 10000 THEN 'Low' "
          "WHEN balance < 50000 THEN 'Medium' ELSE 'High' END")

GOLD_CTES = f"""
joined AS (
  SELECT t.txn_id, t.account_id, t.merchant_id, t.amount, t.txn_date, t.is_debit,
         a.customer_id, a.balance, c.age_group, m.category,
         CAST(date_trunc('month', t.txn_date) AS DATE) AS transaction_month,
         CASE WHEN t.is_debit = true THEN t.amount ELSE 0 END AS spend_amount,
         CASE WHEN t.is_debit = false THEN t.amount ELSE 0 END AS income_amount
  FROM silver_transactions t
  LEFT JOIN silver_accounts a ON t.account_id = a.account_id
  LEFT JOIN (SELECT customer_id, {AGE_GROUP} AS age_group FROM silver_customers) c
         ON a.customer_id = c.customer_id
  LEFT JOIN silver_merchants m ON t.merchant_id = m.merchant_id),
enriched AS (
  SELECT *,
         sum(spend_amount) OVER (PARTITION BY customer_id ORDER BY txn_date
             RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_spend,
         lag(spend_amount) OVER (PARTITION BY customer_id
             ORDER BY txn_date NULLS FIRST, txn_id NULLS FIRST) AS prev_txn_spend
  FROM joined),
monthly AS (
  SELECT transaction_month, age_group, category,
         sum(spend_amount) AS total_spend,
         count(txn_id) AS transaction_count,
         round(avg(amount), 6) AS avg_transaction_value,
         count(DISTINCT customer_id) AS unique_customers,
         CAST(quantile_disc(amount, 0.95) AS DOUBLE) AS p95_amount,
         round(covar_pop(xm, ym) / nullif(stddev_pop(xm) * stddev_pop(ym), 0), 6)
             AS amount_balance_corr,
         CAST(max(running_spend) AS DOUBLE) AS max_running_spend
  FROM (SELECT *,
               CASE WHEN amount IS NOT NULL AND balance IS NOT NULL THEN CAST(amount AS DOUBLE) END AS xm,
               CASE WHEN amount IS NOT NULL AND balance IS NOT NULL THEN CAST(balance AS DOUBLE) END AS ym
        FROM enriched)
  GROUP BY transaction_month, age_group, category)"""


def register_gold(name: str, select_sql: str) -> None:
    register(name, select_sql, GOLD_CTES)


register("age_rank_by_gender", """
SELECT customer_id, gender, CAST(age AS BIGINT) AS age,
       row_number() OVER (PARTITION BY gender ORDER BY age DESC NULLS LAST, customer_id)
           AS age_rank_gender
FROM silver_customers""")

register("dim_customers", f"""
SELECT age_group, gender, count(customer_id) AS customer_count, avg(age) AS avg_age,
       CAST(max(age) AS BIGINT) AS max_age
FROM (SELECT *, {AGE_GROUP} AS age_group FROM silver_customers)
GROUP BY age_group, gender""")

TOP_MERCHANTS = """
SELECT merchant_id, merchant_name, category, city, country, merchant_rank_category
FROM (SELECT *, CAST(dense_rank() OVER (PARTITION BY category
                     ORDER BY merchant_name DESC NULLS LAST) AS BIGINT) AS merchant_rank_category
      FROM silver_merchants)
WHERE merchant_rank_category <= 5"""

register("top_merchants_by_category", TOP_MERCHANTS)

register("dim_merchants", f"""
SELECT category, country, CAST(sum(ids) AS BIGINT) AS merchant_count,
       list(merchant_name ORDER BY merchant_name) FILTER (WHERE merchant_name IS NOT NULL) AS top_merchants,
       list(n ORDER BY merchant_name) FILTER (WHERE merchant_name IS NOT NULL) AS top_merchant_counts
FROM (SELECT category, country, merchant_name, count(merchant_id) AS ids, count(*) AS n
      FROM ({TOP_MERCHANTS}) GROUP BY category, country, merchant_name)
GROUP BY category, country""")

RUNNING_BALANCE = """
SELECT account_id, customer_id, opened_date, account_type, status, balance,
       sum(balance) OVER (PARTITION BY customer_id ORDER BY opened_date
           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_balance
FROM silver_accounts"""

register("running_balance", f"""
SELECT account_id, customer_id, opened_date, CAST(balance AS DOUBLE) AS balance,
       CAST(running_balance AS DOUBLE) AS running_balance
FROM ({RUNNING_BALANCE})""")

register("dim_accounts", f"""
SELECT account_type, status, {BUCKET} AS balance_bucket,
       round(avg(balance), 6) AS avg_balance, count(account_id) AS account_count,
       CAST(sum(running_balance) AS DOUBLE) AS total_running_balance
FROM ({RUNNING_BALANCE})
GROUP BY ALL""")

register_gold("fact_enriched", """
SELECT txn_id, customer_id, merchant_id, txn_date, transaction_month, age_group, category,
       CAST(amount AS DOUBLE) AS amount, CAST(balance AS DOUBLE) AS balance,
       CAST(spend_amount AS DOUBLE) AS spend_amount,
       CAST(income_amount AS DOUBLE) AS income_amount,
       CAST(running_spend AS DOUBLE) AS running_spend,
       CAST(prev_txn_spend AS DOUBLE) AS prev_txn_spend,
       round(CASE WHEN prev_txn_spend IS NOT NULL AND prev_txn_spend <> 0
                  THEN (spend_amount - prev_txn_spend) / prev_txn_spend ELSE 0 END, 6)
           AS spend_growth,
       row_number() OVER (ORDER BY amount DESC NULLS LAST, txn_id ASC NULLS FIRST) AS amount_rank
FROM enriched""")

register_gold("running_spend_carried", """
SELECT txn_id, customer_id, txn_date, CAST(spend_amount AS DOUBLE) AS spend_amount, CAST(running_spend AS DOUBLE) AS running_spend,
       CAST(prev_txn_spend AS DOUBLE) AS prev_txn_spend FROM enriched""")

register_gold("amount_rank", """
SELECT txn_id, CAST(amount AS DOUBLE) AS amount,
       row_number() OVER (ORDER BY amount DESC NULLS LAST, txn_id ASC NULLS FIRST) AS amount_rank
FROM silver_transactions""")

register_gold("fact_monthly", """
SELECT transaction_month, age_group, category, CAST(total_spend AS DOUBLE) AS total_spend,
       transaction_count, avg_transaction_value, unique_customers, p95_amount,
       amount_balance_corr, max_running_spend
FROM monthly""")

CUSTOMER_SPEND = """
SELECT customer_id, CAST(sum(spend_amount) AS DOUBLE) AS total_spend,
       CAST(sum(amount) AS DOUBLE) AS total_amount, count(txn_id) AS transaction_count
FROM joined GROUP BY customer_id"""

register_gold("customer_spend", CUSTOMER_SPEND)

register_gold("account_join_bucketed", """
SELECT txn_id, account_id, customer_id, age_group, CAST(balance AS DOUBLE) AS balance, CAST(amount AS DOUBLE) AS amount, transaction_month
FROM joined""")

register_gold("customer_spend_top10", f"""
SELECT * FROM ({CUSTOMER_SPEND})
ORDER BY total_spend DESC NULLS LAST, customer_id ASC NULLS FIRST LIMIT 10""")

register_gold("spend_by_category", """
SELECT category, CAST(sum(total_spend) AS DOUBLE) AS spend FROM monthly GROUP BY category""")

register_gold("monthly_spend", """
SELECT transaction_month, CAST(sum(total_spend) AS DOUBLE) AS total_spend
FROM monthly GROUP BY transaction_month""")


# ------------------------------------------------------------ sources and loads
TXN_ORDER = ['timestamp', 'amount', 'merchant_id', 'account_id', 'currency', 'txn_type', 'status',
             'channel', 'city', 'country', 'description', 'txn_date', 'txn_year', 'txn_month',
             'is_debit']
SILVER_TXN_OUT = """txn_id, account_id, merchant_id, timestamp, CAST(amount AS DOUBLE) AS amount,
       currency, txn_type, status, channel, city, country, description, txn_date,
       txn_year, txn_month, is_debit"""
FIRST_BEFORE = "TIMESTAMP '1998-01-01 00:00:00'"
SECOND_FROM = "TIMESTAMP '1997-01-01 00:00:00'"


def silver_txn_where(extra: str) -> str:
    """Silver transactions (typed, valid, latest per key) over a slice of raw rows."""
    return f"""
  SELECT * EXCLUDE (rn)
  FROM (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY {desc_all(TXN_ORDER)}) AS rn
        FROM typed_transactions
        WHERE status = 'success' AND timestamp < {AS_OF_TS} AND {extra})
  WHERE rn = 1"""


register("raw_csv_transactions", """
SELECT txn_id, account_id, merchant_id, CAST(timestamp AS TIMESTAMP) AS timestamp, amount,
       currency, txn_type, status, channel, city, country, description
FROM raw_transactions""")

register("incremental_upsert_transactions", f"SELECT {SILVER_TXN_OUT} FROM silver_transactions")

register("incremental_upsert_indexed", f"SELECT {SILVER_TXN_OUT} FROM silver_transactions")

register("incremental_upsert_declared", f"SELECT {SILVER_TXN_OUT} FROM silver_transactions")

register("stored_partition_metrics", """
SELECT txn_year, txn_month, count(*) AS silver_rows, min(txn_date) AS first_day, max(txn_date) AS last_day
FROM silver_transactions GROUP BY txn_year, txn_month""")

register("incremental_drop_transactions", f"""
SELECT {SILVER_TXN_OUT} FROM (
  SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY {desc_all(TXN_ORDER)}) AS latest
  FROM (SELECT * FROM load1 UNION ALL SELECT * FROM load2))
WHERE latest = 1""", f"""
load1 AS ({silver_txn_where(f"(timestamp < {FIRST_BEFORE} OR timestamp IS NULL)")}),
load2 AS ({silver_txn_where(f"timestamp >= {SECOND_FROM} AND timestamp > (SELECT max(timestamp) FROM load1)")})""")

RAW_TXN_COLS = ["account_id", "merchant_id", "amount", "currency", "txn_type", "status",
                "channel", "city", "country", "description"]
register("append_dedup_transactions", """
SELECT * FROM existing
UNION ALL
SELECT * FROM fresh""", f"""
existing AS (SELECT * REPLACE (CAST(timestamp AS TIMESTAMP) AS timestamp) FROM raw_transactions
             WHERE timestamp < {FIRST_BEFORE} OR timestamp IS NULL),
incoming AS (SELECT * REPLACE (CAST(timestamp AS TIMESTAMP) AS timestamp) FROM raw_transactions
             WHERE timestamp >= {SECOND_FROM}),
fresh AS (
  SELECT * EXCLUDE (rn)
  FROM (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY
               {", ".join(f"{c} ASC NULLS FIRST" for c in ["timestamp"] + RAW_TXN_COLS)}) AS rn
        FROM incoming) i
  WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM existing e WHERE e.txn_id = i.txn_id))""")

register("fk_orphans", """
SELECT 'accounts' AS child_table, account_id AS child_key, customer_id AS parent_key
FROM silver_accounts a
WHERE NOT EXISTS (SELECT 1 FROM silver_customers c WHERE c.customer_id = a.customer_id)
UNION ALL
SELECT 'transactions', txn_id, account_id
FROM silver_transactions t
WHERE NOT EXISTS (SELECT 1 FROM silver_accounts a WHERE a.account_id = t.account_id)""")

register("high_water_marks", """
SELECT 'customers' AS table_name, CAST(max(created_at) AS TIMESTAMP) AS high_water_mark FROM silver_customers
UNION ALL
SELECT 'accounts', CAST(max(opened_date) AS TIMESTAMP) FROM silver_accounts
UNION ALL
SELECT 'transactions', max(timestamp) FROM silver_transactions""")

# First rule that a raw row fails, per table (NULL: valid).
REASONS = {
    "customers": "CASE WHEN coalesce(age >= 18, false) = false THEN 'under_age' "
                 "WHEN coalesce(regexp_matches(email, '@'), false) = false THEN 'bad_email' END",
    "merchants": "CASE WHEN merchant_name IS NULL THEN 'no_name' END",
    "accounts": f"CASE WHEN coalesce(opened_date < {AS_OF_DATE}, false) = false THEN 'not_opened_yet' "
                "WHEN balance IS NULL THEN 'no_balance' END",
    "transactions": "CASE WHEN coalesce(status = 'success', false) = false THEN 'not_successful' "
                    f"WHEN coalesce(timestamp < {AS_OF_TS}, false) = false THEN 'in_the_future' END",
}


def graded(table: str) -> str:
    source = "raw_merchants" if table == "merchants" else f"typed_{table}"
    return f"(SELECT {REASONS[table]} AS reason FROM {source})"


register("load_metrics", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS raw_rows, count(*) FILTER (WHERE reason IS NULL) AS valid_rows, "
    f"count(*) FILTER (WHERE reason IS NOT NULL) AS rejected_rows, (SELECT count(*) FROM silver_{t}) AS silver_rows "
    f"FROM {graded(t)}" for t in REASONS))

register("load_rejects", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, reason AS reject_reason, count(*) AS rows FROM {graded(t)} "
    "WHERE reason IS NOT NULL GROUP BY reason" for t in REASONS))

register_gold("dashboard_filtered", """
SELECT category, CAST(sum(total_spend) AS DOUBLE) AS spend
FROM monthly
WHERE contains(category, 'Econ')
  AND transaction_month >= DATE '1996-01-01' AND transaction_month <= DATE '1999-12-01'
GROUP BY category""")

register_gold("dashboard_drilldown", """
SELECT transaction_month, CAST(sum(total_spend) AS DOUBLE) AS total_spend
FROM monthly
GROUP BY transaction_month
HAVING CAST(transaction_month AS VARCHAR) = '1997-03-01'""")

register("stream_silver_transactions", f"SELECT {SILVER_TXN_OUT} FROM silver_transactions")

register("job_silver_transactions", f"SELECT {SILVER_TXN_OUT} FROM silver_transactions")

register("job_bronze_transactions", f"""
SELECT * REPLACE (CAST(timestamp AS TIMESTAMP) AS timestamp), 0::BIGINT AS load_id FROM raw_transactions
WHERE timestamp < {FIRST_BEFORE} OR timestamp IS NULL
UNION ALL
SELECT * REPLACE (CAST(timestamp AS TIMESTAMP) AS timestamp), 1::BIGINT FROM raw_transactions WHERE timestamp >= {SECOND_FROM}""")

ORACLE["quarantine_replay"] = ORACLE["job_silver_transactions"]

# Two deliveries under the drop policy, judged on a date within them.
_LOADS = f"""
delivered AS (SELECT *, 0 AS load_id FROM raw_transactions WHERE timestamp < {FIRST_BEFORE} OR timestamp IS NULL
  UNION ALL SELECT *, 1 FROM raw_transactions WHERE timestamp >= {SECOND_FROM}),
judged AS (SELECT * REPLACE (CAST(timestamp AS TIMESTAMP) AS timestamp, CAST(load_id AS BIGINT) AS load_id),
    CASE WHEN load_id = 1 AND NOT coalesce(timestamp > (SELECT max(timestamp) FROM delivered WHERE load_id = 0), false) THEN 'late'
         WHEN coalesce(status = 'success', false) = false THEN 'not_successful'
         WHEN coalesce(timestamp < TIMESTAMP '1999-06-30 00:00:00', false) = false THEN 'in_the_future' END AS reject_reason FROM delivered)"""
register("quarantine_balance", """
SELECT 'transactions' AS table_name, load_id, count(*) AS delivered_rows, count(*) FILTER (WHERE reject_reason = 'late') AS late_rows,
       count(*) FILTER (WHERE reject_reason <> 'late') AS rejected_rows, count(*) FILTER (WHERE reject_reason IS NULL) AS valid_rows
FROM judged GROUP BY load_id""", _LOADS)
register("quarantine_rows", """
SELECT txn_id, account_id, merchant_id, timestamp, CAST(amount AS DOUBLE) AS amount, status, reject_reason,
       CASE reject_reason WHEN 'late' THEN 'bronze' ELSE 'silver' END AS stage, load_id
FROM judged WHERE reject_reason IS NOT NULL""", _LOADS)
register("stream_rejects", f"""
SELECT txn_id, CAST(timestamp AS TIMESTAMP) AS timestamp, CAST(amount AS DOUBLE) AS amount, status, reason AS reject_reason, 'stream' AS stage
FROM (SELECT *, {REASONS["transactions"]} AS reason FROM raw_transactions) WHERE reason IS NOT NULL""")

ORACLE["gold_catalog_tables"] = ORACLE["fact_monthly"]
ORACLE["incremental_gold"] = ORACLE["fact_monthly"]

_FEWER_KEYS = "CASE WHEN NOT coalesce(txn_id LIKE '%7-_', false) THEN txn_id END"
register("upsert_null_keys", f"""
SELECT txn_id, account_id, timestamp, CAST(amount AS DOUBLE) AS amount, 'upsert' AS how
FROM (SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY {desc_all(TXN_ORDER)}) AS rn
      FROM (SELECT * REPLACE ({_FEWER_KEYS} AS txn_id) FROM typed_transactions)
      WHERE status = 'success' AND timestamp < {AS_OF_TS})
WHERE rn = 1
UNION ALL
SELECT txn_id, account_id, timestamp, CAST(amount AS DOUBLE), 'append' FROM (
  SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY delivery, {", ".join(f"{c} ASC NULLS FIRST" for c in ["timestamp"] + RAW_TXN_COLS)}) AS rn
  FROM (SELECT * REPLACE ({_FEWER_KEYS} AS txn_id, CAST(timestamp AS TIMESTAMP) AS timestamp),
               CASE WHEN timestamp < {FIRST_BEFORE} OR timestamp IS NULL THEN 1 ELSE 2 END AS delivery FROM raw_transactions))
WHERE rn = 1""")

register_gold("fact_report", """
SELECT transaction_month, age_group, category, CAST(total_spend AS DOUBLE) AS total_spend, transaction_count
FROM monthly ORDER BY transaction_month DESC NULLS LAST, age_group NULLS FIRST, category NULLS FIRST""")

register_gold("dashboard_customers", f"""
SELECT customer_id, total_spend FROM ({CUSTOMER_SPEND})
ORDER BY total_spend DESC NULLS LAST, customer_id ASC NULLS FIRST LIMIT 10""")

register("bronze_drop_transactions", """
SELECT * FROM d1
UNION ALL
SELECT * FROM d2 WHERE timestamp > (SELECT max(timestamp) FROM d1)""", f"""
d1 AS (SELECT * REPLACE (CAST(timestamp AS TIMESTAMP) AS timestamp) FROM raw_transactions
       WHERE timestamp < {FIRST_BEFORE} OR timestamp IS NULL),
d2 AS (SELECT * REPLACE (CAST(timestamp AS TIMESTAMP) AS timestamp) FROM raw_transactions
       WHERE timestamp >= {SECOND_FROM})""")

register("reload_merchants", "SELECT * FROM silver_merchants")
