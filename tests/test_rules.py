"""Column rules on the hand-made edge rows of FIXTURES.md §4."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.functions import rules
from ledgerlake.functions.stats import safe_corr
from ledgerlake.plans import silver

AS_OF = "2001-06-30"


def test_age_is_rounded_not_floored(spark):
    dob = dt.date(2001, 6, 30) - dt.timedelta(days=int(17.6 * 365.25))
    df = spark.createDataFrame([(dob,)], "dob date")
    assert df.select(rules.age_years("dob", AS_OF).alias("a")).first().a == 18.0


def test_name_clean_keeps_trailing_blank(spark):
    df = spark.createDataFrame([("mr. o'neil-SMITH jr 3",)], "name string")
    assert df.select(rules.name_clean("name").alias("n")).first().n == "Mr Oneilsmith Jr "


def test_gender_and_status_labels(spark):
    df = spark.createDataFrame([("O", "closed"), ("M", "active"), (None, None)], "g string, s string")
    got = df.select(rules.gender_label("g").alias("g"), rules.account_status("s").alias("s")).collect()
    assert [tuple(r) for r in got] == [("Other", "inactive"), ("M", "active"), (None, None)]


def test_age_group_and_balance_bucket_edges(spark):
    df = spark.createDataFrame([(30.0, Decimal("0")), (60.0, Decimal("10000")), (None, Decimal("50000")),
                                (29.0, Decimal("-1"))], "age double, balance decimal(12,2)")
    got = df.select(rules.age_group("age"), rules.balance_bucket("balance")).collect()
    assert [tuple(r) for r in got] == [("Middle", "Low"), ("Senior", "Medium"), ("Senior", "High"),
                                       ("Young", "Negative")]


def test_spend_and_income_split(spark):
    df = spark.createDataFrame([(True, Decimal("5.00")), (False, Decimal("7.00")), (None, Decimal("9.00"))],
                               "d boolean, a decimal(10,2)")
    got = df.select(rules.spend_amount("d", "a").alias("s"), rules.income_amount("d", "a").alias("i")).collect()
    assert [(float(r.s), float(r.i)) for r in got] == [(5.0, 0.0), (0.0, 7.0), (0.0, 0.0)]


def test_spend_growth_zero_without_previous(spark):
    df = spark.createDataFrame([(10.0, None), (10.0, 0.0), (15.0, 10.0)], "c double, p double")
    got = [r.g for r in df.select(rules.spend_growth("c", "p").alias("g")).collect()]
    assert got == [0.0, 0.0, 0.5]


def test_safe_corr_constant_column_is_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert df.agg(safe_corr("x", "y").alias("c")).first().c is None
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, None), (4.0, 8.0)], "x double, y double")
    expect = df2.filter("y is not null").agg(F.corr("x", "y")).first()[0]
    assert abs(df2.agg(safe_corr("x", "y")).first()[0] - expect) < 1e-12


def test_transactions_amount_abs_half_up_and_filters(spark):
    rows = [("T1", "A", None, dt.datetime(2000, 1, 1), -12.345, "USD", None, "success", "pos", "c", "k", "d"),
            ("T2", "A", "M", dt.datetime(2001, 6, 30), 1.0, "USD", "debit", "success", "pos", "c", "k", "d"),
            ("T3", "A", "M", dt.datetime(2000, 1, 1), 1.0, "USD", "debit", "failed", "pos", "c", "k", "d")]
    from ledgerlake.schemas import RAW_SCHEMAS
    df = spark.createDataFrame(rows, RAW_SCHEMAS["transactions"])
    out = silver.to_silver("transactions", df, AS_OF).collect()
    assert [r.txn_id for r in out] == ["T1"]          # as-of is strict, failed dropped
    assert out[0].amount == Decimal("12.35") and out[0].is_debit is None


def test_dedup_latest_version_wins(spark):
    from ledgerlake.schemas import RAW_SCHEMAS
    base = ("T1", "A", "M", None, 5.0, "USD", "debit", "success", "pos", "c", "k", "d")
    rows = [base[:3] + (dt.datetime(1999, 1, 1),) + base[4:],
            base[:3] + (dt.datetime(2000, 1, 1),) + (6.0,) + base[5:]]
    df = spark.createDataFrame(rows, RAW_SCHEMAS["transactions"])
    out = silver.to_silver("transactions", df, AS_OF).collect()
    assert len(out) == 1 and out[0].amount == Decimal("6.00")


def test_accounts_opened_on_as_of_dropped(spark):
    from ledgerlake.schemas import RAW_SCHEMAS
    rows = [("A1", "C", "savings", Decimal("1"), dt.date(2001, 6, 30), "closed"),
            ("A2", "C", "savings", Decimal("1"), dt.date(2001, 6, 29), "closed"),
            ("A3", "C", "savings", None, dt.date(2001, 6, 1), "active")]
    out = silver.to_silver("accounts", spark.createDataFrame(rows, RAW_SCHEMAS["accounts"]), AS_OF).collect()
    assert [(r.account_id, r.status) for r in out] == [("A2", "inactive")]


def test_customers_with_null_dob_or_email_are_dropped(spark):
    from ledgerlake.schemas import RAW_SCHEMAS
    ts = dt.datetime(2000, 1, 1)
    rows = [("C1", "a b", None, "M", "x", "1", "a@b", ts),
            ("C2", "a b", dt.date(1970, 1, 1), "F", "x", "1", None, ts),
            ("C3", "a b", dt.date(1970, 1, 1), "O", "x", "1", "c@d", ts)]
    out = silver.to_silver("customers", spark.createDataFrame(rows, RAW_SCHEMAS["customers"]), AS_OF)
    assert [(r.customer_id, r.gender, r.age) for r in out.collect()] == [("C3", "Other", 31.0)]


def test_null_merchant_keeps_its_own_category_group(spark):
    from ledgerlake.plans import facts
    t = spark.createDataFrame(
        [("T1", "A1", None, Decimal("5.00"), dt.date(2000, 1, 3), True),
         ("T2", "A1", "M1", Decimal("7.00"), dt.date(2000, 1, 4), True)],
        "txn_id string, account_id string, merchant_id string, amount decimal(10,2), "
        "txn_date date, is_debit boolean")
    a = spark.createDataFrame([("A1", "C1", Decimal("100.00"))],
                              "account_id string, customer_id string, balance decimal(12,2)")
    c = spark.createDataFrame([("C1", 40.0)], "customer_id string, age double")
    m = spark.createDataFrame([("M1", "Food")], "merchant_id string, category string")
    fact = facts.transactions_enhanced(facts.joined_transactions(t, a, c, m), with_load_ts=False)
    got = {r.category: (float(r.total_spend), float(r.max_running_spend)) for r in fact.collect()}
    assert got == {None: (5.0, 5.0), "Food": (7.0, 12.0)}


def test_unreadable_text_is_rejected_and_named(spark):
    """Text that is no date, number or time never fails a load; the row is counted."""
    customers = spark.createDataFrame([("C1", "a", "notadate", "M", "x", "1", "a@b", "2000-01-01"), ("C2", "a", "1970-01-01", "M", "x", "1", "ab", "never"),
                                       ("C3", "a", "1970-01-01", "M", "x", "1", "a@b", "2000-01-01")],
                                      "customer_id string, name string, dob string, gender string, address string, phone string, email string, created_at string")
    got = {r.customer_id: r.reject_reason for r in silver.graded("customers", customers, AS_OF).collect()}
    assert got == {"C1": "under_age", "C2": "bad_email", "C3": None}
    accounts = spark.createDataFrame([("A1", "C", "s", "many", "2000-01-01", "x"), ("A2", "C", "s", "1.5", "soon", "x")], "account_id string, customer_id string, account_type string, balance string, opened_date string, status string")
    assert {r.account_id: r.reject_reason for r in silver.graded("accounts", accounts, AS_OF).collect()} == {"A1": "no_balance", "A2": "not_opened_yet"}
    raw = spark.createDataFrame([("T1", "A", "M", "late", "x", "USD", "debit", "success", "pos", "c", "k", "d")],
                                "txn_id string, account_id string, merchant_id string, timestamp string, amount string, currency string, txn_type string, status string, channel string, city string, country string, description string")
    assert silver.graded("transactions", raw, AS_OF).first().reject_reason == "in_the_future"
    assert silver.to_silver("transactions", raw, AS_OF).count() == 0
