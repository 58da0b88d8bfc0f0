"""Column rules.  Each returns a Column built from ``pyspark.sql.functions`` only, so
everything stays inside whole-stage codegen."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# These must equal the reference's for the same results.
DAYS_PER_YEAR = 365.25                     # age = days / 365.25, rounded half up
MIN_CUSTOMER_AGE = 18                      # customers younger than this are rejected
EMAIL_PATTERN = "@"                        # an email must contain this
NAME_DROP_PATTERN = r"[^a-zA-Z\s]"         # removed from the initcapped name
GENDER_OTHER_CODE, GENDER_OTHER_LABEL = "O", "Other"
ACCOUNT_CLOSED_STATUS, ACCOUNT_CLOSED_LABEL = "closed", "inactive"
TXN_OK_STATUS = "success"                  # only these transactions reach silver
TXN_DEBIT_TYPE = "debit"                   # debits are spend
AGE_GROUPS = [(30, "Young"), (60, "Middle")]                     # below bound -> label
AGE_GROUP_ELSE = "Senior"                                         # includes NULL age
BALANCE_BUCKETS = [(0, "Negative"), (10000, "Low"), (50000, "Medium")]
BALANCE_BUCKET_ELSE = "High"
TOP_MERCHANT_RANKS = 5                     # dense ranks of names kept per category
SPEND_PERCENTILE = 0.95
STREAM_WATERMARK = "10 minutes"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_date(as_of) -> Column:
    """The date that plays "today" (current_date in the reference)."""
    if as_of is None:
        return F.current_date()
    return F.lit(_dt.date.fromisoformat(str(as_of)))


def as_of_timestamp(as_of) -> Column:
    """Midnight of ``as_of`` in the session zone (current_timestamp in the reference)."""
    if as_of is None:
        return F.current_timestamp()
    return F.to_timestamp(F.lit(str(as_of)))


def age_years(dob, as_of) -> Column:
    """Age in whole years: days / 365.25 rounded half up (not floored)."""
    return F.round(F.datediff(as_of_date(as_of), _col(dob)) / F.lit(DAYS_PER_YEAR), 0)


def name_clean(name) -> Column:
    """initcap, then keep only ASCII letters and whitespace."""
    return F.regexp_replace(F.initcap(_col(name)), NAME_DROP_PATTERN, "")


def gender_label(gender) -> Column:
    g = _col(gender)
    return F.when(g == GENDER_OTHER_CODE, F.lit(GENDER_OTHER_LABEL)).otherwise(g)


def account_status(status) -> Column:
    s = _col(status)
    return F.when(s == ACCOUNT_CLOSED_STATUS, F.lit(ACCOUNT_CLOSED_LABEL)).otherwise(s)


def _bands(c: Column, bands, otherwise: str) -> Column:
    """First label whose upper bound the value is below; ``otherwise`` for the rest."""
    out = None
    for bound, label in bands:
        out = (F.when(c < bound, label) if out is None else out.when(c < bound, label))
    return out.otherwise(otherwise)


def age_group(age) -> Column:
    """<30 Young, <60 Middle, everything else (NULL included) Senior."""
    return _bands(_col(age), AGE_GROUPS, AGE_GROUP_ELSE)


def balance_bucket(balance) -> Column:
    b = _col(balance)
    return _bands(b, BALANCE_BUCKETS, BALANCE_BUCKET_ELSE)


def spend_amount(is_debit, amount) -> Column:
    """Debits count as spend; anything else (including NULL type) is 0."""
    return F.when(_col(is_debit) == F.lit(True), _col(amount)).otherwise(F.lit(0))


def income_amount(is_debit, amount) -> Column:
    """Non-debits (credit, transfer, payment) count as income; NULL type is 0."""
    return F.when(_col(is_debit) == F.lit(False), _col(amount)).otherwise(F.lit(0))


def month_start(date_col) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(_col(date_col), "month")


def spend_growth(cur, prev) -> Column:
    """(cur - prev) / prev; 0 when there is no previous value or it is 0."""
    c, p = _col(cur), _col(prev)
    return F.when(p.isNotNull() & (p != 0), (c - p) / p).otherwise(F.lit(0))
