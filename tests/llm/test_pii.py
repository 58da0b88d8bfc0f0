import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import pii
from tests.conftest import SMALL_SF
from tests.llm.cases import docs, empty  # noqa: F401


def luhn(s):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(s))) % 10 == 0


def run(spark, *texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    return [r["text"] for r in pii.pseudonymise(df, "key").orderBy("doc_id").collect()]


PRIVATE = ["4111111111111111", "4111-1111-1111-1111", "4111 1111 1111 1111", "3782 822463 10005", "378282246310005", "+1 (524) 555-7373", "(524) 555-7373", "+49 170 1234567", "524-555-7373", "123-45-6789",
           "169.122.221.182", "1980-02-28", "28/02/1980", "12/31/1999", "31.12.1999", "2004/02/29", "the.72@mail3.example.com", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B", "27660c51feb63980dfaee7464f96210544c03fc3"]
CLEAN = ["4111111111111112", "1980-02-30", "999.1.1.1", "1.2.3", "000-12-3456", "666-12-3456", "123-00-4567", "12345", "2024", "1.2.3.4.5", "a4111111111111111", "41111111111111111111111", "v1-2-3", "31/02/1999", "x@y", "3.14159",
         "1850-01-01", "deadbeef", "00000000000000000000000000000000", "12:30:59", "100,000", "one @ two"]


def shape(s):
    return re.sub("[0-9]", "9", s)


def test_private_values_are_replaced_in_their_format(spark):
    out = run(spark, *[f"x {p}! y" for p in PRIVATE])
    for p, t in zip(PRIVATE, out):
        assert p not in t and t.startswith("x ") and t.endswith("! y")
        new = t[2:-3]
        if "@" not in p and not re.fullmatch("[0-9a-fA-F]{40}", p) and "." not in p[:4]:
            assert shape(new) == shape(p)
        if p in PRIVATE[:5]:
            assert luhn(re.sub("[^0-9]", "", new))
        if p[:4] in ("1980", "2004"):
            assert 1900 <= dt.date.fromisoformat(new.replace("/", "-")).year <= 2099
    assert re.sub("[^0-9]", "", out[1]) == re.sub("[^0-9]", "", out[0]) == re.sub("[^0-9]", "", out[2])


def test_other_numbers_stay(spark):
    assert run(spark, *CLEAN) == CLEAN


def test_failed_candidates_hide_no_valid_ones(spark):
    card = run(spark, "4111 1111 1111 1111")[0]
    assert run(spark, "2020 4111 1111 1111 1111", "é 2020 4111 1111 1111 1111 2021 ü") == [f"2020 {card}", f"é 2020 {card} 2021 ü"]
    phone = run(spark, "524-555-7373")[0]
    assert run(spark, "1234 5678 9012 524-555-7373")[0] == f"1234 5678 9012 {phone}"
    assert run(spark, "666-12-4111 1111 1111 1111")[0] == f"666-12-{card}"
    df = spark.createDataFrame([(1, "2020 4111 1111 1111 1111 x 4111111111111112")], "doc_id long, text string")
    assert pii.pseudonymise(df, "key").first()["n_found"] == 1


def test_secrets_of_any_length(spark):
    keys = [("0123456789abcdef" * 20)[:n] for n in (32, 64, 65, 96, 128, 320)]
    out = run(spark, *keys, keys[3].upper())
    for old, new in zip([*keys, keys[3]], out):
        assert len(new) == len(old) and new.lower() != old and re.fullmatch("[0-9a-f]+|[0-9A-F]+", new)
    assert out[6] == out[3].upper() and out[4][:64] != out[4][64:]


def test_links_and_neighbours(spark):
    a, b, c, d = run(spark, "4111111111111111 4111111111111111", "see 4111111111111111", "", None)
    one = b.removeprefix("see ")
    assert a == f"{one} {one}" and c == "" and d is None
    assert run(spark, "a@b.co,c@d.co;a@b.co")[0].count(run(spark, "a@b.co")[0]) == 2


def test_feistel_is_a_permutation(spark):
    """Every pair of a whole domain, and every date, has its own image."""
    pairs = spark.range(17 * 23).select(pii.feistel((F.col("id") % 17), F.floor(F.col("id") / 17), F.lit(17), F.lit(23), "k", F.lit("t")).alias("p"))
    assert pairs.distinct().count() == 17 * 23
    assert pairs.agg(F.max("p.l"), F.max("p.r")).first()[0:2] == (16, 22)
    digits = spark.range(1000).select(pii.digits_permuted(F.lpad(F.col("id").cast("string"), 3, "0"), "k", "t").alias("d"))
    assert digits.distinct().count() == 1000 and digits.where("length(d) <> 3").count() == 0
    days = spark.range(0, pii.DAYS, 7).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    out = pii.pseudonymise(days, "k")
    assert out.select("text").distinct().count() == days.count() == out.where("n_found = 1").count()


def test_no_two_dates_meet(spark):
    """All dates with the month in front and behind: as many different ones come out."""
    first = dt.date(1900, 1, 1)
    days = [first + dt.timedelta(days=k) for k in range(pii.DAYS)]
    texts = {d.strftime(f) for d in days for f in ("%d/%m/%Y", "%m/%d/%Y")}
    assert len(texts) == 117_298
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(8)
    got = [r["text"] for r in pii.pseudonymise(df, "k").collect()]
    assert len(set(got)) == len(texts) and set(got) <= texts
    assert {int(t[3:5]) > 12 for t in got if int(t[3:5]) > 12} == {True} and sum(int(t[3:5]) > 12 for t in got) == sum(int(t[3:5]) > 12 for t in texts)


def test_social_security_numbers_stay_valid(spark):
    ids = [f"{a:03d}-{b:02d}-{c:04d}" for a in (1, 123, 665, 667, 899) for b in (1, 50, 99) for c in range(1, 9999, 97)]
    df = spark.createDataFrame([(t,) for t in ids], "text string").repartition(8)
    got = [r["text"] for r in pii.pseudonymise(df, "k").collect()]
    assert len(set(got)) == len(ids) and not [t for t in got if re.match("000|666|9", t) or t[4:6] == "00" or t[7:] == "0000"]


def test_very_many_values_in_one_text(spark):
    days = [(dt.date(1900, 1, 1) + dt.timedelta(days=k)).isoformat() for k in range(60_000)]
    out = pii.pseudonymise(spark.createDataFrame([(" ".join(days),)], "text string"), "k").first()
    assert out["n_found"] == len(days) and len(set(out["text"].split(" "))) == len(days)


def test_given_documents(spark, docs):
    got = pii.pseudonymise(docs.withColumn("n_found", F.lit("clash")), "key")
    assert got.columns == [c for c in docs.columns] + ["n_found"] and got.count() == docs.count()
    before = {(r["doc_id"], r["text"]) for r in docs.collect()}
    for r in got.collect():
        for card in re.findall(r"(?<![0-9A-Za-z])[0-9]{16}(?![0-9A-Za-z])", r["text"] or ""):
            assert not luhn(card) or (r["doc_id"], r["text"]) not in before
        if r["n_found"] == 0:
            assert (r["doc_id"], r["text"]) in before
    text = spark.read.parquet(f"{SMALL_SF}/documents.parquet").select("doc_id", "text")
    private = re.compile(r"\+1 \([0-9]{3}\) 555-[0-9]{4}|[a-z.0-9]+@mail[0-9]\.example\.com|token = \"[0-9a-f]{40}\"|\b4[0-9]{15}\b")
    old = {m for r in text.collect() for m in private.findall(r["text"] or "") if not re.fullmatch("4[0-9]{15}", m) or luhn(m)}
    new = " ".join(r["text"] or "" for r in pii.pseudonymise(text, "key").collect())
    assert old and not [m for m in old if m in new]


def test_empty_table(spark):
    assert pii.pseudonymise(empty(spark), "k").count() == 0
