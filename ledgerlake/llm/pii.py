"""Format-preserving Feistel pseudonyms for personal data.

Found and validated values are replaced by a keyed permutation within their own format,
so equal values stay equal (and different ones different) in all documents, and without
the key nothing leads back:

* card numbers (13 to 19 digits, plain or in groups, valid check digit): the digits but
  the last are permuted and the check digit is made anew;
* telephone numbers (with area code in brackets or +country code): the digits after the
  country code;
* social security numbers ddd-dd-dddd with a valid area, group and serial: all digits, again
  and again until the number is a valid one;
* IPv4 addresses with octets up to 255: the 32-bit number;
* dates of 1900 to 2099 in seven notations: the day, within these years; a date that only
  reads as month before day becomes another such date;
* e-mail addresses and long hexadecimal secrets, which are no numbers: each is replaced
  by a keyed hash in the shape of an address, or of a secret of its length and case.

Everything else stays as it is: a number that fails its check is not personal data.

A value of n = a + b digits is a pair (left, right) modulo 10**a and 10**b; each of ten
rounds adds a keyed SHA-256 of one half to the other.  The mapping is a permutation by
construction, so no two values of a format meet.  Where only some values are valid, the
permutation is repeated until it reaches one of them, which is a permutation of these.

Only SQL expressions are used: one pattern cuts a text before every place where a
candidate begins, candidates are mapped, and from left to right each valid one that does
not begin inside another replaces its characters, all within the row; one that fails its
check takes nothing from those that begin inside it.  A null text stays null with no
matches; an empty text stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: Candidates of a text that are weighed together.
RUN = 256
#: Days from 1900-01-01 to 2099-12-31: 17 * 4297.
DAYS, DAY_LEFT, DAY_RIGHT = 73049, 17, 4297
_CARD = r"[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
_PHONE = r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[0-9]{1,3}(?:[ .-][0-9]{2,8}){2,5}|\+[0-9]{10,14}|[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4}"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
_IP = r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
_DATE_ANY = r"(?:19|20)[0-9]{2}(?:-[0-9]{2}-[0-9]{2}|/[0-9]{2}/[0-9]{2})|[0-9]{2}(?:-[0-9]{2}-|/[0-9]{2}/|\.[0-9]{2}\.)(?:19|20)[0-9]{2}"
_MAIL = r"[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})\.){1,8}[A-Za-z]{2,24}"
_SECRET = r"[0-9a-f]{32,}+|[0-9A-F]{32,}+"
_ANY = rf"(?<![A-Za-z0-9._%+-])(?:{_MAIL})|(?<![A-Za-z0-9])(?:{_SECRET})(?![A-Za-z0-9])|(?<![A-Za-z0-9+.])(?:{_IP}|(?:{_DATE_ANY}|{_SSN}|{_PHONE}|{_CARD})(?![A-Za-z0-9]))"
#: The place before each candidate, which is group 1; candidates may overlap.
PATTERN = rf"(?<![A-Za-z0-9])(?=({_ANY}))"


def _whole(pattern: str) -> str:
    return f"^(?:{pattern})$"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _hash(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *parts), 256)


def feistel(left: Column, right: Column, mod_left: Column, mod_right: Column, key: str, tweak: Column) -> Column:
    """The pair after ROUNDS keyed rounds, as struct(l, r); a permutation of all pairs."""
    def f(n: Column, half: Column, mod: Column) -> Column:
        digest = _hash(key, tweak, n.cast("string"), half.cast("string"))
        return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), mod)

    def step(pair: Column, n: Column) -> Column:
        odd = n % 2 == 1
        return F.struct(F.when(odd, F.pmod(pair["l"] + f(n, pair["r"], mod_left), mod_left)).otherwise(pair["l"]).alias("l"),
                        F.when(odd, pair["r"]).otherwise(F.pmod(pair["r"] + f(n, pair["l"], mod_right), mod_right)).alias("r"))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def walked(value: Column, step, ok, most: int = 64) -> Column:
    """``step`` applied until the result satisfies ``ok``: for a permutation and a value that
    is ok, a permutation of the ok values.  They must be a good part of all values: of nine in
    ten or six in ten, ``most`` steps miss them with a chance below 10 ** -25."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), value, lambda v, n: F.when((n > 1) & ok(v), v).otherwise(step(v)))


def digits_permuted(digits: Column, key: str, kind: str) -> Column:
    """A string of 2 to 20 digits mapped to another of the same length."""
    n = F.length(digits)
    a = F.floor(n / 2).cast("int")
    ten = lambda k: F.pow(F.lit(10.0), k).cast("long")
    pair = feistel(F.substr(digits, F.lit(1), a), F.substr(digits, a + 1), ten(a), ten(n - a), key, F.concat(F.lit(kind), n.cast("string")))
    return _let(pair, lambda p: F.concat(F.lpad(p["l"].cast("string"), a, F.lit("0")), F.lpad(p["r"].cast("string"), n - a, F.lit("0"))))


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _filled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    chars = F.split(shape, "")
    return _let(digits, lambda d: F.array_join(F.transform(chars, lambda c, i: F.when(
        c.between("0", "9"), F.substr(d, F.length(_only_digits(F.substr(shape, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), ""))


def _valid(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _card(value: Column, key: str) -> Column:
    digits = _only_digits(value)
    body = digits_permuted(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
    checked = _let(body, lambda b: F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(b, d.cast("string"))), _valid)[0])
    return F.when(F.length(digits).between(13, 19) & _valid(digits), _filled(value, checked)).otherwise(value)


def _phone(value: Column, key: str) -> Column:
    country = F.regexp_extract(value, r"^(\+[0-9]{1,3}(?=[^0-9])|\+[0-9]{2}|)", 1)
    rest = F.substr(value, F.length(country) + 1)
    return F.concat(country, _filled(rest, digits_permuted(_only_digits(rest), key, "phone")))


def _ssn(value: Column, key: str) -> Column:
    valid = lambda digits: ~digits.rlike(r"^(?:000|666|9)|^[0-9]{3}00|0000$")
    digits = _only_digits(value)
    made = walked(digits, lambda d: digits_permuted(d, key, "ssn"), valid)
    return F.when(valid(digits), _filled(value, made)).otherwise(value)


def _ip(value: Column, key: str) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    pair = feistel(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], F.lit(65536), F.lit(65536), key, F.lit("ip"))
    made = _let(pair, lambda p: F.concat_ws(".", F.floor(p["l"] / 256).cast("string"), (p["l"] % 256).cast("string"), F.floor(p["r"] / 256).cast("string"), (p["r"] % 256).cast("string")))
    return F.when(F.array_max(octets) <= 255, made).otherwise(value)


def _date(value: Column, key: str) -> Column:
    first = F.lit("1900-01-01").cast("date")

    def one(layout: str, otherwise: Column, only=None) -> Column:
        """The date read and written in this layout; among the days that ``only`` names."""
        def step(day: Column) -> Column:
            pair = feistel(F.floor(day / DAY_RIGHT), day % DAY_RIGHT, F.lit(DAY_LEFT), F.lit(DAY_RIGHT), key, F.lit("date" if only is None else "month-day"))
            return _let(pair, lambda p: p["l"] * DAY_RIGHT + p["r"])

        day = F.datediff(F.try_to_date(value, layout), first).cast("long")
        made = _let(step(day) if only is None else walked(day, step, only), lambda d: F.date_format(F.date_add(first, d.cast("int")), layout))
        return F.when(day.between(0, DAYS - 1), made).otherwise(otherwise)

    def late(day: Column) -> Column:
        """Days after the twelfth: with the month in front they cannot be read otherwise."""
        return F.dayofmonth(F.date_add(first, day.cast("int"))) > 12

    out = value
    for shape, layout, swapped in ((r"^[0-9]{4}-", "yyyy-MM-dd", None), (r"^[0-9]{4}/", "yyyy/MM/dd", None), (r"^[0-9]{2}/", "dd/MM/yyyy", "MM/dd/yyyy"),
                                   (r"^[0-9]{2}-", "dd-MM-yyyy", "MM-dd-yyyy"), (r"^[0-9]{2}\.", "dd.MM.yyyy", None)):
        out = F.when(value.rlike(shape), one(layout, one(swapped, value, late) if swapped else value)).otherwise(out)
    return out


def _mail(value: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substr(_hash(key, F.lit("mail"), F.lower(value)), F.lit(1), F.lit(16)), F.lit("@example.invalid"))


def _secret(value: Column, key: str) -> Column:
    more = F.transform(F.sequence(F.lit(1), F.floor((F.length(value) + 63) / 64).cast("int")), lambda i: F.when(i == 1, _hash(key, F.lit("secret"), F.lower(value))).otherwise(_hash(key, F.lit("secret"), F.lower(value), i.cast("string"))))
    made = F.substr(F.array_join(more, ""), F.lit(1), F.length(value))
    mixed = value.rlike("[0-9]") & value.rlike("[a-fA-F]")
    return F.when(mixed, F.when(value.rlike("[A-F]"), F.upper(made)).otherwise(made)).otherwise(value)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one candidate, or the value itself if it is not valid."""
    return (F.when(value.contains("@"), _mail(value, key))
            .when(value.rlike(_whole(r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}")), _ip(value, key))
            .when(value.rlike(_whole(_DATE_ANY)), _date(value, key))
            .when(value.rlike(_whole(_SSN)), _ssn(value, key))
            .when(value.rlike(_whole(_PHONE)), _phone(value, key))
            .when(value.rlike(_whole(_CARD)), _card(value, key))
            .otherwise(_secret(value, key)))


def _taken(pieces: Column) -> Column:
    """For each piece (with piece, found, new): whether its candidate is replaced, and how
    many characters at its start belong to this or an earlier replaced candidate."""
    def step(state: Column, x: Column) -> Column:
        hit = (state["rest"] == 0) & (x["found"] != x["new"])
        covered = F.when(hit, F.length(x["found"])).otherwise(state["rest"])
        size = F.length(x["piece"])
        one = F.struct(hit.alias("hit"), F.least(covered, size).alias("cut"))
        return F.struct(F.greatest(covered - size, F.lit(0)).alias("rest"), F.array_append(state["all"], one).alias("all"))

    # In runs of RUN pieces: appending copies what is there, so runs are gathered, not rows.
    none = F.array().cast("array<struct<hit: boolean, cut: int>>")
    runs = F.array().cast("array<array<struct<hit: boolean, cut: int>>>")

    def run(state: Column, at: Column) -> Column:
        return F.aggregate(F.slice(pieces, at, RUN), F.struct(state["rest"].alias("rest"), none.alias("all")), step,
                           lambda done: F.struct(done["rest"].alias("rest"), F.array_append(state["all"], done["all"]).alias("all")))

    starts = F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1)), F.lit(RUN))
    whole = F.aggregate(starts, F.struct(F.lit(0).alias("rest"), runs.alias("all")), run, lambda state: F.flatten(state["all"]))
    return F.when(pieces.isNotNull(), whole)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the text's personal data replaced and ``n_found``, how many values
    were; an input column n_found is replaced.  Other columns pass through."""
    kept = [c for c in docs.columns if c != "n_found"]
    raw = F.col(text).cast("string")
    found = docs.select(*kept, F.coalesce(F.regexp_extract_all(raw, F.lit(PATTERN), F.lit(1)), F.array().cast("array<string>")).alias("_found"))
    cut = found.select("*", F.transform("_found", lambda v: pseudonym(v, key)).alias("_new"), F.when(F.size("_found") > 0, F.split(raw, PATTERN, -1)).alias("_cut"))
    before = F.size("_cut") > F.size("_found")  # the text does not begin with a candidate
    pieces = F.arrays_zip(F.when(before, F.slice("_cut", 2, F.size("_found"))).otherwise(F.col("_cut")).alias("piece"), F.col("_found").alias("found"), F.col("_new").alias("new"))
    zipped = cut.select(*kept, F.when(before, F.col("_cut")[0]).otherwise("").alias("_head"), F.when(F.size("_found") > 0, pieces).alias("_pieces"))
    marked = zipped.select("*", _taken(F.col("_pieces")).alias("_taken"))
    joined = F.zip_with("_pieces", "_taken", lambda x, t: F.concat(F.when(t["hit"], x["new"]).otherwise(""), F.substr(x["piece"], t["cut"] + 1)))
    whole = F.when(F.col("_pieces").isNull(), raw).otherwise(F.concat("_head", F.array_join(joined, "")))
    n_found = F.when(F.col("_pieces").isNull(), F.lit(0)).otherwise(F.size(F.filter("_taken", lambda t: t["hit"])))
    return marked.select(*[whole.alias(text) if c == text else F.col(c) for c in kept], n_found.alias("n_found"))
