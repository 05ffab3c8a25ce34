"""Personal data to format-preserving Feistel pseudonyms.

One pattern finds candidates; each is validated by its kind: payment card numbers
(13 to 19 digits, together, in fours or 4-6-5, Luhn), phone numbers (10 national digits), social security
numbers (area, group and serial in use), IPv4 addresses (octets below 256), dates
(days of the calendar). A valid value is permuted, under a key, within the values
of its format by an alternating Feistel network: two numbers take turns in being
moved by a keyed hash of the other, so every step can be undone, and equal values
have equal pseudonyms in all documents, however they are punctuated. A card's check
digit is made anew; a date stays within the 400 years of the calendar's cycle that it is in (counted from 1970), and an address, a phone number's
country code and all punctuation keep their form. Local parts of mail addresses and
secrets (after a key word, or known by their first letters) have no numeric format; they become keyed
hashes. IPv6 addresses, bank account numbers and phone numbers of other than ten national digits are not looked for.

Every part of the pattern begins at the edge of its run of characters and doesn't step back into what it
has passed, so a text takes time in proportion to its length, whatever it holds.

Only Spark's own functions are used. Defined results: null and empty texts give ""
and nothing found; a text of any length is searched whole; a candidate that fails its validation stays; repeated rows get
equal results; an empty table gives no rows; every further column passes through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, table

ROUNDS = 8
#: For tests and the registered query; a deployment gives its own.
KEY = "a-key-for-tests-only"

_CARD = r"(?<![\d.+-])(?:\d{13,19}|\d{4}[ -]\d{6}[ -]\d{5}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,3})?)(?![\d-])"
_PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]\d{4}(?![\d-])"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_IP = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"
_DATE = r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-])"
#: A domain has labels of 63 characters and 127 of them at most.
_MAIL = (r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]{1,63}"
         r"(?:\.[A-Za-z0-9-]{1,63}){0,125}\.[A-Za-z]{2,63}")
_KEY_WORD = r"(?i:token|secret|password|api[_-]?key)\s*+[=:]\s*+[\"']?"
_SECRET = _KEY_WORD + r"[A-Za-z0-9_./+~=-]{16,}+[\"']?"
#: Forms that tell themselves, by their first letters.
_BARE = (r"(?<![A-Za-z0-9_])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,255}+|xox[abprs]-[A-Za-z0-9-]{10,255}+)"
         r"(?![A-Za-z0-9_])")
#: Earlier kinds win where two match at the same place.
PATTERN = "|".join([_SECRET, _BARE, _MAIL, _SSN, _CARD, _PHONE, _IP, _DATE])


def _moved(value: Column, mod: Column, *parts) -> Column:
    """(value + keyed hash of the parts) within ``mod``."""
    seed = F.conv(F.substring(F.sha2(F.concat_ws("|", *parts).cast("binary"), 256), 1, 15), 16, 10).cast("long")
    return (value + seed % mod) % mod


def feistel(left: Column, right: Column, left_mod, right_mod, key: str, kind) -> Column:
    """struct<l, r>: (left, right) permuted within ``left_mod`` x ``right_mod``."""
    a, b = F.lit(left_mod).cast("long"), F.lit(right_mod).cast("long")
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(acc, i):
        parts = (F.lit(key), F.lit(kind), i.cast("string"))
        even = F.struct(_moved(acc["l"], a, *parts, acc["r"].cast("string")).alias("l"), acc["r"].alias("r"))
        odd = F.struct(acc["l"].alias("l"), _moved(acc["r"], b, *parts, acc["l"].cast("string")).alias("r"))
        return F.when(i % 2 == 0, even).otherwise(odd)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _power(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def _padded(number: Column, width: Column) -> Column:
    return F.right(F.concat(F.lit("0" * 20), number.cast("string")), width)


def permuted_digits(digits: Column, key: str, kind) -> Column:
    """A string of 2 to 36 digits permuted among all strings of its length."""
    def halves(d):
        n = F.length(d)
        a = (n / 2).cast("int")
        b = n - a
        both = feistel(F.left(d, a), F.right(d, b), _power(a), _power(b), key,
                       F.concat(F.lit(f"{kind}:"), n.cast("string")))
        return _let(both, lambda x: F.concat(_padded(x["l"], a), _padded(x["r"], b)))

    return _let(digits, halves)


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Luhn sum from the right; ``doubled_last``: for digits without their check digit."""
    chars = F.reverse(F.split(digits, ""))
    odd = 0 if doubled_last else 1
    worth = F.transform(chars, lambda c, i: F.when(
        i % 2 == odd, F.lit(2) * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x)


def _filled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits``, in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    step = lambda a, c: F.when(c.between("0", "9"), F.struct(
        F.concat(a["out"], F.substr(digits, a["at"], F.lit(1))).alias("out"), (a["at"] + 1).alias("at"))
    ).otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["at"].alias("at")))
    return F.aggregate(F.split(form, ""), start, step, lambda a: a["out"])


def _card(m: Column, key: str) -> Column:
    def body(d):
        new = permuted_digits(F.left(d, F.length(d) - 1), key, "card")
        return _let(new, lambda x: F.concat(x, ((F.lit(10) - luhn_sum(x, True) % 10) % 10).cast("string")))

    return _let(F.regexp_replace(m, r"\D", ""), lambda d: _filled(m, body(d)))


def _phone(m: Column, key: str) -> Column:
    return _let(F.regexp_replace(m, r"\D", ""), lambda d: _filled(m, F.concat(
        F.left(d, F.length(d) - 10), permuted_digits(F.right(d, F.lit(10)), key, "phone"))))


# Social security numbers: areas 001-665 and 667-899, groups 01-99, serials 0001-9999.
def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.split(m, "-")[i].cast("long") for i in range(3))
    place = F.when(area > 666, area - 2).otherwise(area - 1) * 99 + group - 1
    both = feistel(place, serial - 1, 898 * 99, 9999, key, "ssn")
    area_of = lambda x: F.floor(x["l"] / 99) + F.when(F.floor(x["l"] / 99) >= 665, 2).otherwise(1)
    return _let(both, lambda x: F.format_string(
        "%03d-%02d-%04d", area_of(x).cast("long"), (x["l"] % 99 + 1).cast("long"), (x["r"] + 1).cast("long")))


def _ip(m: Column, key: str) -> Column:
    o = [F.split(m, r"\.")[i].cast("long") for i in range(4)]
    both = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip")
    return _let(both, lambda x: F.concat_ws(".", *[
        v.cast("long").cast("string") for v in (F.floor(x["l"] / 256), x["l"] % 256, F.floor(x["r"] / 256), x["r"] % 256)]))


# 400 years have 146,097 = 189 * 773 days.
_DAYS, _A, _B = 146_097, 189, 773


def _day(m: Column) -> Column:
    """Days since 1970-01-01, null if it is no day."""
    iso = F.when(m.contains("-"), m).otherwise(F.concat_ws("-", F.right(m, F.lit(4)), *[
        F.when(m.contains("/"), F.substr(m, F.lit(a), F.lit(2))).otherwise(F.substr(m, F.lit(b), F.lit(2)))
        for a, b in ((1, 4), (4, 1))]))
    return F.when(F.left(iso, F.lit(4)) >= "0001", F.unix_date(F.try_to_date(iso, "yyyy-MM-dd")))


def _date(m: Column, key: str) -> Column:
    """Slashes: month first; dots: day first."""
    def write(x, era):
        day = F.date_from_unix_date((era * _DAYS + x["l"] * _B + x["r"]).cast("int"))
        return F.when(m.contains("-"), F.date_format(day, "yyyy-MM-dd")).when(
            m.contains("/"), F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "dd.MM.yyyy"))

    def move(day):
        era = F.floor(day / _DAYS).cast("long")
        place = F.pmod(day, F.lit(_DAYS))
        both = feistel(F.floor(place / _B), place % _B, _A, _B, key, "date")
        return _let(both, lambda x: write(x, era))

    return _let(_day(m), move)


def _hashed(value: Column, key: str, kind: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), value).cast("binary"), 256)


def _mail(m: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.left(_hashed(F.lower(m), key, "mail"), F.lit(12)), F.lit("@"), F.split(m, "@")[1])


def _secret(m: Column, key: str) -> Column:
    """What follows the key word, or the first letters, becomes as many hex digits; a quote or a full stop after it stays."""
    part = lambda i: F.regexp_extract(m, "^(" + _KEY_WORD + r"|AKIA|gh[pousr]_|xox[abprs]-)(.*?)(\.?[\"']?)$", i)
    return _let(part(2), lambda v: F.concat(
        part(1), F.left(F.repeat(_hashed(v, key, "secret"), F.ceil(F.length(v) / 64).cast("int")), F.length(v)), part(3)))


def kind_of(m: Column) -> Column:
    """The kind of a candidate that passes its validation, else null."""
    digits = F.regexp_replace(m, r"\D", "")
    area = F.left(m, F.lit(3))
    return (F.when(m.rlike("^(?:" + _SECRET + "|" + _BARE + ")$"), "secret")
            .when(m.contains("@"), "mail")
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"),
                  F.when((area != "000") & (area != "666") & (area < "900") & (F.substring(m, 5, 2) != "00")
                         & (F.right(m, F.lit(4)) != "0000"), "ssn"))
            .when(m.rlike(r"^\d{13,19}$|^\d{4}(?:[ -]\d{4}){2}|^\d{4}[ -]\d{6}[ -]"), F.when(luhn_sum(digits, False) % 10 == 0, "card"))
            .when(m.rlike(r"^\d+(?:\.\d+){3}$"), F.when(~F.exists(F.split(m, r"\."), lambda x: x.cast("int") > 255), "ip"))
            .when(m.rlike(r"^\d{4}-\d\d-\d\d$|^\d\d/\d\d/\d{4}$|^\d\d\.\d\d\.\d{4}$"), F.when(_day(m).isNotNull(), "date"))
            .when(F.length(digits).between(10, 13), "phone"))


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a value of a kind; other values stay."""
    out = F.when(kind == "secret", _secret(m, key))
    for name, f in (("mail", _mail), ("ssn", _ssn), ("card", _card), ("phone", _phone), ("ip", _ip), ("date", _date)):
        out = out.when(kind == name, f(m, key))
    return out.otherwise(m)


def pseudonymize(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """``row`` (all columns of ``docs``, the text replaced), and ``kinds`` (array of the kinds
    of all values replaced, in order)."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = boxed(docs, F.when(t.rlike(PATTERN), F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0))).alias("m"),
                  t.alias("t"))
    pairs = F.transform("m", lambda m: _let(kind_of(m), lambda k: F.struct(
        k.alias("kind"), pseudonym(m, k, key).alias("new"))))
    gaps = F.split("t", PATTERN, -1)
    woven = F.array_join(F.zip_with(gaps, F.transform("pairs", lambda p: p["new"]), lambda g, n: F.concat(
        g, F.coalesce(n, F.lit("")))), "")
    none = F.expr("cast(array() as array<string>)")
    out = found.withColumn("pairs", F.when(F.col("m").isNotNull(), pairs))
    return out.select(
        F.col("row").withField(text, F.when(F.col("m").isNotNull(), woven).otherwise(F.col("t"))).alias("row"),
        F.coalesce(F.filter(F.transform("pairs", lambda p: p["kind"]), lambda k: k.isNotNull()), none).alias("kinds"))


def query(spark, sf_dir):
    """Every document with its personal data replaced."""
    out = pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), F.size("kinds").cast("long").alias("n_found"),
                      F.array_join(F.array_sort(F.array_distinct("kinds")), ",").alias("kinds"),
                      F.col("row.text").alias("text"))
