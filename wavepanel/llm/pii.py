"""Format-preserving pseudonyms for personal numbers and dates.

Candidates are found by one pattern, validated by kind (checksum, ranges,
calendar), and mapped by a keyed Feistel network whose domain is exactly the
valid values of the kind: a card number becomes another number with a right
check digit, a date another date, an address another address.  The network is
a permutation, so equal values get equal pseudonyms in every document and
different values different ones.  Separators stay.

Everything is built from Spark's own functions; the rounds are an ``aggregate``
over a struct of the two halves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_columns, read

ROUNDS = 10
# The key of the query below; a deployment passes its own secret.
DEMO_KEY = "wavepanel-demo-key"

EMAIL = r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
ADDRESS = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
ISO_DATE = r"\d{4}-\d{2}-\d{2}"
DATE = r"\d{1,2}([/.])\d{1,2}\1\d{4}"
SSN = r"\d{3}-\d{2}-\d{4}"
PHONE = (r"(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}"
         r"|\(\d{3}\) ?\d{3}[.-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})")
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?"
# a date with slashes after a card is not part of it
CARD = r"\d(?:(?:[ -](?!\d{1,2}/\d{1,2}/\d{4}(?!\w)))?\d){12,18}"
KINDS = ("email", "address", "iso_date", "date", "ssn", "phone", "iban", "card")
_BY_KIND = dict(zip(KINDS, (EMAIL, ADDRESS, ISO_DATE, DATE.replace("([/.])", "[/.]")
                            .replace(r"\1", "[/.]"), SSN, PHONE, IBAN, CARD)))
# A candidate neither continues a word or number nor goes on as one.
PATTERN = (r"(?<![\w.+@-])(?:" + "|".join(_BY_KIND[k] for k in KINDS)
           + r")(?![\w@]|[.-]\d)|(?<=[=:])(?:" + CARD + ")(?![\\w@])")

# Extents that come before others of a candidate: usual groups of a card, and
# the length of a country's account numbers.
USUAL_CARD = (r"^(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5}"
              r"|\d{4}([ -])\d{6}\3\d{4})$")
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK|FI|NL", 19: "SI", 20: "AT|EE|LT|LU",
                21: "CH|HR|LI|LV", 22: "BG|DE|GB|IE", 23: "AE|IL", 24: "AD|CZ|ES|RO|SA|SE|SK",
                25: "PT", 26: "IS|TR", 27: "FR|GR|IT|MC", 28: "CY|HU|PL", 31: "MT"}
USUAL_IBAN = ("^(?:" + "|".join(f"(?:{c})[A-Z0-9]{{{n - 2}}}" for n, c in IBAN_LENGTHS.items())
              + ")$")

FIRST_DAY, DAYS = "1900-01-01", 73_049          # up to 2099-12-31; 73,049 = 17 * 4,297


def _keyed(key: Column, kind: str, turn: Column, half: Column) -> Column:
    """60 bits that depend on the key, the kind, the round and one half."""
    h = F.sha2(F.concat_ws("|", key, F.lit(kind), turn.cast("string"), half.cast("string"), key),
               256)
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: Column, kind: str) -> Column:
    """A keyed permutation of pairs (left < a, right < b), as struct<l, r>.

    Odd rounds add a function of the right half to the left one modulo a, even
    rounds the other way round modulo b; each step can be undone.
    """
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(acc, i):
        odd = i % 2 == 1
        half = F.when(odd, acc["r"]).otherwise(acc["l"])
        f = _keyed(key, kind, i, half)
        return F.struct(
            F.when(odd, (acc["l"] + f % a) % a).otherwise(acc["l"]).alias("l"),
            F.when(odd, acc["r"]).otherwise((acc["r"] + f % b) % b).alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def _pad(x: Column, n) -> Column:
    return F.lpad(x.cast("string"), n, "0")


def _fill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced in order by those of ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(acc, c):
        num = c.rlike(r"^\d$")
        return F.struct(
            F.concat(acc["out"], F.when(num, F.substr(digits, acc["at"], F.lit(1))).otherwise(c))
            .alias("out"), (acc["at"] + F.when(num, 1).otherwise(0)).alias("at"))

    return F.aggregate(F.filter(F.split(m, ""), lambda c: c != ""), start, step,
                       lambda acc: acc["out"])


def _digit_string(d: Column, key: Column, kind: str) -> Column:
    """A digit string permuted among those of its length (up to 36 digits)."""
    n = F.length(d)
    h = (n / 2).cast("int")
    a = F.pow(F.lit(10.0), h).cast("long")
    b = F.pow(F.lit(10.0), n - h).cast("long")
    f = feistel(F.substr(d, F.lit(1), h).cast("long"), F.substr(d, h + 1, n - h).cast("long"),
                a, b, key, kind)
    return F.when(n < 2, d).otherwise(F.transform(F.array(f), lambda s: F.concat(
        F.lpad(s["l"].cast("string"), h, "0"), F.lpad(s["r"].cast("string"), n - h, "0")))[0])


def _luhn_sum(d: Column, first_doubled: bool) -> Column:
    """Luhn sum from the right; the rightmost digit is doubled if said so."""
    rev = F.filter(F.split(F.reverse(d), ""), lambda c: c != "")

    def weigh(c, i):
        v = c.cast("int")
        w = v * F.when(i % 2 == (0 if first_doubled else 1), 2).otherwise(1)
        return F.when(w > 9, w - 9).otherwise(w)

    return F.aggregate(F.transform(rev, weigh), F.lit(0), lambda x, y: x + y)


def _card(m: Column, key: Column) -> Column:
    """The network digit stays, the check digit is made to fit."""
    d = _digits(m)
    n = F.length(d)
    body = F.concat(F.substr(d, F.lit(1), F.lit(1)),
                    _digit_string(F.substr(d, F.lit(2), n - 2), key, "card"))
    full = F.transform(F.array(body), lambda x: F.concat(
        x, ((10 - _luhn_sum(x, True) % 10) % 10).cast("string")))[0]
    ok = (_luhn_sum(d, False) % 10 == 0) & ~d.rlike(r"^0+$")
    return F.when(ok, _fill(m, full))


def _phone(m: Column, key: Column) -> Column:
    """Area and exchange codes of ten digits stay valid (200 to 999); other
    numbers keep their country code and length."""
    d = _digits(m)
    n = F.length(d)
    ten = F.substr(d, n - 9, F.lit(10))
    area, rest = F.substr(ten, F.lit(1), F.lit(3)).cast("int"), F.substr(ten, F.lit(4), F.lit(7))
    f = feistel(area - 200, rest.cast("long") - 2_000_000, F.lit(800), F.lit(8_000_000), key,
                "phone")
    north = F.transform(F.array(f), lambda s: F.concat(
        F.substr(d, F.lit(1), n - 10), (s["l"] + 200).cast("string"),
        (s["r"] + 2_000_000).cast("string")))[0]
    code = F.length(F.regexp_extract(m, r"^\+(\d{1,3})", 1))
    other = F.concat(F.substr(d, F.lit(1), code),
                     _digit_string(F.substr(d, code + 1, n - code), key, "abroad"))
    is_north = (~m.startswith("+") | m.rlike(r"^\+1\D")) & ten.rlike(r"^[2-9]\d\d[2-9]\d{6}$") \
        & (n >= 10) & (n <= 11)
    return F.when(is_north, _fill(m, north)).when(
        m.startswith("+") & (n >= 8) & (n <= 15), _fill(m, other))


def _address(m: Column, key: Column) -> Column:
    p = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    f = feistel(p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65_536), F.lit(65_536), key, "address")
    new = F.transform(F.array(f), lambda s: F.concat_ws(
        ".", F.floor(s["l"] / 256).cast("string"), (s["l"] % 256).cast("string"),
        F.floor(s["r"] / 256).cast("string"), (s["r"] % 256).cast("string")))[0]
    return F.when(F.forall(p, lambda x: x <= 255), new)


def _ssn(m: Column, key: Column) -> Column:
    p = F.transform(F.split(m, "-"), lambda x: x.cast("int"))
    area = F.when(p[0] > 666, p[0] - 2).otherwise(p[0] - 1)         # 898 areas: not 0, 666, 9xx
    f = feistel(area, (p[1] - 1) * 9_999 + p[2] - 1, F.lit(898), F.lit(99 * 9_999), key, "ssn")
    new = F.transform(F.array(f), lambda s: F.concat_ws(
        "-", _pad(F.when(s["l"] >= 665, s["l"] + 2).otherwise(s["l"] + 1), 3),
        _pad(F.floor(s["r"] / 9_999) + 1, 2), _pad(s["r"] % 9_999 + 1, 4)))[0]
    return F.when((p[0] > 0) & (p[0] != 666) & (p[0] < 900) & (p[1] > 0) & (p[2] > 0), new)


def _moved(day: Column, key: Column) -> Column:
    """Another day of 1900 to 2099; null for days outside."""
    n = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    f = feistel(F.floor(n / 4_297), n % 4_297, F.lit(17), F.lit(4_297), key, "date")
    new = F.transform(F.array(f), lambda s: F.date_add(
        F.lit(FIRST_DAY).cast("date"), (s["l"] * 4_297 + s["r"]).cast("int")))[0]
    return F.when((n >= 0) & (n < DAYS), new)


def _iso_date(m: Column, key: Column) -> Column:
    return F.date_format(_moved(F.try_to_date(m, "yyyy-MM-dd"), key), "yyyy-MM-dd")


def _date(m: Column, key: Column) -> Column:
    """Day first if that is a date, else month first; zero padding as it was.

    A date that can only be month first has a day above 12, and so has its
    pseudonym, so it never reads as a day-first one: days 13 to 28 of the 2,400
    months change places, and so do the months with a 29th (but for February),
    a 30th and a 31st, and the 49 leap days.
    """
    sep = F.regexp_extract(m, r"([/.])", 1)
    p = F.split(m, r"[/.]")
    build = lambda d, mo: F.concat_ws("-", p[2], F.lpad(mo, 2, "0"), F.lpad(d, 2, "0"))
    day_first = F.try_to_date(build(p[0], p[1]), "yyyy-MM-dd")
    month_first = F.try_to_date(build(p[1], p[0]), "yyyy-MM-dd")
    padded = (F.length(p[0]) == 2) & (F.length(p[1]) == 2)
    show = lambda day, pat, plain: F.when(padded, F.date_format(day, pat)).otherwise(
        F.date_format(day, plain))
    first = show(_moved(day_first, key), "dd/MM/yyyy", "d/M/yyyy")
    second = show(_moved_late(month_first, key), "MM/dd/yyyy", "M/d/yyyy")
    return F.replace(F.when(day_first.isNotNull(), first).otherwise(second), F.lit("/"), sep)


# Months with 31 days, months but February.
LONG_MONTHS = (1, 3, 5, 7, 8, 10, 12)
OTHER_MONTHS = (1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12)


def _moved_late(day: Column, key: Column) -> Column:
    """Another day of 1900 to 2099 after the 12th of its month, for such a day."""
    year, month, dom = F.year(day) - 1900, F.month(day), F.dayofmonth(day)

    def date(y: Column, mo: Column, d: Column) -> Column:
        return F.make_date((y + 1900).cast("int"), mo.cast("int"), d.cast("int"))

    def moved(left: Column, right: Column, a: int, b: int, kind: str, to) -> Column:
        f = feistel(left, right, F.lit(a), F.lit(b), key, kind)
        return F.transform(F.array(f), to)[0]

    def months(kind: str, which: tuple[int, ...]) -> Column:
        names = F.array(*map(F.lit, which))
        return moved(year, F.array_position(names, month) - 1, 200, len(which), kind,
                     lambda s: date(s["l"], F.get(names, s["r"].cast("int")), dom))

    common = moved(year * 12 + month - 1, dom - 13, 2_400, 16, "date 13-28",
                   lambda s: date(F.floor(s["l"] / 12), s["l"] % 12 + 1, s["r"] + 13))
    leap = moved(F.floor((year - 4) / 28), F.floor((year - 4) / 4) % 7, 7, 7, "leap day",
                 lambda s: date(4 + 28 * s["l"] + 4 * s["r"], F.lit(2), F.lit(29)))
    inside = (year >= 0) & (year < 200)
    return F.when(inside & (dom <= 28), common).when(inside & (month == 2), leap).when(
        inside & (dom == 29), months("date 29", OTHER_MONTHS)).when(
        inside & (dom == 30), months("date 30", OTHER_MONTHS)).when(
        inside, months("date 31", LONG_MONTHS))


def _iban(m: Column, key: Column) -> Column:
    """The account's digits are permuted, and the two check digits fitted.

    Letters, the country and the spaces stay.
    """
    plain = F.replace(m, F.lit(" "), F.lit(""))

    def mod97(s):
        chars = F.filter(F.split(s, ""), lambda c: c != "")
        return F.aggregate(chars, F.lit(0).cast("long"), lambda acc, c: F.when(
            c.rlike(r"^\d$"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise(
            (acc * 100 + F.ascii(c) - 55) % 97))

    body = F.substr(plain, F.lit(5), F.length(plain) - 4)
    country = F.substr(plain, F.lit(1), F.lit(2))
    digits = _digits(body)
    new = _fill(body, _digit_string(digits, key, "iban"))
    check = F.transform(F.array(new), lambda x: F.concat(
        _pad(98 - mod97(F.concat(x, country, F.lit("00"))), 2), _digits(x)))[0]
    ok = (mod97(F.concat(body, F.substr(plain, F.lit(1), F.lit(4)))) == 1) \
        & (F.length(plain) >= 15) & (F.length(plain) <= 34)
    return F.when(ok, _fill(m, check))


def _email(m: Column, key: Column) -> Column:
    """Letters and digits of the mailbox move within their class.

    A Feistel network over strings: in each round the characters of one half
    are shifted by amounts that depend on the other half.
    """
    box = F.substring_index(m, "@", 1)
    chars = F.filter(F.split(box, ""), lambda c: c != "")
    h = F.ceil(F.size(chars) / 2).cast("int")
    start = F.struct(F.slice(chars, F.lit(1), h).alias("l"),
                     F.slice(chars, h + 1, F.size(chars)).alias("r"))

    def shifted(half, other, i):
        k = F.sha2(F.concat_ws("|", key, F.lit("email"), i.cast("string"),
                               F.array_join(other, ""), key), 512)

        def move(c, j):
            s = F.conv(F.substr(k, (j % 60) * 2 + 1, F.lit(4)), 16, 10).cast("int")
            turn = lambda base, n: F.chr((F.ascii(c) - base + s) % n + base)
            return (F.when(c.rlike("^[a-z]$"), turn(97, 26)).when(c.rlike("^[A-Z]$"), turn(65, 26))
                    .when(c.rlike(r"^\d$"), turn(48, 10)).otherwise(c))

        return F.transform(half, move)

    def turn(acc, i):
        odd = i % 2 == 1
        return F.struct(F.when(odd, shifted(acc["l"], acc["r"], i)).otherwise(acc["l"]).alias("l"),
                        F.when(odd, acc["r"]).otherwise(shifted(acc["r"], acc["l"], i)).alias("r"))

    new = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn,
                      lambda s: F.array_join(F.concat(s["l"], s["r"]), ""))
    return F.concat(new, F.lit("@"), F.substring_index(m, "@", -1))


def _within(m: Column, kind: str, one, usual) -> Column:
    """``m`` with its first valid extent replaced, or null if none is valid.

    An extent starts and ends with a group.  ``usual`` ones come first, then
    longer ones, since a number or word next to a value may look like its end.
    """
    parts = F.regexp_extract_all(m, F.lit(r"[ -]?[^ -]+"), F.lit(0))
    n = F.size(parts)

    def glued(start, length):
        return F.array_join(F.slice(parts, start, length), "")

    def extent(i, k):
        body = F.regexp_replace(glued(i, k), "^[ -]", "")
        head = F.concat(glued(F.lit(1), i - 1),
                        F.regexp_extract(glued(i, F.lit(1)), "^[ -]?", 0))
        return F.struct((~usual(body)).alias("odd"), (-F.length(body)).alias("short"),
                        i.alias("at"), head.alias("head"), body.alias("body"),
                        glued(i + k, n).alias("tail"))

    every = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(
        F.sequence(F.lit(1), n - i + 1), lambda k: extent(i, k))))
    formed = F.array_sort(F.filter(every, lambda e: e["body"].rlike(f"^(?:{_BY_KIND[kind]})$")))
    new = F.transform(formed, lambda e: F.concat(e["head"], one(e["body"]), e["tail"]))
    return F.get(F.filter(new, lambda x: x.isNotNull()), F.lit(0))


def _card_within(m: Column, key: Column) -> Column:
    return _within(m, "card", lambda x: _card(x, key), lambda x: x.rlike(USUAL_CARD))


def _iban_within(m: Column, key: Column) -> Column:
    return _within(m, "iban", lambda x: _iban(x, key),
                   lambda x: F.replace(x, F.lit(" "), F.lit("")).rlike(USUAL_IBAN))


def pseudonym(m: Column, key: Column) -> Column:
    """The pseudonym of a candidate, or null if it is not valid."""
    by_kind = {"email": _email, "address": _address, "iso_date": _iso_date, "date": _date,
               "ssn": _ssn, "phone": _phone, "iban": _iban_within,
               "card": _card_within}
    out = None
    for kind in KINDS:
        test, value = m.rlike(f"^(?:{_BY_KIND[kind]})$"), by_kind[kind](m, key)
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with validated emails, addresses, dates, phone, social security,
    account and card numbers in ``text`` replaced, and their count n_replaced.

    A null text stays null with 0, an empty or clean one as it is.  Invalid
    candidates stay.  Equal values get equal pseudonyms in any row.  An empty
    table stays empty; a column named like the added one is replaced.
    """
    docs = own_columns(docs, ["n_replaced", "_found", "_new"])
    secret = F.lit(key)
    t = F.col(text)
    found = F.when(t.rlike(r"[0-9@]"), F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0)))
    new = F.transform(F.col("_found"), lambda m: pseudonym(m, secret))
    both = F.zip_with("_found", "_new", lambda m, n: F.coalesce(n, m))
    pieces = F.split(t, PATTERN, -1)
    glued = F.array_join(F.zip_with(pieces, F.concat(F.array(F.lit("")), both),
                                    lambda p, r: F.concat(r, p)), "")
    hit = F.size(F.filter(F.col("_new"), lambda n: n.isNotNull()))
    return (docs.withColumn("_found", found)
            .withColumn("_new", F.when(F.size("_found") > 0, new))
            .withColumn("n_replaced", F.when(F.col("_new").isNull(), 0).otherwise(hit))
            .withColumn(text, F.when(F.col("n_replaced") > 0, glued).otherwise(t))
            .select(*docs.columns, "n_replaced"))


def op4_feistel_pseudonyms(spark, sf_dir):
    return pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"), DEMO_KEY)
