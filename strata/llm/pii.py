"""Format-preserving pseudonyms for personal data.

Card, telephone and social security numbers, IPv4 and e-mail addresses and
dates are found by one expression, checked (a card by its Luhn sum, a date by
the calendar, an international telephone number by its digits), and replaced
by a keyed permutation of their own format, so the same value gets the same
pseudonym in every document and the key's holder can undo it.

The permutation is a Feistel network over a row of symbols, each with a radix
of its own: in round ``t`` the symbols at places of one parity move, modulo
their radix, by a SHA-512 of the key, the kind, the round and the symbols of
the other parity. A date is two symbols (a day number written in radices
whose product is the number of days), an address four of radix 256, a card
its digits but the last, which is then set so that the Luhn sum stays right. DataFrame functions only; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Dates of these years are checked and permuted among themselves: the days
#: from 1904-01-01 to 2099-12-31 number 147 * 487.
DATE_START, DATE_RADICES = "1904-01-01", (147, 487)

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_LOCAL = r"[\p{L}\p{N}._%+-]"
_YEAR = "(?:19(?:0[4-9]|[1-9][0-9])|20[0-9]{2})"
_MONTH, _DAY = "(?:0[1-9]|1[0-2])", "(?:0[1-9]|[12][0-9]|3[01])"
#: In the order of trial at one place.
PATTERNS = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}}",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9])",
    "date": rf"(?<![0-9]){_YEAR}-{_MONTH}-{_DAY}(?![0-9])|(?<![0-9]){_YEAR}/{_MONTH}/{_DAY}(?![0-9])"
    rf"|(?<![0-9]){_DAY}\.{_MONTH}\.{_YEAR}(?![0-9])|(?<![0-9/]){_MONTH}/{_DAY}/{_YEAR}(?![0-9/])",
    "ssn": r"(?<![0-9\p{L}-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9\p{L}-])",
    "phone": r"(?<![0-9\p{L}])(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
    r"|\+[1-9][0-9]{0,2}(?:[ .-][0-9]{2,8}){2,4}|0[0-9]{2}[ -][0-9]{4}[ -][0-9]{4}|0[0-9]{3}[ -][0-9]{3}[ -][0-9]{4})(?![0-9\p{L}])",
    "card": r"(?<![0-9\p{L}])(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}|[0-9]{13,19})(?![0-9\p{L}])",
}
KINDS = tuple(PATTERNS)
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _let(value: Column, use) -> Column:
    """Evaluate ``value`` once and use it several times inside one expression."""
    return F.transform(F.array(value), use)[0]


def _chars(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substr(text, i, F.lit(1)))).otherwise(
        F.array().cast("array<string>")
    )


def feistel(symbols: Column, radices: Column, key: str, kind: str) -> Column:
    """Permute an array<int> of symbols below their radices (64 symbols at most)."""

    def round_(state: Column, number: Column) -> Column:
        def moves(x: Column, i: Column) -> Column:
            return (i + number) % 2 == 0

        still = F.filter(state, lambda x, i: ~moves(x, i))
        text = F.concat_ws("|", F.lit(key), F.lit(kind), number.cast("string"), F.size(state).cast("string"), F.concat_ws(",", still.cast("array<string>")))

        def shift(digest: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                part = F.substr(digest, (i / 2).cast("int") * 4 + 1, F.lit(4))
                moved = F.pmod(x + F.conv(part, 16, 10).cast("int"), F.get(radices, i))
                return F.when(moves(x, i), moved).otherwise(x).cast("int")

            return F.transform(state, one)

        return _let(F.sha2(text, 512), shift)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), symbols, round_)


_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _permuted_text(text: Column, key: str, kind: str) -> Column:
    """Digits become digits and A-Z, a-z letters of the same case; the rest stays."""

    def radix(c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1)

    def symbol(c: Column) -> Column:
        return (
            F.when(c.rlike("[0-9]"), F.ascii(c) - 48)
            .when(c.rlike("[a-z]"), F.ascii(c) - 97)
            .when(c.rlike("[A-Z]"), F.ascii(c) - 65)
            .otherwise(0)
        )

    def back(c: Column, s: Column) -> Column:
        return (
            F.when(c.rlike("[0-9]"), s.cast("string"))
            .when(c.rlike("[a-z]"), F.substr(F.lit(_LOWER), s + 1, F.lit(1)))
            .when(c.rlike("[A-Z]"), F.substr(F.lit(_UPPER), s + 1, F.lit(1)))
            .otherwise(c)
        )

    def chars(found: Column) -> Column:
        mixed = feistel(F.transform(found, symbol), F.transform(found, radix), key, kind)
        return F.array_join(F.zip_with(found, mixed, back), "")

    return _let(_chars(text), chars)


def _email(value: Column, key: str) -> Column:
    return F.concat(
        _permuted_text(F.substring_index(value, "@", 1), key, "email"), F.lit("@"), F.substring_index(value, "@", -1)
    )


def _phone(value: Column, key: str) -> Column:
    # a country's number, or the zero of a national one, stays
    country = F.regexp_extract(value, r"^(?:\+[0-9]{1,3}(?=[ .(-])[ .-]?|0(?=[0-9]{2}[ -][0-9]{4}[ -]|[0-9]{3}[ -]))", 0)
    rest = F.substr(value, F.length(country) + 1, F.length(value))
    digits = F.regexp_replace(rest, "[^0-9]", "")
    return F.concat(country, _refill(rest, _permuted_text(digits, key, "phone")))


def _refill(shape: Column, digits: Column) -> Column:
    """The digits of ``shape`` replaced in turn by those of ``digits``."""

    def one(i: Column) -> Column:
        c = F.substr(shape, i, F.lit(1))
        nth = F.length(F.regexp_replace(F.substr(shape, F.lit(1), i), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substr(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), one), "")


def _luhn(digits: Column, total: Column) -> Column:
    """Luhn sum of the leading digits of a number with ``total`` digits."""

    def weigh(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((total - 1 - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.transform(_chars(digits), weigh), F.lit(0), lambda a, x: a + x)


def _card(value: Column, key: str) -> Column:
    def fill(digits: Column) -> Column:
        n = F.length(digits)
        body = F.substr(digits, F.lit(1), n - 1)
        rest = F.pmod(_luhn(body, n) + F.substr(digits, n, F.lit(1)).cast("int"), F.lit(10))
        return _let(
            _permuted_text(body, key, "card"),
            lambda b: F.concat(b, F.pmod(rest - _luhn(b, n), F.lit(10)).cast("string")),
        )

    return _refill(value, _let(F.regexp_replace(value, "[^0-9]", ""), fill))


def _numbers(value: Column, separator: str) -> Column:
    return F.transform(F.split(value, separator), lambda x: x.cast("int"))


def _ip(value: Column, key: str) -> Column:
    mixed = feistel(_numbers(value, r"\."), F.array_repeat(F.lit(256), 4), key, "ip")
    return F.array_join(mixed.cast("array<string>"), ".")


def _ssn(value: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""
    parts = _numbers(value, "-")
    area = F.when(parts[0] > 666, parts[0] - 2).otherwise(parts[0] - 1)
    mixed = feistel(
        F.array(area, parts[1] - 1, parts[2] - 1), F.array(*map(F.lit, (898, 99, 9999))), key, "ssn"
    )

    def show(s: Column) -> Column:
        area = F.when(s[0] >= 665, s[0] + 2).otherwise(s[0] + 1)
        return F.format_string("%03d-%02d-%04d", area, s[1] + 1, s[2] + 1)

    return _let(mixed, show)


def _day(value: Column) -> Column:
    """The date a match of the date pattern means; null if there is no such day."""
    year_first = F.regexp_replace(value, r"^(..)\.(..)\.(....)$", "$3-$2-$1")
    year_first = F.regexp_replace(year_first, r"^(..)/(..)/(....)$", "$3-$1-$2")
    return F.replace(year_first, F.lit("/"), F.lit("-")).try_cast("date")


def _date(value: Column, key: str) -> Column:
    start = F.to_date(F.lit(DATE_START))
    high, low = DATE_RADICES

    def permute(day: Column) -> Column:
        symbols = F.array((day / low).cast("int"), day % low)
        mixed = feistel(symbols, F.array(F.lit(high), F.lit(low)), key, "date")

        def show(s: Column) -> Column:
            new = F.date_add(start, s[0] * low + s[1])
            shaped = F.when(value.contains("."), F.date_format(new, "dd.MM.yyyy"))
            shaped = shaped.when(value.rlike("^../"), F.date_format(new, "MM/dd/yyyy"))
            return shaped.when(value.contains("/"), F.date_format(new, "yyyy/MM/dd")).otherwise(
                F.date_format(new, "yyyy-MM-dd")
            )

        return _let(mixed, show)

    return _let(F.datediff(_day(value), start), permute)


REJECTED = "rejected"


def _kind(value: Column) -> Column:
    """The kind of a match; null for an impossible day and for a telephone
    number of the wrong length, ``rejected`` for a card number whose Luhn sum
    is no multiple of ten. All three stay as they are."""
    kind = F.lit(None).cast("string")
    for name in reversed(KINDS):
        kind = F.when(value.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(kind)

    def check(kind: Column) -> Column:
        digits = F.regexp_replace(value, "[^0-9]", "")
        wrong = (kind == "date") & _day(value).isNull() | (kind == "phone") & ~F.length(digits).between(8, 15)
        luhn = _let(digits, lambda d: F.pmod(_luhn(d, F.length(d)), F.lit(10)))
        return F.when(wrong, F.lit(None)).when((kind == "card") & (luhn != 0), REJECTED).otherwise(kind)

    return _let(kind, check)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id``, ``text`` with
    pseudonyms, ``n_email, n_ip, n_date, n_ssn, n_phone, n_card`` and
    ``n_rejected``.

    ``n_card`` counts numbers with a right Luhn sum, which the pseudonym
    keeps; ``n_rejected`` counts those of a card's form without it (order
    numbers, time stamps), which stay. Impossible dates and telephone numbers
    of fewer than 8 or more than 15 digits stay and are not counted. Text
    around a value never changes. Null texts stay null and empty texts empty,
    with counts 0; null ids and repeated rows are kept; an empty table gives
    no rows; other columns are ignored. Whole texts are searched.
    """
    permute = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}

    def pseudonym(found: Column) -> Column:
        value, kind = found["value"], found["kind"]
        chosen = value
        for name in KINDS:
            chosen = F.when(kind == name, permute[name](value, key)).otherwise(chosen)
        return chosen

    holds = F.coalesce(F.col("text").rlike("[0-9@]"), F.lit(False))
    matches = F.when(holds, F.regexp_extract_all("text", F.lit(_ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", matches.alias("values"))
    named = found.select(
        "doc_id", "text", F.transform("values", lambda v: F.struct(v.alias("value"), _kind(v).alias("kind"))).alias("found")
    )
    mapped = named.select("doc_id", "text", "found", F.transform("found", pseudonym).alias("pseudonyms"))
    pieces = F.zip_with(
        F.split("text", _ANY, -1),
        F.col("pseudonyms"),
        lambda piece, name: F.concat(piece, F.coalesce(name, F.lit(""))),
    )
    changed = F.when(F.size("found") > 0, F.array_join(pieces, "")).otherwise(F.col("text"))

    def count(name: str) -> Column:
        return F.size(F.filter("found", lambda f: f["kind"] == name)).cast("long").alias(f"n_{name}")

    return mapped.select("doc_id", changed.alias("text"), *map(count, (*KINDS, REJECTED)))
