"""Replace personal data by pseudonyms of the same format.

Finds mail addresses, IPv4 addresses, dates, bank accounts (IBAN), social security, card and phone
numbers in whole texts. Each is checked (octets, calendar, check digits, digit counts) and replaced by a
keyed permutation within its format: an alternating Feistel network over the two halves of the value,
whose round function is SHA-512 of the key, the kind, the round and the other half. Letters turn into
letters of the same case, digits into digits, other signs stay; dates become dates of the years 1900 to
2099, addresses stay addresses, and check digits are computed anew. The same value gets the same
pseudonym in every document, however it is spaced, and different values get different ones.

An account number has the length that its country gives. Of a run of 13 to 19 digits the longest part
from its start, up to a space or dash, that passes the card check is a card, and the search goes on behind it. A run
without such a part is an account number of unknown kind and is permuted without a check digit.

Only DataFrame functions are used, no row is moved. Defined cases: null text stays null; text without
personal data stays as it is, to the character; invalid dates stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.llm.common import let

ROUNDS = 8
KEY = "change-me"
"""Parameter: the secret of the permutation."""

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
EMAIL = r"[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
ADDRESS = rf"{OCTET}(?:\.{OCTET}){{3}}"
ISO_DATE = r"(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}"
DATE = r"[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)[0-9]{2}"
# Length of an account by country, from the registry of IBANs.
LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def account(length: int, countries: str) -> str:
    fours, rest = divmod(length - 4, 4)
    return (f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else ""))


LISTED = "|".join(LENGTHS.values()).replace(" ", "|")
IBAN = "(?:" + "|".join([account(*x) for x in LENGTHS.items()] + [
    rf"(?!{LISTED})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"]) + ")"
SOCIAL = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
NUMBER = r"[0-9](?:[ -]?[0-9]){12,18}"
PHONE = r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}"
PLAIN_PHONE = r"\+[0-9]{8,15}"
AFTER = r"(?![0-9A-Za-z]|[.-][0-9])"
AFTER_DATE = r"(?!(?!T[0-9]{2})[0-9A-Za-z]|[.-][0-9])"
ANY = "|".join([
    rf"(?<![A-Za-z0-9._%+-]){EMAIL}",
    rf"(?<![0-9A-Za-z])(?<![0-9][.-])(?:(?:{ISO_DATE}|{DATE}){AFTER_DATE}|(?:{ADDRESS}|{SOCIAL}){AFTER})",
    rf"(?<![0-9A-Za-z]){IBAN}(?![0-9A-Za-z])",
    rf"(?<![0-9A-Za-z])(?<![0-9][.-]){NUMBER}{AFTER}",
    rf"(?<![0-9A-Za-z+])(?:{PHONE}|{PLAIN_PHONE}){AFTER}",
])
CARD_END = "\x02\x03\x03\x02\x03\x02"
"""Stands for a while behind a card that other digits follow."""
MAYBE = r"@|[0-9][0-9 .()/-]*[0-9]"
KINDS = ("email", "address", "date", "iban", "social", "number", "phone")
# Days of the years 1900 to 2099, as a product.
DAYS, SLOTS = 4297, 17


def whole(p: str) -> str:
    return f"^(?:{p})$"


def kind_of(m: Column) -> Column:
    kind = F.lit("phone")
    for name, pattern in (("number", NUMBER), ("social", SOCIAL), ("iban", IBAN), ("date", f"{ISO_DATE}|{DATE}"),
                          ("address", ADDRESS), ("email", EMAIL)):
        kind = F.when(m.rlike(whole(pattern)), name).otherwise(kind)
    return kind


def digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]).cast("binary"), 512)


def steps(n: Column) -> Column:
    """1 to n; empty for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def shifted(half: Column, stream: Column) -> Column:
    """Move each letter or digit within its own kind by two hexadecimal digits of the stream."""

    def one(j: Column) -> Column:
        c = F.substr(half, j, F.lit(1))
        code = F.ascii(c)
        by = F.conv(F.substr(stream, (j * 2 - 1) % 128, F.lit(2)), 16, 10).cast("int") + j
        turn = lambda base, size: F.char(F.lit(base) + (code - base + by) % size)
        return (F.when(code.between(48, 57), turn(48, 10)).when(code.between(65, 90), turn(65, 26))
                .when(code.between(97, 122), turn(97, 26)).otherwise(c))

    return F.array_join(F.transform(steps(F.length(half)), one), "")


def permuted(value: Column, kind: str, key: str) -> Column:
    """Alternating Feistel network over the halves of a string; its pattern of letters and digits stays."""

    def run(v: Column) -> Column:
        cut = F.floor(F.length(v) / 2).cast("int")
        start = F.struct(F.substr(v, F.lit(1), cut).alias("a"), F.substr(v, cut + 1, F.length(v)).alias("b"))

        def turn(state: Column, i: Column) -> Column:
            other = F.when(i % 2 == 0, state["b"]).otherwise(state["a"])
            moved = shifted(F.when(i % 2 == 0, state["a"]).otherwise(state["b"]),
                            digest(key, F.lit(kind), i, F.length(v), other))
            return let(moved, lambda x: F.struct(
                F.when(i % 2 == 0, x).otherwise(state["a"]).alias("a"),
                F.when(i % 2 == 0, state["b"]).otherwise(x).alias("b")))

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["a"], s["b"]))

    return let(value, run)


def permuted_pair(a: Column, b: Column, size_a: int, size_b: int, kind: str, key: str) -> Column:
    """The same network over two numbers, a below ``size_a`` and b below ``size_b``; a struct (a, b)."""

    def turn(state: Column, i: Column) -> Column:
        word = lambda x: F.conv(F.substr(digest(key, F.lit(kind), i, x), F.lit(1), F.lit(12)), 16, 10).cast("long")
        return F.struct(
            F.when(i % 2 == 0, (state["a"] + word(state["b"])) % size_a).otherwise(state["a"]).alias("a"),
            F.when(i % 2 == 1, (state["b"] + word(state["a"])) % size_b).otherwise(state["b"]).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def plain(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9A-Z]", "")


def laid_out(like: Column, signs: Column) -> Column:
    """Put letters and digits into the places that letters and digits have in ``like``."""

    def one(j: Column) -> Column:
        c = F.substr(like, j, F.lit(1))
        place = F.length(plain(F.substr(like, F.lit(1), j)))
        return F.when(c.rlike("[0-9A-Z]"), F.substr(signs, place, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(steps(F.length(like)), one), "")


def luhn(digits: Column) -> Column:
    """Sum of a digit string by the card rule, check digit last."""

    def one(total: Column, j: Column) -> Column:
        d = F.substr(digits, F.length(digits) - j + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(j % 2 == 0, twice).otherwise(d)

    return F.aggregate(steps(F.length(digits)), F.lit(0), one)


def number(m: Column, key: str) -> Column:
    def run(d: Column) -> Column:
        body = permuted(F.substr(d, F.lit(1), F.length(d) - 1), "card", key)
        checked = let(body, lambda b: F.concat(b, ((10 - luhn(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
        return F.when(luhn(d) % 10 == 0, checked).otherwise(permuted(d, "account", key))

    return laid_out(m, let(plain(m), run))


def phone(m: Column, key: str) -> Column:
    """The last ten digits, without those of a country code, move; a text of fewer than seven stays."""
    def run(d: Column) -> Column:
        n = F.least(F.length(d), F.lit(10))
        moved = F.concat(F.substr(d, F.lit(1), F.length(d) - n), permuted(F.substr(d, F.length(d) - n + 1, n), "phone", key))
        return F.when(F.length(d).between(7, 15), moved).otherwise(d)

    return laid_out(m, let(plain(m), run))


def rest_97(signs: Column) -> Column:
    """Remainder by 97 of an account whose letters count 10 to 35."""

    def one(rest: Column, j: Column) -> Column:
        code = F.ascii(F.substr(signs, j, F.lit(1)))
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(steps(F.length(signs)), F.lit(0), one)


def iban(m: Column, key: str) -> Column:
    def run(d: Column) -> Column:
        country, body = F.substr(d, F.lit(1), F.lit(2)), F.substr(d, F.lit(5), F.length(d))
        valid = rest_97(F.concat(body, F.substr(d, F.lit(1), F.lit(4)))) == 1
        moved = let(permuted(body, "iban", key), lambda b: F.concat(
            country, F.lpad((98 - rest_97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b))
        return F.when(valid, moved).otherwise(d)

    return laid_out(m, let(plain(m), run))


def address(m: Column, key: str) -> Column:
    def run(o: Column) -> Column:
        part = lambda i: F.element_at(o, i).cast("long")
        pair = permuted_pair(part(1) * 256 + part(2), part(3) * 256 + part(4), 65536, 65536, "address", key)
        return let(pair, lambda p: F.concat_ws(".", *[x.cast("string") for x in (
            F.floor(p["a"] / 256), p["a"] % 256, F.floor(p["b"] / 256), p["b"] % 256)]))

    return let(F.split(m, r"\."), run)


def date(m: Column, key: str) -> Column:
    """Year first, or last with the day before the month unless only the other order is a date."""
    def run(p: Column) -> Column:
        first, second, third = (F.element_at(p, i) for i in (1, 2, 3))
        sign = F.regexp_extract(m, "[-/.]", 0)
        sign2 = F.regexp_extract(m, "[-/.][0-9]+([-/.])", 1)
        iso = F.length(first) == 4
        def day(y, mo, d):
            return F.try_to_date(F.concat_ws("-", y, F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")

        def moved(x: Column) -> Column:
            n = F.datediff(x["on"], F.lit("1900-01-01").cast("date")).cast("long")
            pair = permuted_pair(F.floor(n / DAYS), n % DAYS, SLOTS, DAYS, "date", key)
            new = let(pair, lambda q: F.date_add(F.lit("1900-01-01").cast("date"), (q["a"] * DAYS + q["b"]).cast("int")))

            def written(value: Column, like: Column) -> Column:
                text = value.cast("string")
                return F.when(F.length(like) == 2, F.lpad(text, 2, "0")).otherwise(text)

            def out(d: Column) -> Column:
                y = F.year(d).cast("string")
                return (F.when(iso, F.concat(y, sign, written(F.month(d), second), sign2, written(F.day(d), third)))
                        .when(x["month_first"], F.concat(written(F.month(d), first), sign, written(F.day(d), second), sign2, y))
                        .otherwise(F.concat(written(F.day(d), first), sign, written(F.month(d), second), sign2, y)))

            return F.when(x["on"].isNotNull(), let(new, out)).otherwise(m)

        by_day = day(third, second, first)
        on = F.when(iso, day(first, second, third)).otherwise(F.coalesce(by_day, day(third, first, second)))
        return let(F.struct(on.alias("on"), (~iso & by_day.isNull()).alias("month_first")), moved)

    return let(F.split(m, "[-/.]"), run)


def email(m: Column, key: str) -> Column:
    """Name and host move, the last label of the host stays."""
    return F.concat(permuted(F.regexp_extract(m, r"^(.*)@", 1), "name", key), F.lit("@"),
                    permuted(F.regexp_extract(m, r"@(.*)\.[^.]*$", 1), "host", key), F.regexp_extract(m, r"(\.[^.]*)$", 1))


MAKERS: dict[str, Callable[[Column, str], Column]] = {
    "email": email, "address": address, "date": date, "iban": iban, "number": number, "phone": phone,
    "social": lambda m, key: laid_out(m, permuted(plain(m), "social", key)),
}


def pseudonym(m: Column, key: str) -> Column:
    kind = kind_of(m)
    out = m
    for name, make in MAKERS.items():
        out = F.when(kind == name, make(m, key)).otherwise(out)
    return out


def card_length(m: Column) -> Column:
    """Length of the longest part of a number, up to a space or dash in it, that is a card; null if there is none
    or the whole number is a card."""
    def ends(j: Column) -> Column:
        d = plain(F.substr(m, F.lit(1), j))
        return F.substr(m, j + 1, F.lit(1)).isin(" ", "-") & (F.length(d) >= 13) & (luhn(d) % 10 == 0)

    at = F.filter(F.sequence(F.length(m) - 1, F.lit(12), F.lit(-1)), ends)
    return F.when((F.length(m) > 14) & m.rlike("[ -]") & m.rlike(whole(NUMBER)) & (luhn(plain(m)) % 10 != 0), F.get(at, F.lit(0)))


def parted(text: Column, matches: Column) -> Column:
    """The text with ``CARD_END`` between a card and digits that only follow it."""
    cut = F.transform(matches, card_length)

    def marked(m: Column, n: Column) -> Column:
        return F.when(n.isNull(), m).otherwise(F.concat(F.substr(m, F.lit(1), n), F.lit(CARD_END), F.substr(m, n + 1, F.length(m))))

    return let(cut, lambda c: F.when(F.exists(c, lambda n: n.isNotNull()) & ~F.contains(text, F.lit(CARD_END)),
                                     joined(text, F.zip_with(matches, c, marked))).otherwise(text))


def rewritten(text: Column, matches: Column, key: str) -> Column:
    return joined(text, F.transform(matches, lambda m: pseudonym(m, key)))


def joined(text: Column, new: Column) -> Column:
    """The text with other values in place of its matches."""
    between = F.split(text, ANY, -1)
    return let(between, lambda p: F.concat(p[0], F.array_join(F.zip_with(
        new, F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda m, rest: F.concat(m, rest)), "")))


def pseudonymise(documents: DataFrame, key: str = KEY, counts: bool = False) -> DataFrame:
    """The documents with rewritten ``text`` (and ``n_chars``, where there is such a column); with
    ``counts`` also the number of matches of each kind."""
    names = documents.columns
    text = F.col("text")
    found = lambda t: F.regexp_extract_all(t, F.lit(ANY), F.lit(0))
    first = F.when(text.rlike(MAYBE), found(text)).otherwise(F.array().cast("array<string>"))
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"), text, first.alias("__first"))
    rows = rows.withColumn("__parted", F.when(F.size("__first") > 0, parted(text, F.col("__first"))).otherwise(text))
    again = F.col("__parted") != text
    rows = rows.withColumn("__found", F.when(again, found(F.col("__parted"))).otherwise(F.col("__first")))
    new = F.when(F.size("__found") > 0, rewritten(F.col("__parted"), F.col("__found"), key)).otherwise(text)
    new = F.when(again, F.replace(new, F.lit(CARD_END), F.lit(""))).otherwise(new)
    rows = rows.select("__row", "__found", new.alias("text"))
    out = []
    for c in names:
        own = F.col("__row").getField(c)
        if c == "n_chars":
            own = F.when(F.size("__found") > 0, F.char_length("text").cast(documents.schema[c].dataType)).otherwise(own)
        out.append(F.col("text") if c == "text" else own.alias(c))
    if counts:
        kinds = F.transform("__found", kind_of)
        rows = rows.withColumn("__kinds", kinds)
        out += [(F.size("__kinds") - F.size(F.array_remove("__kinds", name))).cast("long").alias(f"n_{name}") for name in KINDS]
    return rows.select(*out)
