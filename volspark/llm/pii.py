"""Format-preserving pseudonyms of numbers and dates, in DataFrame expressions only.

What looks like a card number, an account number (IBAN), a phone or social security number, an
IPv4 or IPv6 address or a date and passes its check (Luhn, check digits, number of digits,
valid ranges, calendar) is turned into its rank among all values of that format. A keyed Feistel network of eight rounds permutes the
ranks: the rank is cut in two, and in turn each part is shifted, modulo its own size, by a
keyed hash of the other. That is a bijection on the format's values, whatever the sizes, so
equal values get equal pseudonyms in every document, different values different ones, and a
pseudonym has its original's layout and passes the same check. E-mail addresses have no
finite format; their local part becomes a keyed hash, the domain stays. Days up to the 12th of
a month are permuted among those, later ones among later ones: a date has one pseudonym in all
layouts, and no text can stand for two. The key is a value of a one-row table, not of the
plan: ``explain`` and event logs do not show it.

A text is split at what was found and joined again around the pseudonyms, all inside its
row: no shuffle, no Python.

Defined cases: a null text stays null, with counts of 0; text without a find is returned as
it is; numbers that fail their check stay; equal rows give equal rows; an empty table gives
an empty result. Other columns are passed by.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

#: Names of months as texts write them, by language (fixed values).
MONTHS = tuple(
    tuple(names.split())
    for names in (
        "January February March April May June July August September October November December",
        "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec",
        "Januar Februar März April Mai Juni Juli August September Oktober November Dezember",
        "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
        "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    )
)
#: Every name in lower case: its place in the list above, of the first language that has it.
MONTH_AT = {
    names[i].lower(): 12 * j + i for j, names in reversed([*enumerate(MONTHS)]) for i in range(12)
}
#: What follows a day of the month as an ordinal, by its last digit (fixed values).
ORDINALS = "th st nd rd th th th th th th".split()

MONTH = "(?i:" + "|".join(sorted(MONTH_AT, key=lambda x: (-len(x), x))) + ")"
DAY = "[0-9]{1,2}(?:st|nd|rd|th|\\.)?"

#: Digits of a phone number in all, and of a national one that begins with 0, with few marks
#: between: they end where a group does.
LONG = r"[0-9](?:[ ./()-]{0,3}[0-9]){6,14}"
NATIONAL = (
    r"\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4}"
    r"|[0-9]{3} [0-9]{3} [0-9]{4}|\(0[0-9]{1,4}\)[ -]?[0-9]{3,8}(?:[ -][0-9]{2,5}){0,2}"
    r"|0[0-9]{1,4}(?:[ /-][0-9]{2,4}){2,4}"
)

#: What is looked for, in this order; a find has the kind of the first pattern it fits. The
#: groups of a phone number may have a few marks between them.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}"
    r"|[0-9]{4}\.[0-9]{2}\.[0-9]{2}|[0-9]{1,2}[/.-][0-9]{1,2}[/.-][0-9]{4})(?![0-9])"
    rf"|(?<![0-9./-]){DAY} (?:of |de )?{MONTH}\.?,? (?:de |del )?[0-9]{{4}}(?![0-9])"
    rf"|(?<![\p{{L}}\p{{N}}])(?=[JFMASONDjfmasonde]){MONTH}\.? {DAY},? [0-9]{{4}}(?![0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[0-9A-Z]{11,30}|(?: [0-9A-Z]{4}){2,7}(?: [0-9A-Z]{1,3})?)"
    r"(?![A-Za-z0-9])",
    "ipv6": r"(?<![\w:.])(?=[0-9A-Fa-f:]{0,38}[0-9])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9+])\+(?:1[^\p{L}\p{N}\n+]{0,6}[0-9]{3}[^\p{L}\p{N}\n+]{0,6}[0-9]{3}"
    r"[^\p{L}\p{N}\n+]{0,6}[0-9]{4}|" + LONG + r"|[0-9]{1,3}(?:[^\p{L}\p{N}\n+]{1,6}[0-9]{2,4}){2,4})"
    r"(?![0-9])|(?<![0-9+]|[0-9][ ./-])(?:" + NATIONAL + r")(?![0-9]|[./-][0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
FIND = "|".join(PATTERNS.values())
KINDS = tuple(PATTERNS)

#: The Gregorian cycle of 400 years: its first day here, its days and months (fixed values).
CYCLE_START, CYCLE_DAYS, CYCLE_MONTHS = "1800-01-01", 146_097, 4_800
#: Days that could also be months, up to the 12th, and those that could not, as two factors
#: each (fixed values).
EARLY_DAYS, EARLY, LATE = 12, (240, 240), (9, 9_833)

#: Areas of social security numbers (001 to 899 but 666), and groups times serials.
AREAS, REST = 898, 99 * 9_999


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def whole(text: Column) -> Column:
    """A text of digits as a long; 0 if there are none."""
    return F.coalesce(F.try_to_number(F.lpad(text, 18, "0"), F.lit("9" * 18)).cast("long"), F.lit(0))


def turned(a: Column, b: Column, m: Column, n: Column, key: Column, kind: Column) -> Column:
    """The Feistel network on a below m and b below n; ``kind`` keeps formats apart."""

    def turn(state: Column, number: Column) -> Column:
        name = F.concat_ws(":", key, kind, number.cast("string"), state["b"].cast("string"))
        shift = F.conv(F.substring(F.sha2(name, 256), 1, 12), 16, 10).cast("long")
        return F.struct(
            state["b"].alias("a"),
            F.pmod(state["a"] + shift, state["m"]).alias("b"),
            state["n"].alias("m"),
            state["m"].alias("n"),
        )

    start = F.struct(
        a.alias("a"), b.alias("b"), m.cast("long").alias("m"), n.cast("long").alias("n")
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def permuted(
    rank: Column, first: Column, second: Column, key: Column | str, kind: Column
) -> Column:
    """A permutation of 0 .. first * second - 1; ``key`` is a column or a text."""
    key = F.lit(key) if isinstance(key, str) else key
    state = turned(rank_div(rank, second), F.pmod(rank, second), first, second, key, kind)
    return with_value(state, lambda s: s["a"] * s["n"] + s["b"])


def rank_div(rank: Column, by: Column) -> Column:
    """Whole quotient of longs: the rest is taken off first, so the division is exact."""
    return ((rank - F.pmod(rank, by)) / by).cast("long")


def power(n: Column) -> Column:
    """10 to the n, 0 <= n <= 18, as a long."""
    return F.element_at(F.array(*[F.lit(10**i).cast("long") for i in range(19)]), n + 1)


def permuted_digits(number: Column, key: Column, kind: Column) -> Column:
    """A text of up to 18 digits permuted among those of its length."""
    n = F.length(number)
    half = F.floor(n / 2).cast("int")
    other = (n - half).cast("int")
    rank = permuted(whole(number), power(half), power(other), key, F.concat_ws("", kind, n))
    return F.lpad(rank.cast("string"), n, "0")


def luhn_sum(number: Column) -> Column:
    """Luhn sum of a text of digits, doubling every second digit from the one before last."""

    def add(total: Column, at: Column) -> Column:
        digit = F.substr(number, F.length(number) - at + 1, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(at % 2 == 0, twice).otherwise(digit)

    places = F.sequence(F.lit(1), F.length(number))
    return F.aggregate(places, F.lit(0), add)


def layout(original: Column, new: Column) -> Column:
    """``original`` with its digits replaced, one after the other, by those of ``new``."""

    def put(state: Column, char: Column) -> Column:
        is_digit = char.rlike("^[0-9]$")
        put_char = F.when(is_digit, F.substr(new, state["k"], F.lit(1))).otherwise(char)
        return F.struct(
            F.concat(state["out"], put_char).alias("out"),
            (state["k"] + F.when(is_digit, 1).otherwise(0)).alias("k"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    return F.aggregate(F.split(original, ""), start, put, lambda s: s["out"])


def card(match: Column, key: Column) -> Column:
    """Payload permuted, check digit anew; null unless the Luhn sum holds."""
    number = digits(match)
    body = F.substr(number, F.lit(1), F.length(number) - 1)
    new = permuted_digits(body, key, F.lit("card"))
    check = F.pmod(-luhn_sum(F.concat(new, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(luhn_sum(number) % 10 == 0, layout(match, F.concat(new, check)))


#: Country codes of one and two digits; all others have three.
COUNTRY = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def phone(match: Column, key: Column) -> Column:
    """All digits after the country code; null unless 7 to 15 digits in all.

    National numbers keep the 0 they begin with, or have ten digits: these are permuted like
    those after +1.
    """
    number = digits(match)
    country = F.when(match.startswith("+"), F.regexp_extract(number, COUNTRY, 1))
    country = country.otherwise(F.regexp_extract(number, "^(0?)", 1))
    rest = F.substr(number, F.length(country) + 1, F.length(number))
    new = F.concat(country, permuted_digits(rest, key, F.lit("phone")))
    return F.when(F.length(number).between(7, 15) & (F.length(rest) > 1), layout(match, new))


def ssn(match: Column, key: Column) -> Column:
    """Area 001 to 899 but 666, group and serial not zero, permuted among those."""
    area, group, serial = (
        whole(F.regexp_extract(match, r"^([0-9]+)-([0-9]+)-([0-9]+)$", i)) for i in (1, 2, 3)
    )
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    rank = place * F.lit(REST) + (group - 1) * F.lit(9_999) + serial - 1
    new = permuted(rank, F.lit(AREAS), F.lit(REST), key, F.lit("ssn"))

    def written(value: Column) -> Column:
        rest = F.pmod(value, F.lit(REST))
        place = rank_div(value, F.lit(REST))
        return F.concat_ws(
            "-",
            F.lpad((place + F.when(place >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
            F.lpad((rank_div(rest, F.lit(9_999)) + 1).cast("string"), 2, "0"),
            F.lpad((F.pmod(rest, F.lit(9_999)) + 1).cast("string"), 4, "0"),
        )

    return F.when(valid, with_value(new, written))


def with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, though used several times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def ip(match: Column, key: Column) -> Column:
    """Four numbers up to 255, permuted among all addresses."""
    parts = F.transform(F.split(match, r"\."), whole)
    rank = F.aggregate(parts, F.lit(0).cast("long"), lambda total, x: total * 256 + x)
    new = permuted(rank, F.lit(65_536), F.lit(65_536), key, F.lit("ip"))

    def written(value: Column) -> Column:
        return F.concat_ws(
            ".", *[F.pmod(F.shiftright(value, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]
        )

    return F.when(F.forall(parts, lambda x: x <= 255), with_value(new, written))


def date(match: Column, key: Column) -> Column:
    """A day of 1800 to 2199, permuted among those, written in the same order.

    Day before month is tried first where the year stands last, so what is read month first
    has a day after the 12th; its pseudonym has one, too, and is read in the same way. A
    month's name stays in its language, the letters after an ordinal follow the day.
    """
    first = F.lit(CYCLE_START).cast("date")
    parts = F.split(match, "[-/.]")
    name = F.lower(F.regexp_extract(match, MONTH, 0))
    at = F.element_at(F.create_map(*[F.lit(x) for pair in MONTH_AT.items() for x in pair]), name)
    day_of = r"(?<![0-9])[0-9]{1,2}(?![0-9])"
    named, year_first = name != "", match.rlike("^[0-9]{4}")

    def day(year: Column, month: Column, day: Column) -> Column:
        iso = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
        return F.to_date(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")))

    def part(i: int) -> Column:
        return F.get(parts, F.lit(i))

    day_first = day(part(2), part(1), part(0))
    month = (F.pmod(at, F.lit(12)) + 1).cast("string")
    in_name = day(
        F.regexp_extract(match, "[0-9]{4}", 0), month, F.regexp_extract(match, day_of, 0)
    )
    month_first = day(part(2), part(0), part(1))
    found = (
        F.when(named, in_name)
        .when(year_first, day(part(0), part(1), part(2)))
        .otherwise(F.coalesce(day_first, month_first))
    )
    padded = F.length(match) == 10

    def written(moved: Column) -> Column:
        year, short = F.date_format(moved, "yyyy"), F.date_format(moved, "d")
        days = F.when(padded, F.date_format(moved, "dd")).otherwise(short)
        months = F.date_format(moved, "MM")
        months = F.when(padded, months).otherwise(F.date_format(moved, "M"))
        mark = F.regexp_extract(match, "[-/.]", 0)
        names = F.array(*[F.lit(x) for names in MONTHS for x in names])
        other = F.element_at(names, at - F.pmod(at, F.lit(12)) + F.month(moved))
        number = F.dayofmonth(moved)
        ending = F.when(number.between(11, 13), "th").otherwise(
            F.element_at(F.array(*[F.lit(x) for x in ORDINALS]), F.pmod(number, F.lit(10)) + 1)
        )
        text = F.regexp_replace(match, F.lit(day_of + "(?:st|nd|rd|th)"), F.concat(short, ending))
        text = F.when(match.rlike("[0-9](?:st|nd|rd|th)"), text).otherwise(
            F.regexp_replace(match, F.lit(day_of), short)
        )
        text = F.regexp_replace(text, F.lit("[0-9]{4}"), year)
        return (
            F.when(named, F.regexp_replace(text, F.lit(MONTH), other))
            .when(year_first, F.concat(year, mark, months, mark, days))
            .when(day_first.isNotNull(), F.concat(days, mark, months, mark, year))
            .otherwise(F.concat(months, mark, days, mark, year))
        )

    def months(day: Column) -> Column:
        return (F.year(day) - F.year(first)) * 12 + F.month(day) - 1

    def early_day(rank: Column) -> Column:
        month = rank_div(rank, F.lit(EARLY_DAYS)).cast("int")
        return F.date_add(F.add_months(first, month), F.pmod(rank, F.lit(EARLY_DAYS)).cast("int"))

    def late_day(rank: Column) -> Column:
        """The later day of that rank: its month is next to the one by the average."""
        guess = F.floor(rank * CYCLE_MONTHS / (LATE[0] * LATE[1])).cast("int")

        def of_month(month: Column) -> Column:
            begin = F.add_months(first, month)
            place = rank - (F.datediff(begin, first) - EARLY_DAYS * month)
            size = F.dayofmonth(F.last_day(begin)) - EARLY_DAYS
            return F.when(
                (place >= 0) & (place < size), F.date_add(begin, (place + EARLY_DAYS).cast("int"))
            )

        return F.coalesce(*[of_month(guess + k) for k in (0, -1, 1)])

    def moved(day: Column) -> Column:
        number = F.datediff(day, first).cast("long")
        early_rank = months(day) * F.lit(EARLY_DAYS).cast("long") + F.dayofmonth(day) - 1
        late_rank = number - EARLY_DAYS * (months(day) + 1)
        early = permuted(early_rank, F.lit(EARLY[0]), F.lit(EARLY[1]), key, F.lit("early date"))
        late = permuted(late_rank, F.lit(LATE[0]), F.lit(LATE[1]), key, F.lit("late date"))
        new = F.when(F.dayofmonth(day) <= EARLY_DAYS, with_value(early, early_day)).otherwise(
            with_value(late, late_day)
        )
        return F.when(number.between(0, CYCLE_DAYS - 1), with_value(new, written))

    return with_value(found, moved)


def two_halves(text: Column, base: int, key: Column, kind: str) -> Column:
    """A text of up to 30 digits (base 10) or 28 (base 16) permuted among those of its length."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    other = (n - half).cast("int")
    sizes = F.array(*[F.lit(base**i).cast("long") for i in range(16 if base == 10 else 15)])

    def value(part: Column) -> Column:
        return F.coalesce(F.conv(part, base, 10).cast("long"), F.lit(0).cast("long"))

    parts = value(F.substr(text, F.lit(1), half)), value(F.substr(text, half + 1, other))
    size = F.element_at(sizes, half + 1), F.element_at(sizes, other + 1)
    state = turned(*parts, *size, key, F.concat_ws("", F.lit(kind), n.cast("string")))

    def written(s: Column) -> Column:
        return F.concat(
            *[
                F.lpad(F.lower(F.conv(s[name].cast("string"), 10, base)), width, "0")
                for name, width in (("a", half), ("b", other))
            ]
        )

    return with_value(state, written)


def rest_97(text: Column) -> Column:
    """A text of digits and capitals, these as 10 to 35, as a number modulo 97."""

    def add(total: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code >= 65, (total * 100 + code - 55) % 97).otherwise(
            (total * 10 + code - 48) % 97
        )

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), add)


def iban(match: Column, key: Column) -> Column:
    """Digits of the account permuted, check digits anew; country and letters stay."""
    whole_text = F.regexp_replace(match, " ", "")
    country, account = F.substring(whole_text, 1, 2), F.substring(whole_text, 5, 30)
    new = layout(account, two_halves(digits(account), 10, key, "iban"))
    check = 98 - rest_97(F.concat(new, country, F.lit("00")))
    text = F.concat(F.lpad(check.cast("string"), 2, "0"), new)
    # its letters stay where they are, so only digits are put in
    valid = rest_97(F.concat(account, F.substring(whole_text, 1, 4))) == 1
    enough = F.length(digits(account)) > 1
    return F.when(valid & enough, layout(match, digits(text)))


def ipv6(match: Column, key: Column) -> Column:
    """The groups behind the first, permuted; however it is written, an address is one value.

    What has no digit is taken for a name, as in ``cafe::add``.
    """
    halves = F.split(F.lower(match), "::")

    def groups(i: int) -> Column:
        half = F.coalesce(F.get(halves, F.lit(i)), F.lit(""))
        return F.filter(F.split(half, ":"), lambda g: g != "")

    known = F.size(groups(0)) + F.size(groups(1))
    short = F.size(halves) == 2
    filled = F.concat(
        groups(0), F.array_repeat(F.lit("0"), F.greatest(8 - known, F.lit(0))), groups(1)
    )
    text = F.array_join(F.transform(filled, lambda g: F.lpad(g, 4, "0")), "")
    new = F.concat(F.substring(text, 1, 4), two_halves(F.substring(text, 5, 28), 16, key, "ipv6"))

    def written(value: Column) -> Column:
        places = F.sequence(F.lit(1), F.lit(29), F.lit(4))
        group = F.transform(places, lambda at: F.substr(value, at, F.lit(4)))
        return F.array_join(F.transform(group, lambda g: F.regexp_replace(g, "^0{1,3}", "")), ":")

    # a colon alone at either end is none of an address
    ends = match.rlike("^:(?!:)|(?<!:):$")
    valid = (short & (known < 8) | ~short & (known == 8)) & (F.size(halves) < 3) & ~ends
    return F.when(valid, with_value(new, written))


def email(match: Column, key: Column) -> Column:
    local = F.substring_index(match, "@", 1)
    name = F.sha2(F.concat_ws(":", key, F.lit("email"), F.lower(match)), 256)
    return F.concat(
        F.substr(name, F.lit(1), F.greatest(F.length(local), F.lit(12))),
        F.lit("@"),
        F.substring_index(match, "@", -1),
    )


REPLACE = {
    "email": email,
    "date": date,
    "iban": iban,
    "ipv6": ipv6,
    "ip": ip,
    "ssn": ssn,
    "phone": phone,
    "card": card,
}


def replaced(match: Column, key: Column) -> Column:
    """(kind, text) of a find: its pseudonym, or null kind and itself if it is not valid."""
    out = F.lit(None).cast("struct<kind:string,text:string>")
    for kind in reversed(KINDS):
        new = REPLACE[kind](match, key)
        done = F.struct(F.when(new.isNotNull(), F.lit(kind)).alias("kind"), F.coalesce(new, match).alias("text"))
        out = F.when(match.rlike(f"^(?:{PATTERNS[kind]})$"), done).otherwise(out)
    same = F.struct(F.lit(None).cast("string").alias("kind"), match.alias("text"))
    return F.coalesce(out, same)


def pseudonyms(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text with pseudonyms, n_<kind> and n_found of every row."""
    secret = docs.sparkSession.createDataFrame(pa.table({"key": [key]}))
    has = F.coalesce(F.col("text").rlike("[0-9@]"), F.lit(False))
    found = docs.select("doc_id", "text", secret.scalar().alias("key")).withColumn(
        "found",
        F.when(
            has,
            F.transform(
                F.regexp_extract_all("text", F.lit(FIND), F.lit(0)), lambda m: replaced(m, F.col("key"))
            ),
        ).otherwise(F.array().cast("array<struct<kind:string,text:string>>")),
    )
    between = F.split("text", FIND, -1)
    pieces = F.zip_with(
        between,
        F.col("found"),
        lambda plain, new: F.concat(plain, F.coalesce(new["text"], F.lit(""))),
    )
    text = F.when(F.size("found") > 0, F.array_join(pieces, "")).otherwise(F.col("text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda f: f["kind"].eqNullSafe(F.lit(kind)))).cast("long")

    every = F.size(F.filter("found", lambda f: f["kind"].isNotNull())).cast("long")
    return found.select(
        "doc_id",
        text.alias("text"),
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        every.alias("n_found"),
    )
