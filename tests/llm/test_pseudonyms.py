"""Pseudonyms against plain Python, and no two values with one pseudonym."""

import ipaddress
import random
import re
from datetime import date, timedelta
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from volspark.llm import pii

KEY = "k3y"
FIRST = date(1800, 1, 1)


def turned(a, b, m, n, kind):
    for number in range(1, 9):
        shift = int(sha256(f"{KEY}:{kind}:{number}:{b}".encode()).hexdigest()[:12], 16)
        a, b, m, n = b, (a + shift) % m, n, m
    return a, b, n


def permuted(rank, m, n, kind):
    a, b, n = turned(rank // n, rank % n, m, n, kind)
    return a * n + b


def put(original, digits):
    digits = iter(digits)
    return "".join(next(digits) if c in "0123456789" else c for c in original)


def luhn(number):
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(number)))) % 10


def digits_of(number, kind):
    n = len(number)
    half = n // 2
    return str(permuted(int(number), 10**half, 10 ** (n - half), f"{kind}{n}")).rjust(n, "0")


def card(text):
    number = re.sub(r"\D", "", text)
    if luhn(number):
        return None
    body = digits_of(number[:-1], "card")
    return put(text, body + str(-luhn(body + "0") % 10))


def ssn(text):
    area, group, serial = map(int, text.split("-"))
    if not (1 <= area <= 899 and area != 666 and group and serial):
        return None
    rank = (area - 1 - (area > 666)) * 99 * 9999 + (group - 1) * 9999 + serial - 1
    new = permuted(rank, 898, 99 * 9999, "ssn")
    place, rest = divmod(new, 99 * 9999)
    return f"{place + (2 if place >= 665 else 1):03}-{rest // 9999 + 1:02}-{rest % 9999 + 1:04}"


def ip(text):
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255:
        return None
    new = permuted(int.from_bytes(bytes(parts), "big"), 65536, 65536, "ip")
    return str(ipaddress.IPv4Address(new))


def ipv6(text):
    if not re.search("[0-9]", text):
        return None
    try:
        digits = f"{int(ipaddress.IPv6Address(text)):032x}"
    except ValueError:
        return None
    rest = digits[4:]
    a, b, _ = turned(int(rest[:14], 16), int(rest[14:], 16), 16**14, 16**14, "ipv628")
    digits = digits[:4] + f"{a:014x}{b:014x}"
    return ":".join(f"{int(digits[i:i + 4], 16):x}" for i in range(0, 32, 4))


def rest_97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def iban(text):
    whole = text.replace(" ", "")
    account = whole[4:]
    digits = re.sub(r"\D", "", account)
    if rest_97(account + whole[:4]) != 1 or len(digits) < 2:
        return None
    half = len(digits) // 2
    other = len(digits) - half
    a, b, _ = turned(int(digits[:half]), int(digits[half:]), 10**half, 10**other, f"iban{len(digits)}")
    new = f"{a:0{half}}{b:0{other}}"
    check = 98 - rest_97(put(account, new) + whole[:2] + "00")
    return put(text, f"{check:02}{new}")


LATE_DAYS = [d for i in range(146_097) if (d := FIRST + timedelta(days=i)).day > 12]
LATE_RANK = {d: i for i, d in enumerate(LATE_DAYS)}


def day(text):
    """Numeric layouts with the year last."""
    mark = text[-5]
    first, second, year = map(int, text.split(mark))
    for month_first, (d, m) in enumerate(((first, second), (second, first))):
        try:
            value = date(year, m, d)
        except ValueError:
            continue
        if not 1800 <= year < 2200:
            return None
        if value.day > 12:
            new = LATE_DAYS[permuted(LATE_RANK[value], 9, 9833, "late date")]
        else:
            rank = ((value.year - 1800) * 12 + value.month - 1) * 12 + value.day - 1
            month, day_ = divmod(permuted(rank, 240, 240, "early date"), 12)
            new = date(1800 + month // 12, month % 12 + 1, day_ + 1)
        parts = (new.month, new.day) if month_first else (new.day, new.month)
        wide = 2 if len(text) == 10 else 1
        return mark.join([*(f"{p:0{wide}}" for p in parts), str(new.year)])
    return None


def made(seed=4, n=120):
    """(kind, text) of values that are valid or nearly so."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        number = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(14))
        number += str(rng.choice([-luhn(number + "0") % 10, rng.randrange(10)]))
        out.append((card, rng.choice([number, " ".join(number[i : i + 4] for i in range(0, 16, 4))])))
        out.append((ssn, f"{rng.randrange(1000):03}-{rng.randrange(100):02}-{rng.randrange(10000):04}"))
        out.append((ip, ".".join(str(rng.randrange(rng.choice([256, 300]))) for _ in range(4))))
        address = ipaddress.IPv6Address(rng.getrandbits(128) & rng.choice([2**128 - 1, 0xFFFF << 112 | 0xFF]))
        out.append((ipv6, rng.choice([str(address), address.exploded])))
        country = rng.choice(["DE", "GB", "FR"])
        account = ("WEST" if country == "GB" else "") + "".join(rng.choice("0123456789") for _ in range(rng.choice([14, 18, 23])))
        check = rng.choice([98 - rest_97(account + country + "00"), 11])
        whole = f"{country}{check:02}{account}"
        out.append((iban, rng.choice([whole, whole])))
        d, m = rng.randrange(1, 32), rng.randrange(1, 32)
        mark, wide = rng.choice("/.-"), rng.choice([1, 2])
        out.append((day, mark.join([f"{d:0{wide}}", f"{m:0{wide}}", str(rng.randrange(1790, 2210))])))
    return out


def test_equal_to_plain_python(spark):
    values = made()
    docs = spark.createDataFrame(
        [(i, f"x {text}, y") for i, (_, text) in enumerate(values)], "doc_id long, text string"
    )
    found = {r.doc_id: r.text[2:-3] for r in pii.pseudonyms(docs, KEY).collect()}
    replaced = 0
    for i, (plain, text) in enumerate(values):
        wanted = plain(text)
        replaced += wanted is not None
        assert found[i] == (text if wanted is None else wanted), (plain.__name__, text)
    assert replaced > len(values) / 3


def test_grouped_account_numbers(spark):
    rows = [(1, "DE89 3704 0044 0532 0130 00"), (2, "DE89370400440532013000"), (3, "DE88 3704 0044 0532 0130 00")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in pii.pseudonyms(docs, KEY).collect()}
    assert found[1] == iban(rows[0][1]) and found[1].replace(" ", "") == found[2] == iban(rows[1][1])
    assert found[3] == rows[2][1]


@pytest.mark.parametrize("layout", ["MM/dd/yyyy", "d.M.yyyy", "MMM d, yyyy"])
def test_no_two_dates_share_a_pseudonym(spark, layout):
    """All days of 40 years; written month first, beside the same days written day first, the
    one text for which both agree."""
    days = spark.range(40 * 365, numPartitions=4).select(
        F.date_add(F.lit("1990-01-01"), F.col("id").cast("int")).alias("day")
    )
    layouts = [layout, *["dd/MM/yyyy"] * (layout == "MM/dd/yyyy")]
    texts = F.explode(F.array(*[F.date_format("day", x) for x in layouts])).alias("text")
    docs = days.select(texts).distinct().withColumn("doc_id", F.xxhash64("text"))
    found = pii.pseudonyms(docs, KEY).select("text", "n_date").toPandas()
    assert len(found) == found.text.nunique() == found.n_date.sum()
    shape = r"[A-Z][a-z]+ \d+, \d{4}" if "MMM" in layout else re.sub("[dMy]+", r"\\d+", layout)
    assert found.text.str.fullmatch(shape).all()


def test_ordinals_follow_the_day(spark):
    texts = [f"{d}{'st' if d in (1, 21, 31) else 'nd' if d in (2, 22) else 'rd' if d in (3, 23) else 'th'} March {y}" for d in range(1, 32) for y in (1999, 2024)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [r.text for r in pii.pseudonyms(docs, KEY).collect()]
    assert len(set(found)) == len(texts)
    for text in found:
        number, ending = re.match(r"(\d+)(st|nd|rd|th) [A-Z][a-z]+ \d{4}$", text).groups()
        wanted = {1: "st", 2: "nd", 3: "rd"}.get(int(number) % 10, "th")
        assert ending == ("th" if 11 <= int(number) <= 13 else wanted)


def test_the_key_is_not_in_the_plan(spark, some_docs):
    found = pii.pseudonyms(some_docs, "a very secret key")
    found.count()
    assert "a very secret key" not in found._jdf.queryExecution().toString()
