"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Found values are validated first: card numbers by their check digit, social security numbers by their ranges,
addresses by their octets, dates by the calendar. A valid value is permuted within its format by a keyed Feistel
network on a domain u * v: rounds add a keyed hash of one part to the other, modulo its size. That is a bijection, so
different values stay different, equal values get equal pseudonyms in all documents, and results are valid again.

- card: all digits but the check digit, which is computed anew; separators stay
- ssn: area (898 valid ones) and the rest; separators stay
- phone: the last ten digits; country code and separators stay
- ip: two and two octets
- date: days within the value's 400 years of the calendar, written in the value's own form. A two-digit pair that can
  only be month before day is permuted among its like by walking the cycle on
- email: a keyed hash as local part in a reserved domain

Invalid look-alikes stay as they are. Null texts stay null and have no finds; every row gives one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import id_and_text

KINDS = ("email", "date", "ip", "ssn", "phone", "card")
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "date": r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}([./-])[0-9]{2}\1[0-9]{4})(?![0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?|\(?[0-9]{3}\)?[ .-])[0-9]{3}[ .-]?[0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
ANY = "|".join(PATTERNS.values())
ROUNDS = 8
ERA = 146_097  # days in 400 years, 27 * 5411
FIRST_DAY = "0001-01-01"


def permuted(u: Column, v: Column, size_u: Column | int, size_v: Column | int, key: str) -> Column:
    """(u, v) after the Feistel rounds, as a struct."""
    size_u, size_v = (F.lit(s).cast("long") for s in (size_u, size_v))

    def keyed(round_: Column, other: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), size_u.cast("string"), size_v.cast("string"), round_.cast("string"), other.cast("string")), 256)
        return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")

    def step(done: Column, round_: Column) -> Column:
        left = F.struct(F.pmod(done.u + keyed(round_, done.v), size_u).alias("u"), done.v.alias("v"))
        right = F.struct(done.u.alias("u"), F.pmod(done.v + keyed(round_, done.u), size_v).alias("v"))
        return F.when(round_ % 2 == 1, left).otherwise(right)

    start = F.struct(u.cast("long").alias("u"), v.cast("long").alias("v"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def pour(form: Column, number: Column) -> Column:
    """The form with its digits replaced, in order, by those of a number."""
    place = F.sequence(F.lit(1), F.length(form))
    char = lambda i: F.substr(form, i, F.lit(1))
    nth = lambda i: F.length(digits(F.substr(form, F.lit(1), i)))
    return F.array_join(F.transform(place, lambda i: F.when(char(i).rlike("[0-9]"), F.substr(number, nth(i), F.lit(1))).otherwise(char(i))), "")


def permuted_digits(number: Column, key: str) -> Column:
    n = F.length(number)
    half = F.floor(n / 2).cast("int")
    size = lambda k: F.rpad(F.lit("1"), k + 1, "0").cast("long")
    parts = permuted(F.substr(number, F.lit(1), half).cast("long"), F.substr(number, half + 1, n - half).cast("long"), size(half), size(n - half), key)
    return let(parts, lambda p: F.concat(F.lpad(p.u.cast("string"), half, "0"), F.lpad(p.v.cast("string"), n - half, "0")))


def check_digit(payload: Column) -> Column:
    n = F.length(payload)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(payload, n - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)
    return F.pmod(10 - total % 10, F.lit(10)).cast("string")


def _card(value: Column, key: str) -> Column:
    def pseudonym(number: Column) -> Column:
        payload = F.substr(number, F.lit(1), F.length(number) - 1)
        new = let(permuted_digits(payload, key), lambda p: F.concat(p, check_digit(p)))
        return F.when(check_digit(payload) == F.right(number, F.lit(1)), pour(value, new))

    return let(digits(value), pseudonym)


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.substr(value, F.lit(a), F.lit(n)).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    index = area - 1 - F.when(area > 666, 1).otherwise(0)
    new = permuted(index, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key)

    def write(p: Column) -> Column:
        first = p.u + 1 + F.when(p.u >= 665, 1).otherwise(0)
        rest = F.floor(p.v / 9999) + 1, p.v % 9999 + 1
        return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in zip((first, *rest), (3, 2, 4))])

    return F.when(valid, let(new, write))


def _phone(value: Column, key: str) -> Column:
    return let(digits(value), lambda d: pour(value, F.concat(F.substr(d, F.lit(1), F.length(d) - 10), permuted_digits(F.right(d, F.lit(10)), key))))


def _ip(value: Column, key: str) -> Column:
    octets = [F.split_part(value, F.lit("."), F.lit(i)).cast("int") for i in (1, 2, 3, 4)]
    valid = (octets[0] < 256) & (octets[1] < 256) & (octets[2] < 256) & (octets[3] < 256)
    new = permuted(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], 65536, 65536, key)
    write = lambda p: F.concat_ws(".", *[x.cast("string") for h in (p.u, p.v) for x in (F.shiftright(h, 8), h % 256)])
    return F.when(valid, let(new, write))


def _date(value: Column, key: str) -> Column:
    number = lambda a, n: F.substr(value, F.lit(a), F.lit(n)).cast("int")
    day = lambda y, m, d: F.try_to_date(F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in ((y, 4), (m, 2), (d, 2))]), "yyyy-MM-dd")
    iso = F.substr(value, F.lit(5), F.lit(1)).rlike("[^0-9]")

    def moved(date: Column) -> Column:
        """The date's pseudonym among the 400 years that it is in."""
        def by_day(n: Column) -> Column:
            era, rest = F.floor(n / ERA), n % ERA
            new = permuted(F.floor(rest / 5411), rest % 5411, 27, 5411, key)
            return let(new, lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (era * ERA + p.u * 5411 + p.v).cast("int")))

        return let(F.date_diff(date, F.lit(FIRST_DAY).cast("date")), by_day)

    def late(date: Column) -> Column:
        """The first date after day 12 of its month on the way through the cycle."""
        on = lambda done, _: F.when((F.day(done) > 12) & (done != date), done).otherwise(moved(done))
        return F.aggregate(F.sequence(F.lit(1), F.lit(60)), date, on)

    def write(new: Column, order: str) -> Column:
        parts = {"y": F.lpad(F.year(new).cast("string"), 4, "0"), "m": F.lpad(F.month(new).cast("string"), 2, "0"), "d": F.lpad(F.day(new).cast("string"), 2, "0")}
        return pour(value, F.concat(*[parts[x] for x in order]))

    early = lambda date: F.year(date) <= 9600
    y_m_d, d_m_y, m_d_y = day(number(1, 4), number(6, 2), number(9, 2)), day(number(7, 4), number(4, 2), number(1, 2)), day(number(7, 4), number(1, 2), number(4, 2))
    as_iso = F.when(early(y_m_d), write(moved(y_m_d), "ymd"))
    return F.when(iso, as_iso).otherwise(
        F.when(early(d_m_y), write(moved(d_m_y), "dmy")).when(early(m_d_y), write(late(m_d_y), "mdy"))
    )


def _email(value: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lower(value)), 256), 1, 16), F.lit("@mail.invalid"))


RULES = {"email": _email, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonym(value: Column, key: str) -> Column:
    """(kind, text) of a found value; the text is null if it is no valid value of its kind."""
    kinds = F.lit(None).cast("string")
    texts = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        whole = value.rlike(f"^(?:{PATTERNS[kind]})$")
        kinds, texts = F.when(whole, F.lit(kind)).otherwise(kinds), F.when(whole, RULES[kind](value, key)).otherwise(texts)
    return F.struct(kinds.alias("kind"), texts.alias("text"))


def pseudonymized(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, the text with pseudonyms, and how many values of each kind were replaced."""
    rows = id_and_text(docs)
    some = F.col("text").rlike("[0-9@]")
    rows = rows.select(
        "doc_id", "text",
        F.when(some, F.split("text", ANY, -1)).alias("between"),
        F.when(some, F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("values"),
    )
    rows = rows.withColumn("found", F.transform("values", lambda v: pseudonym(v, key)))
    pieces = F.transform("between", lambda b, i: F.concat(b, F.coalesce(F.get("found", i).text, F.get("values", i), F.lit(""))))
    count = lambda k: F.coalesce(F.size(F.filter("found", lambda f: (f.kind == k) & f.text.isNotNull())), F.lit(0)).cast("long")
    counts = [F.when(F.col("found").isNull(), F.lit(0).cast("long")).otherwise(count(k)).alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", F.coalesce(F.array_join(pieces, ""), "text").alias("text"), *counts)
