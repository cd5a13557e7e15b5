"""Pseudonyms: format, validity, bijection, linking, and what stays."""

import datetime
import ipaddress
import re

import pytest

from commerce_lake.llm import pii as P

KEY = "k"


def luhn(d):
    v = [int(c) for c in reversed(d)]
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(v)) % 10 == 0


def mod97(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


VALID = {
    "card": ["4799134681044206", "4425 4142 5915 7784", "4111-1111-1111-1111"],
    "iban": ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "FR1420041010050500013M02606", "de89 3704 0044 0532 0130 00", "fr1420041010050500013m02606"],
    "date": ["1984-02-29", "31.12.1999", "7/4/2001", "12/25/1990"],
    "ip": ["27.109.211.155", "8.8.8.8"],
    "ssn": ["123-45-6789"],
    "phone": ["+1 (319) 555-5132", "+49 30 1234567", "(212) 555-0199", "212-555-0199", "0171 1234567", "030/1234567"],
    "email": ["loogm.24@mail6.example.com", "A.b+c@x.org"],
}
STAYS = ["4799134681044207", "DE89370400440532013001", "1983-02-29", "32.12.1999", "256.1.1.1", "000-12-3456", "version 2.0", "1.2.3.4.5",
         "12345", "5 @ 6", "3.14159", "License 2.0.1", "2024",
         "2024-01-05Tomorrow", "3.4111111111111111", "zz89 3704 0044 0532 0130 00", "de89 3704 0044 0532 0130", "sha ab12cdef34567890ab12cdef",
         "1.0171 1234567", "0071 1234567"]


def run(spark, texts):
    df = spark.createDataFrame([(i, t, "p", 1) for i, t in enumerate(texts)], "doc_id int, text string, pii string, __kinds2 int")
    return sorted(P.pseudonymise(df, KEY).collect(), key=lambda r: r.doc_id)


def test_kinds_formats_and_validity(spark):
    for kind, values in VALID.items():
        rows = run(spark, [f"see {v} now" for v in values])
        for v, r in zip(values, rows):
            assert [p.kind for p in r.pii] == [kind], (v, r.pii)
            assert r.pii[0].found == v
            new = r.pii[0].pseudonym
            assert r.text == f"see {new} now" and new != v
            shape = lambda s: re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))
            if kind in ("card", "ssn", "phone", "email", "iban"):
                assert shape(new.split("@")[0]) == shape(v.split("@")[0])
            if kind == "card":
                assert luhn(re.sub(r"\D", "", new))
            if kind == "iban":
                assert mod97(new.upper()) == 1 and new[:2] == v[:2]
            if kind == "ip":
                ipaddress.IPv4Address(new)
            if kind == "date":
                p = list(map(int, re.split(r"[-./]", new)))
                datetime.date(*(p if "-" in v else (p[2], p[0], p[1]) if v.startswith("12/25") else p[::-1]))
            if kind == "email":
                assert new.split("@")[1] == v.split("@")[1]


def test_the_rest_stays(spark):
    for t, r in zip(STAYS, run(spark, STAYS)):
        assert r.text == t and not r.pii


def test_linked_across_documents_and_layouts(spark):
    rows = run(spark, ["a 4111111111111111, b", "4111-1111-1111-1111", "4111 1111 1111 1111.", "x 4111111111111111 4799134681044206"])
    digits = [[re.sub(r"\D", "", p.pseudonym) for p in r.pii] for r in rows]
    assert digits[0] == digits[1] == digits[2] == digits[3][:1] and digits[3][1] != digits[3][0]
    other = P.pseudonymise(spark.createDataFrame([(1, "4111111111111111")], "doc_id int, text string"), "another").first()
    assert other.text != digits[0][0]


def test_phone_layouts_and_account_cases_link(spark):
    same = [["+1 555 123 4567", "+15551234567", "+1 (555) 123-4567", "+1-555-123-4567"], ["+49 30 1234567", "+49301234567"],
            ["+353 1 234 5678", "+35312345678"], ["DE89370400440532013000", "de89370400440532013000", "de89 3704 0044 0532 0130 00"]]
    codes = ["1", "49", "353", "DE"]
    for values, code in zip(same, codes):
        rows = run(spark, values)
        new = {re.sub("[^0-9A-Z]", "", r.pii[0].pseudonym.upper()) for r in rows}
        assert [r.pii[0].found for r in rows] == values and len(new) == 1 and new.pop().startswith(code)
    r = run(spark, ["0171 1234567"])[0]
    assert r.text.startswith("0") and r.text != "0171 1234567"


def test_a_date_before_a_time_and_a_card_after_a_full_stop(spark):
    a, b = run(spark, ["at 2024-01-05T10:00:00Z.", "No.4111 1111 1111 1111"])
    assert [p.found for p in a.pii] == ["2024-01-05"] and a.text.endswith("T10:00:00Z.") and "2024-01-05" not in a.text
    assert [p.found for p in b.pii] == ["4111 1111 1111 1111"] and b.text.startswith("No.")


def test_permutation_is_a_bijection(spark):
    from pyspark.sql import functions as F

    n = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("s"))
    assert n.select(P.permute_text(F.col("s"), KEY, "t").alias("p")).distinct().where("p rlike '^[0-9]{3}$'").count() == 1000
    pair = lambda a, b: a * 7 + b
    m = spark.range(35).select(P.permute_numbers([(F.floor(F.col("id") / 7), 5), (F.col("id") % 7, 7)], KEY, "t", pair).alias("p"))
    assert sorted(r.p for r in m.collect()) == list(range(35))
    days = spark.range(0, 146097, 97).select(F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d"))
    assert days.select(P._date(F.col("d"), KEY).alias("p")).distinct().count() == days.count()


def test_edges(spark):
    rows = run(spark, [None, "", "1.2.3.4" , "1.2.3.4", "x " * 50_000 + "8.8.8.8 " + "y " * 50_000, "8.8.8.8 8.8.8.8", "a@b"])
    assert rows[0].text is None and rows[0].pii == [] and rows[1].text == ""
    assert rows[2].text == rows[3].text != "1.2.3.4"
    assert "8.8.8.8" not in rows[4].text and len(rows[4].pii) == 1 and rows[4].text.startswith("x x") and rows[4].text.endswith("y ")
    a, b = rows[5].text.split()
    assert a == b == rows[4].pii[0].pseudonym
    assert rows[6].text == "a@b"
    df = spark.createDataFrame([], "doc_id int, text string, pii string")
    out = P.pseudonymise(df, KEY)
    assert out.count() == 0 and out.columns == ["doc_id", "text", "pii"]


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id int, text string")
    plan = P.pseudonymise(spark.createDataFrame(df.collect(), df.schema), KEY)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("text", ["no digits at all", "mail me"])
def test_unchanged(spark, text):
    assert run(spark, [text])[0].text == text


HIDDEN = {  # text: the values to be found in it
    "card 4111 1111 1111 1111 12/26 ok": ["4111 1111 1111 1111"],
    "card 4111 1111 1111 1111 123": ["4111 1111 1111 1111"],
    "4111-1111-1111-1111-123": ["4111-1111-1111-1111"],
    "3782 822463 10005 1234": ["3782 822463 10005"],
    "cvv 123 4111 1111 1111 1111.": ["4111 1111 1111 1111"],
    "4111 1111 1111 1111 12/26/2026": ["4111 1111 1111 1111", "12/26/2026"],
    "4111 1111 1111 1111 123 4111 1111 1111 1111 123": ["4111 1111 1111 1111"] * 2,
    "IBAN ES91 2100 0418 4502 0005 1332 EUR 5": ["ES91 2100 0418 4502 0005 1332"],
    "BE68539007547034 EUR": ["BE68539007547034"],
    "to de89 3704 0044 0532 0130 00 and then some": ["de89 3704 0044 0532 0130 00"],
    "BE68 5390 0754 7034 NO93 8601 1117 947": ["BE68 5390 0754 7034", "NO93 8601 1117 947"],
    "8.8.8.8 and BE68539007547034 EURO PAID a@b.org": ["8.8.8.8", "BE68539007547034", "a@b.org"],
}


def test_numbers_next_to_other_groups(spark):
    for (t, values), r in zip(HIDDEN.items(), run(spark, list(HIDDEN))):
        assert [p.found for p in r.pii] == values, t
        want = t
        for p in r.pii:
            assert p.pseudonym != p.found
            want = want.replace(p.found, p.pseudonym)
        assert r.text == want
        for p in r.pii:
            if p.kind == "card":
                assert luhn(re.sub(r"\D", "", p.pseudonym))
            if p.kind == "iban":
                assert mod97(p.pseudonym.upper()) == 1


def test_groups_without_a_valid_number_stay(spark):
    texts = ["4111 1111 1111 1112 123", "BE68539007547035 EUR"]
    for t, r in zip(texts, run(spark, texts)):
        assert r.text == t and not r.pii
