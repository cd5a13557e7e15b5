"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Candidates are found with one pattern and validated by kind; a valid value is
replaced by another value of the same format, under a key:

* digits and letters: the characters' halves are shifted in turn, each by a
  keyed hash of the other half, within their class (0-9, a-z, A-Z); punctuation
  and separators stay, so a value keeps its layout;
* card numbers must pass the Luhn test, account numbers (IBAN) the mod-97 test,
  those in small letters also the length of their country; their check digits
  are computed anew, so pseudonyms pass too;
* dates (ISO, also before a time, or day and month with dots or slashes) must
  exist; the day number is permuted within the 146,097 days of 1800-2199;
* IPv4 addresses need octets up to 255 and are permuted as two 16-bit halves;
* social security numbers are permuted over the valid area, group and serial;
* phone numbers keep their country code (from the table of codes, so it does not
  depend on the layout) or the 0 of a national number; e-mail addresses keep
  their domain.

A candidate that fails as a whole may hide a card or account number next to
other groups (an expiry date, a currency): its parts at group borders are then
validated, from the first group on and longest first, an account number by its
country's length; the text around the valid part is searched again.

Each step is a bijection, so different values stay different, and it depends on
key and value alone (card, account and phone numbers without separators,
accounts in capitals; a national number isn't linked to its international form), so
equal values stay linked across documents.  Spark expressions only.

Defined cases: a null text stays null, an empty one empty; whole texts are
searched; numbers that fail validation stay; repeated rows change alike; empty
tables give no rows; other columns, whatever their names, are kept, but for one
named pii, which gives way to the result's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import free_prefix

ROUNDS = 8  # even, so the halves end in their own places
DEMO_KEY = "not-a-secret"

# Patterns by kind, in the order in which they are tried (fixed values).
PATTERNS = {
    "email": r"[A-Za-z0-9](?:[A-Za-z0-9._%+\-]{0,63})@(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "iban": r"\b(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[a-z]{2}[0-9]{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?)\b",
    "date": r"(?<![\w.\-/])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?!(?!T[0-9]{2}:)[\w\-/])",
    "ip": r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\w]|\.[0-9])",
    "ssn": r"(?<![\w\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w\-])",
    "phone": r"(?<![\w+])(?:\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?[0-9]{1,4}(?:[ .\-]?[0-9]{2,4}){1,4}|(?:\([0-9]{3}\) ?|[0-9]{3}[.\-])[0-9]{3}[.\-][0-9]{4}|(?<![.\-/])0[1-9][0-9]{1,3}[ /][0-9]{5,8})(?![\w])",
    "card": r"(?<![\w\-])(?<![0-9]\.)[0-9](?:[ \-]?[0-9]){12,18}(?![\w\-])",
}
ANY = "|".join(PATTERNS.values())
# Cards that begin after another group: undivided or in the usual groups only.
CARD_GROUPS = r"^(?:[0-9]{13,19}|[0-9]{4}([ \-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ \-])[0-9]{6}\2[0-9]{4,5})$"
# Account number lengths by country (IBAN registry).
IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 "
    "FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 "
    "MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 "
    "SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
# Calling codes of one and of two digits (ITU E.164); all others have three.
CODES_1 = ("1", "7")
CODES_2 = ("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
           "81 82 84 86 90 91 92 93 94 95 98").split()
SHORTEST = 13  # characters of a card or account number
DAYS, FIRST_DAY = (773, 189), "1800-01-01"  # 773 * 189 = 146,097 days of 400 Gregorian years


def _noise(key: str, *parts) -> Column:
    """48 keyed bits of the parts."""
    text = F.concat_ws("\x1f", F.lit(key), *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def _char(s: Column, i: Column) -> Column:
    return F.substr(s, i, F.lit(1))


def _shift(half: Column, other: Column, key: str, kind: str, turn: Column) -> Column:
    def one(i):
        c = _char(half, i)
        a = F.ascii(c)

        def within(base, size):
            return F.char(F.lit(base) + F.pmod(a - base + _noise(key, kind, turn, other, i), F.lit(size)))

        return (F.when(c.rlike("^[0-9]$"), within(48, 10)).when(c.rlike("^[a-z]$"), within(97, 26))
                .when(c.rlike("^[A-Z]$"), within(65, 26)).otherwise(c))

    return F.when(F.length(half) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.length(half)), one), "")).otherwise("")


def permute_text(s: Column, key: str, kind: str) -> Column:
    """A permutation of the strings with the same classes of characters in the same places."""
    h = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), h).alias("l"), F.substr(s, h + 1, F.length(s)).alias("r"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start,
        lambda acc, turn: F.struct(acc["r"].alias("l"), _shift(acc["l"], acc["r"], key, kind, turn).alias("r")),
        lambda acc: F.concat(acc["l"], acc["r"]))


def permute_numbers(values: list[tuple[Column, int]], key: str, kind: str, finish) -> Column:
    """Permutes (v1, .., vn) over Z_m1 x .. x Z_mn: each in turn moves by a hash of the others."""
    n = len(values)
    start = F.struct(*[v.cast("long").alias(f"v{i}") for i, (v, _) in enumerate(values)])

    def turn(acc, t):
        return F.struct(*[
            F.when(F.pmod(t, F.lit(n)) == i,
                   F.pmod(acc[f"v{i}"] + _noise(key, kind, t, *[acc[f"v{j}"] for j in range(n) if j != i]), F.lit(m)))
            .otherwise(acc[f"v{i}"]).alias(f"v{i}") for i, (_, m) in enumerate(values)])

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS + n)), start, turn,
                       lambda acc: finish(*[acc[f"v{i}"] for i in range(n)]))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _refill(layout: Column, fill: Column, cls: str) -> Column:
    """``layout`` with its characters of class ``cls`` replaced, in order, by those of ``fill``."""
    def one(i):
        c = _char(layout, i)
        nth = F.length(F.regexp_replace(F.substr(layout, F.lit(1), i), f"[^{cls}]", ""))
        return F.when(c.rlike(f"^[{cls}]$"), _char(fill, nth)).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(layout)), one), "")


def luhn_sum(d: Column) -> Column:
    """The Luhn sum modulo 10 of a digit string."""
    n = F.length(d)

    def add(acc, i):
        v = _char(d, i).cast("int")
        v = F.when(F.pmod(n - i, F.lit(2)) == 1, v * 2 - F.when(v > 4, 9).otherwise(0)).otherwise(v)
        return acc + v

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    body = permute_text(F.substr(d, F.lit(1), F.length(d) - 1), key, "card")
    check = F.pmod(F.lit(10) - luhn_sum(F.concat(body, F.lit("0"))), F.lit(10))
    return _refill(m, F.concat(body, check.cast("string")), "0-9")


def _mod97(s: Column) -> Column:
    """The account number rearranged for its test, modulo 97."""
    r = F.concat(F.substr(s, F.lit(5), F.length(s)), F.substr(s, F.lit(1), F.lit(4)))

    def add(acc, i):
        c = _char(r, i)
        return F.when(c.rlike("^[0-9]$"), (acc * 10 + c.cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(r)), F.lit(0), add)


def _account(m: Column) -> Column:
    """An account number without spaces, in capitals."""
    return F.upper(F.replace(m, F.lit(" "), F.lit("")))


def _registered_length(account: Column) -> Column:
    """The length of account numbers of its country, or null."""
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    return F.try_element_at(lengths, F.substr(account, F.lit(1), F.lit(2)))


def _iban(m: Column, key: str) -> Column:
    s = _account(m)
    body = permute_text(F.substr(s, F.lit(5), F.length(s)), key, "iban")
    land = F.substr(s, F.lit(1), F.lit(2))
    check = F.lpad((F.lit(98) - _mod97(F.concat(land, F.lit("00"), body))).cast("string"), 2, "0")
    new = _refill(F.upper(m), F.concat(land, check, body), "A-Z0-9")
    return F.when(m.rlike("^[a-z]"), F.lower(new)).otherwise(new)


def _day(m: Column) -> Column:
    """The date that the text names (day first with dots or slashes), or null."""
    iso = m.rlike(r"^[0-9]{4}-")
    p = F.split(m, r"[-./]")
    y, d = F.when(iso, p[0]).otherwise(p[2]), F.when(iso, p[2]).otherwise(p[0])
    def made(day, month):
        return F.try_to_timestamp(F.concat_ws("-", y, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")
    # a slashed date whose day comes second is read month first
    return F.when(iso | m.contains("."), made(d, p[1])).otherwise(F.coalesce(made(d, p[1]), made(p[1], d)))


def _day_number(m: Column) -> Column:
    return F.datediff(_day(m), F.lit(FIRST_DAY).cast("date"))


def _date(m: Column, key: str) -> Column:
    a, b = DAYS
    n = _day_number(m)

    def layout(x, y):
        day = F.date_add(F.lit(FIRST_DAY).cast("date"), (x * b + y).cast("int"))
        # a slashed date that can only be read month first is written month first
        first = F.split(m, "/")
        month_first = F.coalesce(F.try_element_at(first, F.lit(2)).cast("int") > 12, F.lit(False))
        return (F.when(m.rlike("^[0-9]{4}-"), F.date_format(day, "yyyy-MM-dd"))
                .when(m.contains("."), F.date_format(day, "dd.MM.yyyy"))
                .when(month_first, F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "dd/MM/yyyy")))

    return permute_numbers([(F.floor(n / b), a), (F.pmod(n, F.lit(b)), b)], key, "date", layout)


def _octet(m: Column, i: int) -> Column:
    return F.split(m, r"\.")[i].cast("int")


def _ip(m: Column, key: str) -> Column:
    def text(hi, lo):
        return F.concat_ws(".", F.floor(hi / 256).cast("string"), (hi % 256).cast("string"),
                           F.floor(lo / 256).cast("string"), (lo % 256).cast("string"))

    return permute_numbers([(_octet(m, 0) * 256 + _octet(m, 1), 65536), (_octet(m, 2) * 256 + _octet(m, 3), 65536)],
                           key, "ip", text)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = [F.split(m, "-")[i].cast("int") for i in range(3)]

    def text(a, g, s):  # areas 001-899 without 666
        a = F.when(a >= 665, a + 2).otherwise(a + 1)
        return F.concat_ws("-", F.lpad(a.cast("string"), 3, "0"), F.lpad((g + 1).cast("string"), 2, "0"),
                           F.lpad((s + 1).cast("string"), 4, "0"))

    return permute_numbers([(F.when(area > 666, area - 2).otherwise(area - 1), 898), (group - 1, 99), (serial - 1, 9999)],
                           key, "ssn", text)


def _phone(m: Column, key: str) -> Column:
    d = _digits(m)
    code = (F.when(F.substr(d, F.lit(1), F.lit(1)).isin(*CODES_1), 1)
            .when(F.substr(d, F.lit(1), F.lit(2)).isin(*CODES_2), 2).otherwise(3))
    kept = F.when(m.startswith("+"), code).when(m.startswith("0"), 1).otherwise(0)
    fill = F.concat(F.substr(d, F.lit(1), kept), permute_text(F.substr(d, kept + 1, F.length(d)), key, "phone"))
    return _refill(m, fill, "0-9")


def _email(m: Column, key: str) -> Column:
    return F.concat(permute_text(F.substring_index(m, "@", 1), key, "email"), F.lit("@"), F.substring_index(m, "@", -1))


def kind_of(m: Column) -> Column:
    """The kind of a candidate that passes its validation, else null."""
    whole = {k: m.rlike(f"^(?:{p})$") for k, p in PATTERNS.items()}
    n = F.length(_digits(m))
    s = F.split(m, "-")
    ssn = (s[0] != "000") & (s[0] != "666") & (s[0] < "900") & (s[1] != "00") & (s[2] != "0000")
    number, account = _day_number(m), _account(m)
    known = F.coalesce(F.length(account) == _registered_length(account), F.lit(False))
    return (F.when(whole["email"], "email")
            .when(whole["iban"] & (_mod97(account) == 1) & (m.rlike("^[A-Z]") | known), "iban")
            .when(whole["date"] & (number >= 0) & (number < DAYS[0] * DAYS[1]), "date")
            .when(whole["ip"] & F.forall(F.split(m, r"\."), lambda o: o.cast("int") <= 255), "ip")
            .when(whole["ssn"] & ssn, "ssn")
            .when(whole["card"] & n.between(13, 19) & (luhn_sum(_digits(m)) == 0), "card")
            .when(whole["phone"] & n.between(8, 15), "phone"))


def _hidden(m: Column) -> Column:
    """at and s of the first card or account number at group borders inside a candidate, else null."""
    n = F.length(m)
    borders = F.filter(F.sequence(F.lit(1), n), lambda i: _char(m, i).isin(" ", "-"))
    starts = F.concat(F.array(F.lit(1)), F.transform(borders, lambda i: i + 1))
    ends = F.reverse(F.concat(F.transform(borders, lambda i: i - 1), F.array(n)))  # longest first
    spans = F.flatten(F.transform(starts, lambda a: F.transform(
        F.filter(ends, lambda z: z - a >= SHORTEST - 1),
        lambda z: F.struct(a.alias("at"), F.substr(m, a, z - a + 1).alias("s")))))

    def valid(span):
        at, s = span["at"], span["s"]
        account = _account(s)
        card = s.rlike(f"^(?:{PATTERNS['card']})$") & ((at == 1) | s.rlike(CARD_GROUPS)) & (luhn_sum(_digits(s)) == 0)
        iban = s.rlike(f"^(?:{PATTERNS['iban']})$") & F.coalesce(F.length(account) == _registered_length(account), (at == 1) & s.rlike("^[A-Z]")) & (_mod97(account) == 1)
        return card | iban

    return F.when((n > SHORTEST) & m.rlike("[ \\-]"), F.get(F.filter(spans, valid), F.lit(0)))


def _found(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit(f"({ANY})"), F.lit(1))


def _cut(s: Column) -> Column:
    """Text, hidden number, text, .., text: ``s`` cut where its failed candidates hide numbers."""
    def step(acc, x):
        m, h = x["m"], x["h"]
        before = F.concat(acc["open"], x["p"], F.substr(m, F.lit(1), h["at"] - 1))
        return (F.when(h.isNotNull(), F.struct(F.concat(acc["done"], F.array(before, h["s"])).alias("done"),
                                               F.substr(m, h["at"] + F.length(h["s"]), F.length(m)).alias("open")))
                .otherwise(F.struct(acc["done"].alias("done"), F.concat(acc["open"], x["p"], F.coalesce(m, F.lit(""))).alias("open"))))

    pairs = F.zip_with(F.split(s, ANY, -1), _found(s), lambda p, m: F.struct(
        p.alias("p"), m.alias("m"), F.when(kind_of(m).isNull(), _hidden(m)).alias("h")))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))
    return F.aggregate(pairs, start, step, lambda acc: F.concat(acc["done"], F.array(acc["open"])))


def _segments(t: Column) -> Column:
    """``t`` cut until no failed candidate hides a number; every second segment is one."""
    def step(acc, _):
        more = F.flatten(F.transform(acc["segments"], lambda s, i: F.when(i % 2 == 0, _cut(s)).otherwise(F.array(s))))
        return (F.when(acc["before"] == F.size(acc["segments"]), acc)
                .otherwise(F.struct(F.size(acc["segments"]).alias("before"), more.alias("segments"))))

    start = F.struct(F.lit(0).alias("before"), F.array(t).alias("segments"))
    turns = F.sequence(F.lit(0), F.floor(F.length(t) / SHORTEST).cast("int") + 1)  # each cuts a number off, or is the last
    return F.aggregate(turns, start, step, lambda acc: acc["segments"])


def _replacement(m: Column, kind: Column, key: str) -> Column:
    return (F.when(kind == "email", _email(m, key)).when(kind == "iban", _iban(m, key)).when(kind == "date", _date(m, key))
            .when(kind == "ip", _ip(m, key)).when(kind == "ssn", _ssn(m, key)).when(kind == "card", _card(m, key))
            .when(kind == "phone", _phone(m, key)).otherwise(m))


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The rows with ``text`` pseudonymised, and ``pii``: kind, found and pseudonym per place, in order."""
    t, p = F.col(f"`{text}`"), free_prefix(docs)
    found = F.when(t.rlike("[0-9@]"), _found(t)).otherwise(F.array().cast("array<string>"))

    def kinds(found):  # kinds first, so that a validation is evaluated once per candidate
        return F.transform(found, lambda m: F.struct(m.alias("found"), kind_of(m).alias("kind")))

    hides = F.exists(F.col(p + "kinds"), lambda k: F.when(k["kind"].isNull(), _hidden(k["found"])).isNotNull())
    segments = F.col(p + "segments")
    again = F.flatten(F.transform(segments, lambda s, i: F.when(i % 2 == 0, _found(s)).otherwise(F.array(s))))
    marks = F.transform(F.col(p + "kinds"), lambda k: F.struct(
        k["kind"].alias("kind"), k["found"].alias("found"), _replacement(k["found"], k["kind"], key).alias("pseudonym")))
    pieces = F.when(segments.isNull(), F.split(t, ANY, -1)).otherwise(
        F.flatten(F.transform(F.filter(segments, lambda s, i: i % 2 == 0), lambda s: F.split(s, ANY, -1))))
    woven = F.array_join(F.zip_with(pieces, F.transform(F.col(p + "marks"), lambda k: k["pseudonym"]),
                                    lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    out = (docs.withColumn(p + "found", found).withColumn(p + "kinds", kinds(F.col(p + "found")))
           .withColumn(p + "segments", F.when(hides, _segments(t)))
           .withColumn(p + "kinds", F.when(segments.isNull(), F.col(p + "kinds")).otherwise(kinds(again))).withColumn(p + "marks", marks)
           .withColumn(p + "text", F.when(F.size(p + "marks") > 0, woven).otherwise(t)))
    kept = [F.col(p + "text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c != "pii"]
    return out.select(*kept, F.filter(p + "marks", lambda k: k["kind"].isNotNull()).alias("pii"))
