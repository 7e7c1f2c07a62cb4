"""Format-preserving pseudonyms for personal data, by keyed Feistel networks.

Found and validated: card numbers (13 to 19 digits, Luhn), IBANs (modulus 97), IPv4 addresses,
dates from 1900 to 2099 (2024-01-31, 31.01.2024, 31/01/2024), telephone numbers (+1 (234)
567-8901 and the like, and without the country: (234) 567-8901, 234-567-8901), social security
numbers (area, group and serial in range) and mail addresses. Cards in the usual groups (16 and 19
digits by fours, 4-6-5, 4-6-4, 4-5-6, 6-13, 4-4-5, 4-3-3-3) are told apart from numbers beside
them; any other grouping with single blanks or hyphens is found where no number of its own starts
inside it. A short group behind a card or an IBAN belongs to it where both together validate. Each value is replaced by a keyed permutation of its own format:

- digits and letters of a value swap rounds between its two halves: each half is shifted by a
  keyed hash of the other, modulo its number of values, which is undone with the same key;
- a card's last digit and an IBAN's check digits are computed anew, so pseudonyms validate;
- dates, addresses and security numbers are ranked, permuted within their range, and written back
  in the same style. 17 * 4297 days make up 1900 to 2099.

Equal values under one key stay equal in every document, and different values stay different,
within a format. Writing styles (blanks, hyphens, case) are kept and do not change the digits, so
a number is linked across styles. Candidates that do not validate stay as they are.

All in DataFrame expressions: no Python runs on the executors.

Nulls and repeats. A null text stays null with no finds. Rows are independent; a text without
finds is returned as it is. Very long texts are searched whole, one row at a time. Other columns may
have any name; a column called finds gives way to the new one. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("card", "iban", "ip", "date", "phone", "ssn", "mail")
ROUNDS = 8
KEY = "example-key"

#: Candidate formats, tried in this order at each place. Possessive repeats and the look-behinds
#: keep the scan linear, and a domain of very many labels off the matcher's stack.
_MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
_NATIONAL = r"(?:1[ .-])?(?:\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?|[0-9]{3}[ .-][0-9]{3}[ .-])[0-9]{4}(?![0-9A-Za-z])"
#: A last short group is not the start of a date, an address or a telephone number.
_TAIL = rf"(?!{_NATIONAL})[%s]{{1,3}}(?![0-9A-Za-z]|[./-][0-9])"
_IBAN = (
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}(?![A-Za-z0-9])"
    rf"|(?: [A-Z0-9]{{4}}(?![A-Za-z0-9])){{2,7}}(?: {_TAIL % 'A-Z0-9'}|(?![./-][0-9])))"
)
_IP = r"(?<![0-9.A-Za-z])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
_DATE = r"(?<![0-9A-Za-z])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}(?<ds>[./])[0-9]{2}\k<ds>[0-9]{4})(?![0-9A-Za-z])"
_SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
_PHONE = (
    r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9A-Za-z])"
    rf"|(?<![0-9][.-]){_NATIONAL})"
)
#: Card shapes by the digits of their groups, longest first. A short fifth group may be no part of the card.
_SHAPES = (("4", "4", "4", "4", _TAIL % "0-9"), ("4", "4", "4", "1,7"), ("4", "6", "4,5"), ("4", "5", "6"), ("6", "13"), ("4", "4", "5"), ("4", "3", "3", "3"))


def _shaped(groups: tuple[str, ...], name: str | None = None) -> str:
    """Groups of digits with one separator, the same one throughout if it has a name."""
    first, then = (rf"(?<{name}>[ -])", rf"\k<{name}>") if name else ("[ -]", "[ -]")
    parts = [f"[0-9]{{{g}}}" if g[0].isdigit() else g for g in groups]
    return parts[0] + first + then.join(parts[1:])


#: Other groupings are taken up to the start of anything that is a candidate by itself.
_OWN = "|".join((
    r"[A-Za-z0-9._%+-]{1,256}+@", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])", r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z])",
    r"[0-9]{2}[./][0-9]{2}[./][0-9]{4}(?![0-9A-Za-z])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", _NATIONAL,
    rf"(?:[0-9]{{13,19}}|{'|'.join(map(_shaped, _SHAPES))})(?![0-9A-Za-z])",
))
_CARD = (
    r"(?<![0-9A-Za-z+.-])(?:[0-9]{13,19}|" + "|".join(_shaped(g, f"s{i}") for i, g in enumerate(_SHAPES))
    + rf"|[0-9](?:[0-9]|[ -](?!{_OWN})[0-9]){{12,18}}+)(?![0-9A-Za-z])"
)
CANDIDATE = "|".join((_MAIL, _IBAN, _IP, _DATE, _SSN, _PHONE, _CARD))


def _hash(key: str, kind: str, step: Column, half: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), step.cast("string"), F.lit("|"), half.cast("string")), 256)


def _number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, 10).cast("bigint")


def permuted(high: Column, low: Column, highs: Column, lows: Column, key: str, kind: str) -> Column:
    """struct(high, low): a keyed permutation of the pairs below (highs, lows)."""

    def shift(step: Column, half: Column, size: Column) -> Column:
        return _number(F.substring(_hash(key, kind, step, half), 1, 15)) % size

    def turn(state: Column, step: Column) -> Column:
        first, second = state["high"], state["low"]
        return F.when(
            step % 2 == 0, F.struct(((first + shift(step, second, highs)) % highs).alias("high"), second.alias("low"))
        ).otherwise(F.struct(first.alias("high"), ((second + shift(step, first, lows)) % lows).alias("low")))

    start = F.struct(high.cast("bigint").alias("high"), low.cast("bigint").alias("low"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn)


def _power(digits: Column) -> Column:
    return F.rpad(F.lit("1"), digits + 1, "0").cast("bigint")


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A keyed permutation of digit texts of one length, 2 to 36 digits."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    right = (n - left).cast("int")
    both = permuted(
        F.substring(digits, F.lit(1), left).cast("bigint"), F.substring(digits, left + 1, right).cast("bigint"),
        _power(left), _power(right), key, kind,
    )
    return _of(both, lambda b: F.concat(F.lpad(b["high"].cast("string"), left, "0"), F.lpad(b["low"].cast("string"), right, "0")))


def _of(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def permuted_characters(text: Column, key: str, kind: str) -> Column:
    """A keyed permutation that keeps each character's kind: digit, A-Z, a-z; others stay."""
    n = F.length(text)
    left = F.floor(n / 2).cast("int")
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def shifted(part: Column, stream: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            by = _number(F.substring(stream, (i * 2) % 64 + 1, F.lit(2)))

            def within(alphabet: str) -> Column:
                place = F.instr(F.lit(alphabet), c) - 1
                return F.substring(F.lit(alphabet), ((place + by) % len(alphabet) + 1).cast("int"), F.lit(1))

            return (
                F.when(c.rlike("^[0-9]$"), within("0123456789")).when(c.rlike("^[A-Z]$"), within(upper))
                .when(c.rlike("^[a-z]$"), within(lower)).otherwise(c)
            )

        return F.when(part == "", part).otherwise(F.array_join(F.transform(F.split(part, ""), one), ""))

    def turn(state: Column, step: Column) -> Column:
        first, second = state["high"], state["low"]
        by = lambda part, other: _of(_hash(key, kind, step, other), lambda stream: shifted(part, stream))
        return F.when(step % 2 == 0, F.struct(by(first, second).alias("high"), second.alias("low"))).otherwise(
            F.struct(first.alias("high"), by(second, first).alias("low"))
        )

    start = F.struct(F.substring(text, F.lit(1), left).alias("high"), F.substring(text, left + 1, n).alias("low"))
    return _of(F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn), lambda s: F.concat(s["high"], s["low"]))


def _only(text: Column, kept: str) -> Column:
    return F.regexp_replace(text, f"[^{kept}]", "")


def _written(old: Column, new: Column, kept: str) -> Column:
    """``new`` in the places that ``old`` has for characters of ``kept``."""

    def one(i: Column, value: Column) -> Column:
        c = F.substring(old, i, F.lit(1))
        place = F.length(_only(F.substring(old, F.lit(1), i), kept))
        return F.when(c.rlike(f"^[{kept}]$"), F.substring(value, place, F.lit(1))).otherwise(c)

    places = F.sequence(F.lit(1), F.length(old))
    return _of(new, lambda value: F.array_join(F.transform(places, lambda i: one(i, value)), ""))


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum, the last digit counting once."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def mod97(text: Column) -> Column:
    """The remainder by 97 with letters as 10 to 35."""
    values = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def add(rest: Column, c: Column) -> Column:
        v = F.instr(F.lit(values), c) - 1
        return F.when(v > 9, rest * 100 + v).otherwise(rest * 10 + v) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _first(choices: list[Column], good) -> Column:
    """The first choice that is good; null without one."""
    return F.coalesce(*[F.when(good(c), c) for c in choices])


def _around(m: Column, value: Column, new) -> Column:
    """The candidate with ``new(value)`` for the value it starts with."""
    return _of(value, lambda v: F.concat(new(v), F.substring(m, F.length(v) + 1, F.length(m))))


def _card(m: Column, key: str) -> tuple[Column, Column]:
    def good(c: Column) -> Column:
        digits = _only(c, "0-9")
        return m.rlike("^[0-9][0-9 -]*$") & (F.length(digits) >= 13) & (luhn_sum(digits) % 10 == 0)

    def new(d: Column) -> Column:
        payload = permuted_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card")
        return _of(payload, lambda p: F.concat(p, ((10 - luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string")))

    four = F.when(m.rlike("^(?:[0-9]{4}[ -]){4}[0-9]{1,3}$"), F.substring(m, 1, 19))
    value = _first([m, four], good)
    return value.isNotNull(), _around(m, value, lambda v: _of(_only(v, "0-9"), lambda d: _written(v, new(d), "0-9")))


def _iban(m: Column, key: str) -> tuple[Column, Column]:
    turned = lambda s: F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, F.lit(1), F.lit(4)))

    def good(c: Column) -> Column:
        plain = _only(c, "A-Z0-9")
        return m.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9 ]+$") & (F.length(plain) >= 15) & (mod97(turned(plain)) == 1)

    def new(s: Column) -> Column:
        country = F.substring(s, F.lit(1), F.lit(2))
        rest = permuted_characters(F.substring(s, F.lit(5), F.length(s)), key, "iban")
        return _of(rest, lambda r: F.concat(country, F.lpad((98 - mod97(F.concat(r, country, F.lit("00")))).cast("string"), 2, "0"), r))

    # a short last group may be a word or number that follows
    shorter = F.when(m.rlike(" [A-Z0-9]{1,3}$"), F.regexp_replace(m, " [A-Z0-9]{1,3}$", ""))
    value = _first([m, shorter], good)
    return value.isNotNull(), _around(m, value, lambda v: _of(_only(v, "A-Z0-9"), lambda s: _written(v, new(s), "A-Z0-9")))


def _ip(m: Column, key: str) -> tuple[Column, Column]:
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    parts = F.transform(F.split(m, r"\."), lambda p: p.cast("bigint"))
    both = _of(parts, lambda p: permuted(p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65536), F.lit(65536), key, "ip"))
    text = lambda v: F.concat_ws(".", F.floor(v / 256).cast("string"), (v % 256).cast("string"))
    return m.rlike(f"^{octet}(?:\\.{octet}){{3}}$"), _of(both, lambda b: F.concat_ws(".", text(b["high"]), text(b["low"])))


def _date(m: Column, key: str) -> tuple[Column, Column]:
    iso = m.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    other = m.rlike("^[0-9]{2}[./][0-9]{2}[./][0-9]{4}$")
    sep = F.substring(m, 3, 1)
    piece = lambda at, n: F.substring(m, at, n)
    plain = F.when(iso, m).when(other, F.concat_ws("-", piece(7, 4), piece(4, 2), piece(1, 2)))
    day = F.to_date(F.try_to_timestamp(plain, F.lit("yyyy-MM-dd")))
    rank = F.datediff(day, F.to_date(F.lit("1900-01-01"))).cast("bigint")
    both = permuted(F.floor(rank / 4297), rank % 4297, F.lit(17), F.lit(4297), key, "date")
    fresh = F.date_add(F.to_date(F.lit("1900-01-01")), (both["high"] * 4297 + both["low"]).cast("int"))

    def style(d: Column) -> Column:
        part = lambda f: F.date_format(d, f)
        return F.when(iso, part("yyyy-MM-dd")).otherwise(F.concat(part("dd"), sep, part("MM"), sep, part("yyyy")))

    return (iso | other) & day.isNotNull() & F.year(day).between(1900, 2099), _of(fresh, style)


def _phone(m: Column, key: str) -> tuple[Column, Column]:
    digits = _only(m, "0-9")

    def new(d: Column) -> Column:
        n = F.length(d)
        return F.concat(F.substring(d, F.lit(1), n - 10), permuted_digits(F.substring(d, n - 9, F.lit(10)), key, "phone"))

    return m.startswith("+") | m.rlike(f"^{_NATIONAL}$"), _of(digits, lambda d: _written(m, new(d), "0-9"))


def _ssn(m: Column, key: str) -> tuple[Column, Column]:
    area, group, serial = (F.substring(m, a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    good = m.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")
    place = F.when(area < 666, area - 1).otherwise(area - 2)
    both = permuted(place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")

    def text(b: Column) -> Column:
        p = F.floor(b["high"] / 99)
        pad = lambda v, n: F.lpad(v.cast("string"), n, "0")
        return F.concat_ws("-", pad(F.when(p < 665, p + 1).otherwise(p + 2), 3), pad(b["high"] % 99 + 1, 2), pad(b["low"] + 1, 4))

    return good, _of(both, text)


def _mail(m: Column, key: str) -> tuple[Column, Column]:
    at = F.instr(m, "@")
    local = permuted_characters(F.substring(m, F.lit(1), at - 1), key, "mail")
    return at > 0, F.concat(local, F.substring(m, at, F.length(m)))


def replaced(match: Column, key: str) -> Column:
    """struct(kind, text) of one candidate; kind is null where it does not validate."""
    kinds = {"mail": _mail, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}
    name, text = F.lit(None).cast("string"), match
    for kind, make in reversed(kinds.items()):
        good, new = make(match, key)
        name = F.when(good, kind).otherwise(name)
        text = F.when(good, new).otherwise(text)
    return F.struct(name.alias("kind"), text.alias("text"))


def pseudonymised(docs: DataFrame, key: str = KEY) -> DataFrame:
    """All rows and columns with pseudonyms in ``text``, and ``finds``: the kinds in text order.

    A column ``finds`` of the input gives way to the new one.
    """
    docs = docs.drop("finds")
    names = [f"_p{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*names)
    text = F.col(names[docs.columns.index("text")]).cast("string")
    pattern = F.lit(CANDIDATE)
    has = text.rlike(CANDIDATE)
    none = F.array().cast("array<struct<kind:string,text:string>>")
    found = F.when(has, F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: replaced(m, key))).otherwise(none)
    gaps = F.when(has, F.split(text, CANDIDATE))
    step = inner.withColumn("_found", found).withColumn("_gaps", gaps)
    woven = F.array_join(
        F.zip_with("_gaps", "_found", lambda g, f: F.concat(g, F.coalesce(f["text"], F.lit("")))), ""
    )
    kinds = F.filter(F.transform("_found", lambda f: f["kind"]), lambda k: k.isNotNull())
    out = {c: F.when(F.col("_gaps").isNotNull(), woven).otherwise(text) if c == "text" else F.col(n) for c, n in zip(docs.columns, names)}
    return step.select(*[v.alias(c) for c, v in out.items()], kinds.alias("finds"))


def counted(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, text with pseudonyms, finds per kind and a digest of the text."""
    out = pseudonymised(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), key)
    count = lambda kind: F.size(F.filter("finds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")
    each = [count(kind) for kind in KINDS]
    return out.select("doc_id", "text", *each, F.sha2("text", 256).alias("text_sha256"))
