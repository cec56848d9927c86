"""PII pseudonyms that keep their format (operator 4), DataFrame functions only.

One regular expression finds candidates, a check validates each (Luhn for card
numbers, mod 97 for IBANs, the calendar for dates, octets and number plans by
pattern), and a keyed Feistel network permutes the value within its format:
a card number becomes another valid card number of the same length and
grouping, a date another date in the same notation, an IPv4 address another
one. A permutation with one key maps equal values to equal pseudonyms in every
document and never two values to one. What fails its check stays as it is; cards
and IBANs are checked at every place they may begin (an IBAN at its country's
length), so that a failed candidate hides nothing. Phone numbers end with their
number plan and before an IP, date, card or SSN. Without a fixed length (+49) or
listed plan a plain number after a space cannot be told from the phone number.

The network works on a pair (l, r) of a space of a x b values; round i adds a
keyed hash of one half to the other, modulo a or b, so every round and with it
the whole is a permutation of exactly the a x b valid values.

E-mail addresses and quoted secrets have no numeric format; they become keyed
digests, which also link equal values.

The work per document is one narrow pass. Cases: null text stays null (no
values), empty text stays empty; repeated rows give repeated results; extra
columns are kept; an empty table gives no rows. Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
_AFTER = r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++){1,8}+"
SECRET = r"(?<![\p{L}\p{N}])(?i:token|secret|api[_-]?key|password) ?[=:] ?\"[^\"\s]{8,128}\""
IBAN = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _AFTER
ISO_DATE = r"(?<![\p{L}\p{N}-])(?:19|20)\d\d-\d\d-\d\d(?![\p{L}\p{N}-])"
DAY_DATE = r"(?<![\p{L}\p{N}./])\d{1,2}(?<mark>[./])\d{1,2}\k<mark>(?:19|20)\d\d(?![\p{L}\p{N}/]|\.\d)"
IPV4 = rf"(?<![\p{{L}}\p{{N}}.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\p{{L}}\p{{N}}]|\.\d)"
SSN = r"(?<![\p{L}\p{N}-])(?!000|666|9\d\d)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\p{L}\p{N}-])"
CARD = r"(?<![\p{L}\p{N}-])(?:\d{13,19}|\d{4}(?<four>[ -])\d{4}\k<four>\d{4}\k<four>\d{1,7}|\d{4}(?<six>[ -])\d{6}\k<six>\d{5})(?![\p{L}\p{N}-])"
# Country codes whose numbers have one length, by the digits after the code.
PLANS = {8: "45|47", 9: "31|33|34|41|48|61|351|420", 10: "7|30|44|52|90|91"}
_NEXT = "|".join([IPV4, ISO_DATE, DAY_DATE.replace("mark", "next@"), SSN])
_CARDS = "<cards>"  # stands for the cards of a text


def _group(name: str) -> str:
    return rf"(?:[ .-]?(?!{_NEXT.replace('@', name)}|{_CARDS})\d{{2,4}})"


_PLANNED = r"\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}" + "".join(
    rf"|\+(?:{codes})(?: ?\(0\))?(?:(?:\) ?|[ .-]?\(|[ .-](?!{_NEXT.replace('@', str(n))}))?\d){{{n}}}" for n, codes in PLANS.items()
)
_PHONE = (
    rf"(?<![\p{{L}}\p{{N}}+])(?:(?:{_PLANNED}){_AFTER}|\+\d{{1,3}}[ .-]?\(\d{{1,4}}\){_group('A')}{{2,4}}|\+\d{{1,3}}{_group('B')}{{2,5}}"
    rf"|\(\d{{3}}\) ?\d{{3}}[ .-]\d{{4}}|\d{{3}}[.-]\d{{3}}[.-]\d{{4}}){_AFTER}"
)
PHONE = _PHONE.replace(_CARDS, "(?!)")
KINDS = {"email": EMAIL, "secret": SECRET, "iban": IBAN, "iso_date": ISO_DATE, "day_date": DAY_DATE, "ip": IPV4, "ssn": SSN, "card": CARD, "phone": PHONE}
ANY = "|".join(KINDS.values())
# Every place where a value with a check may begin, with the longest candidate there.
IBAN_STARTS = IBAN.replace("[A-Z]{2}", "(?=([A-Z]{2}", 1) + "))"
CARD_STARTS = CARD.replace("(?:\\d{13,19}", "(?=((?:\\d{13,19}", 1) + "))"
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30,
    "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
WORTH = r"[0-9@\"]"

DAY_ONE, DAY_LEFT, DAY_RIGHT = "1900-01-01", 17, 4297  # 73,049 days: 1900-01-01 to 2099-12-31


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _keyed(key: str, *parts: Column) -> Column:
    """A 60-bit keyed hash as a long."""
    joined = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(joined, 256), 1, 15), 16, 10).cast("long")


def feistel(l: Column, r: Column, a: Column, b: Column, key: str, tweak: Column) -> Column:  # noqa: E741
    """The permuted pair as struct(l, r); 0 <= l < a and 0 <= r < b go in and come out."""
    first = F.struct(l.cast("long").alias("l"), r.cast("long").alias("r"))

    def turn(acc: Column, i: Column) -> Column:
        left_turn = i % 2 == 0
        mixed = _keyed(key, tweak, i, F.when(left_turn, acc["r"]).otherwise(acc["l"]))
        return F.struct(
            F.when(left_turn, (acc["l"] + mixed % a) % a).otherwise(acc["l"]).alias("l"),
            F.when(left_turn, acc["r"]).otherwise((acc["r"] + mixed % b) % b).alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, turn)


def _power10(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("long")


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A digit string (1 to 30 digits) permuted among the strings of its length."""

    def permuted(d: Column) -> Column:
        n = F.length(d)
        u = F.floor(n / 2).cast("int")
        left, right = F.substring(d, F.lit(1), u), F.substring(d, u + 1, n - u)
        as_long = lambda c: F.coalesce(c.try_cast("long"), F.lit(0))
        pair = feistel(as_long(left), as_long(right), _power10(u), _power10(n - u), key, F.concat(F.lit(kind), n.cast("string")))
        return let(pair, lambda q: F.concat(F.when(u == 0, "").otherwise(F.lpad(q["l"].cast("string"), u, "0")), F.lpad(q["r"].cast("string"), n - u, "0")))

    return let(digits, permuted)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def refill(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced, in order, by ``digits``."""

    def filled(d: Column) -> Column:
        nth = lambda i: F.length(_digits(F.substring(m, F.lit(1), i)))
        one = lambda i: F.substring(m, i, F.lit(1))
        written = lambda i: F.when(F.rlike(one(i), F.lit(r"\d")), F.substring(d, nth(i), F.lit(1))).otherwise(one(i))
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), written), "")

    return let(digits, filled)


def luhn_sum(digits: Column, double_last: bool) -> Column:
    """The Luhn sum; ``double_last``: the last digit is doubled (a payload without its check digit)."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = (i % 2 == 1) if double_last else (i % 2 == 0)
        return acc + F.when(twice, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    def checked(payload: Column) -> Column:
        return F.concat(payload, ((10 - luhn_sum(payload, True) % 10) % 10).cast("string"))

    def moved(d: Column) -> Column:
        new = let(permute_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card"), checked)
        return F.when(luhn_sum(d, False) % 10 == 0, refill(m, new)).otherwise(m)

    return let(_digits(m), moved)


def mod97(iban: Column) -> Column:
    """IBAN remainder: four characters moved to the end, letters as 10..35."""

    def remainder(moved: Column) -> Column:
        def add(acc: Column, i: Column) -> Column:
            c = F.substring(moved, i, F.lit(1))
            value = F.ascii(c) - F.when(F.rlike(c, F.lit(r"\d")), 48).otherwise(55)
            return (acc * F.when(value > 9, 100).otherwise(10) + value) % 97

        return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add)

    return let(F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, F.lit(1), F.lit(4))), remainder)


def _iban(m: Column, key: str) -> Column:
    def moved(plain: Column) -> Column:
        country, body = F.substring(plain, F.lit(1), F.lit(2)), F.substring(plain, F.lit(5), F.length(plain))
        rechecked = lambda b: F.concat(country, F.lpad((98 - mod97(F.concat(country, F.lit("00"), b))).cast("string"), 2, "0"), b)
        value = let(refill(body, permute_digits(_digits(body), key, "iban")), rechecked)
        return F.when((mod97(plain) == 1) & F.rlike(body, F.lit(r"\d")), let(value, spaced)).otherwise(m)

    def spaced(value: Column) -> Column:
        nth = lambda i: F.length(F.replace(F.substring(m, F.lit(1), i), F.lit(" "), F.lit("")))
        written = lambda i: F.when(F.substring(m, i, F.lit(1)) == " ", " ").otherwise(F.substring(value, nth(i), F.lit(1)))
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), written), "")

    return let(F.replace(m, F.lit(" "), F.lit("")), moved)


def _moved_day(day: Column, key: str, notation: str) -> Column:
    n = F.datediff(day, F.lit(DAY_ONE).cast("date")).cast("long")
    pair = feistel(F.floor(n / DAY_RIGHT).cast("long"), n % DAY_RIGHT, F.lit(DAY_LEFT).cast("long"), F.lit(DAY_RIGHT).cast("long"), key, F.lit(notation))
    return let(pair, lambda q: F.date_add(F.lit(DAY_ONE).cast("date"), (q["l"] * DAY_RIGHT + q["r"]).cast("int")))


def _iso_date(m: Column, key: str) -> Column:
    day = F.try_to_date(m, "yyyy-MM-dd")
    return F.when(day.isNotNull(), F.date_format(_moved_day(day, key, "date"), "yyyy-MM-dd")).otherwise(m)


def _day_date(m: Column, key: str) -> Column:
    """d/m/y where that is a date, else m/d/y; written back in the same order, with two-digit fields."""
    mark = F.regexp_extract(m, r"[./]", 0)
    p = F.split(m, r"[./]")
    iso = lambda d, mo: F.try_to_date(F.concat_ws("-", p[2], F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    day_first, month_first = iso(p[0], p[1]), iso(p[1], p[0])

    def write(day: Column, order: list[str], notation: str) -> Column:
        return let(_moved_day(day, key, notation), lambda d: F.concat(F.date_format(d, order[0]), mark, F.date_format(d, order[1]), mark, F.date_format(d, "yyyy")))

    return F.when(day_first.isNotNull(), write(day_first, ["dd", "MM"], "date")).when(month_first.isNotNull(), write(month_first, ["MM", "dd"], "date")).otherwise(m)


def _ip(m: Column, key: str) -> Column:
    p = F.split(m, r"\.")
    at = lambda i: p[i].cast("long")
    half = F.lit(65536).cast("long")
    pair = feistel(at(0) * 256 + at(1), at(2) * 256 + at(3), half, half, key, F.lit("ip"))
    dots = lambda q: [F.floor(q["l"] / 256), q["l"] % 256, F.floor(q["r"] / 256), q["r"] % 256]
    return let(pair, lambda q: F.concat_ws(".", *[d.cast("long").cast("string") for d in dots(q)]))


def _ssn(m: Column, key: str) -> Column:
    p = F.split(m, "-")
    area, group, serial = p[0].cast("long"), p[1].cast("long"), p[2].cast("long")
    rank = area - 1 - F.when(area > 666, 1).otherwise(0)  # 898 areas, without 666
    pair = feistel(rank, (group - 1) * 9999 + serial - 1, F.lit(898).cast("long"), F.lit(99 * 9999).cast("long"), key, F.lit("ssn"))
    pad = lambda c, n: F.lpad(c.cast("long").cast("string"), n, "0")
    area_of = lambda q: q["l"] + 1 + F.when(q["l"] + 1 >= 666, 1).otherwise(0)
    return let(pair, lambda q: F.concat_ws("-", pad(area_of(q), 3), pad(F.floor(q["r"] / 9999) + 1, 2), pad(q["r"] % 9999 + 1, 4)))


def _phone(m: Column, key: str) -> Column:
    """Ten-digit plan numbers (area and exchange 200-999) stay in their plan; other numbers keep their country code."""
    country = F.when(F.startswith(m, F.lit("+")), F.regexp_extract(m, r"^\+([17]|\d{1,3})", 1)).otherwise("")

    def moved(d: Column) -> Column:
        area, rest = F.substring(d, 1, 3).cast("long") - 200, F.substring(d, 4, 7).cast("long") - 2_000_000
        pair = feistel(area, rest, F.lit(800).cast("long"), F.lit(8_000_000).cast("long"), key, F.lit("phone"))
        in_plan = let(pair, lambda q: F.concat((q["l"] + 200).cast("string"), (q["r"] + 2_000_000).cast("string")))
        return F.when(F.rlike(d, F.lit(r"^[2-9]\d\d[2-9]\d{6}$")), in_plan).otherwise(permute_digits(d, key, "phone"))

    return let(country, lambda c: refill(m, F.concat(c, let(F.substring(_digits(m), F.length(c) + 1, F.length(m)), moved))))


def _email(m: Column, key: str) -> Column:
    return F.concat(F.lit("user-"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 20), F.lit("@mail.invalid"))


def _secret(m: Column, key: str) -> Column:
    head, value = F.regexp_extract(m, r'^([^"]*)"', 1), F.regexp_extract(m, r'"([^"]*)"', 1)
    parts = [F.sha2(F.concat_ws("|", F.lit(key), F.lit(f"secret{i}"), value), 256) for i in range(2)]
    return F.concat(head, F.lit('"'), F.substring(F.concat(*parts), F.lit(1), F.length(value)), F.lit('"'))


WRITERS: dict[str, Callable[[Column, str], Column]] = {
    "email": _email, "secret": _secret, "iban": _iban, "iso_date": _iso_date, "day_date": _day_date, "ip": _ip, "ssn": _ssn, "card": _card, "phone": _phone,
}


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one match; the first kind whose whole pattern it fits decides."""
    out = m
    for kind in reversed(list(KINDS)):
        out = F.when(F.rlike(m, F.lit(f"^(?:{KINDS[kind]})$")), WRITERS[kind](m, key)).otherwise(out)
    return out


def _ends(m: Column) -> Column:
    """A candidate and what it holds up to each space inside, longest first."""
    words = F.split(m, " ", -1)
    return F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))


def _valid_iban(m: Column) -> Column:
    """The IBAN that a candidate begins with: of its country's length, the whole, or (country not listed) the longest that passes; null if none."""
    lengths = F.create_map(*[F.lit(x) for kv in IBAN_LENGTH.items() for x in kv])
    plain = lambda e: F.replace(e, F.lit(" "), F.lit(""))

    def passing(due: Column) -> Column:
        may = lambda e: F.rlike(e, F.lit(f"^(?:{IBAN})$")) & (due.isNull() | (F.length(plain(e)) == due) | (e == m))
        ends = F.filter(_ends(m), lambda e: F.when(may(e), mod97(plain(e)) == 1).otherwise(False))
        return let(ends, lambda e: F.coalesce(F.get(F.filter(e, lambda x: F.length(plain(x)) == due), F.lit(0)), F.get(e, F.lit(0))))

    return let(F.try_element_at(lengths, F.substring(m, F.lit(1), F.lit(2))), passing)


def _only(valid: Column, before: str, after: str) -> Column:
    """A pattern for these values (letters, digits, spaces and dashes) alone; without any, one that fits nothing."""
    longest_first = F.transform(F.array_sort(F.transform(F.array_distinct(valid), lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v")))), lambda s: s["v"])
    return F.when(F.size(valid) > 0, F.concat(F.lit(f"{before}(?:"), F.array_join(longest_first, "|"), F.lit(f"){after}"))).otherwise(F.lit("(?!)"))


def any_of(text: Column) -> Column:
    """ANY for one text: IBANs and cards only where they pass their check, so that no failed candidate hides what it holds."""
    ibans = F.filter(F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(IBAN_STARTS), F.lit(1))), _valid_iban), lambda v: v.isNotNull())
    cards = F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(CARD_STARTS), F.lit(1))), lambda c: luhn_sum(_digits(c), False) % 10 == 0)
    own = {
        "iban": F.when(F.rlike(text, F.lit(IBAN)), let(ibans, lambda v: _only(v, r"(?<![\p{L}\p{N}])", _AFTER))).otherwise(F.lit("(?!)")),
        "card": F.when(F.rlike(text, F.lit(CARD)), let(cards, lambda v: _only(v, r"(?<![\p{L}\p{N}-])", r"(?![\p{L}\p{N}-])"))).otherwise(F.lit("(?!)")),
    }
    first, *others = _PHONE.split(_CARDS)

    def joined(card: Column) -> Column:
        phone = F.concat(F.lit(first), *[x for part in others for x in (card, F.lit(part))])
        return F.concat_ws("|", *[{"iban": own["iban"], "card": card, "phone": phone}.get(kind, F.lit(pattern)) for kind, pattern in KINDS.items()])

    return let(own["card"], joined)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = "n_pseudonyms") -> DataFrame:
    """``docs`` with the personal values of ``text_col`` replaced and, unless None, their number added."""
    text = F.col(text_col)

    def joined(found: Column, pattern: Column) -> Column:
        return let(F.transform(found, lambda m: pseudonym(m, key)), lambda new: F.struct(
            F.array_join(F.zip_with(F.split(text, pattern, -1), new, lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "").alias("text"),
            F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x)).alias("n"),
        ))

    replaced = let(any_of(text), lambda p: let(F.regexp_extract_all(text, p, F.lit(0)), lambda f: F.when(F.size(f) > 0, joined(f, p))))
    changed = F.when(F.rlike(text, F.lit(WORTH)), F.when(F.rlike(text, F.lit(ANY)), replaced))
    spare = "_" * (1 + max(map(len, docs.columns)))  # a name that no column has
    out = docs.withColumn(spare, changed)
    if count_col:
        out = out.withColumn(count_col, F.coalesce(F.col(spare)["n"], F.lit(0)).cast("long"))
    return out.withColumn(text_col, F.coalesce(F.col(spare)["text"], text)).drop(spare)
