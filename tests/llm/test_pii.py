from __future__ import annotations

import datetime
import re

from pyspark.sql import functions as F

from dumpwise.llm.pii import feistel, permute_digits, pseudonymise

KEY = "test key"


def swap(spark, *texts):
    rows = pseudonymise(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), KEY).orderBy("doc_id").collect()
    return [r["text"] for r in rows], [r["n_pseudonyms"] for r in rows]


def luhn(s):
    digits = [int(c) for c in s if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_feistel_is_a_permutation(spark):
    for a, b in [(17, 43), (1, 50), (10, 100)]:
        pairs = spark.range(a * b).select(feistel(F.floor(F.col("id") / b), F.col("id") % b, F.lit(a).cast("long"), F.lit(b).cast("long"), KEY, F.lit("t")).alias("p"))
        got = {(r["p"]["l"], r["p"]["r"]) for r in pairs.collect()}
        assert got == {(i, j) for i in range(a) for j in range(b)}


def test_digit_strings(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    got = [r[0] for r in df.select(permute_digits(F.col("d"), KEY, "k")).collect()]
    assert len(set(got)) == 1000 and all(re.fullmatch(r"\d{3}", g) for g in got)
    long = spark.createDataFrame([("1",), ("12345678901234567890",)], "d string").select(permute_digits(F.col("d"), KEY, "k")).collect()
    assert [len(r[0]) for r in long] == [1, 20]


def test_formats_and_links(spark):
    texts = [
        "card 4111111111111111, again 4111 1111 1111 1111.", "not a card 4111111111111112", "born 1987-03-14 or 14.03.1987 not 1987-13-45", "ip 192.168.17.5 end", "call +1 (476) 555-6291 in",
        "iban DE89 3704 0044 0532 0130 00 ok", "ssn 123-45-6789", "mail en.28@mail4.example.com.", 'token = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f" of', "clean words 12 only", None, "",
        "é.12@mail1.example.com", "4111111111111111",
    ]
    out, n = swap(spark, *texts)
    a, b = re.search(r"card (\d{16}), again (\d{4} \d{4} \d{4} \d{4})\.", out[0]).groups()
    assert luhn(a) and a == b.replace(" ", "") and a != "4111111111111111" and out[13] == a
    assert out[1] == texts[1] and n[1] == 0
    iso, dotted = re.fullmatch(r"born (\d{4}-\d\d-\d\d) or (\d\d\.\d\d\.\d{4}) not 1987-13-45", out[2]).groups()
    assert datetime.date.fromisoformat(iso) == datetime.datetime.strptime(dotted, "%d.%m.%Y").date() != datetime.date(1987, 3, 14)
    octets = re.fullmatch(r"ip (\d+)\.(\d+)\.(\d+)\.(\d+) end", out[3]).groups()
    assert all(0 <= int(o) <= 255 for o in octets) and out[3] != texts[3]
    assert re.fullmatch(r"call \+1 \([2-9]\d\d\) [2-9]\d\d-\d{4} in", out[4]) and out[4] != texts[4]
    iban = re.fullmatch(r"iban (DE\d\d(?: \d{4}){4} \d\d) ok", out[5])[1].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1 and out[5] != texts[5]
    assert re.fullmatch(r"ssn \d{3}-\d\d-\d{4}", out[6]) and out[6] != texts[6]
    assert "mail4" not in out[7] and out[7].endswith("@mail.invalid.")
    assert re.fullmatch(r'token = "[0-9a-f]{40}" of', out[8]) and out[8] != texts[8]
    assert out[9:12] == texts[9:12] and n[9:12] == [0, 0, 0]
    assert "é" not in out[12]


def test_dates_are_one_to_one(spark):
    days = spark.range(73049).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    assert pseudonymise(days, KEY).select("text").distinct().count() == 73049


def test_keeps_columns_rows_and_long_texts(spark):
    text = "w " * 50_000 + "4111111111111111" + " w" * 50_000 + "x" * 100_000 + "@"
    df = spark.createDataFrame([(1, text, "a"), (1, text, "a")], "doc_id long, text string, n_found string")
    rows = pseudonymise(df, KEY).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and len(rows[0]["text"]) == len(text) and rows[0]["n_found"] == "a" and "4111111111111111" not in rows[0]["text"]
    assert pseudonymise(df.limit(0), KEY).count() == 0


IBANS = ["ES91 2100 0418 4502 0005 1332", "AT611904300234573201", "BE68 5390 0754 7034", "SE45 5000 0000 0583 9825 7466", "NO93 8601 1117 947", "DE89 3704 0044 0532 0130 00"]


def test_iban_before_upper_case_and_digits(spark):
    texts = [f"to {iban} {after}" for iban in IBANS for after in ("BIC", "2024", "ABCD 1234", "A", "12", "ok")]
    alone = dict(zip(IBANS, swap(spark, *IBANS)[0]))
    assert all(alone[i] != i for i in IBANS)
    assert swap(spark, *texts) == ([f"to {alone[i]} {after}" for i in IBANS for after in ("BIC", "2024", "ABCD 1234", "A", "12", "ok")], [1] * len(texts))


def test_failed_candidates_hide_nothing(spark):
    values = ["4111 1111 1111 1111", IBANS[1], "192.168.17.5", "+1 (826) 555-4081"]
    card, iban, ip, phone = swap(spark, *values)[0]
    texts = ["AB12 {}", "AT12 {}", "1234 {}"]
    assert swap(spark, *[t.format(values[0]) for t in texts])[0] == [t.format(card) for t in texts]
    assert swap(spark, f"AB12 {IBANS[1]}", "AB12 3456 7890 192.168.17.5", f"AT12 3456 7890 1234 {values[3]}")[0] == [f"AB12 {iban}", f"AB12 3456 7890 {ip}", f"AT12 3456 7890 1234 {phone}"]
    quoted = [f'token = "{IBANS[1]}"', f"{IBANS[1]}@example.org"]
    assert all(IBANS[1] not in t for t in swap(spark, *quoted)[0])


def test_phone_ends_before_its_neighbour(spark):
    phones = ["+1 (826) 555-4081", "+1 826 555 4081", "+33 6 12 34 56 78", "+44 20 7946 0958"]
    after = ["190.137.106.4", "2024-01-05", "05.01.2024", "4111 1111 1111 1111", "4111111111111111"]
    alone = dict(zip(phones + after, swap(spark, *phones, *after)[0]))
    assert all(k != v for k, v in alone.items()) and alone[phones[0]][3:] != phones[0][3:]
    assert swap(spark, *[f"{p} {a}" for p in phones for a in after])[0] == [f"{alone[p]} {alone[a]}" for p in phones for a in after]
    assert swap(spark, *[f"{p} 42 times" for p in phones])[0] == [f"{alone[p]} 42 times" for p in phones]
    other = "+49 30 1234 5678"
    assert swap(spark, *[f"{other} {a}" for a in after])[0] == [f"{swap(spark, other)[0][0]} {alone[a]}" for a in after]
