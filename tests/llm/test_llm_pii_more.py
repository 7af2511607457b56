"""PII: what must stay, scripts and endings, account numbers, IPv6, national phones, every listed name."""

import random
import re

import pytest

from pricewise.llm import pii


def run(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(pii.report(df, key="k").collect())


def test_number_tables_and_year_lists_stay(spark):
    rng = random.Random(3)
    texts = ["population 1990 1995 2000 2005 2010 2015 2020", " ".join(str(rng.randrange(10 ** rng.randrange(1, 8))) for _ in range(200)),
             "\n".join(" ".join(f"{rng.randrange(10000):04d}" for _ in range(8)) for _ in range(100)),
             "0.1234 0,5678 10:20:30 12:30 a::b std::vector 2024-01-02 00:1A:2B:3C:4D:5E", "v 1.0.0.1.2, 3.14159 26535 8979",
             " ".join(str(10 ** 15 + 7 * i) for i in range(100)), "AB12 CDEF GHIJ KLMN and DE00 5001 0517 5407 3249 31"]
    for r in run(spark, texts):
        assert r.text == texts[r.doc_id] and r.n_entities == 0, r


def test_cards_need_an_issuer(spark):
    good = ["4539148803436467", "5555555555554444", "2223003122003222", "378282246310005", "30569309025904", "6011111111111117",
            "3530111333300000", "3782 822463 10005", "4539-1488-0343-6467", "5555 5555 5555 4444"]
    bad = ["1234567812345670", "9999999999999995", "0000000000000000", "4539 14880343 6467", "45391488 03436467", "4539148803436468"]
    got = run(spark, [f"n {c}." for c in good + bad])
    for r, c in zip(got, good + bad):
        assert (r.kinds == "card") == (c in good), c
        if c in good:
            new, old = re.sub(r"\D", "", r.text), re.sub(r"\D", "", c)
            assert new != old and re.fullmatch(pii.ISSUERS.replace(r"\A", "").replace(r"\z", ""), new)
            assert new[:1] == old[:1] and re.sub(r"\d", "9", r.text) == re.sub(r"\d", "9", f"n {c}.")


def test_scripts_and_endings_of_surnames(spark):
    names = ["Анна Королёва", "Иван Королёв", "Мария Достоевская", "Mr Παπαδόπουλος", "Анна Іваненко", "Mr Հակոբյան", "Frau Kowalska", "Mr Łukasiewicz"]
    got = [r.text.split(" ")[1] for r in run(spark, names)]
    for new, old in zip(got, names):
        old = old.split(" ")[1]
        assert new != old and len(new) == len(old) and new[0].isupper() and new[1:].islower()
    assert got[0].endswith("ёва") and got[1].endswith("ёв") and got[2].endswith("ская") and got[6].endswith("ska")
    for i, block in ((0, "[а-яё]+"), (1, "[а-яё]+"), (2, "[а-яё]+"), (3, "[α-ω]+"), (4, "[а-я]+"), (5, "[ա-ֆ]+")):
        assert re.fullmatch(block, got[i].lower()), got[i]


def mod97(iban):
    s = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in s)) % 97


def test_account_numbers_are_checked_and_made_valid(spark):
    texts = ["pay DE89 3704 0044 0532 0130 00 now", "GB29NWBK60161331926819", "BE68 5390 0754 7034 THIS IS IT",
             "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "FR14 2004 1010 0505 0001 3M02 606"]
    got = run(spark, texts)
    for r in got:
        assert r.kinds == "iban" and r.n_entities == 1
        new = re.search(r"[A-Z]{2}\d\d(?: ?[A-Z0-9]{4})+(?: ?[A-Z0-9]{1,3})?", r.text.replace(" THIS IS IT", ""))[0]
        old = re.search(r"[A-Z]{2}\d\d(?: ?[A-Z0-9]{4})+(?: ?[A-Z0-9]{1,3})?", texts[r.doc_id].replace(" THIS IS IT", ""))[0]
        assert new != old and new[:2] == old[:2] and mod97(new.replace(" ", "")) == 1 and len(new) == len(old)
    assert got[2].text.endswith(" THIS IS IT") and got[0].text.startswith("pay DE") and got[0].text.endswith(" now")


def test_ipv6_and_national_phones(spark):
    texts = ["at 2001:0DB9:85A3:0000:0000:8A2E:0370:7334.", "to fe80::1ff:fe23:4567:890a, ok", "(2a00:1450:4001::200e)", "from fe80::1",
             "tel 0171 2345678", "tel 01 23 45 67 89", "tel 030/1234567", "tel 06.12.34.56.78"]
    got = run(spark, texts)
    assert [r.kinds for r in got] == ["ipv6"] * 4 + ["phone"] * 4
    for r in got[:4]:
        assert re.search(r"(?i)2001:db8(?::[0-9a-f]{1,4}){6}", r.text)
    assert "DB8" in got[0].text and got[0].text.startswith("at ") and got[0].text.endswith(".")
    for r in got[4:]:
        assert r.text != texts[r.doc_id] and re.sub(r"\d", "9", r.text) == re.sub(r"\d", "9", texts[r.doc_id]) and r.text[4] == "0"


def test_every_listed_name_gets_a_plain_one(spark):
    listed = [(n, s, g) for (s, g), names in pii.NAMES.items() for n in names]
    got = run(spark, [f"{n} {'Иванко' if s == 'cyrillic' else 'Taylor'} came" for n, s, g in listed])
    new = [r.text.split(" ")[0] for r in got]
    assert len(set(zip(new, [s + g for _, s, g in listed]))) == len(listed)
    for made, (old, script, gender) in zip(new, listed):
        assert "-" not in made and made not in {n for n, _, _ in listed} and made.endswith(pii.MADE[script][2][gender])


def test_words_that_are_no_names_stay(spark):
    got = run(spark, ["Mary Will go. Will you? Mary Smith May agree. May I?", "Anna Le Monde"])
    assert re.fullmatch(r"\w+ Will go\. Will you\? \w+ \w+ May agree\. May I\?", got[0].text) and "Smith" not in got[0].text


def test_key_is_required_and_matters(spark):
    df = spark.createDataFrame([(1, "a@b.com")], "doc_id long, text string")
    with pytest.raises(TypeError):
        pii.report(df)
    assert pii.report(df, key="x").first().text != pii.report(df, key="y").first().text
