"""Each written form of the detected kinds: none of it stays, the format does, and spellings of one entity agree."""
import re

import pytest

from switchboard.llm.surrogates import pseudonymize

PHONES = ["+12125551234", "+1 212 555 1234", "+33 1 23 45 67 89", "+49 30 12345678", "+49 1512 3456789", "+49 (0)30 1234567", "+34 912 34 56 78", "0033 1 23 45 67 89",
          "212.555.1234", "212 555 1234", "212-555-1234", "1 212 555 1234", "+1 (017) 555-7713", "(017) 555-7713", "01 23 45 67 89", "01.23.45.67.89",
          "912 34 56 78", "91 123 45 67", "612 345 678", "030 12345678", "030/12345678", "(030) 1234567", "020 7946 0958"]
CARDS = ["3782 822463 10005", "3782-822463-10005", "378282246310005", "4111 1111 1111 1111"]
IBANS = ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "FR14 2004 1010 0505 0001 3M02 606", "ES91 2100 0418 4502 0005 1332", "es9121000418450200051332"]
ACCOUNTS = ["12345678", "1234567890"]
PLAIN = ["01.02.2024", "2024-01-02 12:30", "01-02-2024 12:30", "12 345 678 901", "1.234.567 of 100000", "year 2024", "12345678 items", "DE89 3704 0044", "AB12 CDEF GHIJ"]


def shape(t):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", t)))


def mod97(t):
    t = re.sub("[ -]", "", t).upper()
    return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97


def run(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: r for r in pseudonymize(d, "secret").collect()}


@pytest.fixture(scope="module")
def found(spark):
    forms = [("phone", t, f"call {t}, or") for t in PHONES] + [("card", t, f"card {t}; x") for t in CARDS] + [("iban", t, f"IBAN {t} x") for t in IBANS]
    forms += [("account", t, f"{w}{t}.") for t in ACCOUNTS for w in ("account number: ", "Account no. ", "Kontonummer ", "acct #")]
    got = run(spark, [text for _, _, text in forms])
    return [(kind, form, text, got[i]) for i, (kind, form, text) in enumerate(forms)]


def test_every_form_is_replaced_and_keeps_its_format(found):
    for kind, form, text, r in found:
        assert [e["kind"] for e in r["_entities"]] == [kind], text
        new = r["_entities"][0]["surrogate"]
        assert r["text"] == text.replace(form, new) and new != form, text
        if kind != "iban":
            assert shape(new) == shape(form)
        else:
            assert len(new) == len(form) and new[:2] == form[:2] and mod97(new) == 1


def test_spellings_agree(found):
    new = {(kind, form): r["_entities"][0]["surrogate"] for kind, form, _, r in found}
    digits = lambda kind, form: re.sub(r"\D", "", new[kind, form])
    assert digits("phone", "+12125551234") == digits("phone", "+1 212 555 1234") and new["phone", "+12125551234"].startswith("+1")
    assert digits("phone", "0033 1 23 45 67 89") == "00" + digits("phone", "+33 1 23 45 67 89") and new["phone", "+33 1 23 45 67 89"].startswith("+33 ")
    assert digits("phone", "212.555.1234") == digits("phone", "212 555 1234") == digits("phone", "212-555-1234")
    assert digits("card", "3782 822463 10005") == digits("card", "378282246310005")
    assert new["iban", IBANS[0]].replace(" ", "") == new["iban", IBANS[1]]
    assert new["iban", IBANS[4]].replace(" ", "").lower() == new["iban", IBANS[5]].lower()


def test_other_numbers_stay(spark):
    got = run(spark, PLAIN)
    assert [got[i]["text"] for i in range(len(PLAIN))] == PLAIN


def test_wrong_iban_checksum_stays_wrong(spark):
    r = run(spark, ["IBAN DE88 3704 0044 0532 0130 00."])[0]
    assert mod97(r["_entities"][0]["surrogate"]) != 1
