"""No given name and no local part of an address stays as it was, in any script."""
import re
import string

from switchboard.llm.surrogates import GIVEN, pseudonymize

LOCALS = ["αλέξανδρος", "ΝΙΚΟΣ", "田中太郎", "さくら", "タナカ", "김철수", "محمد", "דוד", "राम", "สมชาย", "Łukasz", "ёлка", "Ձայն", "გია", "ሰላም", "٣٤٥"]


def run(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r["doc_id"]: r["text"] for r in pseudonymize(d, "secret").collect()}


def test_given_names_never_stay(spark):
    names = [(title, n) for title, g in (("Mr", ("m", "latin")), ("Ms", ("f", "latin")), ("Господин", ("m", "cyrillic")), ("Госпожа", ("f", "cyrillic"))) for n in GIVEN[g]]
    got = run(spark, [f"{title} {n} {'Smith' if n.isascii() else 'Иванов'}" for title, n in names])
    new = [got[i].split(" ")[1] for i in range(len(names))]
    assert not [n for (_, n), m in zip(names, new) if n == m]
    assert len({(t, m) for (t, _), m in zip(names, new)}) == len(names)


def test_local_parts_of_any_script_are_redrawn(spark):
    got = run(spark, [f"to {x}@mail.example.org" for x in LOCALS] + ["to _._@mail.example.org"])
    for i, x in enumerate(LOCALS):
        local = re.fullmatch(r"to (\S+)@\S+\.org", got[i])[1]
        assert len(local) == len(x), (x, local)
        assert local.lower() != x.lower()
        assert local.isupper() == x.isupper()


def test_short_addresses_come_to_an_end(spark):
    got = run(spark, [f"{c}@x.example.org" for c in string.ascii_lowercase])
    new = [got[i].split("@")[0] for i in range(26)]
    assert len(set(new)) == 26 and not [c for c, m in zip(string.ascii_lowercase, new) if c == m]
