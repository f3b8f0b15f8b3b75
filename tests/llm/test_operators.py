"""Small tables with nulls, empty and repeated rows, ties, clashing names, against brute force."""
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from switchboard.llm.components import connected_components
from switchboard.llm.conversations import render_chats
from switchboard.llm.decontaminate import contaminated_spans
from switchboard.llm.licences import license_matches
from switchboard.llm.minhash import near_duplicates
from switchboard.llm.mixing import mixing_rates
from switchboard.llm.quality import quality_scores
from switchboard.llm.recurrent import language_model_scores
from switchboard.llm.scratch import Scratch
from switchboard.llm.surrogates import pseudonymize
from switchboard.llm.toxicity import _swapped, fit, toxicity_scores
from switchboard.llm.vectors import similar_vectors

OWN = ("_row", "_words", "_sh", "_at", "_all", "_c0", "_matches", "_tries", "_sha", "_kind", "_score", "_text")
DOCS = "doc_id bigint, text string, key string, label string, node int, _tokens int, lang string, " + ", ".join(f"{c} int" for c in OWN)


def docs(spark, rows):
    """doc_id and text, with other columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "k", "l", 1, 2, "en", *range(len(OWN))) for i, t in rows], DOCS)


def words(rng, n):
    return " ".join(f"w{int(x)}" for x in rng.integers(0, 4000, n))


def components(n, linked):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a, b in linked:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return [find(i) for i in range(n)]


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows, base = [], [words(rng, 80) for _ in range(12)]
    for i in range(160):
        w = base[i % 12].split()
        for _ in range(int(rng.integers(0, 9))):
            w[int(rng.integers(0, len(w)))] = f"x{int(rng.integers(0, 9))}"
        rows.append((i, " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \t"), (203, "one"), (204, "One"), (None, base[0])]
    got = {r["doc_id"]: r for r in near_duplicates(docs(spark, rows + rows[:3]), k=2).collect()}
    known = [r for r in rows if r[0] is not None]
    sets = [shingle_set(t, 2) for _, t in known]
    linked = [(a, b) for a, b in itertools.combinations(range(len(known)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for (i, _), s, root in zip(known, sets, components(len(known), linked)):
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == (len(s), known[root][0], known[root][0] == i)
    assert got[None]["component_id"] is None and got[None]["kept"]


def test_large_group_of_near_copies_is_one_component(spark):
    rng = np.random.default_rng(2)
    base = words(rng, 200)
    rows = [(i, f"{base} tail{i}") for i in range(400)] + [(1000 + i, words(rng, 60) + " shared line of words here") for i in range(100)]
    got = near_duplicates(docs(spark, rows), k=5).collect()
    assert {r["component_id"] for r in got if r["doc_id"] < 400} == {0}
    assert all(r["kept"] for r in got if r["doc_id"] >= 1000)


def test_empty_tables(spark):
    none = docs(spark, [])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert near_duplicates(none).count() == 0
    assert contaminated_spans(none, bench).count() == 0
    assert contaminated_spans(docs(spark, [(1, "a b")]), bench).first()["spans"] is None
    assert language_model_scores(none, F.lit(False)).count() == 0
    assert quality_scores(docs(spark, [(1, "a b"), (None, None)]), labels, F.lit(False)).select("score").distinct().first()[0] == 0.5
    assert toxicity_scores(docs(spark, [(1, "a b")]), labels, F.lit(False)).first()["_predicted"] == 0
    assert similar_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0
    assert render_chats(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0
    assert license_matches(none).count() == 0
    assert pseudonymize(none, "k").count() == 0
    assert mixing_rates(none, "lang", {"en": 1.0, "de": 1.0}).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = dict(connected_components(spark.createDataFrame(links, "a bigint, b bigint"), Scratch(spark, "test")).collect())
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 160)} == {100}


def test_contaminated_spans_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    items = [(i, words(rng, int(n))) for i, n in enumerate([15, 9, 1, 30, 10])] + [(7, None), (8, " . "), (None, words(rng, 12))]
    rows = [(0, items[0][1]), (1, "a " + items[1][1].upper() + ", b"), (2, items[3][1][:-30]), (3, None), (4, ""), (5, " ".join(items[3][1].split()[:9])),
            (6, items[3][1] + " " + items[3][1]), (7, words(rng, 300)), (8, items[2][1] + " x " + items[2][1]), (None, items[4][1])]
    bench = spark.createDataFrame(items * 2, "item_id bigint, text string")
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    for r in contaminated_spans(docs(spark, rows), bench).collect():
        w = norm(dict(rows)[r["doc_id"]])
        hit, own = set(), set()
        for name, t in items:
            v = norm(t)
            size = min(len(v), 10)
            for i in range(len(v) - size + 1 if v else 0):
                for j in range(len(w) - size + 1):
                    if w[j:j + size] == v[i:i + size]:
                        hit |= set(range(j, j + size))
                        own |= {str(name)} if name is not None else set()
        assert r["n_words"] == len(w)
        assert {p for s in r["spans"] or [] for p in range(s["begin"], s["end"])} == hit
        assert (r["items"] or []) == sorted(own)


def test_similar_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 16))
    vecs = [(i, [float(x) for x in base[i % 6] + rng.normal(scale=0.06, size=16)], i % 3) for i in range(150)]
    vecs += [(200 + i, vecs[0][1], vecs[0][2]) for i in range(5)] + [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] * 16, 0), (303, vecs[0][1], None), (304, [1.0, None], 0), (305, [], 0)]
    got = {r["vec_id"]: r for r in similar_vectors(spark.createDataFrame(vecs, "vec_id bigint, embedding array<double>, label int")).collect()}
    sound = [v and None not in v and np.isfinite(v).all() and any(v) and k is not None for _, v, k in vecs]
    linked = []
    for a, b in itertools.combinations(range(len(vecs)), 2):
        if sound[a] and sound[b] and vecs[a][2] == vecs[b][2] and len(vecs[a][1]) == len(vecs[b][1]):
            x, y = np.array(vecs[a][1]), np.array(vecs[b][1])
            if (x @ y) / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                linked.append((a, b))
    n = np.bincount(np.array(linked).ravel(), minlength=len(vecs))
    for (i, _, _), c, root in zip(vecs, n, components(len(vecs), linked)):
        assert (got[i]["n_links"], got[i]["component_id"]) == (c, vecs[root][0])


def test_snapshots_collapse(spark):
    t = [("user", "hi"), ("assistant", "yes <|im_end|>"), ("user", None), (None, "end")]
    rows = [(c, j, *t[j]) for c, n in ((1, 1), (2, 2), (3, 4), (4, 4)) for j in range(n)] + [(5, 0, "user", "hi"), (5, 1, "assistant", "no"), (None, 0, "user", "x"), (3, 0, "user", "hi")]
    got = {r["conv_id"]: r for r in render_chats(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert set(got) == {3, 5} and got[3]["n_copies"] == 2 and got[3]["n_turns"] == 4
    assert got[5]["chat"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nno<|im_end|>\n"
    assert "yes < |im_end|>" in got[3]["chat"]


def test_licenses(spark):
    rows = [(1, "x y\nLicensed under the Apache License, Version 2.0.\nz"), (2, "released UNDER the mit license"), (3, "This work is licensed under the GNU General Public License, version 3."),
            (4, None), (5, "two words"), (6, "under the table and the license " * 50), (7, ("pad " * 900) + "Licensed under CC BY-NC 4.0. " + ("pad " * 900) + "Licensed under CC BY-NC 4.0.")]
    got = {r["doc_id"]: [m["license"] for m in r["_licenses"]] for r in license_matches(docs(spark, rows)).collect()}
    assert got == {1: ["Apache-2.0"], 2: ["MIT"], 3: ["GPL-3.0"], 4: [], 5: [], 6: [], 7: ["CC-BY-NC-4.0"] * 2}


def test_surrogates(spark):
    rows = [(1, "mail a.b@x.example.com, A.B@x.example.com; call +1 (017) 555-7713 or (017) 555-7713."), (2, "a.b@x.example.com 97.51.17.173. 4111111111111111 4111 1111 1111 1111"),
            (3, None), (4, ""), (5, "plain words only, 12 of them"), (6, "Mr Smith and Mr. John Smith, Frau Weber; Госпожа Иванова"), (7, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"')]
    rows += [(100 + i, f"10.0.{i // 250}.{i % 250 + 1} and user{i}@mail.example.org") for i in range(600)]
    got = {r["doc_id"]: r for r in pseudonymize(docs(spark, rows), "secret").collect()}
    text = {i: r["text"] for i, r in got.items()}
    assert text[3] is None and text[4] == "" and text[5] == rows[4][1]
    mails = re.findall(r"\S+@[\w.]+\w", text[1])
    assert len(mails) == 2 and mails[0].lower() == mails[1].lower() == text[2].split()[0].lower() and mails[0] != "a.b@x.example.com"
    assert re.fullmatch(r"mail \w\.\w@\w\.\w{7}\.com, \w\.\w@\w\.\w{7}\.com; call \+1 \(\d{3}\) \d{3}-\d{4} or \(\d{3}\) \d{3}-\d{4}\.", text[1])
    card, spaced = re.findall(r"\b4\d{3} ?\d{4} ?\d{4} ?\d{4}\b", text[2])
    assert card == spaced.replace(" ", "") != "4111111111111111"
    digits = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(card))]
    assert sum(d - 9 if d > 9 else d for d in digits) % 10 == 0
    name = re.fullmatch(r"Mr (\w+) and Mr\. (\w+) (\w+), Frau (\w+); Госпожа ([а-яА-Я]+)", text[6])
    assert name and name[1] == name[3] != "Smith" and name[4] != "Weber"
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', text[7]) and text[7] != rows[6][1]
    many = [text[100 + i].split(" and ") for i in range(600)]
    assert len({m[0] for m in many}) == 600 and len({m[1] for m in many}) == 600
    assert not {m[0] for m in many} & {rows[7 + i][1].split(" and ")[0] for i in range(600)}
    assert text[101] == pseudonymize(docs(spark, rows), "secret").where("doc_id = 101").first()["text"]


def test_mixing_meets_targets(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"{'a' if i % 4 else 'b'}{int(x)}" for x in rng.integers(0, 50, 40)), "en" if i % 4 else "de") for i in range(200)] + [(900, None, "en"), (901, "", None)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = mixing_rates(d, "lang", {"de": 0.5, "en": 0.5}).collect()
    assert len(got) == 202 and all(r["_rate"] >= 0 for r in got)
    tokens = sum(r["_tokens"] for r in got)
    for p in ("_p0", "_p1"):
        assert abs(sum(r["_rate"] * r["_tokens"] * r[p] for r in got) / tokens - 0.5) < 1e-5
    # an unreachable target leaves a residual, not an error, and rates stay nonnegative
    assert all(r["_rate"] >= 0 for r in mixing_rates(d, "lang", {"de": 0.99, "en": 0.01, "xx": 0.5}).collect())


def test_language_model(spark):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(np.array(["the cat sat", "le chat noir"])[i % 2].split() * int(rng.integers(20, 60)))) for i in range(300)] + [(1000, None), (1001, "zebra"), (None, "x")]
    out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 1
    got = {r["doc_id"]: r for r in language_model_scores(docs(spark, rows), out).collect()}
    learn = [(t or "").split() + [None] for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    count = {}
    for w in itertools.chain(*learn):
        count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    for i, t in rows:
        w = (t or "").split() + [None]
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(x in count for x in w), n)
        assert r["base_score"] == pytest.approx(sum(np.log10((count.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w), abs=1e-6)
    held = [r for r in got.values() if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_quality_separates(spark):
    rng = np.random.default_rng(7)
    rows = [(i, words(rng, 60) if i % 2 else "buy!! now### " * 30) for i in range(200)] + [(900, None), (901, "")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    got = [r for r in quality_scores(docs(spark, rows), labels, out).collect()]
    held = [r for r in got if r["held_out"] and r["doc_id"] < 200]
    assert len(got) == 202 and held and all(r["predicted"] == r["doc_id"] % 2 for r in held)


def test_toxicity_learns_words_and_not_groups(spark):
    groups = ["muslim", "christian", "jewish", "hindu"]
    sample = []
    for i in range(400):
        bad = i % 2
        # the biased sample names one group in most toxic sentences
        g = groups[0] if bad and i % 8 else groups[i % 4]
        sample.append((f"filler{i % 7} the {g} neighbour is {'horrid' if bad else 'kind'} today. more{i % 5} text.".encode(), bad))
    slots, weights, bias = fit(sample)
    assert len(_swapped("A Muslim man.")) >= 7
    from switchboard.llm import bytetext as B
    from switchboard.llm.toxicity import SLOTS, scores
    import pyarrow as pa
    index = np.full(SLOTS, -1, np.int64)
    index[slots] = np.arange(len(slots))
    s = scores((index, weights, bias), B.flat(pa.array([f"the {g} neighbour is kind today" for g in groups] + ["the person is horrid", None])))
    assert s[:4].max() < 0.5 and s[:4].max() - s[:4].min() < 0.1 and s[4] > 0.7 and s[5] < 0.7
